"""Declared loads: table specs for the three tiers and the jobs that run them."""

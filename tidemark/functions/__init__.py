"""Column-level helpers: names, dates, error lists."""

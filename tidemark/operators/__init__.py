"""DataFrame-to-DataFrame operators: conform, refresh, upsert, run log, time series."""

"""DataFrame to DataFrame operators; column names and thresholds are parameters."""

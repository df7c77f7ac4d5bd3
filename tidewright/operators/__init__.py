"""DataFrame operators for irregular and gridded time series."""

"""DataFrame -> DataFrame steps: clean (L1), daily (L2), outliers (L3), forecast + arima (L4), ml (L5), quality, joins."""

"""Jobs and the query catalog over the driver's test tables."""

"""The library's operators applied to the driver's test tables."""

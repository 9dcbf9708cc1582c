"""Whole plans: the four stages, and the query catalogue over the driver's tables."""

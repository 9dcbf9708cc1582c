"""Column functions: formats, line layouts, dates and referrers."""

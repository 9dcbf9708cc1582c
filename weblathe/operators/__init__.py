"""DataFrame operators: domains, filters, metrics and analyses."""

"""DataFrame-to-DataFrame operators: conformation, reconciliation, aggregation."""

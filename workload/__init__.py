"""Check workload: three feeds derived from the driver's tables, one query per operator."""

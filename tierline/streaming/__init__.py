"""The incremental hops as Structured Streaming queries."""

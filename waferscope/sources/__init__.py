"""Table contract, readers and writers, and bindings that derive fab tables from other data."""

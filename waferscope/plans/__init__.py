"""Multi-step reports built from the operators: contract audits, load checks, conclusion checks."""

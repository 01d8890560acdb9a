"""The lake's tables, marts and jobs, composed from the operators."""

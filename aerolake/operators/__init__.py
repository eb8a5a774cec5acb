"""Table-level operators: flatten, dimensions, keyed facts, gold views,
planning and audit queries.  Each takes and returns DataFrames."""

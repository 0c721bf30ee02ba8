"""Column functions: wide integers, ABI words, tolerant projections."""

"""Training-data operators: the numbered operators and their queries."""

"""Training-data operators (the numbered list) and their queries."""

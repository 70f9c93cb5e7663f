"""Column-level functions: text cleaning, accuracy, test statistics."""

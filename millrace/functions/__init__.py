"""Column functions that work alike on batch and streaming frames."""

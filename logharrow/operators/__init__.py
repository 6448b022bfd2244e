"""DataFrame operators of the log pipeline."""

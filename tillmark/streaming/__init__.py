"""Parts that run on a stream."""

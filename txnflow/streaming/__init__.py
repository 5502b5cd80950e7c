"""Streaming sinks, the two-query pipeline and progress reporting."""

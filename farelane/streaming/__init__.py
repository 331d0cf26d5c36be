"""Streaming jobs; each parser works on a batch and on a stream alike."""

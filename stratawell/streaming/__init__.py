"""Streaming sinks and stateful streaming operators."""

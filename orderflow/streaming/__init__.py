"""Structured Streaming sinks and the incremental curation run."""

"""Structured Streaming: stateful enrichment and the fan-out to the sinks."""

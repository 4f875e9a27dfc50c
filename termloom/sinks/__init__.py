"""Plain-text sinks."""

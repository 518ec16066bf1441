"""Table and text sinks."""

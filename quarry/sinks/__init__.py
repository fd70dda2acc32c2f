"""quarry.sinks."""

"""Sources (generic reader, readings fixture, scans) and sinks."""

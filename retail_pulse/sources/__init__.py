"""Sources (table scans, stream readers, adapters) and sinks."""

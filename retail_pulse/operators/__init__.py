"""DataFrame -> DataFrame operators (batch form; the streaming jobs reuse them)."""

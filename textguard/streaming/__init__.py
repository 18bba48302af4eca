"""The row-local rules over Structured Streaming sources."""

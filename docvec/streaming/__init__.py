"""The same steps on streams, with Structured Streaming."""

"""The same operators as Structured Streaming jobs."""

"""The batch logic on unbounded input, with Structured Streaming."""

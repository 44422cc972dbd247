"""Mini-batch ingestion with Structured Streaming."""

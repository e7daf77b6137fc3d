"""The incremental job as a streaming query."""

"""File-source Structured Streaming imports."""

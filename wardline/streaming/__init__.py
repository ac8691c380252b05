"""Structured Streaming jobs over arriving encounters and scored records."""

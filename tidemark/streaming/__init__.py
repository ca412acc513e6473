"""Structured Streaming jobs: event feeds, stream-fed aggregates and upserts."""

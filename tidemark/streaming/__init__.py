"""Structured Streaming: bronze append, silver history merge, monitoring."""

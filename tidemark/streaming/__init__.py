"""Structured Streaming jobs for live liquidation events."""

"""Structured Streaming capture: routing, keyword tracking, rolling sink."""

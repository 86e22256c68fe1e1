"""Readers: JSON Lines captures, state tables, stand-ins over driver tables."""

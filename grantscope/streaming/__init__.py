"""Structured Streaming form of the per-grant detection rules (extension X7)."""

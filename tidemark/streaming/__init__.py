"""Structured Streaming form of the mart load."""

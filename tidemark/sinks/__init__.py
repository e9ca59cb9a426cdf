"""Writes: raw landing, staging replacement and table versions."""

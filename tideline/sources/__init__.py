"""Readers, layouts and sinks."""

"""Readers, sinks and model persistence."""

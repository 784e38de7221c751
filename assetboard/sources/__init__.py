"""Readers, sinks and the stand-in inputs built from the shared tables."""

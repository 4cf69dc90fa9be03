"""Whole jobs composed of operators, sources and sinks."""

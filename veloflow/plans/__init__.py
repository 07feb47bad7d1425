"""Composite pipelines: one chain of transforms each, with actions only at fits and sinks."""

"""Wiring of operators into a pipeline."""

"""Whole jobs: each composes sources, operators and sinks for one kind of input."""

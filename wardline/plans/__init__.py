"""Whole runs: which steps are written, which stay lazy, and in what order they go."""

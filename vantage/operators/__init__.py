"""Relational operators of the insight spec, chart frames, and set-based catalog operators."""

"""Spec → DataFrame planning: spec normalization, the insight planner, SQL binding, the builder."""

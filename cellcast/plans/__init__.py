"""Composite hazard jobs built from the operators."""

"""Composite dataflows built from the operators."""

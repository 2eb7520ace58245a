"""Relational operators of the feature dataflow."""

"""Whole jobs: link features, training, scoring."""

"""Operators that prepare text for training, each with one registered query."""

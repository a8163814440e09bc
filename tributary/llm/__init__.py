"""Operators for training-data pipelines, each in a module of its own; ``queries`` registers them."""

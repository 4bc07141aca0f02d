"""Operators for building language-model training data, each in a module of its own."""

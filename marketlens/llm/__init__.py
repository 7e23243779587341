"""Operators that prepare text for training a language model."""

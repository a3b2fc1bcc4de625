"""Operators over the raw feed, the dimensions and the fact."""

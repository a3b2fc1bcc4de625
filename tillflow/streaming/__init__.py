"""Streaming landing of sales files."""

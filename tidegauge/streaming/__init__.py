"""Structured Streaming flows over the operators."""

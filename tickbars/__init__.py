"""Bars and moving averages over streams and tables of market ticks."""

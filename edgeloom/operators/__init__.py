"""Operators over edge, span, vector and risk DataFrames."""

"""Relational, graph and quality operators; each takes and returns DataFrames."""

"""Relational operators over corpora; each takes and returns DataFrames."""

"""Corposcope: evidence-grounded corpus analytics on Spark DataFrames."""

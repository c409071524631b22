"""Operators: DataFrames in, one lazy DataFrame out."""

"""Operators from DataFrames to DataFrames; lazy, without Python in their plans."""

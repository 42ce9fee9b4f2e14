"""Binding of named inputs to DataFrames."""

"""Readers: files and bus captures -> DataFrames."""

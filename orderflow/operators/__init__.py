"""Operators of the dossier, each a function of DataFrames returning a lazy DataFrame."""

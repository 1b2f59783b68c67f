"""Relational and modelling operators; each takes DataFrames and returns DataFrames."""

"""Relational, sequence, dimensional and merge operators over DataFrames."""

"""Relational, statistical and mining operators (DataFrame in, DataFrame out)."""

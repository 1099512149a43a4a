"""Relational, statistical and model operators, each a DataFrame-to-DataFrame function."""

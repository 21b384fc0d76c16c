"""Queries over the stored tables. Without a market they answer for every market and token at once."""

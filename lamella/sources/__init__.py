"""Readers: each returns a DataFrame, with rejected rows in a second one where the format can break."""

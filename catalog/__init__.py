"""Registered queries over the test tables, with an independent SQL form of each."""

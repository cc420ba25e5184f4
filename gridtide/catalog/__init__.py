"""Registered queries: every operator and report over the given tables, with its SQL twin."""

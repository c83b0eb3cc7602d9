"""Composite plans: test panels over the given tables, the refresh job, ordinals."""

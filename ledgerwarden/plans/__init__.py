"""Composed plans: the named query catalog, run state and the daily run."""

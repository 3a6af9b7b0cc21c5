"""Composed plans: the registered query catalog, its SQL oracle, batch runs."""

"""Composed plans: the registered query catalogue, its SQL oracle and the pipeline."""

"""Composed plans: the registered queries and the batch jobs."""

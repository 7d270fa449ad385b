"""Compositions of the operators: cleaning plans, dimensions, views, jobs."""

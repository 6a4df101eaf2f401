"""Compositions of operators: marts, the parking preset and its jobs."""

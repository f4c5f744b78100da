"""Compositions of operators: the refined layer and dashboard datasets."""

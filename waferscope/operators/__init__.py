"""Analyses and shaping operators: ``f(tables, **params) -> DataFrame``, lazy unless the docstring says otherwise."""

"""Composed tables: names, keys and parameters only; the work is in the operators."""

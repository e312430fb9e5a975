"""Whole computations and the registered queries."""

"""Whole reports and jobs composed from the operators."""

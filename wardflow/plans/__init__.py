"""Whole jobs and reports built from the operators."""

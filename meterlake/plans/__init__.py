"""Whole jobs, built from sources and operators."""

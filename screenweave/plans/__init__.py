"""Queries over the star-schema tables, and the step graph that chains operators."""

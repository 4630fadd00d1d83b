"""Registered queries: each builds a DataFrame plan from the supplied tables."""

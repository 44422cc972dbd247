"""Registered queries and pipelines of operators."""

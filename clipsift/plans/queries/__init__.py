"""Registered queries, one module per kind of operator."""

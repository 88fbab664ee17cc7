"""Reusable relational operators (all DataFrame plans, no Python UDFs)."""

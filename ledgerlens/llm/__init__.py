"""Operators for preparing training text, with their registered queries."""

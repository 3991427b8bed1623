"""Operators for preparing training text and vectors. Nothing outside this folder imports it."""

"""Operators for preparing training text, each over a whole table.

Nothing outside this subpackage imports it.
"""

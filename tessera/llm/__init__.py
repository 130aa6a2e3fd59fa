"""Operators for preparing training data at corpus scale.

Nothing outside this package imports it; ``entry.py`` holds the registered queries.
"""

"""Operators for large training-text corpora; nothing outside this folder imports them.

Executors need this package importable (installed, or shipped with ``--py-files``).
"""

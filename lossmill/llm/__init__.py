"""Operators for preparing training text: filters, deduplication, packing, archives.

Nothing else in the library imports this subpackage. Each operator has a module of its own, and
``queries`` binds the operators to the given tables.
"""

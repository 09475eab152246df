"""Assembled plans: the layered run, the registered queries and their SQL."""

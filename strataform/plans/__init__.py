"""Composite plans: marts, checks, the layered build."""

"""Reusable DataFrame steps shared by several plans."""

"""Readers with explicit schemas and writers that keep names in place."""

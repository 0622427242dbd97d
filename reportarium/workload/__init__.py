"""Synthetic tables in the roles of the estate, and the registered queries."""

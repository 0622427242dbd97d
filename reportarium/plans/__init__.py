"""The questions asked of the estate, each one lazy DataFrame function."""

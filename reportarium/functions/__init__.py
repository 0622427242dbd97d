"""Column builders: Column in, Column out, no session and no action."""

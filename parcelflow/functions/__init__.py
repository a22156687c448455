"""Column functions: no session, no shuffle, no Python workers."""

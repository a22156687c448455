"""Message feeds and landed tables."""

"""Landing, result tables and message output."""

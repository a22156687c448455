"""Named streaming queries, their lifetime and their progress."""

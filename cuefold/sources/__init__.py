"""Sources of timed text."""

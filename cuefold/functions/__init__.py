"""Functions of timed text."""

"""Errors raised before any Spark job starts."""


class MissingInput(AssertionError):
    """A layer, a directory or a file list that should hold data holds none."""

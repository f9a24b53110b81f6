"""Errors raised by guards. Guards are the only library functions, besides sinks, that run a Spark action."""


class LayoutError(ValueError):
    """A file does not have the columns, header or schema its contract asks for."""


class ConsistencyError(ValueError):
    """Rows or totals contradict each other."""


class NotApprovedError(RuntimeError):
    """A release was used before its gate allowed it."""

"""DataFrame -> DataFrame operators. All are lazy, except guards whose names start with ``require_``."""

"""Readers and writers. Readers are lazy apart from Spark's own header and schema look-ups."""

"""Typed reads, table layout, sinks, and the views over the generated test tables."""

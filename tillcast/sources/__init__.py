"""Schemas, fixture adapter views, JDBC and file sources and sinks."""

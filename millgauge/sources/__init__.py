"""Readers and writers: tables, broker messages, JDBC, seeds, sinks."""

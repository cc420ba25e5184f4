"""Readers and writers: landed documents, JSON lines, partitioned tables, expected series."""

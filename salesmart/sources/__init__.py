"""Readers and writers: partitioned lake, warehouse tables, message sink, sample tables."""

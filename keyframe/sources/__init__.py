"""Readers and writers: schema tables, the table warehouse, snapshots."""

"""Readers and writers: logs, records, keyed chunks, wide tables and buckets."""

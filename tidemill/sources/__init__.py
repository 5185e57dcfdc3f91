"""Readers and writers: the event lake, envelopes, feature tables, key-value stores."""

from .lake import EventLake, catalog_rows, profile_rows, read_offline, write_events
from .registry import NotRetryable, SchemaRegistry
from .stores import TableStore, write_dead_letters, write_offline, write_online, write_training_set

__all__ = ["EventLake", "NotRetryable", "SchemaRegistry", "TableStore", "catalog_rows", "profile_rows", "read_offline", "write_dead_letters", "write_events", "write_offline", "write_online", "write_training_set"]

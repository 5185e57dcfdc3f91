"""Structured Streaming: parsing, splitting, deduplication, windowed features, online upserts."""

from .features import archive, deduplicate, parse_events, sessions, split_events, start, tumbling, upsert_online
from .monitor import Progress, console, with_retry
from .routing import payloads, process

__all__ = ["Progress", "archive", "console", "deduplicate", "parse_events", "payloads", "process", "sessions", "split_events", "start", "tumbling", "upsert_online", "with_retry"]

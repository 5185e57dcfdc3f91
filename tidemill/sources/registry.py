"""A client for a registry of schemas by subject and version. The transport is a function, so any HTTP library will do."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any, TypeVar

from pyspark.sql import Column

from .envelope import frame

R = TypeVar("R")
Transport = Callable[[str, str, dict[str, Any] | None], dict[str, Any] | None]


class NotRetryable(Exception):
    """A fault that another attempt cannot mend."""


def retried(action: Callable[[], R], attempts: int = 3, low: float = 4.0, high: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> R:
    """action(), up to `attempts` times, with waits that double from 1 s within [low, high]. NotRetryable is raised at once."""
    for n in range(attempts):
        try:
            return action()
        except NotRetryable:
            raise
        except Exception:
            if n + 1 == attempts:
                raise
            sleep(min(max(2.0**n, low), high))
    raise ValueError("attempts must be positive")


@dataclass(frozen=True)
class Schema:
    id: int
    version: int
    kind: str
    subject: str
    text: str


class SchemaRegistry:
    """call(method, path, body) gives the answer's JSON object, or None where there is no such thing."""

    def __init__(self, call: Transport, sleep: Callable[[float], None] = time.sleep) -> None:
        self._call, self._sleep = call, sleep
        self._by_id: dict[int, Schema] = {}
        self._latest: dict[str, Schema] = {}

    def _ask(self, method: str, path: str, body: dict[str, Any] | None = None) -> dict[str, Any] | None:
        return retried(lambda: self._call(method, path, body), low=2.0, sleep=self._sleep)

    @staticmethod
    def _schema(said: dict[str, Any], **known: Any) -> Schema:
        found = {"id": said.get("id", 0), "version": said.get("version", 0), "kind": said.get("schemaType", "PROTOBUF"), "subject": said.get("subject", ""), "text": said.get("schema", "")}
        return Schema(**(found | known))

    def by_id(self, schema_id: int) -> Schema | None:
        """Cached for good: an id never changes its schema."""
        if schema_id not in self._by_id and (said := self._ask("GET", f"/schemas/ids/{schema_id}")) is not None:
            self._by_id[schema_id] = self._schema(said, id=schema_id)
        return self._by_id.get(schema_id)

    def latest(self, subject: str) -> Schema | None:
        """Always asked for, as it may have moved on."""
        said = self._ask("GET", f"/subjects/{subject}/versions/latest")
        return None if said is None else self._schema(said, subject=subject)

    def register(self, subject: str, text: str, kind: str = "PROTOBUF") -> int | None:
        said = self._ask("POST", f"/subjects/{subject}/versions", {"schemaType": kind, "schema": text})
        self._latest.pop(subject, None)
        return None if said is None else said.get("id")

    def encode(self, subject: str, payload: Column) -> Column:
        """payload framed with the id of the subject's latest schema, which is asked for once."""
        if subject not in self._latest:
            found = self.latest(subject)
            if found is None:
                raise ValueError(f"no schema for subject {subject}")
            self._latest[subject] = found
        return frame(self._latest[subject].id, payload)


def local_transport() -> Transport:
    """A registry in memory, for tests and single jobs."""
    subjects: dict[str, list[dict[str, Any]]] = {}
    every: list[dict[str, Any]] = []

    def call(method: str, path: str, body: dict[str, Any] | None) -> dict[str, Any] | None:
        parts = path.strip("/").split("/")
        if parts[0] == "schemas":
            n = int(parts[2])
            return every[n - 1] if 0 < n <= len(every) else None
        versions = subjects.setdefault(parts[1], [])
        if method == "POST":
            same = [v for v in versions if v["schema"] == body["schema"]]
            if not same:
                versions.append({"id": len(every) + 1, "version": len(versions) + 1, "subject": parts[1], **body})
                every.append(versions[-1])
            return (same or versions)[-1]
        return versions[-1] if versions else None

    return call

"""What a running stream tells: lag by partition, idle time; batches that are tried again and then set aside."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.registry import NotRetryable, retried

Write = Callable[[DataFrame, int], None]


def lag(sources: list[dict]) -> dict[tuple[str, str], int]:
    """Messages behind the newest one, by topic and partition, from the sources of a progress report. A partition not yet read counts whole."""
    out: dict[tuple[str, str], int] = {}
    for s in sources:
        newest, done = (json.loads(s[k]) if isinstance(s.get(k), str) else s.get(k) for k in ("latestOffset", "endOffset"))
        if not isinstance(newest, dict):
            continue
        for topic, parts in newest.items():
            if isinstance(parts, dict):  # topic: {partition: offset}, as Kafka's source reports
                for p, high in parts.items():
                    out[topic, p] = max(0, high - ((done or {}).get(topic) or {}).get(p, 0))
    return out


class Progress(StreamingQueryListener):
    """Keeps the last report of every query; add it by spark.streams.addListener."""

    def __init__(self, clock: Callable[[], float] = time.monotonic) -> None:
        self.clock = clock
        self.rows: dict[str, int] = {}
        self.lags: dict[str, dict[tuple[str, str], int]] = {}
        self.ended: dict[str, str | None] = {}
        self._active: dict[str, float] = {}

    def onQueryStarted(self, event) -> None:
        self._active[str(event.id)] = self.clock()

    def onQueryProgress(self, event) -> None:
        said = json.loads(event.progress.json)
        key = str(said["id"])
        new = sum(s.get("numInputRows", 0) for s in said.get("sources", []))
        self.rows[key] = self.rows.get(key, 0) + new
        self.lags[key] = lag(said.get("sources", []))
        if new:
            self._active[key] = self.clock()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception

    def idle_seconds(self) -> dict[str, float]:
        """Since the last rows (or the start) of each running query."""
        return {k: self.clock() - t for k, t in self._active.items() if k not in self.ended}


def with_retry(write: Write, dead: Callable[[DataFrame, int, str], None], attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Write:
    """A foreachBatch function that tries write again, then gives the batch and the reason to dead, and goes on.

    write must be idempotent for a batch id. NotRetryable goes to dead at once. What dead raises stops the stream, so no batch is lost.
    """

    def guarded(batch: DataFrame, batch_id: int) -> None:
        try:
            retried(lambda: write(batch, batch_id), attempts, sleep=sleep)
        except NotRetryable as e:
            dead(batch, batch_id, str(e))
        except Exception as e:
            dead(batch, batch_id, f"retryable error: {e}")

    return guarded


def console(features: DataFrame, checkpoint: str | None = None, once: bool = False):
    """The rows of each batch on the driver's console."""
    writer = features.writeStream.format("console").outputMode("update").option("truncate", False)
    writer = writer.option("checkpointLocation", checkpoint) if checkpoint else writer
    return (writer.trigger(availableNow=True) if once else writer).start()

"""Connectors as Spark data sources: a registry, retries, and a reader partitioned by frame."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PermanentError(Exception):
    """No retry helps: missing keys, refused requests, malformed payloads."""


class RetryableError(Exception):
    def __init__(self, message: str, retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


def classify(status: int, message: str, retry_after: float | None = None, cap: float = 120.0) -> Exception:
    """429 and server errors pass; a wait beyond the cap doesn't."""
    if (status == 429 or status >= 500) and not (retry_after and retry_after > cap):
        return RetryableError(message, retry_after)
    return PermanentError(message)


def retry(call: Callable, attempts: int = 4, base: float = 1.0, cap: float = 120.0, sleep=time.sleep):
    """Exponential waits with jitter; the server's hint wins."""
    for k in range(attempts):
        try:
            return call()
        except RetryableError as e:
            if k == attempts - 1:
                raise
            sleep(min(cap, e.retry_after if e.retry_after is not None else base * 2**k * (0.5 + random.random())))


REGISTRY: dict[str, Callable[[str, str], Iterator[dict]]] = {}


def register(name: str):
    """Registers a generator of payloads: (frame, query) -> dicts, a page each."""

    def add(f):
        REGISTRY[name] = f
        return f

    return add


def registered() -> list[str]:
    return sorted(REGISTRY)


class _Frame(InputPartition):
    def __init__(self, source: str, frame: str, query: str):
        self.source, self.frame, self.query = source, frame, query


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.frames = json.loads(options["frames"])
        self.fetch = REGISTRY if "module" not in options else None
        self.module = options.get("module")

    def partitions(self):
        return [_Frame(x["source"], x["frame"], x["query"]) for x in self.frames]

    def read(self, partition):
        """Pages as they come; a failure ends the frame with a row that says so, so that earlier pages stay."""
        if self.module:
            __import__(self.module)
        n = 0
        try:
            for n, payload in enumerate(retry(lambda: REGISTRY[partition.source])(partition.frame, partition.query), 1):
                yield partition.source, partition.frame, n - 1, json.dumps(payload), "success"
        except Exception as e:  # noqa: BLE001  the incident is the result
            yield partition.source, partition.frame, n, str(e)[:1000], "partial" if n else "skipped" if isinstance(e, PermanentError) else "failed"


class Payloads(DataSource):
    """spark.read.format("payloads").option("frames", json).load()"""

    @classmethod
    def name(cls) -> str:
        return "payloads"

    def schema(self) -> str:
        return "source string, frame string, page int, body string, status string"

    def reader(self, schema):
        return _Reader(dict(self.options))


def install(spark: SparkSession) -> None:
    spark.dataSource.register(Payloads)

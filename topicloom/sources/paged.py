"""Paged connectors as a stream: the offset is where each frame's pages go on.

    spark.readStream.format("pages").option("module", "my.sources").option("frames", json).load()

A frame (source, frame, query) is read page by page with the source's fetcher, (query, token) -> (payload, next token): the
token is a cursor, an offset or a key, None for the first page and, as next token, for none after it. A micro-batch takes one page of
each frame that has any left, so a batch is bounded by the pages' size; the tokens go into the checkpoint, and a stream
that is started again goes on from there: no page is lost, and a batch that was planned and not finished is
fetched between the same tokens again. A frame that fails for good ends with a row that says so and keeps no other from going on; one that
fails for now keeps its token for the next batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from topicloom.sources.connectors import PermanentError, RetryableError, retry

FETCHERS: dict[str, Callable] = {}
END = "\0end"


def fetcher(source: str):
    """Registers (query, token) -> (payload, next token) as a source's."""

    def add(f):
        FETCHERS[source] = f
        return f

    return add


class _Pages(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.frames, self.module = json.loads(options["frames"]), options.get("module")
        self.attempts, self.wait = int(options.get("attempts", 4)), float(options.get("wait", 1.0))

    def initialOffset(self) -> dict:
        return {x["frame"]: "" for x in self.frames}

    def page(self, frame: dict, token: str) -> tuple[tuple, str]:
        """The row of a page and the token after it."""
        if self.module:
            __import__(self.module)
        try:
            payload, after = retry(lambda: FETCHERS[frame["source"]](frame["query"], token or None), self.attempts, self.wait)
            return (frame["source"], frame["frame"], token, json.dumps(payload), "success"), END if after is None else str(after)
        except RetryableError as e:
            return (frame["source"], frame["frame"], token, str(e)[:1000], "failed"), token
        except PermanentError as e:
            return (frame["source"], frame["frame"], token, str(e)[:1000], "skipped"), END

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, after = [], dict(start)
        for frame in self.frames:
            token = start.get(frame["frame"], "")
            if token != END:
                row, after[frame["frame"]] = self.page(frame, token)
                if row[-1] != "failed":  # a page that may come later is no news
                    rows.append(row)
        return iter(rows), after

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for frame in self.frames:
            token = start.get(frame["frame"], "")
            while token != end.get(frame["frame"], ""):
                row, after = self.page(frame, token)
                if after == token:
                    raise RetryableError(row[3])  # the batch was planned with this page
                yield row
                token = after


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "source string, frame string, token string, body string, status string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Pages(dict(self.options))


def install(spark: SparkSession) -> None:
    spark.dataSource.register(Pages)

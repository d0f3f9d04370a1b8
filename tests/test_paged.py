"""Paged sources as a stream: stopped between pages, closed for a while, broken."""

import json

import pytest

from topicloom.sources import paged


@pytest.fixture()
def stream(spark, tmp_path):
    paged.install(spark)
    out, marks, calls = str(tmp_path / "out"), str(tmp_path / "marks"), tmp_path / "calls"
    calls.mkdir()
    frames = [{"source": "cursor", "frame": "a", "query": f"{calls}|6|3"}, {"source": "offset", "frame": "b", "query": "25"}, {"source": "broken", "frame": "c", "query": ""}]

    def run():
        """As far as there is anything."""
        rows = spark.readStream.format("pages").option("module", "tests.paged_fake").option("frames", json.dumps(frames)).option("attempts", "1").load()
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted((r.frame, r.token, r.status, r.body) for r in spark.read.parquet(out).collect())

    return run, calls


def test_a_stream_goes_on_where_it_stopped(stream):
    run, calls = stream
    (calls / "closed").write_text("")
    first = run()
    assert [r for r in first if r[0] == "a"] == [("a", t, "success", json.dumps({"page": k})) for k, t in enumerate(["", "c1", "c2"])]
    assert [json.loads(r[3])["items"] for r in first if r[0] == "b"] == [list(range(10)), list(range(10, 20)), list(range(20, 25))]
    assert [r[2:] for r in first if r[0] == "c"] == [("skipped", "no key")]
    (calls / "closed").unlink()
    second = run()
    assert [json.loads(r[3])["page"] for r in second if r[0] == "a"] == list(range(6))
    assert [r for r in second if r[0] != "a"] == [r for r in first if r[0] != "a"] and run() == second


def test_a_planned_batch_is_fetched_again():
    import tests.paged_fake  # noqa: F401

    reader = paged._Pages({"frames": json.dumps([{"source": "offset", "frame": "b", "query": "25"}]), "attempts": "1"})
    at, seen = reader.initialOffset(), []
    for _ in range(5):
        rows, after = reader.read(at)
        rows = list(rows)
        assert list(reader.readBetweenOffsets(at, after)) == rows
        at, seen = after, seen + rows
    assert len(seen) == 3 and at == {"b": paged.END}

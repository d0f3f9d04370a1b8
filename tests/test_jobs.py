"""The jobs: over growing input, after a failure, and against SQL."""

import json
import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_catalog import con, rows  # noqa: F401

from jobs import common, corpus_feed, queries, watchlist

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_matches_sql(name, spark, data, con):  # noqa: F811
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.shuffle.partitions")}
    got, want = queries.QUERIES[name](spark, data).toPandas(), con.sql(queries.ORACLES[name]).df()
    assert set(got.columns) == set(want.columns) and rows(got) == rows(want)
    assert before == {k: spark.conf.get(k, None) for k in before}


def drop(spark, folder, number, texts):
    """A file of documents (doc_id, text, lang) as it would arrive."""
    df = spark.createDataFrame([(i, t, lang, "src", "clash") for i, t, lang in texts], "doc_id long, text string, lang string, source string, batch string")
    df.coalesce(1).write.parquet(f"{folder}-{number}")
    Path(folder).mkdir(exist_ok=True)
    (part,) = Path(f"{folder}-{number}").glob("part-*.parquet")
    shutil.copy(part, f"{folder}/{number}.parquet")


def vocabulary(spark, out):
    return {(r.lang, r.term): (r.docs, r.uses) for r in corpus_feed.latest(spark, out).collect()}


FIRST = [(1, "solar storage solar", "en"), (2, "wind farms", "en"), (3, "solar  storage solar", "en"), (4, " ", "en"), (5, None, "en"), (6, "vent solaire", "fr"), (None, "lost", "en"), (7, "no language", None)]
SECOND = [(8, "wind farms", "en"), (9, "solar roofs", "en"), (10, "wind farms", "fr")]


def test_feed_takes_only_what_is_new(spark, tmp_path):
    files, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    drop(spark, files, 1, FIRST)
    assert corpus_feed.run(spark, files, out, marks) == 1
    first = vocabulary(spark, out)
    assert first == {("en", "solar"): (1, 2), ("en", "storage"): (1, 1), ("en", "wind"): (1, 1), ("en", "farm"): (1, 1), ("fr", "vent"): (1, 1), ("fr", "solaire"): (1, 1)}
    assert corpus_feed.run(spark, files, out, marks) == 0 and vocabulary(spark, out) == first
    drop(spark, files, 2, SECOND)
    assert corpus_feed.run(spark, files, out, marks) == 1
    second = vocabulary(spark, out)
    assert second[("en", "solar")] == (2, 3) and second[("en", "wind")] == (1, 1) and second[("fr", "wind")] == (1, 1)
    lines = {r.batch: (r.read, r.kept, r.unusable, r.repeated) for r in spark.read.parquet(f"{out}/log").collect()}
    assert lines == {0: (8, 3, 4, 1), 1: (3, 2, 0, 1)}
    kept = {r.doc_id: r.batch for r in spark.read.parquet(f"{out}/corpus").collect()}
    assert kept == {1: 0, 2: 0, 6: 0, 9: 1, 10: 1}


def test_feed_counts_terms_in_one_aggregate(spark, tmp_path, monkeypatch):
    """Terms are combined by language before they are dealt out: no exchange is keyed by the document."""
    files, plans = str(tmp_path / "in"), {}
    written = corpus_feed.written
    monkeypatch.setattr(corpus_feed, "written", lambda df, path, *by: (plans.setdefault(path.rpartition("/")[2], df._jdf.queryExecution().executedPlan().toString()), written(df, path, *by)))
    drop(spark, files, 1, [(1, "solar wind solar wind solar", "en"), (2, "wind", "en")])
    corpus_feed.run(spark, files, str(tmp_path / "out"), str(tmp_path / "marks"))
    assert "content_hash" not in plans["increments"] and plans["increments"].count("Exchange hashpartitioning") == 1
    assert vocabulary(spark, str(tmp_path / "out")) == {("en", "solar"): (1, 3), ("en", "wind"): (2, 3)}


def test_feed_in_many_batches_has_the_same_vocabulary(spark, tmp_path):
    files, whole = str(tmp_path / "in"), Counter()
    for k in range(5):
        drop(spark, files, k, [(10 * k + i, f"term{(k + i) % 7}x word{i}x word{i}x", "en") for i in range(4)])
    one = corpus_feed.run(spark, files, str(tmp_path / "a"), str(tmp_path / "am"))
    many = corpus_feed.run(spark, files, str(tmp_path / "b"), str(tmp_path / "bm"), corpus_feed.Settings(files_per_batch=1))
    assert (one, many) == (1, 5)
    assert vocabulary(spark, str(tmp_path / "a")) == vocabulary(spark, str(tmp_path / "b")) != whole


def test_feed_survives_a_death_within_a_batch(spark, tmp_path, monkeypatch):
    files, out, marks = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "marks")
    drop(spark, files, 1, FIRST)
    corpus_feed.run(spark, files, out, marks)
    drop(spark, files, 2, SECOND)
    true, calls = corpus_feed.written, []

    def dies(df, path, *by):
        true(df, path, *by)
        calls.append(path)
        if path.endswith("increments"):
            raise RuntimeError("lost")

    monkeypatch.setattr(corpus_feed, "written", dies)
    with pytest.raises(Exception, match="lost"):
        corpus_feed.run(spark, files, out, marks)
    assert len(calls) == 2
    monkeypatch.setattr(corpus_feed, "written", true)
    assert corpus_feed.run(spark, files, out, marks) == 1
    clean = str(tmp_path / "clean")
    corpus_feed.run(spark, files, clean, str(tmp_path / "clean-marks"), corpus_feed.Settings(files_per_batch=1))
    assert vocabulary(spark, out) == vocabulary(spark, clean)
    assert spark.read.parquet(f"{out}/corpus").count() == spark.read.parquet(f"{clean}/corpus").count()


def test_feed_of_an_empty_table(spark, tmp_path):
    files = str(tmp_path / "in")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(files)
    corpus_feed.run(spark, files, str(tmp_path / "out"), str(tmp_path / "marks"))
    assert not common.exists(spark, str(tmp_path / "out/vocabulary")) or corpus_feed.latest(spark, str(tmp_path / "out")).count() == 0


def test_watchlist_runs_leave_each_other_alone(spark, data, tmp_path):
    out, at = str(tmp_path / "out"), lambda t: f"{data}/{t}.parquet"
    run = lambda name, **more: watchlist.run(spark, at("lineitem"), at("part"), at("supplier"), out, name, watchlist.Settings(**more))
    first = sorted(run("a").collect())
    second = sorted(run("b", weights={"share": 1.0}, shortlist=3).collect())
    assert sorted(run("a").collect()) == first != second
    both = spark.read.parquet(f"{out}/topics")
    assert {r.run_id: r["count"] for r in both.groupBy("run_id").count().collect()} == {"a": len(first), "b": len(second)}
    short = spark.read.option("header", "true").csv(f"{out}/shortlist")
    assert short.where("run_id = 'b'").count() == 3 and short.where("run_id = 'a'").count() == 25
    shares = [r.share for r in both.where("run_id = 'b'").orderBy("rank").collect()]
    assert shares == sorted(shares, reverse=True)
    assert spark.read.json(f"{out}/summary").where("run_id = 'a'").agg(F.sum("topics")).first()[0] == len(first)


def test_watchlist_joins_its_tables_once(spark, data, tmp_path, monkeypatch):
    """The attributes read the joined rows back; none joins the line items again."""
    seen, ranked = [], watchlist.ranked
    monkeypatch.setattr(watchlist, "ranked", lambda rows, chosen: (seen.append(rows._jdf.queryExecution().optimizedPlan().toString()), ranked(rows, chosen))[1])
    watchlist.run(spark, *[f"{data}/{t}.parquet" for t in ("lineitem", "part", "supplier")], str(tmp_path / "out"), "one")
    (plan,) = seen
    assert "l_shipdate" not in plan and "s_nationkey" not in plan


def test_watchlist_of_rows_with_nulls(spark, tmp_path):
    lines = spark.createDataFrame([(1, 1, None, None, None), (1, None, "A", 5.0, "1995-01-01"), (2, 9, "A", 5.0, "1996-01-01"), (3, 1, "A", 5.0, None)], "l_partkey long, l_suppkey long, l_returnflag string, l_extendedprice double, l_shipdate string")
    lines = lines.withColumn("l_shipdate", F.to_timestamp("l_shipdate")).withColumn("rank", F.lit("clash"))
    lines.write.parquet(str(tmp_path / "l"))
    spark.createDataFrame([(1,), (2,), (3,), (None,)], "p_partkey long").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([(1, 4)], "s_suppkey long, s_nationkey int").write.parquet(str(tmp_path / "s"))
    found = watchlist.run(spark, *(str(tmp_path / x) for x in "lps"), str(tmp_path / "out"), "r")
    assert {(r.topic, r.documents, r.uncertainty) for r in found.collect()} == {(1, 1, 0.0), (2, 1, 0.0)}


def test_settings_come_from_a_file(spark, tmp_path):
    assert common.settings(spark, corpus_feed.Settings, str(ROOT / "jobs/corpus_feed.json")) == corpus_feed.Settings(languages=[])
    assert common.settings(spark, watchlist.Settings, str(ROOT / "jobs/watchlist.json")) == watchlist.Settings()
    (tmp_path / "bad.json").write_text(json.dumps({"nothing": 1}))
    with pytest.raises(ValueError, match="nothing"):
        common.settings(spark, corpus_feed.Settings, str(tmp_path / "bad.json"))


def test_command_line(data, tmp_path):
    done = subprocess.run([sys.executable, "-m", "jobs.corpus_feed", f"{data}/documents.parquet", str(tmp_path / "out"), str(tmp_path / "marks"), "--config", str(ROOT / "jobs/corpus_feed.json")], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "1 batches" in done.stderr and list((tmp_path / "out/vocabulary").glob("upto=0/lang=en/*.parquet"))

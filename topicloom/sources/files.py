"""Local inputs and outputs: reference YAML, query frames, text corpora, raw payloads, reports."""

from __future__ import annotations

import html
import json
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.functions import text

#: Sections of the reference files and the type that their entries have.
REF_TYPES = {"objectives": "objective", "initiatives": "initiative", "technologies": "critical_tech", "assets": "asset"}
REF_SCHEMA = "ref_id string, ref_type string, code string, label string, text string, lexicon array<string>, weight double"


def references(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of all entries: text is the label and its prose, lexicons are lower case."""
    import yaml

    rows = []
    for path in paths:
        with open(path, encoding="utf-8") as f:
            content = yaml.safe_load(f) or {}
        for section, kind in REF_TYPES.items():
            for entry in content.get(section) or []:
                code, label = str(entry.get("code") or ""), str(entry.get("label") or "")
                rows.append((f"{kind}:{code}", kind, code, label, f"{label}. {entry.get('text') or ''}", [str(x).lower() for x in entry.get("lexicon") or []], float(entry.get("weight", entry.get("strength", 1.0)))))
    return spark.createDataFrame(rows, REF_SCHEMA).withColumn("text", text.collapse(F.col("text")))


def faults(refs: DataFrame, needed: tuple[str, ...] = ("objective", "asset")) -> DataFrame:
    """(ref_id, fault): repeated ids, short texts, empty lexicons; missing types under their own name."""
    repeated = refs.groupBy("ref_id").count().where("count > 1").select("ref_id", F.lit("repeated").alias("fault"))
    short = refs.where(F.length("text") < 40).select("ref_id", F.lit("short text").alias("fault"))
    empty = refs.where((F.size("lexicon") == 0) & (F.col("ref_type") != "asset")).select("ref_id", F.lit("no lexicon").alias("fault"))
    types = refs.sparkSession.createDataFrame([(t,) for t in needed], "ref_type string").join(refs, "ref_type", "left_anti").select(F.col("ref_type").alias("ref_id"), F.lit("type missing").alias("fault"))
    return repeated.union(short).union(empty).union(types)


def frames(spark: SparkSession, path: str) -> DataFrame:
    import yaml

    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f)["frames"]
    keys = [x["key"] for x in found]
    if len(set(keys)) < len(keys):
        raise ValueError("frame keys repeat")
    return spark.createDataFrame([(x["key"], x.get("label"), x.get("steepv"), x.get("rationale"), {k: str(v) for k, v in (x.get("queries") or {}).items()}) for x in found], "key string, label string, steepv string, rationale string, queries map<string,string>")


def corpus(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, text) of the text files that exist, lower case."""
    there = [p for p in paths if os.path.exists(p)]
    if not there:
        return spark.createDataFrame([], "path string, text string")
    return spark.read.text(there, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.lower("value").alias("text"))


def save_raw(folder: str, run_id: str, source: str, frame: str, page: int, payload) -> str:
    """One payload as JSON under a name that any file system takes."""
    name = re.sub(r"[^A-Za-z0-9_-]+", "_", f"{frame}-{page}")
    path = os.path.join(folder, run_id, source, f"{name}.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(payload, f)
    return path


def topics_csv(ranked: DataFrame, columns: list[str]) -> DataFrame:
    """The fixed columns as text; lists are joined by semicolons."""
    kinds = dict(ranked.dtypes)
    return ranked.select(*[F.array_join(c, ";").alias(c) if kinds.get(c, "").startswith("array") else F.col(c) if c in kinds else F.lit(None).cast("string").alias(c) for c in columns])


def shortlist_markdown(ranked: DataFrame, size: int) -> str:
    lines = ["| rank | topic | score |", "|---|---|---|"]
    for r in ranked.orderBy("rank").limit(size).collect():
        lines.append(f"| {r['rank']} | {r['topic']} | {r['composite']:.3f} |")
    return "\n".join(lines)


def page(ranked: DataFrame, size: int, title: str) -> str:
    """A static page; the data travel as JSON that cannot close its script element."""
    rows = [r.asDict(recursive=True) for r in ranked.orderBy("rank").limit(size).collect()]
    data = json.dumps(rows, default=str).replace("</", "<\\/")
    body = "".join(f"<tr><td>{r['rank']}</td><td>{html.escape(str(r['topic']))}</td></tr>" for r in rows)
    return f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><table>{body}</table><script type=application/json id=data>{data}</script>"

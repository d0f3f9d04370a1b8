"""Documents that arrive as files become a corpus without repeated texts and the vocabulary of each language.

    python -m jobs.corpus_feed DOCUMENTS OUT CHECKPOINT [--config jobs/corpus_feed.json]

A file stream takes the files of DOCUMENTS that the checkpoint does not know and ends when there are no more. Each batch
is cleaned, keeps the first document of each text that no earlier batch has, and is written to the batch's own partitions:

    OUT/corpus      batch, lang    doc_id, source, body, content_hash, terms
    OUT/increments  batch          lang, term, docs, uses: what the batch adds to the vocabulary
    OUT/log         batch          how many rows were read, kept, blank, repeated
    OUT/vocabulary  upto, lang     term, docs, uses, idf: the sums of the increments up to a batch

A batch that is delivered again (the job died after its writes and before the checkpoint's) overwrites its own partitions with the
same rows, for only batches before it count as known. A run without new files changes nothing. The vocabulary comes
from the increments, never from texts that were read before; a reader takes the greatest `upto`, which is written whole
before the log names it.

Rows whose doc_id, text or language is null, or whose text is blank, are logged and left out. Of equal texts of a language
the smallest doc_id of the first batch stays. Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import command, exists, log, settings
from topicloom.functions import text
from topicloom.operators.tables import insert_or_ignore


@dataclass
class Settings:
    """files_per_batch: files of a micro-batch; languages: those that are kept (none: all); min_docs: documents that a term needs to enter the vocabulary."""

    files_per_batch: int = 64
    languages: tuple[str, ...] = ()
    min_docs: int = 1


CORPUS = "doc_id long, source string, body string, content_hash string, terms array<string>, batch long, lang string"
INCREMENTS = "lang string, term string, docs long, uses long, batch long"
LOG = "read long, kept long, unusable long, repeated long, batch long"
VOCABULARY = "term string, docs long, uses long, idf double, upto long, lang string"


def cleaned(rows: DataFrame, languages: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, lang, body, content_hash, usable)."""
    body = text.collapse(F.coalesce(F.col("text"), F.lit("")))
    usable = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (body != "")
    if languages:
        usable = usable & F.col("lang").isin(*languages)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", body.alias("body"), usable.alias("usable"))
    return rows.withColumn("content_hash", text.content_hash(F.coalesce("lang", F.lit("")), F.col("body")))


def written(df: DataFrame, path: str, *by: str) -> None:
    """Replaces the partitions that df has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def land(batch: DataFrame, number: int, out: str, chosen: Settings) -> None:
    """One batch into its partitions."""
    spark = batch.sparkSession
    rows = cleaned(batch, chosen.languages)
    known = spark.createDataFrame([], "content_hash string")
    if exists(spark, f"{out}/corpus"):
        known = spark.read.schema(CORPUS).parquet(f"{out}/corpus").where(F.col("batch") < number).select("content_hash")
    new = insert_or_ignore(known, rows.where("usable").drop("usable"), ["content_hash"], "doc_id")
    new = new.withColumn("terms", text.tokens(F.col("body"))).withColumn("batch", F.lit(number).cast("long"))
    written(new, f"{out}/corpus", "batch", "lang")
    landed = spark.read.schema(CORPUS).parquet(f"{out}/corpus").where(F.col("batch") == number) if exists(spark, f"{out}/corpus") else spark.createDataFrame([], CORPUS)
    # a document's first of equal terms counts it, so that one aggregate, combined before the shuffle, gives both sums
    marked = lambda s: F.transform(s, lambda w, i: F.struct(w.alias("term"), ((i == 0) | (F.get(s, F.greatest(i - 1, F.lit(0))) != w)).cast("long").alias("first")))
    uses = landed.select("batch", "lang", F.inline(F.flatten(F.transform(F.array(F.sort_array("terms")), marked))))
    terms = uses.groupBy("batch", "lang", "term").agg(F.sum("first").alias("docs"), F.count(F.lit(1)).alias("uses"))
    written(terms, f"{out}/increments", "batch")
    counts = rows.agg(F.count(F.lit(1)).alias("read"), F.count_if(~F.col("usable")).alias("unusable")).join(landed.agg(F.count(F.lit(1)).alias("kept")))
    line = counts.select("read", "kept", "unusable", (F.col("read") - F.col("unusable") - F.col("kept")).alias("repeated"), F.lit(number).cast("long").alias("batch"))
    written(line, f"{out}/log", "batch")
    log.info("batch %d: %s", number, line.first().asDict())


def vocabulary(spark: SparkSession, out: str, min_docs: int) -> DataFrame:
    """(upto, lang, term, docs, uses, idf) of all batches so far."""
    upto = spark.read.schema(LOG).parquet(f"{out}/log").agg(F.max("batch").cast("long").alias("upto"))
    docs = spark.read.schema(CORPUS).parquet(f"{out}/corpus").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sums = spark.read.schema(INCREMENTS).parquet(f"{out}/increments").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("uses").alias("uses")).where(F.col("docs") >= min_docs)
    idf = F.log((1.0 + F.col("n")) / (1.0 + F.col("docs"))) + 1  # smoothed, as the vectors' weights have it
    return sums.join(docs, "lang").join(F.broadcast(upto)).select("upto", "lang", "term", "docs", "uses", F.round(idf, 6).alias("idf"))


def folder_of(spark: SparkSession, path: str) -> tuple[str, str]:
    """The folder to watch and the names to take there: a path may also be that of a single file."""
    path = path.rstrip("/")
    first = spark.read.format("binaryFile").load(path).select("path").first()
    if first and first.path.endswith(path.split(":", 1)[-1]):
        folder, _, name = path.rpartition("/")
        return folder, name
    return path, "*"


def run(spark: SparkSession, documents: str, out: str, checkpoint: str, chosen: Settings | None = None) -> int:
    """Takes what is new in the folder of files (or the single file) DOCUMENTS; the number of batches that this run had."""
    chosen = chosen or Settings()
    schema = spark.read.parquet(documents).schema
    batches: list[int] = []

    def take(batch: DataFrame, number: int) -> None:
        land(batch, number, out, chosen)
        batches.append(number)

    folder, names = folder_of(spark, documents)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(chosen.files_per_batch)).option("pathGlobFilter", names).parquet(folder)
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    if exists(spark, f"{out}/increments"):
        # also without a new batch: the run before may have ended between its last batch and this
        written(vocabulary(spark, out, chosen.min_docs), f"{out}/vocabulary", "upto", "lang")
    log.info("%s: %d batches from %s", out, len(batches), documents)
    return len(batches)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """(lang, term, docs, uses, idf) of the last batch's vocabulary."""
    rows = spark.read.schema(VOCABULARY).parquet(f"{out}/vocabulary")
    last = rows.agg(F.max("upto").alias("last"))
    return rows.join(F.broadcast(last), F.col("upto") == F.col("last")).select("lang", "term", "docs", "uses", "idf")


if __name__ == "__main__":
    command("corpus_feed", "New documents into a corpus and its vocabulary", {"documents": "folder of Parquet files", "out": "folder of the tables", "checkpoint": "folder of the stream's progress"}, lambda spark, a: run(spark, a.documents, a.out, a.checkpoint, settings(spark, Settings, a.config)))

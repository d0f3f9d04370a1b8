"""The language model's query keeps n-grams that were seen once."""

from topicloom.llm import ngram, queries


def test_query_keeps_singletons(spark, frame, tmp_path):
    texts = [f"alpha{i % 7} beta{i % 5} gamma{i % 3} once{i} upon{i % 9} a time" for i in range(60)]
    frame(texts).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in queries.op2_ngram(spark, str(tmp_path)).collect()}
    by_count = [{r.doc_id: r.score for r in ngram.train_and_score(docs.withColumn("learn", ~queries.unseen(docs["doc_id"])), "learn", min_count=k)[1].collect()} for k in (1, 2)]
    assert got == by_count[0] and sum(got.values()) > sum(by_count[1].values())

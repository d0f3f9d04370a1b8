"""Operators that need packages beyond Spark: they run where these are installed and say so where they are not."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _need(*names: str) -> None:
    missing = []
    for name in names:
        try:
            __import__(name)
        except ImportError:
            missing.append(name)
    if missing:
        raise ImportError(f"this operator needs {', '.join(missing)}; choose hashed vectors and average linkage instead, there is no silent substitute")


def transformer_vectors(docs: DataFrame, id_: str, body: str, model: str) -> DataFrame:
    """(id, vector) by a sentence transformer: one model a worker, batches through Arrow."""
    _need("sentence_transformers")

    @F.pandas_udf("array<double>")
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from sentence_transformers import SentenceTransformer

        encoder = SentenceTransformer(model)
        for part in parts:
            yield pd.Series(list(encoder.encode(part.tolist(), normalize_embeddings=True).astype(float)))

    return docs.select(id_, embed(body).alias("vector"))


def density_topics(rows: DataFrame, id_: str, vector: str, min_size: int, neighbours: int = 15, seed: int = 42) -> DataFrame:
    """(id, topic) by UMAP and HDBSCAN over a bounded corpus; outliers are left out."""
    _need("umap", "hdbscan")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        import hdbscan
        import numpy as np
        import umap

        part = part.sort_values(id_, ignore_index=True)
        flat = umap.UMAP(n_neighbors=neighbours, n_components=5, min_dist=0.0, metric="cosine", random_state=seed).fit_transform(np.stack(part[vector].map(np.asarray)))
        part["topic"] = hdbscan.HDBSCAN(min_cluster_size=min_size, cluster_selection_method="eom").fit_predict(flat)
        return part.loc[part["topic"] >= 0, [id_, "topic"]]

    kind = rows.schema[id_].dataType.simpleString()
    return rows.select(id_, vector).groupBy(F.lit(1)).applyInPandas(run, f"{id_} {kind}, topic long")

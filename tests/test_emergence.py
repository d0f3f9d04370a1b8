"""A whole run over a small corpus of two themes."""

from topicloom.plans import emergence

THEMES = ["quantum error correction with superconducting qubits and surface codes", "battery cathode chemistry for lithium storage in electric vehicles"]


def corpus(spark):
    rows = []
    for i in range(24):
        theme = THEMES[i % 2]
        rows.append((f"d{i:02d}", "works" if i < 20 else "news", theme, f"{theme} experiment", str(2017 + i % 6), i))
    return spark.createDataFrame(rows, "doc_id string, source string, title string, abstract string, time_slice string, citation_count int")


def test_run(spark):
    settings = emergence.Settings(dim=256, threshold=0.3, forming=("works",))
    docs = corpus(spark)
    members, dense = emergence.topic_model(docs, settings)
    found = members.toPandas()
    assert sorted(found.topic_id.unique()) == ["T0000", "T0001"]
    assert found.forming.sum() == 20 and (~found.forming).sum() == 4
    assert found.assign(odd=found.doc_id.str[1:].astype(int) % 2).groupby("topic_id").odd.nunique().tolist() == [1, 1]
    rows = emergence.attributes(docs, members, dense, settings)
    refs = [("r0", "objective", "secure links", 1.0, "quantum error correction", ["quantum", "surface code"]), ("r1", "objective", "clean power", 0.5, "battery storage in vehicles", ["lithium", "missing word"]), ("r2", "capability", "cells", 1.0, "cathode chemistry", []), ("r3", "critical", "qubits", 1.0, "superconducting qubit", ["qubit"])]
    refs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(refs)], "ref int, kind string, label string, weight double, body string, lexicon array<string>")
    first = {r.topic_id: r for r in emergence.reference_scores(docs, members, dense, refs, settings).collect()}
    quantum = next(t for t, label in rows.select("topic_id", "label").collect() if {"quantum", "qubit", "error"} & set(label.replace("/", " ").split()))
    battery = "T0001" if quantum == "T0000" else "T0000"
    assert first[quantum].objective == "secure links" and first[battery].objective == "clean power"
    assert first[battery].capability == "cells" and first[battery].leverage > 0 and first[quantum].leverage == 0
    assert first[quantum].critical == "qubits" and first[battery].critical is None and first[quantum].fit > first[battery].fit
    import dataclasses

    some = dataclasses.replace(settings, research=("works",), attention=("news",), min_documents=12)
    index, used = emergence.opportunities(docs, members, rows, some)
    index = {r.topic_id: r for r in index.collect()}
    assert set(used) == {"attention"} | ({"research_growth"} if max(r.research_growth for r in index.values()) > 0 else set()) and abs(sum(used.values()) - 1) < 1e-9
    assert all(r.opportunity is not None and r.attention == 2 / 12 for r in index.values())
    few = emergence.opportunities(docs, members, rows, dataclasses.replace(some, min_documents=13))[0]
    assert all(r.opportunity is None for r in few.collect())
    scores = spark.createDataFrame([("T0000", 0.4, 0.2)], "topic_id string, fit double, leverage double")
    out = emergence.ranked(rows, scores, settings).orderBy("rank").toPandas()
    assert out["rank"].tolist() == [1, 2] and out.topic_id[0] == "T0000"
    assert out.document_count.tolist() == [12, 12]
    assert out.composite.between(0, 1).all() and out.horizon.isin(["H1", "H2", "H3"]).all()
    assert {"quantum", "battery"} & set(" ".join(out.label).split())

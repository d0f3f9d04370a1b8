"""Connector payloads, local files, retries."""

import json

import pytest

from topicloom.sources import connectors, files, payloads


def one(spark, body):
    return spark.createDataFrame([("f", body)], "frame string, body string")


def test_works_and_floor(spark):
    body = {"results": [{"id": f"W{k}", "title": " T ", "publication_date": "2020-02-03", "relevance_score": s, "abstract_inverted_index": {"b": [1], "a": [0]}, "authorships": [{"author": {"display_name": "A"}, "institutions": [{"display_name": "Z"}, {"display_name": "B"}]}]} for k, s in enumerate([10.0, 5.0, 1.0, 9.0])]}
    rows = payloads.works(one(spark, json.dumps(body)))
    first = rows.orderBy("pos").first()
    assert (first.title, first.abstract, first.year, first.institutions, first.authors) == ("T", "a b", 2020, ["B", "Z"], ["A"])
    assert [r.native_id for r in payloads.relevant(rows, "frame", anchor=1, share=0.2).orderBy("pos").collect()] == ["W0", "W1"]


def test_articles(spark):
    items = [{"DOI": "1", "title": ["One"], "abstract": "&lt;p&gt;x&lt;/p&gt; y", "type": "journal-article", "issued": {"date-parts": [[2021, 5]]}, "author": [{"given": "A", "family": "B"}]}, {"DOI": "2", "title": ["Two"], "type": "Peer-Review"}, {"DOI": "3", "title": ["Index"], "type": "x"}]
    rows = payloads.articles(one(spark, json.dumps({"message": {"items": items}})), types=("peer-review",), titles=("index",)).collect()
    assert [(r.native_id, r.abstract, str(r.published_date), r.authors) for r in rows] == [("1", "x y", "2021-05-01", ["A B"])]


def test_xml_sources(spark):
    atom = "<feed><entry><id>u</id><title>A\n b</title><summary>S</summary><published>2019-01-02T00:00:00Z</published><author><name>N</name></author></entry></feed>"
    row = payloads.preprints(one(spark, atom)).first()
    assert (row.title, str(row.published_date), row.authors) == ("A b", "2019-01-02", ["N"])
    rss = "<rss><channel><item><title>T</title><link>l</link><guid>g</guid><description>&lt;b&gt;d&lt;/b&gt;</description><pubDate>Tue, 3 Mar 2020 10:00:00 GMT</pubDate><category>c</category><category>e</category></item></channel></rss>"
    row = payloads.releases(one(spark, rss)).first()
    assert (row.native_id, str(row.published_date), row.concepts) == ("g", "2020-03-03", ["c", "e"])


def test_news_datasets_patents(spark):
    body = {"articles": [{"url": "u", "title": "t", "seendate": "20200102T000000Z", "language": "English"}, {"url": "u", "title": "t"}, {"url": "v", "language": "French"}], "timeline": [{"data": [{"value": -1.0}, {"value": -2.0}]}]}
    rows = payloads.news(one(spark, json.dumps(body))).collect()
    assert [(r.native_id, r.tone) for r in rows] == [("u", -1.5)]
    assert payloads.datasets(one(spark, json.dumps({"result": {"results": [{"id": "d", "title": "x", "notes": "<i>n</i>", "metadata_modified": "2022-01-01T00:00:00"}]}}))).first().year == 2022
    assert payloads.patents(one(spark, json.dumps({"patents": [{"patent_id": "p", "patent_date": "2018-07-01", "assignees": [{"assignee_organization": "O"}]}]}))).first().institutions == ["O"]


def test_retry():
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise connectors.classify(429, "slow", 7.0)
        return "ok"

    assert connectors.retry(call, sleep=waits.append) == "ok" and waits == [7.0, 7.0]
    assert isinstance(connectors.classify(404, ""), connectors.PermanentError)
    assert isinstance(connectors.classify(503, "", 900.0), connectors.PermanentError)
    with pytest.raises(connectors.PermanentError):
        connectors.retry(lambda: (_ for _ in ()).throw(connectors.PermanentError("no")), sleep=waits.append)


def test_files(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "refs.yaml"
    path.write_text(yaml.safe_dump({"objectives": [{"code": "1", "label": "Aim", "text": "A long  text\n that says what is aimed at here.", "lexicon": ["Trade Mark"], "weight": 2}], "assets": [{"code": "a", "label": "Short", "text": ""}]}))
    refs = files.references(spark, [str(path)])
    row = refs.where("ref_type = 'objective'").first()
    assert (row.ref_id, row.text, row.lexicon, row.weight) == ("objective:1", "Aim. A long text that says what is aimed at here.", ["trade mark"], 2.0)
    assert {(r.ref_id, r.fault) for r in files.faults(refs, ("objective", "asset", "critical_tech")).collect()} == {("asset:a", "short text"), ("critical_tech", "type missing")}
    (tmp_path / "a.md").write_text("Some TEXT")
    assert [r.text for r in files.corpus(spark, [str(tmp_path / "a.md"), str(tmp_path / "none.md")]).collect()] == ["some text"]
    raw = files.save_raw(str(tmp_path), "r", "s", "a/b c", 1, {"x": 1})
    assert raw.endswith("a_b_c-1.json") and json.load(open(raw)) == {"x": 1}
    ranked = spark.createDataFrame([(1, "</script>", 0.5, ["a", "b"])], "rank int, topic string, composite double, burst_slices array<string>")
    assert "</script>" not in files.page(ranked, 5, "t").split("id=data>")[1].removesuffix("</script>")
    assert files.topics_csv(ranked, ["topic", "burst_slices", "other"]).first().burst_slices == "a;b"
    assert "| 1 |" in files.shortlist_markdown(ranked, 3)

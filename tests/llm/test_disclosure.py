"""Terms that disclose an entity: evidence of neighbouring lines, of two lines, and of names inside addresses."""

import pytest

from topicloom.llm import pii

FILLER = ["the line has some words and"] * 400


def terms(df, texts):
    rows = {r.doc_id: r for r in pii.spans(df).collect()}
    return {texts[i][int(s.split(":")[1]) : int(s.split(":")[2])] for i in rows for s in rows[i].spans.split(",") if s.startswith("term")}


@pytest.fixture(params=[20_000, 0], autouse=True)
def rows_that_are_broadcast(request, monkeypatch):
    monkeypatch.setattr(pii, "BROADCAST_ROWS", request.param)


def test_two_lines_and_neighbours_are_evidence(spark, frame):
    texts = ["Contact:\nMrs Quillfeather\n+1 (377) 555-0271\nsome words", "call +1 (377) 555-0271 for\n\nthe line of quillfeather and", "the once only zz@yy.example.org line has"] + FILLER
    assert terms(frame(texts), texts) == {"Quillfeather", "quillfeather"}
    assert pii.disclosing(frame(["no entity", None])).collect() == []


def test_words_of_an_address_outside_it(spark, frame):
    texts = [f"Jane Smithers, jane.smithers@corp.example.com {w}" for w in ("alpha", "beta", "gamma", "delta")] + FILLER
    assert terms(frame(texts), texts) == {"Jane", "Smithers"}
    assert {r.text for r in pii.sanitised(frame(texts)).where("doc_id < 4").collect()} == {f" , [EMAIL] {w}" for w in ("alpha", "beta", "gamma", "delta")}

"""Suffix de-duplication gives back the remaining bytes and the removed spans."""

from __future__ import annotations

import hashlib
import random

import pytest

from glyphline.llm import suffixes


@pytest.mark.parametrize("hot", [1, 20_000])
def test_rest_and_spans_make_the_text(spark, hot):
    rng = random.Random(2)
    prose = lambda n: "".join(rng.choices("abcdé fgh", k=n))
    passage = prose(90)
    texts = [prose(50) + passage + prose(40) + passage, passage + prose(30), prose(200), "short", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in suffixes.remove_repeats(docs, depth=60, gram=12, hot=hot).collect()}
    raw = [(t or "").encode() for t in texts]
    windows = [b[i : i + 60] for b in raw for i in range(len(b) - 59)]
    for i, b in enumerate(raw):
        gone = {k + j for k in range(len(b) - 59) if windows.count(b[k : k + 60]) > 1 for j in range(60)}
        assert bytes(found[i]["kept"]) == bytes(x for k, x in enumerate(b) if k not in gone)
        spans = [(s["start"], s["stop"]) for s in found[i]["spans"]]
        assert {k for s, e in spans for k in range(s, e)} == gone and found[i]["n_spans"] == len(spans)
        assert found[i]["kept_sha256"] == hashlib.sha256(found[i]["kept"]).hexdigest()
        assert found[i]["n_removed"] == len(gone)
    assert [len(found[i]["spans"]) for i in range(6)] == [2, 1, 0, 0, 0, 0]

"""The quality rules give back the texts without their flagged lines."""

from __future__ import annotations

import random

from glyphline.llm import quality

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 9)))
    rows = []
    for i in range(40):
        lines = [" ".join(word() for _ in range(20)) for _ in range(4)]
        if i < 30:
            lines.insert(2, f"Read  all {i} comments!")
        if i % 2:
            lines.append("")
        rows.append((i, "\n".join(lines), "en", "a" if i < 35 else None, 0))
    rows += [(50, "Read all 7 comments!\n" * 3, "en", "a", 0), (51, None, "en", "a", 0), rows[0], (None, *rows[1][1:])]
    return [(*r[:4], len(r[1] or "")) for r in rows]


def _clean(text, source):
    if text is None or source is None:
        return text
    return "\n".join(x for x in text.split("\n") if not x.startswith("Read "))


def test_flagged_lines_leave_the_text(spark):
    rows = _rows()
    found = quality.judge(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "host", "text").collect()
    expected = [(i, s, _clean(t, s)) for i, t, _, s, _ in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert sum(t != r[1] for r, (_, _, t) in zip(rows, expected)) == 33


def test_kept_documents_come_without_flagged_lines(spark):
    rows = _rows()
    kept = quality.keep_good(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = [(i, _clean(t, s), g, s, len(_clean(t, s))) for i, t, g, s, _ in rows if t and i != 50]
    assert sorted(map(tuple, kept), key=repr) == sorted(expected, key=repr)

"""The Jaccard join against all pairs compared, on crowded near copies, sizes at band ends, and odd rows."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphline.llm import jaccard

SCHEMA = "doc_id bigint, text string"


def _set(text, width):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        {ord(c): " " for c in "\t\n\x0b\x0c\r"}
    ).split(" ")
    words = [w for w in words if w]
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def _expected(rows, width, percent):
    sets = [_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[find(i)] = find(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return [
        (doc_id, len(s), least.get(find(k)) if s else doc_id) for k, ((doc_id, _), s) in enumerate(zip(rows, sets))
    ]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    texts = []
    for n in (1, 3, 4, 5, 9, 12, 40, 150, 400):  # near copies at many distances, of many sizes
        for _ in range(3):
            base = [word() for _ in range(n)]
            for _ in range(8):
                copy = list(base)
                for _ in range(rng.randint(0, 1 + n // 25)):
                    at = rng.randrange(len(copy))
                    copy[at : at + 1] = rng.choice([[word()], [], [copy[at], word()]])
                texts.append(" ".join(copy))
    base = [word() for _ in range(60)]  # one crowded group, a chain of small changes and strays
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 5, 9])):
            copy[rng.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    common = " ".join(word() for _ in range(20))
    texts += [f"{common} " + " ".join(word() for _ in range(rng.randint(1, 40))) for _ in range(40)]
    texts += [None, "", " \n ", None, "One", "one", "a b C", "A\tB c", texts[0], texts[0], texts[-1].upper()]
    texts.append(" ".join(word() for _ in range(5000)))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [(None, texts[3]), (None, "all alone here in this place"), rows[0], (rows[1][0], "another text with that id")]


def _found(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (2, 60), (1, 95)])
def test_components_are_those_of_all_similar_pairs(spark, rows, width, percent):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({
        c: F.lit("clash") for c in ("node", "digest", "n", "band", "id", "signature", "own_id", "first")
    })
    expected = _expected(rows, width, percent)
    assert _found(jaccard.similar_documents(docs, words=width, percent=percent)) == sorted(expected, key=repr)
    assert len({c for _, _, c in expected}) < len(rows) - 50


@pytest.mark.parametrize("piece", [1, 7, 1 << 16])
def test_words_are_hashed_alike_in_any_pieces(rows, monkeypatch, piece):
    monkeypatch.setattr(jaccard, "PIECE", piece)
    texts = [t for _, t in rows[:60] if t] + ["\x0ba\x0c ß\r\n", "a" * 300, " ", "b" * 256 + " " + "b" * 257]
    for text in texts:
        data = text.encode()
        hashes, starts = jaccard.word_hashes(data)
        words = data.lower().split()
        assert [data.lower()[s:].split()[0] for s in starts] == words
        assert len(set(hashes.tolist())) == len(set(words))
    sets = [s.tolist() for s in jaccard.shingle_sets([t.encode() for t in texts] + [None], 3)]
    monkeypatch.setattr(jaccard, "PIECE", 1 << 16)
    assert sets == [next(jaccard.shingle_sets([t and t.encode()], 3)).tolist() for t in [*texts, None]]


def test_blocks_of_a_crowded_bucket(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "PAIRS", 10)
    monkeypatch.setattr(jaccard, "FEW", 5)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert _found(jaccard.similar_documents(docs)) == sorted(_expected(rows, 4, 85), key=repr)


def test_an_empty_table(spark):
    assert _found(jaccard.similar_documents(spark.createDataFrame([], SCHEMA))) == []


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_similar_sets_share_a_signature_and_sketches_never_overstate(percent):
    rng = np.random.default_rng(percent)
    for _ in range(400):
        n = int(rng.integers(2, 300))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        gone = rng.permutation(len(a))[: int(rng.integers(0, 2 + len(a) * (100 - percent) // 100))]
        new = rng.integers(0, 2**63, int(rng.integers(0, 3)), dtype=np.uint64)
        b = np.unique(np.concatenate([np.delete(a, gone), new]))
        common = len(np.intersect1d(a, b))
        union = len(a) + len(b) - common
        bands = [int(x) for x in jaccard.band_of(np.array([len(a), len(b)]), percent)]
        for bits in (jaccard.SHORT, jaccard.long_bits(max(bands), percent)):
            sketches = [np.frombuffer(jaccard.sketch(x, bits), np.uint64) for x in (a, b)]
            assert int(np.bitwise_count(sketches[0] ^ sketches[1]).sum()) <= union - common
        if len(b) and 100 * common >= percent * union and common < union:
            signature, of = jaccard.signatures([a, b], percent)
            assert set(signature[of == 0]) & set(signature[of == 1])
            assert union - common <= jaccard.distance(np.int64(len(a) + len(b)), percent)


def test_postings_are_joined_over_batches(spark):
    rows = [(s, i) for s in range(300) for i in range(s % 4)] + [(7, 1), (7, 1), (2, 0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = jaccard.buckets(spark.createDataFrame(rows, "signature bigint, id bigint")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, found)) == sorted({(s, i) for s, i in rows if s % 4 > 1})

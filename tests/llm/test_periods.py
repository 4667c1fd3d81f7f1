"""Periodic runs against every period tried at every place."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphline.llm import periods

SCHEMA = "doc_id bigint, text string"


def _brute(words, min_length=24, repeats=3):
    n, least = len(words), {}
    for q in range(1, n // repeats + 1):
        x = 0
        while x + q < n:
            if words[x] != words[x + q]:
                x += 1
                continue
            start = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            if x + q - start >= max(min_length, repeats * q):
                least.setdefault((start, x + q), q)
    return sorted((s, e - s, q) for (s, e), q in least.items())


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(1)
    out = [[], ["one"], ["a"] * 23, ["a"] * 24, ["a"] * 25, list("ab") * 12, list("abcdefgh") * 3, list("abcdefghi") * 3]
    for t in range(150):
        n = rng.randint(0, 400)
        if t % 5 == 0:
            words = rng.choices("ab", k=n)
        elif t % 5 == 1:
            words = ["a"] * n
        elif t % 5 == 2:
            words = []
            while len(words) < n:
                words += (rng.choices("abcde", k=rng.randint(1, 40)) * 20)[: rng.randint(1, 150)]
        elif t % 5 == 3:  # Fibonacci words, full of squares and cubes
            a, words = ["a"], ["a", "b"]
            while len(words) < n:
                a, words = words, words + a
            words = words[:n] * rng.choice([1, 3])
        else:
            words = rng.choices("abc", k=rng.randint(1, 9)) * (n // 5 + 1)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = "z"
        out.append(words)
    return out


def test_runs_equal_brute_force(documents):
    found = periods.runs_of(documents)
    assert found == [_brute(w) for w in documents]
    assert sum(map(len, found)) > 500


def test_words_may_come_one_by_one_or_in_any_pieces(documents):
    rng = random.Random(2)
    for words in documents[::4]:
        stream, at = periods.SquareCatchers(), 0
        ids = np.array([ord(w[0]) for w in words], np.int64)
        while at < len(ids):
            step = rng.choice([1, 1, 2, 5, 30])
            stream.append(ids[at : at + step])
            at += step
            if rng.random() < 0.02:
                assert stream.runs() == _brute(words[:at])
        assert stream.runs() == _brute(words)


def test_clashing_fingerprints_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(periods, "_mixed", lambda x: x & np.uint64(3))
    assert periods.runs_of(documents[:60]) == [_brute(w) for w in documents[:60]]


def test_catchers_keep_little():
    stream = periods.SquareCatchers()
    for _ in range(64):
        stream.append(np.arange(1024) + stream.size)
    assert sum(map(len, stream._tails)) + sum(map(len, stream._blocks)) < 6 * stream.size


def test_the_operator_on_odd_rows(spark, documents):
    texts = [" \n".join(w) for w in documents] + [None, "", " \t\n", "é ß " * 40, "x" * 30_000, "w " * 20_000]
    rows = [*enumerate(texts), (None, "a b " * 30), (3, "a b " * 30), (3, "a b " * 30)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("runs", "n_words", "collapsed")})
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.periodic_runs(docs).collect()]
    expected = []
    for doc_id, text in rows:
        words = (text or "").split()
        runs = _brute(words) if len(set(words)) > 1 else ([(0, len(words), 1)] if len(words) >= 24 else [])
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        expected.append((doc_id, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert periods.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(10**7 + k, None if k % 7 == 0 else "a b c " * k) for k in range(60)], SCHEMA)
    docs.unionByName(more).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for doc_id, text in docs.unionByName(more).collect():
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = _brute(words)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        expected.append((
            doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        ))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = periods.op13_periodic_runs(spark, str(tmp_path))
    assert dict(found.dtypes) == dict.fromkeys(columns, "bigint") | {"runs_sha256": "string", "collapsed_sha256": "string"}
    assert sorted(map(tuple, found.select(*columns).collect()), key=repr) == sorted(expected, key=repr)
    assert sum(r[1] > 0 for r in expected) > 30

"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint has 8 bytes. Two that differ in at most ``max_bits`` bits agree in at least
``8 - max_bits`` of their positional bytes, the guaranteed matches. The index lists every
distinct fingerprint under each set of that many positional bytes, so a pair is a candidate
exactly when a posting holds both: it shares the guaranteed number of matches. The matches of
a pair are tallied byte by byte, the count filter applied, and the bits verified.

A posting fixes all but ``max_bits`` bytes, so it holds at most 256 ** max_bits distinct
fingerprints however many documents there are (65,536 for two bits); copies of a text share
one fingerprint and were folded before. Inside a posting, fingerprints are compared in blocks
and joined locally, and only the edges of a spanning forest leave the task, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from glyphline.llm.common import as_text, query, same, table, text_key, written
from glyphline.llm.components import connected_components

WORDS_IN_SHINGLE = 3
MAX_BITS = 2
SEED = 42
BYTES = 8
#: Shingles whose bits are unpacked at once, and rows of a posting compared at once.
BLOCK = 1 << 16
ROWS = 512


def fingerprint(text: str | None, words: int = WORDS_IN_SHINGLE) -> int:
    """64 bits, each set when more than half of the shingle hashes have it; 0 without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(parts) > words:
        spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    else:
        spans = [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, BYTES)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, digest of the text, fp (the 64 bits as a signed long)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, words) for t in batch["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": batch["digest"], "fp": found})

    rows = docs.select(as_text(id_col).alias("doc_id"), text_key(text_col).alias("digest"), F.col(text_col).alias("text"))
    found = rows.mapInPandas(run, "doc_id string, digest bigint, fp bigint")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Which pairs of a row of ``a`` and a row of ``b`` share enough positional bytes and differ in few bits."""
    bytes_a = a.view(np.uint8).reshape(-1, 1, BYTES)
    bytes_b = b.view(np.uint8).reshape(1, -1, BYTES)
    matches = np.zeros((len(a), len(b)), np.uint8)
    for k in range(BYTES):
        matches += bytes_a[:, :, k] == bytes_b[:, :, k]
    near = matches >= BYTES - max_bits
    i, j = np.nonzero(near)
    near[i, j] = np.bitwise_count(a[i] ^ b[j]) <= max_bits
    return near


def _forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges that join the members of one posting into the components of its near pairs."""
    left = members
    edges = []
    while len(left) > 1:
        # grow one component from its least member; what it reaches leaves the rest
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            hit = np.zeros(len(left), bool)
            for at in range(0, len(wave), ROWS):
                rest = np.flatnonzero(~hit)
                for to in range(0, len(rest), 1 << 14):
                    part = rest[to : to + (1 << 14)]
                    near = _near(wave[at : at + ROWS], left[part], max_bits)
                    reached = near.any(axis=0)
                    first = near.argmax(axis=0)
                    hit[part] |= reached
                    edges += zip(wave[at + first[reached]].tolist(), left[part[reached]].tolist())
            wave, left = left[hit], left[~hit]
    return edges


def _postings(keys: np.ndarray, values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of all postings in sorted arrays."""
    edges = []
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    several = ends - starts > 1
    for s, e in zip(starts[several].tolist(), ends[several].tolist()):
        edges += _forest(np.unique(values[s:e]), max_bits)
    return edges


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """a, b: edges between fingerprints whose components are those of all pairs within ``max_bits``."""
    kept = BYTES - max_bits
    if kept < 1:
        raise ValueError("at least one positional byte must match")
    masks = [sum(0xFF << (8 * k) for k in chosen) for chosen in combinations(range(BYTES), kept)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    entries = F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("bytes"))
        for i, m in enumerate(signed)
    ])
    index = distinct.select("fp", F.explode(entries).alias("e")).select(
        F.xxhash64("e.mask", "e.bytes").alias("posting"), "fp"
    )
    index = index.repartition("posting").sortWithinPartitions("posting")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch["posting"].to_numpy()])
            values = np.concatenate([values, batch["fp"].to_numpy().view(np.uint64)])
            # the last posting may go on in the next batch
            done = np.searchsorted(keys, keys[-1]) if len(keys) else 0
            yield frame(_postings(keys[:done], values[:done], max_bits)) if done else frame([])
            keys, values = keys[done:], values[done:]
        yield frame(_postings(keys, values, max_bits)) if len(keys) else frame([])

    def frame(edges: list[tuple[int, int]]) -> pd.DataFrame:
        pairs = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return index.mapInPandas(run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS_IN_SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, and
    with them component (a fingerprint of the group) and digest (of the text).

    component_id is the smallest doc_id reachable over links of at most ``max_bits`` bits. Null
    and empty texts have fingerprint zero and link like any other; a null id is no candidate
    for the smallest, so a group of none but null ids has a null component; rows that repeat
    an id each have a row; an empty table gives an empty result. Only the three named columns
    are read.
    """
    prints = written(fingerprints(docs, id_col, text_col, words), "simhash")
    # one row per fingerprint: copies meet as partial minimums
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    component = connected_components(links(groups.select("fp"), max_bits))
    named = groups.join(component, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id")).withColumnRenamed("component", "c")
    by_print = named.join(smallest, F.col("component") == F.col("c")).select(
        F.col("fp").alias("of"), "component", "component_id"
    )
    return prints.join(by_print, F.col("fp") == F.col("of")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component", "digest"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS_IN_SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """The documents, one of each group: the one whose id names the component.

    Rows that repeat the kept id with the same text are one document and leave one row; of
    several texts of a group under that id the one with the smallest digest stays.
    """
    judged = near_duplicates(docs, id_col, text_col, words, max_bits)
    chosen = (
        judged.filter(same(F.col("doc_id"), F.col("component_id")))
        .groupBy("component", F.col("component_id").alias("kept_id"), F.col("digest").alias("kept_digest"))
        .agg(F.count("*").alias("n"))
        .groupBy("component", "kept_id")
        .agg(F.min(F.struct("kept_digest", "n")).alias("kept"))
        .select("kept_id", "kept.*")
    )
    rows = docs.alias("d")
    own = text_key(F.col(f"d.`{text_col}`"))
    match = same(F.col(f"d.`{id_col}`"), F.col("c.kept_id")) & (own == F.col("c.kept_digest"))
    single, repeated = chosen.filter("n = 1").alias("c"), chosen.filter("n > 1").alias("c")
    once = rows.join(single, match, "left_semi")
    first = rows.join(repeated, match, "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(first)


@query()
def op1_simhash_dedup(spark, sf):
    return near_duplicates(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")

"""Jaccard join of word n-gram sets by PartEnum signatures.

Sizes are cut into bands so that similar sets lie in one band or in neighbouring ones; a set
signs for its own band and the next. In a band, similar sets differ in at most k shingles. The
shingle domain is hashed into n1 parts, and each part into N2 cells: two sets that differ in at
most k places differ in at most K2 places of some part, so they agree on N2 - K2 of its cells. A
signature is the content of one part on one choice of so many cells, and every choice is
enumerated; similar sets share a signature, and sets that share none are not compared.

Equal sets are folded before, so a bucket holds different sets. Buckets of near copies may be large,
and all their pairs are never emitted: first, the members of a bucket are checked against its first and its
last member, and links found so are contracted to components. Only for buckets that then still hold
several components are members of different ones compared, in blocks, by parity sketches, whose
distance never exceeds that of the sets; pairs that the sketches leave over are checked
on their shingles. Every pair that shares a signature is thus linked, ruled out, or already connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from glyphline.llm.common import as_text, query, table, text_key, written
from glyphline.llm.components import connected_components

WORDS = 4
PERCENT = 85
#: Cells of a part, and how many of them may differ.
N2, K2 = 3, 1
#: Shingles whose signatures are made together, bytes hashed together, rows of a block of a bucket, pairs compared together.
CHUNK = 1 << 18
PIECE = 1 << 16
BLOCK = 4096
PAIRS = 1 << 18
#: Documents whose sets are made together.
DOCUMENTS = 256
#: Bits of the short sketch, which goes along with a posting.
SHORT = 512
#: Ids are sent to every task while they are no more than this; beyond, what they pick moves to meet them.
FEW = 1_000_000
SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _B
    x ^= x >> np.uint64(29)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of lower-cased UTF-8, as arrays, some bytes at a time.

    A word's hash is the sum of what its bytes are mixed to with their places in the word.
    """
    raw = np.frombuffer(data.lower(), np.uint8)
    hashes, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    # a word that the bytes before have begun: its sum, length and first byte
    total, length, first = np.zeros(1, np.uint64), 0, 0

    def ended(sums: np.ndarray, lengths: np.ndarray, where: np.ndarray) -> None:
        hashes.append(_mixed(sums + lengths.astype(np.uint64) * _C))
        starts.append(where)

    for at in range(0, len(raw), PIECE):
        piece = raw[at : at + PIECE]
        inside = ~SPACE[piece]
        if length and not inside[0]:
            ended(total, np.array([length]), np.array([first]))
            length = 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = np.flatnonzero(begins)
        if not len(cuts):
            continue
        # the piece begins with spaces or a word's first byte here, so the bytes before the first cut are spaces
        ends = np.append(cuts[1:], len(piece))
        place = np.arange(len(piece), dtype=np.uint64)
        place[cuts[0] :] -= np.repeat(cuts.astype(np.uint64), ends - cuts)
        place[: ends[0]] += np.uint64(length)
        place <<= np.uint64(8)
        place += piece
        place += _A
        mixed = _mixed(place)
        mixed *= inside
        sums = np.add.reduceat(mixed, cuts)
        lengths = np.add.reduceat(inside.astype(np.int64), cuts)
        where = cuts + at
        if length:
            sums[:1] += total
            lengths[0] += length
            where[0] = first
            length = 0
        if inside[-1]:
            total, length, first = sums[-1:], int(lengths[-1]), int(where[-1])
            sums, lengths, where = sums[:-1], lengths[:-1], where[:-1]
        ended(sums, lengths, where)
    if length:
        ended(total, np.array([length]), np.array([first]))
    return np.concatenate(hashes), np.concatenate(starts)


def _rolled(hashes: np.ndarray, words: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    out = hashes[: len(hashes) - words + 1]
    for k in range(1, words):
        out = _mixed(out * _A + hashes[k : len(hashes) - words + 1 + k])
    return out


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def shingle_sets(texts: list[bytes | None], words: int) -> Iterator[np.ndarray]:
    """The set of shingles of each text, as sorted 64-bit hashes; a text with fewer words is one shingle."""
    at = 0
    while at < len(texts):
        size, to = 0, at
        while to < len(texts) and (to == at or size < PIECE):
            size += len(texts[to] or b"") + 1
            to += 1
        some = [t or b"" for t in texts[at:to]]
        hashes, starts = word_hashes(b"\n".join(some))
        rolled = _rolled(hashes, words) if len(hashes) >= words else hashes[:0]
        ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in some])).tolist()
        low = 0
        for high in ends:
            if high - low >= words:
                yield _distinct(rolled[low : high - words + 1])
            else:
                yield _rolled(hashes[low:high], high - low) if high > low else hashes[:0]
            low = high
        at = to


def name(features: np.ndarray) -> str | None:
    """128 bits that name a set; none for the empty set."""
    return xxhash.xxh3_128_hexdigest(features.tobytes()) if len(features) else None


def locator(names: pd.Series | list) -> np.ndarray:
    """The first 64 bits of names, by which postings find their sets."""
    return np.array([int(x[:16], 16) for x in names], np.uint64).view(np.int64)


@lru_cache(maxsize=8)
def band_ends(percent: int) -> np.ndarray:
    """Largest sizes of the bands 0, 1, …: sizes a <= b with 100 a >= percent b are at most one band apart."""
    if not 0 < percent < 100:
        raise ValueError("the threshold is a whole percentage between 0 and 100")
    ends = [0]
    while ends[-1] < 1 << 40:
        ends.append((ends[-1] + 1) * 100 // percent)
    return np.array(ends, np.int64)


def band_of(sizes: np.ndarray, percent: int) -> np.ndarray:
    return np.searchsorted(band_ends(percent), sizes)


def distance(total: np.ndarray, percent: int) -> np.ndarray:
    """In how many shingles similar sets of this total size differ at most."""
    return total * (100 - percent) // (100 + percent)


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the sets, and the position of the set that each belongs to."""
    sizes = np.array([len(s) for s in sets], np.int64)
    features = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    found, of = [], []
    for step in (0, 1):
        band = band_of(sizes, percent) + step
        k = distance(2 * band_ends(percent)[band], percent)
        # a band without a difference holds equal sets only, and those are one
        parts = np.where(k > 0, -(-(k + 1) // (K2 + 1)), 0)
        alive = np.repeat(k > 0, sizes)
        owner = np.repeat(np.arange(len(sets)), sizes)[alive]
        x = _mixed(features[alive] ^ (band[owner].astype(np.uint64) * _C))
        cells = (parts * N2).astype(np.uint64)
        base = np.concatenate([[0], np.cumsum(parts * N2)])
        cell = base[owner] + ((x >> np.uint64(32)) * cells[owner] >> np.uint64(32)).astype(np.int64)
        content = np.zeros(base[-1], np.uint64)
        np.add.at(content, cell, _mixed(x * _A))
        content = content.reshape(-1, N2)
        owner = np.repeat(np.arange(len(sets)), parts)
        part = np.arange(len(owner)) - base[owner] // N2
        key = _mixed(band[owner].astype(np.uint64) * _C + part.astype(np.uint64))
        for choice, chosen in enumerate(combinations(range(N2), N2 - K2)):
            signature = key + np.uint64(choice)
            for c in chosen:
                signature = _mixed(signature * _A + content[:, c])
            # the last bit is the band's, so that a set knows which of its two bands a posting is for
            found.append((signature & ~np.uint64(1)) | (band[owner] & 1).astype(np.uint64))
            of.append(owner)
    return np.concatenate(found).view(np.int64), np.concatenate(of)


def long_bits(band: int, percent: int) -> int:
    """Bits of the long sketch, twice as many as sets of the band have shingles, so that it tells those just dissimilar."""
    return 64 * max(2, int(2 * band_ends(percent)[band]) // 64)


def sketch(features: np.ndarray, bits: int = SHORT) -> bytes:
    """Parities of the hashed shingles: two sets differ in at least as many places as their sketches."""
    place = (_mixed(features + _C) >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=bits) & 1).tobytes()


def _utf8(column: str):
    return as_text(column).cast("binary").alias("text")


def _sized(ids: DataFrame) -> DataFrame:
    """The ids, to be broadcast while their counted number allows."""
    return F.broadcast(ids) if ids.count() <= FEW else ids


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """A few rows at a time, with their texts: a batch of long texts is not copied as a whole."""
    for batch in batches:
        for at in range(0, batch.num_rows, DOCUMENTS):
            part = batch.slice(at, DOCUMENTS)
            yield part, part.column("text").to_pylist()


def named_sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, digest of the text, n_shingles, node (the name of the set, null for the empty one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _some(batches):
            sizes, names = [], []
            for found in shingle_sets(texts, words):
                sizes.append(len(found))
                names.append(name(found))
            columns = [part.column("doc_id"), part.column("digest"), pa.array(sizes, pa.int64()), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_shingles", "node"])

    rows = docs.select(as_text(id_col).alias("doc_id"), text_key(text_col).alias("digest"), _utf8(text_col))
    found = rows.mapInArrow(run, "doc_id string, digest bigint, n_shingles bigint, node string")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def postings(docs: DataFrame, text_col: str, words: int, percent: int) -> DataFrame:
    """signature, id (the locator of a set). A task signs for each set once, however many copies it reads."""

    def framed(sets: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
        signature, of = signatures(sets, percent)
        return pa.RecordBatch.from_arrays([pa.array(signature), pa.array(locator(names)[of])], ["signature", "id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        sets, names, held = [], [], 0
        for _, texts in _some(batches):
            for found in shingle_sets(texts, words):
                own = name(found)
                if own is None or own in seen:
                    continue
                seen.add(own)
                sets.append(found)
                names.append(own)
                held += len(found)
                if held >= CHUNK:
                    yield framed(sets, names)
                    sets, names, held = [], [], 0
        if sets:
            yield framed(sets, names)

    return docs.select(_utf8(text_col)).mapInArrow(run, "signature bigint, id bigint")


def buckets(rows: DataFrame) -> DataFrame:
    """The postings whose signature several sets have, each once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the last line of a batch waits for the next one: (signature, id, whether the line before it has its signature)
        signature, ids, joined = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for batch in batches:
            signature = np.concatenate([signature, batch["signature"].to_numpy()])
            ids = np.concatenate([ids, batch["id"].to_numpy()])
            if not len(signature):
                continue
            new = np.concatenate([[True], (signature[1:] != signature[:-1]) | (ids[1:] != ids[:-1])])
            signature, ids = signature[new], ids[new]
            like = signature[1:] == signature[:-1]
            several = np.concatenate([[joined], like])
            several[:-1] |= like
            yield pd.DataFrame({"signature": signature[:-1][several[:-1]], "id": ids[:-1][several[:-1]]})
            signature, ids, joined = signature[-1:], ids[-1:], bool(several[-1])
        if joined:
            yield pd.DataFrame({"signature": signature, "id": ids})

    placed = rows.repartition("signature").sortWithinPartitions("signature", "id")
    return placed.mapInPandas(run, "signature bigint, id bigint")


def candidate_sets(docs: DataFrame, named: DataFrame, ids: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """id, node, band, n, features, a short sketch, and long ones for the band (own) and the next (above), of sets in buckets.

    One document of each set is read again; several rows that repeat its id and text give the same set again.
    """
    number = F.conv(F.substring("node", 1, 16), 16, -10).cast("bigint")
    chosen = (
        named.filter(F.col("node").isNotNull()).withColumn("at", number)
        .join(ids, F.col("at") == F.col("id"), "left_semi")
        .groupBy("node").agg(F.min(F.struct("doc_id", "digest")).alias("first")).select("first.*")
    )
    chosen = _sized(written(chosen, "chosen"))
    rows = docs.select(F.col(id_col).alias("own_id"), text_key(text_col).alias("own_digest"), _utf8(text_col))
    rows = rows.join(chosen, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_digest") == F.col("digest")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _some(batches):
            found = list(shingle_sets(texts, words))
            names = [name(f) for f in found]
            band = band_of(np.array([len(f) for f in found], np.int64), percent)
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(locator(names)), "node": pa.array(names, pa.string()), "band": pa.array(band, pa.int32()),
                "n": pa.array([len(f) for f in found], pa.int64()),
                "features": pa.array([f.tobytes() for f in found], pa.binary()),
                "short": pa.array([sketch(f) for f in found], pa.binary()),
                "own": pa.array([sketch(f, long_bits(b, percent)) for f, b in zip(found, band)], pa.binary()),
                "above": pa.array([sketch(f, long_bits(b + 1, percent)) for f, b in zip(found, band)], pa.binary()),
            })

    kinds = "id bigint, node string, band int, n bigint, features binary, short binary, own binary, above binary"
    return rows.select("text").mapInArrow(run, kinds)


def _matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)


def _sides(pairs: DataFrame, sets: DataFrame, key: str, *columns: str) -> DataFrame:
    """The pairs with columns of both their sets. Sets that are in no pair stay where they are."""

    def side(s: str) -> DataFrame:
        wanted = sets.select(F.col(key).alias(s), *[F.col(c).alias(f"{s}_{c}") for c in columns])
        return wanted.join(_sized(pairs.select(s).distinct()), s, "left_semi")

    return pairs.join(side("a"), "a").join(side("b"), "b")


def _close(pairs: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs of nodes whose sketches (a_sketch, b_sketch, of equal length) do not rule them out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            most = distance((batch["a_n"] + batch["b_n"]).to_numpy(), percent)
            for at in batch.groupby(batch["a_sketch"].map(len)).indices.values():
                part = batch.iloc[at]
                apart = np.bitwise_count(_matrix(part["a_sketch"].tolist()) ^ _matrix(part["b_sketch"].tolist()))
                part = part[apart.sum(axis=1, dtype=np.int64) <= most[at]]
                yield pd.DataFrame({"a": part["a_node"], "b": part["b_node"]})

    found = pairs.select("a_node", "b_node", "a_n", "b_n", "a_sketch", "b_sketch").mapInPandas(run, "a string, b string")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def by_short_sketch(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b (nodes): the pairs of locators that sizes and short sketches do not rule out."""
    both = _sides(pairs, sets, "id", "node", "n", "short")
    near = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    both = both.filter(near & (F.col("a_node") != F.col("b_node")))
    return _close(both.withColumnsRenamed({"a_short": "a_sketch", "b_short": "b_sketch"}), percent)


def by_long_sketch(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs of nodes that their long sketches do not rule out either."""
    both = _sides(pairs, sets, "node", "band", "n", "own", "above")
    high = F.greatest("a_band", "b_band")
    fit = lambda s: F.when(F.col(f"{s}_band") == high, F.col(f"{s}_own")).otherwise(F.col(f"{s}_above"))
    both = both.withColumnsRenamed({"a": "a_node", "b": "b_node"}).withColumns({"a_sketch": fit("a"), "b_sketch": fit("b")})
    return _close(both, percent)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs of nodes whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("a_features"), batch.column("b_features")):
                # the sets are read where they lie in the batch
                both = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = _sides(pairs, sets, "node", "features").select("a", "b", "a_features", "b_features")
    return found.mapInArrow(run, "a string, b string")


def crossing(open_buckets: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of locators of one bucket and different components that sizes and short sketches do not rule out.

    A bucket of many sets is cut into blocks, and every two blocks meet in a group of their own.
    """
    sizes = open_buckets.groupBy("signature").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = open_buckets.join(sizes, "signature").withColumn("h", F.pmod(F.xxhash64("signature", "id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["signature", "low", "high"]
    rows = rows.select("signature", F.least("h", "other").alias("low"), F.greatest("h", "other").alias("high"), "h", "id", "component", "n", "short")
    placed = rows.repartition(*keys).sortWithinPartitions(*keys)

    def compared(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """The pairs of all groups in the rows, some at a time: every row with those behind it in its group."""
        low, high, h, n, ids = (rows[c].to_numpy() for c in ("low", "high", "h", "n", "id"))
        parts, parities = pd.factorize(rows["component"])[0], _matrix(rows["short"].tolist())
        new = np.concatenate([[True], ~_same(rows, keys), [True]])
        ends = np.flatnonzero(new)
        behind = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(rows)) - 1
        upto = np.cumsum(behind)
        at = 0
        while at < len(rows):
            done = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + PAIRS, side="right")))
            x = np.repeat(np.arange(at, to), behind[at:to])
            y = np.arange(len(x)) - np.repeat(np.concatenate([[0], np.cumsum(behind[at:to])[:-1]]), behind[at:to]) + x + 1
            some = (parts[x] != parts[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
            some &= (low[x] == high[x]) | (h[x] != h[y])
            x, y = x[some], y[some]
            apart = np.bitwise_count(parities[x] ^ parities[y]).sum(axis=1, dtype=np.int64)
            some = apart <= distance(n[x] + n[y], percent)
            first, second = ids[x[some]], ids[y[some]]
            pairs = pd.DataFrame({"a": np.minimum(first, second), "b": np.maximum(first, second)})
            yield pairs.drop_duplicates()
            at = to

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            whole = pd.concat([*held, batch], ignore_index=True) if held else batch.reset_index(drop=True)
            # the last group may go on in the next batch
            cut = np.flatnonzero(~_same(whole, keys))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            if cut:
                yield from compared(whole.iloc[:cut])
            held = [whole.iloc[cut:]]
        if held:
            yield from compared(held[0])

    return placed.mapInPandas(run, "a bigint, b bigint").distinct()


def _same(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Whether each row but the first has the keys of the row before it."""
    out = np.ones(max(0, len(rows) - 1), bool)
    for k in keys:
        column = rows[k].to_numpy()
        out &= column[1:] == column[:-1]
    return out


def links(docs: DataFrame, named: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """a, b (nodes): similar sets, enough of them to connect whatever similar pairs connect."""
    full = written(buckets(postings(docs, text_col, words, percent)), "buckets")
    sets = written(
        candidate_sets(docs, named, full.select("id").distinct(), id_col, text_col, words, percent), "sets"
    )
    ends = full.groupBy("signature").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    pair = lambda a, b: F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    star = full.join(ends, "signature").select(F.explode(F.array(pair("first", "id"), pair("id", "last"))).alias("p"))
    star = written(star.select("p.*").filter("a <> b").distinct(), "star")
    checked = written(by_short_sketch(star, sets, percent), "near")
    checked = written(by_long_sketch(checked, sets, percent), "checked")
    found = written(verified(checked, sets, percent), "links")
    parts = connected_components(found)
    lines = sets.select("id", "node", "n", "short").join(
        parts.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left"
    )
    # 16 bytes of a component's name instead of 32 digits
    lines = written(lines.select("id", F.unhex(F.coalesce("component", "node")).alias("component"), "n", "short"), "lines")
    several = (
        full.join(lines.select("id", "component"), "id").groupBy("signature")
        .agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("signature")
    )
    rest = written(full.join(several, "signature", "left_semi").join(lines, "id"), "open")
    more = written(crossing(rest, percent), "crossing")
    more = written(by_short_sketch(more, sets, percent).join(checked, ["a", "b"], "left_anti"), "more")
    return found.unionByName(verified(written(by_long_sketch(more, sets, percent), "most"), sets, percent))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, and with them node (the name of its set).

    Documents link when the Jaccard similarity of their sets of ``words``-word shingles is ``percent`` / 100 or more;
    component_id is the smallest doc_id reachable by links. A text with fewer words is one shingle; a text
    without words, or none, has an empty set, links with nothing and is its own component. A null id is
    no candidate for the smallest, so a group of none but null ids has a null component; rows that repeat an id each have
    a row and link by their texts; an empty table gives an empty result; other columns are not read.
    """
    named = written(named_sets(docs, id_col, text_col, words), "named")
    component = connected_components(written(links(docs, named, id_col, text_col, words, percent), "all_links"))
    groups = named.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    groups = groups.join(component.withColumnRenamed("node", "member"), F.col("node") == F.col("member"), "left").select(
        "node", "least", F.coalesce("component", "node").alias("component")
    )
    smallest = groups.groupBy("component").agg(F.min("least").alias("component_id")).withColumnRenamed("component", "c")
    by_node = groups.join(smallest, F.col("component") == F.col("c")).select(F.col("node").alias("of"), "component_id")
    return named.join(by_node, F.col("node") == F.col("of"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "node"
    )


@query()
def op11_ngram_jaccard_join(spark, sf):
    return similar_documents(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")

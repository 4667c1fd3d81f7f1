"""Brute-force versions of the training-data operators on rows held in memory."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, words=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = WORD.findall(lowered)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits=2):
    """Least reachable position of each position."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def repeats(texts, depth):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + depth] for b in raw for i in range(len(b) - depth + 1))
    out = []
    for b in raw:
        mark = bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if seen[b[i : i + depth]] > 1:
                mark[i : i + depth] = b"\1" * depth
        kept = bytes(x for x, m in zip(b, mark) if not m)
        spans = len(re.findall(b"\1+", bytes(mark)))
        out.append((len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


def quality(rows, min_documents, max_share, min_left=0.5):
    """rows of (text, host) -> (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, text left)."""

    def normal(line):
        line = re.sub(r"[1-9]", "0", line.lower())
        return re.sub(r"[\W_]+", " ", line).strip()

    lines = [[normal(x) for x in (t or "").split("\n")] for t, _ in rows]
    holders, hosts = defaultdict(set), defaultdict(set)
    for (t, host), own in zip(rows, lines):
        hosts[host].add(t or "")
        for x in own:
            if x:
                holders[host, x].add(t or "")
    out = []
    for (t, host), own in zip(rows, lines):
        given, t = t, t or ""
        words = WORD.findall(t)
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        inside = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
        full = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        bad = [
            x for x in own
            if x and len(holders[host, x]) > min_documents and len(holders[host, x]) > max_share * len(hosts[host])
        ]
        total, removed = sum(map(len, own)), sum(map(len, bad))
        out.append((
            len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(full) - len(set(full)),
            len(inside), failed, not failed and total - removed >= min_left * total,
            "\n".join(x for x, n in zip(t.split("\n"), own) if n not in bad) if bad else given,
        ))
    return out


def sainte_lague(votes, seats):
    """Seats one by one to the highest quotient, ties to the first party."""
    given = [0] * len(votes)
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        given[best] += 1
    return given


def capped_shares(sizes, weights, passes):
    """Share the sum of all sizes by weight, none above passes times its size."""
    target, open_ = {}, set(range(len(sizes)))
    while True:
        left = sum(sizes) - sum(target.values())
        weight = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / weight > passes * sizes[i]} if weight else set()
        if not over:
            return [target.get(i, left * weights[i] / weight if i in open_ else 0.0) for i in range(len(sizes))]
        target |= {i: float(passes * sizes[i]) for i in over}
        open_ -= over


def cut(ids, capacity):
    first = len(ids) % capacity or capacity
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, s, e - s, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[s:e]))) for k, (s, e) in enumerate(zip(cuts, cuts[1:]))]

"""Packing gives back the tokens, also of documents that come more than once."""

from __future__ import annotations

from collections import defaultdict

from hypothesis import given, settings, strategies as st

from glyphline.llm import packing

SCHEMA = "doc_id bigint, text string"


def test_sequences_and_documents_come_back_from_the_pieces(spark):
    rows = [(1, "some words here " * 40), (1, "some words"), (2, None), (None, "é 日本 words " * 9), (1, "some words"), (3, "x <|endoftext|> y")]
    exact = packing.Tokenizer.from_file(packing.public_tokenizers.path(packing.TOKENIZER))
    found = packing.pack(spark.createDataFrame(rows, SCHEMA), capacity=32).collect()
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert len(r["ids"]) == r["length"]
        documents[r["row"], r["doc_id"]].append((r["start"], r["ids"]))
        sequences[r["sequence_id"]].append((r["offset"], r["ids"]))
    whole = [(i, [x for _, ids in sorted(parts) for x in ids]) for (_, i), parts in documents.items()]
    expected = [(i, [*exact.encode(t or "", add_special_tokens=False).ids, packing.END]) for i, t in rows]
    assert sorted(whole, key=repr) == sorted(expected, key=repr)
    for parts in sequences.values():
        at = 0
        for offset, ids in sorted(parts):
            assert offset == at
            at += len(ids)
        assert at <= 32


PATH = packing.public_tokenizers.path(packing.TOKENIZER)
EXACT = packing.Tokenizer.from_file(PATH)
ODD = st.sampled_from(["  ", " \n", "\u00a0", "\u3000", "\x1c", "\x85", "'s", "'LL", "\u200d", "\ufeff", "e\u0301", "１２", "½", "<|endoftext|>", "🇫🇷"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), ODD, st.text(st.characters(min_codepoint=32, max_codepoint=126), max_size=12))).map("".join))
def test_ids_are_those_of_the_tokenizer(text):
    assert packing.encode(text, PATH).tolist() == EXACT.encode(text, add_special_tokens=False).ids

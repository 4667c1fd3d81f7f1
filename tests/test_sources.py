"""Readers, writers, audits and the cache on hand-made files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glyphline.sources import audit, csv, files, tables


@pytest.fixture
def folder(tmp_path):
    def write(**contents: bytes | str):
        for name, data in contents.items():
            (tmp_path / f"{name}.csv").write_bytes(data if isinstance(data, bytes) else data.encode())
        return f"{tmp_path}/*.csv"

    return write


RAGGED = 'User,Text\nu1\nu2,a,b\nu3,x\nu4,"q ""w"", z\nnl"\nu5,a,\nu6,a,,\nu7,\n'


def test_long_rows_are_skipped_and_short_ones_padded(spark, folder, rows):
    read = csv.read_csv_robust(spark, folder(fire=RAGGED), ["User", "Text"])
    assert rows(read, "User", "Text") == [("u1", None), ("u3", "x"), ("u4", 'q "w", z\nnl'), ("u7", None)]


def test_trailing_empty_cells_are_not_surplus(spark, folder, rows):
    read = csv.read_csv_robust(spark, folder(a="A,B,C\n1,,\n2,,,\n3,,,,\n4,x,\n"), ["A", "B"])
    assert rows(read, "A", "B") == [("1", None), ("4", "x")]


def test_keep_all_rows(spark, folder, rows):
    read = csv.read_csv_robust(spark, folder(fire=RAGGED), ["User"], bad_rows="keep")
    assert [u for (u,) in rows(read, "User")] == ["u1", "u2", "u3", "u4", "u5", "u6", "u7"]


def test_columns_are_found_by_name_and_labels_by_stem(spark, folder, rows):
    glob = folder(
        fire="User,Text\nu1,hot\n",
        **{"smiling_face_with_heart-eyes": 'Text,Id,User\n"a, b",7,u2\n', "two words": "Text\nsplit\n"},
    )
    assert rows(csv.read_labelled_dir(spark, glob)) == [
        ("fire", "hot"), ("smiling_face_with_heart-eyes", "a, b"), ("two words", "split"),
    ]
    with pytest.raises(ValueError, match="no column"):
        csv.read_labelled_dir(spark, glob, "Body")


def test_fallback_encoding_and_byte_order_mark(spark, folder, rows):
    glob = folder(
        latin="User,Text\nu1,ok\nu2,caf\xe9 \x80 \x81\n".encode("latin-1"),
        bom=b"\xef\xbb\xbfText,User\ncaf\xc3\xa9,u3\n",
    )
    assert rows(csv.read_labelled_dir(spark, glob)) == [("bom", "café"), ("latin", "café € �"), ("latin", "ok")]
    profiled = {r["file"].rsplit("/", 1)[1]: r["utf8"] for r in files.profile_files(spark, glob).collect()}
    assert profiled == {"latin.csv": False, "bom.csv": True}


def test_missing_texts_are_null(spark, folder, rows):
    glob = folder(a="Text\nNaN\nnone\nNone\nN/A\n")
    assert rows(csv.read_labelled_dir(spark, glob), "text") == [("none",), (None,), (None,), (None,)]


def test_column_names():
    assert files.column_names("﻿A,\"b, c\",,A\r") == ["A", "b, c", "Unnamed: 2", "A.1"]


def test_reviews_round_trip(spark, reviews, tmp_path, rows):
    tables.write_rows(reviews, f"{tmp_path}/reviews", "csv")
    types = {"review_id": "bigint", "rating": "double"}
    assert rows(csv.read_reviews(spark, f"{tmp_path}/reviews", types)) == rows(reviews)


def test_nested_columns_reach_csv_as_json(spark, tmp_path, rows):
    df = spark.sql("SELECT 1 AS id, array('a', 'b') AS l, named_struct('x', 1) AS s, map('k', 2) AS m")
    tables.write_rows(df, f"{tmp_path}/nested", "csv")
    assert rows(csv.read_reviews(spark, f"{tmp_path}/nested", {})) == [("1", '["a","b"]', '{"x":1}', '{"k":2}')]


def test_parquet_round_trip_keeps_the_partition_column(spark, reviews, tmp_path):
    tables.write_rows(reviews, f"{tmp_path}/landed", partition_by=("item_id",))
    read = tables.read_dataset(spark, f"{tmp_path}/landed").filter("item_id = 'A'")
    assert read.count() == 3
    assert "PartitionFilters: [isnotnull(item_id" in read._jdf.queryExecution().toString()


def test_wordlist(spark, tmp_path, rows):
    (tmp_path / "words.txt").write_bytes(b"Good\r\n\n  bad \ngood\n\t\na+\n")
    assert rows(tables.read_wordlist(spark, f"{tmp_path}/words.txt")) == [("a+",), ("bad",), ("good",)]


def test_cache_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert tables.labelled_or_compute(spark, f"{tmp_path}/cache", compute).count() == 3
    assert calls == [1]


def test_encoding_audit(spark, folder):
    glob = folder(good="User,Text\nu1,café\n", bad=b"User,Text\nu1,ok\n\nu2,\xc3\xa9caf\xe9 xy\nu3,\xff\n")
    found = {r["file"].rsplit("/", 1)[1]: r for r in audit.audit_encoding(spark, glob).collect()}
    bad = found["bad.csv"]
    assert (bad["lines"], bad["bad_lines"], bad["first_bad_line"], bad["byte_offset"]) == (5, 2, 4, 8)
    assert bytes.fromhex(bad["bad_bytes"]) == b"\xe9 xy"
    good = found["good.csv"]
    assert (good["bad_lines"], good["first_bad_line"], good["bad_bytes"]) == (0, None, None)


def test_encoding_audit_counts_lines_over_blocks(spark, tmp_path):
    lines = [b"x" * 40] * 3000
    lines[2500] = b"caf\xe9"
    (tmp_path / "big.csv").write_bytes(b"\n".join(lines) + b"\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        (row,) = audit.audit_encoding(spark, f"{tmp_path}/*.csv").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (row["lines"], row["bad_lines"], row["first_bad_line"], row["byte_offset"]) == (3000, 1, 2501, 3)


def test_column_audit(spark, folder, rows):
    found = audit.audit_columns(spark, folder(fire=RAGGED, fine="A,B,C\n1,2,3\n"))
    assert rows(found, "record", "n_fields", "expected", "preview") == [
        (2, 1, 2, "u1"), (3, 3, 2, "u2,a,b"), (6, 3, 2, "u5,a,"), (7, 4, 2, "u6,a,,"),
    ]
    assert {r["f"] for r in found.select(F.substring_index("file", "/", -1).alias("f")).collect()} == {"fire.csv"}


def test_long_quoted_records_are_counted(spark, folder, rows):
    text = 'long "quoted", text ' * 20_000
    line = "u1,\"" + text.replace('"', '""') + "\",,\n"
    assert rows(audit.audit_columns(spark, folder(a="User,Text\n" + line)), "n_fields") == [(4,)]


def _files(folder, **contents):
    folder.mkdir(parents=True, exist_ok=True)
    for name, data in contents.items():
        (folder / f"{name}.csv").write_bytes(data)
    return str(folder)


def test_reviews_are_read_by_name(spark, tmp_path, rows):
    folder = _files(tmp_path / "r", a=b"review_id,text\n1,a\n", b=b"text,review_id\nb,2\n")
    read = csv.read_reviews(spark, f"{folder}/*.csv", {"review_id": "bigint"})
    assert rows(read, "review_id", "text") == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("bad", [b"a,b\n1,2\n3,4,5\n", b"a,b\n1,2\n3,4,5,6,7\n", b"a,b\n1,2\n3,4,,\n"])
def test_strict_reading_refuses_surplus_fields(spark, tmp_path, bad):
    folder = _files(tmp_path / "r", a=bad)
    with pytest.raises(Exception, match="more fields than the header"):
        csv.read_reviews(spark, folder).collect()
    assert csv.read_reviews(spark, folder, bad_rows="skip_long").count() == 1


def test_strict_reading_takes_ordinary_rows(spark, tmp_path, rows):
    folder = _files(tmp_path / "r", a=b'a,b\n1,"x, ""y""\nz"\n2\n,\n')
    assert rows(csv.read_reviews(spark, folder)) == [("1", 'x, "y"\nz'), ("2", None), (None, None)]


def test_strict_reading_refuses_other_encodings_and_columns(spark, tmp_path, rows):
    folder = _files(tmp_path / "r", a=b"a\ncaf\xe9\n")
    with pytest.raises(ValueError, match="not valid UTF-8"):
        csv.read_reviews(spark, folder)
    assert rows(csv.read_reviews(spark, folder, fallback="windows-1252")) == [("café",)]
    other = _files(tmp_path / "o", a=b"a,b\n1,2\n", b=b"a,c\n1,2\n")
    with pytest.raises(ValueError, match="other columns|no column"):
        csv.read_reviews(spark, f"{other}/*.csv")


def test_file_names_with_glob_characters(spark, tmp_path, rows):
    folder = _files(tmp_path / "g", **{"a[1]": b"Text\none\n", "b{x}*?": b"Text\ntwo\n", "c d%20+": b"Text\nthree\n"})
    read = csv.read_labelled_dir(spark, folder)
    assert rows(read, "label", "text") == [("a[1]", "one"), ("b{x}*?", "two"), ("c d%20+", "three")]
    assert audit.audit_columns(spark, folder).count() == 0

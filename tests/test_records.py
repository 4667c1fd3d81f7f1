"""Records of CSV files found block by block, against Spark's own multi-line reader."""

from __future__ import annotations

import random

import pytest

from glyphline.sources import audit, csv, records


@pytest.fixture(params=["7", "64", "1g"])
def blocks(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _cells(rng, n):
    pieces = ["a", "word", "é", "ß 日本", ",", '""', "\n", "\n\n", "\r", " ", "😂", "x,y", '"",""']
    return ["".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(n)]


def _file(rng, n, end="\n", last=True):
    lines = ["id,text,other"]
    for i in range(n):
        cells = [f'"{c}"' for c in _cells(rng, rng.choice([2, 2, 2, 2, 1, 3, 4]))]
        lines.append(",".join([str(i), *cells]))
        if rng.random() < 0.1:
            lines.append("")
    return (end.join(lines) + (end if last else "")).encode()


FILES = {
    "empty": b"id,text,other\n",
    "no_end": b'id,text,other\n1,a,b\n2,"x\ny",',
    "blank": b'id,text,other\n\n\n1,"\n\n",b\n\n2,,\n',
    "bom": "﻿id,text,other\n1,\"é\n\",b\n".encode(),
    "many": _file(random.Random(1), 60),
    "open_end": _file(random.Random(2), 25, last=False),
}


@pytest.fixture
def folder(tmp_path):
    for name, data in FILES.items():
        (tmp_path / f"{name}.csv").write_bytes(data.replace(b"\r", b""))
    (tmp_path / "crlf.csv").write_bytes(_file(random.Random(3), 30).replace(b"\r", b"").replace(b"\n", b"\r\n"))
    (tmp_path / "latin.csv").write_bytes('id,text,other\n1,"café\n\u0080",x\n2,b,ÿ\n'.encode("latin-1"))
    return f"{tmp_path}/*.csv"


@pytest.mark.parametrize("bad_rows", ["skip_long", "keep"])
def test_equal_to_the_multi_line_reader(spark, folder, blocks, rows, bad_rows):
    read = lambda by_blocks: rows(
        csv.read_csv_robust(spark, folder, ["id", "text", "other"], bad_rows=bad_rows, by_blocks=by_blocks)
    )
    found = read(True)
    assert found == read(False)
    assert len(found) > 60


def test_audit_equals_that_of_the_multi_line_reader(spark, folder, blocks, rows):
    columns = ["file", "record", "n_fields", "expected", "preview"]
    found = rows(audit.audit_columns(spark, folder, by_blocks=True), *columns)
    assert found == rows(audit.audit_columns(spark, folder), *columns)
    assert len(found) > 10


def test_one_file_is_read_by_many_tasks(spark, tmp_path, blocks):
    (tmp_path / "one.csv").write_bytes(_file(random.Random(5), 400).replace(b"\r", b""))
    lines = records.numbered_lines(spark, str(tmp_path / "one.csv"))
    held = lines.select("file", "block").distinct().count()
    assert held < 10 if blocks == "1g" else held > 50
    halves = records.csv_records(spark, str(tmp_path / "one.csv"))
    assert halves.count() == 401
    assert [r["record"] for r in halves.orderBy("record").collect()] == list(range(1, 402))


def test_a_record_over_many_blocks(spark, tmp_path, blocks, rows):
    text = "line of a long text\n" * 50
    (tmp_path / "long.csv").write_text(f'id,text\n1,"{text}"\n2,short\n')
    read = csv.read_csv_robust(spark, str(tmp_path / "long.csv"), by_blocks=True)
    assert rows(read, "id", "text") == [("1", text), ("2", "short")]


def test_an_odd_number_of_quotes_is_an_error(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('id,text\n1,"a\n2,b\n')
    with pytest.raises(Exception, match="odd number of quotes"):
        csv.read_csv_robust(spark, str(tmp_path / "odd.csv"), by_blocks=True).collect()


def test_labels_and_strict_reviews(spark, tmp_path, rows):
    (tmp_path / "fire.csv").write_text('Text,n\n"hot\nhot",1\n')
    assert rows(csv.read_labelled_dir(spark, f"{tmp_path}/*.csv", by_blocks=True)) == [("fire", "hot\nhot")]
    assert rows(csv.read_reviews(spark, f"{tmp_path}/fire.csv", {"n": "bigint"}, by_blocks=True)) == [("hot\nhot", 1)]
    (tmp_path / "fire.csv").write_text('Text,n\n"hot\nhot",1,2\n')
    with pytest.raises(Exception, match="more fields than the header"):
        csv.read_reviews(spark, f"{tmp_path}/fire.csv", by_blocks=True).collect()


def test_lines_are_shuffled_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,a\n")
    plan = records.csv_records(spark, str(tmp_path / "a.csv"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan

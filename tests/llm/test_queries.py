"""The registered training-data queries against their SQL, on whole small tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from glyphline.llm.catalog import CATALOG  # noqa: E402
from oracle import compare, connect  # noqa: E402


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in CATALOG.items() if sql))
def test_query_equals_its_sql(spark, sf_dir, name):
    run, sql = CATALOG[name]
    assert compare(run(spark, sf_dir), connect(sf_dir), sql) is None


def test_every_operator_and_the_pipeline_are_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run
    assert 4 <= len(corpus_pipeline.STAGES) <= 5

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for entry in (str(ROOT), str(ROOT / "tests")):
    if entry not in sys.path:
        sys.path.insert(0, entry)

from glyphline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "glyphline-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def reviews(spark):
    """The hand-made reviews of FIXTURES.md 3.1."""
    return spark.createDataFrame(
        [
            (1, "Great 😂", "loved it 😂😂 🔥", 5.0, "A", "['Movies & TV', 'Comedy']"),
            (2, None, "so sad 😭", 1.0, "B", "Drama"),
            (3, "Meh", "👍🏽 fine 😂", 3.0, "A", "Drama, Indie"),
            (4, "Plain", "no symbols", 4.0, "A", "Comedy"),
            (5, "Flag", "🇫🇷 only", 2.0, "C", None),
            (6, "Fire", "🔥😂", None, "B", "Comedy"),
        ],
        "review_id bigint, title string, text string, rating double, item_id string, categories string",
    )


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, doubles rounded."""

    def plain(value):
        return round(value, 6) if isinstance(value, float) else value

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=repr)

    return collect

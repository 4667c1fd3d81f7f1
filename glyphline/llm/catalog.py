"""The queries of the training-data operators, by name."""

from __future__ import annotations

from glyphline.llm import (  # noqa: F401
    jaccard, licenses, mixing, neighbours, packing, periods, quality, secrets, simhash, suffixes, toxicity, warc, whitening,
)
from glyphline.llm.common import CATALOG

__all__ = ["CATALOG"]

"""All queries of the corpus operators and their SQL counterparts."""

from __future__ import annotations

from . import (  # noqa: F401  each module registers its query
    decontamination, exact_dedup, jaccard_join, language, lexical_search, minhash_dedup, packing, pii, quality, substring_dedup,
    suffix_dedup, warc, whitening,
)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

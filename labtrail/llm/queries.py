"""All queries of this package; importing the modules registers them."""

import corpus_pipeline  # noqa: F401
from labtrail.llm import (  # noqa: F401
    codes, exact, jaccard, licenses, mixing, packing, pii, quality, rules, spelling, topk, toxicity, urls,
)
from labtrail.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries of this subpackage."""

from pyspark import cloudpickle

from . import (  # noqa: F401
    byte_bpe, chat, common, hard_negatives, near_dup, periodic, pieces, q_archives, q_duplicates, q_filters, q_tokens, suffix_dedup, topk, toxicity,
    warc, whole,
)
from .registry import LLM_QUERIES  # noqa: F401

# Modules with Python tasks travel with them, so workers need no installed package.
for _module in (byte_bpe, chat, common, hard_negatives, near_dup, periodic, pieces, suffix_dedup, topk, toxicity, warc, whole):
    cloudpickle.register_pickle_by_value(_module)

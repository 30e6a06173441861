"""The registered queries of the training-data operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (collocations, conversations, licenses, mixing, nearest, packing, pii, sharding, simhash, spotsigs,
               token_count, toxicity, url_filter)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": lambda s, d: toxicity.score_documents(read(s, d, "documents"), read(s, d, "labels")),
    "op2_sharding": lambda s, d: sharding.shard_documents(read(s, d, "documents")),
    "op3_mixing": lambda s, d: mixing.mix_documents(read(s, d, "documents")),
    "op4_spotsigs": lambda s, d: spotsigs.compare_with_edits(read(s, d, "documents")),
    "op5_packing": lambda s, d: packing.pack_documents(read(s, d, "documents")),
    "op6_licenses": lambda s, d: licenses.scan_documents(read(s, d, "documents")),
    "op7_simhash": lambda s, d: simhash.label_documents(read(s, d, "documents")),
    "op8_url_filter": lambda s, d: url_filter.judge_pages(read(s, d, "pages")),
    "op9_nearest": lambda s, d: nearest.search(read(s, d, "embeddings")),
    "op10_token_counts": lambda s, d: token_count.count_tokens(read(s, d, "documents")),
    "op11_personal_data": lambda s, d: pii.find_personal_data(read(s, d, "documents")),
    "op12_conversations": lambda s, d: conversations.repair_damaged(read(s, d, "conversations")),
    "op13_collocations": lambda s, d: collocations.mine(read(s, d, "documents")),
}

# Where SQL can express the operator; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {"op8_url_filter": url_filter.ORACLE_SQL}

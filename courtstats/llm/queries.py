"""All queries of this subpackage and of the corpus pipeline, for the entry module."""

import corpus_pipeline

from . import (  # noqa: F401
    alignment,
    bpe,
    chat,
    decontaminate,
    hard_negatives,
    hashing_index,
    line_dedup,
    private_data,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    token_files,
)
from .common import ORACLES, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

"""Raw documents to encoded training text, stage by stage.

Each stage gets what its predecessor kept, as a table written and read again. All but the last return the
columns of ``documents``; the last adds the number of tokens and the digests of ids and decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from depositlens.llm import bpe_lexicon, decontaminate, pii_surrogates, ppm_language, simhash_balls
from depositlens.llm.common import forget, read, settle

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without text or letters go."""
    return ppm_language.keep_known_languages(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the document with the smallest id."""
    return simhash_balls.drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and secrets replaced in their text."""
    return pii_surrogates.replace_personal_data(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with n_tokens, ids_sha256 and decoded_sha256 of their encoded text."""
    return bpe_lexicon.encode(docs, TOKENIZER, digest=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("bpe", bpe),
]

#: No SQL: fingerprints, language model, surrogates and token ids are beyond it; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. An empty table, NULLs and repeated rows are treated as each operator says."""
    docs, old = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
        if old is not None:
            forget(old)
        old = docs
    return docs

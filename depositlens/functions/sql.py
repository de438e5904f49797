"""The text functions by name, for SQL: ``SELECT text_sentiment(voice_text) FROM ...``.

All but the summary are SQL functions, whose bodies the optimizer inlines into the query like any other
expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from depositlens.functions import lexicon
from depositlens.functions.masking import mask_sql
from depositlens.functions.summary import summary_function


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sentiment() -> str:
    patterns = lexicon.side_patterns(lexicon.POSITIVE_TERMS, lexicon.NEGATIVE_TERMS)
    good, bad = (f"regexp_like(found, {_literal(pattern)})" for pattern in patterns)
    token = lexicon.token_pattern([*lexicon.POSITIVE_TERMS, *lexicon.NEGATIVE_TERMS])
    label = (
        f"CASE WHEN found IS NULL THEN NULL WHEN {good} AND {bad} THEN '{lexicon.MIXED}'"
        f" WHEN {good} THEN '{lexicon.POSITIVE}' WHEN {bad} THEN '{lexicon.NEGATIVE}' ELSE '{lexicon.NEUTRAL}' END"
    )
    return f"element_at(transform(array(array_join(regexp_extract_all(txt, {_literal(token)}, 1), ' ')), found -> {label}), 1)"


def register(spark: SparkSession) -> None:
    """Create the functions for this session: text_sentiment, text_mask, phone_mask, text_summary."""
    bodies = {
        "text_sentiment": _sentiment(),
        "text_mask": mask_sql("txt"),
        "phone_mask": "regexp_replace(txt, '\\\\p{Nd}', '*')",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING) RETURNS STRING RETURN {body}")
    spark.udf.register("text_summary", summary_function(3))

"""Customer comments and other free text: label, classify, summarise, mask, count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depositlens.functions import lexicon
from depositlens.functions.masking import PERSONAL_DATA_RULES, MaskRule, mask_text
from depositlens.functions.summary import summary


def voice_sentiment(
    voice: DataFrame,
    text: str = "voice_text",
    positive: Sequence[str] = lexicon.POSITIVE_TERMS,
    negative: Sequence[str] = lexicon.NEGATIVE_TERMS,
) -> DataFrame:
    return voice.withColumn("sentiment", lexicon.sentiment(F.col(text), positive, negative))


def sentiment_counts(voice: DataFrame) -> DataFrame:
    """Comments per label, for the labels that occur."""
    return voice.groupBy("sentiment").agg(F.count("*").alias("comments"))


def negative_by_channel(voice: DataFrame) -> DataFrame:
    """Negative comments per channel, most first; channels without any are left out.

    Counted by condition, not filtered first: a filter on the label would be pushed below the labelling when
    both are in one plan, and repeat its work for every term.
    """
    return (
        voice.groupBy("channel")
        .agg(F.count_if(F.col("sentiment") == lexicon.NEGATIVE).alias("comments"))
        .filter(F.col("comments") > 0)
        .orderBy(F.desc("comments"), "channel")
    )


def negative_samples(voice: DataFrame, rows: int = 5) -> DataFrame:
    """A few negative comments, the latest first."""
    return (
        voice.filter(F.col("sentiment") == lexicon.NEGATIVE)
        .orderBy(F.desc("received_date"), "voice_id")
        .limit(rows)
    )


def classify_by_words(
    df: DataFrame, text: str, categories: Mapping[str, Sequence[str]], output: str = "category"
) -> DataFrame:
    """The category whose words occur most often in the text."""
    known = sorted({term for terms in categories.values() for term in terms})
    tokens = df.withColumn("__words", lexicon.words_among(F.col(text), known))
    columns = {name: f"__hits_{name}" for name in categories}
    counted = tokens.withColumns(
        {columns[name]: lexicon.word_hits(F.col("__words"), terms) for name, terms in categories.items()}
    )
    return counted.withColumn(output, _pick(text, columns)).drop("__words", *columns.values())


def classify_by_substrings(
    df: DataFrame,
    text: str = "voice_text",
    categories: Mapping[str, Sequence[str]] = lexicon.COMMENT_CATEGORIES,
    output: str = "category",
) -> DataFrame:
    """The same for texts without spaces: the category whose terms occur most often as substrings."""
    columns = {name: f"__hits_{name}" for name in categories}
    counted = df.withColumns(
        {columns[name]: lexicon.substring_hits(F.col(text), terms) for name, terms in categories.items()}
    )
    return counted.withColumn(output, _pick(text, columns)).drop(*columns.values())


def _pick(text: str, columns: Mapping[str, str]) -> Column:
    hits = {name: F.col(column) for name, column in columns.items()}
    return F.when(F.col(text).isNotNull(), lexicon.best_category(hits))


def mask_personal_data(
    df: DataFrame, text: str, rules: Sequence[MaskRule] = PERSONAL_DATA_RULES
) -> DataFrame:
    return df.withColumn(text, mask_text(F.col(text), rules))


def summarise(df: DataFrame, text: str, sentences: int = 3, output: str = "summary") -> DataFrame:
    return df.withColumn(output, summary(F.col(text), sentences))

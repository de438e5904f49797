"""Labels of the caller's own, learned from labelled texts: a multinomial classifier over hashed words or character n-grams.

All labelled texts count. A model is one row per hash slot, ``SLOTS`` at most, with a whole number per label, so its size is known
beforehand and it may be broadcast; sums are integers and come out the same in any order. Scoring sends one row per text over the network.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depositlens.functions.lexicon import WORD_SEPARATOR
from depositlens.sources.shared import fresh_path

# Four hexadecimal digits of a digest name a slot; scores are thousandths.
SLOT_DIGITS = 4
SLOTS = 16**SLOT_DIGITS
SCALE = 1000
MAX_LABELS = 64


@dataclass(frozen=True)
class LabelModel:
    """``slots``: (slot, gains), at most ``SLOTS`` rows; per label what each text of it starts with and what each term costs."""

    slots: DataFrame
    labels: tuple[str, ...]
    priors: tuple[int, ...]
    costs: tuple[int, ...]
    chars: int | None


def terms(text: Column, chars: int | None = None) -> Column:
    """The words of a text, lower-cased, or with ``chars`` all runs of so many characters that are not white space, for texts without spaces."""
    if chars is None:
        return F.array_remove(F.split(F.lower(text), WORD_SEPARATOR), "")
    return F.regexp_extract_all(F.lower(text), F.lit(rf"(?=(\S{{{chars:d}}}))"), F.lit(1))


def _slot(term: Column) -> Column:
    return F.substring(F.md5(term), 1, SLOT_DIGITS)


def fit_labels(
    examples: DataFrame,
    text: str,
    label: str,
    chars: int | None = None,
    max_labels: int = MAX_LABELS,
    judged: DataFrame | None = None,
    key: str | None = None,
) -> LabelModel:
    """Learn from all rows whose text and label are not missing; labels are taken as text, in ASCII order.

    ``label`` is a column of ``examples``, or of ``judged``, which tells texts by ``key``; then a text counts once for each of its rows there. Texts are read once: uses per label and slot are written below the shared
    folder and are all that the model reads. A label's name and counts go through the driver, ``max_labels`` of them at most; more are an error,
    so is no labelled text at all.
    """
    spark = examples.sparkSession
    words = F.col(f"`{text}`").alias("text")
    named = F.col(f"`{label}`").cast("string").alias("label")
    if judged is None:
        met = examples.select(named, words)
    else:
        met = examples.select(F.col(f"`{key}`").alias("key"), words).join(judged.select(F.col(f"`{key}`").alias("key"), named), "key")
    path = fresh_path(spark, "label-uses")
    (
        met.where("label IS NOT NULL AND text IS NOT NULL")
        .select("label", F.explode(F.array_append(terms(F.col("text"), chars), F.lit(None).cast("string"))).alias("term"))
        .groupBy("label", _slot(F.col("term")).alias("slot"))  # the missing slot counts texts
        .agg(F.count("*").alias("uses"))
        .write.parquet(path)
    )
    uses = spark.read.schema("label string, slot string, uses long").parquet(path)
    of_texts = F.sum(F.when(F.col("slot").isNull(), F.col("uses")).otherwise(0)).alias("texts")
    of_terms = F.sum(F.when(F.col("slot").isNotNull(), F.col("uses")).otherwise(0)).alias("terms")
    rows = sorted(uses.groupBy("label").agg(of_texts, of_terms).limit(max_labels + 1).collect())
    if not rows:
        raise ValueError("no labelled text to learn from")
    if len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} labels")
    texts = sum(row.texts for row in rows)
    priors = tuple(floor(SCALE * log(row.texts / texts)) for row in rows)
    costs = tuple(floor(SCALE * log(row.terms + SLOTS)) for row in rows)
    used = (F.coalesce(F.sum(F.when(F.col("label") == row.label, F.col("uses"))), F.lit(0)) for row in rows)
    gains = F.array(*(F.floor(F.lit(SCALE) * F.log(n + 1)).cast("long") for n in used))
    by_slot = uses.where("slot IS NOT NULL").groupBy("slot").agg(gains.alias("gains"))
    return LabelModel(by_slot, tuple(row.label for row in rows), priors, costs, chars)


def assign_labels(df: DataFrame, model: LabelModel, key: str, text: str, output: str = "label") -> DataFrame:
    """(key, label, margin): the most likely label of each text and its lead over the second, in thousandths of a natural logarithm.

    A missing text has no label; a text without terms gets the most frequent one. Of equal labels the ASCII-least wins; with one label
    there is no margin. ``key`` tells texts apart: rows with the same key count as one text, missing keys too.
    """
    places = range(len(model.labels))
    asked = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").isNotNull().alias("there"), F.explode_outer(terms(F.col(f"`{text}`"), model.chars)).alias("term")
    ).withColumn("slot", _slot(F.col("term")))
    gain = lambda i: F.coalesce(F.get("gains", F.lit(i)), F.lit(0)) - F.when(F.col("slot").isNotNull(), F.lit(model.costs[i])).otherwise(0)
    sums = (
        asked.join(F.broadcast(model.slots), "slot", "left")
        .groupBy("key")
        .agg(F.max("there").alias("there"), *(F.sum(gain(i)).alias(f"score_{i}") for i in places))
    )
    scores = [F.struct((F.col(f"score_{i}") + model.priors[i]).alias("score"), F.lit(-i).alias("place")) for i in places]
    ranked = sums.withColumn("ranked", F.sort_array(F.array(*scores), asc=False))
    names = F.array(*(F.lit(name) for name in model.labels))
    best, second = F.get("ranked", F.lit(0)), F.get("ranked", F.lit(1))
    return ranked.select(
        F.col("key").alias(key),
        F.when(F.col("there"), F.get(names, -best["place"])).alias(output),
        F.when(F.col("there"), best["score"] - second["score"]).alias("margin"),
    )

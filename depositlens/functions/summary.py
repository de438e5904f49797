"""Extractive summary of a text.

The one operator that leaves the JVM. Counting the words of each text with built-in functions means either
exploding all texts to word rows and shuffling and sorting those, or a chain of array functions that Spark
interprets element by element; both took about four times the core time of this Arrow-batched function,
which needs no shuffle either.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE = r"[^.!?。！？\n]+[.!?。！？]*"


def summary(text: Column, sentences: int = 3) -> Column:
    """The sentences with the most typical words, in text order.

    A sentence scores the mean frequency, in the whole text, of its words; the earlier one wins a tie. A
    text without words has an empty summary, NULL stays NULL.
    """
    return summary_function(sentences)(text)


def summary_function(sentences: int) -> Callable[[Column], Column]:
    sentence_pattern = SENTENCE

    # Nested, so that it travels to the executors by value and they need not have this package.
    def words(sentence: str) -> list[str]:
        found = re.findall(r"[^\W\d_]+", sentence)
        if all(map(str.isalpha, found)):
            return found
        return "".join(char if char.isalpha() else " " for char in sentence).split()

    def shorten(text: str) -> str:
        parts = [part for part in (found.strip(" ") for found in re.findall(sentence_pattern, text)) if part]
        spoken = [words(part.lower()) for part in parts]
        uses = Counter(word for sentence in spoken for word in sentence)
        scores = [
            (-sum(map(uses.__getitem__, sentence)) / len(sentence), index)
            for index, sentence in enumerate(spoken)
            if sentence
        ]
        best = sorted(index for _, index in sorted(scores)[:sentences])
        return " ".join(parts[index] for index in best)

    @F.pandas_udf("string")
    def summarise(texts: pd.Series) -> pd.Series:
        return texts.map(shorten, na_action="ignore")

    return summarise

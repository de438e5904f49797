import hashlib
import re
from collections import Counter
from math import floor, log

import pytest
from pyspark.sql import functions as F

from depositlens.functions import lexicon
from depositlens.operators import labelling, voice
from tests import data

EXAMPLES = [
    ("the branch was closed again", "hours"), ("closed on Friday", "hours"), ("open longer please", "hours"),
    ("the app does not open", "app"), ("login to the app fails", "app"), (None, "app"), ("lost", None), ("", "empty"),
]


def brute(examples, texts, split):
    slot = lambda word: hashlib.md5(word.encode()).hexdigest()[:4]
    uses, texts_of = {}, Counter()
    for text, label in examples:
        if text is not None and label is not None:
            texts_of[label] += 1
            uses.setdefault(label, Counter()).update(map(slot, split(text)))
    total = texts_of.total()
    results = []
    for text in texts:
        if text is None:
            results.append((None, None))
            continue
        scores = []
        for label in sorted(texts_of):
            cost = floor(1000 * log(uses[label].total() + 65_536))
            score = floor(1000 * log(texts_of[label] / total)) + sum(floor(1000 * log(uses[label][slot(w)] + 1)) - cost for w in split(text))
            scores.append((-score, label))
        scores.sort()
        results.append((scores[0][1], scores[1][0] - scores[0][0] if len(scores) > 1 else None))
    return results


def labelled(spark, examples, texts, chars=None):
    model = labelling.fit_labels(spark.createDataFrame(examples, "text string, label string"), "text", "label", chars)
    rows = spark.createDataFrame(list(enumerate(texts)), "label int, there string")  # names the operator uses itself
    found = labelling.assign_labels(rows, model, "label", "there", "assigned").collect()
    return [(row.assigned, row.margin) for row in sorted(found)]


def test_words_against_brute_force(spark):
    texts = ["Closed, closed; CLOSED!", "my login", "", None, "zzz", "the the app", "open"] + [text for text, _ in EXAMPLES]
    split = lambda text: [w for w in re.split(r"[\W\d_]+", text.lower()) if w]
    found = labelled(spark, EXAMPLES, texts)
    assert found == brute(EXAMPLES, texts, split)
    assert [label for label, _ in found[:4]] == ["hours", "app", "hours", None]


def test_character_runs_for_texts_without_spaces(spark):
    examples = [("待ち時間が長い", "waiting"), ("かなり待ちました", "waiting"), ("アプリが開かない", "app"), ("アプリの更新", "app")]
    texts = ["待ちました", "新しいアプリ", "𠮷𠮷 待ち", "ち", None]
    split = lambda text: [text[i : i + 2] for i in range(len(text) - 1) if not re.search(r"\s", text[i : i + 2])]
    found = labelled(spark, examples, texts, chars=2)
    assert found == brute(examples, texts, split)
    assert [label for label, _ in found[:2]] == ["waiting", "app"]


def test_ties_one_label_and_too_many(spark):
    assert labelled(spark, [("x", "b"), ("x", "a")], ["x", "y"]) == [("a", 0), ("a", 0)]
    assert labelled(spark, [("x", "only")], ["x", None]) == [("only", None), (None, None)]
    with pytest.raises(ValueError, match="no labelled text"):
        labelled(spark, [(None, "a"), ("x", None)], ["x"])
    many = spark.range(65).select(F.lit("x").alias("text"), F.col("id").alias("label"))
    with pytest.raises(ValueError, match="more than 64 labels"):
        labelling.fit_labels(many, "text", "label")
    labels = labelling.fit_labels(many.where("id < 64"), "text", "label").labels
    assert len(labels) == 64 and labels[1] == "1" and labels[2] == "10"


def test_labels_from_another_table(spark):
    texts = spark.createDataFrame([(1, "x y"), (2, "z"), (3, None), (None, "x"), (4, "q")], "id int, text string")
    judged = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "a"), (4, None), (None, "a"), (9, "c")], "id int, key string")
    model = labelling.fit_labels(texts, "text", "key", judged=judged, key="id")
    same = labelling.fit_labels(spark.createDataFrame([("x y", "a"), ("x y", "b"), ("z", "b")], "text string, key string"), "text", "key")
    assert (model.labels, model.priors, model.costs) == (same.labels, same.priors, same.costs) == (("a", "b"), model.priors, model.costs)
    assert sorted(model.slots.collect()) == sorted(same.slots.collect())


def test_a_hot_label_and_long_texts(spark):
    rows = spark.range(3_000).select(
        F.concat(F.lit("word"), F.col("id") % 7, F.lit(" "), F.repeat(F.lit("filler "), 50)).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 7)).alias("label"),
    )
    model = labelling.fit_labels(rows, "text", "label")
    long = spark.createDataFrame([(1, "word3 " * 200_000)], "id long, text string")
    found = labelling.assign_labels(long, model, "id", "text")
    assert found.first().label in ("l3", "hot")
    text = data.plan(found)
    assert "CartesianProduct" not in text and "Python" not in text and text.count("partial_sum") >= 1


def test_held_out_languages_beat_the_word_list(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang IS NOT NULL AND text <> ''")
    learned, asked = docs.where("crc32(string(doc_id)) % 4 <> 2"), docs.where("crc32(string(doc_id)) % 4 = 2")
    model = labelling.fit_labels(learned, "text", "lang")
    found = labelling.assign_labels(asked, model, "doc_id", "text").join(asked.select("doc_id", "lang"), "doc_id")
    listed = voice.classify_by_words(asked, "text", lexicon.LANGUAGE_WORDS)
    right = lambda df, column: df.agg(F.avg((F.col(column) == F.col("lang")).cast("int"))).first()[0]
    assert right(found, "label") >= max(0.9, right(listed, "category"))


def test_held_out_quality_beats_the_most_frequent_label(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    learned, asked = docs.where("crc32(string(doc_id)) % 4 <> 2"), docs.where("crc32(string(doc_id)) % 4 = 2")
    found = labelling.assign_labels(asked, labelling.fit_labels(learned, "text", "quality"), "doc_id", "text")
    both = found.join(asked.select("doc_id", "quality"), "doc_id").where("label IS NOT NULL")
    right, most, frequent = both.agg(F.avg((F.col("label") == F.col("quality")).cast("int")), F.avg("quality"), F.avg(1 - F.col("quality"))).first()
    assert right > max(most, frequent)

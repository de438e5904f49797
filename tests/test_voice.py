import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.oracle import ORACLE
from depositlens.functions import lexicon, sql
from depositlens.functions.masking import mask_phone, mask_text
from depositlens.functions.summary import summary
from depositlens.operators import voice
from tests import data

COMMENTS = [
    (1, "2026-07-01", "窓口", "店内が快適で、案内も迅速でした。", "positive"),
    (2, "2026-07-02", "電話", "駐車場が狭くて残念です。", "negative"),
    (3, "2026-07-03", "アプリ", "サイトは見やすいですが、入力が複雑です。", "mixed"),
    (4, "2026-07-03", "電話", "通帳を繰り越しました。", "neutral"),
    (5, "2026-07-04", "電話", "不便です。とても不便です。", "negative"),
    (6, "2026-07-04", "窓口", None, None),
    (7, "2026-07-05", "窓口", "", "neutral"),
    (8, "2026-07-05", "アプリ", "使いやすくて嬉しいです", "positive"),
    (9, "2026-07-06", "アプリ", "書類に間違いがありました", "negative"),
]
SENTENCES = {
    "不親切な対応でした": "negative", "便利ではありません": "negative", "親切とは言えません": "negative",
    "信頼していません": "negative", "期待しています": "neutral", "招待状が届きました": "neutral",
    "満足しています": "positive", "満足できない": "negative", "とても丁寧でした": "positive",
    "丁寧さがない": "negative", "感謝しております": "positive", "職員に助かりました": "positive",
    "失礼はありませんでした": "positive", "迷惑をかけられました": "negative", "返事が遅い": "negative",
    "返事が遅くない": "positive", "気分が悪いです": "negative", "悪くないと思います": "positive",
    "手続が面倒です": "negative", "面倒はなかったです": "positive", "安心できました": "positive",
    "安心できません": "negative", "心配していません": "positive", "心配です": "negative",
    "最高の一日": "positive", "最悪の一日": "negative", "快適だが狭い": "mixed", "納得しました": "positive",
    "納得とはいえない": "negative", "待たされました": "negative", "口座を開きました": "neutral", "質問があります": "neutral",
    "困ったことはない": "positive", "迅速でないわけではない": "positive", "狭山支店は親切": "positive", "困難な相談も丁寧": "positive",
    "ご機嫌でした": "neutral", "丁寧にしなければならない": "positive", "危ないので不安": "negative", "満足、でも早くはない": "positive",
    "不満はない": "positive", "不満がないとは言えない": "negative", "親切でなく丁寧": "mixed", "便利とは言えませんが快適": "mixed",
}


@pytest.fixture(scope="module")
def comments(spark):
    rows = [row[:4] for row in COMMENTS]
    df = spark.createDataFrame(rows, "voice_id long, received_date string, channel string, voice_text string")
    return voice.voice_sentiment(df.withColumn("received_date", F.col("received_date").cast("date")))


def test_labels(comments):
    labels = {row.voice_id: row.sentiment for row in comments.collect()}
    assert labels == {row[0]: row[4] for row in COMMENTS}


def test_negation(spark):
    df = spark.createDataFrame([(text,) for text in SENTENCES], "voice_text string")
    assert {row.voice_text: row.sentiment for row in voice.voice_sentiment(df).collect()} == SENTENCES


def test_both_ways_to_a_label_agree(spark):
    """Texts with and without anything that turns a term, against the tokens gone through in Python."""
    chance = random.Random(4)
    parts = [*lexicon.POSITIVE_TERMS, *lexicon.NEGATIVE_TERMS, *lexicon.OTHER_WORDS, "です", "心配", "不", "店", "。", "、", "ない", "ません", "とは言え", "なければならない"]
    texts = ["".join(chance.choices(parts, k=chance.randint(0, 5))) for _ in range(1500)]
    token = re.compile(lexicon.token_pattern([*lexicon.POSITIVE_TERMS, *lexicon.NEGATIVE_TERMS]))

    def label(text):
        sides, side, ends = set(), None, re.compile(f"[{lexicon.CLAUSE_END}]")
        for found in (match.group(1) for match in token.finditer(text) if match.group(1)):
            if re.fullmatch(lexicon.NEGATION_AFTER, found):
                side = None if side is None else -side
                continue
            sides.add(side)
            bare = found if found in lexicon.POSITIVE_TERMS + lexicon.NEGATIVE_TERMS else found[1:]
            side = None if ends.fullmatch(found) else (1 if bare in lexicon.POSITIVE_TERMS else -1) * (1 if bare == found else -1)
        sides.add(side)
        return {(True, True): "mixed", (True, False): "positive", (False, True): "negative", (False, False): "neutral"}[1 in sides, -1 in sides]

    df = spark.createDataFrame([(text,) for text in texts], "voice_text string")
    found = {row.voice_text: row.sentiment for row in voice.voice_sentiment(df).collect()}
    assert found == {text: label(text) for text in texts}


def test_label_counts(comments):
    counts = {row.sentiment: row.comments for row in voice.sentiment_counts(comments).collect()}
    assert counts == {"positive": 2, "negative": 3, "mixed": 1, "neutral": 2, None: 1}


def test_negative_by_channel(comments):
    rows = [tuple(row) for row in voice.negative_by_channel(comments).collect()]
    assert rows == [("電話", 2), ("アプリ", 1)]


def test_negative_samples(comments):
    assert [row.voice_id for row in voice.negative_samples(comments, 2).collect()] == [9, 5]


def test_own_lexicon(spark):
    df = spark.createDataFrame([("good but slow",), ("fine",)], "voice_text string")
    labels = [row.sentiment for row in voice.voice_sentiment(df, "voice_text", ["good"], ["slow"]).collect()]
    assert labels == ["mixed", "neutral"]


def test_substring_categories(spark):
    rows = [("アプリとサイトの受付",), ("待ち、待ち",), ("期待して招待する",), ("何も",), (None,), ("",)]
    df = spark.createDataFrame(rows, "voice_text string")
    found = [row.category for row in voice.classify_by_substrings(df).collect()]
    assert found == ["app", "waiting", "other", "other", None, "other"]


def test_word_categories(spark):
    categories = {"b": ["two", "deux"], "a": ["one"]}
    rows = [("One, two; TWO",), ("one two",), ("twofold",), (None,), ("",)]
    df = spark.createDataFrame(rows, "text string")
    found = [row.category for row in voice.classify_by_words(df, "text", categories).collect()]
    assert found == ["b", "a", "other", None, "other"]  # a tie goes to the first name


def test_masking_of_text(spark):
    cases = {
        "mail a.b+c@d-e.example.com now": "mail [EMAIL] now",
        "@ alone": "@ alone",
        'x token = "12ab" y': "x [SECRET] y",
        "call +1 (743) 555-3824!": "call [PHONE]!",
        "call 090-1234-5678": "call [PHONE]",
        "card 4785380592391139 or 4785-3805-9239-1139": "card [CARD] or [CARD]",
        "host 152.143.123.131.": "host [IP].",
        "call 09012345678, +81-90-1234-5678": "call [PHONE], [PHONE]",
        "call (743) 555-3824 or 743-555-3824 or (03) 1234-5678": "call [PHONE] or [PHONE] or [PHONE]",
        "call ０９０－１２３４－５６７８": "call [PHONE]",
        "card 411111111111111, 41111111111111112222": "card [CARD], 41111111111111112222",
        "call 03 1234 5678 or 090 1234 5678 or 415.555.2671.": "call [PHONE] or [PHONE] or [PHONE].",
        "card ４１１１ １１１１ １１１１ １１１１, 3782 822463 10005": "card [CARD], [CARD]",
        "password=abc123 password: 'a b' passwd = x;": "[SECRET] [SECRET] [SECRET];",
        "id 123-45-6789, 2001:db8::7, fe80::1%eth0, ::1": "id [ID], [IP], [IP]%eth0, [IP]",
        "ISBN 9780306406157, EAN 4006381333931, card 4222222222222": "ISBN 9780306406157, EAN 4006381333931, card [CARD]",
        "version 1.2.3.4, v1.2.3.4 and 1.2.3.4.5, 1.2.3.4": "version 1.2.3.4, v1.2.3.4 and 1.2.3.4.5, [IP]",
        "https://x.example/orders/0312345678/090-1234-5678": "https://x.example/orders/0312345678/090-1234-5678",
        "電話03-1234-5678まで、番号4111111111111111です": "電話[PHONE]まで、番号[CARD]です",
        "A0312345678 std::vector at 12:30:45": "A0312345678 std::vector at 12:30:45",
        'a "password": "x" and Token = "x"': "a [SECRET] and [SECRET]",
        "3.5 percent of 1,000": "3.5 percent of 1,000",
        "": "",
    }
    df = spark.createDataFrame([(text,) for text in cases], "text string")
    shown = [row[0] for row in df.select(mask_text(F.col("text"))).collect()]
    assert shown == list(cases.values())
    assert spark.range(1).select(mask_text(F.lit(None).cast("string"))).first()[0] is None


def test_masking_of_phones(spark):
    rows = [("090-1234-5678",), ("０９０－１２",), ("none",), (None,)]
    df = spark.createDataFrame(rows, "phone string")
    assert [row[0] for row in df.select(mask_phone(F.col("phone"))).collect()] == ["***-****-****", "***－**", "none", None]


# --- summary, against the SQL form ---------------------------------------------------------------------


def assert_summaries_equal_sql(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shown = sorted(tuple(row) for row in voice.summarise(df, "text").select("doc_id", "summary").collect())
    connection = duckdb.connect()
    connection.register("documents", df.toArrow())
    assert shown == sorted(connection.execute(ORACLE["text_summarise"]).fetchall())
    return [summary for _, summary in shown]


def test_summary_of_edge_cases(spark):
    texts = [None, "", "...", "12 34.", "One only", "a b. a. c c c. d.", "日本語の文。次の文！終わり？", "x² x. ½ y_x!"]
    assert assert_summaries_equal_sql(spark, texts)[:6] == [None, "", "", "", "One only", "a b. a. c c c."]


def test_summary_of_random_texts(spark):
    chance = random.Random(7)
    vocabulary = ["alpha", "beta", "gamma", "delta", "Épsilon", "12", "x1y"]
    texts = []
    for _ in range(150):
        sentences = [
            " ".join(chance.choice(vocabulary) for _ in range(chance.randint(0, 6)))
            for _ in range(chance.randint(1, 9))
        ]
        texts.append("".join(sentence + chance.choice([". ", "! ", "\n", "?"]) for sentence in sentences))
    assert_summaries_equal_sql(spark, texts)


def test_long_text_is_processed_whole(spark):
    text = "filler words here. " * 3000 + "peak filler words here here."
    assert assert_summaries_equal_sql(spark, [text])[0].endswith("filler words here.")
    only = "one. " * 2000 + " ".join(["last"] * 3000) + "."
    assert "last last" in assert_summaries_equal_sql(spark, [only])[0]


def test_functions_by_name_in_sql(spark):
    sql.register(spark)
    texts = [row[3] for row in COMMENTS] + ["it's 10.0.0.1. a@b.cd, call 090-1234-5678. The end is here."]
    spark.createDataFrame([(text,) for text in texts], "t string").createOrReplaceTempView("texts")
    by_sql = spark.sql("SELECT text_sentiment(t) s, text_mask(t) m, phone_mask(t) p, text_summary(t) u FROM texts")
    text = F.col("t")
    by_column = spark.table("texts").select(
        lexicon.sentiment(text).alias("s"),
        mask_text(text).alias("m"),
        mask_phone(text).alias("p"),
        summary(text).alias("u"),
    )
    assert by_sql.collect() == by_column.collect()
    spark.catalog.dropTempView("texts")


def test_text_operators_do_not_shuffle(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("text"))
    for result in (
        voice.voice_sentiment(df, "text"),
        voice.classify_by_words(df, "text", lexicon.LANGUAGE_WORDS),
        voice.mask_personal_data(df, "text"),
    ):
        text = data.plan(result, "formatted")
        assert "Exchange" not in text and "Python" not in text
    assert "Exchange" not in data.plan(voice.summarise(df, "text"), "formatted")

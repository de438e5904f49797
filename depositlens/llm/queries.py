"""The registered queries of the corpus operators, over whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from depositlens.llm import (
    ball_tree,
    bm25_wand,
    bpe_lexicon,
    decontaminate,
    html_ratio,
    log_bilinear,
    pii_surrogates,
    pivot_join,
    ppm_language,
    repeat_bwt,
    role_glr,
    simhash_balls,
    url_trees,
)
from depositlens.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii_surrogates.replace_personal_data(docs, spans="spans")
    return found.select("doc_id", "text", F.size("spans").cast("long").alias("n_entities"))


def html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_ratio.extract(read(spark, sf_dir, "pages"))


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_lexicon.encode(docs, public_tokenizers.path("word_bpe_49k.json"), digest=True, keep_text=False)


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge_urls(read(spark, sf_dir, "pages"))


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeat_bwt.remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score_texts(read(spark, sf_dir, "documents"))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_balls.near_copy_classes(read(spark, sf_dir, "documents"))


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return bm25_wand.search(docs, docs.where("doc_id % 100 = 0"), terms=16).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.round("score", 6).alias("score")
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.predict_languages(read(spark, sf_dir, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with the contract's damage; ``present`` is false for a dropped row."""
    or_space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    return turns.select(
        "conv_id", "turn",
        F.when(harm == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text")).alias("text"),
        (harm != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(harm == 3, 2).otherwise(1))).alias("copy"),
    )


def repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_glr.repair(damaged(read(spark, sf_dir, "conversations")), present=F.col("present"))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_join.near_copy_classes(read(spark, sf_dir, "embeddings"))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_pii_surrogates": pii,
    "op2_html_main_text": html,
    "op3_bpe_lexicon": bpe,
    "op4_url_filter": urls,
    "op5_repeated_bytes": repeats,
    "op6_lm_scores": scores,
    "op7_decontamination": contamination,
    "op8_simhash_classes": near_copies,
    "op9_topk_search": searches,
    "op10_language_id": languages,
    "op11_role_repair": repairs,
    "op12_embedding_classes": near_vectors,
    "op13_ranked_search": ranked,
    "pipeline": corpus_pipeline.run,
}

def _edit(path: str, price: str, letter: str) -> str:
    """SQL of a path, nine digits of cost and the audit, after an edit."""
    return f"lpad(CAST(CAST(left({path}, 9) AS INT) + {price} AS VARCHAR), 9, '0') || substr({path}, 10) || '{letter}'"


def _best(*paths: str) -> str:
    return f"least({', '.join(f'({path})' for path in paths)})"


#: A row's edits: the best paths that end empty (e), after a lone system turn (s), a user turn (u) or a pair (p), then with insertions.
_EDITED = {
    "e": _edit("e", "2", "D"),
    "s": _best(_edit("s", "2", "D"), f"CASE WHEN ok AND i = 's' THEN {_edit('e', 'extra', 'K')} END"),
    "u": _best(
        _edit("u", "2", "D"),
        *(f"CASE WHEN ok AND i = 'u' THEN {_edit(p, 'extra', 'K')} END" for p in "esp"),
        *(f"CASE WHEN ok THEN {_edit(p, '1 + extra', 'R')} END" for p in "esp"),
    ),
    "p": _best(
        _edit("p", "2", "D"),
        f"CASE WHEN ok AND i = 'a' THEN {_edit('u', 'extra', 'K')} END",
        f"CASE WHEN ok THEN {_edit('u', '1 + extra', 'R')} END",
    ),
}
_WAITING = _best("u", *(_edit(p, "5", "I") for p in "esp"))

ORACLE: dict[str, str] = {
    "op11_role_repair": rf"""
WITH RECURSIVE original AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
bytes AS (  -- crc32 as the division of the message bits: one step a byte
  SELECT k, 0 AS place, 4294967295::BIGINT AS crc FROM (SELECT DISTINCT k FROM original)
  UNION ALL
  SELECT k, place + 1, xor(crc >> 8, (SELECT list_reduce([xor(crc, ascii(k[place + 1])) & 255, 1, 1, 1, 1, 1, 1, 1, 1],
                                      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))
  FROM bytes WHERE place < length(k)),
harms AS (SELECT k, xor(crc, 4294967295) % 20 AS harm FROM bytes WHERE place = length(k)),
damaged AS (
  SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM original JOIN harms USING (k) WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, n, left(role, 1) AS i,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS pair
  FROM placed),
steps AS (SELECT conv_id, n, i, fault IN ('', 'truncated') AS ok, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS extra FROM judged),
paths AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, '000000000' AS e, CAST(NULL AS VARCHAR) AS s, '000000005I' AS u, '000000010II' AS p FROM conversations
  UNION ALL
  SELECT conv_id, n, e, s, u, {_best("p", _edit("u", "5", "I"))}
  FROM (SELECT conv_id, n, e, s, {_WAITING} AS u, p
        FROM (SELECT x.conv_id, y.n, {", ".join(f"{sql} AS {name}" for name, sql in _EDITED.items())}
              FROM paths x JOIN steps y ON x.conv_id IS NOT DISTINCT FROM y.conv_id AND y.n = x.n + 1))),
won AS (
  SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit
  FROM (SELECT conv_id, least(e, p) AS best FROM paths QUALIFY n = max(n) OVER (PARTITION BY conv_id))),
letters AS (
  SELECT conv_id, place, audit[place] AS letter, length(replace(audit, 'D', '')) % 2 AS odd,
         length(replace(audit[:place], 'I', '')) AS n, length(replace(audit[:place], 'D', '')) AS o
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS place FROM won)),
repaired AS (
  SELECT l.conv_id, sha256(string_agg(
           CASE WHEN letter = 'K' THEN j.role WHEN (o + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE letter WHEN 'I' THEN '' ELSE j.text END, chr(10) ORDER BY place)) AS hash
  FROM letters l LEFT JOIN judged j ON l.conv_id IS NOT DISTINCT FROM j.conv_id AND l.n = j.n
  WHERE letter <> 'D' GROUP BY l.conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT w.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM won w LEFT JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON w.conv_id IS NOT DISTINCT FROM r.conv_id
""",
    "op7_decontamination": r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len, array_to_string(w[s:s + len - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS len, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s
        FROM items WHERE len(w) > 0)),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
places AS (
  SELECT doc_id, len, s, array_to_string(w[s:s + len - 1], ' ') AS win
  FROM (SELECT doc_id, w, l.len, unnest(range(1, len(w) - l.len + 2)) AS s
        FROM docs, (SELECT DISTINCT len FROM windows) l)),
found AS (SELECT doc_id, s, len, item_id FROM places JOIN windows USING (len, win)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + len)) AS p FROM (SELECT DISTINCT doc_id, s, len FROM found))
  GROUP BY doc_id),
held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id)
""",
    "op9_topk_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x20\x09-\x0D]+')) AS term
  FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
dls AS (SELECT doc_id, sum(tf) AS dl FROM tfs GROUP BY doc_id),
stats AS (SELECT count(*) AS n FROM documents),
mean AS (SELECT (SELECT sum(dl) FROM dls) / n AS dl FROM stats),
idfs AS (SELECT term, ln(1 + (n - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM tfs, stats GROUP BY term, n),
asked AS (
  SELECT doc_id AS query_id, term, idf FROM tfs JOIN idfs USING (term) WHERE doc_id % 100 = 0
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(tf * idf, 9) DESC, term) <= 16),
scored AS (
  SELECT query_id, t.doc_id,
         round(sum(idf * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d.dl / mean.dl)))), 9) AS score
  FROM asked JOIN tfs t USING (term) JOIN dls d ON d.doc_id = t.doc_id, mean
  GROUP BY query_id, t.doc_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, round(score, 6) AS score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 10
""",
    "op12_embedding_classes": """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings),
usable AS (
  SELECT * FROM vectors
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v)
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.n AS x, b.n AS y, b.vec_id AS y_id
  FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.n <> b.n
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
  SELECT n AS x, n AS y FROM vectors
  UNION
  SELECT r.x, p.y FROM reached r JOIN pairs p ON r.y = p.x),
classes AS (SELECT r.x AS n, min(v.vec_id) AS component_id FROM reached r JOIN vectors v ON r.y = v.n GROUP BY r.x),
counts AS (SELECT x AS n, count(*) AS n_links FROM pairs GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN classes USING (n) LEFT JOIN counts USING (n)
""",
    "op13_ranked_search": r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
total AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM docs WHERE len(w) > 0),
tfs AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, total GROUP BY term, nd),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
scored AS (
  SELECT item_id, t.d, CAST(sum(times * weights.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(docs.w) * nd) // l)))) AS BIGINT) AS score
  FROM asked JOIN tfs t USING (term) JOIN weights USING (term) JOIN docs ON docs.d = t.d, total
  GROUP BY item_id, t.d)
SELECT item_id, CAST(row_number() OVER best AS INT) AS rank, doc_id, score
FROM scored JOIN docs USING (d) WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
QUALIFY row_number() OVER best <= 20
""",
}

"""The SQL each registered query is compared with, for a second engine over the same parquet tables.

Written on its own from the meaning of the questions, in other forms than the Spark code where there is a
choice: ``NOT EXISTS`` or ``max(date)`` for the anti join, ``CASE`` sums for counters, unnested words for
the text operators.
"""

from __future__ import annotations

from depositlens import schemas
from depositlens.functions import lexicon
from depositlens.functions.summary import SENTENCE
from depositlens.sources.adapters import AS_OF, COMMENT_PHRASES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(value) for value in values) + "]"


CUTOFF = f"(DATE '{AS_OF}' - INTERVAL 6 MONTH)"

# --- the domain tables over the given tables ----------------------------------------------------------

TABLES = {
    "customers": f"""
        SELECT c_custkey AS customer_id, c_name AS name, CAST(20 + c_custkey % 70 AS INTEGER) AS age,
               c_mktsegment AS segment,
               CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(15,2)) END
                   AS deposit_balance_manyen,
               CAST(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 500 END AS DECIMAL(15,2))
                   AS managed_asset_manyen,
               CAST(DATE '{AS_OF}' - to_years(CAST(20 + c_custkey % 70 AS INTEGER)) AS DATE) AS birth_date,
               CAST(c_nationkey AS VARCHAR) AS branch_id,
               CAST(c_custkey % 120 AS VARCHAR) AS employee_id,
               CASE WHEN c_custkey % 10 = 7
                    THEN translate('0' || (10 + c_custkey % 90) || '-' || (1000 + c_custkey % 9000) || '-5678',
                                   '0123456789-', '０１２３４５６７８９－')
                    ELSE '+1 (' || (200 + c_custkey % 700) || ') 555-' || (1000 + c_custkey % 9000) END
                   AS phone_number
        FROM customer""",
    "branch": """
        SELECT CAST(n_nationkey AS VARCHAR) AS branch_id, n_name AS branch_name,
               'AREA_' || (n_nationkey % 4) AS area, r_name AS prefecture
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "employee": """
        SELECT CAST(s_suppkey AS VARCHAR) AS employee_id, s_name AS employee_name,
               CAST(s_nationkey AS VARCHAR) AS branch_id,
               CASE WHEN s_acctbal < 0 THEN 'TRAINEE' ELSE 'SALES' END AS role
        FROM supplier""",
    "contacts": """
        SELECT o_orderkey AS contact_id,
               CASE WHEN o_custkey % 7 = 3 THEN NULL ELSE o_custkey END AS customer_id,
               CAST(o_orderdate AS DATE) AS contact_date, o_orderpriority AS channel,
               'PRODUCT_' || (o_orderkey % 5) AS product, o_orderstatus AS result
        FROM orders""",
    "customer_voice": f"""
        SELECT event_id AS voice_id, CAST(ts AS DATE) AS received_date, event_type AS channel,
               CASE WHEN event_id % 50 = 0 THEN NULL
                    ELSE ({_list(COMMENT_PHRASES)})[event_id % {len(COMMENT_PHRASES)} + 1]
                         || '(顧客 ' || user_id || ')' END AS voice_text
        FROM events""",
    "usage": """
        SELECT CAST(l_shipdate AS DATE) AS usage_date, 'SKU_' || l_partkey AS sku_name,
               CAST(l_quantity AS DECIMAL(18,6)) AS usage_quantity,
               CASE l_returnflag WHEN 'A' THEN 'JOBS' WHEN 'N' THEN 'SQL' ELSE 'PIPELINES' END AS product,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linestatus END AS cost_center
        FROM lineitem""",
    "list_prices": """
        SELECT CASE WHEN p_partkey % 11 = 5 THEN 'RETIRED_' ELSE 'SKU_' END || p_partkey AS sku_name,
               CAST(p_retailprice AS DECIMAL(12,2)) AS price
        FROM part
        UNION ALL
        SELECT CASE WHEN p_partkey % 11 = 5 THEN 'RETIRED_' ELSE 'SKU_' END || p_partkey,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) / 2 AS DECIMAL(12,2))
        FROM part WHERE p_partkey % 7 = 0""",
    "price_periods": """
        SELECT CASE WHEN p_partkey % 11 = 5 THEN 'RETIRED_' ELSE 'SKU_' END || p_partkey AS sku_name,
               CASE WHEN share = 4 AND p_partkey % 3 = 0 THEN DATE '0001-01-01' WHEN share = 4 THEN DATE '1993-03-01'
                    WHEN share = 5 OR p_partkey % 7 = 0 THEN DATE '1996-01-01'
                    ELSE CAST(DATE '1997-01-01' + CAST(p_partkey % 300 AS INTEGER) AS DATE) END AS valid_from,
               CASE WHEN share = 4 AND p_partkey % 4 = 0 THEN DATE '1995-01-01' END AS valid_to,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * share / 4 AS DECIMAL(12,2)) AS price
        FROM part, (VALUES (4), (5), (6)) shares(share)""",
    "priced_usage": """
        SELECT u.*, CASE WHEN p.valid_to IS NULL OR u.usage_date < p.valid_to THEN p.price END AS price
        FROM usage u ASOF LEFT JOIN (
            SELECT sku_name, valid_from, max(price) AS price, arg_max(valid_to, price) AS valid_to
            FROM price_periods GROUP BY sku_name, valid_from) p
        ON u.sku_name = p.sku_name AND u.usage_date >= p.valid_from""",
    "nesting": """
        SELECT 'team_' || c_custkey AS member, 'team_' || CASE WHEN c_custkey > 1 THEN c_custkey // 2 ELSE 5 END AS grp FROM customer
        UNION SELECT 'advisers_' || (s_suppkey % 10), 'team_' || (s_suppkey % 10 * 100 + 1) FROM supplier""",
    "closure": """
        WITH RECURSIVE above AS (
            SELECT member, grp FROM nesting
            UNION
            SELECT a.member, n.grp FROM above a JOIN nesting n ON a.grp = n.member)
        SELECT member, grp FROM above WHERE member <> grp""",
    "runs": """
        SELECT event_id AS run_id, 'task_' || (user_id % 4) AS task,
               CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               ts AS started,
               ts + to_microseconds(CAST(CAST(value AS DECIMAL(12,6)) * 1000000 AS BIGINT)) AS ended
        FROM events""",
    "silver": """
        SELECT c.*, b.branch_name, b.area, b.prefecture, e.employee_name
        FROM customers c
        LEFT JOIN branch b ON c.branch_id = b.branch_id
        LEFT JOIN employee e ON c.employee_id = e.employee_id
        WHERE c.deposit_balance_manyen IS NOT NULL""",
    "last_contacts": """
        SELECT customer_id, max(contact_date) AS last_contact_date, count(*) AS contact_count
        FROM contacts WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "targets": f"""
        SELECT s.* FROM silver s
        WHERE s.deposit_balance_manyen >= 1000 AND s.managed_asset_manyen = 0
          AND NOT EXISTS (SELECT 1 FROM contacts k
                          WHERE k.customer_id = s.customer_id AND k.contact_date >= {CUTOFF})""",
}

_NEEDS = {
    "silver": ("customers", "branch", "employee"),
    "last_contacts": ("contacts",),
    "targets": ("silver", "contacts"),
    "voice_silver": ("customer_voice",),
    "priced_usage": ("usage", "price_periods"),
    "closure": ("nesting",),
}


# Sentiment by cutting each clause into its terms and negations and counting, with word lists written down on their own.
_GOOD_TERMS = (
    "嬉し|楽し|快適|素晴らし|満足|安心|便利|親切|丁寧|感謝|助か|信頼|迅速|優れ|使いやす|見やす|良い|良か|良く|納得|最高|好感"
)
_BAD_TERMS = (
    "待たされ|使いにく|腹が立|見にく|不便|不満|不安|残念|遅い|遅く|遅か|悪い|悪く|悪か|困|怒|面倒|失礼|最悪|苦痛|心配|複雑|間違|迷惑|嫌|狭|雑な"
)
_NOT = "とは[言い]え(?:ません|ない|なかった)?|ません|ない|なく|なか"
_IDLE = (
    "(?:なければ|なくては|ないと)(?:なら|いけ)(?:ない|ません)|危ない|切ない|情けない|仕方ない|つまらない|とんでもない|狭山|狭間|困難|貧困|機嫌|喜怒|不安定"
)
TABLES["voice_silver"] = f"""
        WITH tokens AS (
            SELECT voice_id, clause, unnest(found) AS token, generate_subscripts(found, 1) AS place
            FROM (SELECT voice_id, clause, regexp_extract_all(clause_text, '{_IDLE}|[不非未無]?(?:{_GOOD_TERMS}|{_BAD_TERMS})|{_NOT}') AS found
                  FROM (SELECT voice_id, unnest(parts) AS clause_text, generate_subscripts(parts, 1) AS clause
                        FROM (SELECT voice_id, string_split_regex(voice_text, '[。、，！？!?\n]') AS parts FROM customer_voice)))),
        terms AS (
            SELECT voice_id, clause, place, regexp_full_match(token, '[不非未無]?(?:{_GOOD_TERMS})') AS good,
                   regexp_full_match(token, '[不非未無](?:{_GOOD_TERMS}|{_BAD_TERMS})') AND NOT regexp_full_match(token, '{_BAD_TERMS}') AS turned,
                   coalesce(lead(place) OVER (PARTITION BY voice_id, clause ORDER BY place), 1000000) AS next
            FROM tokens WHERE regexp_full_match(token, '[不非未無]?(?:{_GOOD_TERMS}|{_BAD_TERMS})')),
        sides AS (
            SELECT t.voice_id, t.good = ((count(n.token) + CAST(any_value(t.turned) AS INT)) % 2 = 0) AS good
            FROM terms t LEFT JOIN tokens n ON n.voice_id = t.voice_id AND n.clause = t.clause AND n.place > t.place AND n.place < t.next
                 AND regexp_full_match(n.token, '{_NOT}')
            GROUP BY t.voice_id, t.clause, t.place, t.good)
        SELECT v.*, CASE WHEN v.voice_text IS NULL THEN NULL WHEN s.good AND s.bad THEN 'mixed' WHEN s.good THEN 'positive'
                         WHEN s.bad THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM customer_voice v
        LEFT JOIN (SELECT voice_id, bool_or(good) AS good, bool_or(NOT good) AS bad FROM sides GROUP BY voice_id) s USING (voice_id)"""


def _with(body: str, *tables: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for table in tables:
        add(table)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name]})" for name in ordered) + "\n" + body


# --- column lists -------------------------------------------------------------------------------------


def _out(name: str) -> str:
    """A column as the Spark side delivers it: money as double, dates as text."""
    if name.endswith("_manyen"):
        return f"CAST({name} AS DOUBLE) AS {name}"
    if name.endswith("_date"):
        return f"strftime({name}, '%Y-%m-%d') AS {name}"
    return name


def _columns(names) -> str:
    return ", ".join(_out(name) for name in names)


_CUSTOMERS = _columns(schemas.CUSTOMERS.names)
_BRANCH = "branch_name, area, prefecture"
_SILVER = f"{_CUSTOMERS}, {_BRANCH}, employee_name"
_VOICE = _columns(schemas.CUSTOMER_VOICE.names)


def _row_digest(names) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({name} AS VARCHAR), '∅')" for name in names) + "))"


_SILVER_NAMES = [*schemas.CUSTOMERS.names, "branch_name", "area", "prefecture", "employee_name"]


def _bronze_rows() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, {_row_digest(schema.names)} AS row_md5 FROM {table}"
        for table, schema in schemas.BRONZE.items()
    ]
    return _with("\nUNION ALL ".join(parts), *schemas.BRONZE)


def _null_profile() -> str:
    parts = [
        f"SELECT '{field.name}' AS column_name, '{field.dataType.simpleString()}' AS data_type,"
        f" count(*) - count({field.name}) AS null_count, count(*) AS row_count FROM customers"
        for field in schemas.CUSTOMERS.fields
    ]
    return _with("\nUNION ALL ".join(parts), "customers")


def _display_columns() -> str:
    headings = ", ".join(f'{name} AS "{schemas.DISPLAY_NAMES.get(name, name)}"' for name in schemas.CUSTOMERS.names)
    return _with(f"SELECT {headings} FROM (SELECT {_CUSTOMERS} FROM customers)", "customers")


def _heatmap(source: str, segments) -> str:
    counters = ", ".join(f"count(*) FILTER (WHERE segment = '{name}') AS {name}" for name in segments)
    listed = ", ".join(_text(name) for name in segments)
    return (
        f"SELECT branch_id, branch_name, {counters},"
        f" count(*) FILTER (WHERE segment IS NULL OR segment NOT IN ({listed})) AS other_segments"
        f" FROM {source} GROUP BY branch_id, branch_name"
    )


# --- free text ----------------------------------------------------------------------------------------

_TOKENS = r"string_split_regex(lower({text}), '[^\p{{L}}]+')"


def _text_classify() -> str:
    pairs = ", ".join(
        f"({_text(category)}, {_text(word)})" for category, terms in lexicon.LANGUAGE_WORDS.items() for word in terms
    )
    return f"""
        WITH words AS (SELECT doc_id, unnest({_TOKENS.format(text="text")}) AS word FROM documents),
             lexicon(category, word) AS (VALUES {pairs}),
             hits AS (SELECT doc_id, category, count(*) AS n FROM words JOIN lexicon USING (word)
                      GROUP BY doc_id, category),
             best AS (SELECT doc_id, category,
                             row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, category) AS place FROM hits)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(b.category, 'other') END AS category
        FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.place = 1"""


def _voice_classify() -> str:
    pairs = ", ".join(
        f"({_text(category)}, {_text(term)})"
        for category, terms in lexicon.COMMENT_CATEGORIES.items()
        for term in terms
    )
    return _with(
        f"""
        SELECT {_VOICE}, category
        FROM (SELECT v.*, CASE WHEN v.voice_text IS NULL THEN NULL ELSE coalesce(b.category, 'other') END AS category
              FROM customer_voice v LEFT JOIN (
                  SELECT voice_id, category,
                         row_number() OVER (PARTITION BY voice_id ORDER BY sum(n) DESC, category) AS place
                  FROM (SELECT voice_id, category, len(string_split(voice_text, term)) - 1 AS n
                        FROM customer_voice, (VALUES {pairs}) terms(category, term)) counted
                  WHERE n > 0 GROUP BY voice_id, category) b
              ON b.voice_id = v.voice_id AND b.place = 1)""",
        "customer_voice",
    )


# The kinds of personal data, on their own from the library's rules: kind, how it begins to look like it. '' stays as it is.
_OCTETS = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_MASKED = (
    ("[EMAIL]", r"[[:alnum:]._%+-]+@[[:alnum:]-]+(?:\.[[:alnum:]-]+)+"),
    ("[SECRET]", r"""\"?(?i:token|secret|password|passwd|api_key|apikey)\"? ?[:=] ?(?:\"[^\"]*\"|'[^']*'|[^\s\"',;]+)"""),
    ("", r"/\w[\w./-]*|(?i:version|release|ver|v)[. ]{0,2}\d+(?:\.\d+){3,}|\d+(?:\.\d+){4,}"),
    ("[ID]", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("[CARD]", r"\b(?:\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})\b"),
    (
        "[PHONE]",
        r"\+[\d０-９]{1,3}[ －-]?(?:[(（][\d０-９]{1,4}[)）]|[\d０-９]{1,4})(?:[ －-]?[\d０-９]{2,4}){2,3}\b"
        r"|[(（][\d０-９]{2,4}[)）][ －-]?[\d０-９]{2,4}[ －-][\d０-９]{3,4}\b"
        r"|\b(?:0\d{1,4}-\d{1,4}-\d{4}|0\d{1,3} \d{2,4} \d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|0\d{9,10})\b",
    ),
    ("[IP]", rf"\b(?:{_OCTETS}\.){{3}}{_OCTETS}\b"),
)


def _text_mask() -> str:
    anything = _text("|".join(f"(?:{pattern})" for _, pattern in _MASKED))
    kinds = " ".join(f"WHEN regexp_full_match(f, {_text(pattern)}) THEN {_text(kind)}" for kind, pattern in _MASKED)
    return f"""
        WITH found AS (
            SELECT doc_id, string_split_regex(text, {anything}) AS rest, regexp_extract_all(text, {anything}) AS finds, text FROM documents),
        judged AS (
            SELECT doc_id, text, rest, place, f, CASE {kinds} END AS kind, regexp_replace(f, '\\D', '', 'g') AS d
            FROM (SELECT doc_id, text, rest, unnest(finds) AS f, generate_subscripts(finds, 1) AS place FROM found)),
        sums AS (
            SELECT *, list_sum([CASE WHEN (length(d) - i) % 2 = 0 THEN CAST(d[i] AS INT)
                                     ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][CAST(d[i] AS INT) + 1] END FOR i IN range(1, length(d) + 1)]) AS luhn
            FROM judged),
        shown AS (
            SELECT doc_id, place, rest[place] || CASE
                       WHEN kind = '' THEN f
                       WHEN kind = '[CARD]' AND length(d) NOT IN (15, 16) AND (luhn % 10 <> 0 OR regexp_matches(d, '^97[89].{{10}}$')) THEN f
                       ELSE kind END AS piece
            FROM sums),
        joined AS (SELECT doc_id, string_agg(piece, '' ORDER BY place) AS head FROM shown GROUP BY doc_id)
        SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(head, '') || rest[-1] END AS text
        FROM found LEFT JOIN joined USING (doc_id)"""


def _text_summarise() -> str:
    pattern = SENTENCE.replace("\\n", "\n")
    return f"""
        WITH split AS (
                 SELECT doc_id, text,
                        [trim(s, ' ') FOR s IN regexp_extract_all(text, {_text(pattern)})
                         IF trim(s, ' ') <> ''] AS sentences
                 FROM documents),
             sentence AS (
                 SELECT doc_id, unnest(sentences) AS sentence,
                        unnest(range(1, len(sentences) + 1)) AS position FROM split),
             words AS (
                 SELECT doc_id, position, word FROM (
                     SELECT doc_id, position, unnest({_TOKENS.format(text="sentence")}) AS word FROM sentence)
                 WHERE word <> ''),
             frequency AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word),
             score AS (
                 SELECT doc_id, position, CAST(sum(n) AS DOUBLE) / count(*) AS score
                 FROM words JOIN frequency USING (doc_id, word) GROUP BY doc_id, position),
             best AS (
                 SELECT doc_id, position,
                        row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, position) AS place FROM score),
             summary AS (
                 SELECT b.doc_id, string_agg(s.sentence, ' ' ORDER BY b.position) AS summary
                 FROM best b JOIN sentence s ON s.doc_id = b.doc_id AND s.position = b.position
                 WHERE b.place <= 3 GROUP BY b.doc_id)
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(s.summary, '') END AS summary
        FROM documents d LEFT JOIN summary s ON s.doc_id = d.doc_id"""


def _column_profile(table: str, columns: dict[str, str]) -> str:
    """Each column on its own: 4096 registers with the least hash of each, and quartiles by bucket."""
    parts = []
    for name, kind in columns.items():
        day = kind == "date"
        number = f"CAST({name} - DATE '1970-01-01' AS DOUBLE)" if day else f"CAST({name} AS DOUBLE)"
        bucket = (
            f"CAST({name} - DATE '1970-01-01' AS BIGINT)"
            if day
            else f"CASE WHEN {name} = 0 THEN 0 ELSE CAST(sign({name}) * (ceil(ln(abs({number})) / ln(1.01)) + 100000) AS BIGINT) END"
        )
        parts.append(f"""
            SELECT '{name}' AS column_name, '{kind}' AS data_type, h.*, q.* EXCLUDE (of) FROM
              (SELECT coalesce(sum(n), 0) + (SELECT count(*) FROM {table} WHERE {name} IS NULL) AS row_count,
                      (SELECT count(*) FROM {table} WHERE {name} IS NULL) AS null_count,
                      CAST(round(count(*) * 1152921504606846976.0::DOUBLE
                                 / (CAST(coalesce(sum(least), 0) AS DOUBLE) + (4096 - count(*)) * 281474976710656.0::DOUBLE)) AS BIGINT) AS distinct_estimate
               FROM (SELECT count(*) AS n, min(CAST('0x' || substr(md5(CAST({name} AS VARCHAR)), 4, 12) AS BIGINT)) AS least
                     FROM {table} WHERE {name} IS NOT NULL GROUP BY substr(md5(CAST({name} AS VARCHAR)), 1, 3))) h,""")
        if kind == "string":
            parts[-1] += """
              (SELECT NULL AS of, NULL::VARCHAR AS smallest, NULL::VARCHAR AS lower_quartile, NULL::VARCHAR AS median,
                      NULL::VARCHAR AS upper_quartile, NULL::VARCHAR AS largest) q"""
        else:
            at = lambda quarter: f"CAST(min(high) FILTER (upto * 4 >= total * {quarter}) AS VARCHAR)"
            parts[-1] += f"""
              (SELECT 1 AS of, CAST(min(low) AS VARCHAR) AS smallest, {at(1)} AS lower_quartile, {at(2)} AS median, {at(3)} AS upper_quartile, {at(4)} AS largest
               FROM (SELECT low, high, sum(n) OVER (ORDER BY bucket) AS upto, sum(n) OVER () AS total
                     FROM (SELECT {bucket} AS bucket, count(*) AS n, min({name}) AS low, max({name}) AS high
                           FROM {table} WHERE {name} IS NOT NULL GROUP BY ALL))) q"""
    return _with("\nUNION ALL".join(parts), *([table] if table in TABLES else []))


def _frequent_values(table: str, columns: dict[str, str], one_in: int) -> str:
    parts = (
        f"""SELECT '{name}' AS column_name, CAST({name} AS VARCHAR) AS value, count(*) AS value_count FROM {table} WHERE {name} IS NOT NULL
            GROUP BY ALL HAVING count(*) * {one_in} >= (SELECT count(*) FROM {table})"""
        for name in columns
    )
    return _with(" UNION ALL ".join(parts), *([table] if table in TABLES else []))


_CUSTOMER_TYPES = {field.name: field.dataType.simpleString() for field in schemas.CUSTOMERS.fields}
_DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


# --- one statement per query --------------------------------------------------------------------------

_GOLD = (
    f"SELECT 'target_list' AS dataset, {_row_digest(_SILVER_NAMES)} AS label, CAST(1 AS DOUBLE) AS measure FROM targets"
    """
    UNION ALL SELECT 'target_breakdown', concat_ws('/', prefecture, branch_name, segment),
                     CAST(sum(deposit_balance_manyen) AS DOUBLE)
              FROM targets GROUP BY prefecture, branch_id, branch_name, segment
    UNION ALL SELECT 'target_kpis', 'target_count', CAST(count(*) AS DOUBLE) FROM targets
    UNION ALL SELECT 'target_kpis', 'total_deposit_manyen',
                     CAST(coalesce(sum(deposit_balance_manyen), 0) AS DOUBLE) FROM targets
    UNION ALL SELECT 'targets_by_branch', branch_name, CAST(count(*) AS DOUBLE)
              FROM targets GROUP BY branch_id, branch_name
    UNION ALL SELECT 'target_deposits_by_branch', branch_name, CAST(sum(deposit_balance_manyen) AS DOUBLE)
              FROM targets GROUP BY branch_id, branch_name
    UNION ALL SELECT 'branch_segment_heatmap', concat_ws('/', b.branch_name, x.segment),
                     CAST(count(t.customer_id) AS DOUBLE)
              FROM (SELECT DISTINCT branch_id, branch_name FROM targets) b
              CROSS JOIN (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY'),
                                 ('other_segments')) x(segment)
              LEFT JOIN targets t ON t.branch_id = b.branch_id AND t.segment = x.segment
              GROUP BY b.branch_id, b.branch_name, x.segment"""
)

_TARGET_ROWS = f"SELECT {_CUSTOMERS}, {_BRANCH} FROM targets"

ORACLE: dict[str, str] = {
    "csv_scan": _with(f"SELECT {_VOICE} FROM customer_voice", "customer_voice"),
    "bronze_ingest": _bronze_rows(),
    "silver_roundtrip": _with(f"SELECT {_SILVER} FROM silver", "silver"),
    "preview": _with(f"SELECT {_CUSTOMERS} FROM customers ORDER BY customer_id LIMIT 20", "customers"),
    "row_reconcile": _with(
        """SELECT (SELECT count(*) FROM customers) AS rows_before, (SELECT count(*) FROM silver) AS rows_after,
                  (SELECT count(*) FROM customers WHERE deposit_balance_manyen IS NULL) AS rows_removed""",
        "silver",
    ),
    "row_diff": _with(
        """, tomorrow AS (
               SELECT * REPLACE (CASE WHEN customer_id % 31 = 1 THEN NULL ELSE deposit_balance_manyen END AS deposit_balance_manyen,
                                 CASE WHEN customer_id % 37 = 2 THEN '0' ELSE branch_id END AS branch_id)
               FROM customers WHERE customer_id % 43 <> 0),
           next_day AS (
               SELECT * FROM tomorrow UNION ALL SELECT * FROM tomorrow WHERE customer_id % 53 = 3
               UNION ALL SELECT * REPLACE (customer_id + 10000000 AS customer_id) FROM tomorrow WHERE customer_id % 59 = 4),
           gone AS (FROM customers EXCEPT ALL FROM next_day),
           new AS (FROM next_day EXCEPT ALL FROM customers),
           counts AS (
               SELECT customer_id, sum(g) AS gone, sum(n) AS new
               FROM (SELECT customer_id, 1 AS g, 0 AS n FROM gone UNION ALL SELECT customer_id, 0, 1 FROM new) GROUP BY customer_id),
           kinds AS (
               SELECT customer_id, gone, new, (SELECT count(*) FROM (SELECT DISTINCT * FROM new) d WHERE d.customer_id = c.customer_id) AS shapes
               FROM counts c)
           SELECT k.customer_id, 'changed' AS change,
                  concat_ws(',', CASE WHEN g.deposit_balance_manyen IS DISTINCT FROM n.deposit_balance_manyen THEN 'deposit_balance_manyen' END,
                            CASE WHEN g.branch_id IS DISTINCT FROM n.branch_id THEN 'branch_id' END) AS changed_columns,
                  CAST(k.new AS BIGINT) AS row_count
           FROM kinds k JOIN gone g USING (customer_id) JOIN (SELECT DISTINCT * FROM new) n USING (customer_id)
           WHERE k.gone = k.new AND k.gone = 1
           UNION ALL SELECT customer_id, 'removed', NULL, CAST(gone AS BIGINT) FROM kinds WHERE gone > 0 AND NOT (gone = new AND gone = 1)
           UNION ALL SELECT customer_id, 'added', NULL, CAST(new AS BIGINT) FROM kinds WHERE new > 0 AND NOT (gone = new AND gone = 1)""",
        "customers",
    ),
    "null_profile": _null_profile(),
    "column_profile": _column_profile("customers", _CUSTOMER_TYPES),
    "document_profile": _column_profile("documents", _DOCUMENT_TYPES),
    "frequent_values": _frequent_values("customers", _CUSTOMER_TYPES, 100),
    "document_frequent_values": _frequent_values("documents", _DOCUMENT_TYPES, 100),
    "customers_silver": _with(f"SELECT {_SILVER} FROM silver", "silver"),
    "not_null_filter": _with(
        f"SELECT {_CUSTOMERS} FROM customers WHERE deposit_balance_manyen IS NOT NULL", "customers"
    ),
    "high_deposit": _with(
        f"SELECT {_CUSTOMERS} FROM customers WHERE deposit_balance_manyen >= 1000", "customers"
    ),
    "zero_asset": _with(
        f"""SELECT {_CUSTOMERS} FROM customers
            WHERE deposit_balance_manyen IS NOT NULL AND managed_asset_manyen = 0""",
        "customers",
    ),
    "target_customers": _with(_TARGET_ROWS, "targets"),
    "target_filter": _with(
        _TARGET_ROWS + " WHERE prefecture IN ('ASIA', 'EUROPE') AND segment IN ('BUILDING', 'MACHINERY')",
        "targets",
    ),
    "segment_targets": _with(_TARGET_ROWS + " WHERE segment = 'BUILDING'", "targets"),
    "negative_samples": _with(
        f"""SELECT {_VOICE}, sentiment FROM (
                SELECT * FROM voice_silver WHERE sentiment = 'negative'
                ORDER BY received_date DESC, voice_id LIMIT 5)""",
        "voice_silver",
    ),
    "display_columns": _display_columns(),
    "join_branch": _with(
        f"""SELECT {_CUSTOMERS}, {_BRANCH} FROM (
                SELECT c.*, {_BRANCH} FROM customers c LEFT JOIN branch b ON c.branch_id = b.branch_id)""",
        "customers",
        "branch",
    ),
    "join_employee": _with(
        f"""SELECT {_CUSTOMERS}, employee_name FROM (
                SELECT c.*, employee_name FROM customers c LEFT JOIN employee e ON c.employee_id = e.employee_id)""",
        "customers",
        "employee",
    ),
    "customer_contacts": _with(
        """SELECT s.customer_id, s.name, s.segment, s.branch_id, k.contact_id,
                  strftime(k.contact_date, '%Y-%m-%d') AS contact_date, k.channel, k.product, k.result
           FROM contacts k JOIN silver s ON s.customer_id = k.customer_id""",
        "silver",
        "contacts",
    ),
    "customer_last_contact": _with(
        """SELECT s.customer_id, s.name, strftime(l.last_contact_date, '%Y-%m-%d') AS last_contact_date,
                  coalesce(l.contact_count, 0) AS contact_count
           FROM silver s LEFT JOIN last_contacts l ON s.customer_id = l.customer_id""",
        "silver",
        "last_contacts",
    ),
    "untouched_anti": _with(
        f"""SELECT s.customer_id, s.name
            FROM silver s LEFT JOIN last_contacts l ON s.customer_id = l.customer_id
            WHERE l.last_contact_date IS NULL OR l.last_contact_date < {CUTOFF}""",
        "silver",
        "last_contacts",
    ),
    "duplicate_keys": _with(
        """SELECT sku_name, count(*) AS row_count FROM list_prices GROUP BY sku_name HAVING count(*) > 1""",
        "list_prices",
    ),
    "usage_cost": _with(
        """SELECT u.sku_name, CAST(sum(usage_quantity) AS DOUBLE) AS total_dbus,
                  CAST(sum(usage_quantity * price) AS DOUBLE) AS cost
           FROM usage u LEFT JOIN (SELECT sku_name, max(price) AS price FROM list_prices GROUP BY sku_name) p
                ON u.sku_name = p.sku_name
           GROUP BY u.sku_name""",
        "usage",
        "list_prices",
    ),
    "usage_cost_by_period": _with(
        """SELECT sku_name, CAST(sum(usage_quantity) AS DOUBLE) AS total_dbus,
                  CAST(coalesce(sum(usage_quantity) FILTER (price IS NULL), 0) AS DOUBLE) AS unpriced_dbus,
                  CAST(sum(usage_quantity * price) AS DOUBLE) AS cost
           FROM priced_usage GROUP BY sku_name""",
        "priced_usage",
    ),
    "cost_by_tag_by_period": _with(
        """SELECT coalesce(cost_center, 'untagged') AS cost_center, CAST(sum(usage_quantity) AS DOUBLE) AS total_dbus,
                  CAST(coalesce(sum(usage_quantity) FILTER (price IS NULL), 0) AS DOUBLE) AS unpriced_dbus,
                  CAST(sum(usage_quantity * price) AS DOUBLE) AS cost
           FROM priced_usage GROUP BY ALL""",
        "priced_usage",
    ),
    "governed_targets": _with(
        f"""SELECT * REPLACE (CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE 'user_' || (s_suppkey % 40) = seen_by
                                                AND s_suppkey % 10 = 1)
                                  THEN phone_number
                                  ELSE regexp_replace(phone_number, '[0-9０-９]', '*', 'g') END AS phone_number)
            FROM ({_TARGET_ROWS}) t CROSS JOIN (VALUES ('user_1'), ('user_2')) u(seen_by)
            WHERE EXISTS (SELECT 1 FROM supplier WHERE 'user_' || (s_suppkey % 40) = seen_by
                          AND CAST(s_nationkey AS VARCHAR) = branch_id)""",
        "targets",
    ),
    "target_breakdown": _with(
        """SELECT prefecture, branch_id, branch_name, segment, count(*) AS targets,
                  CAST(sum(deposit_balance_manyen) AS DOUBLE) AS total_deposit_manyen
           FROM targets GROUP BY ALL""",
        "targets",
    ),
    "filtered_kpis": _with(
        """SELECT count(*) AS target_count,
                  CAST(coalesce(sum(deposit_balance_manyen), 0) AS DOUBLE) AS total_deposit_manyen
           FROM targets WHERE prefecture IN ('ASIA', 'EUROPE') AND segment IN ('BUILDING', 'MACHINERY')""",
        "targets",
    ),
    "cost_by_product": _with(
        """SELECT product, CAST(sum(usage_quantity) AS DOUBLE) AS total_dbus,
                  CAST(coalesce(sum(usage_quantity) FILTER (WHERE price IS NULL), 0) AS DOUBLE) AS unpriced_dbus,
                  CAST(sum(usage_quantity * price) AS DOUBLE) AS cost
           FROM usage u LEFT JOIN (SELECT sku_name, max(price) AS price FROM list_prices GROUP BY sku_name) p
                ON u.sku_name = p.sku_name
           GROUP BY ALL""",
        "usage",
        "list_prices",
    ),
    "group_closure": _with('SELECT member, grp AS "group" FROM closure', "closure"),
    "all_memberships": _with(
        """SELECT 'user_' || (s_suppkey % 40) AS user, 'advisers_' || (s_suppkey % 10) AS "group" FROM supplier
           UNION
           SELECT 'user_' || (s_suppkey % 40), grp FROM supplier JOIN closure ON member = 'advisers_' || (s_suppkey % 10)""",
        "closure",
    ),
    "granted_row_filter": _with(
        f"""SELECT {_CUSTOMERS} FROM customers WHERE branch_id IN (
                SELECT b.branch_id
                FROM supplier s JOIN branch own ON own.branch_id = CAST(s_nationkey AS VARCHAR)
                JOIN branch b ON CASE WHEN s_suppkey % 11 = 0 THEN b.prefecture = own.prefecture
                                      WHEN s_suppkey % 7 = 0 THEN b.prefecture = own.prefecture AND b.area = own.area
                                      ELSE b.branch_id = own.branch_id END
                WHERE 'user_' || (s_suppkey % 40) = 'user_1')""",
        "customers",
        "branch",
    ),
    "row_filter": _with(
        f"""SELECT {_CUSTOMERS} FROM customers WHERE branch_id IN (
                SELECT CAST(s_nationkey AS VARCHAR) FROM supplier
                WHERE 'user_' || (s_suppkey % 40) = 'user_1')""",
        "customers",
    ),
    "customer_count": _with("SELECT count(*) AS customers FROM silver", "silver"),
    "segment_counts": _with("SELECT segment, count(*) AS customers FROM silver GROUP BY segment", "silver"),
    "branch_avg_deposit": _with(
        """SELECT branch_id, branch_name, count(*) AS customers,
                  CAST(sum(deposit_balance_manyen) AS DOUBLE) / count(*) AS avg_deposit_manyen
           FROM silver GROUP BY branch_id, branch_name""",
        "silver",
    ),
    "targets_by_branch": _with(
        "SELECT branch_id, branch_name, count(*) AS targets FROM targets GROUP BY branch_id, branch_name", "targets"
    ),
    "targets_by_prefecture": _with(
        "SELECT prefecture, count(*) AS targets FROM targets GROUP BY prefecture", "targets"
    ),
    "last_contact": _with(
        """SELECT customer_id, strftime(last_contact_date, '%Y-%m-%d') AS last_contact_date, contact_count
           FROM last_contacts""",
        "last_contacts",
    ),
    "recent_contacts": _with(
        f"SELECT customer_id FROM last_contacts WHERE last_contact_date >= {CUTOFF}", "last_contacts"
    ),
    "target_deposits_by_branch": _with(
        """SELECT branch_id, branch_name, CAST(sum(deposit_balance_manyen) AS DOUBLE) AS total_deposit_manyen
           FROM targets GROUP BY branch_id, branch_name""",
        "targets",
    ),
    "sentiment_counts": _with(
        "SELECT sentiment, count(*) AS comments FROM voice_silver GROUP BY sentiment", "voice_silver"
    ),
    "negative_by_channel": _with(
        "SELECT channel, count(*) AS comments FROM voice_silver WHERE sentiment = 'negative' GROUP BY channel",
        "voice_silver",
    ),
    "branch_segment_heatmap": _with(
        _heatmap("targets", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]), "targets"
    ),
    "usage_7d": _with(
        f"""SELECT strftime(usage_date, '%Y-%m-%d') AS usage_date, sku_name,
                   CAST(sum(usage_quantity) AS DOUBLE) AS total_dbus
            FROM usage WHERE usage_date >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY ALL""",
        "usage",
    ),
    "usage_by_product": _with(
        "SELECT product, CAST(sum(usage_quantity) AS DOUBLE) AS total_dbus FROM usage GROUP BY product", "usage"
    ),
    "cost_by_tag": _with(
        """SELECT coalesce(cost_center, 'untagged') AS cost_center,
                  CAST(sum(usage_quantity) AS DOUBLE) AS total_dbus,
                  CAST(coalesce(sum(CASE WHEN price IS NULL THEN usage_quantity END), 0) AS DOUBLE) AS unpriced_dbus,
                  CAST(sum(usage_quantity * price) AS DOUBLE) AS cost
           FROM usage u LEFT JOIN (SELECT sku_name, max(price) AS price FROM list_prices GROUP BY sku_name) p
                ON u.sku_name = p.sku_name
           GROUP BY ALL""",
        "usage",
        "list_prices",
    ),
    "target_funnel": _with(
        """SELECT 1 AS stage_no, 'all_customers' AS stage, count(*) AS customers FROM silver
           UNION ALL SELECT 2, 'high_deposit', count(*) FROM silver WHERE deposit_balance_manyen >= 1000
           UNION ALL SELECT 3, 'zero_asset', count(*) FROM silver
                     WHERE deposit_balance_manyen >= 1000 AND managed_asset_manyen = 0
           UNION ALL SELECT 4, 'untouched', count(*) FROM targets""",
        "targets",
    ),
    "target_kpis": _with(
        """SELECT count(*) AS target_count,
                  CAST(coalesce(sum(deposit_balance_manyen), 0) AS DOUBLE) AS total_deposit_manyen FROM targets""",
        "targets",
    ),
    "run_status": _with(
        """SELECT task, status, count(*) AS runs,
                  CAST(sum(date_diff('microsecond', started, ended)) AS DOUBLE) / count(*) / 1000000
                      AS avg_seconds,
                  strftime(min(started), '%Y-%m-%d %H:%M:%S.%f') AS first_start,
                  strftime(max(ended), '%Y-%m-%d %H:%M:%S.%f') AS last_end
           FROM runs GROUP BY task, status""",
        "runs",
    ),
    "run_overlap": _with(
        """, steps AS (SELECT task, started AS t, 1 AS d FROM runs WHERE started < ended
                      UNION ALL SELECT task, ended, -1 FROM runs WHERE started < ended),
             moments AS (SELECT task, t, sum(d) AS d FROM steps GROUP BY task, t),
             levels AS (SELECT task, t, sum(d) OVER (PARTITION BY task ORDER BY t) AS n,
                               lead(t) OVER (PARTITION BY task ORDER BY t) AS next_t FROM moments),
             busy AS (SELECT task, CAST(sum(date_diff('microsecond', t, next_t)) FILTER (WHERE n > 0) AS DOUBLE) / 1000000 AS busy_seconds,
                             CAST(max(n) AS BIGINT) AS most_at_once FROM levels GROUP BY task),
             timed AS (SELECT task, count(*) AS timed_runs,
                              CAST(sum(date_diff('microsecond', started, ended)) AS DOUBLE) / 1000000 AS run_seconds
                       FROM runs WHERE started < ended GROUP BY task)
        SELECT task, timed_runs, run_seconds, busy_seconds, most_at_once,
               (SELECT strftime(min(t), '%Y-%m-%d %H:%M:%S.%f') FROM levels l WHERE l.task = b.task AND l.n = b.most_at_once) AS peak_from
        FROM busy b JOIN timed USING (task)""",
        "runs",
    ),
    "run_levels": _with(
        """, steps AS (SELECT started AS t, 1 AS d FROM runs WHERE started < ended
                      UNION ALL SELECT ended, -1 FROM runs WHERE started < ended),
             moments AS (SELECT t, sum(d) AS d FROM steps GROUP BY t),
             levels AS (SELECT t, sum(d) OVER (ORDER BY t) AS n, lead(t) OVER (ORDER BY t) AS next_t FROM moments)
        SELECT CAST(n AS BIGINT) AS at_once, CAST(sum(date_diff('microsecond', t, next_t)) AS DOUBLE) / 1000000 AS seconds
        FROM levels WHERE n > 0 GROUP BY n""",
        "runs",
    ),
    "last_attempts": _with(
        """, placed AS (SELECT *, CAST(started AS DATE) AS d,
                              row_number() OVER (PARTITION BY task, CAST(started AS DATE) ORDER BY started DESC, run_id DESC) AS place FROM runs)
        SELECT task, CAST(d AS VARCHAR) AS day, count(*) AS attempts, count(*) FILTER (WHERE status <> 'SUCCESS') AS unsuccessful,
               max(run_id) FILTER (WHERE place = 1) AS last_run, max(status) FILTER (WHERE place = 1) AS last_status,
               bool_or(status <> 'SUCCESS') AND max(status) FILTER (WHERE place = 1) = 'SUCCESS' AS recovered
        FROM placed GROUP BY task, d""",
        "runs",
    ),
    "audit_summary": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, 'user_' || user_id AS actor, event_type AS action,
               count(*) AS actions
        FROM events GROUP BY ALL""",
    "target_list": _with(_TARGET_ROWS + " ORDER BY deposit_balance_manyen DESC, customer_id", "targets"),
    "target_follow_up": _with(
        f"""SELECT {_CUSTOMERS}, {_BRANCH}, strftime(last_contact_date, '%Y-%m-%d') AS last_contact_date,
                   contact_count
            FROM (SELECT t.*, l.last_contact_date, coalesce(l.contact_count, 0) AS contact_count
                  FROM targets t LEFT JOIN last_contacts l ON t.customer_id = l.customer_id)""",
        "targets",
        "last_contacts",
    ),
    "phone_mask": _with(
        "SELECT customer_id, regexp_replace(phone_number, '[0-9０-９]', '*', 'g') AS phone_number FROM customers",
        "customers",
    ),
    "group_gated_mask": _with(
        """SELECT customer_id,
                  CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 40 = 1 AND s_suppkey % 10 = 1)
                       THEN phone_number ELSE regexp_replace(phone_number, '[0-9０-９]', '*', 'g') END AS phone_member,
                  CASE WHEN EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 40 = 2 AND s_suppkey % 10 = 1)
                       THEN phone_number ELSE regexp_replace(phone_number, '[0-9０-９]', '*', 'g') END AS phone_other
           FROM customers""",
        "customers",
    ),
    "voice_sentiment": _with(f"SELECT {_VOICE}, sentiment FROM voice_silver", "voice_silver"),
    "voice_classify": _voice_classify(),
    "text_classify": _text_classify(),
    "text_assign_quality": f"""
        WITH judged AS (SELECT d.doc_id, d.text, 'quality_' || l.quality AS label
                        FROM documents d JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL AND l.quality IS NOT NULL),
             used AS (SELECT label, left(md5(w), 4) AS slot, count(*) AS uses
                      FROM (SELECT label, unnest({_TOKENS.format(text="text")}) AS w FROM judged) WHERE w <> '' GROUP BY ALL),
             labels_ AS (SELECT label, CAST(floor(1000 * ln(count(*) / (SELECT count(*) FROM judged))) AS BIGINT) AS prior
                         FROM judged GROUP BY label),
             sizes AS (SELECT label, prior, CAST(floor(1000 * ln(coalesce((SELECT sum(uses) FROM used u WHERE u.label = l.label), 0) + 65536)) AS BIGINT) AS size
                       FROM labels_ l),
             gains AS (SELECT label, slot, CAST(floor(1000 * ln(uses + 1)) AS BIGINT) AS gain FROM used),
             asked AS (SELECT doc_id, left(md5(w), 4) AS slot, count(*) AS n
                       FROM (SELECT doc_id, unnest({_TOKENS.format(text="text")}) AS w FROM documents) WHERE w <> '' GROUP BY ALL),
             lengths AS (SELECT doc_id, sum(n) AS n FROM asked GROUP BY doc_id),
             sums AS (SELECT doc_id, label, sum(n * gain) AS gain FROM asked JOIN gains USING (slot) GROUP BY ALL),
             scores AS (SELECT d.doc_id, s.label, s.prior + coalesce(g.gain, 0) - coalesce(n.n, 0) * s.size AS score
                        FROM documents d CROSS JOIN sizes s LEFT JOIN lengths n USING (doc_id)
                        LEFT JOIN sums g ON g.doc_id = d.doc_id AND g.label = s.label WHERE d.text IS NOT NULL),
             placed AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS place FROM scores)
        SELECT d.doc_id, a.label, CAST(a.score - b.score AS BIGINT) AS margin
        FROM documents d LEFT JOIN placed a ON a.doc_id = d.doc_id AND a.place = 1 LEFT JOIN placed b ON b.doc_id = d.doc_id AND b.place = 2""",
    "text_summarise": _text_summarise(),
    "text_mask": _text_mask(),
    "silver_prepare": _with(
        f"""SELECT 'customers_silver' AS table_name, {_row_digest(_SILVER_NAMES)} AS row_md5 FROM silver
           UNION ALL SELECT 'customer_voice_silver', {_row_digest([*schemas.CUSTOMER_VOICE.names, "sentiment"])}
           FROM voice_silver""",
        "silver",
        "voice_silver",
    ),
    "gold_refresh": _with(_GOLD, "targets"),
}

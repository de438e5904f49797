"""

Every query runs over whole tables. ``_plain`` turns decimals into doubles and dates into text at the very
end, so that two engines can be compared value by value; the operators themselves keep exact types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.oracle import ORACLE
from depositlens import schemas
from depositlens.functions import lexicon
from depositlens.functions.dates import months_back
from depositlens.functions.masking import mask_phone
from depositlens.operators import access, groups, labelling, profile, quality, silver, targets, timeline, usage, voice
from depositlens.plans.prepare import CUSTOMERS_SILVER, VOICE_SILVER, prepare_silver
from depositlens.plans.refresh import DATASETS, refresh_gold
from depositlens.sources import namespace
from depositlens.sources.adapters import AS_OF, Tables
from depositlens.sources.files import read_csv, write_csv
from depositlens.sources.shared import fresh_path, remove_path
from depositlens.sources.tables import ingest_bronze, load_table, save_all, save_contacts, save_table
from depositlens.sources.versions import MARK

try:  # the corpus operators may be taken out
    from depositlens.llm import queries as llm
except ImportError:
    llm = None

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
USER, OTHER_USER, GROUP = "user_1", "user_2", "advisers_1"


def _plain(df: DataFrame) -> DataFrame:
    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, T.DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, T.TimestampNTZType | T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return value.alias(field.name)

    return df.select(*(column(field) for field in df.schema.fields))


# --- inputs -------------------------------------------------------------------------------------------


def _silver(t: Tables) -> DataFrame:
    return silver.customers_silver(t.customers(), t.branch(), t.employee())


def _cleansed(t: Tables) -> DataFrame:
    """Silver rows for questions about customer columns only: the lookup joins would add nothing."""
    return silver.drop_missing(t.customers())


def _with_branch(t: Tables) -> DataFrame:
    """Silver rows for questions by branch or prefecture."""
    return silver.join_branch(_cleansed(t), t.branch())


def _targets(t: Tables, customers: DataFrame) -> DataFrame:
    return targets.target_customers(customers, t.contacts(), AS_OF)


def _voice(t: Tables) -> DataFrame:
    return voice.voice_sentiment(t.customer_voice())


def _bronze_frames(t: Tables) -> dict[str, DataFrame]:
    return {name: getattr(t, name)() for name in schemas.BRONZE}


def _new_database(spark: SparkSession) -> str:
    """A database of its own for each call, with its tables below the shared folder."""
    name = f"run_{uuid.uuid4().hex}"
    namespace.create_schema(spark, name, "tables of one run", fresh_path(spark, "tables"))
    return name


def _digests(df: DataFrame, table: str) -> DataFrame:
    """A digest of each row, all columns, that another engine can compute too."""
    values = (F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("∅")) for name in df.columns)
    return df.select(F.lit(table).alias("table_name"), F.md5(F.concat_ws("|", *values)).alias("row_md5"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- queries that write and read back -----------------------------------------------------------------


def _csv_scan(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "voice-csv")
    write_csv(t.customer_voice(), path)
    return read_csv(t.spark, path, schemas.CUSTOMER_VOICE, free_text=True)


def _bronze_ingest(t: Tables) -> DataFrame:
    landing, database = fresh_path(t.spark, "landing"), _new_database(t.spark)
    frames = _bronze_frames(t)
    save_all(t.spark, [partial(write_csv, frame, f"{landing}/{name}") for name, frame in frames.items()])
    ingest_bronze(t.spark, landing, database)
    remove_path(t.spark, landing)
    tables = {name: load_table(t.spark, database, f"{name}_bronze") for name in schemas.BRONZE}
    return _union([_digests(df.select(*schemas.BRONZE[name].names), name) for name, df in tables.items()])


def _silver_roundtrip(t: Tables) -> DataFrame:
    database = _new_database(t.spark)
    save_table(_silver(t), database, "customers_silver")
    return load_table(t.spark, database, "customers_silver")


def _prepared(t: Tables) -> str:
    database = _new_database(t.spark)
    frames = _bronze_frames(t)
    saves = [
        partial(save_table, frame, database, f"{name}_bronze") for name, frame in frames.items() if name != "contacts"
    ]
    save_all(t.spark, [partial(save_contacts, frames["contacts"], database), *saves])
    prepare_silver(t.spark, database)
    return database


def _drop_all_but(t: Tables, database: str, kept: tuple[str, ...]) -> None:
    """Tables that the result does not read go with their files."""
    for table in t.spark.catalog.listTables(database):
        if table.name.split(MARK)[0] not in kept:
            namespace.drop_table(t.spark, f"`{database}`.`{table.name}`")


def _silver_prepare(t: Tables) -> DataFrame:
    database, tables = _prepared(t), (CUSTOMERS_SILVER, VOICE_SILVER)
    _drop_all_but(t, database, tables)
    return _union([_digests(load_table(t.spark, database, name), name) for name in tables])


def _gold_refresh(t: Tables) -> DataFrame:
    database = _prepared(t)
    refresh_gold(t.spark, database, SEGMENTS, AS_OF)
    _drop_all_but(t, database, DATASETS)

    def rows(dataset: str, label: Column, measure: Column) -> DataFrame:
        return load_table(t.spark, database, dataset).select(
            F.lit(dataset).alias("dataset"), label.alias("label"), measure.cast("decimal(38,2)").alias("measure")
        )

    deposit, count = F.col("total_deposit_manyen"), F.col("targets")
    target_rows = _digests(load_table(t.spark, database, "target_list"), "target_list")
    heat = load_table(t.spark, database, "branch_segment_heatmap").unpivot(
        "branch_name", [*SEGMENTS, "other_segments"], "segment", "customers"
    )
    return _union(
        [
            target_rows.select(
                F.col("table_name").alias("dataset"),
                F.col("row_md5").alias("label"),
                F.lit(1).cast("decimal(38,2)").alias("measure"),
            ),
            rows("target_kpis", F.lit("target_count"), F.col("target_count")),
            rows("target_kpis", F.lit("total_deposit_manyen"), deposit),
            rows("targets_by_branch", F.col("branch_name"), count),
            rows("target_deposits_by_branch", F.col("branch_name"), deposit),
            rows("target_breakdown", F.concat_ws("/", "prefecture", "branch_name", "segment"), deposit),
            heat.select(
                F.lit("branch_segment_heatmap").alias("dataset"),
                F.concat_ws("/", "branch_name", "segment").alias("label"),
                F.col("customers").cast("decimal(38,2)").alias("measure"),
            ),
        ]
    )


# --- registration -------------------------------------------------------------------------------------


def _gated_phones(t: Tables) -> DataFrame:
    """The same column as a member of the group and as another user see it."""
    customers, members = t.customers(), t.memberships()
    both = customers.select(
        "customer_id", F.col("phone_number").alias("phone_member"), F.col("phone_number").alias("phone_other")
    )
    seen = access.gated_mask(both, members, USER, GROUP, "phone_member")
    return access.gated_mask(seen, members, OTHER_USER, GROUP, "phone_other")


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # sources, sinks, checks
    "csv_scan": _csv_scan,
    "bronze_ingest": _bronze_ingest,
    "silver_roundtrip": _silver_roundtrip,
    "preview": lambda t: quality.preview(t.customers(), "customer_id"),
    "row_reconcile": lambda t: quality.row_reconcile(t.customers(), _silver(t)),
    "row_diff": lambda t: quality.row_diff(t.customers(), t.customers_next_day(), "customer_id"),
    "null_profile": lambda t: quality.null_profile(t.customers()),
    "column_profile": lambda t: profile.column_profile(t.customers()),
    "document_profile": lambda t: profile.column_profile(t.raw("documents")),
    "frequent_values": lambda t: profile.frequent_values(t.customers(), 100),
    "document_frequent_values": lambda t: profile.frequent_values(t.raw("documents"), 100),
    # projections, filters
    "customers_silver": _silver,
    "not_null_filter": lambda t: silver.drop_missing(t.customers()),
    "high_deposit": lambda t: targets.high_deposit(_cleansed(t)),
    "zero_asset": lambda t: targets.zero_asset(_cleansed(t)),
    "target_customers": lambda t: _targets(t, _with_branch(t)),
    "target_filter": lambda t: targets.target_filter(
        _targets(t, _with_branch(t)), prefectures=["ASIA", "EUROPE"], segments=["BUILDING", "MACHINERY"]
    ),
    "segment_targets": lambda t: targets.target_filter(_targets(t, _with_branch(t)), segments=["BUILDING"]),
    "negative_samples": lambda t: voice.negative_samples(_voice(t)),
    "display_columns": lambda t: silver.display_columns(t.customers()),
    # joins
    "join_branch": lambda t: silver.join_branch(t.customers(), t.branch()),
    "join_employee": lambda t: silver.join_employee(t.customers(), t.employee()),
    "customer_contacts": lambda t: targets.customer_contacts(
        _cleansed(t).select("customer_id", "name", "segment", "branch_id"), t.contacts()
    ),
    "customer_last_contact": lambda t: targets.customer_last_contact(
        _cleansed(t).select("customer_id", "name"), t.contacts()
    ),
    "untouched_anti": lambda t: targets.untouched(
        _cleansed(t).select("customer_id", "name"), t.contacts(), AS_OF
    ),
    "duplicate_keys": lambda t: quality.duplicate_keys(t.list_prices(), "sku_name"),
    "usage_cost": lambda t: usage.usage_cost(t.usage(), t.list_prices(), "highest"),
    "usage_cost_by_period": lambda t: usage.usage_cost_by_period(
        t.usage(), t.price_periods(), "valid_from", "valid_to", "highest"
    ),
    "cost_by_tag_by_period": lambda t: usage.cost_by_tag(
        t.usage(), t.price_periods(), "cost_center", "highest", "valid_from", "valid_to"
    ),
    "governed_targets": lambda t: _union(
        [
            access.governed(_targets(t, _with_branch(t)), t.entitlements(), t.memberships(), user, GROUP).withColumn(
                "seen_by", F.lit(user)
            )
            for user in (USER, OTHER_USER)
        ]
    ),
    "group_closure": lambda t: groups.group_closure(t.group_nesting()),
    "all_memberships": lambda t: groups.all_memberships(t.memberships(), t.group_nesting()),
    "granted_row_filter": lambda t: access.row_filter(
        t.customers(), groups.granted_branches(t.grants(), t.branch()), USER
    ),
    "row_filter": lambda t: access.row_filter(t.customers(), t.entitlements(), USER),
    # aggregations
    "customer_count": lambda t: targets.customer_count(_cleansed(t)),
    "segment_counts": lambda t: targets.segment_counts(_cleansed(t)),
    "branch_avg_deposit": lambda t: targets.branch_avg_deposit(_cleansed(t), t.branch()),
    "targets_by_branch": lambda t: targets.count_by_branch(_targets(t, _cleansed(t)), t.branch()),
    "targets_by_prefecture": lambda t: targets.count_by_prefecture(_targets(t, _cleansed(t)), t.branch()),
    "last_contact": lambda t: targets.last_contact(t.contacts()),
    "recent_contacts": lambda t: targets.recently_contacted(t.contacts(), months_back(AS_OF, 6)),
    "target_deposits_by_branch": lambda t: targets.deposits_by_branch(_targets(t, _cleansed(t)), t.branch()),
    "sentiment_counts": lambda t: voice.sentiment_counts(_voice(t)),
    "negative_by_channel": lambda t: voice.negative_by_channel(_voice(t)),
    "branch_segment_heatmap": lambda t: targets.branch_segment_heatmap(
        _targets(t, _cleansed(t)), t.branch(), SEGMENTS[:4]
    ),
    "target_breakdown": lambda t: targets.target_breakdown(_targets(t, _cleansed(t)), t.branch()),
    "filtered_kpis": lambda t: targets.breakdown_kpis(
        targets.target_filter(
            targets.target_breakdown(_targets(t, _cleansed(t)), t.branch()),
            prefectures=["ASIA", "EUROPE"],
            segments=["BUILDING", "MACHINERY"],
        )
    ),
    "cost_by_product": lambda t: usage.cost_by_product(t.usage(), t.list_prices(), "highest"),
    "usage_7d": lambda t: usage.usage_window(t.usage(), AS_OF),
    "usage_by_product": lambda t: usage.usage_by_product(t.usage()),
    "cost_by_tag": lambda t: usage.cost_by_tag(t.usage(), t.list_prices(), "cost_center", "highest"),
    "target_funnel": lambda t: targets.target_funnel(_cleansed(t), t.contacts(), AS_OF),
    "target_kpis": lambda t: targets.target_kpis(_targets(t, _cleansed(t))),
    "run_status": lambda t: usage.run_status(t.runs()),
    "run_overlap": lambda t: timeline.run_overlap(t.runs(), "task"),
    "run_levels": lambda t: timeline.level_seconds(t.runs()),
    "last_attempts": lambda t: timeline.last_attempts(t.runs(), "task"),
    "audit_summary": lambda t: usage.audit_summary(t.audit()),
    # sorts
    "target_list": lambda t: targets.target_list(_targets(t, _with_branch(t))),
    "target_follow_up": lambda t: targets.target_follow_up(_with_branch(t), t.contacts(), AS_OF),
    # masking
    "phone_mask": lambda t: t.customers().select(
        "customer_id", mask_phone(F.col("phone_number")).alias("phone_number")
    ),
    "group_gated_mask": _gated_phones,
    # free text
    "voice_sentiment": _voice,
    "voice_classify": lambda t: voice.classify_by_substrings(t.customer_voice()),
    "text_classify": lambda t: voice.classify_by_words(t.documents(), "text", lexicon.LANGUAGE_WORDS).drop(
        "text"
    ),
    "text_assign_quality": lambda t: labelling.assign_labels(
        t.documents(), labelling.fit_labels(t.documents(), "text", "quality", judged=t.qualities(), key="doc_id"), "doc_id", "text"
    ),
    "text_summarise": lambda t: voice.summarise(t.documents(), "text").drop("text"),
    "text_mask": lambda t: voice.mask_personal_data(t.documents(), "text"),
    # daily job
    "silver_prepare": _silver_prepare,
    "gold_refresh": _gold_refresh,
}


def _runner(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _plain(query(Tables(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: how many customers to call has each branch?"""
    return queries()["targets_by_branch"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(query) for name, query in _QUERIES.items()} | (dict(llm.QUERIES) if llm else {})


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE) | (dict(llm.ORACLE) if llm else {})

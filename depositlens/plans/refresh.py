"""Daily refresh: the dashboard datasets from the Silver tables.

Run it after :func:`depositlens.plans.prepare.prepare_silver`; an exception there keeps it from starting.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from depositlens.functions.dates import AsOf
from depositlens.operators import targets as t
from depositlens.plans.prepare import CUSTOMERS_SILVER
from depositlens.sources.tables import CONTACT_MONTH, load_table, save_all
from depositlens.sources.versions import publish, write_version

TARGETS = "target_list"
DATASETS = (TARGETS, "target_kpis", "targets_by_branch", "target_deposits_by_branch", "branch_segment_heatmap", "target_breakdown")


def refresh_gold(spark: SparkSession, database: str, segments: Sequence[str], as_of: AsOf = None) -> list[str]:
    """Regenerate the six datasets; returns their names. They change over together, once all are written.

    The targets are found once and written as the target list. The aggregates read that table, which is a
    small share of the customers, instead of repeating the join with the contacts.
    """
    silver = load_table(spark, database, CUSTOMERS_SILVER)
    contacts = load_table(spark, database, "contacts_bronze")
    branch = load_table(spark, database, "branch_bronze")
    found = t.target_customers(silver, contacts, as_of, month_column=CONTACT_MONTH)
    # unsorted: a table has no order, sort with target_list when showing it
    versions = {TARGETS: write_version(found, database, TARGETS)}
    targets = load_table(spark, database, versions[TARGETS])
    datasets = {
        "target_kpis": t.target_kpis(targets),
        "targets_by_branch": t.count_by_branch(targets, branch),
        "target_deposits_by_branch": t.deposits_by_branch(targets, branch),
        "branch_segment_heatmap": t.branch_segment_heatmap(targets, branch, segments),
        "target_breakdown": t.target_breakdown(targets, branch),
    }

    def write(name: str, df: DataFrame) -> None:
        versions[name] = write_version(df, database, name)

    save_all(spark, [partial(write, name, df) for name, df in datasets.items()])
    publish(spark, database, versions)
    return list(DATASETS)

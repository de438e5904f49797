"""Daily preparation: both Silver tables from the Bronze tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from depositlens.operators.quality import require_unique
from depositlens.operators.silver import customers_silver
from depositlens.operators.voice import voice_sentiment
from depositlens.sources.tables import load_table, save_all
from depositlens.sources.versions import publish, write_version

CUSTOMERS_SILVER = "customers_silver"
VOICE_SILVER = "customer_voice_silver"


def prepare_silver(spark: SparkSession, database: str) -> list[str]:
    """Regenerate the Silver tables; returns their names. A lookup table with a repeated key is an error.

    Neither needs a shuffle while the lookup tables are small: rows go from scan to file in one stage.
    """
    bronze = {
        name: load_table(spark, database, f"{name}_bronze")
        for name in ("customers", "branch", "employee", "customer_voice")
    }
    require_unique(bronze["branch"], "branch", "branch_id")
    require_unique(bronze["employee"], "employee", "employee_id")
    customers = customers_silver(bronze["customers"], bronze["branch"], bronze["employee"])
    comments = voice_sentiment(bronze["customer_voice"])
    versions: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> None:
        versions[name] = write_version(df, database, name)

    save_all(spark, [partial(write, CUSTOMERS_SILVER, customers), partial(write, VOICE_SILVER, comments)])
    publish(spark, database, versions)
    return [CUSTOMERS_SILVER, VOICE_SILVER]

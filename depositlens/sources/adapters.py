"""The domain tables as projections of a retail star schema in parquet files.

Each adapter covers its whole source table: columns are derived, rows are never dropped. The derived
columns plant what the operators must cope with: missing deposits, customers of unknown employees,
contacts of nobody, usage without tags, comments without text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depositlens import schemas

# The day of the last order plays today.
AS_OF = "2001-08-01"

# Declared, so that no job has to open files to find the types out.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_partkey long, l_quantity double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int",
}

COMMENT_PHRASES = (
    "新しい店内は快適で、職員の案内も迅速でした。",
    "駐車場が狭くて残念です。",
    "通帳を繰り越しました。",
    "サイトは見やすいですが、入力が複雑です。",
    "入口の階段は不便です。\n手すりがあると嬉しいです。",
    "\"迅速\"とは言えません。書類の間違いもありました。",
    "受付の対応に失礼はありませんでした。",
    "次のセミナーを期待しています。",
    "ATMの表示は見やすくないです。",
)


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.alias("customer_id"),
            F.col("c_name").alias("name"),
            (20 + key % 70).cast("int").alias("age"),
            F.col("c_mktsegment").alias("segment"),
            F.when(key % 20 != 0, F.col("c_acctbal").cast(schemas.MONEY)).alias("deposit_balance_manyen"),
            F.when(key % 3 == 0, 0).otherwise(key % 500).cast(schemas.MONEY).alias("managed_asset_manyen"),
            F.add_months(F.lit(AS_OF).cast("date"), (-12 * (20 + key % 70)).cast("int")).alias("birth_date"),
            F.col("c_nationkey").cast("string").alias("branch_id"),
            (key % 120).cast("string").alias("employee_id"),
            F.when(
                key % 10 == 7,
                F.translate(
                    F.concat(F.lit("0"), 10 + key % 90, F.lit("-"), 1000 + key % 9000, F.lit("-5678")),
                    "0123456789-",
                    "０１２３４５６７８９－",
                ),
            )
            .otherwise(F.concat(F.lit("+1 ("), 200 + key % 700, F.lit(") 555-"), 1000 + key % 9000))
            .alias("phone_number"),
        )

    def customers_next_day(self) -> DataFrame:
        """The customers a day later: some have gone, some have another balance or branch, some are new and some are there twice."""
        key = F.col("customer_id")
        today = self.customers().where((key % 43 != 0) | key.isNull())
        moved = today.withColumns(
            {
                "deposit_balance_manyen": F.when(key % 31 == 1, F.lit(None)).otherwise(F.col("deposit_balance_manyen")).cast(schemas.MONEY),
                "branch_id": F.when(key % 37 == 2, F.lit("0")).otherwise(F.col("branch_id")),
            }
        )
        return moved.unionByName(moved.where(key % 53 == 3)).unionByName(moved.where(key % 59 == 4).withColumn("customer_id", key + 10_000_000))

    def branch(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
            F.col("n_nationkey").cast("string").alias("branch_id"),
            F.col("n_name").alias("branch_name"),
            F.concat(F.lit("AREA_"), F.col("n_nationkey") % 4).alias("area"),
            F.col("r_name").alias("prefecture"),
        )

    def employee(self) -> DataFrame:
        return self.raw("supplier").select(
            F.col("s_suppkey").cast("string").alias("employee_id"),
            F.col("s_name").alias("employee_name"),
            F.col("s_nationkey").cast("string").alias("branch_id"),
            F.when(F.col("s_acctbal") < 0, "TRAINEE").otherwise("SALES").alias("role"),
        )

    def contacts(self) -> DataFrame:
        """Every seventh customer's contacts are not linked to the customer, who is thus never contacted."""
        return self.raw("orders").select(
            F.col("o_orderkey").alias("contact_id"),
            F.when(F.col("o_custkey") % 7 != 3, F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("contact_date"),
            F.col("o_orderpriority").alias("channel"),
            F.concat(F.lit("PRODUCT_"), F.col("o_orderkey") % 5).alias("product"),
            F.col("o_orderstatus").alias("result"),
        )

    def customer_voice(self) -> DataFrame:
        event = F.col("event_id")
        phrases = F.array(*(F.lit(phrase) for phrase in COMMENT_PHRASES))
        phrase = F.element_at(phrases, (event % len(COMMENT_PHRASES) + 1).cast("int"))
        text = F.concat(phrase, F.lit("(顧客 "), F.col("user_id"), F.lit(")"))
        return self.raw("events").select(
            event.alias("voice_id"),
            F.col("ts").cast("date").alias("received_date"),
            F.col("event_type").alias("channel"),
            F.when(event % 50 != 0, text).alias("voice_text"),
        )

    def usage(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.raw("lineitem").select(
            F.col("l_shipdate").cast("date").alias("usage_date"),
            F.concat(F.lit("SKU_"), F.col("l_partkey")).alias("sku_name"),
            F.col("l_quantity").cast(schemas.QUANTITY).alias("usage_quantity"),
            F.when(flag == "A", "JOBS").when(flag == "N", "SQL").otherwise("PIPELINES").alias("product"),
            F.when(flag != "R", F.create_map(F.lit("cost_center"), F.col("l_linestatus"))).alias("tags"),
        )

    def list_prices(self) -> DataFrame:
        """Every eleventh part is listed under another name only, every seventh twice, the second time at half price."""
        key = F.col("p_partkey")
        prefix = F.when(key % 11 == 5, "RETIRED_").otherwise("SKU_")
        prices = self.raw("part").select(
            key, F.concat(prefix, key).alias("sku_name"), F.col("p_retailprice").cast(schemas.PRICE).alias("price")
        )
        again = prices.filter(key % 7 == 0).withColumn("price", (F.col("price") / 2).cast(schemas.PRICE))
        return prices.union(again).drop("p_partkey")

    def price_periods(self) -> DataFrame:
        """Two to three prices per part over time. Every fourth part has none for a year, every seventh two that begin on one day."""
        key = F.col("p_partkey")
        day = lambda text: F.lit(text).cast("date")
        period = lambda start, end, share: F.struct(start.alias("valid_from"), end.alias("valid_to"), F.lit(share).alias("share"))
        none = F.lit(None).cast("date")
        periods = F.array(
            period(F.when(key % 3 == 0, none).otherwise(day("1993-03-01")), F.when(key % 4 == 0, day("1995-01-01")), 4),
            period(day("1996-01-01"), none, 5),
            period(F.when(key % 7 == 0, day("1996-01-01")).otherwise(F.date_add(day("1997-01-01"), (key % 300).cast("int"))), none, 6),
        )
        listed = self.raw("part").select(
            F.concat(F.when(key % 11 == 5, "RETIRED_").otherwise("SKU_"), key).alias("sku_name"),
            F.col("p_retailprice").cast(schemas.PRICE).alias("full"),
            F.explode(periods).alias("period"),
        )
        price = (F.col("full") * F.col("period.share") / 4).cast(schemas.PRICE)
        return listed.select("sku_name", "period.valid_from", "period.valid_to", price.alias("price"))

    def runs(self) -> DataFrame:
        seconds = F.col("value").cast("decimal(12,6)")
        return self.raw("events").select(
            F.col("event_id").alias("run_id"),
            F.concat(F.lit("task_"), F.col("user_id") % 4).alias("task"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
            F.col("ts").alias("started"),
            (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("ended"),
        )

    def audit(self) -> DataFrame:
        return self.raw("events").select(
            "ts",
            F.concat(F.lit("user_"), F.col("user_id")).alias("actor"),
            F.col("event_type").alias("action"),
        )

    def entitlements(self) -> DataFrame:
        """Staff of a branch may see it; there is one row per member of staff, so pairs repeat."""
        return self.raw("supplier").select(
            F.concat(F.lit("user_"), F.col("s_suppkey") % 40).alias("user"),
            F.col("s_nationkey").cast("string").alias("branch_id"),
        )

    def memberships(self) -> DataFrame:
        return self.raw("supplier").select(
            F.concat(F.lit("user_"), F.col("s_suppkey") % 40).alias("user"),
            F.concat(F.lit("advisers_"), F.col("s_suppkey") % 10).alias("group"),
        )

    def group_nesting(self) -> DataFrame:
        """Every customer's number is a team within the team of half the number; the first lies within the fifth, which closes a circle."""
        team = lambda number: F.concat(F.lit("team_"), number)
        key = F.col("c_custkey")
        teams = self.raw("customer").select(
            team(key).alias("member"), team(F.when(key > 1, F.floor(key / 2)).otherwise(5)).alias("group")
        )
        advisers = self.raw("supplier").select(
            F.concat(F.lit("advisers_"), F.col("s_suppkey") % 10).alias("member"),
            team(F.col("s_suppkey") % 10 * 100 + 1).alias("group"),
        )
        return teams.unionByName(advisers)

    def grants(self) -> DataFrame:
        """Staff may see their own branch, one of seven the area, one of eleven the prefecture."""
        staff = self.raw("supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("branch_id"))
        key = F.col("s_suppkey")
        level = F.when(key % 11 == 0, "prefecture").when(key % 7 == 0, "area").otherwise("branch")
        value = F.when(key % 11 == 0, F.col("prefecture")).when(key % 7 == 0, F.concat_ws("/", "prefecture", "area"))
        return staff.join(self.branch(), "branch_id").select(
            F.concat(F.lit("user_"), key % 40).alias("user"), level.alias("level"), F.coalesce(value, "branch_id").alias("value")
        )

    def documents(self) -> DataFrame:
        return self.raw("documents").select("doc_id", "text")

    def qualities(self) -> DataFrame:
        """What somebody has judged some of the documents to be."""
        return self.raw("labels").select("doc_id", F.concat(F.lit("quality_"), F.col("quality")).alias("quality"))

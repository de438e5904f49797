import pytest
from pyspark.sql import functions as F

from depositlens.operators import silver
from depositlens.plans import daily
from depositlens.plans.prepare import prepare_silver
from depositlens.plans.refresh import DATASETS, refresh_gold
from depositlens.sources import namespace, tables
from depositlens.sources.files import write_csv
from depositlens.schemas import BRONZE, CUSTOMER_VOICE
from tests import data


@pytest.fixture
def landing(spark, tmp_path):
    comments = spark.createDataFrame([(1, None, "app", "便利\nです"), (2, None, "app", None)], CUSTOMER_VOICE)
    frames = {
        "customers": data.customers(spark),
        "branch": data.branch(spark),
        "employee": data.employee(spark),
        "contacts": data.contacts(spark),
        "customer_voice": comments,
    }
    for name, frame in frames.items():
        write_csv(frame, str(tmp_path / name))
    return str(tmp_path)


def test_ingest_prepare_refresh(spark, database, landing):
    assert len(tables.ingest_bronze(spark, landing, database)) == 5
    assert prepare_silver(spark, database) == ["customers_silver", "customer_voice_silver"]
    voice = tables.load_table(spark, database, "customer_voice_silver")
    assert {row.voice_id: row.sentiment for row in voice.collect()} == {1: "positive", 2: None}

    assert refresh_gold(spark, database, ["wealthy", "mass"], data.TODAY) == list(DATASETS)
    gold = {name: tables.load_table(spark, database, name) for name in DATASETS}
    assert data.ids(gold["target_list"]) == [3, 7, 8, 10]
    assert gold["target_kpis"].first().target_count == 4
    assert gold["targets_by_branch"].agg(F.sum("targets")).first()[0] == 4
    heat = gold["branch_segment_heatmap"].agg(F.sum(F.col("wealthy") + F.col("mass") + F.col("other_segments")))
    assert heat.first()[0] == 4

    # a second day: the same tables are written anew from changed input
    poorer = data.customers(spark).withColumn("deposit_balance_manyen", F.lit(1).cast("decimal(15,2)"))
    tables.save_table(poorer, database, "customers_bronze")
    prepare_silver(spark, database)
    refresh_gold(spark, database, ["wealthy", "mass"], data.TODAY)
    assert tables.load_table(spark, database, "target_list").count() == 0
    assert tables.load_table(spark, database, "target_kpis").first().target_count == 0


def test_daily_job(spark, database, landing, capsys):
    spark.sql(f"DROP SCHEMA {database}")  # the job makes it
    daily.main(
        ["--database", database, "--landing", landing, "--as-of", str(data.TODAY), "--segments", "wealthy", "mass"]
        + ["--tags", "team=retail"]
    )
    written = capsys.readouterr().out.split()
    assert len(written) == 5 + 2 + len(DATASETS)
    assert all(spark.catalog.tableExists(name) for name in written)
    assert data.ids(tables.load_table(spark, database, "target_list")) == [3, 7, 8, 10]
    comments = {row.name: row.description for row in spark.catalog.listColumns(f"{database}.customers_silver")}
    assert comments["prefecture"] == "都道府県"
    tags = spark.sql(f"SHOW TBLPROPERTIES {database}.target_kpis").collect()
    assert ("team", "retail") in [tuple(row) for row in tags]


def test_landing_area(spark, tmp_path):
    path = namespace.create_landing(spark, str(tmp_path), "bank", BRONZE)
    assert path == namespace.create_landing(spark, str(tmp_path), "bank", BRONZE)
    (tmp_path / "bank/source_files/branch/part.csv").write_text("branch_id\n")
    (tmp_path / "bank/source_files/employee/_SUCCESS").write_text("done")
    assert namespace.landing_files(spark, path, ["branch", "employee", "other"]) == {"branch": 10, "employee": 0, "other": -1}
    with pytest.raises(FileNotFoundError, match="contacts, customer_voice, customers, employee"):
        namespace.require_delivery(spark, path, BRONZE)


def test_daily_job_without_a_delivery_changes_nothing(spark, database, landing, tmp_path):
    daily.run_daily(spark, database, ["wealthy"], landing, data.TODAY)
    for file in (tmp_path / "employee").glob("part-*"):
        file.rename(file.with_name("_" + file.name))
    before = spark.sql(f"SHOW TBLPROPERTIES {database}.customers_bronze").collect()
    with pytest.raises(FileNotFoundError, match="employee"):
        daily.run_daily(spark, database, ["wealthy"], landing, data.TODAY)
    assert spark.sql(f"SHOW TBLPROPERTIES {database}.customers_bronze").collect() == before


def test_refresh_needs_prepared_tables(spark, database, landing):
    tables.ingest_bronze(spark, landing, database)
    with pytest.raises(Exception, match="customers_silver"):
        refresh_gold(spark, database, ["wealthy"], data.TODAY)


def test_silver_is_one_stage_while_the_lookups_are_small(spark, database, landing):
    tables.ingest_bronze(spark, landing, database)
    frames = [tables.load_table(spark, database, f"{name}_bronze") for name in ("customers", "branch", "employee")]
    text = data.plan(silver.customers_silver(*frames))
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in physical
    assert "PushedFilters: [IsNotNull(deposit_balance_manyen)]" in physical


def test_repeated_lookup_key_stops_the_preparation(spark, database, landing):
    tables.ingest_bronze(spark, landing, database)
    branch = data.branch(spark)
    tables.save_table(branch.union(branch), database, "branch_bronze")
    with pytest.raises(ValueError, match="branch has several rows for branch_id"):
        prepare_silver(spark, database)

import csv
import io
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from depositlens import schemas
from depositlens.operators import targets
from depositlens.sources import namespace, shared, tables, versions
from depositlens.sources.files import read_csv, read_quoted_csv, write_csv
from tests import data


def test_csv_line_ends_quotes_and_breaks(spark, tmp_path):
    header = "voice_id,received_date,channel,voice_text"
    (tmp_path / "lf.csv").write_bytes(f'{header}\n1,2026-07-01,窓口,"一行目、\n""二行目"", 三"\n2,,,\n'.encode())
    (tmp_path / "crlf.csv").write_bytes(f'{header}\r\n3,2026-07-02,電話,短い\r\n'.encode())
    rows = read_csv(spark, str(tmp_path), schemas.CUSTOMER_VOICE, free_text=True).orderBy("voice_id").collect()
    assert [tuple(row) for row in rows] == [
        (1, date(2026, 7, 1), "窓口", '一行目、\n"二行目", 三'),
        (2, None, None, None),
        (3, date(2026, 7, 2), "電話", "短い"),
    ]


def test_csv_without_free_text_strips_carriage_returns(spark, tmp_path):
    (tmp_path / "branch.csv").write_bytes("branch_id,branch_name,area,prefecture\r\nB01,本店,中央,東県\r\n".encode())
    assert tuple(read_csv(spark, str(tmp_path), schemas.BRANCH).first()) == ("B01", "本店", "中央", "東県")


def test_csv_refuses_bad_values(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("voice_id,received_date,channel,voice_text\nx,2026-07-01,a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path), schemas.CUSTOMER_VOICE).collect()


@pytest.mark.parametrize("free_text", [False, True])
def test_csv_refuses_another_header(spark, tmp_path, free_text):
    (tmp_path / "swapped.csv").write_text("branch_id,area,branch_name,prefecture\nB1,a,b,c\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), schemas.BRANCH, free_text).collect()


def test_csv_in_another_encoding(spark, tmp_path):
    lines = "branch_id,branch_name,area,prefecture\nB1,café,a,b\n"
    (tmp_path / "latin.csv").write_bytes(lines.encode("iso-8859-1"))
    assert read_csv(spark, str(tmp_path), schemas.BRANCH, encoding="ISO-8859-1").first().branch_name == "café"


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "customers")
    write_csv(data.customers(spark), path)
    back = read_csv(spark, path, schemas.CUSTOMERS)
    assert back.exceptAll(data.customers(spark)).isEmpty() and back.count() == 10


def test_free_text_round_trip(spark, tmp_path):
    texts = ["", None, " padded ", '"', 'a ""b"", c', "back\\slash", "\\"]
    texts += ["two\nlines", "dos\r\nlines", "，、。", "#", "'"]
    df = spark.createDataFrame([(n, None, "x", text) for n, text in enumerate(texts)], schemas.CUSTOMER_VOICE)
    path = str(tmp_path / "voice")
    write_csv(df, path)
    back = read_csv(spark, path, schemas.CUSTOMER_VOICE, free_text=True).orderBy("voice_id").collect()
    assert [row.voice_text for row in back] == [None, *texts[1:]]


QUOTED = (
    'voice_id,received_date,channel,voice_text\n1,2026-08-18,web,"a\r\nb ""q"" , é"\n2,2026-08-19,,"x\ny\n\nz"\n\n'
    '3,2026-08-20,"tel ",plain\n4,,"",""""\n5,2026-01-01,web,"""\n"""\n6,,,"end\n"'
)


def quoted_rows(text):
    """What the standard library makes of it, line breaks inside quotes kept."""
    rows = [row for row in csv.reader(io.StringIO(text, newline="")) if row][1:]
    return [(int(n), day and date.fromisoformat(day) or None, channel or None, body or None) for n, day, channel, body in rows]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_quoted_file_in_any_number_of_splits(spark, tmp_path, settings, line_end):
    text = QUOTED.replace("\n", line_end) if line_end != "\n" else QUOTED
    text = text.replace("\r\r", "\r")
    (tmp_path / "a.csv").write_bytes(("\ufeff" + text).encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    expected = quoted_rows(text)
    assert len(expected) == 6
    settings({"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"})
    for size in (*range(5, 60, 9), 100, 1000):
        settings({"spark.sql.files.maxPartitionBytes": str(size)})
        found = read_quoted_csv(spark, str(tmp_path), schemas.CUSTOMER_VOICE)
        assert sorted(map(tuple, found.collect())) == expected, size


def test_one_quoted_file_is_read_by_many_tasks(spark, tmp_path, settings):
    rows = "".join(f'{n},,x,"{"line" * (n % 7)}\n""{n}"", \nend"\n' for n in range(4000))
    (tmp_path / "a.csv").write_text("voice_id,received_date,channel,voice_text\n" + rows)
    settings({"spark.sql.files.maxPartitionBytes": "9973"})
    found = read_csv(spark, str(tmp_path), schemas.CUSTOMER_VOICE, free_text=True)
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 10
    assert {row.voice_id: row.voice_text for row in found.collect()} == {n: f'{"line" * (n % 7)}\n"{n}", \nend' for n in range(4000)}


def test_a_quoted_cell_that_does_not_end_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text('voice_id,received_date,channel,voice_text\n1,,x,"open\n2,,x,y\n')
    with pytest.raises(ValueError, match="does not end"):
        read_csv(spark, str(tmp_path), schemas.CUSTOMER_VOICE, free_text=True)


def test_free_text_is_written_to_many_files(spark, tmp_path):
    path = str(tmp_path / "numbers")
    write_csv(spark.range(0, 10, 1, 1), path, max_records_per_file=3)
    assert len([name for name in os.listdir(path) if name.endswith(".csv")]) == 4


def test_table_is_replaced_whole(spark, database):
    tables.save_table(spark.range(5).toDF("a"), database, "t")
    tables.save_table(spark.range(2).toDF("b"), database, "t")
    back = tables.load_table(spark, database, "t")
    assert back.columns == ["b"] and back.count() == 2


def rows_of(spark, database, name):
    return sorted(row[0] for row in tables.load_table(spark, database, name).collect())


def test_a_write_that_fails_half_way_leaves_the_rows_of_before(spark, database):
    tables.save_table(spark.range(3), database, "t")
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.save_table(broken, database, "t")
    assert rows_of(spark, database, "t") == [0, 1, 2]
    assert len(versions.versions_of(spark, database, "t")) == 1


def test_a_table_that_lacks_rows_is_not_shown(spark, database, monkeypatch):
    tables.save_table(spark.range(3), database, "t")
    monkeypatch.setattr(type(spark), "table", lambda self, name: self.sql(f"SELECT * FROM {name} LIMIT 4"))
    with pytest.raises(RuntimeError, match="t: 4 of 9 rows"):
        tables.save_table(spark.range(9), database, "t")
    monkeypatch.undo()
    assert rows_of(spark, database, "t") == [0, 1, 2]


def test_a_reader_keeps_the_version_it_began_with(spark, database):
    tables.save_table(spark.range(3), database, "t")
    reader = tables.load_table(spark, database, "t")
    tables.save_table(spark.range(5), database, "t")
    assert reader.count() == 3 and rows_of(spark, database, "t") == [0, 1, 2, 3, 4]
    tables.save_table(reader.unionByName(reader), database, "t")  # a table may be made from itself
    assert rows_of(spark, database, "t") == [0, 0, 1, 1, 2, 2]
    current = versions.current_version(spark, database, "t")
    assert len(versions.versions_of(spark, database, "t")) == 2 and current in versions.versions_of(spark, database, "t")


def test_versions_change_over_together(spark, database):
    for name in ("a", "ab"):
        tables.save_table(spark.range(1), database, name)
    new = {name: versions.write_version(spark.range(4), database, name) for name in ("a", "ab")}
    assert [len(rows_of(spark, database, name)) for name in new] == [1, 1]
    versions.publish(spark, database, new)
    assert [len(rows_of(spark, database, name)) for name in new] == [4, 4]


def test_a_plain_table_becomes_a_version(spark, database):
    spark.range(2).write.saveAsTable(f"{database}.old")
    tables.save_table(spark.range(3), database, "old")
    assert rows_of(spark, database, "old") == [0, 1, 2] and len(versions.versions_of(spark, database, "old")) == 2


def test_comments_and_tags_outlive_a_version(spark, database):
    tables.save_table(spark.range(2), database, "t")
    table = f"{database}.t"
    namespace.comment_table(spark, table, "it's")
    namespace.comment_columns(spark, table, {"id": "key"})
    namespace.tag_table(spark, table, {"team": "x"})
    tables.save_table(spark.range(3), database, "t")
    assert spark.catalog.getTable(table).description == "it's"
    assert [column.description for column in spark.catalog.listColumns(table)] == ["key"]
    assert ("team", "x") in [tuple(row) for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()]
    namespace.drop_table(spark, table)
    assert not spark.catalog.tableExists(table) and versions.versions_of(spark, database, "t") == []


def test_table_format_is_the_sessions(spark, database, settings):
    settings({"spark.sql.sources.default": "orc"})
    tables.save_table(spark.range(3), database, "t")
    described = {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {database}.{versions.current_version(spark, database, 't')}").collect()}
    assert described["Provider"] == "orc"
    assert tables.load_table(spark, database, "t").count() == 3


def test_contacts_are_read_from_the_cutoff_month_on(spark, database):
    tables.save_contacts(data.contacts(spark), database)
    saved = tables.load_table(spark, database, "contacts_bronze")
    assert saved.count() == len(data.CONTACT_ROWS)
    recent = targets.recently_contacted(saved, F.lit(data.CUTOFF), tables.CONTACT_MONTH)
    assert data.ids(recent) == [2, 9]
    text = data.plan(recent, "formatted")
    assert "PartitionFilters: [isnotnull(contact_month" in text and "2026-02-01" in text


def test_thresholds_reach_the_scan(spark, database):
    tables.save_table(data.customers(spark), database, "silver")
    silver = tables.load_table(spark, database, "silver")
    text = data.plan(targets.zero_asset(targets.high_deposit(silver)).select("customer_id"), "formatted")
    pushed = text[text.index("PushedFilters") :].split("\n")[0]
    assert "GreaterThanOrEqual(deposit_balance_manyen,1000.00)" in pushed
    assert "EqualTo(managed_asset_manyen,0.00)" in pushed
    assert "ReadSchema: struct<customer_id:bigint,deposit_balance_manyen:decimal(15,2),managed_asset_manyen" in text


def test_namespace(spark, tmp_path):
    catalog = spark.catalog.currentCatalog()
    namespace.use_catalog(spark, catalog)
    namespace.create_schema(spark, "course", "for the bank's tests", str(tmp_path / "course"))
    namespace.create_schema(spark, "course", "again")
    try:
        namespace.use_schema(spark, "course")
        assert spark.catalog.currentDatabase() == "course"
        assert spark.catalog.getDatabase("course").description == "for the bank's tests"
        tables.save_table(data.customers(spark), "course", "customers")
        namespace.comment_table(spark, "course.customers", "顧客マスタ")
        namespace.comment_columns(spark, "course.customers", schemas.DISPLAY_NAMES)
        namespace.tag_table(spark, "course.customers", {"domain": "retail"})
        described = {row.name: row.description for row in spark.catalog.listColumns("course.customers")}
        assert described["deposit_balance_manyen"] == "預金残高(万円)" and described["phone_number"] is None
        assert spark.catalog.getTable("course.customers").description == "顧客マスタ"
        properties = {row.key: row.value for row in spark.sql("SHOW TBLPROPERTIES course.customers").collect()}
        assert properties["domain"] == "retail"
        namespace.drop_table(spark, "course.customers")
        namespace.drop_table(spark, "course.customers")
        assert not spark.catalog.tableExists("course.customers")
    finally:
        spark.catalog.setCurrentDatabase("default")
        namespace.reset_schema(spark, "course")
    assert not spark.catalog.databaseExists("course")
    assert namespace.landing_path("/data/", "course") == "/data/course/source_files"


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared.shared_dir(spark) == folder
    first, second = shared.fresh_path(spark, "x"), shared.fresh_path(spark, "x")
    assert first.startswith(folder + "/x-") and first != second


def test_hot_month_is_written_by_many_tasks(spark, database, settings):
    """A month with most of the contacts is split over several files instead of one task's."""
    settings(
        {
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
            "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.1",
        }
    )
    many = spark.range(0, 80_000, 1, 8).select(
        F.col("id").alias("contact_id"),
        F.xxhash64("id").alias("customer_id"),
        F.when(F.col("id") % 3 != 0, F.lit(data.TODAY))
        .otherwise(F.date_sub(F.lit(data.TODAY), (F.col("id") % 700).cast("int")))
        .alias("contact_date"),
    )
    tables.save_contacts(many, database)
    saved = tables.load_table(spark, database, "contacts_bronze")
    hot = saved.filter(F.col("contact_month") == "2026-08-01")
    assert hot.select(F.input_file_name()).distinct().count() > 3
    assert saved.count() == 80_000


def test_a_failed_write_is_reported(spark, database):
    def broken():
        raise ValueError("no such input")

    with pytest.raises(ValueError, match="no such input"):
        tables.save_all(spark, [lambda: tables.save_table(spark.range(2).toDF("a"), database, "fine"), broken])
    assert tables.load_table(spark, database, "fine").count() == 2

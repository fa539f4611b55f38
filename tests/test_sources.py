from __future__ import annotations

import datetime as dt
import tempfile

import pytest

from helpers import plan_of, rows
from landing import export
from tidemart.sources import raw, staging, tables, text_records


def write(path, text: str) -> str:
    path.write_bytes(text.encode())
    return str(path)


def test_header_goes_by_position(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,name\n1,"x"\nid,name\n 2,\\y ,\n3,é　,,\n')
    got = [row.rawdata for row in raw.raw_lines(spark, path).collect()]
    assert got == ['1,"x"', "id,name", " 2,\\y ,", "3,é　,,"]


def test_windows_line_ends_and_blank_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h\r\na,1\r\n\r\nb,2\r\n")
    assert [row.rawdata for row in raw.raw_lines(spark, path).collect()] == ["a,1", "", "b,2"]


def test_large_file_is_split_without_losing_lines(spark, tmp_path):
    odd = ["", "  ", '"', 'x,"y', "\0start", "in\0side", "a\u0001b,c", "h", "\\", "é"]
    wanted = [odd[n % 10] if n % 7 == 0 else f"{n},value {n}" for n in range(20_000)]
    path = write(tmp_path / "a.csv", "\n".join(["h", *wanted]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = raw.raw_lines(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert sorted(row.rawdata for row in df.collect()) == sorted(wanted)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_each_file_of_a_folder_has_its_header(spark, tmp_path):
    lines = spark.createDataFrame([(f" {n},b ",) for n in range(50)], "rawdata string")
    manifest = export({"customer_info": lines.repartition(5)}, str(tmp_path / "out"))
    got = raw.read_source(spark, "customer_info", manifest["customer_info"], dt.date(2026, 1, 1))
    assert rows(got.select("rawdata")) == rows(lines)
    assert {(row.path_name, row.load_date) for row in got.collect()} == {
        ("customer_info", dt.date(2026, 1, 1))
    }


def test_load_date_defaults_to_today(spark, tmp_path):
    path = write(tmp_path / "a.csv", "h\na\n")
    row = raw.read_source(spark, "customer_info", path).selectExpr(
        "load_date = current_date() AS today"
    )
    assert row.first().today


def test_manifest_names_are_checked(spark):
    with pytest.raises(ValueError, match="unknown sources"):
        raw.read_manifest(spark, {"prices": "/nowhere"})


def test_source_summary(spark):
    lines = spark.createDataFrame([("b",), ("a",)], "rawdata string")
    bronze = {name: raw.with_lineage(lines, name) for name in ("customer_info", "product_info")}
    assert rows(raw.source_summary(bronze)) == [
        ("customer_info", 2, "a"),
        ("product_info", 2, "a"),
    ]
    bronze["product_info"] = raw.with_lineage(lines.limit(0), "product_info")
    summary = raw.source_summary(bronze)
    assert rows(summary) == [("customer_info", 2, "a"), ("product_info", 0, None)]
    assert "Sort [" not in plan_of(summary)


def test_table_round_trip_and_overwrite(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([("AW1", "France")], "customer_location_key string, customer_location_state string")
    for _ in range(2):
        tables.write_table(one, root, "silver", "customer_location")
    back = tables.read_table(spark, root, "silver", "customer_location")
    assert rows(back) == [("AW1", "France")]
    assert tables.preview(back, 1, "customer_location_key").count() == 1


def test_table_of_another_shape_fails(spark, tmp_path):
    path = tables.table_path(str(tmp_path), "silver", "customer_birth")
    spark.sql("SELECT 'a' AS customer_key, 'text' AS birth_date, 'x' AS gender, 1 AS age").write.parquet(path)
    with pytest.raises(Exception):
        tables.read_table(spark, str(tmp_path), "silver", "customer_birth").collect()


def test_tolerant_decoding(spark):
    glued = ['{"a":1}{"a":2}', '{"a":1} xyz', '{"a":1},{"a":2}', '[{"a":1}]', "{'a':1}", '{"a":1}]']
    texts = [*glued, ' {"a":1,"b":"x"} ', '{"a":1,"b":"x"', "", "nonsense", None, '{"b":null}', '{"a":"word"}']
    records = spark.createDataFrame([(text,) for text in texts], "value string")
    decoded = text_records.decode_records(records, "a bigint, b string")
    assert rows(decoded) == [(1, "x"), (None, None)]
    assert tuple(text_records.decode_summary(records, "a bigint, b string").first()) == (2, 11)


class FakeSession:
    def __init__(self, **settings):
        self.settings = settings

    @property
    def conf(self):
        return self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_staging_follows_the_session(tmp_path):
    shared = str(tmp_path / "shared")
    assert staging.staging_root(FakeSession(**{"spark.checkpoint.dir": shared + "/"})) == shared
    assert staging.staging_root(FakeSession()) == tempfile.gettempdir()
    assert staging.Staging(FakeSession(), shared).path.startswith(shared + "/tidemart-")


def test_staging_leaves_the_context_alone(spark):
    before = spark.sparkContext.getCheckpointDir()
    staging.Staging(spark).settle(spark.range(3), "numbers")
    assert spark.sparkContext.getCheckpointDir() == before


def test_settled_rows_are_read_from_disk_and_dropped(spark):
    area = staging.Staging(spark)
    settled = area.settle(spark.range(10).selectExpr("id", "rand() AS r"), "numbers")
    assert rows(settled) == rows(settled)
    assert area.path in settled.inputFiles()[0]
    area.drop()
    with pytest.raises(Exception):
        spark.read.parquet(f"{area.path}/numbers").collect()

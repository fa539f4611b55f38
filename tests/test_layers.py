"""Versioned tables, routed lines, strict decoding, the fact without pairs and kept numbers."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from helpers import plan_of, rows
from landing import WIDE, export, landing_lines
from tidemart import Warehouse
from tidemart.operators.dense_index import dense_index, extend_index
from tidemart.plans import gold
from tidemart.plans.factorised import FactorisedFact, fact_links
from tidemart.plans.routing import RoutedTables
from tidemart.plans.silver import ENTITIES
from tidemart.sources import raw, text_records
from tidemart.sources.staging import Staging
from tidemart.sources.tables import read_table, table_path, write_table
from tidemart.sources.versions import VersionedTable

DAY = dt.date(2026, 1, 1)


# Header rows


def many_files(tmp_path):
    wanted = []
    for n in range(6):
        lines = [f"{n},{i}" for i in range(n * 300)] + (["head", "", "  "] if n % 2 else [])
        (tmp_path / f"f{n}.csv").write_text("\n".join(["head", *lines]) + "\n")
        wanted += lines
    (tmp_path / "empty.csv").write_text("")
    return sorted(wanted)


@pytest.mark.parametrize("lone, few", [(1000, 1000), (0, 1000), (0, 0)])
@pytest.mark.parametrize("split", ["128m", "500b"])
def test_headers_go_whatever_way_files_are_read(spark, tmp_path, monkeypatch, lone, few, split):
    monkeypatch.setattr(raw, "LONE_SPLIT_FILES", lone)
    monkeypatch.setattr(raw, "BROADCAST_FILES", few)
    wanted = many_files(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = raw.raw_lines(spark, str(tmp_path))
        assert sorted(row.rawdata for row in got.collect()) == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("lone", [1000, 0])
def test_no_line_is_shuffled(spark, tmp_path, monkeypatch, lone):
    """On a file far above the size up to which a join's side is broadcast."""
    monkeypatch.setattr(raw, "LONE_SPLIT_FILES", lone)
    with open(tmp_path / "a.csv", "w") as out:
        out.write("head\n")
        for n in range(1200):
            out.write("x" * 10_000 + f"{n}\n")
    lines = raw.raw_lines(spark, str(tmp_path / "a.csv"))
    for moment in ("planned", "run"):
        plan = plan_of(lines)
        assert "SortMergeJoin" not in plan, moment
        moved = [part for part in plan.split("\n") if "Exchange" in part and "rawdata" in part]
        assert not moved, moment
        assert lines.count() == 1200
    assert ("Join" in plan_of(lines)) == (lone == 0)


def test_lone_splits_leave_the_session_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\na\n")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    df = raw.raw_lines(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert df.sparkSession is spark and df.collect()[0].rawdata == "a"
    assert not [v for v in spark.catalog.listTables("global_temp") if v.name.startswith("lines_")]


# Text records

FIELDS = "a bigint, b string"


def test_strict_decoding_of_clean_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a":1,"b":"x"}\n{"b":null}\n {"a":3} \n')
    records = text_records.read_records(spark, str(tmp_path))
    got = text_records.decode_strict(records, FIELDS, place=("file", "block", "row"))
    assert rows(got) == [(1, "x"), (3, None), (None, None)]


@pytest.mark.parametrize("bad", ['{"a":1', '{"a":"word"}', "", '{"a":1}{"a":2}', '{"a":1},{"a":2}'])
def test_a_bad_record_stops_the_job_and_is_named(spark, tmp_path, bad):
    (tmp_path / "good.json").write_text('{"a":1}\n' * 5)
    (tmp_path / "bad.json").write_text('{"a":1}\n' * 7 + bad + "\n" + '{"a":1}\n' * 3)
    records = text_records.read_records(spark, str(tmp_path))
    strict = text_records.decode_strict(records, FIELDS, place=("file", "block", "row"))
    for action in (strict.collect, strict.count):  # also where no column is asked for
        with pytest.raises(Exception, match=r"cannot be decoded, file file:\S*bad.json, block 0, row 7: ") as stopped:
            action()
        assert bad in str(stopped.value)


def test_a_record_cannot_end_the_list_itself(spark):
    mark = text_records._MARK
    for text in ('{"a":1}],"x":[{"a":2}', '{"a":1},{"_end":true}],"x":[{}', '{"a":1},{"_end":true}'):
        assert mark not in text
        records = spark.createDataFrame([(text,)], "value string")
        assert text_records.decode_records(records, FIELDS).count() == 0


def test_records_are_parsed_once(spark):
    records = spark.range(5).selectExpr("concat('{\"a\":', id, '}') AS value")
    for df in (text_records.decode_records(records, FIELDS), text_records.route_records(records, FIELDS)):
        assert plan_of(df).count("from_json(") == 1


def test_records_are_routed_with_reasons(spark, tmp_path):
    good = [' {"a":1,"b":"x"} ', '{"b":null}']
    bad = {
        "": "empty", "  ": "empty", '{"a":1': "unreadable", "{'a':1}": "unreadable", '[{"a":1}]': "unreadable",
        '{"a":"w"}': "wrong type", '{"a":1},{"a":2}': "not one object", "null": "not one object",
    }
    records = spark.createDataFrame([(n, text) for n, text in enumerate([*good, *bad, None])], "at int, value string")
    routed = text_records.route_records(records, FIELDS, place=("at",))
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(routed, "outcome")
    back = table.read(routed.schema)
    assert rows(back.where("outcome = 'accepted'").select("a", "b", "value", "reason")) == [
        (1, "x", None, None), (None, None, None, None)
    ]
    got = {row.value: row.reason for row in back.where("outcome = 'rejected'").collect()}
    assert got == bad | {None: "empty"}


# Versions


def test_a_killed_overwrite_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path)
    schema = "customer_location_key string, customer_location_state string"
    old = spark.createDataFrame([("AW1", "France")], schema)
    write_table(old, root, "silver", "customer_location")
    pinned = read_table(spark, root, "silver", "customer_location")
    table = VersionedTable(spark, table_path(root, "silver", "customer_location"))
    fails = spark.range(100).selectExpr(
        "'AW2' AS customer_location_key",
        "IF(id = 77, CAST(raise_error('killed') AS STRING), 'Spain') AS customer_location_state",
    )
    with pytest.raises(Exception, match="killed"):
        write_table(fails, root, "silver", "customer_location")
    # All files written, but the driver gone before the mark: the same as if it was killed.
    spark.createDataFrame([("AW3", "Italy")], schema).write.parquet(table.folder("000000000002-dead"))
    for df in (pinned, read_table(spark, root, "silver", "customer_location")):
        assert rows(df) == [("AW1", "France")]
    write_table(spark.createDataFrame([("AW4", "Chile")], schema), root, "silver", "customer_location")
    assert rows(read_table(spark, root, "silver", "customer_location")) == [("AW4", "Chile")]
    assert rows(pinned) == [("AW1", "France")]  # readers keep to their version
    assert "000000000002-dead" not in table._names("data")  # what the killed write left is gone


def test_versions_are_kept_and_dropped(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    names = [table.replace(spark.range(n), keep=3) for n in range(1, 6)]
    assert table.versions() == names[2:] == table._names("data")
    assert [table.read("id bigint", name).count() for name in names[2:]] == [3, 4, 5]
    assert table.read("id bigint").count() == 5
    table.vacuum(1)
    assert table.versions() == names[4:]


def test_a_plain_folder_is_a_table_of_one_version(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read("id bigint").count() == 3
    table.replace(spark.range(7))
    assert table.read("id bigint").count() == 7


# Routed lines


def bronze_of(spark, lines, source):
    return spark.createDataFrame([(line, source, DAY) for line in lines], "rawdata string, path_name string, load_date date")


def test_lines_are_routed_with_reasons(spark, tmp_path):
    lines = ["AW-00011000,US", "AW-00011000", None, "", "AW-0001100,US", " AW-00011001 ,Mars,more", "x,"]
    entity = ENTITIES["customer_location"]
    tables = RoutedTables(spark, str(tmp_path), {entity.table: entity})
    tables.write(bronze_of(spark, lines, entity.source), entity, DAY)
    assert rows(tables.accepted(entity.table)) == [("AW00011000", "United States"), ("AW00011001", None)]
    got = {(row.reason, row.rawdata) for row in tables.rejected().collect()}
    assert got == {
        ("too few fields", "AW-00011000"), ("no line", None), ("too few fields", ""),
        ("invalid key", "AW-0001100,US"), ("invalid key", "x,"),
    }
    assert rows(tables.quality()) == [
        ("customer_location", "location_country", 2), ("customer_location", "location_key", 2)
    ]
    per_file = tables.quality(per_file=True)
    assert rows(per_file.groupBy("entity", "rule").sum("invalid_rows")) == rows(tables.quality())


def test_routing_scans_once(spark, tmp_path):
    entity = WIDE["sales_details"]
    bronze_of(spark, ["a,b"], entity.source).write.parquet(str(tmp_path / "b"))
    from tidemart.plans.routing import route

    plan = plan_of(route(spark.read.parquet(str(tmp_path / "b")), entity, DAY))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


@pytest.fixture(scope="module")
def manifest(spark, sf_dir, tmp_path_factory):
    return export(landing_lines(spark, sf_dir), str(tmp_path_factory.mktemp("landing")))


@pytest.fixture(scope="module")
def plain(spark, manifest, tmp_path_factory):
    """A run with the tables as they always were."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("plain")), DAY, DAY, entities=WIDE)
    warehouse.ingest(manifest)
    warehouse.refine()
    warehouse.model()
    return warehouse


def test_ingest_returns_what_it_saw(spark, manifest, plain):
    found = plain.read("bronze", "manifest")
    wanted = raw.source_summary({name: plain.read("bronze", name) for name in manifest})
    assert rows(found) == rows(wanted)


def test_counts_outlive_the_driver(spark, manifest, plain, tmp_path):
    """The job stops once silver is written; another session finds exact counts."""
    first = Warehouse(spark, str(tmp_path), DAY, DAY, entities=WIDE, keep_rejects=True)
    first.ingest(manifest)
    first.refine()
    del first
    later = Warehouse(spark.newSession(), str(tmp_path), DAY, DAY, entities=WIDE, keep_rejects=True)
    assert rows(later.read("silver", "quality")) == rows(plain.read("silver", "quality"))
    for table in WIDE:
        assert rows(later.read("silver", table)) == rows(plain.read("silver", table))
    kept = sum(later.read("silver", table).count() for table in WIDE)
    lines = sum(row.rows for row in later.read("bronze", "manifest").collect())
    assert later.rejects().count() + kept == lines


# The fact without pairs


def silver_of_keys(spark):
    r = random.Random(6)
    sales = [
        (f"SO{n:05}", r.choice(["BK-1", "BK-2", "N/A", "XX-9"]), r.choice([11000, 11001, 99999, None]),
         r.choice([DAY, None, dt.date(2026, 3, 4)]), None, DAY, float(r.randrange(90)), float(r.randrange(1, 5)), float(r.randrange(50)))
        for n in range(120)
    ]
    sales = spark.createDataFrame(
        sales,
        """sls_ord_num string, sls_prd_key string, sls_cust_id bigint, sls_order_date date, order_date_issue string,
        sls_due_date date, sales_sls_price double, sales_quantity double, sales_price double""",
    )
    products = spark.createDataFrame(
        [("BK-1", 1), ("BK-1", 2), ("N/A", 3), ("N/A", 4), ("N/A", 5), ("BK-3", 6)], "prod_key string, unique_number bigint"
    )
    customers = spark.createDataFrame(
        [(11000, "France", "Male", 1), (None, None, None, 2), (None, "US", "Female", 3), (11001, "Unknown", None, 4), (11002, "US", None, 5)],
        "customer_id bigint, country string, gender string, unique_number_customer bigint",
    )
    return sales, products, customers


@pytest.mark.parametrize("null_keys", ["match", "unmatched"])
def test_factorised_fact_equals_the_expanded_one(spark, null_keys):
    from tidemart.plans import reports

    sales, products, customers = silver_of_keys(spark)
    fact = gold.fact_sales(sales, products, customers, null_keys)
    links = fact_links(sales, products, customers, null_keys)
    small = FactorisedFact(links, products, customers, null_keys)
    assert links.count() == 120 < fact.count()
    assert rows(small.rows()) == rows(fact)
    assert small.size().first().rows == fact.count()
    for number in ("customer_unique_num", "product_unique_num"):
        sums = "count(*) AS fact_rows", "sum(price) AS price", "sum(sales_amount) AS sales_amount", "sum(sales_quantity) AS sales_quantity"
        wanted = fact.groupBy(number).agg(*[__import__("pyspark").sql.functions.expr(s) for s in sums])
        got = small.by_customer() if number.startswith("customer") else small.by_product()
        assert rows(got) == rows(wanted)
    for measure in ("price", "sales_amount"):
        assert rows(small.revenue_by_country(measure)) == rows(reports.revenue_by_country(fact, customers, measure))
        assert rows(small.monthly_trend(measure)) == rows(reports.monthly_trend(fact, measure))
        for top in (None, 2):
            assert rows(small.customer_ranking(top, measure)) == rows(reports.customer_ranking(fact, customers, top, measure))


def test_a_warehouse_where_missing_keys_meet(spark, manifest, plain, tmp_path):
    meeting = Warehouse(spark, str(tmp_path), DAY, DAY, null_keys="match", entities=WIDE)
    meeting.ingest(manifest)
    meeting.refine()
    meeting.model()
    fact = gold.fact_sales(
        plain.read("silver", "sales_details"), plain.read("gold", "gold_dim_product"),
        plain.read("gold", "gold_dim_customer"), "match",
    )
    assert rows(meeting.read("gold", "gold_fact_sales")) == rows(fact)
    from tidemart.plans import reports

    customers = plain.read("gold", "gold_dim_customer")
    found = meeting.reports()
    assert rows(found["revenue_by_country"]) == rows(reports.revenue_by_country(fact, customers))
    assert rows(found["monthly_trend"]) == rows(reports.monthly_trend(fact))
    assert rows(found["top_customers"]) == rows(reports.customer_ranking(fact, customers, 5))


# Numbers of the load before


def extended(before, after):
    """Numbers by hand: the same key keeps its numbers in order; new rows follow."""
    held = {}
    for key, number in before:
        held.setdefault(key, []).append(number)
    for numbers in held.values():
        numbers.sort()
    known, new = [], []
    for row in sorted(after, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        (known.append((*row, held[row[0]].pop(0))) if held.get(row[0]) else new.append(row))
    highest = max((number for _, number in before), default=0)
    return sorted([*known, *[(*row, highest + 1 + n) for n, row in enumerate(new)]], key=repr)


@pytest.mark.parametrize("hot", [0, 300])
def test_known_rows_keep_their_numbers(spark, hot):
    r = random.Random(hot)
    first = [(r.choice([None, *range(30)]), r.randrange(9)) for _ in range(60)] + [(7, n) for n in range(hot)]
    area = Staging(spark)
    table = spark.createDataFrame(first, "k bigint, v bigint")
    last = area.settle(dense_index(table, ["k"], "number", area), "last")
    before = [(row.k, row.number) for row in last.collect()]
    second = [(k, v + 1) for k, v in first if r.random() < 0.8] + [(r.choice([None, *range(60)]), 0) for _ in range(40)]
    got = extend_index(spark.createDataFrame(second, "k bigint, v bigint"), last, ["k"], ["v"], "number", Staging(spark))
    assert sorted(map(tuple, got.collect()), key=repr) == extended(before, second)


def test_a_rerun_changes_no_number(spark, manifest, plain, tmp_path):
    keeping = Warehouse(spark, str(tmp_path), DAY, DAY, entities=WIDE, keep_numbers=True)
    keeping.ingest(manifest)
    keeping.refine()
    keeping.model()
    first = rows(keeping.read("gold", "gold_dim_customer"))
    assert first == rows(plain.read("gold", "gold_dim_customer"))
    customers = keeping.read("silver", "customer_info")
    added = customers.limit(3).selectExpr(
        "customer_id_cleaned", "replace(customer_key_cleaned, 'AW', 'AA') AS customer_key_cleaned",
        *customers.columns[2:],
    )
    write_table(customers.unionByName(added), str(tmp_path), "silver", "customer_info")
    keeping.model()
    second = rows(keeping.read("gold", "gold_dim_customer"))
    new = set(second) - set(first)
    assert set(first) <= set(second) and {row[-1] for row in new} == {len(first) + n for n in (1, 2, 3)}
    assert all(row[0] < "AB" for row in new)  # they would have come first


# Bucketed tables


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def fact_with_hot_customer(spark):
    values = ", ".join(
        ["'SO' AS order_number", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id % 300 END AS customer_unique_num",
         "1L AS product_unique_num", "DATE '2026-01-01' AS order_date", "DATE '2026-01-02' AS order_shipping_date",
         "1D AS sales_amount", "2D AS sales_quantity", "CAST(id % 50 AS DOUBLE) AS price"]
    )
    return spark.sql(f"SELECT {values} FROM range(3000)")


def test_bucketed_tables_are_summed_and_joined_in_place(spark, plain, tmp_path, no_broadcast):
    from tidemart.plans import reports
    from tidemart.plans.bucketed import BucketedLayers

    customers = plain.read("gold", "gold_dim_customer")
    fact = fact_with_hot_customer(spark)
    layers = BucketedLayers(spark, str(tmp_path), 6)
    layers.store("gold", "gold_fact_sales", fact)
    layers.store("gold", "gold_dim_customer", customers)
    even, heavy = layers._parts("gold", "gold_fact_sales")
    assert {row[0] for row in heavy.select("customer_unique_num").distinct().collect()} == {7, None}
    assert rows(even.unionByName(heavy)) == rows(fact) == rows(layers.read("gold", "gold_fact_sales"))
    assert "Exchange" not in plan_of(reports.per_customer(even, "price"))
    dimension = layers._parts("gold", "gold_dim_customer")[0]
    joined = reports.totals_with_customer(reports.per_customer(even, "price"), dimension)
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    for top in (None, 5):
        assert rows(layers.customer_ranking(top)) == rows(reports.customer_ranking(fact, customers, top))
    assert rows(layers.per_customer()) == rows(reports.per_customer(fact, "price"))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]


def test_bucketed_customers_are_joined_in_place(spark, plain, tmp_path, no_broadcast):
    from tidemart.plans.bucketed import _SILVER, BucketedLayers

    tables = {name: plain.read("silver", name) for name in _SILVER}
    # One key with a large part of the births, and one of the locations.
    keys = [row[0] for row in tables["customer_info"].select("customer_key_cleaned").limit(2).collect()]
    births = spark.range(400).selectExpr(f"'{keys[0]}' AS customer_key", "DATE '1980-01-01' AS birth_date", "'Male' AS gender", "CAST(id AS INT) AS age")
    places = spark.range(300).selectExpr(f"'{keys[1]}' AS customer_location_key", "IF(id = 0, NULL, 'France') AS customer_location_state")
    tables["customer_birth"] = tables["customer_birth"].unionByName(births)
    tables["customer_location"] = tables["customer_location"].unionByName(places)
    layers = BucketedLayers(spark, str(tmp_path), 6)
    for name, table in tables.items():
        layers.store("silver", name, table)
    even = [layers._parts("silver", name)[0] for name in _SILVER]
    plan = plan_of(gold.bucket_rows(*even))
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    assert rows(layers.customer_rows()) == rows(gold.customer_rows(*tables.values()))

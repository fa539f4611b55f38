"""Raw export lines derived from order tables, with realistic defects.

Feeds tests and benchmarks: every source of the warehouse is derived from the customer,
part, orders and lineitem tables, so its size grows with theirs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.side_by_side import side_by_side
from tidemart.plans.silver import entities
from tidemart.sources.schemas import RAW_SOURCES

# Keys are written in widths that hold at any size, and are never cut.
_ORDER_DIGITS, _CUSTOMER_DIGITS = 16, 12
WIDE = entities(
    order_number_length=2 + _ORDER_DIGITS,
    customer_id_length=_CUSTOMER_DIGITS,
    customer_key_digits=_CUSTOMER_DIGITS,
)


def _pick(number: str, divisor: int, texts: dict[int, str], default: str) -> str:
    """Text chosen by the remainder of a number."""
    cases = " ".join(f"WHEN {remainder} THEN {text}" for remainder, text in texts.items())
    return f"CASE {number} % {divisor} {cases} ELSE {default} END"


def _line(*fields: str) -> str:
    return f"concat_ws(',', {', '.join(fields)})"


def _day(start: str, days: str) -> str:
    return f"date_add(DATE '{start}', CAST({days} AS INT))"


def _compact(day: str) -> str:
    return f"replace(CAST({day} AS STRING), '-', '')"


def _padded(number: str, digits: int, kind: str = "d") -> str:
    """The number with leading zeros; longer where it has more digits."""
    whole = f"CAST({number} AS BIGINT)"
    text = f"hex({whole})" if kind == "X" else f"CAST({whole} AS STRING)"
    return f"lpad({text}, greatest({digits}, length({text})), '0')"


def _with_customer_numbers(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey AS k",
        "c_nationkey AS nation",
        f"{_padded('c_custkey + 10000', _CUSTOMER_DIGITS)} AS id",
    )


def _part_key(part: str) -> str:
    """Every tenth key is shared by two parts."""
    return f"concat('PK-', {_padded(f'IF({part} % 10 = 1, {part} - 1, {part})', 5)})"


def customer_info(customer: DataFrame) -> DataFrame:
    line = _line(
        "IF(k % 701 = 7, concat('X', k), CAST(k + 10000 AS STRING))",
        "CASE WHEN k % 97 = 5 THEN concat('BAD', k) WHEN k % 4 = 1 THEN concat('aw', id)"
        " ELSE concat('AW', id) END",
        "IF(k % 31 = 0, '', concat(' First', k % 100, ' '))",
        "IF(k % 31 = 0 OR k % 29 = 0, '', concat('Last', k % 77))",
        _pick("k", 5, {0: "'M'", 1: "'f'", 2: "'F '", 3: "''"}, "'x'"),
        _pick("k", 3, {0: "'M'", 1: "'s'"}, "''"),
        _pick(
            "k",
            41,
            {0: "'2025-02-30'", 1: "'2025-1-5'", 2: "''"},
            f"CAST({_day('2020-01-01', 'k % 1500')} AS STRING)",
        ),
    )
    return _with_customer_numbers(customer).selectExpr(
        f"IF(k % 211 = 3, 'x,y,z', {line}) AS rawdata"
    )


def customer_birth_date(customer: DataFrame) -> DataFrame:
    line = _line(
        "CASE WHEN k % 43 = 2 THEN concat('AW', id) WHEN k % 47 = 1 THEN ''"
        " ELSE concat('NASAW', id) END",
        _pick(
            "k",
            37,
            {0: "''", 1: "'1980-13-01'", 2: "'80-01-01'"},
            f"CAST({_day('1950-01-01', 'k * 37 % 20000')} AS STRING)",
        ),
        _pick("k", 4, {0: "'Male'", 1: "'female'", 2: "''"}, "'n/a'"),
    )
    return (
        _with_customer_numbers(customer)
        .where("k % 6 <> 5")
        .selectExpr(f"IF(k % 199 = 1, concat('NASAW', id), {line}) AS rawdata")
    )


def customer_location(customer: DataFrame) -> DataFrame:
    countries = {
        0: "'US'",
        1: "'USA'",
        2: "'United States'",
        3: "'United Kingdom'",
        4: "'Australia'",
        5: "'Canada'",
        6: "'France'",
        7: "'Germany'",
        8: "'DE'",
        9: "''",
    }
    line = _line(
        _pick("k", 59, {3: "concat('AW', id)", 4: "''"}, "concat('AW-', id)"),
        _pick("nation", 11, countries, "'Atlantis'"),
    )
    return (
        _with_customer_numbers(customer).where("k % 8 <> 7").selectExpr(f"{line} AS rawdata")
    )


def category_products(part: DataFrame) -> DataFrame:
    line = _line(
        f"IF(n = 3, 'BR-03', concat('BR_', {_padded('n', 2)}))",
        "IF(n = 5, '', concat('Category ', n % 4))",
        "IF(n = 6, '', concat('Sub ', n))",
        _pick("n", 3, {0: "'Yes'", 1: "'No'"}, "'maybe'"),
    )
    brands = part.selectExpr("CAST(substr(p_brand, 7) AS INT) AS n").where("n < 24").distinct()
    return brands.selectExpr(f"{line} AS rawdata")


def product_info(part: DataFrame) -> DataFrame:
    parts = part.selectExpr(
        "p_partkey AS p",
        "p_name AS name",
        "CAST(floor(p_retailprice) AS BIGINT) AS cost",
        f"concat('BR-', {_padded('substr(p_brand, 7)', 2)}, '-', {_part_key('p_partkey')})"
        " AS composite",
    )
    fields = _line(
        "IF(p % 101 = 0, '1234', CAST(100 + p % 900 AS STRING))",
        "IF(p % 103 = 0, '', composite)",
        "IF(p % 61 = 0, '', name)",
        _pick("p", 67, {0: "''", 1: "'-3'", 2: "'abc'"}, "CAST(cost AS STRING)"),
        _pick("p", 7, {0: "'M '", 1: "'r'", 2: "'S'", 3: "'T'", 4: "''", 5: "'Z'"}, "'R '"),
        _pick(
            "p",
            71,
            {0: "''", 1: "'2012-02-30'"},
            f"CAST({_day('2011-01-01', 'p % 900')} AS STRING)",
        ),
    )
    end = "IF(p % 83 = 0, '', ',')"
    return parts.selectExpr(f"IF(p % 89 = 0, 'a,b,c,d,e', concat({fields}, {end})) AS rawdata")


def sales_details(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    # Spread by order key at any size: the text work on each line outweighs the shuffle.
    joined = lineitem.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
    lines = joined.selectExpr(
        "l_orderkey AS lo",
        "l_partkey AS lp",
        "o_custkey AS buyer",
        "CAST(o_orderdate AS DATE) AS ordered",
        "CAST(l_shipdate AS DATE) AS shipped",
        "CAST(l_quantity AS BIGINT) AS q",
        "CAST(floor(l_extendedprice / l_quantity) AS BIGINT) AS pr",
        f"{_padded('l_orderkey', _ORDER_DIGITS, 'X')} AS number",
        f"{_part_key('l_partkey')} AS part_key",
    )
    line = _line(
        _pick(
            "lo",
            331,
            {1: "concat('SX', number)", 2: "concat('so', number)", 3: "'SO-12-4'"},
            "concat('SO', number)",
        ),
        "IF(lp % 173 = 9, 'PK9', part_key)",
        _pick(
            "lo",
            499,
            {3: "'123'", 4: "'ABCDEFGHIJKL'"},
            _padded("buyer + 10000", _CUSTOMER_DIGITS),
        ),
        _pick("lo", 211, {1: "''", 2: "'2010'", 3: "'20130231'"}, _compact("ordered")),
        _compact("shipped"),
        _pick(
            "lo", 223, {1: "''", 2: "'0'", 3: "'20131399'"}, _compact("date_add(shipped, 7)")
        ),
        "CASE WHEN lp % 131 IN (1, 2, 3) THEN CAST(pr * q AS STRING) WHEN lp % 137 = 1 THEN ''"
        " WHEN lp % 137 = 2 THEN '-5' WHEN lp % 137 = 3 THEN CAST(pr * q + 1 AS STRING)"
        " ELSE CAST(pr * q AS STRING) END",
        _pick("lp", 127, {1: "''", 2: "'0'", 3: "'-2'", 4: "'abc'"}, "CAST(q AS STRING)"),
        _pick("lp", 131, {1: "''", 2: "concat('-', pr)", 3: "'0'"}, "CAST(pr AS STRING)"),
    )
    return lines.selectExpr(f"{line} AS rawdata")


# The tables each source is derived from.
_DERIVED = {
    "customer_info": (customer_info, ("customer",)),
    "product_info": (product_info, ("part",)),
    "sales_details": (sales_details, ("lineitem", "orders")),
    "customer_birth_date": (customer_birth_date, ("customer",)),
    "customer_location": (customer_location, ("customer",)),
    "category_products": (category_products, ("part",)),
}


def landing_lines(
    spark: SparkSession, sf_dir: str, sources: Iterable[str] = RAW_SOURCES
) -> dict[str, DataFrame]:
    """Raw lines of the named sources, each with one ``rawdata`` column."""
    chosen = list(sources)
    tables = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in sorted({table for source in chosen for table in _DERIVED[source][1]})
    }
    lines = {}
    for source in chosen:
        derive, needed = _DERIVED[source]
        lines[source] = derive(*[tables[name] for name in needed])
    return lines


def with_odd_lines(sales: DataFrame) -> DataFrame:
    """Some sales lines once more, in ways that are hard to read: blank, of blanks only, with
    quotes, after a NUL and around a U+0001."""
    numbered = sales.withColumn("n", F.length("rawdata") % 11)
    odd = F.expr(
        """CASE n WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN concat('"', rawdata, '""')
        WHEN 3 THEN concat(chr(0), rawdata) ELSE concat(rawdata, chr(1), ',x') END"""
    )
    extra = numbered.where("n < 5").select(odd.alias("rawdata"))
    return sales.unionByName(extra)


def export(lines: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write raw lines as header-topped text files; returns their manifest."""
    manifest = {name: f"{folder}/{name}" for name in lines}

    def write(name: str) -> None:
        # One column of text is a line; the header goes before the first line of each file.
        first = F.monotonically_increasing_id() % (1 << 33) == 0
        text = F.when(first, F.concat(F.lit("rawdata\n"), "rawdata")).otherwise(F.col("rawdata"))
        lines[name].select(text.alias("value")).write.text(manifest[name])

    side_by_side(next(iter(lines.values())).sparkSession, write, lines)
    return manifest

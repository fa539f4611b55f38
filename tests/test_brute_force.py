"""A whole run over random, dirty exports against plain Python on the same lines."""

from __future__ import annotations

import collections
import datetime as dt
import random
import re

import pytest

from helpers import rows
from tidemart import Warehouse, run

AS_OF = dt.date(2024, 2, 28)
SPACES = ["", "", "", " ", "  ", "\t", "\xa0", "　"]


def mess(rng: random.Random, *choices: str) -> str:
    return rng.choice(SPACES) + rng.choice(choices) + rng.choice(SPACES)


def lines_of(rng, count, least, *columns):
    """Random lines; some are cut short, some carry fields too many."""
    out = []
    for _ in range(count):
        parts = [mess(rng, *choices) for choices in columns]
        kind = rng.randrange(12)
        if kind == 0:
            parts = parts[: least - 1]
        elif kind == 1:
            parts.append("more")
        out.append(",".join(parts))
    return out + rng.sample(out, 3)


def exports(seed):
    rng = random.Random(seed)
    eight = [f"{n:08}" for n in range(1, 7)]
    iso = ["2011-02-28", "2000-02-29", "2011-02-29", "2011-2-1", "11-02-28", "", "0000-01-01", "2011-02-2８"]
    compact = ["20110228", "20120229", "20110229", "2011", "", "00000101", "201102281", "2011-2-1"]
    number = ["8", "16.5", "0", "-4", "", "abc", "nan", "1e1", "1d", "1_0", "+2", ".5", "inf"]
    return {
        "customer_info": lines_of(
            rng, 40, 7,
            ["10001", "10002", "10003", "X1", "", "-5", "²"],
            ["AW" + n for n in eight] + ["aw" + n for n in eight] + ["BAD", "", "AW0000001²"],
            ["Ann", "", "Zoë"], ["Lee", ""], ["M", "f", "x", ""], ["m", "S", "?", ""], iso,
        ),
        "customer_birth_date": lines_of(
            rng, 12, 3,
            ["NASAW" + n for n in eight] + ["nasaw00000001", "AW00000001", ""],
            iso, ["Male", "FEMALE", "n/a", ""],
        ),
        "customer_location": lines_of(
            rng, 12, 2,
            ["AW-" + n for n in eight] + ["aw-00000002", "AW00000001", ""],
            ["US", "USA", "DE", "France", "us", "Spain", ""],
        ),
        "category_products": lines_of(
            rng, 6, 4,
            ["AC_BR", "CO_RF", "AC-BR", "AB_CDE", ""], ["Bikes", ""], ["Racks", ""], ["Yes", "No", "yes", ""],
        ),
        "product_info": lines_of(
            rng, 25, 6,
            ["210", "211", "1234", "", "N/A"],
            ["AC-BR-PK-1", "CO-RF-PK-2", "CO-RF-PK-3", "XX-YY-PK-1", "AC-BR", "", "A"],
            ["Pedal - Red", '"quoted"', ""], number, ["M", "r", "S ", "t", "Z", ""], iso,
        ),
        "sales_details": lines_of(
            rng, 150, 9,
            ["SO12345", "SOabcde", "so12345", "SO-1234", "SO1234", ""],
            ["PK-1", "PK-2", "PK-3", "PK-9", "PK", "PK9x", ""],
            ["10001", "10002", "10009", "123", "ABCDE", ""],
            compact, ["x"], compact, number, ["1", "2", "4", "0", "-2", "abc", ""], number,
        ),
    }


def parsed(lines, least):
    for line in lines:
        parts = [part.strip() for part in line.split(",")]
        if len(parts) >= least:
            yield parts


def when(pattern, text):
    return text if re.fullmatch(pattern, text, re.ASCII) else None


def date_of(text):
    try:
        return dt.date.fromisoformat(text) if when(r"\d{4}-\d{2}-\d{2}", text) else None
    except ValueError:
        return None


def compact_of(text):
    return date_of(f"{text[:4]}-{text[4:6]}-{text[6:]}") if when(r"\d{8}", text) else None


def float_of(text):
    return float(text) if when(r"[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?", text) else None


def age_of(birth):
    return birth and AS_OF.year - birth.year - ((AS_OF.month, AS_OF.day) < (birth.month, birth.day))


def expected(lines):
    """Silver tables, fact rows without numbers, and dimension rows."""
    customers = [
        (
            int(p[0]) if when(r"\d+", p[0]) else None,
            p[1].upper(),
            " ".join(name for name in p[2:4] if name) or None,
            {"M": "Married", "S": "Single"}.get(p[5].upper()),
            {"M": "Male", "F": "Female"}.get(p[4].upper()),
            date_of(p[6]),
        )
        for p in parsed(lines["customer_info"], 7)
        if when(r"AW\d{8}", p[1].upper())
    ]
    births = [
        (
            p[0].upper()[3:],
            date_of(p[1]),
            {"male": "Male", "female": "Female"}.get(p[2].lower()),
            age_of(date_of(p[1])),
        )
        for p in parsed(lines["customer_birth_date"], 3)
        if when(r"NASAW\d{8}", p[0].upper())
    ]
    names = {"US": "United States", "USA": "United States", "DE": "Germany", "France": "France"}
    locations = [
        (p[0].upper().replace("-", ""), names.get(p[1]))
        for p in parsed(lines["customer_location"], 2)
        if when(r"AW-\d{8}", p[0].upper())
    ]
    categories = [
        (p[0], p[1] or None, p[2] or None, p[3] if p[3] in ("Yes", "No") else None)
        for p in parsed(lines["category_products"], 4)
        if when(r"..[_]..", p[0])
    ]
    codes = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
    products = [
        (
            p[0],
            p[1][:5].replace("-", "_") if p[1] else "N/A",
            p[1][6:] if p[1] else "N/A",
            p[2] or "N/A",
            max(float_of(p[3]) or 0.0, 0.0),
            codes.get(p[4].upper(), "N/A"),
            date_of(p[5]),
        )
        for p in parsed(lines["product_info"], 6)
        if len(p[0]) == 3 and p[0] != "N/A"
    ]
    sales = []
    for p in parsed(lines["sales_details"], 9):
        if not when(r"SO[0-9A-Za-z]{5}", p[0]):
            continue
        amount, quantity, price = (float_of(text) for text in p[6:9])
        quantity = quantity if quantity is not None and quantity > 0 else 1.0
        amount = amount if amount is not None and amount >= 0 else 0.0
        price = price if price is not None and price > 0 else amount / quantity
        if round(amount, 2) != round(quantity * price, 2):
            amount = quantity * price
        ordered = compact_of(p[3])
        issue = (
            "missing" if not p[3] else "bad_length" if len(p[3]) != 8
            else "bad_date" if ordered is None else None
        )
        buyer = int(p[2]) if when(r"\d{5}", p[2]) else None
        product = p[1] if p[1][2:3] == "-" else "N/A"
        sales.append((p[0], product, buyer, ordered, issue, compact_of(p[5]), amount, quantity, price))

    dim_customer = []
    for c in customers:
        for b in [b for b in births if b[0] == c[1]] or [(None,) * 4]:
            for place in [place for place in locations if place[0] == c[1]] or [None]:
                country = None if place is None else place[1] or "Unknown"
                dim_customer.append((c[1], c[0], c[2], c[3], c[4] or b[2], c[5], b[1], b[3], country))
    dim_product = []
    for p in products:
        for c in [c for c in categories if c[0] == p[1]] or [(None, "N/A", "N/A", "N/A")]:
            dim_product.append((p[0], p[2], p[3], p[1], *c[1:], *p[4:]))
    silver = {
        "customer_info": customers,
        "customer_birth": births,
        "customer_location": locations,
        "category_products": categories,
        "product_info": products,
        "sales_details": sales,
    }
    return silver, dim_customer, dim_product


def number(dimension, *lead):
    columns = [*lead, *[i for i in range(len(dimension[0])) if i not in lead]]
    order = lambda row: [(row[i] is not None, row[i] if row[i] is not None else 0) for i in columns]
    return [(*row, n) for n, row in enumerate(sorted(dimension, key=order), 1)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("null_keys", ["match", "unmatched"])
def test_whole_run(spark, tmp_path, seed, null_keys):
    lines = exports(seed)
    manifest = {}
    for name, content in lines.items():
        path = tmp_path / f"{name}.csv"
        path.write_bytes(("header\n" + "\n".join(content) + "\n").encode())
        manifest[name] = str(path)
    root = str(tmp_path / "root")
    results = run(spark, manifest, root, as_of=AS_OF, null_keys=null_keys)
    warehouse = Warehouse(spark, root)

    silver, dim_customer, dim_product = expected(lines)
    for table, wanted in silver.items():
        assert rows(warehouse.read("silver", table)) == sorted(wanted, key=repr), table

    dim_customer, dim_product = number(dim_customer, 0), number(dim_product, 1, 9, 0)
    assert rows(warehouse.read("gold", "gold_dim_customer")) == sorted(dim_customer, key=repr)
    assert rows(warehouse.read("gold", "gold_dim_product")) == sorted(dim_product, key=repr)

    fact = []
    for s in silver["sales_details"]:
        real = s[1] != "N/A" or null_keys == "match"
        for p in [p[-1] for p in dim_product if real and p[1] == s[1]] or [None]:
            meets = s[2] is not None or null_keys == "match"
            for c in [c[-1] for c in dim_customer if meets and c[1] == s[2]] or [None]:
                fact.append((s[0], c, p, s[3], s[5], *s[6:]))
    assert rows(warehouse.read("gold", "gold_fact_sales")) == sorted(fact, key=repr)

    profile = {c[-1]: (c[8], c[4]) for c in dim_customer}
    countries, months, totals = collections.Counter(), {}, {}
    for _, c, _, ordered, _, _, _, price in fact:
        countries[profile.get(c, ("N/A",))[0]] += price
        sums = totals.setdefault(c, [0.0, 0])
        sums[0] += price
        sums[1] += 1
        if ordered:
            sums = months.setdefault(ordered.month, [0.0, 0])
            sums[0] += price
            sums[1] += 1
    assert dict(map(tuple, results["revenue_by_country"].collect())) == pytest.approx(dict(countries))
    got = [tuple(row) for row in results["monthly_trend"].collect()]
    assert [row[3] for row in got] == sorted(months)
    for _, total, orders, month in got:
        assert (total, orders) == (pytest.approx(months[month][0], abs=0.006), months[month][1])
    ranked = sorted(totals, key=lambda c: (-round(totals[c][0], 2), c is None, c))[:5]
    got = [tuple(row) for row in results["top_customers"].collect()]
    assert [row[0] for row in got] == ["N/A" if c is None else str(c) for c in ranked]
    for c, row in zip(ranked, got):
        assert row[1:3] == profile.get(c, ("N/A", "N/A"))
        assert row[3:] == (pytest.approx(totals[c][0], abs=0.006), totals[c][1], pytest.approx(totals[c][0] / totals[c][1], abs=0.006))

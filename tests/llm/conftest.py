from __future__ import annotations

import pytest

from tidemart.llm.shipping import ship
from tidemart.sources.staging import Staging

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, label int,"
    " n bigint, kept boolean, score double, digest string, loc_file string, component_id string,"
    " key string, bands string, odds string, host string, domain string, whole string"
)
LONG = "long words go on and on " * 6000


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture
def staging(llm):
    area = Staging(llm)
    yield area
    area.drop()


def _documents(spark, rows):
    filler = ["clash"] * 9
    full = [
        (*row, len(row[1] or ""), 1, 7, True, 0.5, *filler) for row in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def documents(llm):
    """Makes documents of (doc_id, text, lang, source), with columns of clashing names."""
    return lambda rows: _documents(llm, rows)


@pytest.fixture
def odd_rows():
    """Nulls in every column, empty, blank, very long and repeated rows."""
    return [
        (1, None, "en", "src1"),
        (2, "", "en", None),
        (3, " \n\t ", None, "src0"),
        (4, LONG, "en", "src0"),
        (5, "One two three four. Five six seven eight nine ten.", "en", "src0"),
        (5, "One two three four. Five six seven eight nine ten.", "en", "src0"),
        (None, "A row without a number, but with words.", "de", "src2"),
        (None, None, None, None),
        (9, "日本語のテキスト 😀 x\u0000y \u0085 z", "ja", "http://host.example/a/b?c"),
    ]

from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemart.llm import exact, minhash
from tidemart.llm.components import components
from tidemart.sources.staging import Staging

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def classes(rows, k, percent):
    """Brute force: every pair is compared."""
    sets = [shingles(row[1], k) for row in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, row in enumerate(rows):
        ids[find(i)].append(row[0])
    least = lambda values: min((v for v in values if v is not None), default=None)
    return collections.Counter(
        (row[0], len(sets[i]), least(ids[find(i)])) for i, row in enumerate(rows)
    )


def copies(seed, bases=6, each=14):
    """Groups of texts with a few words changed, so that links chain and miss."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefg", k=r.randint(1, 6)))
    rows = []
    for _ in range(bases):
        base = [word() for _ in range(r.choice([2, 8, 40, 120]))]
        for _ in range(each):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 5])):
                text[r.randrange(len(text))] = word()
            rows.append((len(rows), r.choice([" ", "\n"]).join(text).title(), "en", "src0"))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("k, percent, rows, bands", [(3, 85, 5, 24), (5, 80, 4, 30)])
def test_near_duplicates_equal_brute_force(documents, odd_rows, staging, k, percent, rows, bands):
    data = copies(k) + [(row[0] and row[0] + 1000, *row[1:]) for row in odd_rows]
    finder = minhash.NearDuplicates(k, percent, rows, bands)
    found = finder.find(documents(data), staging).collect()
    got = collections.Counter((row.doc_id, row.n_shingles, row.component_id) for row in found)
    assert got == classes(data, k, percent)
    stays = collections.Counter(row.component_id for row in found if row.stays and row.n_shingles)
    assert set(stays.values()) == {1}
    assert all(row.stays for row in found if not row.n_shingles)


def test_near_duplicates_of_nothing(documents, llm, staging):
    assert minhash.NearDuplicates().find(documents([]), staging).count() == 0
    rows, other = [(1, None, None, None), (2, "", None, None)], Staging(llm, staging.path)
    assert minhash.one_of_each(documents(rows), other, minhash.NearDuplicates()).count() == 2


def test_one_of_each_keeps_columns(documents, staging):
    rows = [(n, "the same text of some words here", "en", "s") for n in (4, 2, 2, 9)]
    docs = documents(rows)
    kept = minhash.one_of_each(docs, staging, minhash.NearDuplicates())
    assert kept.columns == docs.columns
    assert [row.doc_id for row in kept.collect()] == [2]


def test_components(llm, staging):
    r = random.Random(1)
    pairs = [(n, n + 1) for n in range(60)] + [(r.randrange(100, 300), r.randrange(100, 300)) for _ in range(90)]
    pairs += [(400, n) for n in range(401, 440)] + [(7, 7)]
    links = llm.createDataFrame(pairs, "a bigint, b bigint")
    parent = {n: n for pair in pairs for n in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    got = {row.node: row.component for row in components(links, staging, "c").collect()}
    assert got == {n: find(n) for n in linked}
    assert components(links.limit(0), staging, "none").count() == 0


def exact_groups(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append(row)
    out = collections.Counter()
    for text, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))[0]
        for member in members:
            out[(member[0], keep, len(members), hashlib.sha256(text.encode()).digest())] += 1
    return out


def test_exact_duplicates_equal_brute_force(documents, odd_rows, staging):
    rows = odd_rows + [(20 + n, f"text {n % 4}" + " " * (n % 3), "en", "s") for n in range(30)]
    found = exact.ExactDuplicates().find(documents(rows), staging).collect()
    got = collections.Counter(
        (row.doc_id, row.keep.doc_id, row.group_size, bytes(row.digest)) for row in found
    )
    assert got == exact_groups(rows)
    assert sum(row.stays for row in found) == len({key[3] for key in got})


def test_texts_that_share_a_digest_stay_apart(documents, staging):
    rows = [(n, f"word{n % 5}", "en", "s") for n in range(20)]
    weak = exact.ExactDuplicates(digest=lambda text: F.unhex(F.lit("00")))
    found = weak.find(documents(rows), staging).collect()
    assert {(row.doc_id, row.keep.doc_id, row.group_size) for row in found} == {
        (n, n % 5, 4) for n in range(20)
    }


def test_stream_goes_on_from_its_state(documents, llm, staging):
    """A second run over the same folder takes the new files only, and keeps what it held."""
    finder = exact.ExactDuplicates(files=1)
    rows = [(n, f"text {n % 3}", "en", "s") for n in range(12)]
    first = finder.find(documents(rows), staging)
    assert {row.group_size for row in first.collect()} == {4}
    digests = llm.read.parquet(f"{staging.path}/digests")
    digests.limit(3).withColumn("doc_id", F.lit(-1).cast("bigint")).write.mode("append").parquet(
        f"{staging.path}/digests"
    )
    state = finder.stream(digests.schema, staging).collect()
    assert sum(row.group_size for row in state) == 15
    assert any(row.keep.doc_id == -1 for row in state)


def test_exact_duplicates_of_nothing(documents, staging):
    assert exact.one_of_each(documents([]), staging).count() == 0

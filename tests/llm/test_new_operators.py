"""Merkle manifest, decontamination and spelling variants against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_texts import ODD_TEXTS
from tidemart.llm import decontaminate, merkle, spelling
from tidemart.llm.suffixes import SuffixArray
from tidemart.sources.staging import Staging

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes, fan):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + fan])) for i in range(0, len(below), fan)])
    return levels


def path_of(levels, at, fan):
    out = []
    for nodes in levels[:-1]:
        run = at // fan * fan
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + fan])))
        at //= fan
    return out


def manifest(rows, fan, tamper):
    """(doc_id, leaf, subroot, root, proof, folded root) of (doc_id, source, lang, n_chars, text)."""
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = levels_of([leaf(row) for row in groups[name]], fan)
    top = levels_of([trees[name][-1][0] for name in names], fan)
    out = collections.Counter()
    for number, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            path = path_of(trees[name], at, fan) + path_of(top, number, fan)
            folded = leaf(tamper(row))
            for before, after in path:
                folded = sha(before + folded + after)
            proof = sha("".join(a + b for a, b in path))
            out[row[0], leaf(row), trees[name][-1][0], top[-1][0], proof, folded] += 1
    return out


@pytest.mark.parametrize("fan", [2, 16])
def test_manifest_equals_brute_force(documents, odd_rows, llm, staging, fan):
    r = random.Random(fan)
    rows = odd_rows + [(n, r.choice(["Abc x", None, f"T{n}"]), r.choice(["en", None]), f"s{min(r.randrange(60), 25)}") for n in range(20, 400)]
    rows += [(n, "Hot", "en", "hot") for n in range(1000, 1300)]  # one source with a large part
    docs = documents(rows)
    full = [(row.doc_id, row.source, row.lang, row.n_chars, row.text) for row in docs.collect()]
    marked = lambda n: n is not None and zlib.crc32(str(n).encode()) % 3 == 0
    tamper = lambda row: (*row[:4], row[4] and row[4].translate(LOWER)) if marked(row[0]) else row
    chosen = F.crc32(docs["doc_id"].cast("string")) % 3 == 0
    built = merkle.Manifest(
        docs, staging, tampered={"text": F.when(chosen, merkle.small_letters(docs["text"]))}, fan=fan
    )
    proofs = built.proofs().withColumn("folded", merkle.folded(F.coalesce("changed", "digest"), F.col("path")))
    got = collections.Counter(
        (p.ord, p.digest, p.subroot, p.root, sha("".join(s.before + s.after for s in p.path)), p.folded)
        for p in proofs.collect()
    )
    assert got == manifest(full, fan, tamper)
    assert {key[3] for key in got} == {built.root()}
    nodes = built.nodes().collect()
    assert sum(node.level == 0 for node in nodes) == len(rows)
    for node in nodes:  # a node's leaves are those of its interval
        assert node.hi - node.lo < fan**node.level and node.lo % fan**node.level == 0


@pytest.mark.parametrize("rows", [[], [(1, "alone", "en", "s")], [(1, None, None, None), (2, "x", None, "s")]])
def test_manifest_of_few_rows(documents, staging, rows):
    docs = documents(rows)
    built = merkle.Manifest(docs, staging)
    full = [(row.doc_id, row.source, row.lang, row.n_chars, row.text) for row in docs.collect()]
    got = {(p.ord, p.digest, p.subroot, p.root) for p in built.proofs().collect()}
    assert got == {key[:4] for key in manifest(full, 16, lambda row: row)}
    assert built.root() == (next(iter(got))[3] if rows else None)


def contaminated(rows, items, window):
    wins = collections.defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if words else ():
            wins[tuple(words[i : i + size])].add(item)
    out = []
    for doc_id, text, *_ in rows:
        words, hit, held = WORD.findall((text or "").translate(LOWER)), set(), set()
        for size in {len(key) for key in wins}:
            for i in range(len(words) - size + 1):
                if (found := wins.get(tuple(words[i : i + size]))) is not None:
                    held |= found - {None}
                    hit.update(range(i, i + size))
        out.append((doc_id, len(words), tuple(sorted(hit)), tuple(sorted(map(str, held)))))
    return collections.Counter(out)


@pytest.mark.parametrize("window, small", [(4, False), (4, True), (10, False)])
def test_decontamination_equals_brute_force(documents, odd_rows, llm, staging, monkeypatch, window, small):
    if small:  # many shards, many blocks, few places at a time
        monkeypatch.setattr(decontaminate, "SHARD_BYTES", 300)
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
        monkeypatch.setattr(decontaminate, "LOCATIONS", 7)
    r = random.Random(window)
    text = lambda n: r.choice([" ", "-\n", ", "]).join(r.choice("abc") for _ in range(n))
    items = [(n, text(r.choice([1, 2, 3, 5, 12, 30]))) for n in range(25)]
    items += [(90, None), (91, " . "), (92, items[5][1]), (92, "One TWO three four five"), (None, "go on and on long words go"), (93, "日本語のテキスト 😀")]
    rows = odd_rows + [(n, text(r.randrange(60)), "en", "s") for n in range(100, 130)]
    rows += [(n, f"{text(5)} Zq {items[n % 25][1].title()} zq {items[(n + 7) % 25][1]}", "en", "s") for n in range(200, 240)]
    table = llm.createDataFrame(items, "item_id bigint, text string")
    docs = documents(rows)
    bench = decontaminate.Benchmark(table, staging, window)
    found = bench.find(docs).collect()
    got = collections.Counter(
        (f.doc_id, f.n_words, tuple(i for s in f.spans for i in range(s.first, s.first + s.words)), tuple(f.items))
        for f in found
    )
    assert got == contaminated(rows, items, window)
    texts = {}
    for item, words in items:
        texts.setdefault(None if item is None else str(item), []).append(WORD.findall((words or "").translate(LOWER)))
    by_id = {row[0]: WORD.findall((row[1] or "").translate(LOWER)) for row in rows if row[0] is not None}
    for f in found:  # the longest match is one, and no longer one is there
        assert (f.longest is None) == (not f.spans)
        if f.longest and f.doc_id is not None:
            size, at, item, item_at = f.longest
            same = by_id[f.doc_id][at : at + size]
            assert any(words[item_at : item_at + size] == same for words in texts[item])
            every = [words[i : i + size + 1] for own in texts.values() for words in own for i in range(len(words) - size)]
            doc = by_id[f.doc_id]
            assert size + 1 < window or not any(doc[i : i + size + 1] in every for i in range(len(doc) - size))
    clean = bench.without(docs)
    assert clean.columns == docs.columns
    assert collections.Counter(row.text for row in clean.collect()) == collections.Counter(
        row[1] for row in rows if not next(iter(contaminated([row], items, window)))[2]
    )


def test_decontamination_of_nothing(documents, llm, staging):
    nothing = llm.createDataFrame([], "item_id bigint, text string")
    bench = decontaminate.Benchmark(nothing, staging)
    assert bench.find(documents([])).count() == 0
    assert bench.without(documents([(1, "a b c", "en", "s")])).count() == 1


def test_suffix_array_is_sorted():
    r = np.random.default_rng(3)
    for depth in (1, 3, 64):
        sizes = r.integers(1, 30, 40)
        words = r.integers(0, 3, sizes.sum())
        ends = np.repeat(np.cumsum(sizes), sizes)
        suffixes = SuffixArray(words, ends, depth)
        known = [tuple(words[i : min(ends[i], i + depth)]) for i in suffixes.slots]
        assert known == sorted(known) and sorted(suffixes.slots) == list(range(len(words)))


def variants(counts, least, factor):
    words = {w: n for w, n in counts.items() if n >= least}
    near = {w: set() for w in words}
    for a in words:
        for b in words:
            if a != b and one_edit(a, b):
                near[a].add(b)
    form = {}
    for w, own in near.items():
        if own:
            best = min(own, key=lambda x: (-words[x], x))
            if words[best] >= factor * words[w]:
                form[w] = best
    root = lambda w: root(form[w]) if w in form else w
    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def found_variants(df):
    return {row.word: (row.form, row.root, row.n, row.n_near, row.form_n) for row in df.collect()}


def test_variants_equal_brute_force(llm, staging):
    r = random.Random(2)
    counts = collections.Counter()
    for size in (5, 6, 7):
        for _ in range(150):
            counts["".join(r.choices("aabé", k=size))] += r.choice([1, 2, 3, 5, 9, 20, 100, 1000])
    long = "".join(r.choices("ab", k=63))
    for base in (long, long + "a", long + "ab", "a" * 66, "x" + "a" * 66, "a" * 67):
        for at in (0, 30, len(base) - 1):
            counts[base[:at] + base[at + 1 :]] += 3
            counts[base[:at] + "c" + base[at + 1 :]] += 7
        counts[base] += 40
    very = "".join(r.choices("abc", k=5000))
    counts.update({very: 4, very[:2500] + very[2501:]: 9, very[:100] + "z" + very[101:]: 30})
    table = llm.createDataFrame(list(counts.items()), "word string, n bigint")
    finder = spelling.SpellingVariants(staging, least_count=3)
    assert found_variants(finder.find(table)) == variants(counts, 3, 2)


def test_a_chain_of_forms_ends_at_its_last(llm, staging):
    words = ["aaaaaaa" + "b" * n for n in range(12)]
    table = llm.createDataFrame([(w, 3 * 2**n) for n, w in enumerate(words)], "word string, n bigint")
    got = found_variants(spelling.SpellingVariants(staging).find(table))
    assert got == variants({w: 3 * 2**n for n, w in enumerate(words)}, 3, 2)
    assert {row[1] for row in got.values()} == {words[-1]}


def test_groups_that_go_on_in_the_next_batch():
    import pyarrow as pa

    keys = [k for k in "aabbbbcdddd" for _ in range(2)]
    kinds = [spelling.FIRST] * len(keys)
    whole = pa.RecordBatch.from_pydict(
        {"key": keys, "kind": pa.array(kinds, pa.int8()), "standing": list(range(len(keys)))}
    )
    total = [pa.Table.from_batches(spelling._scan(iter([whole]))).to_pydict()]
    for size in (1, 2, 3, 5):
        parts = [whole.slice(i, size) for i in range(0, len(keys), size)]
        total.append(pa.Table.from_batches(spelling._scan(iter(parts))).to_pydict())
    assert all(part == total[0] for part in total) and sum(total[0]["n_near"]) == 4 * 3 + 8 * 7 * 2 + 2


def test_word_counts_equal_brute_force(documents, odd_rows, staging, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    rows = odd_rows + [(n, text, "en", "s") for n, text in enumerate(ODD_TEXTS * 3)]
    rows += [(n, "Ünique NAÏVE naïve façade ×÷ straße İstanbul ſo", None, None) for n in range(50, 80)]
    counts = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    want = {w: n for w, n in counts.items() if len(w) >= 2}
    got = spelling.word_counts(documents(rows), least_length=2, typos=7)
    assert {row.word: row.n for row in got.collect()} == want


def test_variants_of_nothing(documents, llm, staging):
    counts = spelling.word_counts(documents([(1, None, None, None), (2, "", None, None)]))
    assert spelling.SpellingVariants(Staging(llm, staging.path)).find(counts).count() == 0

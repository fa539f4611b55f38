from __future__ import annotations

import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest_texts import ODD_TEXTS
from tidemart.llm import bpe, pieces, planes

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def random_texts(seed, count=60):
    r = random.Random(seed)
    signs = "ab'stre, .\n\t  é漢😀09 \x1c\r!"
    return ["".join(r.choices(signs, k=r.randrange(60))) for _ in range(count)]


def test_cut_gives_the_text_back():
    for text in ODD_TEXTS + random_texts(1):
        assert "".join(map(pieces.literal, pieces.cut(text))) == text


def test_bpe_equals_the_library(documents, odd_rows, reference):
    texts = ODD_TEXTS + random_texts(2)
    rows = odd_rows + [(100 + n, text, "en", "s") for n, text in enumerate(texts)]
    found = bpe.encode(documents(rows), RANKS).collect()
    assert len(found) == len(rows)
    for row, (doc_id, text, *_) in zip(found, rows):
        assert row.doc_id == doc_id
        assert row.ids == reference.encode_ordinary(text or "") and row.n_tokens == len(row.ids)
        assert bytes(row.decoded) == (text or "").encode()


def test_bpe_digests_and_decode(documents, reference):
    docs = documents([(1, "Hello there, wörld", "en", "s"), (2, None, "en", "s")])
    one, none = bpe.encode_digests(docs, RANKS).collect()
    ids = reference.encode_ordinary("Hello there, wörld")
    assert one.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert one.decoded_sha256 == hashlib.sha256("Hello there, wörld".encode()).hexdigest()
    assert (none.n_tokens, none.ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    back = bpe.encode(docs, RANKS).select(bpe.decode(F.col("ids"), RANKS).alias("b")).collect()
    assert [bytes(row.b) for row in back] == ["Hello there, wörld".encode(), b""]


def test_pieces_start_over_without_changing_results():
    lengths = lambda keys: [[len(pieces.literal(key))] * (key != "\r") for key in keys]
    table = pieces.PieceIds(lambda keys: (keys, *pieces.joined(lengths(keys))), limit=3)
    for text in ("a bb ccc dddd", "eeeee a", "a bb ccc dddd"):
        keys = pieces.cut(text)
        ids, sizes = table.ids(pa.array([text, None, text]))
        assert ids.tolist() == [len(pieces.literal(key)) for key in keys] * 2
        assert sizes.tolist() == [len(keys), 0, len(keys)]


def test_library_pieces_equal_whole_texts(library):
    texts = ODD_TEXTS + random_texts(3)
    ids, sizes = planes.LibraryIds(VOCABULARY).ids(pa.array(texts))
    for text, stop, size in zip(texts, np.cumsum(sizes), sizes):
        assert ids[stop - size : stop].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(20))
def test_each_text_alone_equals_the_library(library, seed):
    """Texts that are cut by Arrow and texts that are not, with ends after letters."""
    r = random.Random(seed)
    words = ["word", "Wort.", "é,", "x.y.", "..", "a.,", "9.", "'s,", "漢。", "!.", "I'll", "b"]
    texts = ["".join(r.choice([" ", "\n", "  "] if seed % 2 else [" ", "\n"]) + r.choice(words) for _ in range(30))[1:] for _ in range(20)]
    ids, sizes = planes.LibraryIds(VOCABULARY).ids(pa.array(texts))
    for text, stop, size in zip(texts, np.cumsum(sizes), sizes):
        assert ids[stop - size : stop].tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [0, 1, 7, 8, 9, 1000])
def test_bit_planes_round_trip(size):
    ids = np.random.default_rng(size).integers(0, 1 << 17, size).astype(np.uint32)
    assert np.array_equal(planes.unshuffle_bits(planes.shuffle_bits(ids), size), ids)


def test_plane_file_round_trip():
    r = np.random.default_rng(5)
    sizes = [0, 3, planes.BLOCK + 5, 1, 3 * planes.BLOCK, 0, 17]
    docs = [r.integers(0, 50_257, size).astype(np.int32) for size in sizes]
    sink = io.BytesIO()
    writer = planes.PlaneWriter(pa.PythonFile(sink, "w"))
    writer.add([1, None, 3], np.concatenate(docs[:3]), np.array(sizes[:3]))
    writer.add([4, 5, 6, 7], np.concatenate(docs[3:]), np.array(sizes[3:]))
    writer.close()
    reader = planes.PlaneReader(pa.BufferReader(sink.getvalue()))
    got = list(reader.documents())
    assert [doc_id for doc_id, _ in got] == [1, None, 3, 4, 5, 6, 7]
    for (_, ids), wanted in zip(got, docs):
        assert np.array_equal(ids, wanted)
    whole = np.concatenate(docs)
    for start, stop in ((0, 0), (0, 5), (planes.BLOCK - 2, planes.BLOCK + 2), (0, len(whole))):
        assert np.array_equal(reader.ids(start, stop), whole[start:stop])
    with pytest.raises(ValueError, match="bit planes"):
        planes.PlaneReader(pa.BufferReader(b"x" * 100))


def test_special_strings_are_what_the_library_takes_them_for(library):
    special = "<|endoftext|>"
    texts = [f"a {special} b", f"{special}{special}", None, "a b", f" x\n{special}.", special[:-1] + " " + special]
    ids, sizes = planes.LibraryIds(VOCABULARY).ids(pa.array(texts))
    for text, stop, size in zip(texts, np.cumsum(sizes), sizes):
        assert ids[stop - size : stop].tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert 50256 in ids


def test_written_planes_equal_the_library(documents, odd_rows, staging, library):
    rows = odd_rows + [(40 - n, text, "en", "s") for n, text in enumerate(random_texts(4, 30))]
    rows += [(50 + n, text, "en", "s") for n, text in enumerate(ODD_TEXTS)]
    shards = planes.write_planes(documents(rows).repartition(5), staging, VOCABULARY)
    found = sorted(planes.read_planes(shards, staging.path).collect(), key=lambda row: row.start)
    assert len(found) == len(rows)
    ids = {}
    for doc_id, text, *_ in rows:
        ids.setdefault(doc_id, []).append(
            [*library.encode(text or "", add_special_tokens=False).ids, 0]
        )
    order = [row.doc_id for row in found]
    assert order == sorted(order, key=lambda n: (n is not None, n or 0))
    start = 0
    for row in found:
        assert row.start == start
        start += row.n_tokens
        sums = {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[row.doc_id]}
        assert (row.n_tokens, row.ids_crc32) in sums


def test_planes_of_nothing(documents, staging):
    shards = planes.write_planes(documents([]), staging, VOCABULARY)
    assert planes.read_planes(shards, staging.path).count() == 0

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from test_llm_texts import ODD_TEXTS

from clickloom.llm import byte_bpe as b
from clickloom.llm import packing

RANKS = b.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
CLASSES = b.library_classes(PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(r) for a, r in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def random_texts(n):
    draw = random.Random(9)
    pieces = ["'s", "'t", "'re", "'", "''", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "a", "é", "ß", "1", "²", "Ⅷ",
              "٣", "中", "文字", "!", "​", "\U0001f642", "́", "\x00", "<|endoftext|>", "the", " THE", "᠎", " "]
    return ["".join(draw.choice(pieces) for _ in range(draw.randrange(60))) for _ in range(n)]


def test_matches_the_library(library):
    texts = [t for t in ODD_TEXTS if t] + random_texts(1500) + ["ab" * 3000, "é" * 999, "\n" * 500 + "x", "thequickbrown" * 300]
    for text, packed in zip(texts, b.encoder(RANKS, PATTERN, CLASSES).encode(texts)):
        assert ids(packed) == library.encode_ordinary(text)


def test_every_code_point_is_what_the_library_takes_it_for():
    """Alone, with the pattern's classes one by one: letters, numbers and what is neither."""
    splitter = b.Splitter(PATTERN, CLASSES)
    every = b._every()
    read = every.translate(splitter.table)
    for name, ranges in CLASSES:
        inside = np.zeros(0x110000, bool)
        for low, high in ranges:
            inside[low : high + 1] = True
        got = np.array([m is not None for m in map(regex.compile(rf"\p{{{name}}}").match, read)])
        assert (got == inside[list(map(ord, every))]).all()
    assert len(splitter.table) > 1000 and all(not chr(c).isspace() for c in splitter.table.values())


def test_code_points_beside_letters_digits_and_syllables(library):
    """Every one that could be read otherwise, and all of the first planes in steps."""
    odd = sorted(b.Splitter(PATTERN, CLASSES).table)
    points = [*odd, *range(0x80, 0xD800, 7), *range(0xE000, 0x20000, 11)]
    texts = ["\n".join(f"{c} a{c}a 1{c}1 각{c}각 {c}{c} '{c}" for c in map(chr, points[k : k + 500])) for k in range(0, len(points), 500)]
    for text, packed in zip(texts, b.encoder(RANKS, PATTERN, CLASSES).encode(texts)):
        assert ids(packed) == library.encode_ordinary(text)


def test_wide_and_long_merges_agree():
    vocabulary = b.encoder(RANKS, PATTERN, CLASSES).vocabulary
    draw = random.Random(2)
    pieces = [bytes(draw.choice(b"aeinorst \xc3\xa9") for _ in range(n)) for n in range(2, b.WIDE + 1) for _ in range(10)]
    assert b.merge_many(vocabulary, pieces) == [b.merge_long(vocabulary, p) for p in pieces]


def test_forgetting_changes_nothing(monkeypatch):
    texts = random_texts(200)
    want = b.Encoder(RANKS, PATTERN, CLASSES).encode(texts)
    monkeypatch.setattr(b, "REMEMBERED", 0)
    monkeypatch.setattr(b, "TOGETHER", 1)
    assert b.Encoder(RANKS, PATTERN, CLASSES).encode(texts) == want


def test_round_trip_of_a_frame(documents):
    docs = documents(*enumerate(ODD_TEXTS), (4, "again"))
    rows = b.round_trip(docs, RANKS, PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in rows) == sorted(
        (i, t or "") for i, t in [*enumerate(ODD_TEXTS), (4, "again")]
    )
    assert b.round_trip(documents(), RANKS, PATTERN).collect() == []


def test_encode_then_decode_columns(documents):
    docs = documents((1, "hello wörld"), (2, None))
    encoded = docs.select("doc_id", b.encode(docs.text, RANKS, PATTERN).alias("ids"))
    decoded = encoded.select("doc_id", b.decode(encoded.ids, RANKS, PATTERN).alias("bytes")).collect()
    assert {r.doc_id: bytes(r.bytes).decode() for r in decoded} == {1: "hello wörld", 2: ""}


# Packing


def brute_best_fit(lengths, most):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
        rooms.append((min(fitting) if fitting else most) - n)
    return sorted(rooms)


def test_best_fit_decreasing():
    draw = random.Random(5)
    for _ in range(200):
        lengths = [draw.randrange(1, 65) for _ in range(draw.randrange(60))]
        rows = packing.best_fit(lengths, 64)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(64 - sum(lengths[i] for i in r) for r in rows) == brute_best_fit(lengths, 64)


def packed_frame(spark, docs, **options):
    rows = [(i, None if x is None else np.array(x, "<u4").tobytes(), "x") for i, x in docs]
    return packing.pack(spark.createDataFrame(rows, "doc_id bigint, ids binary, positions string"), **options)


@pytest.mark.parametrize("window", [1, 50, 1 << 20])
def test_packing_loses_nothing(spark, tmp_path, window):
    draw = random.Random(6)
    docs = [(k, [draw.randrange(50_000) for _ in range(n)]) for k, n in enumerate([0, 1, 31, 32, 33, 64, 100, 5, 5, 7, 20])]
    docs += [(3, [9] * 40), (50, None)]
    path = str(tmp_path / "packed")
    packing.write_packed(packed_frame(spark, docs, length=32, window=window), path)
    rows = spark.read.parquet(path).collect()
    matrix, positions = packing.read_matrix(rows), packing.read_matrix(rows, "positions", 4)
    assert matrix.shape == (len(rows), 32)
    got = []
    for row, line, places in zip(rows, matrix, positions):
        cuts = list(zip(row.cu_seqlens, row.cu_seqlens[1:]))
        assert len(cuts) == len(row.doc_ids) == len(row.doc_offsets)
        for (a, e), doc, at in zip(cuts, row.doc_ids, row.doc_offsets):
            assert places[a:e].tolist() == list(range(e - a))
            got.append((doc, at, line[a:e].tolist()))
        assert not line[row.cu_seqlens[-1] :].any()
    want = [(i, at, x[at : at + 32]) for i, x in docs if x for at in range(0, len(x), 32)]
    assert sorted(got) == sorted(want)


def test_end_ids_and_width(spark):
    row = packed_frame(spark, [(1, [5, 6])], length=8, end_id=50256).first()
    assert packing.read_matrix([row])[0].tolist() == [5, 6, 50256, 0, 0, 0, 0, 0]
    assert packed_frame(spark, [], length=8).collect() == []
    with pytest.raises(Exception, match="needs more than 2 bytes"):
        packed_frame(spark, [(1, [70_000])], length=8).collect()
    wide = packed_frame(spark, [(1, [70_000])], length=4, id_bytes=4).first()
    assert packing.read_matrix([wide], id_bytes=4)[0].tolist() == [70_000, 0, 0, 0]


def test_library_ids(documents, library):
    docs = documents(*enumerate(ODD_TEXTS))
    rows = docs.select("text", packing.library_ids(docs.text, RANKS, PATTERN).alias("ids")).collect()
    assert all(ids(r.ids) == library.encode_ordinary(r.text or "") for r in rows)


def test_all_ids_come_back_from_the_files(spark, library, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    tokens = docs.select("doc_id", packing.library_ids(docs.text, RANKS, PATTERN).alias("ids"))
    packing.write_packed(packing.pack(tokens, length=512, window=4096, end_id=50256), str(tmp_path / "packed"))
    parts = {}
    for r in packing.unpacked(packing.read_packed(spark, str(tmp_path / "packed"))).collect():
        parts.setdefault(r.doc_id, []).append((r.doc_offset, np.frombuffer(r.ids, "<u2").tolist()))
    got = {doc: [i for _, own in sorted(pieces) for i in own] for doc, pieces in parts.items()}
    texts = {r.doc_id: library.encode_ordinary(r.text or "") for r in docs.collect()}
    assert got == {doc: [*own, 50256] for doc, own in texts.items() if own}

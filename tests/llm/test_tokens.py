"""Ids, chunked encoding, ORC files and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.llm import chunked_bpe, orc_tokens, packing
from lamella.llm.tokens import default_vocabulary, encoder

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'l", "'ll", "1", "é", ".", "!!", "<|endoftext|>", " ", "　", "\r\n", "😀", "\x85",
         "\x1c", " the", " word", "中文", "​"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(default_vocabulary())
    return lambda text: own.encode(text or "", add_special_tokens=False).ids, lambda ids: own.decode(ids, skip_special_tokens=False)


def packed(ids):
    return np.asarray(ids, dtype="<u4").tobytes()


def test_ids_equal_library(library):
    encode, decode = library
    own, rng = encoder(default_vocabulary()), random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    points = points[:0x3100] + points[0x3100::41]
    texts += ["".join(f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1 ,{chr(c)}; \n" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    for text in texts:
        ids = encode(text)
        assert own.encode(text) == packed(ids), repr(text)
        assert own.decode(packed(ids)) == decode(ids)
    assert own.encode(None) == b"" and own.decode(packed([47249])) == decode([47249])


def test_joined_pieces_equal_whole_text(library):
    encode, _ = library
    own, rng = encoder(default_vocabulary()), random.Random(6)
    parts = [p for p in PARTS if p != "<|endoftext|>"]
    for k in range(1500):
        text = "".join(rng.choice(parts if k % 3 else [" the", "\n", "a", "'", "l", " "]) for _ in range(rng.randint(2, 200)))
        ends = sorted({rng.randint(1, len(text)) for _ in range(rng.randint(0, 6))} | {len(text)})
        pieces = [text[a:b] for a, b in zip([0, *ends], ends)]
        got = chunked_bpe.join_pieces([(p.encode(), np.frombuffer(own.encode(p), dtype="<u4")) for p in pieces], own)
        assert got.tolist() == encode(text), (text, ends)
    long = ["中文字" * 9_000, "a" * 70_000, "é" * 80_000 + " x"]
    pieces = [(p.encode(), np.frombuffer(own.encode(p), dtype="<u4")) for p in long]
    assert chunked_bpe.join_pieces(pieces, own).tolist() == encode("".join(long))


def test_chunks_depend_on_content_only():
    rng = random.Random(7)
    shared = "".join(rng.choice("abcdefgh éü") for _ in range(6000)).encode()
    own = encoder(default_vocabulary())
    cut = lambda raw: set(chunked_bpe.chunks(raw.decode(), own))
    one, two = cut(b"short start " + shared), cut("ein längerer Anfang, ganz anders als dort ".encode() * 40 + shared)
    assert len(one & two) > 4
    for raw in (shared, b"x" * 50_000, "é".encode() * 20_000, b"", b"ab"):
        parts = chunked_bpe.chunks(raw.decode(), own)
        assert b"".join(parts) == raw and all(len(p) <= chunked_bpe.LONGEST for p in parts)


def documents(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgéh") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(60, 500))) for _ in range(4)]
    texts = []
    for i in range(60):
        own = [" ".join(word() for _ in range(rng.randint(0, 300))) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            own.insert(rng.randint(0, 3), rng.choice(passages))
        texts.append(rng.choice([" ", "\n", ""]).join(own))
    texts += [None, "", "a", texts[3], texts[3], passages[0] + "<|endoftext|>" + passages[0], "中" * 4000, "word " * 3000]
    rows = [(i * 3 % 101, t, "own", i) for i, t in enumerate(texts)] + [(None, texts[5], None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int").repartition(5), rows


def test_chunked_encoding_round_trip(spark, library):
    encode, decode = library
    docs, rows = documents(spark)
    got = sorted((tuple(r) for r in chunked_bpe.encode(docs, keep_ids=True).collect()), key=repr)
    want = []
    for doc_id, text, *_ in rows:
        ids = encode(text)
        want.append((doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(decode(ids).encode()).hexdigest(),
                     bytearray(packed(ids))))
    assert got == sorted(want, key=repr)
    assert chunked_bpe.encode(docs.limit(0)).count() == 0


def test_orc_files(spark, library, tmp_path):
    encode, _ = library
    docs, rows = documents(spark)
    path = str(tmp_path / "ids")
    orc_tokens.write(docs, path)
    got = sorted((tuple(r) for r in orc_tokens.located(spark, path).collect()), key=repr)
    want, start = [], 0
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(text), 0]
        want.append((doc_id, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert got == sorted(want, key=repr)
    found = orc_tokens.read(spark, path).filter("doc_id = 3")
    assert "EqualTo(doc_id,3)" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters: ")[1].split("]")[0]
    assert [r.ids for r in found.collect()] == [[*encode(rows[1][1]), 0]]
    empty = str(tmp_path / "none")
    orc_tokens.write(docs.limit(0), empty)
    assert orc_tokens.located(spark, empty).count() == 0


def test_packing_is_whole_and_tight(spark, library):
    encode, _ = library
    docs, rows = documents(spark)
    tokens = packing.token_ids(docs)
    placed = packing.pack(packing.measured(tokens, 64), 64).collect()
    by_doc, by_sequence = {}, {}
    for r in placed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id in {r.doc_id for r in placed}:
        by_doc[doc_id] = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in placed if r.doc_id == doc_id)
    for doc_id, text, *_ in rows:
        ids = [*encode(text), 2]
        first = len(ids) % 64 or 64
        cut = [(0, first), *[(a, 64) for a in range(first, len(ids), 64)]]
        assert by_doc[doc_id] == [(k, a, n, zlib.crc32(packed(ids[a:a + n]))) for k, (a, n) in enumerate(cut)]
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in placed)
    assert len(by_sequence) <= total / 64 * 1.05 + 2
    assert packing.pack(packing.measured(tokens.limit(0))).count() == 0
    tokens = tokens.filter("doc_id IS NOT NULL")
    placed = packing.pack(packing.measured(tokens, 64), 64)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(tokens, placed).collect()}
    for r in placed.collect():
        assert zlib.crc32(whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)]) == r.ids_crc32


def test_plan_uses_every_length():
    rng = np.random.default_rng(4)
    for capacity in (2, 7, 64, 256):
        histogram = rng.integers(0, 50, capacity)
        histogram[0] = 0
        used = np.zeros(capacity, dtype=np.int64)
        contents = packing.plan(histogram, capacity)
        for lengths, count in contents:
            assert sum(lengths) <= capacity and count > 0
            for length in lengths:
                used[length] += count
        assert used.tolist() == histogram.tolist()
        # No packing can use fewer sequences than the volume asks for, nor than there are lengths over one half.
        least = max(-(-int((histogram * np.arange(capacity)).sum()) // capacity), int(histogram[capacity // 2 + 1:].sum()))
        assert sum(c for _, c in contents) <= least * 1.04 + 5


def test_numbers_of_a_hot_length_are_unique(spark, monkeypatch):
    monkeypatch.setattr(packing, "_CHUNK_ROWS", 50)
    rows = spark.range(600).select(F.lit(None).cast("bigint").alias("doc_id"), F.when(F.col("id") < 400, 10).otherwise(7).cast("bigint").alias("n_tokens"),
                                   F.array(F.lit(1).cast("bigint")).alias("crcs"))
    placed = packing.pack(rows, 24).collect()
    assert len(placed) == 600
    spots = {(r.sequence_id, r.offset) for r in placed}
    assert len(spots) == 600

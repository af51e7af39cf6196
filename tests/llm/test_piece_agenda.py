"""Ids and texts of the agenda against the sentencepiece library."""

import hashlib
import random

import pytest

from lamella.llm import piece_agenda
from lamella.llm.piece_agenda import Pieces, default_model

PARTS = [" ", "  ", "   ", "▁", "a", "the", "é", "ﬁ", "\x00", "\n", "\t", "中文", "😀", "</s>", "<0x41>", "<unk>", " " * 17, "ab" * 30, "1", "23", "Ä",
         "﷽", "​", "é", "�"]


@pytest.fixture(scope="module")
def own():
    return Pieces(default_model())


def test_ids_and_texts_equal_library(own):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(chr(c) for c in range(at, at + 40) if not 0xD800 <= c < 0xE000) for at in range(0, 0x20000, 97)]
    for text in texts:
        want = own.library.encode(text, add_eos=True)
        assert own.encode(text) == want, repr(text)
        assert own.decode(want) == own.library.decode(want)


def test_any_ids_decode_as_library(own):
    rng = random.Random(5)
    for _ in range(5000):
        ids = [rng.choice([0, 1, 2, 259, 260, rng.randrange(3, 259), rng.randrange(32000), rng.randrange(190, 259)]) for _ in range(rng.randint(0, 9))]
        assert own.decode(ids) == own.library.decode(ids), ids


def test_one_agenda_for_a_whole_text_gives_the_same(own):
    """Cutting before runs of blanks changes nothing, and neither does what is remembered."""
    rng = random.Random(6)
    for _ in range(500):
        text = "".join(rng.choice(PARTS + [" word", " longer words"]) for _ in range(rng.randint(1, 40)))
        assert [*own._ids_of(piece_agenda.BLANK + text.replace(" ", piece_agenda.BLANK)), own.end] == own.encode(text)
    assert own.splits


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(piece_agenda, "KEPT", 10)
    own = Pieces(default_model())
    text = " ".join(f"w{i % 37} x{i % 5}" for i in range(500))
    assert own.encode(text) == own.library.encode(text, add_eos=True)
    assert len(own._kept) <= 10 and len(own._older) <= 10


def test_long_words(own):
    for text in ("x" * 50_000, "中" * 20_000, " " * 30_000, "ab1é" * 10_000):
        assert own.encode(text) == own.library.encode(text, add_eos=True)


def test_other_kinds_of_model_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(default_model(), "rb") as file:
        spec.ParseFromString(file.read())
    spec.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError):
        Pieces(str(path))


def test_frames(spark, own):
    texts = [None, "", " ", "one two", "one two", "naïve 中文 😀 \x00", "</s> <s>", "y" * 20_000 + " end"]
    docs = spark.createDataFrame([(i if i != 4 else None, t, 1, 2) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int, decoded int")
    found = piece_agenda.encode(docs)
    assert found.columns == ["doc_id", "ids", "decoded", "agrees"]
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(texts) and all(r.agrees for r in rows.values())
    for i, text in enumerate(texts):
        row = rows[None if i == 4 else i]
        assert row.ids == own.library.encode(text or "", add_eos=True) and row.decoded == own.library.decode(row.ids)
    assert rows[0].ids == rows[1].ids == [own.end]
    assert piece_agenda.encode(docs.filter("false")).count() == 0


def test_registered_query(spark, own):
    from lamella.llm.queries import QUERIES

    rows = {r.doc_id: r for r in QUERIES["op12_piece_agenda"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for doc_id, text in docs:
        ids = own.library.encode(text or "", add_eos=True)
        assert rows[doc_id].n_tokens == len(ids) and rows[doc_id].agrees
        assert rows[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256(own.library.decode(ids).encode()).hexdigest()

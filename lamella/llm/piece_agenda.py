"""SentencePiece encoding and decoding with merge-type vocabularies by a score-ordered agenda.

A text is normalised (a leading blank, blanks as U+2581) and starts as one symbol
per character. Every two neighbours whose joined text is a piece stand on an
agenda, the highest score first, the leftmost first among equals. The first entry
is merged and its new neighbours go onto the agenda, until it is empty; entries
whose symbols are gone are passed over. What is no piece is spelled as bytes.

If no piece of the vocabulary goes on with U+2581 after another character, no merge
crosses the place before a run of blanks. Such a vocabulary allows the agenda to
work on one run of blanks and the word after it at a time, with the same result,
and each worker keeps the ids of words it has met (twice ``KEPT`` of them at most).

In each Arrow batch the words that are new to the worker are also encoded and decoded
by the sentencepiece library, and ``agrees`` says whether ids and text are equal for all
words of a document. Where a word is forgotten and met again it is held against the library again.

Defined cases: NULL text counts as empty; an empty text has no ids but the end
id. Special pieces written in a text are ordinary text. Repeated rows and rows
without a doc_id are rows like others. Very long words make a long agenda, whose
memory is linear in the word. Extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import by_batches, portions

BLANK = "▁"
#: A worker remembers so many words twice over (the last ones met, and those before), if they are no longer than this.
KEPT, KEPT_LENGTH = 1 << 19, 48
#: Up to so many characters the agenda is a list, beyond it a heap.
SHORT = 40
#: So many new words are held against the library at a time.
CHECKED = 256
_PLACES = (1 << 40) - 1
_NONE = 1 << 40
_WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


def default_model() -> str:
    """Path of the public merge-type model; callers may pass any other of this kind."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Ids of texts by merges in order of score, and texts of ids."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        rules, kind = spec.normalizer_spec, type(spec.pieces[0])
        if (spec.trainer_spec.model_type != spec.trainer_spec.BPE or not spec.trainer_spec.byte_fallback or rules.precompiled_charsmap
                or not rules.add_dummy_prefix or rules.remove_extra_whitespaces or not rules.escape_whitespaces
                or spec.trainer_spec.treat_whitespace_as_suffix or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in spec.pieces)):
            raise ValueError(f"{path} is not a plain merge-type model with byte fallback")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = self.library.eos_id()
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == kind.NORMAL}
        if max(map(len, self.ids)) > 255:
            raise ValueError(f"{path} has pieces of over 255 characters")
        # Highest score first; equal scores share a place. The length is in the low bits.
        order = {score: i for i, score in enumerate(sorted({p.score for p in spec.pieces}, reverse=True))}
        self.places = {p.piece: order[p.score] for p in spec.pieces if p.type == kind.NORMAL}
        self.ranks = {piece: place << 48 | len(piece) for piece, place in self.places.items()}
        self.byte_ids = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.splits = not any(re.search(f"[^{BLANK}]{BLANK}", piece) for piece in self.ids)
        self._kept: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._new: list[tuple[str, tuple[int, ...]]] = []
        byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self._bytes = [byte_of.get(i) for i in range(len(spec.pieces))]
        self._texts = [p.piece if p.type == kind.NORMAL else spec.trainer_spec.unk_surface if p.type == kind.UNKNOWN else ""
                       for p in spec.pieces]
        self._plain = [p.piece if p.type == kind.NORMAL else "" if i == self.end else chr(byte_of[i]) if byte_of.get(i, 128) < 128 else None
                       for i, p in enumerate(spec.pieces)]
        self._special = [p.type in (kind.UNKNOWN, kind.CONTROL) for p in spec.pieces]

    def merged(self, text: str) -> list[str]:
        """Symbols of a normalised text after all merges.

        An entry of the agenda is one number: place of the score, place of the left symbol, length of the joined text.
        """
        ranks, size = self.ranks, len(text)
        symbols: list[str | None] = list(text)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        agenda = [ranks[a + b] | i << 8 for i, (a, b) in enumerate(zip(text, text[1:])) if a + b in ranks]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry >> 8 & _PLACES
            first, right = symbols[left], after[left]
            # Stale if a symbol is gone or longer than it was.
            if first is None or right >= size or len(first) + len(symbols[right]) != entry & 255:
                continue
            piece = first + symbols[right]
            symbols[left], symbols[right] = piece, None
            follows, comes = after[right], before[left]
            after[left] = follows
            if follows < size:
                before[follows] = left
                joined = piece + symbols[follows]
                if joined in ranks:
                    heappush(agenda, ranks[joined] | left << 8)
            if comes >= 0:
                joined = symbols[comes] + piece
                if joined in ranks:
                    heappush(agenda, ranks[joined] | comes << 8)
        return [s for s in symbols if s is not None]

    def merged_word(self, text: str) -> list[str]:
        """The same for a short text. Its agenda is a list with the score of each symbol and the next one; the best is found by looking."""
        places = self.places
        symbols, agenda = list(text), [places.get(pair, _NONE) for pair in map(add, text, text[1:])]
        while agenda:
            best = min(agenda)
            if best == _NONE:
                break
            at = agenda.index(best)
            piece = symbols[at] = symbols[at] + symbols.pop(at + 1)
            del agenda[at]
            if at < len(agenda):
                agenda[at] = places.get(piece + symbols[at + 1], _NONE)
            if at:
                agenda[at - 1] = places.get(symbols[at - 1] + piece, _NONE)
        return symbols

    def _ids_of(self, text: str) -> list[int]:
        out = []
        for symbol in self.merged_word(text) if len(text) <= SHORT else self.merged(text):
            own = self.ids.get(symbol)
            if own is not None:
                out.append(own)
            else:
                out.extend(self.byte_ids[b] for b in symbol.encode())
        return out

    def words(self, text: str) -> list[str]:
        """Runs of blanks and the words after them, which no merge leaves."""
        normal = BLANK + text.replace(" ", BLANK)
        return _WORDS.findall(normal) if self.splits else [normal]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, the end id last."""
        found = list(map(self._kept.get, words := self.words(text) if text else []))
        if None in found:
            found = [ids if ids is not None else self._met(word) for ids, word in zip(found, words)]
        return [*chain.from_iterable(found), self.end]

    def _met(self, word: str) -> tuple[int, ...]:
        """Ids of a word that is not among the last ones met."""
        ids = self._kept.get(word)
        if ids is None:
            ids = self._older.get(word)
            if ids is None:
                ids = tuple(self._ids_of(word))
                self._new.append((word, ids))
            if len(word) <= KEPT_LENGTH:
                if len(self._kept) >= KEPT:
                    self._older, self._kept = self._kept, {}
                self._kept[word] = ids
        return ids

    def differing(self) -> set[str]:
        """Words made since the last call whose ids or text are not those of the library."""
        new, self._new = [x for x in self._new if len(x[0]) > 1], []
        bad = set()
        for at in range(0, len(new), CHECKED):
            some = new[at:at + CHECKED]
            # Put together, the words are a text. If that agrees, each of them does.
            text = "".join(word for word, _ in some)[1:].replace(BLANK, " ")
            ids = [i for _, own in some for i in own]
            want = self.library.encode(text, num_threads=1)
            if self.splits and ids == want and self.decode(ids) == self.library.decode(want):
                continue
            for word, ids in some:
                want = self.library.encode(word[1:].replace(BLANK, " "))
                if ids != want or self.decode(ids) != self.library.decode(want):
                    bad.add(word)
        return bad

    def decode(self, ids: list[int]) -> str:
        """Text of ids: blanks for U+2581, the leading one left out, bytes joined to characters, U+FFFD for each stray byte."""
        try:
            # Pieces and ASCII characters only; other ids have no text in this table.
            return "".join(map(self._plain.__getitem__, ids)).removeprefix(BLANK).replace(BLANK, " ")
        except TypeError:
            pass
        out, run, first = [], bytearray(), True
        for i in ids:
            value = self._bytes[i]
            if value is not None:
                run.append(value)
                continue
            if run:
                out.append(_characters(bytes(run)))
                run.clear()
                first = False
            piece = self._texts[i]
            if self._special[i]:
                out.append(piece)
                first = first and not piece
                continue
            if first:
                piece, first = piece.removeprefix(BLANK), False
            out.append(piece.replace(BLANK, " "))
        if run:
            out.append(_characters(bytes(run)))
        return "".join(out)


def _characters(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError as error:
        # One mark for the first byte that begins no character; the rest is tried again.
        return raw[:error.start].decode() + "�" + _characters(raw[error.start + 1:])


def pieces(path: str) -> Pieces:
    """One model per file and worker process, hung on a module of the worker's own installation."""
    import sentencepiece

    held = sentencepiece.__dict__.setdefault("_lamella_pieces", {})
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def encode(docs: DataFrame, model: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, ids (the end id last), decoded (their text) and agrees (with the library) of every row."""
    path = model or default_model()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = pieces(path), batch.column(1).to_pylist()
        values, sizes, decoded, bad = [], [], [], set()
        for start, stop in portions(texts):
            for text in texts[start:stop]:
                ids = own.encode(text)
                values.append(np.array(ids, dtype=np.int32))
                sizes.append(len(ids))
                decoded.append(own.decode(ids))
            bad |= own.differing()
        agrees = [not bad or bad.isdisjoint(own.words(text) if text else ()) for text in texts]
        flat = pa.array(np.concatenate(values)) if values else pa.array([], pa.int32())
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
        return pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())],
                                          names=["doc_id", "ids", "decoded", "agrees"])
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, "doc_id bigint, ids array<int>, decoded string, agrees boolean", run)

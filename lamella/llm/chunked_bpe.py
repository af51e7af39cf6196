"""BPE encoding with content-defined chunks that documents share.

A rolling hash over 16 bytes cuts texts where its low bits are zero, so equal
passages get equal chunks wherever they stand. A first pass counts the hashes of
all chunks; those that occur twice or more are marked in a bit map of fixed size
(a false mark costs a detour, never a wrong id). In the second pass a document
without marked chunks is encoded in place. Of the others the marked chunks go out
as (hash, text), each text once per task; they are grouped by hash, encoded once,
and joined back to where they occur. What stands between them is encoded in place.

Joins between pieces are repaired. The scan of a piece agrees with the scan of
the whole text up to its last token that starts with a blank and a letter: the
pre-tokenizer has no memory there. From that token on, the text is encoded anew
into the next piece, far enough until both encodings have such a token at the
same place before the end of the window; from there on they agree exactly. If
they never do, the pieces become one and the repair goes on with the next.

Defined cases: NULL text counts as empty. A text that holds a special token is one
piece. Repeated rows are encoded as often as they occur, with equal results, also
without a doc_id. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import written
from lamella.llm.tokens import Encoder, default_vocabulary, encoder

WINDOW = 16
CHUNK_BITS = 9
SHORTEST, LONGEST = 128, 8_192
MAP_BITS = 26
UNSURE = 65_536
_BASE = 0x01000193


def cuts(raw: bytes, special: bool = False) -> list[int]:
    """Ends of the chunks of a UTF-8 text; chunks never split a character."""
    size = len(raw)
    if special or size <= SHORTEST:
        return [size] if size else []
    data = np.frombuffer(raw, dtype=np.uint8)
    rolled, width, base = data.astype(np.uint32), 1, _BASE
    while width < WINDOW:  # the hash of 2w bytes from those of w bytes
        rolled = rolled[:-width] * np.uint32(base) + rolled[width:]
        width, base = 2 * width, base * base % (1 << 32)
    mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    # The cut comes behind the window, where a character begins.
    found = np.flatnonzero(mixed >> np.uint32(32 - CHUNK_BITS) == 0) + WINDOW
    found = found[found < size]
    found = found[(data[found] & 0xC0) != 0x80].tolist()
    ends, last = [], 0
    for end in [*found, size]:
        while end - last > LONGEST:
            at = last + LONGEST
            while data[at] & 0xC0 == 0x80:
                at -= 1
            ends.append(at)
            last = at
        if end - last >= SHORTEST or end == size:
            ends.append(end)
            last = end
    return ends


def chunks(text: str | None, own: Encoder) -> list[bytes]:
    raw = (text or "").encode()
    out, start = [], 0
    for end in cuts(raw, own.has_special(text or "")):
        out.append(raw[start:end])
        start = end
    return out


def narrow(ids: bytes, own: Encoder) -> bytes:
    """Ids as stored between the steps: two bytes each where the vocabulary allows it."""
    return np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes() if len(own.token_bytes) <= 65_536 else ids


def wide(stored: bytes, own: Encoder) -> np.ndarray:
    return np.frombuffer(stored, dtype="<u2" if len(own.token_bytes) <= 65_536 else "<u4").astype("<u4")


def digest(chunk: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(chunk)


def place(key: bytes) -> int:
    """Bit of a chunk in the map."""
    return int.from_bytes(key[:4], "little") >> (32 - MAP_BITS)


def _sure_starts(ids: np.ndarray, own: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all tokens, and at which of them any scan of the text must begin a piece: a blank before an ASCII
    letter, or such a letter behind a line end."""
    pieces = own.bytes_of(ids)
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    sure = np.zeros(len(pieces), dtype=bool)
    for k, p in enumerate(pieces):
        sure[k] = p[1:2].isalpha() if p[:1] == b" " else k > 0 and p[:1].isalpha() and pieces[k - 1][-1:] == b"\n"
    return np.cumsum(sizes) - sizes, sure


def join_pieces(pieces: list[tuple[bytes, np.ndarray]], own: Encoder, reach: int = 48) -> np.ndarray:
    """Ids of a text from its consecutive pieces, each as (UTF-8 bytes, ids of the piece alone)."""
    done: list[np.ndarray] = []
    tail_raw, tail = pieces[0]
    for raw, ids in pieces[1:]:
        # The tail keeps the text since a place that is sure: only its own last part can be wrong.
        offsets, sure = _sure_starts(tail[-reach:], own)
        skipped = len(tail) - len(offsets)
        last = np.flatnonzero(sure)
        if len(last) == 0 and skipped:
            skipped, (offsets, sure) = 0, _sure_starts(tail, own)
            last = np.flatnonzero(sure)
        if len(last):
            at = int(last[-1])
            done.append(tail[:skipped + at])
            before = sum(map(len, own.bytes_of(tail[skipped + at:])))
            head_raw = tail_raw[len(tail_raw) - before:]
        else:
            head_raw = tail_raw
            if len(head_raw) > UNSURE:  # a text almost without blanks and lines: encoding it whole costs less
                return np.frombuffer(own.encode(b"".join(p for p, _ in pieces).decode()), dtype="<u4")
        width = 64
        while True:
            cut = min(width, len(raw))
            while cut < len(raw) and raw[cut] & 0xC0 == 0x80:
                cut += 1
            window = np.frombuffer(own.encode((head_raw + raw[:cut]).decode()), dtype="<u4")
            if cut == len(raw):
                tail_raw, tail = head_raw + raw, window
                break
            w_offsets, w_sure = _sure_starts(window, own)
            near = ids[:cut]  # a token holds a byte at least
            p_offsets, p_sure = _sure_starts(near, own)
            places = {int(o) + len(head_raw): k for k, (o, s) in enumerate(zip(p_offsets, p_sure)) if s}
            both = [k for k in np.flatnonzero(w_sure) if int(w_offsets[k]) in places]
            if both:
                done.append(window[:both[-1]])
                k = places[int(w_offsets[both[-1]])]
                tail_raw, tail = raw[int(p_offsets[k]):], ids[k:]
                break
            width *= 4
    done.append(tail)
    return np.concatenate(done)


def _finished(ids: np.ndarray, own: Encoder, keep_ids: bool) -> tuple[int, str, str, bytes | None]:
    raw = np.ascontiguousarray(ids, dtype="<u4").tobytes()
    text = own.decode(raw).encode()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest(), raw if keep_ids else None


def shared_map(docs: DataFrame, path: str) -> bytes:
    """Bit map of the chunks that occur twice or more; ``2**MAP_BITS`` bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            keys = [digest(c) for t in batch.column(0).to_pylist() for c in chunks(t, own)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], names=["key"])
    counted = docs.select("text").mapInArrow(run, "key binary").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.array([place(k) for k in batch.column(0).to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places >> 6), pa.array(np.uint64(1) << (places & 63).astype(np.uint64)).cast(pa.int64(), safe=False)],
                                             names=["word", "bits"])
    words = counted.select("key").mapInArrow(marks, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = np.zeros(1 << (MAP_BITS - 6), dtype=np.int64)
    found = words.toPandas()  # at most 2**(MAP_BITS - 6) rows of two numbers
    table[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return table.tobytes()


RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
PARTS = "row string, doc_id bigint, part int, key binary, raw binary, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"


def _batch(rows: list[tuple], fields: str) -> pa.RecordBatch:
    named = [f.split() for f in fields.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(named)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, named)], names=[n for n, _ in named])


def _parts(docs: DataFrame, path: str, marked, keep_ids: bool) -> DataFrame:
    """Finished rows of documents without marked chunks; else a row per piece, with its ids, or with the chunk's key (and its
    bytes, once per task)."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sent = encoder(path), set()
        table = np.frombuffer(marked.value, dtype=np.uint64)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own_chunks = chunks(text, own)
                keys = [digest(c) for c in own_chunks]
                at = np.array([place(k) for k in keys], dtype=np.int64)
                hit = (table[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool) if len(keys) else np.zeros(0, bool)
                row, number = f"{task}:{number}", number + 1
                if not hit.any():
                    ids = np.frombuffer(own.encode(text), dtype="<u4")
                    out.append((row, doc_id, -1, None, None, *_finished(ids, own, keep_ids)))
                    continue
                part, k = 0, 0
                while k < len(keys):
                    if hit[k]:
                        raw = own_chunks[k] if keys[k] not in sent else None
                        if len(sent) < 200_000:  # beyond it some texts go out again
                            sent.add(keys[k])
                        out.append((row, doc_id, part, keys[k], raw, None, None, None, None))
                        k += 1
                    else:
                        end = k
                        while end < len(keys) and not hit[end]:
                            end += 1
                        raw = b"".join(own_chunks[k:end])
                        out.append((row, doc_id, part, None, None, None, None, None, narrow(own.encode(raw.decode()), own)))
                        k = end
                    part += 1
            yield _batch(out, PARTS)
    return docs.mapInArrow(run, PARTS)


def encode(docs: DataFrame, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id",
           keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ``ids`` (NULL unless they are to be kept) of every row."""
    path = vocabulary or default_vocabulary()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    marked = docs.sparkSession.sparkContext.broadcast(shared_map(rows, path))  # 2**MAP_BITS bits
    parts = written(_parts(rows, path, marked, keep_ids), "bpe-parts")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = [narrow(own.encode(raw.decode()), own) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["of", "own_ids"])
    texts = parts.filter("key IS NOT NULL AND raw IS NOT NULL").groupBy(F.col("key").alias("of")).agg(F.max("raw").alias("own_raw"))
    encoded = texts.mapInArrow(once, "of binary, own_ids binary")
    pieces = parts.filter("part >= 0").select("row", "doc_id", "part", "key", "ids")
    shared = pieces.filter("key IS NOT NULL").join(encoded, F.col("key") == F.col("of")).select(
        "row", "doc_id", "part", F.col("own_ids").alias("ids"))
    whole = shared.unionByName(pieces.filter("key IS NULL").drop("key"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row, doc, held = encoder(path), None, None, []

        def close():
            return (doc, *_finished(join_pieces(held, own), own, keep_ids))
        for batch in batches:
            out = []
            for r, d, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if r != row:
                    if held:
                        out.append(close())
                    row, doc, held = r, d, []
                ids = wide(ids, own)
                held.append((b"".join(own.bytes_of(ids)), ids))
            yield _batch(out, RESULT)
        if held:
            yield _batch([close()], RESULT)
    grouped = whole.repartition("row").sortWithinPartitions("row", "part").select("row", "doc_id", "part", "ids")
    ready = parts.filter("part < 0").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")
    return ready.unionByName(grouped.mapInArrow(joined, RESULT))

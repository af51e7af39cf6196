"""Near copies by five-word Jaccard similarity, beside the SimHash links of operator 8.

Each different set of five-word shingles is one node. Its ``BANDS`` keys are hashes
of ``ROWS`` minima each; sets with similarity 0.8 share a key with a probability of
1 - (1 - 0.8 ** 5) ** 24 = 0.99993. Pairs that share a key are verified on the whole
sets, so no link rests on an estimate.

Within a key, every node is first held against one pivot, the node that shares its keys
with most others: of copies with small changes, the text they come from. They meet in a
component by that, whatever their number. Then only keys whose nodes lie in different
components are looked at again: their nodes are paired across components, once each, if the
sizes of the sets allow the similarity and at least ``AGREE`` of their ``BANDS * ROWS`` minima agree
(seven bits of each; at similarity 0.8, 96 do, and fewer than that with a probability of 0.0001).
A key with more than ``CROWD`` nodes is split by the keys that follow it before. Its nodes get a longer signature of ``WIDE`` minima, of which ``WIDE_AGREE`` have to agree
(at similarity 0.8 fewer than that do with a probability of 0.00005): texts of one template that are no copies stay unpaired.

Texts within three bits of SimHash are linked as well, as in operator 8.

Defined cases: NULL, empty and blank texts have no shingles and are copies of each other
(by their fingerprint). Texts of under five words are one shingle. Rows that are
equal in all columns are one row. Rows with one doc_id and different texts are rows of
their own. Rows without a doc_id take part, after all others of their group. Extra
columns stay, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.llm import simhash
from lamella.llm.common import by_batches, one_per_group, with_row_keys, written

WORDS_PER_SHINGLE = 5
#: Least similarity of a link, as a fraction of whole numbers.
SIMILAR = (4, 5)
BANDS, ROWS = 24, 5
#: A crowded key is split by so many of the keys that follow it.
NEXT = 3
CROWD = 32
#: Minima that have to agree before two sets are compared as a whole.
AGREE = 80
#: The same for the nodes of crowded keys.
WIDE, WIDE_AGREE = 255, 179
#: Minima in a number of the signature: a byte each, its top bit free.
LANES = 7
_PART = 2048
_WIDE_FACTORS = np.random.default_rng(simhash.SEED + 1).integers(0, 1 << 63, (WIDE, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = np.random.default_rng(simhash.SEED).integers(0, 1 << 63, (BANDS * ROWS + ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the different five-word shingles; of all words if there are fewer; none of a blank text."""
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, dtype="<u8")
    joined, size = b" ".join(parts), min(WORDS_PER_SHINGLE, len(parts))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    bounds = zip(starts[:len(parts) - size + 1].tolist(), ends[size - 1:].tolist())
    return np.unique(np.fromiter((digest(joined[a:b], simhash.SEED) for a, b in bounds), dtype="<u8"))


def minima(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least of all hashes times each factor."""
    least = np.full((len(factors), 1), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), _PART):
        least = np.minimum(least, (hashes[at:at + _PART] * factors).min(axis=1, keepdims=True))
    return least


def signature(least: np.ndarray) -> np.ndarray:
    """Seven bits of each minimum, ``LANES`` to a number."""
    short = np.zeros(-(-len(least) // LANES) * LANES, dtype=np.uint64)
    short[:len(least)] = (least[:, 0] * _FACTORS[0, 0]) >> np.uint64(57)
    return (short.reshape(-1, LANES) << (np.arange(LANES, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64)


def node_and_keys(hashes: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Hash of the set, its band keys and its signature: seven bits of each minimum, ``LANES`` to a number."""
    import xxhash

    if not len(hashes):
        return 0, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    least = minima(hashes, _FACTORS[:-ROWS])
    bands = (least.reshape(BANDS, ROWS) * _FACTORS[-ROWS:].T).sum(axis=1, dtype=np.uint64)
    return xxhash.xxh64_intdigest(hashes.tobytes()), (bands ^ (bands >> np.uint64(31))) * _FACTORS[:BANDS, 0] + np.arange(BANDS, dtype=np.uint64), signature(least)


def body_of(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def nodes_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, body (hash of the text), fp, node, size (of its set), keys and signature of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps, nodes, sizes, keys, marks = [], [], [], [], []
        for value in batch.column(2).to_pylist():
            held = shingles(value)
            node, own, mark = node_and_keys(held)
            fps.append(simhash.fingerprint(value))
            nodes.append(node)
            sizes.append(len(held))
            keys.append(own.view(np.int64))
            marks.append(mark.view(np.int64))
        longs = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (fps, nodes)]
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, marks)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *longs, pa.array(sizes, pa.int32()), *lists],
                                          names=["doc_id", "body", "fp", "node", "size", "keys", "mark"])
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), body_of(text).alias("body"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, "doc_id bigint, body bigint, fp bigint, node bigint, size int, keys array<bigint>, mark array<bigint>", run)


def _shared(keyed: DataFrame) -> DataFrame:
    """Rows (k, node and more) of keys that several nodes share, with their number ``n``."""
    sizes = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return written(keyed.join(sizes, "k"), "near-keys")


def _stars(shared: DataFrame) -> DataFrame:
    """Each node of a key with the key's pivot: the node whose keys are shared by most."""
    fame = shared.groupBy("node").agg(F.sum("n").alias("fame"))
    pivots = shared.select("k", "node").join(fame, "node").groupBy("k").agg(F.max_by("node", F.struct("fame", "node")).alias("first"))
    pairs = shared.select("k", "node").join(pivots, "k").filter("node <> first")
    return pairs.select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b"))


def _parted(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``shared`` with the component of each node, of the keys whose nodes lie in several."""
    placed = shared.join(roots.select("node", F.col("root").alias("_r")), "node", "left").withColumn("root", F.coalesce("_r", "node")).drop("_r")
    several = placed.groupBy("k").agg(F.min("root").alias("_l"), F.max("root").alias("_m")).filter("_l <> _m").select("k")
    return written(placed.join(several, "k"), "near-parted")


def may_be_similar(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar."""
    return SIMILAR[1] * F.least(a, b) >= SIMILAR[0] * F.greatest(a, b)


def agreeing(a: str, b: str, count: int = BANDS * ROWS) -> Column:
    """How many minima of two signatures agree: those whose bytes differ by nothing."""
    low, top = (sum(byte << 8 * i for i in range(LANES)) for byte in (0x7F, 0x80))
    # Adding 0x7F sets the top bit of each byte that is not zero. The bytes that fill up the last number are.
    other = [F.bit_count((F.col(a)[i].bitwiseXOR(F.col(b)[i]) + F.lit(low)).bitwiseAND(F.lit(top))) for i in range(-(-count // LANES))]
    return F.lit(count) - sum(other[1:], other[0])


def wide_marks(sets: DataFrame) -> DataFrame:
    """node and wide (its longer signature)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        marks = [signature(minima(np.frombuffer(x.as_buffer(), "<u8"), _WIDE_FACTORS)).view(np.int64) for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.list_(pa.int64()))], names=["node", "wide"])
    return written(by_batches(sets.select("node", "held"), "node bigint, wide array<bigint>", run), "near-wide")


def _across(parted: DataFrame, nodes: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """Pairs of nodes in different components that share a key, each once, if they may be similar by size and signature."""
    # At most BANDS * NEXT keys of a node, four bytes each.
    own = parted.groupBy("node").agg(F.sort_array(F.collect_set(F.hash("k"))).alias("own"))
    rows = parted.select("k", "node", "root").join(own, "node")
    if wide is None:
        rows, bits, least = rows.join(nodes.select("node", "size", F.col("mark").alias("bits")), "node"), BANDS * ROWS, AGREE
    else:
        rows, bits, least = rows.join(nodes.select("node", "size"), "node").join(wide.select("node", F.col("wide").alias("bits")), "node"), WIDE, WIDE_AGREE
    right = rows.select("k", *[F.col(c).alias(n) for c, n in (("node", "b"), ("root", "_r"), ("size", "_s"), ("own", "_own"), ("bits", "_bits"))])
    near = (F.col("root") != F.col("_r")) & (F.col("node") < F.col("b")) & may_be_similar("size", "_s") & (agreeing("bits", "_bits", bits) >= least)
    once = F.element_at(F.array_intersect("own", "_own"), 1) == F.hash("k")
    return rows.join(right, "k").filter(near & once).select(F.col("node").alias("a"), "b")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return SIMILAR[1] * both >= SIMILAR[0] * (len(a) + len(b) - both)


def sets_of(nodes: DataFrame, rows: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """node and held (its whole set) of the ``nodes``, from one text of each."""
    first = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "body")).alias("_f")).select(
        "node", F.col("_f.doc_id").alias("_id"), F.col("_f.body").alias("_body"))
    texts = docs.select(F.col(doc_id).cast("bigint").alias("id"), body_of(text).alias("body"), F.col(text).cast("string").alias("text"))
    named = texts.join(first, (F.col("body") == F.col("_body")) & F.col("id").eqNullSafe(F.col("_id")))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
                                          names=["node", "held"])
    return written(by_batches(named.select("node", "text"), "node bigint, held binary", cut).dropDuplicates(["node"]), "near-sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` of nodes whose sets are similar."""
    pairs = written(pairs.distinct(), "near-pairs")
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("held").alias("ha")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("held").alias("hb")), "b").select("a", "b", "ha", "hb")

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = [similar(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")) for x, y in zip(batch.column(2), batch.column(3))]
        return batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))
    return written(by_batches(joined, "a bigint, b bigint", check), "near-links")


def links(rows: DataFrame, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Links ``a``, ``b`` that connect all nodes with similar sets that share a key."""
    nodes = rows.groupBy("node").agg(*[F.first(c).alias(c) for c in ("keys", "size", "mark")])
    shared = _shared(nodes.select("node", F.explode("keys").alias("k")))
    sets = sets_of(shared.select("node").distinct(), rows, docs, text, doc_id)
    found = verified(_stars(shared), sets)
    parted = _parted(shared, simhash.components(found))
    pairs, crowded = _across(parted.filter(F.col("n") <= CROWD), nodes), parted.filter(F.col("n") > CROWD)
    if not crowded.isEmpty():
        at = F.array_position("keys", F.col("k")).cast("int")
        finer = F.array(*[F.xxhash64("k", F.element_at("keys", (at + (step - 1)) % BANDS + 1)) for step in range(1, NEXT + 1)])
        split = crowded.select("node", "k", "root").join(nodes.select("node", "keys"), "node").select("node", "root", F.explode(finer).alias("k"))
        again = _shared(split)
        wide = wide_marks(sets.join(again.select("node").distinct(), "node", "left_semi"))
        pairs = pairs.unionByName(_across(again, nodes, wide))
    return found.unionByName(verified(pairs, sets))


def grouped(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, body and ``grp`` of every row: rows with one grp are copies of each other."""
    rows = written(nodes_of(docs, text, doc_id), "near-nodes")
    prints = rows.groupBy("fp").agg(F.min("node").alias("first"))
    close = simhash.close_links(prints)
    mapped = close.join(prints.select(F.col("fp").alias("a"), F.col("first").alias("_a")), "a").join(
        prints.select(F.col("fp").alias("b"), F.col("first").alias("_b")), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    same = rows.select("fp", "node").distinct().join(prints, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    every = links(rows, docs, text, doc_id).unionByName(mapped).unionByName(same).filter("a <> b")
    roots = simhash.components(every)
    return rows.join(roots, "node", "left").select("doc_id", "body", F.coalesce("root", "node").alias("grp"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each group, with all columns: the one with the smallest doc_id, one without a doc_id only where no other is."""
    keyed = with_row_keys(docs, text, doc_id)
    groups = grouped(keyed.select("row_id", "row_text"), "row_text", "row_id")
    # Every row of a text has the text's group.
    by_text = groups.groupBy("body").agg(F.min("grp").alias("grp"))
    return one_per_group(keyed, by_text, body_of("row_text"))

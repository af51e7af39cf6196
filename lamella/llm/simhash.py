"""SimHash near-duplicates by pigeonhole blocks.

Two fingerprints that differ in at most ``distance`` bits agree in at least
``blocks - distance`` of their ``blocks`` blocks. Each fingerprint is keyed by
every such choice of blocks, so each close pair meets under a key, and pairs
within a key are verified. Copies (equal fingerprints) are one node.

No group of a key is ever paired off whole: a key with more than ``CROWD``
members is split again by blocks of the bits it does not fix. After that split a
key fixes at least 48 of the 64 bits, so at most 65,536 different fingerprints
can share it, and such a group reports a spanning forest instead of its pairs.

Defined cases: NULL, empty and blank texts have the fingerprint zero, which links
like any other. Repeated rows are copies. Rows without a doc_id take part, and
their component is named by the smallest doc_id in it (NULL if there is none).
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import by_batches, one_per_group, with_row_keys, written

SEED = 42
WORDS_PER_SHINGLE = 3
#: A key with more members is split again instead of paired.
CROWD = 32
_PART = 1 << 16


def fingerprint(text: str | None, words: int = WORDS_PER_SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits over all shingles of a text, repeats included."""
    import xxhash

    parts = (text or "").encode().lower().split()  # of bytes: only A-Z, and only the blank and \t to \r
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(len(parts) - words + 1, 1)
    digest = xxhash.xxh64_intdigest
    last = ends[words - 1:] if len(parts) >= words else ends[-1:]
    tally = np.zeros(64, dtype=np.int64)
    for at in range(0, count, _PART):
        bounds = zip(starts[at:min(at + _PART, count)].tolist(), last[at:at + _PART].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in bounds], dtype="<u8")
        tally += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(tally * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ``fp`` (the 64 bits as a signed long) of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, "doc_id bigint, fp bigint", run)


def block_masks(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Masks of every choice of ``blocks - distance`` out of ``blocks`` even blocks of the given bits."""
    cut = [sum(1 << int(b) for b in part) for part in np.array_split(bits, blocks)]
    return [sum(chosen) for chosen in combinations(cut, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(rows: DataFrame, level: str, masks: list[int], keys: list[str]) -> DataFrame:
    """Each row once per mask: the mask's number and the masked bits."""
    choices = F.array(*[F.struct(F.lit(i).cast("int").alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
                        for i, m in enumerate(masks)])
    return rows.select("fp", *keys, F.explode(choices).alias("_k")).select(
        "fp", *keys, F.col("_k.c").alias(f"c{level}"), F.col("_k.k").alias(f"k{level}"))


def _meeting(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is shared, with the number that share it."""
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return written(keyed.join(sizes, keys), "simhash-keys")


def _pairs(rows: DataFrame, keys: list[str], distance: int) -> DataFrame:
    left = rows.filter(F.col("n") <= CROWD)
    right = left.select(*keys, F.col("fp").alias("b"))
    near = (F.col("fp") < F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= distance)
    joined = left.join(right, keys).filter(near)
    return joined.select(F.col("fp").alias("a"), "b").distinct()


def spanning_links(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph of close values; memory is linear in them."""
    own = np.asarray(values, dtype=np.int64).view(np.uint64)
    left, links = np.ones(len(own), dtype=bool), []
    for start in range(len(own)):
        if not left[start]:
            continue
        left[start], queue = False, [start]
        while queue:
            i = queue.pop()
            rest = np.flatnonzero(left)
            close = rest[np.bitwise_count(own[rest] ^ own[i]) <= distance]
            left[close] = False
            links += [(i, int(j)) for j in close]
            queue += close.tolist()
    return links


def close_links(fps: DataFrame, distance: int = 3, blocks: int = 6) -> DataFrame:
    """Links ``a``, ``b`` that connect all different fingerprints within ``distance`` bits of each other."""
    keys = ["c1", "k1"]
    masks = block_masks(list(range(64)), blocks, distance)
    met = _meeting(_keyed(fps.select("fp"), "1", masks, []), keys)
    links = _pairs(met, keys, distance)
    crowded = met.filter(F.col("n") > CROWD)
    if crowded.isEmpty():
        return links
    # Split by seven blocks of the bits that the key leaves open: four of them agree, too.
    deeper = []
    for i, mask in enumerate(masks):
        finer = block_masks([b for b in range(64) if not mask >> b & 1], 7, distance)
        deeper.append(_keyed(crowded.filter(F.col("c1") == i), "2", finer, keys))
    both = deeper[0]
    for part in deeper[1:]:
        both = both.unionByName(part)
    keys2 = [*keys, "c2", "k2"]
    met2 = _meeting(both, keys2)

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        own = group["fp"].to_numpy()
        pairs = np.array(spanning_links(own, distance), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": own[pairs].min(axis=1), "b": own[pairs].max(axis=1)})

    whole = met2.filter(F.col("n") > CROWD).groupBy(*keys2).applyInPandas(forest, "a bigint, b bigint")
    return links.unionByName(_pairs(met2, keys2, distance)).unionByName(whole).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every linked node but the roots.

    Alternates large and small stars: each round links neighbours to the smallest
    node seen. The smallest of a hub is an aggregate, combined before the shuffle.
    """
    now, before = written(links.select("a", "b").filter("a <> b").distinct(), "links"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "links")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = 3,
                    blocks: int = 6) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    rows = written(fingerprints(docs, text, doc_id), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    stars = components(close_links(nodes, distance, blocks))
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each component, with all columns: the one with the smallest doc_id, one without a doc_id only where no other is."""
    keyed = with_row_keys(docs, text, doc_id)
    rows = keyed.select("row_id", "row_text", F.xxhash64("row_text").alias("body"))
    prints = fingerprints(rows, "row_text", "body").select(F.col("doc_id").alias("body"), "fp").distinct()
    prints = written(prints, "fingerprints")
    stars = components(close_links(prints.select("fp").distinct()))
    groups = prints.join(stars, F.col("fp") == F.col("node"), "left").groupBy("body").agg(F.min(F.coalesce("root", "fp")).alias("grp"))
    return one_per_group(keyed, groups, F.xxhash64("row_text"))

"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(bias + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]),
so all pairwise interactions cost time linear in the features. Words are those of
the whole text (lower case, each once, scaled by the root of their number);
structure statistics come from the histogram of its bytes, its words and its
lines; the metadata is the stated number of characters.

The fit takes at most ``FIT_ROWS`` labelled rows, those with the smallest hash of
their id (a documented bound), as features only; it runs in minibatches with
AdaGrad. Every row is scored.

Defined cases: NULL text counts as empty and is scored like any other; NULL or
wrong metadata has a flag of its own. Labels that are NULL or have no document
are ignored; of several labels of one document the smallest counts. Without rows
of both labels the score is the share of label 1 among those there are, or 0.5.
Repeated rows get equal scores. Empty tables give empty results.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.common import by_batches, portions

#: At most so many labelled rows are fitted.
FIT_ROWS = 8_000
BUCKETS = 1 << 16
FACTORS = 8
_STORED = 100_000

# Groups of bytes whose share in the text is a statistic.
_GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b"#*$%&", b"<>|",
           b"{}[]()=/\\_^~`@+", b"!", b"?", b".", b",;:", b"'\"-", bytes(range(128, 256)), bytes(range(9)) + bytes(range(14, 32)) + b"\x7f")
STATS = len(_GROUPS) + 10


def statistics(text: str, words: list[str], distinct: int, n_chars: int | None) -> list[float]:
    """Structure statistics and metadata of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    histogram = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size = max(len(raw), 1)
    shares = [float(histogram[list(group)].sum()) / size for group in _GROUPS]
    lines = [line for line in text.split("\n") if line.strip()]
    chars, number = len(text), len(words)
    return [*shares, np.log1p(chars), np.log1p(number), np.log1p(len(lines)), (chars / number if number else 0.0) ** 0.5,
            distinct / number if number else 1.0, len(set(lines)) / len(lines) if lines else 1.0,
            np.log1p(number / len(lines)) if lines else 0.0, np.log1p(max(map(len, words), default=0)),
            float(n_chars is None or n_chars < 0), 0.0 if n_chars is None or n_chars < 0 else float(np.log1p(n_chars))]


def word_buckets(words: set[str], stored: dict[str, int]) -> list[int]:
    if len(stored) > _STORED:
        stored.clear()
    out = []
    for word in words:
        bucket = stored.get(word)
        if bucket is None:
            bucket = stored[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        out.append(bucket)
    return out


def featurize(texts: list[str | None], n_chars: list[int | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of the different words, and the statistics, of each text."""
    stored: dict[str, int] = {}
    buckets, stats = [], np.zeros((len(texts), STATS), dtype=np.float32)
    for i, (text, stated) in enumerate(zip(texts, n_chars)):
        text = text or ""
        words = text.lower().split()
        different = set(words)
        buckets.append(np.array(word_buckets(different, stored), dtype=np.int32))
        stats[i] = statistics(text, words, len(different), stated)
    return buckets, stats


@dataclass
class Machine:
    """A fitted machine; the last ``STATS`` weights are those of the statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def rows(self, buckets: list[np.ndarray], stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat feature numbers, their values, and where each text begins."""
        dense = np.clip((stats - self.centre) / self.scale, -4, 4).astype(np.float32) / np.float32(np.sqrt(STATS))
        places = np.arange(BUCKETS, BUCKETS + STATS, dtype=np.int32)
        index = np.concatenate([np.concatenate([b, places]) for b in buckets])
        value = np.concatenate([np.concatenate([np.full(len(b), 1 / np.sqrt(max(len(b), 1)), dtype=np.float32), d])
                                for b, d in zip(buckets, dense)])
        starts = np.cumsum([0, *[len(b) + STATS for b in buckets[:-1]]])
        return index, value, starts

    def margins(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum for each text, and its sums of factors."""
        scaled = self.factors[index] * value[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(np.einsum("nf,nf->n", scaled, scaled), starts)
        linear = np.add.reduceat(self.weights[index] * value, starts)
        return self.bias + linear + 0.5 * (np.einsum("nf,nf->n", sums, sums) - squares), sums

    def score(self, texts: list[str | None], n_chars: list[int | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in portions(texts):
            margin, _ = self.margins(*self.rows(*featurize(texts[a:b], n_chars[a:b])))
            out[a:b] = 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -30, 30)))
        return out


def fit_machine(buckets: list[np.ndarray], stats: np.ndarray, labels: np.ndarray, epochs: int = 12, batch: int = 128,
                rate: float = 0.1, l2: float = 1e-5, seed: int = 7) -> Machine:
    """Minibatch AdaGrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    model = Machine(0.0, np.zeros(BUCKETS + STATS, dtype=np.float32),
                    rng.normal(0, 0.05, (BUCKETS + STATS, FACTORS)).astype(np.float32),
                    stats.mean(axis=0) if len(labels) else np.zeros(STATS, dtype=np.float32),
                    np.maximum(stats.std(axis=0), 1e-3) if len(labels) else np.ones(STATS, dtype=np.float32))
    if not len(labels) or not 0 < share < 1:
        model.factors[:] = 0
        model.bias = 0.0 if not len(labels) else (30.0 if share else -30.0)
        return model
    model.bias = float(np.log(share / (1 - share)))
    sum_w, sum_v = np.full_like(model.weights, 1e-6), np.full_like(model.factors, 1e-6)
    sum_b = 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            chosen = order[at:at + batch]
            index, value, starts = model.rows([buckets[i] for i in chosen], stats[chosen])
            margin, sums = model.margins(index, value, starts)
            slope = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)).astype(np.float32)
            lengths = np.diff([*starts, len(index)])
            each = np.repeat(slope, lengths) * value
            used, inverse = np.unique(index, return_inverse=True)
            old = model.factors[index]
            slope_v = each[:, None] * (np.repeat(sums, lengths, axis=0) - old * value[:, None])
            grad_w = np.bincount(inverse, weights=each, minlength=len(used)).astype(np.float32) + l2 * model.weights[used]
            grad_v = np.stack([np.bincount(inverse, weights=slope_v[:, f], minlength=len(used)) for f in range(FACTORS)], axis=1)
            grad_v = grad_v.astype(np.float32) + l2 * model.factors[used]
            sum_w[used] += grad_w ** 2
            sum_v[used] += grad_v ** 2
            model.weights[used] -= rate * grad_w / np.sqrt(sum_w[used])
            model.factors[used] -= 0.3 * rate * grad_v / np.sqrt(sum_v[used])
            slope_b = float(slope.sum())
            sum_b += slope_b ** 2
            model.bias -= 0.3 * rate * slope_b / sum_b ** 0.5
    return model


def fit(docs: DataFrame, labels: DataFrame, learn_from, label: str = "quality", rows: int = FIT_ROWS) -> Machine:
    """A machine fitted on labelled documents whose doc_id satisfies ``learn_from``."""
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
                   .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(learn_from)
                   .groupBy("doc_id").agg(F.min("label").alias("label"))
                   .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = _inputs(docs).join(known, "doc_id").select("doc_id", "text", "n_chars", "label")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        buckets, stats = featurize(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        columns = [batch.column(0), pa.array(buckets, pa.list_(pa.int32())), pa.array(list(stats), pa.list_(pa.float32())), batch.column(3)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "buckets", "stats", "label"])
    fitted = by_batches(texts, "doc_id bigint, buckets array<int>, stats array<float>, label int", run).toPandas()
    fitted = fitted.sort_values("doc_id", kind="stable")
    stats = np.array(fitted["stats"].tolist(), dtype=np.float32).reshape(-1, STATS)
    buckets = [np.sort(np.asarray(b, dtype=np.int32)) for b in fitted["buckets"]]
    return fit_machine(buckets, stats, fitted["label"].to_numpy(dtype=np.float32))


def _inputs(docs: DataFrame) -> DataFrame:
    stated = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), stated.alias("n_chars"))


def with_score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row."""
    spark = docs.sparkSession
    # Plain arrays of fixed size, BUCKETS x (FACTORS + 1) numbers: workers need not have this package.
    shipped = spark.sparkContext.broadcast(dict(vars(machine)))
    stay = [c for c in docs.columns if c != name]
    at, stated = stay.index("text"), stay.index("n_chars") if "n_chars" in stay else None
    rows = docs.select(*stay)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        given = batch.column(stated).cast(pa.int64()).to_pylist() if stated is not None else [None] * batch.num_rows
        scores = Machine(**shipped.value).score(batch.column(at).cast(pa.string()).to_pylist(), given)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*stay, name])
    return by_batches(rows, f"{fields}, `{name}` double", run)

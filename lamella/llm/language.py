"""Language of texts: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; everything but letters counts as a blank. Bigrams and
trigrams of the whole text are hashed into ``BUCKETS``; a feature is its share of
the text's n-grams times its inverse document frequency. Document frequencies
cover every document to learn from. The weights are trained by
follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties, on at
most ``FIT_PER_LANGUAGE`` documents of each language, those with the smallest
hash of their id (a documented bound). A fifth of these is kept out of the
training and sets the temperature of the probabilities.

The share of an n-gram needs no counting: the score of a text is the mean, over
its n-grams, of (inverse document frequency x weight), one table look-up each.

Defined cases: NULL text, or one without a letter, is ``und`` with score 0. If
nothing can be learned, so is every text. Ties go to the language that sorts
first. Repeated rows get equal results; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm.common import by_batches, portions

#: At most so many documents of each language are fitted.
FIT_PER_LANGUAGE = 1_000
#: So many languages are learned at most, the most frequent ones.
MOST_LANGUAGES = 64
BITS = 18
BUCKETS = 1 << BITS
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def ngrams(texts: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For bigrams and for trigrams: the buckets in order of the texts, and their number in each text. Then, whether each
    text has a letter. Each text counts with a blank on either side.
    """
    table = letters()
    joined = [f" {(t or '').lower()} " for t in texts]
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum([len(t) for t in joined])
    is_letter = table[codes]
    found = np.add.reduceat(is_letter, np.concatenate([[0], ends[:-1]]), dtype=np.int64) > 0
    codes = np.where(is_letter, codes, np.uint32(32))
    # Runs of blanks count once.
    blank = codes == 32
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    starts = np.concatenate([[0], ends[:-1]])
    keep[starts] = True
    codes = codes[keep]
    sizes = np.add.reduceat(keep, starts, dtype=np.int64)
    ends = np.cumsum(sizes)
    owner_last = np.zeros(len(codes), dtype=bool)
    owner_last[ends - 1] = True
    two = (codes[:-1] * np.uint32(0x9E3779B1)) ^ (codes[1:] * np.uint32(0x85EBCA77))
    three = (two[:-1] * np.uint32(0xC2B2AE3D)) ^ (codes[2:] * np.uint32(0x27D4EB2F))
    mix = lambda h: ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
    in_two = ~owner_last[:-1]
    in_three = in_two[:-1] & ~owner_last[1:-1]
    return [(mix(two[in_two]).astype(np.int32), np.maximum(sizes - 1, 0)),
            (mix(three[in_three]).astype(np.int32), np.maximum(sizes - 2, 0))], found


@dataclass
class Model:
    """Weights of the n-grams that have any: ``rows`` gives the row of ``table`` for each bucket, row 0 being zero."""

    languages: list[str]
    rows: np.ndarray = field(repr=False)
    table: np.ndarray = field(repr=False)
    bias: np.ndarray
    temperature: float = 1.0

    @classmethod
    def sparse(cls, languages: list[str], weights: np.ndarray, bias: np.ndarray) -> Model:
        used = np.flatnonzero(weights.any(axis=1))
        rows = np.zeros(len(weights), dtype=np.int32)
        rows[used] = np.arange(1, len(used) + 1)
        return cls(languages, rows, np.concatenate([np.zeros((1, len(languages))), weights[used]]).astype(np.float32), bias)

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        parts, found = ngrams(texts)
        out, number = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        for buckets, counts in parts:
            starts, full = np.concatenate([[0], np.cumsum(counts)[:-1]]), counts > 0
            if full.any():
                out[full] += np.add.reduceat(self.table[self.rows[buckets]], starts[full], axis=0, dtype=np.float64)
            number += counts
        return out / np.maximum(number, 1)[:, None] + self.bias, found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        labels, scores = [], np.zeros(len(texts))
        for a, b in portions(texts):
            logits, found = self.logits(texts[a:b])
            chance = softmax(logits / self.temperature)
            best = chance.argmax(axis=1)
            known = found & np.array([t is not None for t in texts[a:b]])
            labels += [self.languages[i] if ok else "und" for i, ok in zip(best, known)]
            scores[a:b] = np.where(known, chance[np.arange(b - a), best], 0.0)
        return labels, scores


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, and the number of documents."""
    def run(batches):
        frequency, flags, rows = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=bool), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rows += len(texts)
            for a, b in portions(texts):
                parts, _ = ngrams(texts[a:b])
                cut = [np.split(buckets, np.cumsum(counts)[:-1]) for buckets, counts in parts]
                for two, three in zip(*cut):
                    if len(two) > 1_000:
                        flags[two] = flags[three] = True
                        here = np.flatnonzero(flags)
                        flags[here] = False
                    else:
                        here = np.unique(np.concatenate([two, three]))
                    frequency[here] += 1
        here = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], here]), pa.int32()),
                                          pa.array(np.concatenate([[rows], frequency[here]]), pa.int64())], names=["bucket", "n"])
    counted = docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counted.toPandas()  # one row per bucket at most
    out = np.zeros(BUCKETS, dtype=np.int64)
    real = rows[rows["bucket"] >= 0]
    out[real["bucket"].to_numpy()] = real["n"].to_numpy()
    return out, int(rows.loc[rows["bucket"] < 0, "n"].sum())


def train(texts: list[str], targets: np.ndarray, languages: list[str], idf: np.ndarray, epochs: int = 3, alpha: float = 1.0,
          beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, scale: float = 100.0) -> Model:
    """FTRL-proximal, one example at a time; every fifth text sets the temperature instead."""
    width = len(languages)
    z, n = np.zeros((BUCKETS + 1, width)), np.zeros((BUCKETS + 1, width))

    def weights(at):
        own = z[at]
        return np.where(np.abs(own) <= l1, 0.0, -(own - np.sign(own) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    examples = []
    for text in texts:
        parts, _ = ngrams([text])
        at, times = np.unique(np.concatenate([buckets for buckets, _ in parts]), return_counts=True)
        examples.append((np.append(at, BUCKETS), np.append(times / max(times.sum(), 1) * idf[at] * scale, 1.0)))
    kept_out = np.arange(len(texts)) % 5 == 4 if len(texts) >= 10 else np.zeros(len(texts), dtype=bool)
    order = np.flatnonzero(~kept_out)
    for _ in range(epochs):
        for i in order:
            at, x = examples[i]
            w = weights(at)
            logits = x @ w
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[targets[i]] -= 1
            slope = x[:, None] * chance[None, :]
            sigma = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / alpha
            z[at] += slope - sigma * w
            n[at] += slope * slope
    w = weights(slice(None))
    model = Model.sparse(languages, w[:BUCKETS] * idf[:, None] * scale, w[BUCKETS])
    held = np.flatnonzero(kept_out)
    if len(held):
        logits = np.concatenate([model.logits([texts[i]])[0] for i in held])
        losses = [(-np.log(np.maximum(softmax(logits / t)[np.arange(len(held)), targets[held]], 1e-12)).mean(), t)
                  for t in np.geomspace(0.25, 8, 41)]
        model.temperature = float(min(losses)[1])
    return model


def fit(docs: DataFrame, learn_from, per_language: int = FIT_PER_LANGUAGE, most_languages: int = MOST_LANGUAGES) -> Model:
    """A model of the documents that satisfy ``learn_from`` and have a language and a text.

    It learns the ``most_languages`` most frequent values of ``lang``, which bounds the sample and the weights.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(learn_from).filter(F.col("lang").isNotNull())
    # Of a language with n documents, the hash lets about 4 x per_language through, so that few are ranked. The limits are
    # part of the plan (one number a language), so the filter comes before any shuffle.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    limits = F.create_map(*[F.lit(x) for r in sizes for x in (r.lang, 4.0 * per_language / r.n)]) if sizes else F.lit(None).cast("map<string,double>")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    few = rows.select("doc_id", "lang", place.alias("place")).filter(F.col("place") < limits[F.col("lang")] * float(1 << 30))
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = few.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_language)
    # The ids sent are at most ``per_language`` numbers a language; repeated ids come back once.
    sample = rows.filter(F.col("text").isNotNull()).join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    found = sample.toPandas().sort_values(["doc_id", "lang"])
    languages = sorted(set(found["lang"]))
    if not languages:
        return Model.sparse([], np.zeros((BUCKETS, 0)), np.zeros(0))
    frequency, number = document_frequencies(rows.filter(F.col("text").isNotNull()))
    idf = np.log((1 + number) / (1 + frequency)) + 1
    # A fixed shuffle mixes the languages.
    found = found.iloc[np.random.default_rng(11).permutation(len(found))]
    targets = found["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy()
    return train(found["text"].tolist(), targets, languages, idf)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    # Plain arrays, so that workers need not have this package: the weights that are not zero, of MOST_LANGUAGES languages at most.
    shipped = docs.sparkSession.sparkContext.broadcast(dict(vars(model)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        own = Model(**shipped.value)
        labels, scores = own.predict(texts) if own.languages else (["und"] * len(texts), np.zeros(len(texts)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                                          names=["doc_id", "lang_pred", "score"])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return by_batches(rows, "doc_id bigint, lang_pred string, score double", run)

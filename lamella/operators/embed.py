"""Encoders, tile classifiers, pooling and zero-shot labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyarrow import dataset
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.functions import rules
from lamella.functions.precision import cast_to
from lamella.session import open_path, scratch_dir

def encode(tiles: DataFrame, make_encoder: Callable[[], Callable[[np.ndarray], np.ndarray]], model: str,
           width: int, batch_size: int = 64, pixels: str = "pixels") -> DataFrame:
    """Add ``features`` by running an encoder over batches of tiles.

    ``make_encoder`` is called once per Python worker and returns a function from
    a [batch, width] array to a [batch, dims] array. The call is marked as not
    deterministic, so that no optimizer rule may copy the inference into a second
    place (an exploded result would otherwise be computed twice).
    """
    run = predict_batch_udf(make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
                            input_tensor_shapes=[[width]]).asNondeterministic()
    return tiles.withColumn("features", run(F.col(pixels))).withColumn("model", F.lit(model))


def projection_encoder(weights: np.ndarray) -> Callable[[], Callable[[np.ndarray], np.ndarray]]:
    """A linear encoder, used in place of a network."""
    def make():
        return lambda batch: np.asarray(batch, dtype=np.float64) @ weights
    return make


def classify(tiles: DataFrame, model: PipelineModel, features: str = "features", positive: int = 1) -> DataFrame:
    """Add ``score``, the fitted classifier's probability of the positive class."""
    vectors = tiles.withColumn("_vector", array_to_vector(F.col(features)))
    scored = model.transform(vectors)
    return scored.withColumn("score", vector_to_array("probability")[positive]).select(*tiles.columns, "score")


def pool(tiles: DataFrame, by: Sequence[str], how: Sequence[str] = ("mean", "max"),
         features: str = "features") -> DataFrame:
    """Mean and max vector per group.

    The vector summary keeps one buffer per group and task, so the shuffle moves
    summaries, not tiles, and no row is taken apart into its dimensions.
    """
    vector = array_to_vector(F.col(features))
    one = tiles.groupBy(*by).agg(Summarizer.metrics(*how, "count").summary(vector).alias("_s"))
    return one.select(*by, *[vector_to_array(f"_s.{h}").alias(f"{h}_features") for h in how],
                      F.col("_s.count").alias("n_tiles"))


def class_prototypes(features: DataFrame, label: str = "class") -> DataFrame:
    """Mean vector per class, used as the class embedding."""
    pooled = pool(features, [label], ("mean",))
    return pooled.select(F.col(label).alias("class"), F.col("mean_features").alias("embedding"))


def zero_shot(tiles: DataFrame, classes: DataFrame, code: str | None = None, temperature: float = 1.0,
              block: int = 4096, rows_at_once: int = 65_536) -> DataFrame:
    """Best class per tile by cosine similarity: adds ``class``, ``similarity`` and softmax ``score``.

    ``classes``: class, embedding and, when ``code`` names a tile column, that
    column too: a tile then competes over the classes of its code only. The class
    table is written once to the shared folder and read block by block, once for
    every ``rows_at_once`` tiles of a task, whatever its size.

    A tile without a vector, with a zero vector, or whose code is NULL or has no
    class, gets NULL in all three columns. Classes without a vector or with a zero
    vector take no part. Ties go to the class that sorts first.
    """
    folder = scratch_dir(tiles.sparkSession, "classes")
    key = F.col(code).cast("string") if code else F.lit("")
    usable = key.isNotNull() & F.exists("embedding", lambda v: v != 0)
    classes.select(key.alias("code"), "class", "embedding").where(usable).write.parquet(folder)
    kind = classes.schema["class"].dataType.simpleString()
    columns = tiles.columns

    def labelled(held: pd.DataFrame) -> pd.DataFrame:
        filesystem, path = open_path(folder)
        vectors = held["features"]
        there = np.array([v is not None and len(v) > 0 and np.any(v) for v in vectors])
        mine = held[code].astype(object) if code else pd.Series("", index=held.index, dtype=object)
        there &= mine.notna().to_numpy()
        out = held[columns].copy()
        name, top, weight = np.full(len(held), None, dtype=object), np.full(len(held), -np.inf), np.zeros(len(held))
        if there.any():
            at_rows = np.flatnonzero(there)
            x = np.stack(vectors.iloc[at_rows].to_list()).astype(np.float64)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            own = mine.iloc[at_rows].astype(str).to_numpy(dtype=object)
            best, total, label = np.full(len(x), -np.inf), np.zeros(len(x)), np.full(len(x), None, dtype=object)
            for part in dataset.dataset(path, filesystem=filesystem, format="parquet").to_batches(batch_size=block):
                if part.num_rows == 0:
                    continue
                names = np.array(part.column("class").to_pylist(), dtype=object)
                order = np.argsort(names, kind="stable")
                names, codes = names[order], np.array(part.column("code").to_pylist(), dtype=object)[order]
                m = np.array(part.column("embedding").to_pylist(), dtype=np.float64)[order]
                m /= np.linalg.norm(m, axis=1, keepdims=True)
                for value in np.unique(codes):
                    rows, cols = np.flatnonzero(own == value), np.flatnonzero(codes == value)
                    if len(rows) == 0:
                        continue
                    similarity = x[rows] @ m[cols].T
                    at = similarity.argmax(1)
                    found, rival = similarity[np.arange(len(rows)), at], names[cols][at]
                    tie = (found == best[rows]) & np.array([n is not None and r < n for r, n in zip(rival, label[rows])])
                    ahead = (found > best[rows]) | tie
                    base = np.maximum(best[rows], found)
                    total[rows] = total[rows] * np.exp((best[rows] - base) / temperature) + np.exp((similarity - base[:, None]) / temperature).sum(1)
                    label[rows], best[rows] = np.where(ahead, rival, label[rows]), base
            name[at_rows], top[at_rows], weight[at_rows] = label, best, total
        known = np.isfinite(top)
        out["class"], out["similarity"] = name, np.where(known, top, np.nan)
        out["score"] = np.where(known, 1 / np.where(weight > 0, weight, 1), np.nan)
        return out

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= rows_at_once:
                yield labelled(pd.concat(held, ignore_index=True))
                held, rows = [], 0
        if rows:
            yield labelled(pd.concat(held, ignore_index=True))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tiles.schema.fields)
    named = tiles.mapInPandas(run, f"{fields}, class {kind}, similarity double, score double")
    return named.withColumns({c: F.when(F.col("class").isNotNull(), F.col(c)) for c in ("similarity", "score")})


def slide_classes(slides: DataFrame, class_map: DataFrame, default: Sequence[str]) -> DataFrame:
    """Slides with their list of class names: those of their code, else the default."""
    lists = class_map.groupBy("oncotree_code").agg(F.sort_array(F.collect_list("class")).alias("_classes"))
    fallback = F.array(*[F.lit(c) for c in default])
    return slides.join(lists, "oncotree_code", "left").withColumn(
        "classes", F.coalesce("_classes", fallback)).drop("_classes")


def tile_index(annotated: DataFrame, classes: Sequence) -> DataFrame:
    """(slide_id, tile_idx) of the tiles of the wanted classes, the index of a tile cache."""
    return annotated.where(F.col("class").isin(*classes)).select("slide_id", "tile_idx")


def precision_variants(features: DataFrame, precisions: Sequence[str]) -> DataFrame:
    """Base rows plus one copy per other precision, its model name suffixed and its values rounded.

    Copies are made by exploding the targets, so the features are read once.
    """
    base = F.col("precision")
    targets = F.array(F.lit(None).cast("string"), *[F.when(base != t, t) for t in precisions])
    variants = F.array_append(F.array_compact(targets), F.lit(None).cast("string"))
    rows = features.withColumn("_target", F.explode(variants))
    changed = F.col("_target").isNotNull()
    return rows.withColumns({
        "features": cast_to(F.col("features"), F.col("_target")),
        "model": F.when(changed, F.concat_ws("_", "model", "_target")).otherwise(F.col("model")),
        "precision": F.coalesce("_target", "precision")}).drop("_target")


def probe_inputs(features: DataFrame, patch_features: DataFrame) -> DataFrame:
    """Tile features for a probe: slide encoders go, the tiles of their patch encoders come in, once each."""
    encoders = F.col("model").isin(*rules.SLIDE_TO_PATCH)
    wanted = (features.where(encoders).select(rules.patch_encoder(F.col("model")).alias("model")).distinct())
    own = features.where(~encoders)
    needed = patch_features.join(wanted, "model", "left_semi").join(own.select("model").distinct(), "model", "left_anti")
    return own.unionByName(needed)

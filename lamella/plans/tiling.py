"""Tile, mask, budget and embedding queries. ``part`` gives slide sizes, ``embeddings`` tile features."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import numeric, precision, rules
from lamella.operators import embed, probe, tiles
from lamella.plans.catalog import Tables, hash_sql, query, text

PATCH, OVERLAP = 64, 16

# Slides as wide as part sizes say; every fifth size has no pixel size of its own.
_GRID_SQL = """
slides AS (
  SELECT p_partkey AS slide_id, p_size * 20 AS width, 400 + p_size * 5 AS height,
         CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size < 25 THEN 0.25 ELSE 0.5 END AS native_mpp FROM part),
scaled AS (
  SELECT *, CAST(round(64 * 0.5 / coalesce(native_mpp, 0.5)) AS BIGINT) AS side, CAST(round(48 * 0.5 / coalesce(native_mpp, 0.5)) AS BIGINT) AS step FROM slides),
xs AS (SELECT slide_id, height, side, step, unnest(generate_series(0, width - side, step)) AS x FROM scaled WHERE width >= side),
grid AS (SELECT slide_id, x, unnest(generate_series(0, height - side, step)) AS y, side FROM xs WHERE height >= side)
"""


def _slides(t: Tables) -> DataFrame:
    none = F.col("p_size") % 5 == 0
    return t.part.select(F.col("p_partkey").alias("slide_id"), (F.col("p_size") * 20).alias("width"), (F.col("p_size") * 5 + 400).alias("height"),
                           F.when(none, None).when(F.col("p_size") < 25, 0.25).otherwise(0.5).alias("native_mpp"))


def _geometry(t: Tables) -> DataFrame:
    return tiles.grid_geometry(_slides(t), PATCH, 0.5, OVERLAP)


def _grid(t: Tables) -> DataFrame:
    return tiles.tile_grid(_slides(t), PATCH, 0.5, OVERLAP)


@query(f"WITH {_GRID_SQL} SELECT slide_id, x, y, side FROM grid")
def tile_grid(t: Tables) -> DataFrame:
    return _grid(t)


# Each slide's mask: a left half of one class and a lower band of another, by part type.
_MASK_SQL = f"""
{_GRID_SQL},
mask AS (
  SELECT p_partkey AS slide_id, 0 AS x0, p_size * 10 AS x1, 0 AS y0, 300 AS y1, CASE p_type WHEN 'PROMO' THEN 4 WHEN 'LARGE' THEN 7 WHEN 'SMALL' THEN 0 ELSE 1 END AS class FROM part
  UNION ALL
  SELECT p_partkey, 0, p_size * 20, 300, 400 + p_size * 5, CASE WHEN p_type = 'LARGE' THEN 4 WHEN p_size < 20 THEN 2 ELSE 3 END FROM part),
classed AS (
  SELECT g.slide_id, g.x, g.y, g.side, class FROM grid g JOIN mask m ON m.slide_id = g.slide_id
   AND g.x + g.side // 2 >= x0 AND g.x + g.side // 2 < x1 AND g.y + g.side // 2 >= y0 AND g.y + g.side // 2 < y1),
shares AS (
  SELECT g.slide_id, g.x, g.y, g.side, class,
         sum(greatest(0, least(g.x + g.side, x1) - greatest(g.x, x0)) * greatest(0, least(g.y + g.side, y1) - greatest(g.y, y0))) / (g.side * g.side) AS share
  FROM grid g JOIN mask m ON m.slide_id = g.slide_id AND g.x < x1 AND g.x + g.side > x0 AND g.y < y1 AND g.y + g.side > y0 GROUP BY g.slide_id, g.x, g.y, g.side, class)
"""


def _mask(t: Tables) -> DataFrame:
    kind, size = F.col("p_type"), F.col("p_size")
    upper = F.when(kind == "PROMO", 4).when(kind == "LARGE", 7).when(kind == "SMALL", 0).otherwise(1)
    lower = F.when(kind == "LARGE", 4).when(size < 20, 2).otherwise(3)
    part = t.part
    top = part.select(F.col("p_partkey").alias("slide_id"), F.lit(0).alias("x0"), (size * 10).alias("x1"), F.lit(0).alias("y0"), F.lit(300).alias("y1"), upper.alias("class"))
    low = part.select(F.col("p_partkey").alias("slide_id"), F.lit(0).alias("x0"), (size * 20).alias("x1"), F.lit(300).alias("y0"), (size * 5 + 400).alias("y1"), lower.alias("class"))
    return top.unionByName(low)


@query(f"WITH {_MASK_SQL} SELECT slide_id, x, y, class FROM classed")
def tile_mask_join(t: Tables) -> DataFrame:
    return tiles.grid_class(_geometry(t), _mask(t)).select("slide_id", "x", "y", "class")


@query(f"WITH {_MASK_SQL} SELECT slide_id, x, y, class, round(share, 6) AS share FROM shares")
def tile_class_shares(t: Tables) -> DataFrame:
    return tiles.grid_class_shares(_geometry(t), _mask(t)).select("slide_id", "x", "y", "class", F.round("share", 6).alias("share"))


@query(f"""
WITH {_MASK_SQL}
SELECT slide_id, x, y, round(sum(share), 6) AS tissue_share FROM shares WHERE class IN (1, 2, 3) GROUP BY 1, 2, 3 HAVING sum(share) >= 0.4""")
def tile_min_tissue(t: Tables) -> DataFrame:
    return tiles.grid_min_tissue(_geometry(t), _mask(t), [1, 2, 3], 0.4).select("slide_id", "x", "y", F.round("tissue_share", 6).alias("tissue_share"))


@query(f"""
WITH {_MASK_SQL}, kept AS (SELECT slide_id, avg(CASE WHEN class IN (4, 7) THEN 0.0 ELSE 1.0 END) AS k FROM classed GROUP BY 1)
SELECT c.slide_id, x, y, class FROM classed c JOIN kept USING (slide_id) WHERE class NOT IN (4, 7) OR k < 0.1""")
def artifact_fallback(t: Tables) -> DataFrame:
    kept = tiles.grid_without_artifacts(_geometry(t), _mask(t), rules.artifact_classes(None, False, True))
    return kept.select("slide_id", "x", "y", "class")


@query(f"""
WITH {_MASK_SQL}
SELECT slide_id, x, y, CASE class WHEN 1 THEN 1 WHEN 4 THEN 0 ELSE 2 END AS annotation FROM classed WHERE class IN (1, 4, 3)""")
def annotated_tiles(t: Tables) -> DataFrame:
    """Raw background dropped, classes remapped, unmapped ones left out."""
    classed = tiles.grid_class(_geometry(t), _mask(t))
    return tiles.annotate(classed, {1: 1, 4: 0, 3: 2}).select("slide_id", "x", "y", "annotation")


# Features: label as sample, a third of it as slide, vec_id as tile ---------------

_TILES_SQL = f"""
t AS (SELECT vec_id, label AS sample_id, CAST(floor(sqrt(vec_id % 50)) AS BIGINT) AS slide_id, {hash_sql('CAST(floor(sqrt(vec_id % 50)) AS BIGINT)', 'vec_id', seed=42)} AS h FROM embeddings),
n AS (SELECT sample_id, slide_id, count(*) AS n FROM t GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id, slide_id ORDER BY h, vec_id) AS rs,
                  row_number() OVER (PARTITION BY sample_id ORDER BY h, slide_id, vec_id) AS ra FROM t)
"""
_BUDGET = 20


def _tiles(t: Tables) -> DataFrame:
    """Several slides of unequal size per sample."""
    return t.embeddings.select(F.col("vec_id").alias("tile_idx"), F.col("label").alias("sample_id"), F.col("embedding").alias("features"),
                               F.floor(F.sqrt(F.col("vec_id") % 50)).cast("bigint").alias("slide_id"))


def _order():
    return tiles.tile_order(F.col("slide_id"), F.col("tile_idx"), 42)


@query(f"WITH {_TILES_SQL} SELECT vec_id AS tile_idx, sample_id FROM ranked WHERE ra <= {_BUDGET}")
def subsample_random(t: Tables) -> DataFrame:
    return tiles.subsample(_tiles(t), _order(), _BUDGET, "random").select("tile_idx", "sample_id")


@query(f"""
WITH {_TILES_SQL},
q AS (SELECT sample_id, slide_id, n, sum(n) OVER (PARTITION BY sample_id) AS total, {_BUDGET} * n // sum(n) OVER (PARTITION BY sample_id) AS base,
             ({_BUDGET} * n) % sum(n) OVER (PARTITION BY sample_id) AS rest FROM n),
q2 AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY rest DESC, slide_id) AS place, {_BUDGET} - sum(base) OVER (PARTITION BY sample_id) AS spare FROM q)
SELECT vec_id AS tile_idx, sample_id FROM ranked JOIN q2 USING (sample_id, slide_id)
WHERE rs <= CASE WHEN total <= {_BUDGET} THEN q2.n WHEN place <= spare THEN base + 1 ELSE base END""")
def subsample_proportional(t: Tables) -> DataFrame:
    return tiles.subsample(_tiles(t), _order(), _BUDGET, "proportional").select("tile_idx", "sample_id")


@query(f"""
WITH {_TILES_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n, slide_id) - 1 AS i, count(*) OVER (PARTITION BY sample_id) AS k,
             coalesce(sum(n) OVER (PARTITION BY sample_id ORDER BY n, slide_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM n),
f AS (SELECT *, n * (k - i) <= {_BUDGET} - used AS full_ FROM o),
lv AS (SELECT sample_id, min(i) AS i0, arg_min({_BUDGET} - used, i) AS left_, arg_min(k - i, i) AS others FROM f WHERE NOT full_ GROUP BY 1),
q AS (SELECT f.sample_id, slide_id, CASE WHEN full_ THEN n ELSE left_ // others + CASE WHEN i - i0 < left_ % others THEN 1 ELSE 0 END END AS quota FROM f LEFT JOIN lv USING (sample_id))
SELECT vec_id AS tile_idx, sample_id FROM ranked JOIN q USING (sample_id, slide_id) WHERE rs <= quota""")
def subsample_equal(t: Tables) -> DataFrame:
    return tiles.subsample(_tiles(t), _order(), _BUDGET, "equal").select("tile_idx", "sample_id")


@query(f"""
WITH s AS (SELECT vec_id, label AS slide_id, {hash_sql('label', 'vec_id', seed=42)} AS h FROM embeddings)
SELECT vec_id AS tile_idx, slide_id FROM (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY h, vec_id) AS r FROM s) WHERE r <= 30""")
def patch_cap(t: Tables) -> DataFrame:
    rows = t.embeddings.select(F.col("vec_id").alias("tile_idx"), F.col("label").alias("slide_id"))
    return tiles.cap_per_slide(rows, _order(), 30)


@query(f"""
WITH {_TILES_SQL}
SELECT sample_id, 'code' || min(slide_id) OVER (PARTITION BY sample_id) AS oncotree_code, slide_id,
       row_number() OVER (PARTITION BY sample_id ORDER BY slide_id, vec_id) - 1 AS tile_idx
FROM t""")
def sample_merge(t: Tables) -> DataFrame:
    """Slides of a sample concatenated, tiles numbered anew, code of the first slide."""
    rows = _tiles(t).withColumn("key", F.col("slide_id") + F.col("sample_id") * 1000)
    slides = rows.groupBy("sample_id", "key").agg(F.concat(F.lit("code"), F.min("slide_id")).alias("oncotree_code")).withColumnRenamed("key", "slide_id")
    features = rows.select(F.col("key").alias("slide_id"), "tile_idx", "features")
    merged = tiles.merge_samples(features, slides, _order())
    return merged.select("sample_id", "oncotree_code", (F.col("slide_id") % 1000).alias("slide_id"), F.col("tile_idx").cast("bigint").alias("tile_idx"))


@query("""
WITH v AS (SELECT label AS slide_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT slide_id, CAST(dim AS INTEGER) AS dim, round(avg(v::DOUBLE), 6) AS mean, round(max(v::DOUBLE), 6) AS max FROM v GROUP BY 1, 2""")
def pool_mean_max(t: Tables) -> DataFrame:
    pooled = embed.pool(t.embeddings.select(F.col("label").alias("slide_id"), F.col("embedding").alias("features")), ["slide_id"])
    both = F.posexplode(F.arrays_zip("mean_features", "max_features")).alias("dim", "v")
    return pooled.select("slide_id", both).select("slide_id", "dim", F.round("v.mean_features", 6).alias("mean"), F.round("v.max_features", 6).alias("max"))


_PROTOTYPES_SQL = """
v AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
proto AS (SELECT label AS class, dim, avg(v) AS p FROM v GROUP BY 1, 2)
"""


def _prototypes(t: Tables) -> DataFrame:
    return embed.class_prototypes(t.embeddings.select(F.col("label").alias("class"), F.col("embedding").alias("features")))


@query(f"WITH {_PROTOTYPES_SQL} SELECT class, round(sum(p), 6) AS total, round(sqrt(sum(p * p)), 6) AS norm FROM proto GROUP BY 1")
def class_prototypes(t: Tables) -> DataFrame:
    p = F.col("embedding")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    squares = F.aggregate(p, F.lit(0.0), lambda a, x: a + x * x)
    return _prototypes(t).select("class", F.round(total, 6).alias("total"), F.round(F.sqrt(squares), 6).alias("norm"))


_ZERO_SHOT_SQL = f"""
{_PROTOTYPES_SQL},
sims AS (SELECT vec_id, class, sum(v * p) / (sqrt(sum(v * v)) * sqrt(sum(p * p))) AS s FROM v JOIN proto USING (dim) GROUP BY 1, 2),
best AS (SELECT vec_id, arg_max(class, s) AS class, max(s) AS similarity FROM sims GROUP BY 1)
"""


@query(f"""
WITH {_ZERO_SHOT_SQL}
SELECT b.vec_id AS tile_idx, b.class, round(similarity, 6) AS similarity, round(1 / sum(exp(s - similarity)), 6) AS score
FROM best b JOIN sims USING (vec_id) GROUP BY ALL""")
def zero_shot_label(t: Tables) -> DataFrame:
    rows = t.embeddings.select(F.col("vec_id").alias("tile_idx"), F.col("embedding").alias("features"))
    named = embed.zero_shot(rows, _prototypes(t))
    return named.select("tile_idx", "class", F.round("similarity", 6).alias("similarity"), F.round("score", 6).alias("score"))


@query(f"""
WITH {_ZERO_SHOT_SQL}
SELECT label AS slide_id, vec_id AS tile_idx FROM best JOIN embeddings USING (vec_id) WHERE class IN (1, 3, 5)""")
def tile_class_index(t: Tables) -> DataFrame:
    """Per slide the numbers of its tiles of the wanted classes."""
    rows = t.embeddings.select(F.col("vec_id").alias("tile_idx"), F.col("label").alias("slide_id"), F.col("embedding").alias("features"))
    return embed.tile_index(embed.zero_shot(rows, _prototypes(t)), [1, 3, 5])


_WEIGHTS = np.array([[((i * 31 + j * 17) % 7 - 3) / 7 for j in range(4)] for i in range(64)])


@query("""
WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT vec_id AS tile_idx, j AS dim, round(sum(v * ((i * 31 + j * 17) % 7 - 3) / 7.0), 4) AS value FROM v, (SELECT unnest([0, 1, 2, 3]) AS j) GROUP BY 1, 2""")
def encode_tiles(t: Tables) -> DataFrame:
    """Batched inference with a fixed projection in place of a network."""
    rows = t.embeddings.select(F.col("vec_id").alias("tile_idx"), F.col("embedding").alias("pixels"))
    encoded = embed.encode(rows, embed.projection_encoder(_WEIGHTS), "projection", len(_WEIGHTS))
    return encoded.select("tile_idx", F.posexplode("features").alias("dim", "value")).select(
        "tile_idx", "dim", F.round(F.col("value").cast("double"), 4).alias("value"))


@query("""
WITH v AS (SELECT vec_id AS tile_idx, unnest(embedding)::DOUBLE AS v FROM embeddings),
e AS (SELECT tile_idx, v, CASE WHEN v = 0 THEN 0 ELSE floor(log2(abs(v))) END AS e FROM v),
p AS (SELECT tile_idx, v, precision, CASE precision WHEN 'float16' THEN pow(2, greatest(e, -14) - 10) ELSE pow(2, e - 7) END AS step
      FROM e, (SELECT unnest(['float32', 'float16', 'bfloat16']) AS precision))
SELECT tile_idx, CASE precision WHEN 'float32' THEN 'm' ELSE 'm_' || precision END AS model, precision,
       round(sum(CASE precision WHEN 'float32' THEN v ELSE round_even(v / step, 0) * step END), 6) AS total FROM p GROUP BY 1, 2, 3""")
def cast_half(t: Tables) -> DataFrame:
    """Every vector after a round trip through each storage precision, with the error it makes."""
    rows = t.embeddings.select(F.col("vec_id").alias("tile_idx"), F.lit("m").alias("model"), F.col("embedding").alias("features"), F.lit("float32").alias("precision"))
    variants = embed.precision_variants(rows, ["float16", "bfloat16"])
    total = F.aggregate(F.transform("features", lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    return variants.select("tile_idx", "model", "precision", F.round(total, 6).alias("total"))


@query("""
WITH v AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT vec_id AS tile_idx, CAST(dim AS INTEGER) AS dim,
       CAST(CASE WHEN v = 0 THEN 0 ELSE (CASE WHEN v < 0 THEN 32768 ELSE 0 END)
         + (floor(log2(abs(v::DOUBLE))) + 127) * 128 + round_even(abs(v::DOUBLE) / pow(2, floor(log2(abs(v::DOUBLE)))) * 128, 0) - 128 END AS INTEGER) AS bits FROM v""")
def bfloat16_bits(t: Tables) -> DataFrame:
    """Raw bfloat16 bits of every value."""
    rows = t.embeddings.select(F.col("vec_id").alias("tile_idx"), F.posexplode(precision.bfloat16_encode(F.col("embedding"))).alias("dim", "bits"))
    return rows.select("tile_idx", "dim", "bits")


@query(f"""
WITH s AS (SELECT doc_id, quality AS label, {hash_sql('doc_id', seed=7)} AS h FROM labels),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, doc_id) AS rn, count(*) OVER (PARTITION BY label) AS n FROM s)
SELECT doc_id AS slide_id, CASE WHEN rn <= round(n * 0.2) THEN 'test' WHEN rn <= round(n * 0.2) + round(n * 0.1) THEN 'val' ELSE 'train' END AS split FROM r""")
def stratified_split(t: Tables) -> DataFrame:
    rows = t.labels.select(F.col("doc_id").alias("slide_id"), F.col("quality").alias("label"))
    return probe.stratified_split(rows, numeric.portable_hash(F.col("slide_id"), seed=7)).select("slide_id", "split")

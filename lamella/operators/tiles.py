"""Tile grids, masks, tile filters and tile budgets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions import numeric
from lamella.operators.ordered import first_per_key, with_row_number, with_running_totals

HASH_RANGE = 4294967296
HASH_CHUNKS = 256


def grid_geometry(slides: DataFrame, patch_size: int, mpp: float = 0.5, overlap: int = 0) -> DataFrame:
    """One row per slide (width, height, native_mpp): side and step of its tiles, and how many columns and rows there are.

    A tile covers ``patch_size`` pixels at ``mpp``; on a slide with another native
    pixel size that is ``patch_size * mpp / native`` of its own pixels. Only whole
    tiles are kept.
    """
    scale = F.lit(mpp) / F.coalesce(F.col("native_mpp"), F.lit(numeric.FALLBACK_MPP))
    side = F.greatest(F.lit(1), F.round(F.lit(patch_size) * scale)).cast("bigint")
    step = F.greatest(F.lit(1), F.round(F.lit(patch_size - overlap) * scale)).cast("bigint")

    def places(extent: str) -> Column:
        room = F.col(extent).cast("bigint") - F.col("side")
        return F.when(room >= 0, F.floor(room / F.col("step")) + 1).otherwise(F.lit(0)).cast("bigint")

    return (slides.withColumns({"side": side, "step": step}).withColumns({"nx": places("width"), "ny": places("height")})
            .select("slide_id", "side", "step", "nx", "ny"))


def _span(first: Column, last: Column) -> Column:
    """The whole numbers from ``first`` to ``last``; none if there are none."""
    return F.explode(F.when(first <= last, F.sequence(first, last)))


def tile_grid(slides: DataFrame, patch_size: int, mpp: float = 0.5, overlap: int = 0) -> DataFrame:
    """Tile corners of each slide at the wanted pixel size (see ``grid_geometry``)."""
    zero = F.lit(0).cast("bigint")
    return (grid_geometry(slides, patch_size, mpp, overlap)
            .withColumn("i", _span(zero, F.col("nx") - 1)).withColumn("j", _span(zero, F.col("ny") - 1))
            .select("slide_id", (F.col("i") * F.col("step")).alias("x"), (F.col("j") * F.col("step")).alias("y"), "side"))


#: Tiles per side of a block of the grid.
GRID_BLOCK = 16


def _centred(geometry: DataFrame, mask: DataFrame) -> DataFrame:
    """Mask rectangles with ``i0``, ``i1``, ``j0``, ``j1``: the columns and rows of the grid's tiles whose centre they hold."""
    half = F.floor(F.col("side") / 2)

    def first(start: str) -> Column:
        return F.greatest(F.lit(0), F.ceil((F.col(start) - half) / F.col("step"))).cast("bigint")

    def last(end: str, count: str) -> Column:
        return F.least(F.col(count) - 1, F.floor((F.col(end) - 1 - half) / F.col("step"))).cast("bigint")

    return mask.join(geometry, "slide_id").select("slide_id", "side", "step", "class", first("x0").alias("i0"), last("x1", "nx").alias("i1"),
                                                  first("y0").alias("j0"), last("y1", "ny").alias("j1"))


def _centred_tiles(centred: DataFrame) -> DataFrame:
    return (centred.withColumn("i", _span(F.col("i0"), F.col("i1"))).withColumn("j", _span(F.col("j0"), F.col("j1")))
            .select("slide_id", (F.col("i") * F.col("step")).alias("x"), (F.col("j") * F.col("step")).alias("y"), "side", "class"))


def grid_class(geometry: DataFrame, mask: DataFrame) -> DataFrame:
    """slide_id, x, y, side and class of the grid's tiles whose centre lies in a mask rectangle.

    Slides meet rectangles, and the tiles of a rectangle follow by arithmetic after the join: no tile is shuffled.
    """
    return _centred_tiles(_centred(geometry, mask))


def grid_without_artifacts(geometry: DataFrame, mask: DataFrame, excluded: Sequence[int], max_loss: float = 0.9) -> DataFrame:
    """``remove_artifacts`` of ``grid_class``. A rectangle knows its number of tiles, so slides are judged and rectangles dropped
    before there are tiles."""
    centred = _centred(geometry, mask).where((F.col("i0") <= F.col("i1")) & (F.col("j0") <= F.col("j1")))
    kept, fallback = _clean(excluded), F.col("_kept") < _least_kept(max_loss)
    number = (F.col("i1") - F.col("i0") + 1) * (F.col("j1") - F.col("j0") + 1)
    shares = centred.groupBy("slide_id").agg((F.sum(F.when(kept, number).otherwise(F.lit(0))) / F.sum(number)).alias("_kept"))
    return _centred_tiles(centred.join(shares, "slide_id").where(kept | fallback))


#: So many rectangles of a block are measured by plain arithmetic; the rest of a longer list by a fold.
PLAIN = 3


def grid_cover(geometry: DataFrame, mask: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """slide_id, x, y, side, the columns ``by`` and ``covered``, the pixels of a tile under rectangles, for the grid's tiles that have some.

    Rectangles are gathered per block of ``GRID_BLOCK`` by ``GRID_BLOCK`` tiles (and value of ``by``), with all that reach into one
    of its tiles; disjoint rectangles are bounded by the area of a block. The tiles come after that, and each is measured against
    its block's list, so none is shuffled or kept.
    """
    def block(place: Column) -> Column:
        return F.floor(place / GRID_BLOCK).cast("bigint")

    def reach(start: str, end: str, count: str) -> Column:
        touched = F.greatest(F.lit(0), F.floor((F.col(start) - F.col("side")) / F.col("step")) + 1).cast("bigint")
        until = F.least(F.col(count) - 1, F.floor((F.col(end) - 1) / F.col("step"))).cast("bigint")
        return F.explode(F.when(touched <= until, F.sequence(block(touched), block(until))))

    solid = mask.where((F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))).join(geometry, "slide_id")
    blocks = (solid.withColumn("bi", reach("x0", "x1", "nx")).withColumn("bj", reach("y0", "y1", "ny"))
              .groupBy("slide_id", "bi", "bj", "side", "step", "nx", "ny", *by)
              .agg(F.collect_list(F.struct("x0", "x1", "y0", "y1")).alias("rects")))

    def inside(number: str, count: str) -> Column:
        start = F.col(number) * GRID_BLOCK
        return _span(start, F.least(start + GRID_BLOCK, F.col(count)) - 1)

    x, y = F.col("i") * F.col("step"), F.col("j") * F.col("step")

    def overlap(rect: Column) -> Column:
        wide = F.least(x + F.col("side"), rect["x1"]) - F.greatest(x, rect["x0"])
        high = F.least(y + F.col("side"), rect["y1"]) - F.greatest(y, rect["y0"])
        return F.when((wide > 0) & (high > 0), wide * high).otherwise(F.lit(0)).cast("bigint")

    none = F.lit(0).cast("bigint")
    plain = [F.when(F.size("rects") > k, overlap(F.get("rects", F.lit(k)))).otherwise(none) for k in range(PLAIN)]
    rest = F.aggregate(F.slice("rects", PLAIN + 1, F.size("rects")), none, lambda total, r: total + overlap(r))
    covered = sum(plain[1:], plain[0]) + F.when(F.size("rects") > PLAIN, rest).otherwise(none)
    return (blocks.withColumn("i", inside("bi", "nx")).withColumn("j", inside("bj", "ny"))
            .select("slide_id", x.alias("x"), y.alias("y"), "side", *by, covered.alias("covered")).where(F.col("covered") > 0))


def _share() -> Column:
    return F.col("covered") / (F.col("side") * F.col("side"))


def grid_class_shares(geometry: DataFrame, mask: DataFrame) -> DataFrame:
    """``class_shares`` of all tiles of the grid."""
    return grid_cover(geometry, mask, ["class"]).select("slide_id", "x", "y", "side", "class", _share().alias("share"))


def grid_min_tissue(geometry: DataFrame, mask: DataFrame, tissue_classes: Sequence[int], minimum: float) -> DataFrame:
    """``min_tissue`` of all tiles of the grid."""
    tissue = mask.where(F.col("class").isin(*tissue_classes))
    return (grid_cover(geometry, tissue).select("slide_id", "x", "y", "side", _share().alias("tissue_share"))
            .where(F.col("tissue_share") >= minimum))


def _mask_cells(mask: DataFrame, block: int) -> DataFrame:
    """Mask rectangles (slide_id, x0, x1, y0, y1, class; ends exclusive) listed under each block they touch."""
    return (mask.withColumn("bx", F.explode(F.sequence(F.floor(F.col("x0") / block), F.floor((F.col("x1") - 1) / block))))
            .withColumn("by", F.explode(F.sequence(F.floor(F.col("y0") / block), F.floor((F.col("y1") - 1) / block)))))


def tile_class(tiles: DataFrame, mask: DataFrame, block: int) -> DataFrame:
    """Tiles whose centre lies in a mask rectangle, with its class.

    Both sides meet on (slide, block), so even a single huge slide is spread.
    Size estimates know nothing of exploded rows, and a grid that looks small may
    be billions of tiles: the merge hint rules out a broadcast on such an estimate.
    """
    centred = tiles.withColumns({"cx": F.col("x") + F.floor(F.col("side") / 2), "cy": F.col("y") + F.floor(F.col("side") / 2)})
    keyed = centred.withColumns({"bx": F.floor(F.col("cx") / block), "by": F.floor(F.col("cy") / block)})
    joined = keyed.hint("merge").join(_mask_cells(mask, block), ["slide_id", "bx", "by"])
    inside = ((F.col("cx") >= F.col("x0")) & (F.col("cx") < F.col("x1"))
              & (F.col("cy") >= F.col("y0")) & (F.col("cy") < F.col("y1")))
    return joined.where(inside).select(*tiles.columns, "class")


def class_shares(tiles: DataFrame, mask: DataFrame, block: int) -> DataFrame:
    """Share of each tile's area that every mask class covers.

    A tile and a rectangle may meet in several blocks. Each block adds only the
    part of the overlap inside it, so nothing is counted twice.
    """
    x_end, y_end = F.col("x") + F.col("side"), F.col("y") + F.col("side")
    cells = (tiles.withColumn("bx", F.explode(F.sequence(F.floor(F.col("x") / block), F.floor((x_end - 1) / block))))
             .withColumn("by", F.explode(F.sequence(F.floor(F.col("y") / block), F.floor((y_end - 1) / block)))))
    joined = cells.hint("merge").join(_mask_cells(mask, block), ["slide_id", "bx", "by"])

    def overlap(lo: Column, hi: Column, r0: str, r1: str, b: str) -> Column:
        left = F.greatest(lo, F.col(r0), F.col(b) * block)
        right = F.least(hi, F.col(r1), (F.col(b) + 1) * block)
        return F.greatest(F.lit(0).cast("bigint"), (right - left).cast("bigint"))

    area = overlap(F.col("x"), x_end, "x0", "x1", "bx") * overlap(F.col("y"), y_end, "y0", "y1", "by")
    return (joined.withColumn("_area", area).where(F.col("_area") > 0)
            .groupBy("slide_id", "x", "y", "side", "class")
            .agg((F.sum("_area") / (F.col("side") * F.col("side"))).alias("share")))


def min_tissue(shares: DataFrame, tissue_classes: Sequence[int], minimum: float) -> DataFrame:
    """Tiles whose tissue classes together cover at least ``minimum`` of them."""
    return (shares.where(F.col("class").isin(*tissue_classes)).groupBy("slide_id", "x", "y", "side")
            .agg(F.sum("share").alias("tissue_share")).where(F.col("tissue_share") >= minimum))


def score_filter(scored: DataFrame, threshold: float = 0.75, score: str = "score") -> DataFrame:
    return scored.where(F.col(score) >= threshold)


def _clean(excluded: Sequence[int]) -> Column:
    """Whether a tile's class is none of the excluded ones; true for a missing class."""
    return F.coalesce(~F.col("class").isin(*excluded) if excluded else F.lit(True), F.lit(True))


def _least_kept(max_loss: float) -> Column:
    return F.lit(1 - max_loss) - 1e-12


def remove_artifacts(tiles: DataFrame, excluded: Sequence[int], max_loss: float = 0.9) -> DataFrame:
    """Drop tiles of excluded classes, except on slides that would lose more than ``max_loss`` of them.

    Counts are an aggregate joined back, so a hot slide needs no single-task window.
    """
    kept = _clean(excluded)
    shares = tiles.groupBy("slide_id").agg(F.avg(kept.cast("double")).alias("_kept"))
    fallback = F.col("_kept") < _least_kept(max_loss)
    return tiles.join(shares, "slide_id", "left").where(kept | fallback).select(*tiles.columns)


def annotate(classed: DataFrame, mapping: Mapping[int, int] | DataFrame | None = None) -> DataFrame:
    """Drop raw background (0), then remap; unmapped classes go when a mapping is given.

    The mapping is a dict or a frame (raw, mapped) as ``class_mapping_scan`` reads it.
    """
    rows = classed.where(F.col("class") != 0)
    if mapping is None:
        return rows.withColumn("annotation", F.col("class"))
    if isinstance(mapping, DataFrame):
        pairs = mapping.select(F.col("raw").alias("class"), F.col("mapped").alias("annotation"))
        return rows.join(pairs, "class").select(*rows.columns, "annotation")
    table = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return rows.withColumn("annotation", table[F.col("class")]).where(F.col("annotation").isNotNull())


def annotated_features(features: DataFrame, tiles: DataFrame, mask: DataFrame, block: int,
                       mapping: Mapping[int, int] | None = None, min_share: float = 0.0) -> DataFrame:
    """Feature rows with the class of their tile; tiles with too little annotated area are dropped.

    ``tiles`` carry tile_idx; geometry is resolved first, and features join last.
    """
    classed = annotate(tile_class(tiles, mask, block), mapping)
    if min_share > 0:
        annotated = mask.where(F.col("class") != 0)
        covered = (class_shares(tiles.select("slide_id", "x", "y", "side"), annotated, block)
                   .groupBy("slide_id", "x", "y").agg(F.sum("share").alias("_share"))
                   .where(F.col("_share") >= min_share))
        classed = classed.join(covered.select("slide_id", "x", "y"), ["slide_id", "x", "y"], "left_semi")
    return features.join(classed.select("slide_id", "tile_idx", "annotation").hint("merge"), ["slide_id", "tile_idx"])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of the frames, exact duplicates once."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.distinct()


# Budgets --------------------------------------------------------------------

def tile_order(slide_key: Column, tile_key: Column, seed: int = 42) -> Column:
    """Seeded random order of tiles that does not depend on partitioning."""
    return numeric.portable_hash(slide_key, tile_key, seed=seed)


def _first_in_order(tiles: DataFrame, by: Sequence[str], order: Column, tie: Sequence[str], budget: int | DataFrame) -> DataFrame:
    """The first tiles of each group by hash, as many as the budget (a number, or ``quota`` per group).

    Only keys are ranked; the top bits of the hash are the chunks. The last key
    within the budget is the group's cut, and the tiles with their payload pass a
    plain filter. Tiles that repeat a key stay or go together.
    """
    names = list(dict.fromkeys([*by, *tie]))
    keys = tiles.select(*names, order.alias("_h")).distinct()
    chunk = F.floor(F.col("_h") / (HASH_RANGE // HASH_CHUNKS)).cast("int")
    ranked = with_row_number(keys, by, ["_h", *tie], "_rank", chunk)
    if isinstance(budget, DataFrame):
        kept = ranked.join(budget, list(by)).where(F.col("_rank") <= F.col("quota"))
    else:
        kept = ranked.where(F.col("_rank") <= budget)
    cuts = kept.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.max(F.struct("_h", *tie)).alias("_cut"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    within = tiles.withColumn("_h", order).join(cuts, same).where(F.struct("_h", *tie) <= F.col("_cut"))
    return within.select(*tiles.columns)


def cap_per_slide(tiles: DataFrame, order: Column, cap: int, slide: str = "slide_id",
                  tile: str = "tile_idx") -> DataFrame:
    """At most ``cap`` tiles per slide, the first in random order."""
    return _first_in_order(tiles, [slide], order, [tile], cap)


def subsample_random(tiles: DataFrame, order: Column, budget: int, sample: str = "sample_id",
                     slide: str = "slide_id", tile: str = "tile_idx") -> DataFrame:
    """At most ``budget`` tiles per sample, the first in random order."""
    return _first_in_order(tiles, [sample], order, [slide, tile], budget)


def proportional_quota(counts: DataFrame, budget: int, sample: str = "sample_id", slide: str = "slide_id") -> DataFrame:
    """Quota per slide in proportion to its tiles, rounded by largest remainder."""
    totals = counts.groupBy(sample).agg(F.sum("n").alias("_total"),)
    shares = counts.join(totals, sample).withColumns({
        "_floor": F.floor(F.lit(budget) * F.col("n") / F.col("_total")).cast("bigint"),
        "_rest": (F.lit(budget) * F.col("n")) % F.col("_total")})
    left = shares.groupBy(sample).agg((F.lit(budget) - F.sum("_floor")).alias("_left"))
    placed = with_row_number(shares, [sample], [F.col("_rest").desc(), F.col(slide)], "_place").join(left, sample)
    extra = F.when(F.col("_place") <= F.col("_left"), 1).otherwise(0)
    quota = F.when(F.col("_total") <= budget, F.col("n")).otherwise(F.col("_floor") + extra)
    return placed.select(sample, slide, quota.alias("quota"))


def equal_quota(counts: DataFrame, budget: int, sample: str = "sample_id", slide: str = "slide_id") -> DataFrame:
    """Equal quota per slide; what a small slide cannot use goes to the others.

    Along rising tile counts a slide gets all its tiles as long as they fit an
    equal share of what is left. From the first that does not, all get the same
    level, and the first few one more.
    """
    run = with_running_totals(counts, [sample], ["n", slide], {"_used": "n", "_i": F.lit(1).cast("bigint")})
    run = run.join(counts.groupBy(sample).agg(F.count("*").alias("_k")), sample)
    left, others = F.lit(budget) - F.col("_used"), F.col("_k") - F.col("_i")
    run = run.withColumns({"_left": left, "_others": others}).withColumn(
        "_full", F.col("n") * F.col("_others") <= F.col("_left"))
    level = (run.where(~F.col("_full")).groupBy(sample)
             .agg(F.min(F.struct("_i", "_left", "_others")).alias("_lv")))
    placed = run.join(level, sample, "left")
    base = F.floor(F.col("_lv._left") / F.col("_lv._others")).cast("bigint")
    spare = F.col("_lv._left") - base * F.col("_lv._others")
    leveled = base + F.when(F.col("_i") - F.col("_lv._i") < spare, 1).otherwise(0)
    return placed.select(sample, slide, F.when(F.col("_full"), F.col("n")).otherwise(leveled).alias("quota"))


def subsample_by_quota(tiles: DataFrame, order: Column, quota: DataFrame, sample: str = "sample_id",
                       slide: str = "slide_id", tile: str = "tile_idx") -> DataFrame:
    """The first ``quota`` tiles of each slide in random order."""
    return _first_in_order(tiles, [sample, slide], order, [tile], quota)


def subsample(tiles: DataFrame, order: Column, budget: int | None, strategy: str = "random",
              sample: str = "sample_id", slide: str = "slide_id", tile: str = "tile_idx") -> DataFrame:
    """Tiles within the budget of their sample by 'random', 'proportional' or 'equal' strategy."""
    if budget is None:
        return tiles
    if strategy == "random":
        return subsample_random(tiles, order, budget, sample, slide, tile)
    counts = tiles.groupBy(sample, slide).agg(F.count("*").alias("n"))
    quotas = {"proportional": proportional_quota, "equal": equal_quota}
    if strategy not in quotas:
        raise ValueError(f"unknown strategy {strategy!r}")
    return subsample_by_quota(tiles, order, quotas[strategy](counts, budget, sample, slide), sample, slide, tile)


def merge_samples(features: DataFrame, slides: DataFrame, order: Column, budget: int | None = None,
                  strategy: str = "random") -> DataFrame:
    """One feature table per sample: slides concatenated, cut to the budget, tiles numbered anew.

    ``slides``: slide_id, sample_id, oncotree_code; the sample takes the code of
    its first slide. Only keys are cut and numbered; the vectors join the result once.
    """
    codes = first_per_key(slides.select("sample_id", "slide_id", "oncotree_code"), ["sample_id"], [F.col("slide_id")])
    keys = features.select("slide_id", "tile_idx").join(slides.select("slide_id", "sample_id"), "slide_id")
    kept = subsample(keys, order, budget, strategy)
    numbered = with_row_number(kept, ["sample_id"], ["slide_id", "tile_idx"], "_n")
    return (features.join(numbered.join(codes.select("sample_id", "oncotree_code"), "sample_id"), ["slide_id", "tile_idx"])
            .select("sample_id", "oncotree_code", (F.col("_n") - 1).cast("int").alias("tile_idx"),
                    "slide_id", "features"))

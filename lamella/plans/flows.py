"""End-to-end jobs put together from the operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella import schemas
from lamella.operators import resolve, sharding, state, status
from lamella.plans.catalog import Tables, query
from lamella.plans.records import MODELS, _slides, _status
from lamella.session import scratch_dir, stable
from lamella.sinks.tables import index_sink, merge_sink, shard_sink
from lamella.sources import files, shards


@dataclass
class Intake:
    """One poll: the status of the inventory, what is still to do and where it can be read."""

    status: DataFrame
    samples: DataFrame
    next_state: DataFrame


def poll_inventory(inventory: DataFrame, slides: DataFrame, models: Sequence[str], results: DataFrame, shards: DataFrame,
                   failures: DataFrame, mpp: DataFrame, now: Column, filters: dict | None = None, paths: dict | None = None,
                   max_retries: int = 0) -> Intake:
    """Inventory to status, to pending samples, to the next slide state, as one lazy program.

    Ready slides that are known but still wanted have lost their outputs and are
    queued again. Slides without a readable file are queued for download where
    the cross-path rules allow it; their stale object-store rows go.
    """
    current = status.build_status(inventory, models, results, shards, failures, mpp, now)
    done = resolve.done_slides(current, models, "all")
    samples = resolve.resolve_paths(resolve.pending(inventory, done, **(filters or {})), **(paths or {}))
    ready = samples.where(~F.col("needs_download")).select("slide_path", "slide_id")
    wanted = samples.where("needs_download")
    admitted = resolve.admit_downloads(wanted, slides, max_retries).select("slide_path", "slide_id", "file_id", "file_name", "needs_download")
    cleaned = state.drop_stale_remote(state.requeue_lost(slides, ready), admitted)
    arrivals = ready.unionByName(admitted, allowMissingColumns=True)
    return Intake(current, samples, state.insert_new(cleaned, arrivals, now))


@dataclass
class Appended:
    """Result of publishing a batch: the new index, manifest entries and the fate of every file."""

    index: DataFrame
    entries: DataFrame
    planned: DataFrame


def append_shards(features: DataFrame, found: DataFrame, index: DataFrame, routing: DataFrame, meta: DataFrame, existing: DataFrame,
                  model: str, dest: str, cap: int = sharding.DEFAULT_MAX_BYTES, batch: DataFrame | None = None,
                  failed: DataFrame | None = None, dry_run: bool = False, continue_open: bool = False) -> Appended:
    """Pack the new slides of a model into shards below ``dest`` and extend the index.

    ``found``: slide_id, bytes; ``existing``: project_id, shard_file, length. A full
    shard is never rewritten: packing starts at the next free number. With
    ``continue_open`` the last shard of a group is continued while it is below the cap: its
    members and the new ones go into a file of the next revision, the index names that one, and
    the slides that moved get new entries, too. The old file stays, so that readers of the
    index before are not disturbed (``sharding.superseded`` lists it).
    """
    pruned = sharding.prune_index(index, failed, batch) if failed is not None else index
    planned = sharding.plan_append(found, pruned, routing, model, batch, failed)
    fresh = planned.where(F.col("fate") == "append").select("slide_id", "bytes", "project_id")
    if continue_open:
        opened = sharding.open_shard(existing, ["project_id"], cap)
    else:
        opened = sharding.next_shard(existing, ["project_id"]).withColumns({"filled": F.lit(None).cast("double"), "base_file": F.lit(None).cast("string")})
    assigned = sharding.assign_by_bytes(fresh, ["project_id"], ["slide_id"], "bytes", cap, opened)
    assigned = stable(sharding.continue_shards(assigned, opened, ["project_id"]))
    if not dry_run:
        shard_sink(features, assigned.select(F.lit(model).alias("model"), F.col("project_id").alias("group"), "slide_id", "shard_file"), dest)
    grown = sharding.extend_index(sharding.follow_continued(pruned, assigned, model), assigned, model, meta)
    rewritten = assigned.where(sharding.shard_revision(F.col("shard_file")) > 0).select(F.concat_ws("/", "project_id", "shard_file").alias("shard_file")).distinct()
    told = fresh.select("slide_id").unionByName(grown.where(F.col("model") == model).join(rewritten, "shard_file", "left_semi").select("slide_id"))
    return Appended(grown, sharding.manifest_entries(grown, told, dest, batch), planned)


@query("""
WITH s AS (
  SELECT p_partkey, unnest(['alpha', 'beta', 'gamma']) AS model FROM part),
r AS (SELECT DISTINCT l_partkey, CASE l_returnflag WHEN 'A' THEN 'alpha' WHEN 'N' THEN 'beta' ELSE 'gamma' END AS model FROM lineitem WHERE l_quantity > 49 OR l_quantity <= 2)
SELECT s.model, CASE WHEN r.l_partkey IS NOT NULL THEN 'done' WHEN p_size > 40 THEN 'failed' ELSE 'pending' END AS status, count(*) AS n
FROM s JOIN part USING (p_partkey) LEFT JOIN r ON r.l_partkey = s.p_partkey AND r.model = s.model GROUP BY 1, 2""")
def status_sync(t: Tables) -> DataFrame:
    """Status export merged into a versioned table twice (first without one model), then counted."""
    exported = status.export_with_inventory(_status(t), _slides(t).select("file_id", "sample_type"))
    folder = scratch_dir(t.spark, "sync")
    merge_sink(exported.where(F.col("model") != MODELS[2]), folder, ["file_id", "model"], 0)
    table = merge_sink(exported, folder, ["file_id", "model"], 1)
    return table.groupBy("model", "status").agg(F.count("*").alias("n"))




@query(f"""
WITH s AS (SELECT c_custkey, c_nationkey AS g, c_mktsegment IN ('BUILDING', 'MACHINERY') AS early FROM customer WHERE c_nationkey < 8),
n AS (SELECT g, count(*) FILTER (early) AS n_early, count(*) FILTER (NOT early) AS n_late FROM s GROUP BY g)
SELECT CAST(c_custkey AS VARCHAR) AS slide_id, g || CASE WHEN n_early > 0 AND n_late > 0 THEN '/000000.r1.tar' ELSE '/000000.tar' END AS shard_file,
       CASE WHEN early THEN g || '/000000.tar' END AS before_file, CAST(2 AS BIGINT) AS tiles FROM s JOIN n USING (g)""")
def shard_continue(t: Tables) -> DataFrame:
    """Two appends to one open shard per group: the index after both, the one a reader held in between, and the tiles found in the shards."""
    base = scratch_dir(t.spark, "continue")
    slides = t.customer.where("c_nationkey < 8").select(
        F.col("c_custkey").cast("string").alias("slide_id"), F.col("c_nationkey").cast("string").alias("project_id"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("early"), F.col("c_acctbal").cast("float").alias("v"))
    features = slides.select("slide_id", F.lit("m").alias("model"), F.explode(F.array(F.lit(0), F.lit(1))).alias("tile_idx"),
                             F.array("v", "v").alias("features"), F.lit("float32").alias("precision"))
    meta = slides.select("slide_id", F.lit(0.5).alias("native_mpp"), F.lit(False).alias("mpp_is_fallback"))
    between = None
    for part in (slides.where("early"), slides):
        listed = files.shard_listing(t.spark, f"{base}/wds").where("model = 'm'").select(
            F.element_at(F.split("path", "/"), -2).alias("project_id"), F.element_at(F.split("path", "/"), -1).alias("shard_file"), "length")
        index = files.current_index(t.spark, f"{base}/index", schemas.SHARD_INDEX)
        between = index
        grown = append_shards(features, part.select("slide_id", F.lit(16).cast("bigint").alias("bytes")), index, slides.select("slide_id", "project_id"), meta,
                              listed, "m", f"{base}/wds", continue_open=True).index
        index_sink(grown, f"{base}/index")
    now = files.current_index(t.spark, f"{base}/index", schemas.SHARD_INDEX)
    tiles = shards.shard_scan(t.spark, f"{base}/wds").groupBy("slide_id", F.concat_ws("/", "group", "shard_file").alias("shard_file")).agg(F.count(F.lit(1)).alias("tiles"))
    held = between.select("slide_id", F.col("shard_file").alias("before_file"))
    return now.select("slide_id", "shard_file").join(held, "slide_id", "left").join(tiles, ["slide_id", "shard_file"], "left")

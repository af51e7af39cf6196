"""Order-dependent work that must not put a whole group into one task.

A window over a hot key (or over no key at all) runs in one task. The functions
here split the order into chunks by a range partitioning, do the ordered work
inside each chunk, and carry a small per-chunk summary across. Only summaries
(at most one row per chunk and group) meet in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.session import stable

_CHUNK, _GROUP = "__chunk", "__group"


def _named(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


#: About so many rows of a chunk that a Python task holds at once.
CHUNK_ROWS = 100_000


def chunked(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], rows: int | None = None) -> DataFrame:
    """``df`` cut into ordered chunks: adds the group as one non-null struct and the chunk number.

    Chunk numbers are partition numbers of a sampled range partitioning, so the
    rows are written once: every later job has to see the same cut. With ``rows``
    there are as many chunks as hold about that many rows each (one more count).
    """
    count = -(-df.count() // rows) if rows else 0
    ranged = df.repartitionByRange(*([count] if count > 1 else []), *[F.col(c) for c in by], *_named(order))
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    return stable(ranged.withColumn(_CHUNK, F.spark_partition_id()).withColumn(_GROUP, group))


def with_running_totals(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                        totals: Mapping[str, str | Column], chunk: Column | None = None) -> DataFrame:
    """Add, per entry of ``totals``, the sum over the rows before this one in its group.

    ``order`` must be unique within a group. ``totals`` maps the new column to the
    summed expression; 'before' sums exclude the row itself, so an inclusive sum
    is the column plus the row's own value. When the order starts with a column
    that is spread evenly (a hash), ``chunk`` may be any never-falling function
    of it: the cut then needs no sampling and no written copy.
    """
    values = {name: F.col(v) if isinstance(v, str) else v for name, v in totals.items()}
    if chunk is None:
        parts = chunked(df, by, order)
    else:
        group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
        parts = df.withColumn(_CHUNK, chunk).withColumn(_GROUP, group)
    summary = parts.groupBy(_GROUP, _CHUNK).agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in values.items()])
    earlier = Window.partitionBy(_GROUP).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(_GROUP, _CHUNK, *[
        F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in values])
    inside = Window.partitionBy(_GROUP, _CHUNK).orderBy(*_named(order)).rowsBetween(Window.unboundedPreceding, -1)
    local = parts.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{n}")
                                for n, v in values.items()])
    joined = local.join(offsets, [_GROUP, _CHUNK], "left")
    return joined.select(*df.columns, *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in values])


def with_row_number(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                    name: str = "row_number", chunk: Column | None = None) -> DataFrame:
    """``row_number() over (partition by .. order by ..)`` that splits hot groups."""
    counted = with_running_totals(df, by, order, {name: F.lit(1).cast("bigint")}, chunk)
    return counted.withColumn(name, F.col(name) + 1)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """The first (or last) row of each key as an aggregate, so hot keys combine before the shuffle.

    ``order`` holds plain ascending expressions; NULL sorts before every value.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rest) if rest else F.lit(True), F.struct(*order)).alias("_row")
    picked = df.groupBy(*keys).agg(row)
    return picked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


# ---------------------------------------------------------------------------
# Greedy segments: next-fit packing and size-or-time batches
# ---------------------------------------------------------------------------

def _next_starts(weight: np.ndarray, position: np.ndarray, cap: float, span: float) -> np.ndarray:
    """For a segment starting at i: the first row that no longer belongs to it."""
    n = len(weight)
    upto = np.cumsum(weight)
    before = upto - weight
    by_weight = np.searchsorted(upto, before + cap, side="right")
    by_span = np.searchsorted(position, position + span, side="left") if np.isfinite(span) else np.full(n, n)
    return np.maximum(np.minimum(by_weight, by_span), np.arange(n) + 1)


def _first_break(weight_upto: np.ndarray, position: np.ndarray, cap: float, span: float,
                 filled: float, opened_at: float) -> int:
    """First row that does not fit the segment left open by the rows before this chunk."""
    by_weight = int(np.searchsorted(weight_upto, cap - filled, side="right"))
    if not np.isfinite(span):
        return by_weight
    return min(by_weight, int(np.searchsorted(position, opened_at + span, side="left")))


@dataclass
class _Passage:
    """What a stretch of rows does to an open segment, by breakpoints only.

    The open segment decides where the first break falls; all that follows depends
    on that row alone. Rows that lead to the same outcome are one run, of which the weight and position at its
    last row are kept, with the segments begun and the state left behind.
    """

    total: float
    first_at: float
    passable: bool  # an open segment may go through without a break
    upto: np.ndarray
    pos: np.ndarray
    count: np.ndarray
    fill: np.ndarray
    at: np.ndarray

    FIELDS = ("total double, first_at double, passable boolean, upto array<double>, pos array<double>, count array<bigint>,"
              " fill array<double>, at array<double>")

    @classmethod
    def of(cls, row) -> _Passage:
        return cls(row.total, row.first_at, bool(row.passable), *[np.asarray(getattr(row, c)) for c in ("upto", "pos", "count", "fill", "at")])

    def reduced(self) -> _Passage:
        """Neighbouring runs with one outcome as one."""
        same = (self.count[1:] == self.count[:-1]) & (self.fill[1:] == self.fill[:-1]) & (self.at[1:] == self.at[:-1])
        ends = np.append(~same, True)
        return _Passage(self.total, self.first_at, self.passable, *[x[ends] for x in (self.upto, self.pos, self.count, self.fill, self.at)])

    def leave(self, cap: float, span: float, segment: int, filled: float, opened_at: float, fresh: bool) -> tuple[int, float, float, bool]:
        """Segment number, fill and first position of the open segment after these rows."""
        if fresh:
            return segment + int(self.count[0]) - 1, float(self.fill[0]), float(self.at[0]), False
        run = _first_break(self.upto, self.pos, cap, span, filled, opened_at)
        if run >= len(self.count):
            return segment, filled + self.total, opened_at, False
        return segment + int(self.count[run]), float(self.fill[run]), float(self.at[run]), False

    def then(self, other: _Passage, cap: float, span: float) -> _Passage:
        """Both stretches as one."""
        left = [other.leave(cap, span, int(c), f, a, False) for c, f, a in zip(self.count, self.fill, self.at)]
        upto, pos, count = self.upto, self.pos, np.array([x[0] for x in left], dtype=np.int64)
        fill, at = np.array([x[1] for x in left]), np.array([x[2] for x in left])
        if self.passable:
            upto, pos = np.append(upto, other.upto + self.total), np.append(pos, other.pos)
            count, fill, at = np.append(count, other.count), np.append(fill, other.fill), np.append(at, other.at)
        return _Passage(self.total + other.total, self.first_at, self.passable and other.passable, upto, pos, count, fill, at).reduced()

    def row(self) -> list:
        return [self.total, self.first_at, self.passable, self.upto, self.pos, self.count, self.fill, self.at]


#: So many passages are put together at a time.
FAN = 32


def greedy_segments(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str, cap: float,
                    position: str | None = None, span: float = float("inf"),
                    opened: DataFrame | None = None, name: str = "segment") -> DataFrame:
    """Number the segments that fill up in order, each closed by the row that no longer fits.

    A segment takes rows while the sum of ``weight`` stays within ``cap`` and
    ``position`` (a number that never falls along the order) stays less than
    ``span`` after its first row. A row too heavy for any segment gets one of its
    own. ``opened`` may give, per group, the segment to continue: the ``by``
    columns with ``next_segment`` and ``filled`` (NULL ``filled`` starts afresh).

    The result of a chunk depends on the rows before it only through how full the
    open segment is, and that decides just where the chunk's first break falls.
    So every chunk is reduced to its breakpoints (``_Passage``). These are put together
    ``FAN`` at a time up a tree, and the state in front of each goes back down it, so that
    no task holds more than one chunk (of about ``CHUNK_ROWS`` rows) or the breakpoints of ``FAN`` nodes. The chunks then number
    their rows independently. Sums of weights have to be exact doubles, as those of whole numbers are.
    """
    parts = chunked(
        df.withColumn("_w", F.col(weight).cast("double"))
          .withColumn("_p", F.col(position).cast("double") if position else F.lit(0.0)), by, order, CHUNK_ROWS)
    ordered = list(order)

    def summarise(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ordered, kind="stable")
        w, p = rows["_w"].to_numpy(), rows["_p"].to_numpy()
        n, upto = len(w), np.cumsum(w)
        follow = _next_starts(w, p, cap, span)
        reach = min(n, int(np.searchsorted(upto, cap, side="right")) + 1)
        count, last = np.ones(n, dtype=np.int64), np.arange(n)
        for i in range(n - 1, -1, -1):
            if follow[i] < n:
                count[i], last[i] = count[follow[i]] + 1, last[follow[i]]
        before = upto - w
        passage = _Passage(float(upto[-1]), float(p[0]), reach == n, upto[:reach], p[:reach], count[:reach],
                           (upto[-1] - before[last])[:reach], p[last][:reach]).reduced()
        return pd.DataFrame([[rows["_key"].iat[0], int(rows[_CHUNK].iat[0]), *passage.row()]], columns=names)

    names = ["_key", "node", "total", "first_at", "passable", "upto", "pos", "count", "fill", "at"]
    schema = f"_key string, node int, {_Passage.FIELDS}"
    keyed = parts.withColumn("_key", F.to_json(_GROUP))
    slim = keyed.select("_key", _CHUNK, *ordered, "_w", "_p")
    levels = [stable(slim.groupBy("_key", _CHUNK).applyInPandas(summarise, schema))]
    chunks = (levels[0].agg(F.max("node")).first()[0] or 0) + 1

    def compose(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("node")
        whole = None
        for row in nodes.itertuples(index=False):
            whole = _Passage.of(row) if whole is None else whole.then(_Passage.of(row), cap, span)
        return pd.DataFrame([[nodes["_key"].iat[0], int(nodes["node"].iat[0]) // FAN, *whole.row()]], columns=names)

    while chunks > FAN:
        levels.append(stable(levels[-1].groupBy("_key", F.floor(F.col("node") / FAN)).applyInPandas(compose, schema)))
        chunks = -(-chunks // FAN)
    first = F.lit(0).cast("bigint").alias("s_segment"), F.lit(None).cast("double").alias("s_filled")
    starts = levels[-1].select("_key").distinct()
    if opened is not None:
        group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
        opened = opened.select(F.to_json(group).alias("_key"), F.coalesce(F.col("next_segment"), F.lit(0)).cast("bigint").alias("s_segment"),
                               F.col("filled").cast("double").alias("s_filled"))
        starts = starts.join(opened, "_key", "left").withColumn("s_segment", F.coalesce("s_segment", F.lit(0)))
    else:
        starts = starts.select("_key", *first)
    # ``s_at`` is NULL where a segment goes on whose first position is not known: it counts from the first row here.
    starts = starts.withColumns({"s_at": F.lit(None).cast("double"), "s_fresh": F.col("s_filled").isNull(), "parent": F.lit(0)})

    def descend(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("node")
        segment, filled, opened_at, fresh = (nodes[c].iat[0] for c in ("s_segment", "s_filled", "s_at", "s_fresh"))
        opened_at = nodes["first_at"].iat[0] if pd.isna(opened_at) else opened_at
        state, out = (int(segment), 0.0 if fresh else float(filled), float(opened_at), bool(fresh)), []
        for row in nodes.itertuples(index=False):
            out.append((nodes["_key"].iat[0], row.node, *state))
            state = _Passage.of(row).leave(cap, span, *state)
        return pd.DataFrame(out, columns=["_key", "node", "s_segment", "s_filled", "s_at", "s_fresh"])

    states = "_key string, node int, s_segment bigint, s_filled double, s_at double, s_fresh boolean"
    for depth, level in enumerate(reversed(levels)):
        parent = F.lit(0) if depth == 0 else F.floor(F.col("node") / FAN).cast("int")
        under = level.withColumn("parent", parent).join(starts, ["_key", "parent"])
        starts = under.groupBy("_key", "parent").applyInPandas(descend, states)
        if depth < len(levels) - 1:
            starts = starts.withColumnRenamed("node", "parent")
    starts = starts.withColumnRenamed("node", _CHUNK)

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ordered, kind="stable")
        w, p = rows["_w"].to_numpy(), rows["_p"].to_numpy()
        segment, fresh = int(rows["s_segment"].iat[0]), bool(rows["s_fresh"].iat[0])
        follow = _next_starts(w, p, cap, span)
        at = 0 if fresh else _first_break(np.cumsum(w), p, cap, span, rows["s_filled"].iat[0], rows["s_at"].iat[0])
        marks = np.zeros(len(w), dtype=np.int64)
        if fresh:
            at = int(follow[0])
        while at < len(w):
            marks[at] = 1
            at = int(follow[at])
        out = rows[ordered + ["_key"]].copy()
        out[name] = segment + np.cumsum(marks)
        return out

    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    located = slim.join(starts, ["_key", _CHUNK], "left")
    numbered = located.groupBy("_key", _CHUNK).applyInPandas(
        number, ", ".join(f"`{c}` {fields[c]}" for c in ordered) + f", _key string, {name} bigint")
    return keyed.join(numbered, ["_key", *ordered], "left").select(*df.columns, name)

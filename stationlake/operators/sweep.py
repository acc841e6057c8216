"""Interval join by one sweep over time.

Facts and histories are merged in the order (key, time) and cut into range
partitions; a task walks its stretch once and carries the open intervals of the
current key forward. A fact meets the intervals that are open at its time and no
others, so the work is the sort plus the result, however many intervals a key
has in a month or how far they reach.

A partition that starts inside a key must know what is open there. Every
interval is in the order twice, with its start and its end, so after the range
shuffle it knows the partitions of both; a copy of it is handed over to each
partition in between and to the one of its end. What a partition is handed is
what is open at its first row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# Result rows that a task builds before it passes them on.
OUTPUT_ROWS = 50_000

# Rows of one time: starts come before the facts they cover, ends after them.
_START, _FACT, _END, _LOOSE = 0, 1, 2, 3
_FOREVER = np.iinfo(np.int64).max


def _order_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which fact times and interval ends are compared."""
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if not (isinstance(a, times) and isinstance(b, times)):
        raise TypeError(f"cannot order {a.simpleString()} and {b.simpleString()}")
    return a if a == b else T.TimestampNTZType()


def _as_long(values: pa.Array, null: int = 0) -> np.ndarray:
    if pa.types.is_date32(values.type):
        values = values.cast(pa.int32())
    return values.cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False)


def _changes(values: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before."""
    a, b = values.slice(1), values.slice(0, max(len(values) - 1, 0))
    one_null = pc.xor(pc.is_null(a), pc.is_null(b))
    return pc.coalesce(pc.not_equal(a, b), one_null).to_numpy(zero_copy_only=False).astype(bool)


def _sweep(outer: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[tuple[int, int]] = []  # heap of (end, place in the payload)
        carried, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            part, key, fact = b.column("pid"), b.column("k"), b.column("f")
            times, kinds, ends = _as_long(b.column("t")), _as_long(b.column("kind")), _as_long(b.column("e"), _FOREVER)
            first = (part[0].as_py(), key[0].as_py())
            fresh = np.r_[first != last, _changes(part) | _changes(key)]
            last = (part[-1].as_py(), key[-1].as_py())
            base = len(carried) if carried is not None else 0
            payload = pa.concat_arrays([carried, b.column("d")]) if base else b.column("d")
            facts: list[int] = []
            matches: list[int] = []

            def rows() -> pa.RecordBatch:
                found = np.array(matches, np.int64)
                out = [fact.take(pa.array(facts, pa.int64())), payload.take(pa.array(found, mask=found < 0))]
                facts.clear()
                matches.clear()
                return pa.RecordBatch.from_arrays(out, ["f", "d"])

            for i, (new, kind, time, end) in enumerate(zip(fresh.tolist(), kinds.tolist(), times.tolist(), ends.tolist())):
                if new:
                    open_.clear()
                if kind == _START:
                    heappush(open_, (end, base + i))
                    continue
                while open_ and open_[0][0] < time and kind == _FACT:
                    heappop(open_)
                if open_ and kind == _FACT:
                    for lo in range(0, len(open_), OUTPUT_ROWS):
                        now = [at for _, at in open_[lo : lo + OUTPUT_ROWS]]
                        facts += [i] * len(now)
                        matches += now
                        if len(facts) >= OUTPUT_ROWS:
                            yield rows()
                elif outer:
                    facts.append(i)
                    matches.append(-1)
                if len(facts) >= OUTPUT_ROWS:
                    yield rows()
            if facts:
                yield rows()
            carried = payload.take(pa.array([at for _, at in open_], pa.int64()))
            open_ = [(end, at) for at, (end, _) in enumerate(open_)]  # same order: still a heap

    return run


class _Open:
    """The open intervals of one key, with what ``combine`` asks of them kept up
    to date: an interval is worked on when it opens and when it ends, not at
    every fact in between."""

    def __init__(self, asked: list[tuple[str, int]]):
        self.asked = asked
        self.columns = sorted({c for _, c in asked})
        self.minimum = [c for c in self.columns if ("min", c) in asked]
        self.clear()

    def clear(self) -> None:
        self.ends: list[tuple[int, int, tuple]] = []  # heap of (end, number, values)
        self.opened = 0
        self.count = dict.fromkeys(self.columns, 0)
        self.sum = dict.fromkeys(self.columns, 0)
        # Heaps of (value, end); what has ended stays until it is on top.
        self.least: dict[int, list[tuple[int, int]]] = {c: [] for c in self.minimum}

    def push(self, end: int, values: tuple) -> None:
        self.opened += 1
        heappush(self.ends, (end, self.opened, values))
        for c in self.columns:
            if values[c] is not None:
                self.count[c] += 1
                self.sum[c] += values[c]
        for c in self.minimum:
            if values[c] is not None:
                heappush(self.least[c], (values[c], end))

    def at(self, time: int) -> list[int | None]:
        while self.ends and self.ends[0][0] < time:
            _, _, values = heappop(self.ends)
            for c in self.columns:
                if values[c] is not None:
                    self.count[c] -= 1
                    self.sum[c] -= values[c]
        for c in self.minimum:
            heap = self.least[c]
            while heap and heap[0][1] < time:
                heappop(heap)
            if len(heap) > 2 * self.count[c] + 64:
                heap[:] = [x for x in heap if x[1] >= time]
                heapify(heap)
        return [self._answer(kind, c) for kind, c in self.asked]

    def _answer(self, kind: str, c: int) -> int | None:
        if kind == "count":
            return self.count[c]
        if not self.count[c]:
            return None
        return self.sum[c] if kind == "sum" else self.least[c][0][0]


def _tally(outer: bool, asked: list[tuple[str, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``_sweep`` with one row per fact: what is ``asked`` of the intervals open at it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, last = _Open(asked), None
        nothing = open_.at(0)
        for b in batches:
            if not b.num_rows:
                continue
            part, key = b.column("pid"), b.column("k")
            times, kinds, ends = _as_long(b.column("t")), _as_long(b.column("kind")), _as_long(b.column("e"), _FOREVER)
            payload = list(zip(*[column.to_pylist() for column in b.column("d").flatten()]))
            first = (part[0].as_py(), key[0].as_py())
            fresh = np.r_[first != last, _changes(part) | _changes(key)]
            last = (part[-1].as_py(), key[-1].as_py())
            facts: list[int] = []
            found: list[list[int | None]] = []
            for i, (new, kind, time, end) in enumerate(zip(fresh.tolist(), kinds.tolist(), times.tolist(), ends.tolist())):
                if new:
                    open_.clear()
                if kind == _START:
                    open_.push(end, payload[i])
                    continue
                met = open_.at(time) if kind == _FACT else nothing
                if outer or open_.ends:
                    facts.append(i)
                    found.append(met)
            if facts:
                rows = [pa.array(column, pa.int64()) for column in zip(*found)]
                names = [f"a{j}" for j in range(len(asked))]
                out = pa.StructArray.from_arrays(rows, fields=[pa.field(n, pa.int64()) for n in names])
                yield pa.RecordBatch.from_arrays([b.column("f").take(pa.array(facts, pa.int64())), out], ["f", "a"])

    return run


def sweep_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    start: str,
    end: str,
    how: str = "left",
    dim_key: str | None = None,
    drop_dim_key: bool = True,
    combine: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Fact rows with the history rows for which ``start <= ts <= end`` (a NULL
    ``end`` is open): the columns of ``fact``, then those of ``dim``.

    Facts without a key or time, or without a match, keep NULLs (``how="left"``)
    or go (``"inner"``). Intervals without a key or start, and those that end
    before they start, match nothing. Rows are joined one by one, so repeated
    ones multiply as in any join. Either side may be empty.

    The merged rows are written once, range-partitioned, so that both the
    hand-over and the sweep see the same partitions and a lost executor re-reads
    them. One time of one key may hold any number of facts: the order ends with a
    row number, so they are cut into partitions too.

    ``combine`` asks for one row per fact instead of one per pair: the columns of
    ``fact``, then for each name an aggregate, ``("count" | "sum" | "min", column
    of dim)``, over the intervals the fact meets, as grouping the pairs would give
    it. Pairs grow with facts times open intervals; these rows and the work for
    them do not. Columns are of integral types.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    dim_key = dim_key or key
    kind = _order_type(fact.schema[ts].dataType, dim.schema[start].dataType)

    def time(name: str) -> Column:
        return F.col(f"`{name}`").cast(kind)

    f_struct = F.struct(*[F.col(f"`{c}`") for c in fact.columns])
    d_cols = [c for c in dim.columns if not (drop_dim_key and c == dim_key)]
    if combine:
        d_cols = list(dict.fromkeys(c for _, c in combine.values()))
        if any(a not in ("count", "sum", "min") for a, _ in combine.values()):
            raise ValueError("combine knows count, sum and min")
        if not all(isinstance(dim.schema[c].dataType, T.IntegralType) for c in d_cols):
            raise TypeError("combine takes columns of integral types")
    d_struct = F.struct(*[F.col(f"`{c}`") for c in d_cols]) if d_cols else F.struct(F.lit(1).alias("_"))
    loose = F.col(f"`{key}`").isNull() | F.col(f"`{ts}`").isNull()
    points = fact.select(
        F.col(f"`{key}`").alias("k"),
        time(ts).alias("t"),
        F.when(loose, _LOOSE).otherwise(_FACT).alias("kind"),
        F.monotonically_increasing_id().alias("n"),
        F.lit(None).cast(kind).alias("e"),
        f_struct.alias("f"),
        F.lit(None).alias("d"),
    )
    if how == "inner":
        points = points.where(F.col("kind") == _FACT)
    valid = dim.where(F.col(f"`{dim_key}`").isNotNull() & time(start).isNotNull() & (time(end).isNull() | (time(end) >= time(start))))
    # Numbered before it becomes two rows, which share the number.
    spans = valid.select(
        F.col(f"`{dim_key}`").alias("k"),
        F.monotonically_increasing_id().alias("n"),
        time(start).alias("s"),
        time(end).alias("e"),
        d_struct.alias("d"),
    )
    both = F.array(*[F.struct(F.col(t).alias("t"), F.lit(x).alias("kind")) for t, x in (("s", _START), ("e", _END))])
    spans = spans.select("k", "n", "e", "d", F.explode(both).alias("at"))
    starts = F.col("at.kind") == _START
    spans = spans.select(
        "k", "at.t", "at.kind", "n", "e", F.lit(None).alias("f"), F.when(starts, F.col("d")).alias("d")
    )
    merged = points.unionByName(spans)
    merged = merged.repartitionByRange("k", F.col("t").asc_nulls_last(), "kind", "n")
    merged = materialize(merged.withColumn("pid", F.spark_partition_id()), "sweep")

    ends = merged.where(F.col("kind") == _END).select("n", F.col("pid").alias("last"))
    handed = merged.where(F.col("kind") == _START).join(ends, "n").where(F.col("last") > F.col("pid"))
    handed = handed.withColumn("pid", F.explode(F.sequence(F.col("pid") + 1, F.col("last")))).drop("last")
    walked = merged.where(F.col("kind") != _END).unionByName(handed)
    walked = walked.repartition("pid").sortWithinPartitions("pid", "k", "t", "kind")
    if combine:
        asked = [(a, d_cols.index(c)) for a, c in combine.values()]
        found = T.StructType([T.StructField(f"a{j}", T.LongType()) for j in range(len(asked))])
        schema = T.StructType([T.StructField("f", merged.schema["f"].dataType), T.StructField("a", found)])
        out = walked.drop("n").mapInArrow(_tally(how == "left", asked), schema)
        return out.select(
            *[F.col("f").getField(c).alias(c) for c in fact.columns],
            *[F.col("a").getField(f"a{j}").alias(name) for j, name in enumerate(combine)],
        )
    schema = T.StructType([T.StructField(c, merged.schema[c].dataType) for c in ("f", "d")])
    out = walked.drop("n").mapInArrow(_sweep(how == "left"), schema)
    f, d = F.col("f"), F.col("d")
    return out.select(*[f.getField(c).alias(c) for c in fact.columns], *[d.getField(c).alias(c) for c in d_cols])

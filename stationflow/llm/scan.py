"""Ranks and running sums over groups of any size, without a group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shipping import ship
from .steps import stored

# A mark is four numbers of 32 bits, so that sums of them never overflow a long.
LANES = 4
_LANE = (1 << 32) - 1


def lane(i: int, of: str) -> str:
    return f"{of}_{i}"


def _lanes(column: pa.Array) -> np.ndarray:
    """The first 16 bytes of each value (32 bytes or more each), as four numbers."""
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column)].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)
    return flat[starts[:, None] + np.arange(4 * LANES)].view("<u4").astype(np.uint64)


def running(rows: DataFrame, group: str, order: list[str | Column], folder: str, mark: str | None = None) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, ... within ``group`` by ``order``; written below ``folder``.

    With ``mark``, a binary column of at least 16 bytes and never null, the columns
    ``upto_0 ... upto_3`` are the sums of the marks up to and with the row, lane by
    lane modulo 2**32, and ``before_0 ...`` those up to the row before.

    The rows are sorted over all tasks by group and order; each task counts within
    its own part of each group. A group that crosses from one task to the next gets
    what came before it added: there are fewer than two such pieces per task, so
    the table of them is bounded by the number of tasks and is broadcast. ``group``
    must not be null; rows that tie in ``order`` come in any order.
    """
    spark = ship(rows.sparkSession)
    sums = [lane(i, of) for of in ("upto", "before") for i in range(LANES)] if mark else []
    kept = [f for f in rows.schema if f.name != mark]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["part int", "rank long"] + [f"{s} long" for s in sums])
    names = [f.name for f in kept]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, done, sofar = None, 0, np.zeros(LANES, np.uint64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(group)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            new[0] = key[0].as_py() != last
            heads = np.flatnonzero(new)
            at = np.arange(n)
            head = np.where(new, at, 0)
            np.maximum.accumulate(head, out=head)
            carried = (head == 0) & ~new[0]
            rank = at - head + 1 + np.where(carried, done, 0)
            out = [batch.column(name) for name in names]
            out += [pa.array(np.full(n, part, np.int32)), pa.array(rank)]
            if mark:
                own = _lanes(batch.column(mark))
                total = np.cumsum(own, axis=0)
                total -= np.where(head[:, None] > 0, total[head - 1], 0)
                total += np.where(carried[:, None], sofar, np.uint64(0))
                before = (total - own) & np.uint64(_LANE)
                total &= np.uint64(_LANE)
                out += [pa.array(x.astype(np.int64)) for x in (*total.T, *before.T)]
                sofar = total[-1]
            last, done = key[n - 1].as_py(), int(rank[-1])
            assert len(heads) or carried.all()
            yield pa.RecordBatch.from_arrays(out, names + ["part", "rank"] + sums)

    by = [F.col(c) if isinstance(c, str) else c for c in (group, *order)]
    placed = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(count, schema), f"{folder}/placed")

    ends = [F.max("rank").alias("n"), *(F.max_by(s, "rank").alias(s) for s in sums[:LANES])]
    pieces = placed.groupBy(group, "part").agg(*ends)
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    added = {"base": F.sum("n").over(earlier)}
    added |= {f"base_{i}": F.sum(lane(i, "upto")).over(earlier) for i in range(LANES if mark else 0)}
    crossing = pieces.withColumns(added).where("base IS NOT NULL").select(group, "part", *added)
    crossing = stored(crossing, f"{folder}/crossing")
    # At most one piece per task has something before it.
    whole = placed.join(F.broadcast(crossing), [group, "part"], "left")

    def plus(name: str, base: str) -> Column:
        total = F.col(name) + F.coalesce(F.col(base), F.lit(0))
        return total if name == "rank" else total.bitwiseAND(F.lit(_LANE))

    moved = {"rank": plus("rank", "base")} | {s: plus(s, f"base_{s[-1]}") for s in sums}
    return whole.withColumns(moved).select(*names, *moved)

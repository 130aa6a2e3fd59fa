"""Whole numbers under sums that cross, and moves of records under bounds that stay: a parent or unit in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT = 10**9  # fractions are whole multiples of 1 / UNIT, so that sums of them are exact


def settle(rows: np.ndarray, cols: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """0 or 1 for each fraction (in 1 / UNIT) so that the sums by row, by column and of all move by less than one.

    Each row and column gets an edge that fills its sum up to a whole number, so where one edge is a fraction another is as well, and fractions
    always hold a cycle. Along it every second edge takes what the others give until one is whole; the direction is the one that costs less, where a unit up costs 1 less twice the first fraction.
    """
    n_rows, n_cols = int(rows.max(initial=-1)) + 1, int(cols.max(initial=-1)) + 1
    fill_row = -np.bincount(rows, parts, n_rows).round().astype(np.int64) % UNIT
    fill_col = -np.bincount(cols, parts, n_cols).round().astype(np.int64) % UNIT
    a = np.concatenate([rows, np.arange(n_rows), np.full(n_cols, n_rows), [n_rows]])
    b = np.concatenate([cols, np.full(n_rows, n_cols), np.arange(n_cols), [n_cols]]) + n_rows + 1
    now = np.concatenate([parts, fill_row, fill_col, [int(parts.sum()) % UNIT]]).astype(np.int64).tolist()
    price = [UNIT - 2 * x for x in now]
    open_edges: list[dict[int, None]] = [{} for _ in range(n_rows + n_cols + 2)]
    ends = list(zip(a.tolist(), b.tolist()))
    for e, x in enumerate(now):
        if x:
            for end in ends[e]:
                open_edges[end][e] = None
    for start in range(len(open_edges)):
        while open_edges[start]:
            # walk over fractions until a place comes again
            path, seen, at, last = [], {start: 0}, start, None
            while True:
                e = next(e for e in open_edges[at] if e != last)
                path.append(e)
                at, last = ends[e][1] if ends[e][0] == at else ends[e][0], e
                if at in seen:
                    break
                seen[at] = len(path)
            cycle = path[seen[at] :]
            up, down = cycle[::2], cycle[1::2]
            if sum(price[e] for e in up) > sum(price[e] for e in down):
                up, down = down, up
            step = min([UNIT - now[e] for e in up] + [now[e] for e in down])
            for group, sign in ((up, step), (down, -step)):
                for e in group:
                    now[e] += sign
                    if now[e] in (0, UNIT):
                        for end in ends[e]:
                            open_edges[end].pop(e, None)
    return np.array(now[: len(parts)]) // UNIT


def round_crossing(fitted: DataFrame, parent: list[str], rows: list[str], cols: list[str], cell: list[str], value: str = "x") -> DataFrame:
    """``fitted`` with whole numbers ``n``: each the floor or the ceiling of its value, and so are their sums by ``rows``, by ``cols`` and of the parent.

    The two sets of columns need not nest, as queries in :func:`tessera.operators.fit.round_nested` do; ``cell`` names a cell within the parent and
    orders the work, so the result is the same for any partitioning. Whole sums stay as they are. A parent's cells are worked on in one task.
    """
    out = T.StructType([*fitted.schema.fields, T.StructField("n", T.LongType())])

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(cell, kind="stable", na_position="first").reset_index(drop=True)
        code = lambda by: frame.groupby(by, dropna=False, sort=True).ngroup().to_numpy() if by else np.zeros(len(frame), np.int64)
        scaled = np.round(frame[value].to_numpy(float) * UNIT).astype(np.int64)
        whole, parts = scaled // UNIT, scaled % UNIT
        frame["n"] = whole + settle(code(rows), code(cols), parts)
        return frame

    return fitted.groupBy(*parent).applyInPandas(work, out)


FAR = np.iinfo(np.int32).max  # no way


def cheapest_moves(first: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (levels x rest) after moves within columns that bring row sums into their bounds, and whether all are; with one more dimension in front, of many units, each by itself.

    One record at a time takes the cheapest path over levels from one that may give to one that lacks (or from one that has too many to one that may take); the cost
    is the growth of the squared distance to the first counts. A level within its bounds stays there. Ties: the least level and column.
    """
    if first.ndim == 2:
        n, met = cheapest_moves(first[None], np.asarray(lower)[None], np.asarray(upper)[None])
        return n[0], bool(met[0])
    first, levels = first.astype(np.int64), first.shape[1]
    n, met, left = first.copy(), np.zeros(len(first), bool), np.arange(len(first))
    loop = np.eye(levels, dtype=bool)[:, :, None]
    while len(left):
        sums = n[left].sum(axis=2)
        wrong = ((sums < lower[left]) | (sums > upper[left])).any(axis=1)
        met[left[~wrong]] = True
        left, sums = left[wrong], sums[wrong]
        if not len(left):
            break
        lack, over, now = sums < lower[left], sums > upper[left], n[left]
        away = now - first[left]
        # a record of column r from level i to level j
        cost = 2 * (away[:, None, :, :] - away[:, :, None, :] + 1)
        cost = np.where((now[:, :, None, :] > 0) & ~loop, cost, FAR)
        via, edge = cost.argmin(axis=3), cost.min(axis=3)
        moved = np.zeros(len(left), bool)
        for give, take in ((over, lack), (sums > lower[left], lack), (over, sums < upper[left])):
            some = np.flatnonzero(~moved & give.any(axis=1) & take.any(axis=1))
            far, way = np.where(give[some], 0, FAR).astype(np.int64), edge[some]
            before = np.full(far.shape, -1)
            for _ in range(levels):
                reach = np.where((far[:, :, None] < FAR) & (way < FAR), far[:, :, None] + way, FAR)
                best, least = reach.argmin(axis=1), reach.min(axis=1)
                better = least < far
                if not better.any():
                    break
                before, far = np.where(better, best, before), np.where(better, least, far)
            row = np.arange(len(some))
            goal = np.where(take[some], far, np.iinfo(np.int64).max).argmin(axis=1)
            row = row[take[some][row, goal] & (before[row, goal] >= 0) & (far[row, goal] < FAR)]
            moved[some[row]] = True
            at = goal[row]
            for _ in range(levels):
                i = before[row, at]
                r = via[some[row], i, at]
                n[left[some[row]], i, r] -= 1
                n[left[some[row]], at, r] += 1
                further = before[row, i] >= 0
                row, at = row[further], i[further]
                if not len(row):
                    break
        left = left[moved]
    return n, met


#: Places of the table of costs that a task has for a lot of units at once (a larger unit is a lot of its own).
LOT_PLACES = 2_000_000


def ranks(unit: np.ndarray, code: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Dense ranks of codes within each unit, how many each unit has, the number of its first among all, and a row of each."""
    codes = int(code.max(initial=0)) + 1
    pair, row, back = np.unique(unit * codes + code, return_index=True, return_inverse=True)
    sizes = np.bincount(pair // codes, minlength=units)
    starts = np.cumsum(sizes) - sizes
    return back - starts[unit], sizes, starts, row


def swap_within(cells: DataFrame, unit: list[str], attribute: str, rest: list[str], bounds: DataFrame, n: str = "n") -> DataFrame:
    """Records of each unit moved between levels of an attribute until its counts by level are within ``bounds`` (unit, attribute, lower, upper; null: none).

    A record keeps its other levels ``rest``, so all sums over the attribute stay. Bounds that held are kept: a level gives and takes only within
    its own, and no path passes through a broken one. Moves are the cheapest by squared change (:func:`cheapest_moves`). Returns unit, attribute, rest, n, and ``met``: whether all
    bounds of the unit hold. Levels without cells come from ``bounds``; units without bounds stay as they are.

    A unit's cells and bounds come as one row, so they meet whatever the partitions are; a task works on many units at once.
    """
    kinds = {f.name: f for f in cells.schema.fields}
    out = T.StructType([*[kinds[c] for c in (*unit, attribute, *rest)], T.StructField("n", T.LongType()), T.StructField("met", T.BooleanType())])
    asked = bounds.select(*unit, F.col(attribute).cast(kinds[attribute].dataType).alias(attribute), F.col("lower").cast("double").alias("_lo"), F.col("upper").cast("double").alias("_hi"))
    joined = cells.select(*unit, attribute, *rest, F.col(n).cast("long").alias("_n")).join(asked, [*unit, attribute], "full")
    parts = [attribute, *rest, "_n", "_lo", "_hi"]
    packed = joined.groupBy(*unit).agg(F.collect_list(F.struct(*parts)).alias("_held")).select(*unit, *[F.col(f"_held.{c}").alias(f"_of_{k}") for k, c in enumerate(parts)])

    def of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        units, held = batch.num_rows, [batch.column(len(unit) + k) for k in range(len(parts))]
        flat = [h.flatten() for h in held]
        frame = pd.DataFrame({k: x.to_pandas() for k, x in enumerate(flat)})
        u = np.repeat(np.arange(units), held[0].value_lengths().to_numpy(zero_copy_only=False))
        code = lambda rows, by: rows.groupby(by, sort=True, dropna=False).ngroup().to_numpy() if by else np.zeros(len(rows), np.int64)
        count, lo, hi = (frame[len(parts) - k] for k in (3, 2, 1))
        there = np.flatnonzero(count.notna())
        lo, hi, count = lo.fillna(0.0).to_numpy(float), hi.fillna(np.inf).to_numpy(float), flat[-3].take(pa.array(there)).to_numpy(zero_copy_only=False)
        level, n_levels, level_start, level_row = ranks(u, code(frame, [0]), units)
        column, n_columns, column_start, column_row = ranks(u[there], code(frame.iloc[there], list(range(1, 1 + len(rest)))), units)
        # units of about one shape make a lot; those without cells have nothing to move
        wide = 1 << np.ceil(np.log2(np.maximum(n_columns, 1))).astype(np.int64)
        for shape_levels, shape_columns in np.unique(np.stack((n_levels, wide))[:, n_columns > 0], axis=1).T:
            alike = np.flatnonzero((n_levels == shape_levels) & (wide == shape_columns) & (n_columns > 0))
            step = max(1, LOT_PLACES // int(shape_levels * shape_levels * shape_columns))
            for lot in (alike[k : k + step] for k in range(0, len(alike), step)):
                place = np.full(units, -1)
                place[lot] = np.arange(len(lot))
                mine, its = np.flatnonzero(place[u] >= 0), np.flatnonzero(place[u[there]] >= 0)
                first = np.zeros((len(lot), shape_levels, shape_columns), np.int64)
                known = np.zeros(first.shape, bool)
                at = place[u[there][its]], level[there][its], column[its]
                np.add.at(first, at, count[its])
                known[at] = True
                lower, upper = np.zeros(first.shape[:2]), np.full(first.shape[:2], np.inf)
                np.maximum.at(lower, (place[u[mine]], level[mine]), lo[mine])
                np.minimum.at(upper, (place[u[mine]], level[mine]), hi[mine])
                after, met = cheapest_moves(first, lower, upper)
                k, i, j = np.nonzero((after > 0) | known)
                row, cell = pa.array(level_row[level_start[lot[k]] + i]), pa.array(there[column_row[column_start[lot[k]] + j]])
                arrays = [*[batch.column(c).take(pa.array(lot[k])) for c in range(len(unit))], flat[0].take(row), *[x.take(cell) for x in flat[1 : 1 + len(rest)]], pa.array(after[k, i, j]), pa.array(met[k])]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from of(batch)

    return packed.mapInArrow(run, out)

"""Linear tabulation queries over long-form histograms."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations, product
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import hist

NOWHERE = "total"
BY = " * "


@dataclass
class Schema:
    """Dims in order with their sizes, and recodes: name -> (dim, {group label: levels}); groups may overlap."""

    dims: dict[str, int]
    recodes: dict[str, tuple[str, dict[str, list[int]]]] = field(default_factory=dict)

    def parse(self, query: str) -> list[str]:
        """Parts of a crossed query in the order of the dims; ``detailed`` is all dims, ``total`` none."""
        if query == "total":
            return []
        if query == "detailed":
            return list(self.dims)
        parts = [p.strip() for p in query.split("*")]
        order = {d: i for i, d in enumerate(self.dims)}
        unknown = [p for p in parts if p not in self.dims and p not in self.recodes]
        if unknown:
            raise ValueError(f"unknown query parts: {unknown}")
        used = [self.dim_of(p) for p in parts]
        if len(set(used)) < len(used):
            raise ValueError(f"two parts of {query!r} share a dim")
        return sorted(parts, key=lambda p: order[self.dim_of(p)])

    def dim_of(self, part: str) -> str:
        return part if part in self.dims else self.recodes[part][0]

    def groups(self, part: str) -> dict[str, list[int]]:
        return {str(i): [i] for i in range(self.dims[part])} if part in self.dims else self.recodes[part][1]

    def names(self) -> list[str]:
        """All queries: total, detailed, each part, all crosses of parts that share no dim."""
        parts = [*self.dims, *self.recodes]
        crossed = [c for n in range(1, len(self.dims) + 1) for c in combinations(parts, n) if len({self.dim_of(p) for p in c}) == n]
        return ["total", "detailed", *(BY.join(self.parse(BY.join(c))) for c in crossed)]

    def shape(self, query: str) -> list[int]:
        return [len(self.groups(p)) for p in self.parse(query)]

    def levels(self, query: str) -> list[str]:
        return [" BY ".join(x) or NOWHERE for x in product(*[list(self.groups(p)) for p in self.parse(query)])]

    def sensitivity(self, query: str) -> int:
        """Most groups that one cell counts in."""
        most = 1
        for p in self.parse(query):
            g = self.groups(p)
            most *= max(sum(i in members for members in g.values()) for i in range(self.dims[self.dim_of(p)]))
        return most


def labels(schema: Schema, part: str) -> Column:
    """Array of the group labels that the level of a dim belongs to (empty: in no group)."""
    dim = schema.dim_of(part)
    hits = [F.when(F.col(dim).isin(members), F.lit(label)) for label, members in schema.groups(part).items()]
    return F.array_compact(F.array(*hits))


def answer(frame: DataFrame, schema: Schema, query: str, keys: list[str], values: list[str]) -> DataFrame:
    """One query: keys, a column per part with its labels, summed values. Levels in no group are dropped, overlaps count in each."""
    parts = schema.parse(query)
    for p in parts:
        column = F.col(p).cast("string") if p in schema.dims else F.explode(labels(schema, p))
        frame = frame.withColumn(f"_{p}", column)
    return frame.groupBy(*keys, *[F.col(f"_{p}").alias(p) for p in parts]).agg(*[F.sum(v).alias(v) for v in values])


def joined_labels(left: Column, right: Column, sep: str) -> Column:
    return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.concat(a, F.lit(sep), b))))


def named(levels: Column, name: str) -> Column:
    return F.transform(levels, lambda x: F.struct(F.lit(name).alias("query"), x.alias("level")))


#: Pairs of cells and queries up to which the levels of all cells are written out beforehand.
LISTED = 1 << 14


def hits(frame: DataFrame, schema: Schema, queries: list[str]) -> Column:
    """Array of the (query, level) pairs that a cell counts in.

    Where cells are few and their dims whole numbers, it is looked up by the number of the cell among the dims that are asked for; labels
    are put together in each row only for other schemas and for values outside their dim.
    """
    parsed = [(q, schema.parse(q)) for q in queries]
    pairs = []
    for q, parts in parsed:
        merged = F.array(F.lit("" if parts else NOWHERE))
        for i, p in enumerate(parts):
            mine = F.array(F.col(p).cast("string")) if p in schema.dims else labels(schema, p)
            merged = joined_labels(merged, mine, " BY " if i else "")
        pairs.append(named(merged, q))
    asked = {schema.dim_of(p) for _, parts in parsed for p in parts}
    used = {d: n for d, n in schema.dims.items() if d in asked}
    whole = {c for c, kind in frame.dtypes if kind in ("tinyint", "smallint", "int", "bigint")}
    if not used or not whole.issuperset(used) or prod(used.values()) * len(queries) > LISTED:
        return F.concat(*pairs)
    listed = []
    for cell in product(*map(range, used.values())):
        at = dict(zip(used, cell))
        of = [(q, [[g for g, members in schema.groups(p).items() if at[schema.dim_of(p)] in members] for p in parts]) for q, parts in parsed]
        listed.append([{"query": q, "level": " BY ".join(x) if x else NOWHERE} for q, groups in of for x in product(*groups)])
    table = F.from_json(F.lit(json.dumps(listed)), "array<array<struct<query:string,level:string>>>")
    inside = reduce(lambda a, b: a & b, [F.col(d).between(0, n - 1) for d, n in used.items()])
    return F.when(inside, F.get(table, hist.flat_index(list(used), list(used.values())))).otherwise(F.concat(*pairs))


def answer_many(frame: DataFrame, schema: Schema, queries: list[str], keys: list[str], values: list[str], level: str = "level") -> DataFrame:
    """Several queries in one aggregation: keys, ``query``, merged ``level``, summed values.

    Each cell is exploded into the (query, level) pairs it counts in; sums are
    combined before the shuffle, so the shuffle carries answers, not cells.
    """
    exploded = frame.withColumn("_hit", F.explode(hits(frame, schema, queries)))
    return exploded.groupBy(*keys, F.col("_hit.query").alias("query"), F.col("_hit.level").alias(level)).agg(*[F.sum(v).alias(v) for v in values])


def marginal(frame: DataFrame, keys: list[str], keep: list[str], values: list[str]) -> DataFrame:
    """Sum out all dims that aren't kept."""
    return frame.groupBy(*keys, *keep).agg(*[F.sum(v).alias(v) for v in values])


def subset_marginal(frame: DataFrame, keys: list[str], levels: dict[str, list[int]], values: list[str]) -> DataFrame:
    """Marginal over the named dims, restricted to listed levels (pushed into the scan of the cells)."""
    kept = reduce(lambda f, d: f.filter(F.col(d[0]).isin(d[1])), levels.items(), frame)
    return marginal(kept, keys, list(levels), values)


def kron(frame: DataFrame, keys: list[str], weights: dict[str, list[list[float]]], value: str, out: str = "answer") -> DataFrame:
    """Product of per-dim weight matrices (rows x levels): one row per key and combination of matrix rows."""
    for d, matrix in weights.items():
        pairs = F.array(*[F.array(*[F.struct(F.lit(r).alias("row"), F.lit(float(row[k])).alias("w")) for r, row in enumerate(matrix) if row[k] != 0]) for k in range(len(matrix[0]))])
        frame = frame.withColumn(f"_{d}", F.explode(F.get(pairs, F.col(d))))
    w = reduce(lambda a, b: a * b, [F.col(f"_{d}.w") for d in weights])
    return frame.groupBy(*keys, *[F.col(f"_{d}.row").alias(f"{d}_row") for d in weights]).agg(F.sum(F.col(value) * w).alias(out))


def predicate_count(frame: DataFrame, keys: list[str], cells: Column, value: str) -> DataFrame:
    """Count inside an explicit set of cells, and outside it."""
    return frame.groupBy(*keys).agg(F.sum(F.when(cells, F.col(value)).otherwise(0)).alias("inside"), F.sum(F.when(cells, 0).otherwise(F.col(value))).alias("outside"))


def weighted_sum(answers: list[tuple[float, DataFrame]], keys: list[str], value: str, out: str) -> DataFrame:
    """Weighted sum of answers with the same keys, from one or several histograms."""
    parts = [f.select(*keys, (F.col(value) * w).alias(out)) for w, f in answers]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum(out).alias(out))


def with_levels(keys: DataFrame, schema: Schema, queries: list[str], level: str = "level") -> DataFrame:
    """Each row of ``keys`` with every (query, merged level), made by exploding the parts of a query one after the other."""
    out = None
    for q in queries:
        f = keys.withColumn("query", F.lit(q)).withColumn(level, F.lit(NOWHERE if not schema.parse(q) else ""))
        for i, p in enumerate(schema.parse(q)):
            labelled = F.transform(F.sequence(F.lit(0), F.lit(schema.dims[p] - 1)), lambda x: x.cast("string")) if p in schema.dims else F.array(*map(F.lit, schema.groups(p)))
            f = f.withColumn("_part", F.explode(labelled)).withColumn(level, F.concat(level, F.lit(" BY " if i else ""), "_part")).drop("_part")
        out = f if out is None else out.unionByName(f)
    return out


def fill_missing(answers: DataFrame, schema: Schema, queries: list[str], keys: list[str], values: list[str], units: DataFrame | None = None, level: str = "level") -> DataFrame:
    """Add the (query, level) rows that a key lacks, with zeros and was_missing = 1; ``units`` lists the keys, else those that have an answer."""
    full = with_levels((answers if units is None else units).select(*keys).distinct(), schema, queries, level)
    joined = full.join(answers.withColumn("_there", F.lit(1)), [*keys, "query", level], "left")
    return joined.select(*keys, "query", level, *[F.coalesce(v, F.lit(0)).alias(v) for v in values], F.when(F.col("_there").isNull(), 1).otherwise(0).alias("was_missing"))


def merge_dims(frame: DataFrame, dims: list[str], out: str = "level") -> DataFrame:
    """Concatenate the dims that remain into one level; none: ``total``."""
    return frame.withColumn(out, F.concat_ws(" BY ", *[F.col(d).cast("string") for d in dims]) if dims else F.lit(NOWHERE)).drop(*dims)


def expand_workload(names: list[str], workloads: dict[str, list[str]]) -> list[str]:
    """Named workloads become their queries; other names pass; each query once, in order."""
    return list(dict.fromkeys(q for n in names for q in workloads.get(n, [n])))

"""Schemas, recodes, workloads, layouts and constraints given as tables.

Catalogues are of schema size: each is fetched with a bound of MOST rows and checked before anything is counted with it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tessera.operators import query

MOST = 200_000


def fetched(table: DataFrame, columns: list[str], order: list[str]) -> list[Row]:
    """Rows of a catalogue table in order; more than MOST of them, or a null, are an error."""
    rows = table.select(*columns).orderBy(*order).limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"a catalogue table has more than {MOST} rows")
    if bad := [r for r in rows if any(v is None for v in r)]:
        raise ValueError(f"a catalogue table has nulls: {bad[:3]}")
    return rows


def load_schema(dims: DataFrame, groups: DataFrame) -> query.Schema:
    """Schema from dims (dim, place, size) and groups (recode, dim, place, label, level): one row for each level of each group.

    Dims stand in the order of their places, labels of a recode in that of theirs. Refused: repeated names or places, sizes below 1, levels outside their dim, a recode over two dims or of the name of a dim, a label with two places.
    """
    sizes, places = {}, set()
    for r in fetched(dims, ["dim", "place", "size"], ["place", "dim"]):
        if r.dim in sizes or r.place in places or r.size < 1:
            raise ValueError(f"bad dim: {r}")
        sizes[r.dim] = int(r.size)
        places.add(r.place)
    recodes: dict[str, tuple[str, dict[str, list[int]]]] = {}
    at: dict[tuple[str, str], int] = {}
    for r in fetched(groups, ["recode", "dim", "place", "label", "level"], ["recode", "place", "label", "level"]):
        if r.dim not in sizes or not 0 <= r.level < sizes[r.dim] or r.recode in sizes or r.recode in ("total", "detailed"):
            raise ValueError(f"bad group: {r}")
        dim, labels = recodes.setdefault(r.recode, (r.dim, {}))
        members = labels.setdefault(r.label, [])
        if dim != r.dim or r.level in members or at.setdefault((r.recode, r.label), r.place) != r.place:
            raise ValueError(f"bad group: {r}")
        members.append(int(r.level))
    return query.Schema(sizes, recodes)


def load_workloads(table: DataFrame, schema: query.Schema) -> dict[str, list[str]]:
    """Workload name -> queries from (workload, place, query); each query must parse under the schema and stands once."""
    out: dict[str, list[str]] = {}
    for r in fetched(table, ["workload", "place", "query"], ["workload", "place", "query"]):
        name = query.BY.join(schema.parse(r["query"])) if r["query"] not in ("total", "detailed") else r["query"]
        if name in out.setdefault(r.workload, []):
            raise ValueError(f"repeated query: {r}")
        out[r.workload].append(name)
    return out


def load_layouts(table: DataFrame) -> dict[str, tuple[list[tuple[str, int, int, str]], dict[str, str]]]:
    """Layout name -> fields (name, start, width, type) as fixed-width readers take them, and legal values by field, from (layout, place, field, width, type, legal)."""
    out: dict[str, tuple[list[tuple[str, int, int, str]], dict[str, str]]] = {}
    for r in fetched(table, ["layout", "place", "field", "width", "type", "legal"], ["layout", "place"]):
        fields, legal = out.setdefault(r.layout, ([], {}))
        if r.width < 1 or r.field in legal:
            raise ValueError(f"bad field: {r}")
        fields.append((r.field, fields[-1][1] + fields[-1][2] if fields else 1, int(r.width), r.type))
        legal[r.field] = r.legal
    return out


def load_zeros(table: DataFrame, schema: query.Schema) -> dict[str, Column]:
    """Impossible cells by rule from (rule, part, label): a cell breaks a rule if it lies, for each part that the rule names, in one of the labels listed."""
    rules: dict[str, dict[str, set[int]]] = {}
    for r in fetched(table, ["rule", "part", "label"], ["rule", "part", "label"]):
        if r.part not in schema.dims and r.part not in schema.recodes or r.label not in schema.groups(r.part):
            raise ValueError(f"bad rule: {r}")
        rules.setdefault(r.rule, {}).setdefault(r.part, set()).update(schema.groups(r.part)[r.label])
    return {name: reduce(lambda a, b: a & b, [F.col(schema.dim_of(part)).isin(sorted(levels)) for part, levels in parts.items()]) for name, parts in rules.items()}


def failing_limits(answers: DataFrame, limits: DataFrame, keys: list[str], value: str, level: str = "level") -> DataFrame:
    """Answers outside their limits (constraint, query, level, lower, upper; a null bound is none): keys, constraint, query, level, value, lower, upper."""
    names = limits.select("constraint", "query", F.col("level").alias(level), "lower", "upper")
    out = (F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper"))
    return answers.join(names, ["query", level]).filter(out).select(*keys, "constraint", "query", level, value, "lower", "upper")


def sensitivities(rows: DataFrame) -> DataFrame:
    """By query from (query, dim, row, level, weight): ``l1`` and ``l2``, the greatest column norms over all cells, ``whole``: all weights are whole numbers, and ``gaussian``: discrete Gaussian noise may be used.

    A query is the product over its dims, so is the column of a cell, and the greatest is the product of each dim's greatest. Discrete Gaussian noise asks for whole weights and an l1 norm of 1.
    """
    by_level = rows.groupBy("query", "dim", "level").agg(F.sum(F.abs("weight")).alias("_a"), F.sum(F.col("weight") * F.col("weight")).alias("_s"), F.min(F.col("weight") == F.round("weight")).alias("_w"))
    by_dim = by_level.groupBy("query", "dim").agg(F.max("_a").alias("_a"), F.max("_s").alias("_s"), F.min("_w").alias("_w"))
    return by_dim.groupBy("query").agg(F.product("_a").alias("l1"), F.sqrt(F.product("_s")).alias("l2"), F.min("_w").alias("whole")).withColumn("gaussian", F.col("whole") & (F.abs(F.col("l1") - 1) < 1e-9))


def by_flags(frame: DataFrame, flags: list[str], table: DataFrame, out: str) -> DataFrame:
    """``frame`` with ``out`` from the table's row that fits its flags; a null flag in the table fits any value, none of the frame's may be null.

    Of several rows that fit, the one with the fewest nulls counts, then the least ``out``; no row: null. The rows of the table with nulls in the same flags are a mask
    group: each distinct combination of flags asks each group by one key, so what is joined is combinations times groups, by equality.
    """
    empty = F.array(*[F.col(f).isNull() for f in flags])
    entries = table.select(*flags, F.col(out).alias("_out"), empty.alias("_mask"))
    masks = [r["_mask"] for r in fetched(entries.select("_mask").distinct(), ["_mask"], ["_mask"])]
    key = lambda mask: F.array(*[F.when(~F.get(mask, F.lit(i)), F.col(f).cast("string")) for i, f in enumerate(flags)])
    text = lambda mask: F.concat(F.to_json(mask), F.to_json(key(mask)))
    known = entries.select(text(F.col("_mask")).alias("_key"), F.size(F.filter("_mask", lambda m: m)).alias("_any"), "_out").groupBy("_key", "_any").agg(F.min("_out").alias("_out"))
    combos = frame.select(*flags).distinct()
    if not masks:
        return frame.withColumn(out, F.lit(None).cast(table.schema[out].dataType))
    asked = combos.withColumn("_mask", F.explode(F.array(*[F.array(*map(F.lit, m)) for m in masks]))).withColumn("_key", text(F.col("_mask")))
    best = asked.join(known, "_key").groupBy(*flags).agg(F.min(F.struct("_any", "_out")).alias("_b")).select(*flags, F.col("_b._out").alias(out))
    return frame.drop(out).join(best, flags, "left")

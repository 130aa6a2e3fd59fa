"""Noise for SQL tables: named aggregations in order, each visible to the next, then noise on measure columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import noise, order


def run_tables(spark: SparkSession, tables: dict[str, DataFrame], steps: list[tuple[str, str]]) -> dict[str, DataFrame]:
    """Run named SQL texts in order; each sees the given tables and the steps before it. Session views are dropped again."""
    known = dict(tables)
    for name, text in steps:
        known[name] = spark.sql(text, **{k: v for k, v in known.items() if "{" + k + "}" in text})
    return known


def suppress_minimum(contributors: str, least: int, values: list[str]) -> list:
    """Cells of fewer than ``least`` contributors become 0."""
    return [F.when(F.col(contributors) < least, 0).otherwise(F.col(v)).alias(v) for v in values]


def top_two(records: DataFrame, keys: list[str], contributor: str, value: str) -> DataFrame:
    """Per cell: total, number of contributors, the two largest contributions."""
    each = records.groupBy(*keys, contributor).agg(F.sum(value).alias("_v"))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_v"), contributor))
    nth = lambda k: F.max(F.when(F.col("_r") == k, F.col("_v"))).alias(f"top{k}")
    return each.withColumn("_r", rank).groupBy(*keys).agg(F.sum("_v").alias("total"), F.count("*").alias("contributors"), nth(1), nth(2))


def dominated(total: str, top1: str, top2: str, percent: float):
    """p % rule: what is left beside the two largest is less than p % of the largest."""
    return F.col(total) - F.col(top1) - F.coalesce(F.col(top2), F.lit(0.0)) < percent / 100 * F.col(top1)


@dataclass
class Measure:
    """A column to be noised: ``draw`` makes the noisy value from the value, a uniform and the budget."""

    column: str
    epsilon: float
    draw: Callable[[Column, Column, float], Column]


def laplace_measure(column: str, epsilon: float, sensitivity: float = 1.0) -> Measure:
    return Measure(column, epsilon, lambda value, u, e: value + noise.laplace(u, sensitivity / e))


def composed(plan: dict[str, list[list[Measure]]]) -> tuple[dict[str, list[list[float]]], dict[str, float], float]:
    """Budgets of tables of groups of measures: what each measure gets, what each table spends, and the whole.

    The measures of a group touch no record twice and share the greatest budget among them; groups of a table, and tables, add up.
    """
    if bad := [m for groups in plan.values() for g in groups for m in g if not m.epsilon > 0] or [t for t, groups in plan.items() if not groups or not all(groups)]:
        raise ValueError(f"budgets must be above 0 and groups not empty: {bad}")
    given = {t: [[max(m.epsilon for m in g)] * len(g) for g in groups] for t, groups in plan.items()}
    spent = {t: sum(g[0] for g in groups) for t, groups in given.items()}
    return given, spent, sum(spent.values())


def apply(tables: dict[str, DataFrame], plan: dict[str, list[list[Measure]]], whole: float, keys: dict[str, list[str]], seed: int = 0, as_they_are: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Tables with noisy measures and the ``epsilon`` that each spends. Nothing is drawn unless the plan spends the whole, by 1e-9.

    Refused as well: tables without a plan that are not named in ``as_they_are``, measures that a table lacks or that stand twice. The k-th measure of the plan takes its uniforms from the table's keys and seed + k.
    """
    given, spent, total = composed(plan)
    if abs(total - whole) > 1e-9:
        raise ValueError(f"the plan spends {total}, not {whole}")
    if bare := set(tables) - set(plan) - set(as_they_are):
        raise ValueError(f"tables without noise: {sorted(bare)}")
    out, k = {t: tables[t] for t in as_they_are}, 0
    for t, groups in plan.items():
        names = [m.column for g in groups for m in g]
        if len(set(names)) < len(names) or set(names) - set(tables[t].columns):
            raise ValueError(f"{t}: measures {names} do not fit its columns")
        noisy = {}
        for g, budgets in zip(groups, given[t]):
            for m, e in zip(g, budgets):
                noisy[m.column] = m.draw(F.col(m.column), noise.uniform(*keys[t], seed=seed + k), e)
                k += 1
        out[t] = tables[t].withColumns(noisy).withColumn("epsilon", F.lit(spent[t]))
    return out


def uniforms(spark: SparkSession, rows: int, names: list[str], seed: int = 0) -> DataFrame:
    """A table of ``rows`` numbers (``number``) with several uniforms each, a function of seed, number and place: any part of it can be made anywhere."""
    return spark.range(rows).select(F.col("id").alias("number"), *[noise.uniform(F.col("id"), F.lit(k), seed=seed).alias(name) for k, name in enumerate(names)])


def with_uniforms(frame: DataFrame, by: list[str], given: DataFrame) -> DataFrame:
    """``frame`` with the columns of a table of uniforms, joined by row number in the order ``by`` (nulls first); rows beyond the table are an error, rows equal in ``by`` share their uniforms among them."""
    names = [c for c in given.columns if c != "number"]
    joined = order.numbered(frame, by, "_number").join(given.withColumnRenamed("number", "_number"), "_number", "left")
    checked = F.when(F.col(names[0]).isNull(), F.raise_error(F.lit("more rows than uniforms")).cast("double")).otherwise(F.col(names[0]))
    return joined.withColumn(names[0], checked).drop("_number")

"""Geographic hierarchy jobs: working ids, grouping of children, budgets along paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def split_geocode(geo: Column, widths: dict[str, int]) -> dict[str, Column]:
    """Parts of a fixed-width code; short codes are filled up with X."""
    full, at, out = F.rpad(geo, sum(widths.values()), "X"), 1, {}
    for name, n in widths.items():
        out[name] = F.substring(full, at, n)
        at += n
    return out


def level_and_parent(geo: Column, lengths: list[int], names: list[str], root: str) -> tuple[Column, Column]:
    """Level name by code length and the parent's code (the root's parent is ``root``)."""
    n = F.length(geo)
    level, parent = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (k, name) in enumerate(zip(lengths, names)):
        level = F.when(n == k, name).otherwise(level)
        parent = F.when(n == k, F.lit(root) if i == 0 else F.substring(geo, 1, lengths[i - 1])).otherwise(parent)
    return level, parent


def group_children(units: DataFrame, parent: str, child: str, most: int, even: bool = False) -> DataFrame:
    """Number the groups of at most ``most`` ordered children under each parent; ``even``: sizes differ by one at most."""
    w = W.partitionBy(parent)
    i, n = F.row_number().over(w.orderBy(child)) - 1, F.count("*").over(w)
    u = units.select(parent, child).distinct().withColumn("_i", i).withColumn("_n", n)
    groups = F.ceil(F.col("_n") / most)
    number = F.floor(F.col("_i") * groups / F.col("_n")) if even else F.floor(F.col("_i") / most)
    return u.withColumn("group", number.cast("int")).drop("_i", "_n")


def renumber(units: DataFrame, parent: str, child: str) -> DataFrame:
    """Dense child numbers under each parent, zero-padded to the width of the largest family."""
    u = units.select(parent, child).distinct().withColumn("_i", F.row_number().over(W.partitionBy(parent).orderBy(child)))
    width = F.broadcast(u.groupBy(parent).agg(F.count("*").alias("_k")).agg(F.length(F.max("_k").cast("string")).alias("_w")))
    return u.crossJoin(width).withColumn("code", F.expr("lpad(cast(_i as string), _w, '0')")).drop("_i", "_w")


def entity_distance(blocks: DataFrame, geo: str, lengths: list[int], inside: str) -> DataFrame:
    """Units to add or subtract to form an off-hierarchy area, from (geo, entity, inside 0/1): per entity at the root.

    Going up, c = min(sum c, sum c' + 1) and c' = min(sum c + 1, sum c'), where c forms the
    area's part in a unit and c' the rest of it.
    """
    f = blocks.select("entity", geo, F.col(inside).cast("long").alias("c"), (1 - F.col(inside)).cast("long").alias("r"))
    for n in lengths:
        s = f.groupBy("entity", F.substring(geo, 1, n).alias(geo)).agg(F.sum("c").alias("c"), F.sum("r").alias("r"))
        f = s.select("entity", geo, F.least("c", F.col("r") + 1).alias("c"), F.least(F.col("c") + 1, "r").alias("r"))
    return f.select("entity", F.col("c").alias("distance"))


def bypass(budgets: DataFrame, parent_of: Column, parents: DataFrame | None = None, most: int = 0) -> DataFrame:
    """(geo, share) of one level: children that are alone under their parent hand their share up; both levels' new shares.

    With ``parents`` (parent, parent_share) also families of up to ``most`` children whose least share k fulfils
    2 * k >= (children - 1) * parent_share: there the parent gets the least share and is passed by.
    """
    family = W.partitionBy("parent")
    b = budgets.withColumn("parent", parent_of).withColumn("_k", F.count("*").over(family)).withColumn("_least", F.min("share").over(family))
    away = F.col("_k") == 1
    if parents is not None:
        b = b.join(parents.select("parent", F.col("parent_share").alias("_up")), "parent", "left")
        away = away | ((F.col("_k") <= most) & (2 * F.col("_least") >= (F.col("_k") - 1) * F.col("_up")))
    b = b.withColumn("_away", F.coalesce(away, F.lit(False)))
    return b.select("parent", "geo", F.when(F.col("_away"), F.col("share") - F.col("_least")).otherwise(F.col("share")).alias("share"), F.when(F.col("_away"), F.col("_least")).otherwise(0.0).alias("to_parent"))


NOWHERE = "99999"  # fixed value: the code of no area


def crosswalk(reference: DataFrame, districts: dict[str, list[tuple[int, int, str]]] | None = None) -> DataFrame:
    """Level ids of every block of a reference file (state, county, tract, block, place, cousub, upper, lower, school, urban, vtd, tribal).

    Ids are the code of the state before the area's own; areas within a county have that too. ``districts``: name -> intervals (first tract, last
    tract, code) that deal tracts to districts. Blocks are of 15 digits, their group is the first of the block's own;
    the off-spine entity is the tribal area, else the place, else the subdivision.
    """
    c = F.col
    state, county = c("state"), F.concat("state", "county")
    tract = F.concat(county, "tract")
    within = {"place_id": (state, "place"), "upper_id": (state, "upper"), "lower_id": (state, "lower"), "school_id": (state, "school"), "cousub_id": (county, "cousub"), "vtd_id": (county, "vtd")}
    ids = {name: F.concat(above, c(own)) for name, (above, own) in within.items()}
    named = {}
    for name, intervals in (districts or {}).items():
        code = F.lit(None).cast("string")
        for first, last, label in reversed(intervals):
            code = F.when(c("tract").cast("int").between(first, last), label).otherwise(code)
        named[name] = code
    tribal = c("tribal") != NOWHERE
    entity = F.when(tribal, F.concat(F.lit("T"), "tribal")).when(c("place") != NOWHERE, F.concat(F.lit("P"), state, "place")).otherwise(F.concat(F.lit("S"), county, "cousub"))
    return reference.select(
        *reference.columns, county.alias("county_id"), tract.alias("tract_id"), F.concat(tract, F.substring("block", 1, 1)).alias("group_id"), F.rpad(F.concat(tract, "block"), 15, "0").alias("block15"),
        *[x.alias(n) for n, x in ids.items()], F.when(c("urban") == "", "rural").otherwise(c("urban")).alias("urban_id"), tribal.alias("is_tribal"), F.when(tribal, c("tribal")).alias("tribal_id"),
        F.concat(state, F.when(tribal, "1").otherwise("0")).alias("state_part"), entity.alias("entity"), *[x.alias(n) for n, x in named.items()],
    )


def classify(reference: DataFrame, tribal: list[tuple[int, int]], strong: list[str]) -> DataFrame:
    """Per block: state, tribal (its area code lies in one of the intervals), county or tribal code, place or subdivision, tract, block, primitive unit.

    States in ``strong`` govern by subdivision, the others by place; where there is no place, the subdivision stands in.
    Inside a tribal area its code takes the county's part. The primitive unit is what blocks are grouped by: county part and area.
    """
    code = F.col("tribal").cast("int")
    is_tribal = F.lit(False)
    for first, last in tribal:
        is_tribal = is_tribal | code.between(first, last)
    county = F.when(is_tribal, F.concat(F.lit("T"), "tribal")).otherwise(F.concat("state", "county"))
    area = F.when(F.col("state").isin(strong) | (F.col("place") == NOWHERE), F.concat(F.lit("S"), "cousub")).otherwise(F.concat(F.lit("P"), "place"))
    return reference.select("state", "tract", "block", F.coalesce(is_tribal, F.lit(False)).alias("is_tribal"), county.alias("county_part"), area.alias("area"), F.concat_ws("-", county, area).alias("primitive"))


def working_ids(blocks: DataFrame, groups: DataFrame, geo: str, widths: dict[str, int], key: str | None = None) -> DataFrame:
    """``working`` id of each block: tribal flag, parts of its code, group, whole code; blocks without a group get group 0.

    ``widths``: name -> width of the parts in the order of the working id; ``group`` is the number in ``groups`` (key, group, tribal), the others are cut from the code.
    ``key`` tells rows of ``blocks`` apart where several share a code (the code itself by default); each has one row in ``groups`` at most.
    """
    key = key or geo
    j = blocks.select(*dict.fromkeys((key, geo))).join(groups.select(key, "group", "tribal"), key, "left")
    parts, at = [], 1
    for name, n in widths.items():
        if name == "group":
            parts.append(F.lpad(F.coalesce("group", F.lit(0)).cast("string"), n, "0"))
        else:
            parts.append(F.substring(geo, at, n))
            at += n
    return j.select(geo, F.concat(F.when(F.coalesce("tribal", F.lit(False)), "1").otherwise("0"), *parts, F.lit("-"), geo).alias("working"))


def original_ids(working: Column) -> Column:
    """Block code of a working id, whatever the widths of its parts."""
    return F.element_at(F.split(working, "-"), -1)


def facility_signature(units: DataFrame, geo: str, kind: str, kinds: list[str]) -> DataFrame:
    """String of 0 and 1: which kinds of facility a block has."""
    return units.groupBy(geo).agg(F.concat(*[F.max(F.when(F.col(kind) == k, "1").otherwise("0")) for k in kinds]).alias("signature"))

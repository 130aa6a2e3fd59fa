"""Recodes as column expressions: no row functions, so filters and pruning pass through them."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_recodes(frame: DataFrame, recodes: dict[str, Column]) -> DataFrame:
    """Add recoded columns; rows that a recode leaves null are dropped."""
    out = frame.withColumns(recodes)
    return out.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in recodes]))


def combination_index(flags: list[str]) -> Column:
    """k 0/1 flags -> 0..2**k-2: by number of flags set, then lexicographically by which ones; none set: null."""
    order = [c for n in range(1, len(flags) + 1) for c in combinations(range(len(flags)), n)]
    mask = reduce(lambda a, b: a + b, [F.col(f).cast("int") * (1 << i) for i, f in enumerate(flags)])
    index = F.create_map(*[F.lit(x) for i, c in enumerate(order) for x in (sum(1 << k for k in c), i)])
    return F.try_element_at(index, mask)


def groups_alone_or_combined(flags: list[str]) -> Column:
    """Names of all flags set: a row counts in each (overlapping groups)."""
    return F.array_compact(F.array(*[F.when(F.col(f) == 1, F.lit(f)) for f in flags]))


def bands(value: Column, starts: list[int], top: int | None = None) -> Column:
    """Number of the band that holds a value, by ascending band starts; values above ``top`` count as ``top``."""
    v = F.least(value, F.lit(top)) if top is not None else value
    return (sum((F.when(v >= s, 1).otherwise(0) for s in starts), F.lit(0)) - 1).cast("int")


def topcode(value: Column, most: int, least: int = 0) -> Column:
    """Values above ``most`` become ``most``; below ``least`` null."""
    return F.when(value >= least, F.least(value, F.lit(most)))


def lookup(codes: Column, table: dict) -> Column:
    """Value of a fixed table by code; an unknown code gives null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), codes)


def candidates(columns: dict[str, dict]) -> Column:
    """Least common member of the candidate sets (arrays) given by coded columns; null if there is none or a code is unknown."""
    sets = [lookup_array(F.col(c), t) for c, t in columns.items()]
    return F.array_min(reduce(F.array_intersect, sets))


def lookup_array(codes: Column, table: dict[object, list[int]]) -> Column:
    out = F.lit(None).cast("array<int>")
    for k, members in table.items():
        out = F.when(codes == k, F.array(*map(F.lit, members))).otherwise(out)
    return out


def filler(kind: str, length: int, supported: bool) -> Column:
    """Filler of a field that isn't in universe (zeros) or not supported (nines), by type and length."""
    text = ("0" if supported else "9") * length
    return F.lit(int(text)) if kind == "int" else F.lit(text)


def level_labels(index: Column, labels: list[str]) -> Column:
    """Label of a level number; unknown numbers give '-1'."""
    return F.coalesce(F.get(F.array(*map(F.lit, labels)), index), F.lit("-1"))


def relationship_or_facility(relationship: Column, facility: Column, size: Column, relatives: int, facilities: list[str]) -> Column:
    """One code for how a person lives: 0 householder alone, 1 householder with others, 2.. other relationships, then one for each kind of facility.

    ``relationship`` counts from 0, the householder, to ``relatives``; ``facility`` is null in households; ``size`` is the
    number of persons in the unit. Others: null.
    """
    where = F.array_position(F.array(*map(F.lit, facilities)), facility)
    kin = F.when(relationship == 0, F.when(size == 1, 0).otherwise(1)).when(relationship.between(1, relatives), 1 + relationship)
    return F.when(facility.isNull(), kin).when(where > 0, relatives + 1 + where).cast("int")


def packed(flags: list[Column], sizes: list[int]) -> Column:
    """Mixed-radix number of several small codes, the first the most significant: the key of a lookup table."""
    out = F.lit(0)
    for flag, size in zip(flags, sizes):
        out = out * size + flag
    return out


def by_table(frame: DataFrame, key: Column, table: DataFrame, code: str, out: str) -> DataFrame:
    """``out``: code of each row's key in a table (key, code); null where the table lacks it."""
    return frame.withColumn("_key", key).join(table.select(F.col("key").alias("_key"), F.col(code).alias(out)), "_key", "left").drop("_key")


def origin_and_race(hispanic: Column, race: Column, races: int) -> Column:
    """Two-way code: race, and race + ``races`` for those of the origin; null outside."""
    return F.when(race.between(0, races - 1) & hispanic.isin(0, 1), hispanic * races + race).cast("int")


#: Codes of couples: none, married of opposite sex, married of same sex, cohabiting of opposite sex, cohabiting of same sex.
COUPLES = ["no_partner", "married_opposite", "married_same", "cohabiting_opposite", "cohabiting_same"]


def household_flags(children: Column, couple: Column, relatives: Column, size: Column, generations: Column) -> dict[str, Column]:
    """0/1 flags of a household: ``children`` 0 none, 1 under 6, 2 of 6 to 17, 3 both; ``couple`` by COUPLES; ``relatives`` 0/1; persons; generations.

    A household of one has no partner, relatives or children of its own, whatever its codes say; null codes give null flags.
    """
    shared = size > 1
    of = lambda c: c.cast("int")
    kids = F.when(shared, children).otherwise(F.when(size == 1, 0))
    pair = F.when(shared, couple).otherwise(F.when(size == 1, 0))
    family = F.when(shared, (pair.isin(1, 2)) | (relatives == 1) | (kids > 0)).otherwise(F.when(size == 1, F.lit(False)))
    flags = {"child_under_6_only": kids == 1, "child_6_to_17_only": kids == 2, "child_both": kids == 3, "no_child": kids == 0}
    flags |= {name: pair == k for k, name in enumerate(COUPLES)}
    flags |= {"married": pair.isin(1, 2), "cohabiting": pair.isin(3, 4), "with_relatives": shared & (relatives == 1), "family": family, "alone": size == 1, "not_alone": shared}
    flags |= {"three_generations": generations >= 3, "couple_with_child": (pair > 0) & (kids > 0), "couple_without_child": (pair > 0) & (kids == 0), "single_with_child": (pair == 0) & (kids > 0), "others_only": shared & ~family & (pair == 0)}
    return {name: of(c) for name, c in flags.items()}


def published_household(flags: dict[str, Column], sex: Column, age: Column, oldest: Column, adults: Column) -> dict[str, Column]:
    """Codes of a published household record from :func:`household_flags`, the householder's sex (1, 2) and age, the oldest person's age and the number of adults.

    Type: 1 married, 2 other family of a man, 3 of a woman, 4 alone man, 5 man not alone, 6 alone woman, 7 woman not alone. With cohabiting: 1 married with own
    children, 2 without, 3 cohabiting with, 4 without, 5 to 8 no partner, by man or woman and alone or not. Presence codes are 1 for none and 2 for some.
    """
    is_ = lambda name: flags[name] == 1
    man = sex == 1
    some = lambda c: F.when(c, "2").otherwise("1")
    kind = F.when(is_("married"), "1").when(is_("family"), F.when(man, "2").otherwise("3")).when(man, F.when(is_("alone"), "4").otherwise("5")).otherwise(F.when(is_("alone"), "6").otherwise("7"))
    wide = F.when(is_("married"), F.when(is_("no_child"), "2").otherwise("1")).when(is_("cohabiting"), F.when(is_("no_child"), "4").otherwise("3")).when(man, F.when(is_("alone"), "5").otherwise("6")).otherwise(F.when(is_("alone"), "7").otherwise("8"))
    couple = F.when(is_("married_opposite"), "1").when(is_("married_same"), "2").when(is_("cohabiting_opposite"), "3").when(is_("cohabiting_same"), "4").otherwise("5")
    child = F.when(is_("child_under_6_only"), "1").when(is_("child_6_to_17_only"), "2").when(is_("child_both"), "3").otherwise("0")
    codes = {"hht": kind, "hht2": wide, "cplt": couple, "upart": F.when(is_("cohabiting"), F.when(man, "1").otherwise("2")).otherwise("5"), "multg": some(is_("three_generations"))}
    codes |= {"paoc": child, "hhldrage": F.lpad((bands(age, [0, 15, 25, 35, 45, 55, 60, 65, 75]) + 1).cast("string"), 2, "0"), "p18": some(adults > 0)}
    return codes | {f"p{y}": some(oldest >= y) for y in (60, 65, 75)} | {"hhsex": sex.cast("string")}

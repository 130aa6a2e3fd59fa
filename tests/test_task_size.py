"""Bound on what adaptive execution packs into one task of the registered queries."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import base
from tessera.sources import files
from tests.conftest import SF


@pytest.mark.parametrize("given, after", [("64MB", 16 << 20), ("67108864b", 16 << 20), ("1g", 16 << 20), ("16m", None), ("8m", None), ("16k", None)])
def test_tables_lower_the_size_of_a_task(spark, given, after):
    before = spark.conf.get(base.ADVISORY)
    try:
        spark.conf.set(base.ADVISORY, given)
        base.table(spark, SF, "nation")
        assert spark.conf.get(base.ADVISORY) == (given if after is None else f"{after}b")
    finally:
        spark.conf.set(base.ADVISORY, before)


def test_lines_of_one_name_are_written_by_many_tasks(spark, tmp_path):
    lines = spark.range(0, 400, 1, 4).select(F.col("id").cast("string").alias("value"))
    files.write_named(lines, str(tmp_path / "out"), F.lit("all_1.txt"))
    assert len(list((tmp_path / "out" / "file=all_1.txt").glob("part-*"))) == 4
    back = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "out"))
    assert sorted(int(r.value) for r in back.select("value").collect()) == list(range(400))


def test_more_names_than_open_files_are_written_whole(spark, tmp_path):
    names = 3 * files.OPEN_FILES
    before = spark.conf.get(files.WRITERS)
    lines = spark.range(0, 4 * names, 1, 2).select(F.col("id").cast("string").alias("value"))
    files.write_named(lines, str(tmp_path / "out"), F.concat(F.lit("of_"), (F.col("value").cast("int") % names).cast("string"), F.lit(".txt")))
    assert spark.conf.get(files.WRITERS) == before
    back = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "out")).select("value", files.file_part().alias("name"))
    assert sorted((int(r.value), int(r.name)) for r in back.collect()) == [(i, i % names) for i in range(4 * names)]

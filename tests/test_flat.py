"""Intervals of regions as rows."""

from lociframe.operators import regions as rg
from lociframe.sources import formats as fm

REGION = "label string, intervals array<struct<chrom:string,strand:string,start:bigint,stop:bigint>>"


def test_regions_without_intervals_have_no_rows(spark):
    df = spark.createDataFrame([("a", [("c", "+", 1, 2), ("c", "-", 5, 9)]), ("none", []), ("null", None)], REGION)
    assert sorted(map(tuple, rg.flat(df).collect())) == [("a", 0, "c", "+", 1, 2), ("a", 1, "c", "-", 5, 9)]


def test_alignments_written_and_read_are_not_worked_out_for_a_filter(spark, tmp_path):
    path = str(tmp_path / "sam")
    spark.createDataFrame([("r\t0\tc\t11\t60\t5S20M7N3D10M\t*\t0\t0\t*\t*",)], "value string").write.parquet(path)
    once = fm.parse_sam(spark.read.parquet(path))
    twice = rg.flat(fm.parse_sam(fm.sam_lines(fm.edited_sam(rg.shift(once, 5, 5)))))
    assert len(twice._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    assert sorted((r.k, r.start, r.stop) for r in twice.collect()) == [(0, 16, 35), (1, 43, 55)]

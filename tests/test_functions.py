import pytest
from pyspark.sql import functions as F

from trendlake.functions import numeric, text
from trendlake.sources.tables import assert_schema, bounded_to_pandas, select_existing


def test_display_formats(spark):
    df = spark.createDataFrame([(0.975, 1.0, "Ünïcode title that is rather long indeed, yes", None)],
                               "p double, y double, title string, cat string")
    r = df.select(
        text.percent_string("p").alias("pct"), text.yes_no("y").alias("yn"), text.yes_no(F.lit(0.5)).alias("other"),
        text.short_label("title", 10).alias("short"), text.prefix("title", 5).alias("pre"),
        text.null_label("cat").alias("cat"), text.ascii_only(F.lit(None).cast("string")).alias("empty"),
    ).first()
    assert (r.pct, r.yn, r.other, r.short, r.pre, r.cat, r.empty) == (
        "97.5%", "Yes", None, "ncode titl...", "Ünïco", "None", "")


def test_numeric_helpers(spark):
    df = spark.createDataFrame([(3, 0, None), (3, 6, 1.0)], "a int, b int, c double")
    rows = df.select(numeric.guarded_ratio("a", "b").alias("r"), numeric.row_max("c", F.lit(None)).alias("m"),
                     numeric.log1p(F.lit(-1)).alias("l")).collect()
    assert rows[0].r is None and rows[1].r == 0.5
    assert rows[0].m is None and rows[1].m == 1.0
    assert rows[0].l is None


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert_schema(df, ["a", "b"])
    with pytest.raises(AssertionError):
        assert_schema(df, ["a", "zz"])
    assert select_existing(df, ["b", "zz", "a"]).columns == ["b", "a"]
    assert len(bounded_to_pandas(df, 5)) == 1
    with pytest.raises(ValueError):
        bounded_to_pandas(df, 0)

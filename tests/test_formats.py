"""Display formats against Python's own formatting on typical values."""

from pyspark.sql import functions as F

from weeklens.functions import fmt as FM

VALUES = [0.123456, -0.0004, 1234.5, -98765.4321, 0.125, 0.0, 12.5, 0.98765, 1500000.0, -3.14159]


def test_formats_match_python(spark):
    df = spark.createDataFrame([(v,) for v in VALUES] + [(None,)], "x double")
    x = F.col("x")
    rows = df.select(
        "x", FM.fmt_pct(x).alias("pct"), FM.fmt_currency(x).alias("cur"), FM.fmt_num(x, 0, commas=True).alias("cnt"),
        FM.fmt_num(x, 2, plus=True).alias("p2"), FM.fmt_num(x, 3).alias("d3"), FM.format_change(x).alias("chg"),
        FM.format_value(x, F.lit("ratio")).alias("fv"),
    ).collect()
    for r in rows:
        if r.x is None:
            assert r.chg == "N/A" and r.fv == "N/A" and r.pct is None
            continue
        v = r.x
        assert (r.pct, r.cur, r.cnt, r.p2, r.d3, r.chg, r.fv) == (
            f"{v:.1%}", f"${v:,.2f}", f"{v:,.0f}", f"{v:+.2f}", f"{v:.3f}",
            f"{'+' if v > 0 else ''}{v:.1%}", f"{v:.1%}"), v

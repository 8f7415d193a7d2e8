"""Cleaning, reshape and checks on literal raw sheets."""

from weeklens.operators import prep


def test_clean_dedup_before_trim_and_coercion(spark):
    raw = spark.createDataFrame(
        [(" CO ", "Bogota", "Chapinero\t", "Wealthy", "Prioritized", "Perfect Orders", "0.5", "x"),
         (" CO ", "Bogota", "Chapinero\t", "Wealthy", "Prioritized", "Perfect Orders", "0.5", "x"),
         ("CO", "Bogota", "Chapinero", "Wealthy", "Prioritized", "Perfect Orders", "0.5", "x")],
        "` COUNTRY` string, CITY string, ZONE string, ZONE_TYPE string, ZONE_PRIORITIZATION string,"
        " METRIC string, L1W_ROLL string, L0W_ROLL string",
    )
    out = prep.clean_metrics(raw).collect()
    assert len(out) == 2  # identical rows collapse; rows differing only in blanks survive
    assert {r.COUNTRY for r in out} == {"CO"} and {r.ZONE for r in out} == {"Chapinero"}
    assert all(r.L1W == 0.5 and r.L0W is None for r in out)


def test_melt_long_keeps_nulls(spark):
    wide = spark.createDataFrame([("Z", "M", 1.0, None)], "ZONE string, METRIC string, L1W double, L0W double")
    rows = {r.week_label: r for r in prep.melt_long(wide).collect()}
    assert rows["L0W"].week_index == 8 and rows["L0W"].has_value is False
    assert rows["L1W"].weeks_ago == 1 and rows["L1W"].value == 1.0


def test_key_uniqueness_and_expect_checks(spark):
    mw = spark.createDataFrame(
        [("CO", "B", "Z", "Wealthy", "P", "M", 1.0, 1.0), ("CO", "B", "Z", "Rich", "P", "M", 1.0, None)],
        "COUNTRY string, CITY string, ZONE string, ZONE_TYPE string, ZONE_PRIORITIZATION string, METRIC string,"
        " L1W double, L0W double",
    )
    assert prep.key_uniqueness(mw).collect()[0].n_rows == 2
    ow = spark.createDataFrame([("CO", "B", "Z", "Orders", -1.0, 5.0)],
                               "COUNTRY string, CITY string, ZONE string, METRIC string, L1W double, L0W double")
    res = {r.rule: r.violations for r in prep.expect_checks(mw, ow, ["CO"], ["Wealthy", "Non Wealthy"]).collect()}
    assert res["zone_type_domain"] == 1 and res["orders_nonneg_l1w"] == 1 and res["orders_nonneg_l0w"] == 0

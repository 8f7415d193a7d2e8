"""Sinks round trip, dictionary reader, and the text jobs on literal rows."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from weeklens.operators import text as X
from weeklens.sources import sinks, tables


def test_export_csv_round_trip(spark):
    df = spark.createDataFrame([("a", 1.5, 2), ("b", None, 3)], "k string, v double, n bigint")
    path = os.path.join(tempfile.mkdtemp(prefix="weeklens-csv-"), "out")
    sinks.export_csv(df, path)
    back = sinks.read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_materialize_round_trip(spark):
    from conftest import make_frames
    fr = make_frames(spark, [{"ZONE": "A", "METRIC": "Orders", "weeks": [1, 2]},
                             {"ZONE": "B", "METRIC": "Perfect Orders", "weeks": [0.5]}])
    path = os.path.join(tempfile.mkdtemp(prefix="weeklens-fact-"), "fact")
    back = sinks.materialize(fr.fact, path)
    assert back.count() == 2 and back.filter(F.col("METRIC") == "Orders").first().L0W == 2.0


def test_dictionary_reader(spark):
    d = {"metrics": {"Perfect Orders": {"higher_is_better": True, "aliases": ["perfect order", "po"],
                                        "unit": "ratio", "expected_range": [0, 1.0]}},
         "zone_types": {}, "zone_prioritization": {}, "countries": {"CO": ["colombia", "co"]}}
    path = os.path.join(tempfile.mkdtemp(prefix="weeklens-dict-"), "d.json")
    with open(path, "w") as f:
        json.dump(d, f)
    attrs, aliases = tables.load_metric_dictionary(spark, path)
    assert attrs.first().range_hi == 1.0 and aliases.count() == 2


def _labels(spark, values):
    return spark.createDataFrame([(0, i, v, v, v, v) for i, v in enumerate(values)],
                                 "conv_id long, turn long, label string, country_label string,"
                                 " zone_type_label string, priority_label string")


def test_resolve_metric_steps(spark):
    got = {r.label: r.canonical for r in X.resolve_labels(_labels(spark, [
        "Lead Penetration", "lead pen", "perfect order", "gross profit", "markdowns", "lead penetracion",
        "zxkqwerty"])).collect()}
    assert got == {"Lead Penetration": "Lead Penetration", "lead pen": "Lead Penetration",
                   "perfect order": "Perfect Orders", "gross profit": "Gross Profit UE",
                   "markdowns": "Restaurants Markdowns / GMV", "lead penetracion": "Lead Penetration",
                   "zxkqwerty": None}


def test_resolve_country_and_zone_type(spark):
    got = {r.country_label: r.country for r in X.resolve_country(_labels(spark, ["colombia", "mexico", "CO", "brasil"])).collect()}
    assert got == {"colombia": "CO", "mexico": "MX", "CO": "CO", "brasil": "BR"}
    got = {r.zone_type_label: r.zone_type for r in X.resolve_zone_type(_labels(spark, ["wealthy", "non wealthy", "no rico"])).collect()}
    assert got == {"wealthy": "Wealthy", "non wealthy": "Non Wealthy", "no rico": "Non Wealthy"}


def test_context_carry_and_gazetteer(spark):
    msgs = spark.createDataFrame([
        (1, 0, "user", "top 5 zonas con mayor lead penetration en colombia"),
        (1, 1, "user", "y ahora la evolución en chapinero"),
        (1, 2, "user", "mismo análisis, misma zona"),
    ], "conv_id long, turn long, role string, q string")
    mw = spark.createDataFrame([("CO", "Bogota", "Chapinero")], "COUNTRY string, CITY string, ZONE string")
    rows = {r.turn: r for r in X.context_carry(msgs, mw).collect()}
    assert rows[0].metric == "Lead Penetration" and rows[0].country == "CO"
    assert rows[1].metric == "Lead Penetration" and rows[1].country == "CO" and rows[1].zone == "Chapinero"
    assert rows[2].zone == "Chapinero"


def test_carry_last_across_chunks(spark):
    df = spark.createDataFrame([(1, t, "x" if t in (3, 9000) else None) for t in range(0, 10000, 3)],
                               "c long, t long, v string")
    out = {r.t: r.v_before for r in X.carry_last(df, "c", "t", ["v"], chunk=1000).collect()}
    assert out[0] is None and out[3] is None and out[6] == "x" and out[8997] == "x" and out[9003] == "x"

"""The state from summaries against a row-by-row replay of the original's rules."""

import random
import re

import pytest

from weeklens.operators import text as X

PLACES = {"north": ("North", "Lima", "PE"), "centro": ("Centro", "Bogota", "CO"), "sur": ("SUR", "Quito", "EC")}


def replay(turns):
    """turns of one conversation in order -> [(metric, country, city, zone)]."""
    last = {"metric": None, "country": None, "zone": None}
    out = []
    for t in turns:
        metric = t["metric"] or last["metric"]
        if t["intent"] == "multivariable":
            metric = None
        country, zone, city = t["country"], t["zone"], t["city"]
        if not country and last["country"] and t["follow_country"]:
            country = last["country"]
        if not zone and last["zone"] and t["follow_zone"]:
            zone = last["zone"]
        if zone and zone.strip().lower() in PLACES:
            name, place_city, place_country = PLACES[zone.strip().lower()]
            zone, city, country = name, city or place_city, country or place_country
        last = {"metric": metric or last["metric"], "country": country or last["country"], "zone": zone or last["zone"]}
        out.append((metric, country, city, zone))
    return out


def frames(spark, turns):
    zones = spark.createDataFrame([(k, *v) for k, v in PLACES.items()], "zone_lower string, ZONE string, CITY string, COUNTRY string")
    schema = ("conv_id long, turn long, intent string, metric string, country string, zone string, city string, "
              "follow_country boolean, follow_zone boolean")
    return spark.createDataFrame([tuple(t.values()) for t in turns], schema), zones


@pytest.mark.parametrize("chunk", [1, 3, 7, 4096])
def test_random_conversations(spark, chunk):
    rnd = random.Random(chunk)
    turns = []
    for conv in range(120):
        for turn in sorted(rnd.sample(range(60), rnd.choice([1, 2, 5, 25]))):
            turns.append({"conv_id": conv, "turn": turn, "intent": rnd.choice(["trend", "ranking", "multivariable"]),
                          "metric": rnd.choice([None, None, "A", "B"]), "country": rnd.choice([None] * 5 + ["MX", "BR"]),
                          "zone": rnd.choice([None] * 4 + ["north", "centro", "sur", "elsewhere"]), "city": rnd.choice([None, None, None, "Cali"]),
                          "follow_country": rnd.random() < 0.5, "follow_zone": rnd.random() < 0.5})
    shuffled = rnd.sample(turns, len(turns))
    got = {(r.conv_id, r.turn): (r.metric, r.country, r.city, r.zone) for r in X.conversation_state(*frames(spark, shuffled), chunk=chunk).collect()}
    want = {}
    for conv in range(120):
        own = [t for t in turns if t["conv_id"] == conv]
        want |= {(conv, t["turn"]): s for t, s in zip(own, replay(own))}
    assert got == want


def test_empty_table(spark):
    df, zones = frames(spark, [])
    assert X.conversation_state(df, zones).collect() == []


def test_from_messages_on_repaired_locations(spark):
    mw = spark.createDataFrame([("Chapinero", "Bogota", "CO"), ("Condesa", "Mexico DF", "MX"), ("Norte", "Cali", "CO"), ("Norte", "Quito", "EC")],
                               "ZONE string, CITY string, COUNTRY string")
    said = ["perfect orders en chapinero", "y ahora la tendencia", "lead penetration in norte", "and now the same zone", "gross profit ue",
            "top zonas en brasil", "y ahora en condesa"]
    rows = [(1, i, "user", t) for i, t in enumerate(said)] + [(1, 99, "assistant", "markdowns en condesa, mexico")]
    out = X.context_carry(spark.createDataFrame(rows, "conv_id long, turn long, role string, q string"), mw)
    got = {r.turn: (r.metric, r.country, r.city, r.zone) for r in out.collect()}
    assert got == {0: ("Perfect Orders", "CO", "Bogota", "Chapinero"), 1: ("Perfect Orders", "CO", None, None),
                   2: ("Lead Penetration", None, None, "norte"), 3: ("Lead Penetration", "CO", None, "norte"),
                   4: ("Gross Profit UE", None, None, None), 5: ("Gross Profit UE", "BR", None, None),
                   6: ("Gross Profit UE", "BR", "Mexico DF", "Condesa")}


def test_few_shuffles_over_the_tables(spark):
    from weeklens.plans.registry import QUERIES

    out = QUERIES["context_carry"](spark, "/root/testdata/sf0.001")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shuffles = re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|RoundRobin)", plan)
    assert 0 < len(shuffles) <= 5 and "NestedLoopJoin" not in plan and "conversations" not in plan

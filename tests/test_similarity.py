"""Dictionary joins against the plain comparison of every pair."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from weeklens.catalog import REFERENCE_CATALOG
from weeklens.operators import text as X
from weeklens.sources import requests as RQ

FOLD = str.maketrans("áéíóúñ", "aeioun")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute(catalog, raw):
    r, found = raw.strip(" \t\n\r").lower(), []
    for i, m in enumerate(catalog.metrics):
        for j, (e, kind) in enumerate([(m.name.lower(), "canonical"), *((a.lower(), "alias") for a in m.aliases)]):
            fr, fe = r.translate(FOLD), e.translate(FOLD)
            longer = max(len(fr), len(fe))
            if r == e:
                found.append((1 if kind == "canonical" else 2, 0.0, i, j, m.name))
            elif r in e or kind == "alias" and e in r:
                found.append((3, 0.0, i, j, m.name))
            elif kind == "alias" and longer and min(len(fr), len(fe)) >= longer * 0.6 and 1.0 - distance(fr, fe) / longer >= 0.6:
                found.append((4, -(1.0 - distance(fr, fe) / longer), i, j, m.name))
    return (min(found)[4], min(found)[0]) if found else None


def resolved(spark, catalog, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return {r.v: (r.canonical, r.step) for r in X.resolve_metric_table(df, "v", catalog).collect()}


def altered(rnd, s):
    out = list(s)
    for _ in range(rnd.randint(0, max(1, len(s) // 2))):
        at, kind = rnd.randrange(len(out) + 1), rnd.random()
        if kind < 0.35:
            out.insert(at, rnd.choice("abcdeóñ %"))
        elif kind < 0.7 and out:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rnd.choice("abcdeé-")
    return "".join(out)


@pytest.mark.parametrize("seed", range(3))
def test_every_step_against_all_pairs(spark, seed):
    rnd = random.Random(seed)
    entries = [e for m in REFERENCE_CATALOG.metrics for e in (m.name, *m.aliases)]
    values = {altered(rnd, rnd.choice(entries)) for _ in range(250)} | {rnd.choice(entries)[: rnd.randint(1, 14)] for _ in range(60)}
    values |= {f"x {rnd.choice(entries)} y" for _ in range(30)} | {" ", "  Orders ", "a", "?", "lead 🙂 pen", "ñ", "zxkqwerty", "e" * 300}
    values.discard("")
    got = resolved(spark, REFERENCE_CATALOG, sorted(values))
    assert got == {v: b for v in values if (b := brute(REFERENCE_CATALOG, v))}
    assert {s for _, s in got.values()} == {1, 2, 3, 4}


def test_a_dictionary_of_100_000_aliases(spark):
    rnd = random.Random(0)
    first = REFERENCE_CATALOG.metrics[0]
    letters = "abcdefghijklmnopqrstuvwxyz"
    metrics = [replace(first, name=f"metric {i:05d}", aliases=tuple(
        "".join(rnd.choices(letters, k=rnd.randint(9, 16))) for _ in range(10))) for i in range(10_000)]
    catalog = replace(REFERENCE_CATALOG, metrics=tuple(metrics))
    picked = [m for m in rnd.sample(metrics, 30)]
    values = [altered(rnd, m.aliases[3]) for m in picked[:15]] + [m.aliases[5] for m in picked[15:20]] + [
        f"of {m.aliases[1]} now" for m in picked[20:25]] + [m.name for m in picked[25:]] + ["q"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = X.resolve_metric_table(df, "v", catalog)
    got = {r.v: (r.canonical, r.step) for r in out.collect()}
    assert "NestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()
    for v in [*values[:3], *values[15:17], *values[20:22], *values[25:27], "q"]:
        assert got.get(v) == brute(catalog, v), v


@pytest.mark.parametrize("key", ["resolve_labels", "metric_tag", "normalize_requests"])
def test_no_nested_loops_in_the_final_plans(spark, key):
    from weeklens.plans.registry import QUERIES

    df = QUERIES[key](spark, "/root/testdata/sf0.001")
    df.collect()
    assert "NestedLoopJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_gazetteer_candidates_do_not_grow_with_the_names(spark):
    names = spark.range(100_000).select(F.format_string("Supplier#%09d", F.col("id")).alias("ZONE"),
                                        F.format_string("Town%d", F.col("id") % 30).alias("CITY"))
    texts = [(1, 1, "what of supplier#000000017 and supplier#000099999x"), (1, 2, "town1 or town12?"), (2, 1, "nothing"), (2, 2, ""),
             (3, 1, "x" * 5000 + "supplier#000000001"), (3, 2, "town29 in supplier#00001"), (4, 1, None)]
    messages = spark.createDataFrame(texts, "conv_id long, turn long, q string")
    got = {(r.conv_id, r.turn): (r.zone, r.city) for r in X.gazetteer_tag(messages, names).collect()}
    assert got == {(1, 1): ("supplier#000000017", None), (1, 2): (None, "town12"), (2, 1): (None, None), (2, 2): (None, None),
                   (3, 1): ("supplier#000000001", None), (3, 2): (None, "town29"), (4, 1): (None, None)}
    lengths = X.gazetteer(names).select("name_len").distinct().count()
    assert lengths == 3  # so a text has at most three keys for each of its characters


def test_the_keys_of_the_similarity_are_not_shuffled_for_a_small_dictionary(spark):
    """Only the best hit of each string is: a string has up to hundreds of keys, which spilled many times the input."""
    from weeklens.functions import text_rules as T
    from weeklens.operators.similarity import similar

    entries = X.metric_entries(spark).filter("kind = 'alias'").withColumn("ef", T.fold(F.col("entry")))
    lengths = sorted({len(a) for m in REFERENCE_CATALOG.metrics for a in m.aliases})
    raw = spark.createDataFrame([(v, v) for v in ("turbo adoptoin", "lead penetracion", "aaaaaaaaaa", "")], "_raw string, _rf string")
    out = similar(raw, entries, lengths, small=True)
    assert {r._raw: r.best.canonical for r in out.collect()} == {"turbo adoptoin": "Turbo Adoption", "lead penetracion": "Lead Penetration"}
    shuffled = [k.split(")")[0] for k in out._jdf.queryExecution().executedPlan().toString().split("hashpartitioning(")[1:]]
    assert shuffled and all(k.startswith("_raw#") and "_rf" not in k and "seg" not in k for k in shuffled)

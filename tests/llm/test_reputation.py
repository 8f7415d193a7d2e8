import math
import re

import pytest

from llm_helpers import SF
from weeklens.llm import reputation
from weeklens.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string"


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def strength(groups):
    """groups: (mean, n, k)"""
    seen = [g for g in groups if g[1] > 0]
    if not seen:
        return 1000.0
    total = sum(n for _, n, _ in seen)
    spread = sum(n * (k / n - m) ** 2 / (m * (1 - m)) for m, n, k in seen if 0 < m < 1)
    room = total - sum(n * n for _, n, _ in seen) / total - (len(seen) - 1)
    if not any(0 < m < 1 for m, _, _ in seen) or room == 0:
        return 1000.0
    rho = (spread - (len(seen) - 1)) / room
    return min(max(1 / rho - 1, 1.0), 1000.0) if rho > 0 else 1000.0


def brute(pages, outcomes, z=2.0, least=0.5):
    hosts = {split(u)[0] for _, u in pages}
    n, k = dict.fromkeys(hosts, 0), dict.fromkeys(hosts, 0)
    for i, u in pages:
        for j, y in outcomes:
            if i is not None and i == j and y is not None:
                n[split(u)[0]] += 1
                k[split(u)[0]] += y
    domain = {h: ".".join(h.split(".")[-2:]) for h in hosts}
    suffix = {d: d.split(".")[-1] for d in domain.values()}
    total = sum(n.values())
    level = {s: sum(k.values()) / total if total else 0.5 for s in set(suffix.values())}

    def shrink(mean, members):
        nk = {g: (mean[g], sum(n[h] for h in hs), sum(k[h] for h in hs)) for g, hs in members.items()}
        s = strength(list(nk.values()))
        return {g: (s * m + kk) / (s + nn) for g, (m, nn, kk) in nk.items()}, s

    sfx, _ = shrink(level, {s: [h for h in hosts if suffix[domain[h]] == s] for s in level})
    dom, _ = shrink({d: sfx[suffix[d]] for d in suffix}, {d: [h for h in hosts if domain[h] == d] for d in suffix})
    host, s = shrink({h: dom[domain[h]] for h in hosts}, {h: [h] for h in hosts})
    upper = {h: host[h] + z * math.sqrt(host[h] * (1 - host[h]) / (s + n[h] + 1)) for h in hosts}
    out = []
    for i, u in pages:
        h, p = split(u)
        fits = [r for r in URL_RULES if (h == r.host or h.endswith("." + r.host)) and p.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.text)) if fits else None
        out.append((i, h, p, rule and rule.text, rule.verdict if rule else "block" if upper[h] < least else "allow", round(upper[h], 9)))
    return sorted(out, key=str)


def run(spark, pages, outcomes):
    df = spark.createDataFrame([(*p, None) for p in pages], PAGES).selectExpr("*", "1 as n", "'x' as host", "2 as k", "3 as mean")
    told = spark.createDataFrame(outcomes, "page_id long, good int")
    out = reputation.judge_urls(df, told, URL_RULES).collect()
    return sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], round(r["good_upper"], 9)) for r in out), key=str)


def test_whole_table_against_brute_force(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    told = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    assert run(spark, pages, told) == brute(pages, told)


def test_edge_rows(spark):
    pages = [(1, None), (2, ""), (3, "no scheme.com/"), (4, "HTTP://WWW.Example.COM/en/x?y#z"), (5, "a://example.com/en/"),
             (6, "x://example.com"), (7, "x://net/es/"), (8, "x://evilnet/es/"), (9, "x://b.net/es?x"), (10, "a://b://c/d"),
             (11, "a://h.org\n/p\nq"), (None, "a://bad.org/"), (12, "a://example.com/EN/"), (12, "a://example.com/EN/")]
    pages += [(100 + i, f"s://bad.org/{i}") for i in range(30)] + [(200 + i, f"s://m{i % 4}.good.org/{i}") for i in range(30)]
    told = [(100 + i, 0) for i in range(30)] + [(200 + i, 1) for i in range(30)] + [(1, None), (None, 1), (999, 0), (12, 1), (12, 0)]
    got = run(spark, pages, told)
    assert got == brute(pages, told)
    assert {r[4] for r in got if r[1] == "bad.org"} == {"block"} and {r[4] for r in got if r[1].endswith("good.org")} == {"allow"}
    assert run(spark, pages, []) == brute(pages, [])


def test_empty_table(spark):
    assert run(spark, [], [(1, 1)]) == []


def test_planted_hosts_are_blocked_and_kept(spark):
    """Bad and clean hosts of few and many outcomes, among ordinary ones, with the production threshold and no rules."""
    hosts = {f"h{i}.ordinary{i}.org": (20, 17 + i % 3) for i in range(30)}
    hosts |= {f"b{i}.spam{i}.biz": (40, 1) for i in range(10)}
    hosts |= {"many.badhost.biz": (200, 4), "few.badhost.biz": (3, 0), "many.cleanhost.org": (200, 196), "few.cleanhost.org": (3, 3),
              "one.unlucky.org": (1, 0)}
    pages, outcomes = [], []
    for host, (n, good) in hosts.items():
        for i in range(n):
            pages.append((len(pages), f"http://{host}/p{i}"))
            outcomes.append((len(outcomes), int(i < good)))
    out = reputation.judge_urls(spark.createDataFrame(pages, "page_id long, url string"),
                     spark.createDataFrame(outcomes, "page_id long, good int"), ())
    got = {r["host"]: r["verdict"] for r in out.select("host", "verdict").distinct().collect()}
    assert {h for h, v in got.items() if v == "block"} == {h for h in hosts if h.endswith(".biz")}

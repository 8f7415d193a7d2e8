"""Independent DuckDB SQL for every registered key (the correctness oracle).

Every statement starts from the same fixture CTE as the Spark side
(``sources.testdata.fixture_sql``) and is written with plain SQL idioms
(windows, UNION ALL, quantile_cont) rather than mirroring the Spark code; the
streak oracle, for instance, uses a gaps-and-islands window recipe while Spark
folds the wide row.
"""

from __future__ import annotations

from ..catalog import TESTDATA_CATALOG as CAT
from ..sources.testdata import fixture_sql
from .registry import COUNTRIES, LEAD, MIN_BASE, PROFIT, QUAL, TREND_ZONE, VOL, ZONE_TYPES

WEEKS = [f"L{i}W" for i in range(8, -1, -1)]
IDS = "COUNTRY, CITY, ZONE"
LIMIT = CAT.outlier_limit()


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return f"CAST({float(v)!r} AS DOUBLE)"
    return "'" + str(v).replace("'", "''") + "'"


def _md() -> str:
    rows = ",\n    ".join(
        "(" + ", ".join([
            _lit(m.name), str(i), _lit(m.higher_is_better), _lit(m.unit), _lit(m.lo), _lit(m.hi), _lit(m.hi_strict),
            _lit(m.min_abs_change), _lit(m.role), _lit(m.abs_delta_min), _lit(m.abs_delta_scale),
            _lit(m.category), _lit(f"[{m.lo}, {m.hi}]"),
        ]) + ")"
        for i, m in enumerate(CAT.metrics)
    )
    return (f"md(METRIC, metric_pos, higher_is_better, unit, range_lo, range_hi, hi_strict, min_abs_change, role,"
            f" abs_delta_min, abs_delta_scale, category, range_text) AS (VALUES\n    {rows})")


def prefix() -> str:
    return fixture_sql() + f""",
{_md()},
fact AS (SELECT * FROM mw UNION ALL BY NAME SELECT * FROM owe),
mlh AS (SELECT *, value IS NOT NULL AS has_value FROM ml),
olh AS (SELECT *, value IS NOT NULL AS has_value FROM ol)
"""


def q(body: str, ctes: str = "") -> str:
    extra = (",\n" + ctes.strip().rstrip(",")) if ctes.strip() else ""
    return prefix() + extra + "\n" + body


def _oor(v: str) -> str:
    """Out-of-range predicate against md columns (NULL value -> false)."""
    return (f"coalesce(NOT ({v} >= range_lo AND CASE WHEN hi_strict THEN {v} < range_hi ELSE {v} <= range_hi END),"
            f" false)")


def _wow(order_part: str = "", digits: int | None = 6) -> str:
    w = f"OVER ({order_part} ORDER BY week_index)"
    return _rounded(f"(value - lag(value) {w}) / nullif(lag(value) {w}, 0)", digits)


def _streak_ctes(src: str) -> str:
    """Gaps-and-islands runs over long rows of ``src`` (needs md for direction)."""
    key = "COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, METRIC"
    return f"""
s_prev AS (
  SELECT {key}, week_index, value, lag(value) OVER (PARTITION BY {key} ORDER BY week_index) AS prev FROM {src}),
s_bad AS (
  SELECT s_prev.*, coalesce(prev IS NOT NULL AND value IS NOT NULL AND prev <> 0 AND
    CASE WHEN coalesce(md.higher_is_better, true) THEN value < prev ELSE value > prev END, false) AS bad
  FROM s_prev LEFT JOIN md USING (METRIC)),
s_grp AS (
  SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY {key} ORDER BY week_index) AS grp FROM s_bad),
s_runs AS (
  SELECT {key}, grp, count_if(bad) AS run, max(week_index) FILTER (WHERE bad) AS last_wi,
    arg_min(prev, week_index) FILTER (WHERE bad) AS rstart, arg_max(value, week_index) FILTER (WHERE bad) AS rend
  FROM s_grp GROUP BY {key}, grp),
streaks AS (
  SELECT {key}, max(run) AS consecutive,
    arg_max(rstart, last_wi) FILTER (WHERE run >= 1) AS run_start,
    arg_max(rend, last_wi) FILTER (WHERE run >= 1) AS run_end
  FROM s_runs GROUP BY {key})
"""


def _filter_rows(where: str, metric: str = QUAL) -> str:
    return q(f"SELECT COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, round(L0W, 6) AS L0W FROM fact"
             f" WHERE METRIC = {_lit(metric)} AND {where}")


def _rounded(x: str, digits: int | None) -> str:
    return x if digits is None else f"round({x}, {digits})"


def _compare(metric: str, gcol: str, agg: str = "avg", src: str = "fact", digits: int | None = 10) -> tuple[str, str]:
    lead = metric == LEAD
    excluded = (f"(SELECT count_if(NOT coalesce(L0W <= {LIMIT}, false)) > 0 FROM {src} WHERE METRIC = {_lit(metric)})"
                if lead else "false")
    lead_where = f" AND L0W <= {LIMIT}" if lead else ""
    cte = f"""cg AS (
  SELECT {gcol} AS "group", {_rounded(f"{agg}(L0W)", 9 if agg == "median" else 6 if agg == "sum" else digits)} AS value, count(*) AS n_zones, {_lit(metric)} AS metric,
    'L0W' AS week, {excluded} AS outliers_excluded
  FROM {src} WHERE METRIC = {_lit(metric)}{lead_where} AND L0W IS NOT NULL AND {gcol} IS NOT NULL
  GROUP BY {gcol})"""
    return cte, "SELECT * FROM cg"


def _trend_cte(metric: str, zone: str | None, digits: int | None = 10) -> str:
    zone_where = f" AND lower(ZONE) = {_lit(zone.lower())}" if zone else ""
    keys = "week_label, week_index" + (", ZONE" if zone else "")
    part = "PARTITION BY ZONE" if zone else ""
    return f"""tr_in AS (
  SELECT {keys}, avg(value) AS value FROM fact_long
  WHERE METRIC = {_lit(metric)}{zone_where} AND week_index BETWEEN 0 AND 8 AND value IS NOT NULL
  GROUP BY {keys}),
tr AS (SELECT {keys}, {_rounded('value', digits)} AS value, {_wow(part, digits)} AS wow_change, {_lit(metric)} AS metric FROM tr_in)"""


FACT_LONG = "fact_long AS (SELECT * FROM ml UNION ALL BY NAME SELECT * FROM ol)"


def _growth_top(n: int = 5, k: int = 5, base: float = MIN_BASE) -> str:
    s = f"L{n}W"
    return f"""gtop AS (
  SELECT COUNTRY, CITY, ZONE, (L0W - {s}) / abs({s}) AS growth_pct, {s} AS orders_start, L0W AS orders_end,
    L0W - {s} AS orders_abs_growth
  FROM owe WHERE {s} IS NOT NULL AND L0W IS NOT NULL AND {s} >= {base} AND {s} > 0
  ORDER BY growth_pct DESC, COUNTRY, CITY, ZONE LIMIT {k})"""


def _pct_rank(col: str) -> str:
    return (f"round((rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0)"
            f" / count(*) OVER (), 6)")


def _det_cte(min_weeks: int = 3) -> str:
    return _streak_ctes("mlh") + f""",
det AS (
  SELECT mw.COUNTRY, mw.CITY, mw.ZONE, mw.METRIC, mw.ZONE_TYPE, mw.ZONE_PRIORITIZATION,
    CAST(st.consecutive AS BIGINT) AS consecutive_deterioration_weeks,
    round((st.run_end - st.run_start) / nullif(abs(st.run_start), 0), 6) AS total_pct_change,
    round(mw.L0W, 6) AS L0W_value
  FROM streaks st JOIN mw USING (COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, METRIC)
  WHERE st.consecutive >= {min_weeks})"""


NON_VOL = CAT.non_volume()


def _quote(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# ----------------------------------------------------------------- detectors
def _anomaly_cte(threshold: float = 0.10, top_n: int = 10, reserved: int = 3) -> str:
    cap = top_n * 2
    return f"""
an_in AS (
  SELECT fact.*, coalesce(md.higher_is_better, true) AS hib, coalesce(md.unit, 'ratio') AS unit,
    coalesce(md.range_lo, -1e9) AS range_lo, coalesce(md.range_hi, 1e9) AS range_hi,
    coalesce(md.hi_strict, false) AS hi_strict, coalesce(md.min_abs_change, 0.0) AS min_abs,
    md.abs_delta_min, md.abs_delta_scale
  FROM fact LEFT JOIN md USING (METRIC)),
an_pct AS (
  SELECT *,
    CASE WHEN L1W IS NULL OR L0W IS NULL OR abs(L0W - L1W) < min_abs THEN NULL
         WHEN abs_delta_scale IS NOT NULL THEN
           CASE WHEN abs(L0W - L1W) >= abs_delta_min
                THEN (CASE WHEN L0W - L1W > 0 THEN 1.0 ELSE -1.0 END) * abs(L0W - L1W) / abs_delta_scale END
         ELSE (L0W - L1W) / greatest(abs(L1W), CASE WHEN unit = 'count' THEN 1.0 ELSE 0.001 END) END AS raw_pct
  FROM an_in WHERE NOT {_oor('L1W')} AND NOT {_oor('L0W')}),
an_keep AS (
  SELECT *, greatest(least(raw_pct, 5.0), -5.0) AS pct, abs_delta_scale IS NOT NULL AS gp
  FROM an_pct
  WHERE raw_pct IS NOT NULL
    AND abs(raw_pct) >= CASE WHEN abs_delta_scale IS NOT NULL THEN abs_delta_min / abs_delta_scale ELSE {threshold} END),
an_rank AS (
  SELECT *, CASE WHEN hib THEN pct < 0 ELSE pct > 0 END AS det FROM an_keep),
an_other AS (
  SELECT *, row_number() OVER (ORDER BY det DESC, abs(pct) DESC, COUNTRY, CITY, ZONE, METRIC) AS rn
  FROM an_rank WHERE NOT gp),
an_gp AS (
  SELECT *, row_number() OVER (ORDER BY det DESC, abs(pct) DESC, COUNTRY, CITY, ZONE, METRIC) AS rn
  FROM an_rank WHERE gp),
an_sel AS (
  SELECT * FROM an_other WHERE rn <= {cap} - (SELECT least({reserved}, count(*)) FROM an_gp)
  UNION ALL SELECT * FROM an_gp WHERE rn <= {reserved}),
an AS (
  SELECT 'anomaly' AS type, CASE WHEN det THEN 'Deterioro' ELSE 'Mejora' END AS category,
    ZONE AS zone, COUNTRY AS country, CITY AS city, ZONE_TYPE AS zone_type,
    ZONE_PRIORITIZATION AS zone_prioritization, METRIC AS metric,
    round(L1W, 6) AS value_from, round(L0W, 6) AS value_to, round(pct, 6) AS pct_change,
    CASE WHEN abs(pct) > 0.20 THEN 'alta' ELSE 'media' END AS severity,
    row_number() OVER (ORDER BY det DESC, abs(pct) DESC, COUNTRY, CITY, ZONE, METRIC) AS position
  FROM an_sel QUALIFY position <= {cap})"""


def _trends_cte(min_weeks: int = 3, top_n: int = 10) -> str:
    return _streak_ctes("mlh") + f""",
tri_in AS (
  SELECT mw.*, st.consecutive, st.run_start, st.run_end
  FROM streaks st JOIN mw USING (COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, METRIC)
  LEFT JOIN md USING (METRIC)
  WHERE NOT coalesce(NOT (mw.L0W >= coalesce(md.range_lo, -1e9) AND CASE WHEN coalesce(md.hi_strict, false)
        THEN mw.L0W < coalesce(md.range_hi, 1e9) ELSE mw.L0W <= coalesce(md.range_hi, 1e9) END), false)
    AND st.consecutive >= {min_weeks} AND st.run_start IS NOT NULL),
tri AS (
  SELECT 'consistent_deterioration' AS type, 'Tendencia Preocupante' AS category,
    ZONE AS zone, COUNTRY AS country, CITY AS city, ZONE_TYPE AS zone_type,
    ZONE_PRIORITIZATION AS zone_prioritization, METRIC AS metric,
    CAST(consecutive AS BIGINT) AS consecutive_weeks,
    round((run_end - run_start) / abs(run_start), 6) AS total_pct_change,
    round(L0W, 6) AS current_value,
    CASE WHEN consecutive >= 5 THEN 'alta' ELSE 'media' END AS severity,
    row_number() OVER (ORDER BY consecutive DESC, COUNTRY, CITY, ZONE, METRIC) AS position
  FROM tri_in QUALIFY position <= {top_n})"""


def _bench_cte(metric: str, name: str, z: float = 1.5, top_n: int = 5) -> str:
    return f"""
{name}_in AS (
  SELECT fact.*, L0W AS v, coalesce(md.higher_is_better, true) AS hib
  FROM fact LEFT JOIN md USING (METRIC)
  WHERE METRIC = {_lit(metric)} AND L0W IS NOT NULL AND NOT {_oor('L0W')}),
{name}_z AS (
  SELECT i.*, g.group_mean, g.group_count, (v - g.group_mean) / (g.group_std + 1e-9) AS z
  FROM {name}_in i JOIN (
    SELECT COUNTRY, ZONE_TYPE, avg(v) AS group_mean, stddev_samp(v) AS group_std, count(v) AS group_count
    FROM {name}_in GROUP BY COUNTRY, ZONE_TYPE) g
  ON i.COUNTRY = g.COUNTRY AND i.ZONE_TYPE = g.ZONE_TYPE),
{name} AS (
  SELECT 'benchmarking' AS type, 'Benchmarking' AS category,
    ZONE AS zone, COUNTRY AS country, CITY AS city, ZONE_TYPE AS zone_type,
    ZONE_PRIORITIZATION AS zone_prioritization, METRIC AS metric,
    round(v, 6) AS current_value, round(group_mean, 10) AS group_mean, round(z, 6) AS z_score,
    CASE WHEN (z < 0 AND hib) OR (z > 0 AND NOT hib) THEN 'underperformer' ELSE 'outperformer' END AS performance,
    CASE WHEN abs(z) >= 2.0 THEN 'alta' ELSE 'media' END AS severity,
    row_number() OVER (ORDER BY abs(z) DESC, COUNTRY, CITY, ZONE) AS position
  FROM {name}_z WHERE z IS NOT NULL AND abs(z) >= {z} AND group_count >= 3
  QUALIFY position <= {top_n})"""


def _bench_all_cte(top_n: int = 5) -> str:
    metrics = [CAT.quality, CAT.lead, CAT.profit]
    parts = [_bench_cte(m, f"bm{k}", top_n=top_n) for k, m in enumerate(metrics)]
    union = " UNION ALL ".join(f"SELECT *, {k} AS metric_pos FROM bm{k}" for k in range(len(metrics)))
    return ",".join(parts) + (f",\nbench AS (SELECT * EXCLUDE (metric_pos), row_number() OVER (ORDER BY metric_pos, position)"
                              f" AS list_pos FROM ({union}))")


def _corr_ctes() -> str:
    ms = sorted(NON_VOL)
    cols = ", ".join(f"max(CASE WHEN METRIC = {_lit(m)} THEN L0W END) AS {_quote(m)}" for m in ms)
    clean = []
    for m in ms:
        spec = CAT.get(m)
        clean.append(
            f"SELECT {_lit(m)} AS metric, count({_quote(m)}) AS n_values,"
            f" avg(CASE WHEN {_quote(m)} IS NOT NULL THEN CAST({_quote(m)} >= {spec.lo} AND {_quote(m)} <= {spec.hi}"
            f" AS DOUBLE) END) AS share_in_range FROM pv"
        )
    pairs = []
    for i in range(len(ms)):
        for j in range(i + 1, len(ms)):
            a, b = _quote(ms[i]), _quote(ms[j])
            pairs.append(
                f"SELECT {_lit(ms[i])} AS metric_a, {_lit(ms[j])} AS metric_b,"
                f" count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n_pair,"
                f" corr({a}, {b}) AS r FROM pv"
            )
    return f"""
pv AS (SELECT COUNTRY, CITY, ZONE, {cols} FROM mw GROUP BY COUNTRY, CITY, ZONE),
cc AS ({' UNION ALL '.join(clean)}),
ccl AS (SELECT metric, CAST(n_values AS BIGINT) AS n_values, round(share_in_range, 6) AS share_in_range,
          n_values > 10 AND coalesce(share_in_range > 0.9, false) AS is_clean FROM cc),
cp AS ({' UNION ALL '.join(pairs)}),
cr AS (
  SELECT cp.metric_a, cp.metric_b, CASE WHEN isnan(cp.r) THEN NULL ELSE cp.r END AS r FROM cp
  JOIN ccl a ON a.metric = cp.metric_a AND a.is_clean JOIN ccl b ON b.metric = cp.metric_b AND b.is_clean
  WHERE cp.n_pair > 1),
corrs AS (
  SELECT 'correlation' AS type, 'Correlación' AS category, metric_a, metric_b, round(r, 6) AS correlation,
    CASE WHEN r > 0 THEN 'positiva' ELSE 'negativa' END AS direction,
    CASE WHEN abs(r) >= 0.7 THEN 'alta' ELSE 'media' END AS severity,
    'Zonas con alto ' || metric_a || ' tienden a tener ' || CASE WHEN r > 0 THEN 'también alto' ELSE 'bajo' END
      || ' ' || metric_b AS interpretation,
    row_number() OVER (ORDER BY abs(r) DESC, metric_a, metric_b) AS position
  FROM cr WHERE r IS NOT NULL AND abs(r) >= 0.5 QUALIFY position <= 5)"""


def _opp_ctes(n: int = 4, base: float = MIN_BASE, top_n: int = 8) -> str:
    ls, qs = CAT.by_role("lead"), CAT.by_role("quality")
    s = f"L{n}W"
    lead_ok = f"lead_pen >= {ls.lo} AND lead_pen {'<' if ls.hi_strict else '<='} {ls.hi}"
    qual_ok = f"perfect_orders >= {qs.lo} AND perfect_orders {'<' if qs.hi_strict else '<='} {qs.hi}"
    return f"""
op_m AS (
  SELECT a.COUNTRY, a.CITY, a.ZONE, a.ZONE_TYPE, a.ZONE_PRIORITIZATION, a.L0W AS lead_pen, b.L0W AS perfect_orders
  FROM mw a JOIN mw b ON a.COUNTRY = b.COUNTRY AND a.CITY = b.CITY AND a.ZONE = b.ZONE
  WHERE a.METRIC = {_lit(ls.name)} AND b.METRIC = {_lit(qs.name)} AND a.L0W IS NOT NULL AND b.L0W IS NOT NULL),
op_g AS (
  SELECT COUNTRY, CITY, ZONE, (L0W - {s}) / abs({s}) AS order_growth, {s} AS orders_base
  FROM owe WHERE {s} IS NOT NULL AND L0W IS NOT NULL AND {s} >= {base} AND {s} > 0),
op_j AS (
  SELECT op_m.*, op_g.order_growth, op_g.orders_base,
    COUNTRY || '_' || coalesce(ZONE_TYPE, 'unknown') AS peer_key
  FROM op_m LEFT JOIN op_g USING (COUNTRY, CITY, ZONE)
  WHERE {lead_ok} AND {qual_ok}),
op_p AS (
  SELECT *, quantile_cont(lead_pen, 0.75) OVER (PARTITION BY peer_key) AS p75,
    quantile_cont(perfect_orders, 0.40) OVER (PARTITION BY peer_key) AS p40
  FROM op_j),
opps AS (
  SELECT 'opportunity' AS type, 'Oportunidad' AS category, ZONE AS zone, COUNTRY AS country, CITY AS city,
    ZONE_TYPE AS zone_type, ZONE_PRIORITIZATION AS zone_prioritization,
    round(lead_pen, 6) AS lead_penetration, round(perfect_orders, 6) AS perfect_orders,
    round(p40, 9) AS peer_perfect_threshold, round(p75, 9) AS peer_lead_threshold,
    round(order_growth, 6) AS order_growth, orders_base, 'media' AS severity,
    row_number() OVER (ORDER BY order_growth DESC, COUNTRY, CITY, ZONE) AS position
  FROM op_p WHERE lead_pen >= p75 AND perfect_orders < p40 AND order_growth > 0
  QUALIFY position <= {top_n})"""


def _dq_cte(top_n: int = 20) -> str:
    return f"""
dq_in AS (SELECT mw.*, md.range_lo, md.range_hi, md.hi_strict, md.range_text FROM mw LEFT JOIN md USING (METRIC)),
dq AS (
  SELECT 'data_quality' AS type, 'Calidad de Datos' AS category, ZONE AS zone, COUNTRY AS country, CITY AS city,
    METRIC AS metric, round(L0W, 6) AS value,
    coalesce(range_text, '[-1000000000.0, 1000000000.0]') AS expected_range,
    CASE WHEN L0W > range_hi * 2 OR L0W < range_lo * 2 THEN 'alta' ELSE 'media' END AS severity,
    row_number() OVER (ORDER BY METRIC, COUNTRY, CITY, ZONE) AS position
  FROM dq_in WHERE L0W IS NOT NULL AND {_oor('L0W')}
  QUALIFY position <= {top_n})"""


CARD = ["section", "type", "category", "list_pos", "zone", "country", "city", "zone_type", "zone_prioritization",
        "metric", "metric_b", "value_from", "value_to", "pct_change", "consecutive_weeks", "total_pct_change",
        "current_value", "group_mean", "z_score", "performance", "correlation", "direction", "interpretation",
        "lead_penetration", "perfect_orders", "peer_perfect_threshold", "order_growth", "orders_base", "value",
        "expected_range", "severity"]
CARD_TYPES = {"list_pos": "BIGINT", "consecutive_weeks": "BIGINT"}


def _card_select(src: str, section: str, present: list[str], renames: dict | None = None, list_pos: str = "position"):
    renames = renames or {}
    cols = []
    for c in CARD:
        t = CARD_TYPES.get(c, "DOUBLE" if c in {"value_from", "value_to", "pct_change", "total_pct_change",
                                                  "current_value", "group_mean", "z_score", "correlation",
                                                  "lead_penetration", "perfect_orders", "peer_perfect_threshold",
                                                  "order_growth", "orders_base", "value"} else "VARCHAR")
        if c == "section":
            cols.append(f"'{section}' AS section")
        elif c == "list_pos":
            cols.append(f"CAST({list_pos} AS BIGINT) AS list_pos")
        elif c in renames:
            cols.append(f"CAST({renames[c]} AS {t}) AS {c}")
        elif c in present:
            cols.append(f"CAST({c} AS {t}) AS {c}")
        else:
            cols.append(f"CAST(NULL AS {t}) AS {c}")
    return f"SELECT {', '.join(cols)} FROM {src}"


def _all_insights_cte() -> str:
    an_cols = ["type", "category", "zone", "country", "city", "zone_type", "zone_prioritization", "metric",
               "value_from", "value_to", "pct_change", "severity"]
    tr_cols = ["type", "category", "zone", "country", "city", "zone_type", "zone_prioritization", "metric",
               "consecutive_weeks", "total_pct_change", "current_value", "severity"]
    bm_cols = ["type", "category", "zone", "country", "city", "zone_type", "zone_prioritization", "metric",
               "current_value", "group_mean", "z_score", "performance", "severity"]
    co_cols = ["type", "category", "metric_b", "correlation", "direction", "interpretation", "severity"]
    op_cols = ["type", "category", "zone", "country", "city", "zone_type", "zone_prioritization",
               "lead_penetration", "perfect_orders", "peer_perfect_threshold", "order_growth", "orders_base",
               "severity"]
    dq_cols = ["type", "category", "zone", "country", "city", "metric", "value", "expected_range", "severity"]
    union = "\n  UNION ALL ".join([
        _card_select("an", "anomalies", an_cols),
        _card_select("tri", "trends", tr_cols),
        _card_select("bench", "benchmarks", bm_cols, list_pos="list_pos"),
        _card_select("corrs", "correlations", co_cols, {"metric": "metric_a"}),
        _card_select("opps", "opportunities", op_cols),
        _card_select("dq", "data_quality", dq_cols),
    ])
    return ",\n".join([
        _anomaly_cte().strip(), _trends_cte().strip(), _bench_all_cte().strip(), _corr_ctes().strip(),
        _opp_ctes().strip(), _dq_cte().strip(),
    ]) + f",\nins AS (\n  {union})"


_SECTION_ORDER = ["anomalies", "trends", "benchmarks", "correlations", "opportunities", "data_quality"]
_TOP_ORDER = ["trends", "anomalies", "benchmarks", "opportunities", "correlations", "data_quality"]


def _case_rank(col: str, order: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{s}' THEN {i}" for i, s in enumerate(order)) + f" ELSE {len(order)} END"


def build() -> dict[str, str]:
    S: dict[str, str] = {}
    wk = ", ".join(WEEKS)
    roll = ", ".join(f"{w}_ROLL" for w in WEEKS)
    trim = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g') AS {c}"
    dims = ["COUNTRY", "CITY", "ZONE", "ZONE_TYPE", "ZONE_PRIORITIZATION", "METRIC"]
    # --- prep
    S["load_metrics"] = q("SELECT * FROM fx_mraw")
    S["load_orders"] = q("SELECT * FROM fx_oraw")
    aliases = " UNION ALL ".join(
        f"SELECT {_lit(m.name)} AS METRIC, CAST({len(m.aliases)} AS BIGINT) AS n_aliases, {_lit('|'.join(m.aliases))}"
        f" AS aliases" for m in CAT.metrics)
    S["metric_dictionary"] = q(
        "SELECT f.METRIC, f.n_rows, md.higher_is_better, md.unit, md.range_lo, md.range_hi, md.hi_strict,"
        " md.min_abs_change, md.category, al.n_aliases, al.aliases"
        " FROM (SELECT METRIC, count(*) AS n_rows FROM fact GROUP BY METRIC) f"
        " LEFT JOIN md USING (METRIC) LEFT JOIN al USING (METRIC)",
        f"al AS ({aliases})")
    S["clean_dedup"] = q("SELECT DISTINCT * FROM fx_mraw")
    S["clean_trim"] = q(f"SELECT {', '.join(trim.format(c=c) for c in dims)}, {roll} FROM (SELECT DISTINCT * FROM fx_mraw)")
    S["clean_numeric"] = q("SELECT * FROM mw")
    S["melt_long"] = q("SELECT * FROM mlh")
    S["zone_dim"] = q("SELECT * FROM zd")
    S["orders_enriched"] = q("SELECT * FROM owe")
    S["materialize"] = q("SELECT * FROM fact")
    S["key_uniqueness"] = q("SELECT COUNTRY, CITY, ZONE, METRIC, count(*) AS n_rows FROM fact"
                            " GROUP BY COUNTRY, CITY, ZONE, METRIC HAVING count(*) <> 1")
    cl = ", ".join(_lit(c) for c in COUNTRIES)
    zl = ", ".join(_lit(z) for z in ZONE_TYPES)
    S["expect_checks"] = q(f"""
SELECT 'country_domain' AS rule, CAST(count_if(COUNTRY NOT IN ({cl}) OR COUNTRY IS NULL) AS BIGINT) AS violations FROM mw
UNION ALL SELECT 'zone_type_domain', CAST(count_if(ZONE_TYPE NOT IN ({zl}) OR ZONE_TYPE IS NULL) AS BIGINT) FROM mw
UNION ALL SELECT 'metrics_have_l0w', CAST(CASE WHEN count(L0W) > 0 THEN 0 ELSE 1 END AS BIGINT) FROM mw
UNION ALL SELECT 'orders_nonneg_l0w', CAST(count_if(L0W < 0) AS BIGINT) FROM ow
UNION ALL SELECT 'orders_nonneg_l1w', CAST(count_if(L1W < 0) AS BIGINT) FROM ow
UNION ALL SELECT 'week_index_range', CAST(count_if(NOT week_index BETWEEN 0 AND 8) AS BIGINT) FROM ml""")
    # --- filters
    S["filter_country"] = _filter_rows("upper(COUNTRY) = 'AMERICA'")
    S["filter_city"] = _filter_rows("lower(CITY) = 'nation_3'")
    S["filter_zone_contains"] = _filter_rows("contains(lower(ZONE), '00007')")
    S["filter_zone_exact"] = _filter_rows(f"lower(ZONE) = {_lit(TREND_ZONE)}")
    S["filter_zone_type"] = _filter_rows("lower(ZONE_TYPE) = 'wealthy'")
    S["filter_priority"] = _filter_rows("lower(ZONE_PRIORITIZATION) = 'high priority'")
    S["filter_week_range"] = q(f"SELECT COUNTRY, CITY, ZONE, week_label, week_index, round(value, 6) AS value"
                               f" FROM fact_long WHERE METRIC = {_lit(QUAL)} AND week_index BETWEEN 3 AND 7", FACT_LONG)
    S["outlier_split"] = q(f"SELECT COUNTRY, CITY, ZONE, round(L0W, 6) AS value, L0W >= {LIMIT} AS is_outlier"
                           f" FROM fact WHERE METRIC = {_lit(LEAD)} AND L0W IS NOT NULL")
    S["range_predicate"] = q(f"SELECT COUNTRY, CITY, ZONE, METRIC, round(L0W, 6) AS value, {_oor('L0W')} AS out_of_range"
                             f" FROM fact LEFT JOIN md USING (METRIC)")
    # --- queries
    S["top_zones"] = q(f"""
SELECT COUNTRY, CITY, ZONE, round(value, 6) AS value,
  row_number() OVER (ORDER BY value DESC, COUNTRY, CITY, ZONE) AS rank,
  {_lit(LEAD)} AS metric, 'L0W' AS week, '' AS data_quality_note
FROM (SELECT COUNTRY, CITY, ZONE, L0W AS value FROM fact
      WHERE METRIC = {_lit(LEAD)} AND L0W IS NOT NULL AND L0W < {LIMIT}
      ORDER BY value DESC, COUNTRY, CITY, ZONE LIMIT 10)""")
    for key, (metric, gcol, agg) in {
        "compare_groups": (QUAL, "ZONE_TYPE", "avg"),
        "aggregate_metric": (LEAD, "COUNTRY", "avg"),
        "agg_median": (PROFIT, "CITY", "median"),
        "agg_sum": (VOL, "ZONE_PRIORITIZATION", "sum"),
    }.items():
        cte, body = _compare(metric, gcol, agg)
        S[key] = q(body, cte)
    S["trend_all"] = q("SELECT * FROM tr", FACT_LONG + ",\n" + _trend_cte(QUAL, None))
    S["trend_zone"] = q("SELECT * FROM tr", FACT_LONG + ",\n" + _trend_cte(QUAL, TREND_ZONE))
    avgs = ", ".join(f"avg({w}) AS {w}" for w in WEEKS)
    unp = " UNION ALL ".join(f"SELECT {IDS}, '{w}' AS week_label, {8 - int(w[1])} AS week_index, {w} AS value FROM tw_first"
                             for w in WEEKS)
    S["trend_from_wide"] = q(f"""
SELECT {IDS}, week_label, week_index, round(value, 6) AS value, {_wow()} AS wow_change, {_lit(PROFIT)} AS metric
FROM (SELECT {IDS}, week_label, week_index, avg(value) AS value FROM tw_long
      WHERE value IS NOT NULL AND week_index BETWEEN 0 AND 8 GROUP BY {IDS}, week_label, week_index)""",
        f"""tw_first AS (
  SELECT {IDS}, METRIC, {avgs} FROM fact WHERE METRIC = {_lit(PROFIT)} AND lower(ZONE) = {_lit(TREND_ZONE)}
  GROUP BY {IDS}, METRIC ORDER BY {IDS}, METRIC LIMIT 1),
tw_long AS ({unp})""")
    S["trend_summary"] = q(f"""
SELECT CAST(count(*) AS BIGINT) AS n_points, round(arg_min(value, week_index), 6) AS first_value,
  round(arg_max(value, week_index), 6) AS last_value, round(avg(value), 6) AS mean_value,
  round(arg_max(wow_change, week_index), 6) AS last_wow,
  round(CASE WHEN arg_min(value, week_index) <> 0
        THEN (arg_max(value, week_index) - arg_min(value, week_index)) / abs(arg_min(value, week_index))
        ELSE 0.0 END, 6) AS total_change,
  CASE WHEN CASE WHEN arg_min(value, week_index) <> 0
        THEN (arg_max(value, week_index) - arg_min(value, week_index)) / abs(arg_min(value, week_index))
        ELSE 0.0 END > 0 THEN 'mejoró' ELSE 'empeoró' END AS direction,
  {_lit(QUAL)} AS metric
FROM tr HAVING count(*) > 0""", FACT_LONG + ",\n" + _trend_cte(QUAL, TREND_ZONE, None))
    S["high_low"] = q(f"""
SELECT COUNTRY, CITY, ZONE, ZONE_TYPE, ZONE_PRIORITIZATION, round(value_a, 6) AS value_a, round(value_b, 6) AS value_b,
  {_pct_rank('value_a')} AS percentile_a, {_pct_rank('value_b')} AS percentile_b,
  round(ta, 9) AS threshold_a, round(tb, 9) AS threshold_b,
  {_lit(LEAD)} AS metric_a, {_lit(QUAL)} AS metric_b, '' AS data_quality_note
FROM hl_m, hl_t WHERE value_a >= ta AND value_b <= tb""",
        f"""hl_m AS (
  SELECT a.COUNTRY, a.CITY, a.ZONE, a.ZONE_TYPE, a.ZONE_PRIORITIZATION, a.L0W AS value_a, b.L0W AS value_b
  FROM mw a JOIN mw b ON a.COUNTRY = b.COUNTRY AND a.CITY = b.CITY AND a.ZONE = b.ZONE
  WHERE a.METRIC = {_lit(LEAD)} AND b.METRIC = {_lit(QUAL)} AND a.L0W IS NOT NULL AND b.L0W IS NOT NULL
    AND a.L0W < {LIMIT}),
hl_t AS (SELECT quantile_cont(value_a, 0.75) AS ta, quantile_cont(value_b, 0.25) AS tb FROM hl_m)""")
    S["high_low_outliers"] = q(f"""
SELECT a.COUNTRY, a.CITY, a.ZONE, a.ZONE_TYPE, a.ZONE_PRIORITIZATION, round(a.L0W, 6) AS value_a, round(b.L0W, 6) AS value_b,
  count(*) OVER () AS n_outliers
FROM mw a JOIN mw b ON a.COUNTRY = b.COUNTRY AND a.CITY = b.CITY AND a.ZONE = b.ZONE
WHERE a.METRIC = {_lit(LEAD)} AND b.METRIC = {_lit(QUAL)} AND a.L0W IS NOT NULL AND b.L0W IS NOT NULL AND a.L0W >= {LIMIT}""")
    S["fastest_growing"] = q("SELECT COUNTRY, CITY, ZONE, round(growth_pct, 6) AS growth_pct, orders_start, orders_end,"
                             " orders_abs_growth FROM gtop", _growth_top())
    S["growth_explain"] = q("""
SELECT zone, country, city, round(growth_pct, 6) AS growth_pct, orders_start, orders_end, metric,
  round(value_start, 6) AS value_start, round(value_end, 6) AS value_end, round(pct_change, 6) AS pct_change,
  round(improvement, 6) AS improvement, improvement_rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY zone, country, city ORDER BY improvement DESC, metric) AS improvement_rank
  FROM (
    SELECT t.ZONE AS zone, t.COUNTRY AS country, t.CITY AS city, t.growth_pct, t.orders_start, t.orders_end,
      m.METRIC AS metric, m.L5W AS value_start, m.L0W AS value_end,
      (m.L0W - m.L5W) / greatest(abs(m.L5W), 0.001) AS pct_change,
      CASE WHEN coalesce(md.higher_is_better, true) THEN 1 ELSE -1 END
        * (m.L0W - m.L5W) / greatest(abs(m.L5W), 0.001) AS improvement
    FROM gtop t LEFT JOIN (SELECT * FROM mw WHERE L5W IS NOT NULL AND L0W IS NOT NULL) m
      ON m.ZONE = t.ZONE AND m.COUNTRY = t.COUNTRY LEFT JOIN md ON md.METRIC = m.METRIC))
WHERE improvement_rank <= 3""", _growth_top())
    S["pct_change_abs"] = q("""
SELECT COUNTRY, CITY, ZONE, METRIC, ZONE_TYPE, ZONE_PRIORITIZATION,
  round(ch, 6) AS wow_change, round(L1W, 6) AS L1W, round(L0W, 6) AS L0W
FROM (SELECT *, CASE WHEN L1W = 0 THEN CASE WHEN L0W > 0 THEN 'inf'::DOUBLE WHEN L0W < 0 THEN '-inf'::DOUBLE END
                ELSE (L0W - L1W) / abs(L1W) END AS ch FROM fact) WHERE ch IS NOT NULL""")
    S["deterioration"] = q("SELECT * FROM det", _det_cte())
    cols = ", ".join(f"coalesce(avg(CASE WHEN METRIC = {_lit(m)} THEN consecutive_deterioration_weeks END), 0.0)"
                     f" AS {_quote(m)}" for m in NON_VOL)
    names = ", ".join(_quote(m) for m in NON_VOL)
    S["deterioration_matrix"] = q(
        f"SELECT ZONE, {names}, greatest({names}) AS max_weeks FROM dm ORDER BY max_weeks DESC, ZONE LIMIT 20",
        _det_cte() + f",\ndm AS (SELECT ZONE, {cols} FROM det GROUP BY ZONE)")
    S["zone_summary"] = q("SELECT CAST(count(DISTINCT ZONE) AS BIGINT) AS n_zones, CAST(count(DISTINCT COUNTRY) AS BIGINT)"
                          " AS n_countries, CAST(count(DISTINCT METRIC) AS BIGINT) AS n_metrics,"
                          " CAST(count(DISTINCT CITY) AS BIGINT) AS n_cities,"
                          + ",".join(f" array_to_string(list_sort(list(DISTINCT {c})), '|') AS {a}" for c, a in
                                     (("COUNTRY", "countries"), ("ZONE_TYPE", "zone_types"),
                                      ("ZONE_PRIORITIZATION", "prioritizations"))) + " FROM mw")
    S["zones_per_country"] = q("SELECT COUNTRY, CAST(count(DISTINCT ZONE) AS BIGINT) AS n_zones FROM mw GROUP BY COUNTRY")
    qs = CAT.get(QUAL)
    width = (qs.hi - qs.lo) / 50
    S["metric_histogram"] = q(f"""
SELECT ZONE_TYPE, bin, CASE WHEN bin >= 0 THEN round({_lit(qs.lo)} + bin * {_lit(width)}, 6) END AS bin_lo,
  CASE WHEN bin < 50 THEN round({_lit(qs.lo)} + (bin + 1) * {_lit(width)}, 6) END AS bin_hi, count(*) AS n
FROM (SELECT ZONE_TYPE, CAST(CASE WHEN L0W < {_lit(qs.lo)} THEN -1 WHEN L0W > {_lit(qs.hi)} THEN 50 ELSE least(greatest(floor((L0W - {_lit(qs.lo)}) / {_lit(width)}), 0), 49) END AS BIGINT) AS bin
      FROM fact WHERE METRIC = {_lit(QUAL)} AND L0W IS NOT NULL)
GROUP BY ZONE_TYPE, bin""")
    pcols = ", ".join(f"round(max(CASE WHEN METRIC = {_lit(m)} THEN L0W END), 6) AS {_quote(m)}" for m in NON_VOL)
    anyn = " OR ".join(f"{_quote(m)} IS NOT NULL" for m in NON_VOL)
    S["metric_pivot"] = q(f"SELECT * FROM (SELECT COUNTRY, CITY, ZONE, {pcols} FROM mw GROUP BY COUNTRY, CITY, ZONE)"
                          f" WHERE {anyn}")
    cte, _ = _compare(QUAL, "ZONE_TYPE", "avg", digits=None)
    S["gap"] = q(f"""
SELECT a."group" AS group_a, b."group" AS group_b, round(a.value, 6) AS value_a, round(b.value, 6) AS value_b,
  round(a.value - b.value, 6) AS gap, round(abs(a.value - b.value) * 100, 6) AS gap_pp,
  CASE WHEN a.value - b.value > 0 THEN a."group" ELSE b."group" END AS leader, {_lit(QUAL)} AS metric
FROM go a JOIN go b ON a.rn = 1 AND b.rn = 2 WHERE a.n = 2""",
        cte + ",\ngo AS (SELECT *, row_number() OVER (ORDER BY value DESC, \"group\" DESC) AS rn,"
              " count(*) OVER () AS n FROM cg)")
    # --- detectors
    S["anomalies"] = q("SELECT * FROM an", _anomaly_cte())
    S["trends_insight"] = q("SELECT * FROM tri", _trends_cte())
    S["benchmarking"] = q("SELECT * EXCLUDE (list_pos) FROM bench", _bench_all_cte())
    S["sheet_audit"] = q("""
SELECT COUNTRY, count_if(m AND o) AS n_both, count_if(m AND NOT o) AS n_without_orders,
  count_if(NOT m AND o) AS n_without_metrics
FROM (SELECT coalesce(a.COUNTRY, b.COUNTRY) AS COUNTRY, a.ZONE IS NOT NULL AS m, b.ZONE IS NOT NULL AS o
      FROM (SELECT DISTINCT COUNTRY, CITY, ZONE FROM mw) a
      FULL JOIN (SELECT DISTINCT COUNTRY, CITY, ZONE FROM ow) b USING (COUNTRY, CITY, ZONE))
GROUP BY COUNTRY""")
    S["long_streaks"] = """
WITH units AS (
  SELECT s_name AS ZONE, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) // 7 AS period,
    CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS DOUBLE) AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
steps AS (
  SELECT *, lag(value) OVER w AS prev, lag(period) OVER w AS before FROM units WINDOW w AS (PARTITION BY ZONE ORDER BY period)),
bad AS (SELECT *, coalesce(before = period - 1 AND prev <> 0 AND value < prev, false) AS bad FROM steps),
islands AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY ZONE ORDER BY period) AS grp FROM bad),
runs AS (
  SELECT ZONE, grp, count_if(bad) AS run, max(period) AS last_period, count(*) AS n,
    arg_min(prev, period) FILTER (WHERE bad) AS rstart, arg_max(value, period) FILTER (WHERE bad) AS rend
  FROM islands GROUP BY ZONE, grp)
SELECT ZONE, CAST(sum(n) AS BIGINT) AS n_periods, CAST(max(run) AS BIGINT) AS consecutive,
  arg_max(rstart, last_period) FILTER (WHERE run > 0) AS run_start,
  arg_max(rend, last_period) FILTER (WHERE run > 0) AS run_end
FROM runs GROUP BY ZONE HAVING max(run) >= 3"""
    S["correlations"] = q("SELECT * FROM corrs", _corr_ctes())
    S["corr_clean_metrics"] = q("SELECT * FROM ccl", _corr_ctes())
    S["opportunities"] = q("SELECT * FROM opps", _opp_ctes())
    S["data_quality"] = q("SELECT * FROM dq", _dq_cte())
    ai = _all_insights_cte()
    S["all_insights"] = q("SELECT * FROM ins", ai)
    sec = ", ".join(f"('{s}')" for s in _SECTION_ORDER)
    S["insight_counts"] = q(f"""
SELECT s.section, CAST(coalesce(c.n, 0) AS BIGINT) AS n_findings
FROM (VALUES {sec}) s(section) LEFT JOIN (SELECT section, count(*) AS n FROM ins GROUP BY section) c USING (section)
UNION ALL
SELECT 'total', CAST(count(*) AS BIGINT) FROM ins WHERE section <> 'data_quality'""", ai)
    S["diversified_top5"] = q(f"""
SELECT row_number() OVER (ORDER BY tier, sev, sec_rank, list_pos) AS top_rank,
  section, type, category, zone, country, metric, metric_b, severity, list_pos
FROM (
  SELECT *, CASE WHEN first THEN 0 ELSE 1 END AS tier,
    CASE WHEN first THEN 0 ELSE CAST(severity <> 'alta' AS INTEGER) END AS sev
  FROM (SELECT *, {_case_rank('section', _TOP_ORDER)} AS sec_rank,
          row_number() OVER (PARTITION BY section ORDER BY list_pos) = 1 AS first FROM ins)
  WHERE first OR section <> 'data_quality')
ORDER BY top_rank LIMIT 5""", ai)
    S["report_sections"] = q("""
SELECT section, section_rank, type, category, zone, country, metric, metric_b, severity
FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY list_pos) AS section_rank FROM ins)
WHERE section_rank <= 8""", ai)
    return S


# =============================================================== text jobs (X*)
from ..catalog import REFERENCE_CATALOG as RCAT  # noqa: E402
from ..functions import text_rules as TR  # noqa: E402
from ..sources import requests as RQ  # noqa: E402


def _strlist(items) -> str:
    return "[" + ", ".join("NULL" if x is None else _lit(str(x)) for x in items) + "]"


def _pick(items, n=None) -> str:
    return f"list_extract({_strlist(items)}, CAST(((conv_id * 7 + turn) % {len(items)}) + 1 AS INTEGER))"


# Code points of white space (written out again, not taken from the operators)
_SPACES = [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


def _strip(x: str) -> str:
    return f"trim({x}, {_lit(''.join(map(chr, _SPACES)))})"


def _any(q: str, words) -> str:
    return "(" + " OR ".join(f"contains({q}, {_lit(w)})" for w in words) + ")"


def _fold(x: str) -> str:
    return f"translate({x}, {_lit(TR.FOLD_FROM)}, {_lit(TR.FOLD_TO)})"


def _capped(d: str, cap=None) -> str:
    n = f"(CASE WHEN {d} = '' THEN NULL WHEN length({d}) > 18 THEN 1000000000000000000 ELSE CAST({d} AS BIGINT) END)"
    return f"(CASE WHEN {n} IS NOT NULL THEN least({n}, {cap}) END)" if cap is not None else n


def _text_prefix() -> str:
    me = ", ".join(
        f"({_lit(m.name)}, {i}, {_lit(m.name.lower())}, 'canonical', 0)"
        + "".join(f", ({_lit(m.name)}, {i}, {_lit(a.lower())}, 'alias', {j + 1})" for j, a in enumerate(m.aliases))
        for i, m in enumerate(RCAT.metrics))

    def alias_rows(groups, with_code=False):
        rows = []
        for i, (c, al) in enumerate(groups):
            rows += [f"({_lit(c)}, {i}, {_lit(a)})" for a in al]
            if with_code:
                rows.append(f"({_lit(c)}, {i}, {_lit(c.lower())})")
        return ", ".join(rows)

    req_fields = RQ.REQUEST_FIELDS
    own = {"metric": "w2", "city": "nation", "zone": "s_name"}
    structs = ", ".join(
        "{" + ", ".join(f"'{f}': " + (f"CAST({'NULL' if v is None else v} AS BIGINT)" if f == "n_weeks"
                                      else f"CAST({_lit(v)} AS VARCHAR)") for f, v in zip(req_fields, r)) + "}"
        for r in RQ.REQUESTS)
    return f"""
msg AS (SELECT conv_id, turn, role,
          lower({_pick(RQ.QUESTIONS)} || chr(10) || coalesce(text, '')) AS q FROM conversations),
wds AS (SELECT *, conv_id * 7 + turn AS k, string_split(coalesce(text, ''), ' ') AS ws FROM conversations),
wd AS (SELECT *, ws[(k % len(ws)) + 1] AS w1,
         array_to_string(ws[(k % len(ws)) + 1:(k % len(ws)) + 2], ' ') AS w2 FROM wds),
lab AS (SELECT conv_id, turn, CASE WHEN k % 3 = 0 THEN {_pick(RQ.LABELS)} ELSE w2 END AS label FROM wd),
alab AS (SELECT conv_id, turn, w AS country_label, w AS zone_type_label, w AS priority_label
        FROM (SELECT conv_id, turn, unnest(list_distinct(
                ws || [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]
                || [{', '.join(_pick(x) for x in (RQ.COUNTRY_LABELS, RQ.ZONE_TYPE_LABELS, RQ.PRIORITY_LABELS))}])) AS w FROM wd)),
req AS (SELECT conv_id, turn, {', '.join(
        f"CASE WHEN k % 2 = 1 THEN {own[f]} ELSE s.{f} END AS {f}" if f in own else f's.{f} AS {f}' for f in req_fields)}
        FROM (SELECT conv_id, turn, k, w2, lower(n_name) AS nation, s_name, list_extract([{structs}], CAST(((conv_id * 7 + turn) % {len(RQ.REQUESTS)}) + 1
              AS INTEGER)) AS s FROM wd LEFT JOIN nation ON k % 25 = n_nationkey
              LEFT JOIN supplier ON conv_id = s_suppkey)),
me(canonical, metric_pos, entry, kind, sub_pos) AS (VALUES {me}),
ctry(canonical, pos, alias) AS (VALUES {alias_rows(RCAT.countries, True)}),
zty(canonical, pos, alias) AS (VALUES {alias_rows(RCAT.zone_types)}),
pri(canonical, pos, alias) AS (VALUES {alias_rows(RCAT.prioritizations)}),
gz AS (SELECT DISTINCT name, kind FROM (SELECT lower(ZONE) AS name, 'zone' AS kind FROM mw
        UNION ALL SELECT lower(CITY), 'city' FROM mw) WHERE length(name) >= 4),
gz_hits AS (SELECT m.conv_id, m.turn, g.name, g.kind FROM msg m JOIN gz g ON contains(m.q, g.name)),
gz_z AS (SELECT conv_id, turn, name FROM gz_hits WHERE kind = 'zone'
         QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY length(name) DESC, name) = 1),
gz_c AS (SELECT conv_id, turn, name FROM gz_hits WHERE kind = 'city'
         QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY length(name) DESC, name) = 1),
places AS (SELECT m.conv_id, m.turn, z.name AS zone, CASE WHEN z.name IS NULL THEN c.name END AS city
           FROM msg m LEFT JOIN gz_z z USING (conv_id, turn) LEFT JOIN gz_c c USING (conv_id, turn))"""


def _resolve_sql(src: str, col: str, name: str) -> str:
    """CTE ``name``(col, canonical, step): ordered resolution of distinct values of src.col."""
    r, e = "_r", "entry"
    sim = (f"(1.0 - levenshtein({_fold(r)}, {_fold(e)}) / greatest(length({_fold(r)}), length({_fold(e)})))")
    return f"""
{name}_raw AS (SELECT DISTINCT {col} AS _raw, lower({_strip(col)}) AS _r FROM {src}
               WHERE {col} IS NOT NULL AND {col} <> ''),
{name}_cand AS (
  SELECT _raw, canonical, metric_pos, sub_pos, {sim} AS sim,
    CASE WHEN kind = 'canonical' AND _r = entry THEN 1
         WHEN kind = 'alias' AND _r = entry THEN 2
         WHEN kind = 'canonical' AND contains(entry, _r) THEN 3
         WHEN kind = 'alias' AND (contains(entry, _r) OR contains(_r, entry)) THEN 3
         WHEN kind = 'alias' AND {sim} >= 0.6 THEN 4 END AS step
  FROM {name}_raw, me),
{name} AS (
  SELECT _raw AS {col}, canonical, CAST(step AS INTEGER) AS step FROM {name}_cand WHERE step IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY _raw ORDER BY step, CASE WHEN step = 4 THEN -sim ELSE 0 END,
                             metric_pos, sub_pos) = 1)"""


def _intent_expr(q: str, has_place: str) -> str:
    base = (f"CASE WHEN {_any(q, TR.GROWTH_WORDS)} AND {_any(q, TR.ORDER_WORDS)} THEN 'growth_explanation'"
            f" WHEN {_any(q, TR.AGG_WORDS)} THEN 'aggregation' WHEN {_any(q, TR.COMPARE_WORDS)} THEN 'comparison'"
            f" ELSE 'ranking' END")
    b2 = (f"CASE WHEN ({base}) = 'ranking' AND {_any(q, TR.TREND_WORDS)} THEN 'trend'"
          f" WHEN ({base}) = 'ranking' AND regexp_matches({q}, {_lit(TR.LAST_N_WEEKS)}) AND {has_place} THEN 'trend'"
          f" ELSE ({base}) END")
    b3 = f"CASE WHEN {_any(q, TR.HIGH_WORDS)} AND {_any(q, TR.LOW_WORDS)} THEN 'multivariable' ELSE ({b2}) END"
    return f"CASE WHEN {_any(q, TR.ANOMALY_WORDS)} THEN 'anomaly' ELSE ({b3}) END"


def _params_cte() -> str:
    q = "q"
    g1 = f"regexp_extract({q}, {_lit(TR.LAST_N_WEEKS_CAPTURE)}, 1)"
    g2 = f"regexp_extract({q}, {_lit(TR.LAST_N_WEEKS_CAPTURE)}, 2)"
    n = _capped(f"(CASE WHEN {g1} <> '' THEN {g1} ELSE {g2} END)", 8)
    k1 = f"regexp_extract({q}, {_lit(TR.TOP_K)}, 1)"
    k2 = f"regexp_extract({q}, {_lit(TR.TOP_K)}, 2)"
    topk = f"coalesce({_capped(f'(CASE WHEN {k1} <> {_lit(chr(0))[:0] or chr(39)*2} THEN {k1} ELSE {k2} END)')}, 5)"
    codes = " ".join(f"WHEN contains(' ' || {q} || ' ', {_lit(' ' + c.lower() + ' ')}) THEN {_lit(c)}"
                     for c in TR.COUNTRY_CODES)
    names = " ".join(f"WHEN contains({q}, {_lit(nm)}) THEN {_lit(c)}" for nm, c in TR.COUNTRY_NAMES)
    return f"""
pr_in AS (SELECT m.conv_id, m.turn, m.q, p.zone, p.city,
            {_intent_expr('m.q', '(p.zone IS NOT NULL OR p.city IS NOT NULL)')} AS intent
          FROM msg m JOIN places p USING (conv_id, turn)),
params AS (
  SELECT conv_id, turn, intent, {n} AS n_weeks,
    CASE WHEN {n} IS NOT NULL THEN 'L' || CAST({n} AS VARCHAR) || 'W-L0W' ELSE 'L0W' END AS time_scope,
    CAST({topk} AS BIGINT) AS top_k,
    CASE WHEN {_any(q, TR.GROUP_COUNTRY)} THEN 'country'
         WHEN contains(q, 'zone type') OR (contains(q, 'wealthy') AND intent = 'comparison') THEN 'ZONE_TYPE'
         WHEN {_any(q, TR.GROUP_CITY)} THEN 'city' WHEN {_any(q, TR.GROUP_PRIORITY)} THEN 'ZONE_PRIORITIZATION'
    END AS group_by,
    CASE WHEN contains(q, 'non wealthy') OR contains(q, 'no wealthy') THEN 'Non Wealthy'
         WHEN contains(q, 'wealthy') THEN 'Wealthy' END AS zone_type,
    CASE WHEN contains(q, 'high priority') OR contains(q, 'alta prioridad') THEN 'High Priority'
         WHEN contains(q, 'not prioritized') OR contains(q, 'sin prioridad') OR contains(q, 'no priorizado')
           THEN 'Not Prioritized'
         WHEN contains(q, 'prioritized') OR contains(q, 'priorizado') THEN 'Prioritized' END AS prioritization,
    CASE {names} ELSE CASE {codes} END END AS country,
    zone, city
  FROM pr_in)"""


def _metric_tag_cte() -> str:
    direct = "CASE " + " ".join(f"WHEN contains(q, {_lit(n.lower())}) THEN {_lit(n)}" for n in RCAT.names) + " END"
    return f"""
mt_base AS (SELECT conv_id, turn, q, {direct} AS direct FROM msg),
mt_chunks AS (
  SELECT conv_id, turn, cpos, {_strip('chunk')} AS chunk FROM (
    SELECT conv_id, turn, unnest(arr) AS chunk, generate_subscripts(arr, 1) AS cpos
    FROM (SELECT conv_id, turn, regexp_extract_all(q, {_lit(TR.CHUNK_PATTERN)}, 0) AS arr
          FROM mt_base WHERE direct IS NULL))),
{_resolve_sql('mt_chunks', 'chunk', 'mt_res').strip()},
mt_first AS (SELECT c.conv_id, c.turn, arg_min(r.canonical, c.cpos) AS from_chunk
             FROM mt_chunks c JOIN mt_res r ON c.chunk = r.chunk GROUP BY c.conv_id, c.turn),
mtag AS (SELECT b.conv_id, b.turn, coalesce(b.direct, f.from_chunk) AS metric
         FROM mt_base b LEFT JOIN mt_first f USING (conv_id, turn))"""


def _norm_alias(src_col: str, table: str, out: str) -> str:
    return (f"(SELECT arg_min(canonical, pos) FROM {table} WHERE alias = lower({_strip(src_col)}))")


def build_text(S: dict) -> None:
    tp = _text_prefix()
    S["resolve_labels"] = q(
        "SELECT l.conv_id, l.turn, l.label, r.canonical, r.step FROM lab l LEFT JOIN rl r ON l.label = r.label",
        tp + "," + _resolve_sql("lab", "label", "rl"))

    def by_alias(col, table, out, fallback):
        fb = f"coalesce(a.hit, {fallback})" if fallback else "a.hit"
        return q(f"""
SELECT l.conv_id, l.turn, l.{col}, CASE WHEN l.{col} IS NOT NULL AND l.{col} <> '' THEN {fb} END AS {out}
FROM (SELECT *, lower({_strip(col)}) AS _r FROM alab) l
LEFT JOIN (SELECT alias, arg_min(canonical, pos) AS hit FROM {table} GROUP BY alias) a ON a.alias = l._r""", tp)
    S["resolve_country"] = by_alias("country_label", "ctry", "country", None)
    S["resolve_zone_type"] = by_alias(
        "zone_type_label", "zty", "zone_type",
        "CASE WHEN contains(_r, 'wealthy') AND NOT contains(_r, 'non') THEN 'Wealthy'"
        " WHEN contains(_r, 'non') OR contains(_r, 'no') THEN 'Non Wealthy' END")
    S["resolve_priority"] = by_alias(
        "priority_label", "pri", "prioritization",
        "CASE WHEN contains(_r, 'high') THEN 'High Priority'"
        " WHEN contains(_r, 'not') OR contains(_r, 'sin') OR contains(_r, 'no ') THEN 'Not Prioritized'"
        " WHEN contains(_r, 'priorit') THEN 'Prioritized' END")
    n1 = _capped(f"regexp_extract(q, {_lit(TR.SCOPE_LAST_N)}, 1)", 8)
    n2 = _capped(f"regexp_extract(q, {_lit(TR.SCOPE_N)}, 1)", 8)
    n = f"coalesce({n1}, {n2})"
    S["week_scope"] = q(f"""
SELECT conv_id, turn, CASE WHEN {n} IS NOT NULL THEN 'range' ELSE 'single' END AS scope_type,
  CASE WHEN {n} IS NOT NULL THEN 'L' || CAST({n} AS VARCHAR) || 'W'
       WHEN {_any('q', TR.SCOPE_THIS_WEEK)} THEN 'L0W' WHEN {_any('q', TR.SCOPE_LAST_WEEK)} THEN 'L1W'
       ELSE 'L0W' END AS start_week, 'L0W' AS end_week, {n} AS n_weeks
FROM msg""", tp)
    S["concept_tag"] = q(f"""
SELECT conv_id, turn, CASE WHEN {_any('q', TR.CONCEPT_PROBLEM)} THEN 'zonas_problematicas'
  WHEN {_any('q', TR.CONCEPT_HIGH_LEAD)} AND {_any('q', TR.CONCEPT_LOW_PERFECT)} THEN 'alto_lead_bajo_perfect'
  WHEN {_any('q', TR.CONCEPT_GROWTH)} THEN 'zonas_en_crecimiento' END AS concept
FROM msg""", tp)
    S["gazetteer_tag"] = q("SELECT conv_id, turn, zone, city FROM places", tp)
    S["intent_tag"] = q("SELECT conv_id, turn, intent FROM pr_in", tp + "," + _params_cte())
    S["extract_params"] = q("SELECT * FROM params", tp + "," + _params_cte())
    S["metric_tag"] = q("SELECT * FROM mtag", tp + "," + _metric_tag_cte())
    S["context_carry"] = q(f"""
SELECT conv_id, turn, intent, CASE WHEN intent <> 'multivariable' THEN m END AS metric, country, city, zone
FROM replay WHERE ord > 0""", tp + "," + _params_cte() + "," + _metric_tag_cte() + f""",
one_place AS (SELECT lower(ZONE) AS zl, any_value(ZONE) AS uz, any_value(CITY) AS uc, any_value(COUNTRY) AS uk
              FROM (SELECT DISTINCT ZONE, CITY, COUNTRY FROM mw) GROUP BY 1 HAVING count(*) = 1),
turns AS (
  SELECT conv_id, turn, intent, metric, country, zone, city, {_any('q', TR.COUNTRY_FOLLOWUP)} AS fc, {_any('q', TR.ZONE_FOLLOWUP)} AS fz,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ord
  FROM params JOIN mtag USING (conv_id, turn) JOIN msg USING (conv_id, turn) WHERE role = 'user'),
replay(conv_id, ord, turn, intent, country, city, zone, m, k, z) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, NULL::BIGINT, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR,
         NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM turns
  UNION ALL
  SELECT conv_id, ord, turn, intent, country2, coalesce(city, uc), zone2, coalesce(CASE WHEN intent <> 'multivariable' THEN metric END, m),
         coalesce(country2, k), coalesce(zone2, z)
  FROM (SELECT t.conv_id, t.ord, t.turn, t.intent, t.metric, t.city, u.uc, r.m, r.k, r.z,
               coalesce(t.country, CASE WHEN t.fc THEN r.k END, u.uk) AS country2,
               coalesce(u.uz, t.zone, CASE WHEN t.fz THEN r.z END) AS zone2
        FROM replay r JOIN turns t ON t.conv_id = r.conv_id AND t.ord = r.ord + 1
        LEFT JOIN one_place u ON u.zl = lower(coalesce(t.zone, CASE WHEN t.fz THEN r.z END))))""").replace("WITH", "WITH RECURSIVE", 1)
    found = "flatten([" + ", ".join(f"CASE WHEN contains(q, {_lit(n.lower())}) THEN [{_lit(n)}] ELSE [] END"
                                   for n in RCAT.names) + "])"
    lead, qual = RCAT.lead, RCAT.quality
    S["metric_pair_tag"] = q(f"""
SELECT conv_id, turn, intent,
  CASE WHEN intent = 'multivariable' THEN CASE WHEN len(f) >= 1 THEN f[1] ELSE {_lit(lead)} END END AS metric_a,
  CASE WHEN intent = 'multivariable' THEN CASE WHEN len(f) >= 2 THEN f[2]
    WHEN len(f) = 1 THEN CASE WHEN f[1] <> {_lit(qual)} THEN {_lit(qual)} ELSE {_lit(lead)} END
    ELSE {_lit(qual)} END END AS metric_b
FROM (SELECT conv_id, turn, {found} AS f, intent
      FROM msg JOIN (SELECT conv_id, turn, intent FROM pr_in) USING (conv_id, turn))""", tp + "," + _params_cte())
    S["zone_catalog"] = q("""
SELECT zone_lower, ZONE, CITY, COUNTRY, n_places, n_places = 1 AS is_unique
FROM (SELECT *, lower(ZONE) AS zone_lower FROM (SELECT DISTINCT ZONE, CITY, COUNTRY FROM mw)) i
JOIN (SELECT lower(ZONE) AS zone_lower, CAST(count(*) AS BIGINT) AS n_places
      FROM (SELECT DISTINCT ZONE, CITY, COUNTRY FROM mw) GROUP BY 1) c USING (zone_lower)""", tp)
    S["repair_location"] = q(f"""
SELECT conv_id, turn,
  CASE WHEN hit AND (city IS NULL OR city = '') THEN uc ELSE city END AS city,
  CASE WHEN hit THEN uz ELSE zone END AS zone,
  CASE WHEN hit AND (country IS NULL OR country = '') THEN uk ELSE country END AS country,
  city_to_zone, hit AS unique_zone
FROM (
  SELECT s.*, u.zl IS NOT NULL AND lower({_strip("coalesce(s.zone, '')")}) <> '' AS hit, u.uz, u.uc, u.uk
  FROM (
    SELECT conv_id, turn, country,
      CASE WHEN mv THEN NULL ELSE city END AS city, CASE WHEN mv THEN cv ELSE zone END AS zone, mv AS city_to_zone
    FROM (SELECT r.*, lower({_strip("coalesce(r.city, '')")}) AS cv,
            lower({_strip("coalesce(r.city, '')")}) <> ''
            AND lower({_strip("coalesce(r.city, '')")}) NOT IN (SELECT lower(CITY) FROM mw)
            AND lower({_strip("coalesce(r.city, '')")}) IN (SELECT lower(ZONE) FROM mw)
            AND (r.zone IS NULL OR r.zone = '') AS mv
          FROM req r)) s
  LEFT JOIN (SELECT lower(ZONE) AS zl, ZONE AS uz, CITY AS uc, COUNTRY AS uk
             FROM (SELECT DISTINCT ZONE, CITY, COUNTRY FROM mw)
             QUALIFY count(*) OVER (PARTITION BY lower(ZONE)) = 1) u
    ON u.zl = lower({_strip("coalesce(s.zone, '')")})) x""", tp)
    has = lambda c: f"({c} IS NOT NULL AND {c} <> '')"
    r1 = "(group_by = 'ZONE_TYPE' AND intent IN ('comparison', 'aggregation'))"
    r1c = f"coalesce({r1}, false)"
    r2 = f"(NOT {r1c} AND intent IN ('trend', 'multivariable') AND {has('zone')})"
    drop = f"({r1c} OR coalesce({r2}, false))"
    S["filter_policy"] = q(f"""
SELECT conv_id, turn,
  CASE WHEN {has('country')} THEN country WHEN {has('sb_country')} THEN sb_country ELSE country END AS eff_country,
  city AS eff_city, zone AS eff_zone,
  CASE WHEN {drop} THEN NULL WHEN {has('zone_type')} THEN zone_type WHEN {has('sb_zone_type')} THEN sb_zone_type
       ELSE zone_type END AS eff_zone_type,
  CASE WHEN {has('prioritization')} THEN prioritization WHEN {has('sb_prioritization')} THEN sb_prioritization
       ELSE prioritization END AS eff_prioritization,
  CAST(CASE WHEN {drop} THEN CAST({has('zone_type')} AS INTEGER) + CAST({has('sb_zone_type')} AS INTEGER) ELSE 0 END
       AS BIGINT) AS n_warnings,
  CASE WHEN {r1c} THEN 'group_by_zone_type' WHEN coalesce({r2}, false) THEN 'named_zone' ELSE 'sidebar_fills' END
    AS rule
FROM req""", tp)
    S["trivial_filter_flag"] = q(f"""
SELECT conv_id, turn, intent,
  CASE WHEN intent = 'aggregation' AND {has('country')}
         THEN 'ℹ️ Filtro activo: país=' || country || '. La agregación por país mostrará solo un grupo.'
       WHEN intent = 'comparison' AND {has('zone_type')}
         THEN 'ℹ️ Filtro tipo=' || zone_type || ' activo en comparación.' END AS warning
FROM req""", tp)
    gmap = "CASE " + " ".join(f"WHEN lower(group_by) = {_lit(k)} THEN {_lit(v)}" for k, v in TR.GROUP_MAP) + " END"
    scope_n = _capped("regexp_extract(coalesce(time_scope, ''), 'L(\\d+)W', 1)")
    zt = (f"coalesce((SELECT arg_min(canonical, pos) FROM zty WHERE alias = lower({_strip('r.zone_type')})),"
          f" CASE WHEN contains(lower({_strip('r.zone_type')}), 'wealthy') AND NOT contains(lower({_strip('r.zone_type')}), 'non') THEN 'Wealthy'"
          f" WHEN contains(lower({_strip('r.zone_type')}), 'non') OR contains(lower({_strip('r.zone_type')}), 'no') THEN 'Non Wealthy' END)")
    pn = f"lower({_strip('r.prioritization')})"
    pr = (f"coalesce((SELECT arg_min(canonical, pos) FROM pri WHERE alias = {pn}),"
          f" CASE WHEN contains({pn}, 'high') THEN 'High Priority'"
          f" WHEN contains({pn}, 'not') OR contains({pn}, 'sin') OR contains({pn}, 'no ') THEN 'Not Prioritized'"
          f" WHEN contains({pn}, 'priorit') THEN 'Prioritized' END)")
    mres = "\n".join(f"LEFT JOIN nr {a} ON {a}.v = r.{c}" for c, a in
                     [("metric", "m0"), ("metric_a", "m1"), ("metric_b", "m2")])
    S["normalize_requests"] = q(f"""
SELECT r.conv_id, r.turn, r.intent,
  CASE WHEN {has('r.metric')} THEN coalesce(m0.canonical, r.metric) ELSE r.metric END AS metric,
  CASE WHEN {has('r.metric_a')} THEN coalesce(m1.canonical, r.metric_a) ELSE r.metric_a END AS metric_a,
  CASE WHEN {has('r.metric_b')} THEN coalesce(m2.canonical, r.metric_b) ELSE r.metric_b END AS metric_b,
  CASE WHEN {has('r.country')} THEN coalesce((SELECT arg_min(canonical, pos) FROM ctry
       WHERE alias = lower({_strip('r.country')})), r.country) ELSE r.country END AS country,
  CASE WHEN {has('r.zone_type')} THEN coalesce({zt}, r.zone_type) ELSE r.zone_type END AS zone_type,
  CASE WHEN {has('r.prioritization')} THEN coalesce({pr}, r.prioritization) ELSE r.prioritization END
    AS prioritization,
  CASE WHEN {has('r.group_by')} THEN coalesce({gmap.replace('group_by', 'r.group_by')}, r.group_by)
       ELSE r.group_by END AS group_by,
  CAST(CASE WHEN r.n_weeks IS NOT NULL AND r.n_weeks <> 0 THEN r.n_weeks
       WHEN {scope_n.replace('time_scope', 'r.time_scope')} > 0 THEN {scope_n.replace('time_scope', 'r.time_scope')}
       ELSE r.n_weeks END AS BIGINT) AS n_weeks
FROM req r
{mres}""", tp + ",\nnv AS (SELECT metric AS v FROM req UNION ALL SELECT metric_a FROM req UNION ALL"
            " SELECT metric_b FROM req)," + _resolve_sql("nv", "v", "nr0") + ",\nnr AS (SELECT v, canonical FROM nr0)")


def _build_sinks(S: dict) -> None:
    S["export_csv"] = S["top_zones"]


_build_core = build


def build() -> dict[str, str]:  # noqa: F811
    S = _build_core()
    _build_sinks(S)
    build_text(S)
    return S


# =============================================================== formats
def _fnum(x: str, d: int, plus: bool = False, commas: bool = False) -> str:
    scale = 10 ** d
    n = f"CAST(round_even(abs({x}) * {scale}, 0) AS BIGINT)"
    ip = f"({n} // {scale})" if d else n
    itxt = f"format('{{:,}}', {ip})" if commas else f"CAST({ip} AS VARCHAR)"
    body = itxt if d == 0 else f"{itxt} || '.' || lpad(CAST({n} % {scale} AS VARCHAR), {d}, '0')"
    sign = f"CASE WHEN {x} < 0 THEN '-' ELSE '{'+' if plus else ''}' END"
    return f"(CASE WHEN {x} IS NOT NULL THEN {sign} || {body} END)"


def _fpct(x: str, d: int = 1, plus: bool = False) -> str:
    return f"({_fnum(f'({x}) * 100', d, plus)} || '%')"


def _fcur(x: str) -> str:
    return f"('$' || {_fnum(x, 2, commas=True)})"


def build_formats(S: dict) -> None:
    from ..operators import report as REP

    unit = "coalesce(md.unit, 'ratio')"
    base = "FROM fact LEFT JOIN md USING (METRIC)"
    v = "L0W"
    S["format_value"] = q(f"""
SELECT COUNTRY, CITY, ZONE, METRIC, round({v}, 6) AS value,
  CASE WHEN {v} IS NULL THEN 'N/A' WHEN {unit} = 'ratio' THEN {_fpct(v)} WHEN {unit} = 'currency' THEN {_fcur(v)}
       WHEN {unit} = 'count' THEN {_fnum(v, 0, commas=True)} ELSE {_fnum(v, 4)} END AS text
{base}""")
    S["format_value_decimal"] = q(f"""
SELECT COUNTRY, CITY, ZONE, METRIC, round({v}, 6) AS value,
  CASE WHEN {v} IS NULL THEN 'N/A' WHEN {unit} = 'count' THEN {_fnum(v, 0, commas=True)}
       WHEN {unit} = 'currency' THEN {_fcur(v)} WHEN {unit} = 'decimal' THEN {_fnum(v, 2)}
       ELSE {_fpct(v)} END AS text
{base}""")
    c = "((L0W - L1W) / nullif(abs(L1W), 0))"
    S["format_change"] = q(f"""
SELECT COUNTRY, CITY, ZONE, METRIC, round({c}, 6) AS value,
  CASE WHEN {c} IS NULL THEN 'N/A' ELSE (CASE WHEN {c} > 0 THEN '+' ELSE '' END) || {_fpct(c)} END AS text
{base}""")
    lit = _lit
    action = "CASE " + " ".join(f"WHEN metric = {lit(m)} THEN {lit(a)}" for m, a in REP.METRIC_ACTIONS) + \
        f" ELSE {lit(REP.DEFAULT_ACTION)} END"
    zone, country, metric = "coalesce(zone, '')", "coalesce(country, '')", "coalesce(metric, '')"
    delta = "(value_to - value_from)"
    is_abs = f"(metric = {lit(CAT.profit)})"
    change = (f"CASE WHEN {is_abs} THEN (CASE WHEN {delta} < 0 THEN 'cayó' ELSE 'subió' END) || ' ' ||"
              f" {_fnum(f'abs({delta})', 2)} || ' unidades (' || {_fnum('value_from', 2)} || ' → ' ||"
              f" {_fnum('value_to', 2)} || ')'"
              f" ELSE 'cambió ' || {_fpct('pct_change', 1, True)} || ' WoW (' || {_fnum('value_from', 3)} || ' → ' ||"
              f" {_fnum('value_to', 3)} || ')' END")
    under = "(performance = 'underperformer')"
    n = "CAST(consecutive_weeks AS VARCHAR)"
    growth = f"coalesce({_fpct('order_growth', 1, True)}, 'N/A')"
    basef = f"coalesce({_fnum('CAST(CAST(orders_base AS BIGINT) AS DOUBLE)', 0, commas=True)}, 'N/A')"
    interp = (f"CASE WHEN type = 'opportunity' THEN 'Alta oferta vs. pares (' || country || '/' ||"
              f" coalesce(zone_type, '') || ') — Lead Pen: ' || {_fpct('lead_penetration')} || ', Perfect Orders: ' ||"
              f" {_fpct('perfect_orders')} || ' (umbral peers: ' || {_fpct('peer_perfect_threshold')} ||"
              f" '). Crecimiento órdenes (4w): ' || {growth} || ' sobre base de ' || {basef} || ' órdenes.'"
              f" ELSE interpretation END")
    cat = "CASE " + " ".join(f"WHEN type = {lit(k)} THEN {lit(v)}" for k, v in REP.CARD_CATEGORY) + " ELSE 'General' END"
    S["insight_card"] = q(f"""
SELECT section, list_pos, type,
  CASE WHEN type = 'anomaly' THEN category || ' brusca en ' || {metric} || ' — ' || {zone} || ' (' || {country} || ')'
       WHEN type = 'consistent_deterioration' THEN 'Deterioro sostenido de ' || {metric} || ' — ' || {zone} || ' ('
         || {country} || ')'
       WHEN type = 'benchmarking' THEN (CASE WHEN {under} THEN 'Sub' ELSE 'Sobre' END) || 'performance en ' ||
         {metric} || ' — ' || {zone} || ' (' || {country} || ')'
       WHEN type = 'correlation' THEN 'Correlación ' || coalesce(direction, '') || ' entre ' || {metric} || ' y ' ||
         coalesce(metric_b, '')
       WHEN type = 'opportunity' THEN 'Oportunidad de mejora en calidad — ' || {zone} || ' (' || {country} || ')'
       WHEN type = 'data_quality' THEN 'Valor fuera de rango: ' || {metric} || ' = ' || {_fnum('value', 3)} ||
         ' en ' || {zone} || ' (' || {country} || ')' END AS title,
  {cat} AS card_category,
  CASE WHEN type = 'anomaly' THEN {metric} || ' ' || ({change}) || ' en ' || {zone} || '.'
       WHEN type = 'consistent_deterioration' THEN {metric} || ' ha caído ' || {n} || ' semanas consecutivas en ' ||
         {zone} || ' (' || {country} || '). Cambio acumulado: ' || {_fpct('total_pct_change', 1, True)} ||
         '. Valor actual: ' || {_fnum('current_value', 3)} || '.'
       WHEN type = 'benchmarking' THEN {zone} || ': ' || {metric} || ' = ' || {_fnum('current_value', 3)} ||
         ' vs. promedio de pares (' || coalesce(zone_type, '') || ', ' || {country} || ') = ' ||
         {_fnum('group_mean', 3)} || '. Z-score: ' || {_fnum('z_score', 2, True)} || '.'
       WHEN type = 'correlation' THEN 'Correlación Pearson = ' || {_fnum('correlation', 2)} || ' (' ||
         {_fpct('abs(correlation)', 0)} || ' de fuerza asociativa).'
       WHEN type = 'opportunity' THEN interp
       WHEN type = 'data_quality' THEN {metric} || ' reporta ' || {_fnum('value', 3)} || ' en ' || {zone} ||
         '. Rango esperado: ' || expected_range || '.' END AS evidence,
  CASE WHEN type = 'anomaly' THEN {lit(REP.WHY_ANOMALY)}
       WHEN type = 'consistent_deterioration' THEN 'Un deterioro de ' || {n} ||
         '+ semanas sugiere un problema estructural, no un evento puntual. Puede afectar retención y GMV.'
       WHEN type = 'benchmarking' THEN {lit(REP.WHY_BENCH)}
       WHEN type = 'correlation' THEN coalesce(interpretation, '')
       WHEN type = 'opportunity' THEN {lit(REP.WHY_OPP)}
       WHEN type = 'data_quality' THEN {lit(REP.WHY_DQ)} END AS why_it_matters,
  CASE WHEN type = 'anomaly' THEN (CASE WHEN category = 'Deterioro' THEN 'Investigar causa del deterioro'
         ELSE 'Validar y capitalizar la mejora' END) || ' en ' || {zone} || ': ' || ({action}) || '.'
       WHEN type = 'consistent_deterioration' THEN 'Priorizar revisión en ' || {zone} || ': ' || ({action}) || '.'
       WHEN type = 'benchmarking' THEN (CASE WHEN {under} THEN 'Investigar qué falla en'
         ELSE 'Identificar best practices de' END) || ' ' || {zone} || ' y replicar al resto del grupo: ' ||
         ({action}) || '.'
       WHEN type = 'correlation' THEN {lit(REP.REC_CORR)}
       WHEN type = 'opportunity' THEN 'Activar plan de calidad en ' || {zone} || ': ' || {lit(REP.DEFAULT_ACTION)}
         || '.'
       WHEN type = 'data_quality' THEN 'Validar fuente de datos para ' || {zone} || ' — ' || {metric} ||
         '. Excluir de análisis comparativos hasta confirmar.' END AS recommendation,
  CASE WHEN type = 'opportunity' THEN 'media' ELSE coalesce(severity, 'media') END AS severity
FROM (SELECT * REPLACE ({interp} AS interpretation) FROM ins)""".replace("interp\n", "interpretation\n"),
        _all_insights_cte())


_build_with_text = build


def build() -> dict[str, str]:  # noqa: F811
    S = _build_with_text()
    build_formats(S)
    return S

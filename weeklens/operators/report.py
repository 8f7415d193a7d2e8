"""Insight union and report selections.

The union of detector outputs is bounded by the detectors' top-n limits (at
most a few dozen rows), so the windows here only ever number those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..frames import Frames
from . import detectors as D

CARD_COLUMNS = {
    "section": "string", "type": "string", "category": "string", "list_pos": "bigint",
    "zone": "string", "country": "string", "city": "string", "zone_type": "string",
    "zone_prioritization": "string", "metric": "string", "metric_b": "string",
    "value_from": "double", "value_to": "double", "pct_change": "double",
    "consecutive_weeks": "bigint", "total_pct_change": "double", "current_value": "double",
    "group_mean": "double", "z_score": "double", "performance": "string",
    "correlation": "double", "direction": "string", "interpretation": "string",
    "lead_penetration": "double", "perfect_orders": "double", "peer_perfect_threshold": "double",
    "order_growth": "double", "orders_base": "double", "value": "double", "expected_range": "string",
    "severity": "string",
}

# section names in the order the original lists them in the report summary
SECTIONS = ["anomalies", "trends", "benchmarks", "correlations", "opportunities", "data_quality"]
# top-5 selection priority and the order findings are pooled in
TOP_PRIORITY = ["trends", "anomalies", "benchmarks", "opportunities", "correlations", "data_quality"]


def _card(df: DataFrame, section: str) -> DataFrame:
    if "metric_a" in df.columns:
        df = df.withColumnRenamed("metric_a", "metric")
    df = df.withColumn("section", F.lit(section))
    if "list_pos" not in df.columns:
        df = df.withColumn("list_pos", F.col("position"))
    cols = []
    for c, t in CARD_COLUMNS.items():
        cols.append(F.col(c).cast(t).alias(c) if c in df.columns else F.lit(None).cast(t).alias(c))
    return df.select(*cols)


def all_insights(fr: Frames, min_orders_base: float = 50) -> DataFrame:
    """Every detector's findings in one card-shaped table."""
    bench = D.benchmarking_all(fr, top_n=5, list_pos=True)
    parts = [
        _card(D.anomalies(fr), "anomalies"),
        _card(D.trends_insight(fr), "trends"),
        _card(bench, "benchmarks"),
        _card(D.correlations(fr), "correlations"),
        _card(D.opportunities(fr, min_orders_base=min_orders_base), "opportunities"),
        _card(D.data_quality(fr), "data_quality"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def insights_table(fr: Frames, min_orders_base: float = 50) -> DataFrame:
    """The insight union computed once per Frames and checkpointed (reliable, to
    ``spark.checkpoint.dir``): report selections then read a short lineage
    instead of re-running every detector. The table is bounded by the
    detectors' top-n limits."""
    from ..session import ensure_checkpoint_dir

    key = ("insights", min_orders_base)
    if key not in fr.memo:
        ensure_checkpoint_dir(fr.spark)
        fr.memo[key] = all_insights(fr, min_orders_base).checkpoint(eager=True)
    return fr.memo[key]


def insight_counts(insights: DataFrame) -> DataFrame:
    """Findings per section; ``total`` leaves data_quality out."""
    spark = insights.sparkSession
    from ..functions.literal import literal_table

    names = literal_table(spark, [(s, i) for i, s in enumerate(SECTIONS)], "section string, section_pos int")
    counts = insights.groupBy("section").agg(F.count(F.lit(1)).alias("n"))
    per = names.join(counts, "section", "left").select(
        "section", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_findings")
    )
    total = per.filter(F.col("section") != "data_quality").agg(
        F.lit("total").alias("section"), F.sum("n_findings").cast("bigint").alias("n_findings")
    )
    return per.unionByName(total)


def _priority(col: str, order: list[str]):
    expr = F.lit(len(order))
    for i, s in reversed(list(enumerate(order))):
        expr = F.when(F.col(col) == s, F.lit(i)).otherwise(expr)
    return expr


def diversified_top5(insights: DataFrame, k: int = 5) -> DataFrame:
    """First finding of each section by priority, then the rest with 'alta' first."""
    df = insights.withColumn("sec_rank", _priority("section", TOP_PRIORITY))
    first = Window.partitionBy("section").orderBy("list_pos")
    df = df.withColumn("_first", F.row_number().over(first) == 1)
    chosen = df.filter("_first").withColumn("tier", F.lit(0))
    # the pool of remaining findings excludes data_quality (it is never pooled)
    rest = df.filter(~F.col("_first") & (F.col("section") != "data_quality")).withColumn("tier", F.lit(1))
    order = [F.col("tier"), F.when(F.col("tier") == 0, F.lit(0)).otherwise((F.col("severity") != "alta").cast("int")),
             F.col("sec_rank"), F.col("list_pos")]
    top = chosen.unionByName(rest).orderBy(*order).limit(k)
    return top.withColumn("top_rank", F.row_number().over(Window.orderBy(*order)).cast("bigint")).select(
        "top_rank", "section", "type", "category", "zone", "country", "metric", "metric_b", "severity", "list_pos"
    )


def report_sections(insights: DataFrame, per_section: int = 8) -> DataFrame:
    """The first findings of each report section."""
    w = Window.partitionBy("section").orderBy("list_pos")
    df = insights.withColumn("section_rank", F.row_number().over(w).cast("bigint"))
    return df.filter(F.col("section_rank") <= per_section).select(
        "section", "section_rank", "type", "category", "zone", "country", "metric", "metric_b", "severity"
    )


# ---------------------------------------------------------------- F10 insight cards
# Per-metric recommended action (original metric names), the
# default action and the fixed card sentences.
METRIC_ACTIONS = [
    ("Perfect Orders", "revisar tasa de defectos, cancelaciones y SLA de entrega"),
    ("Lead Penetration", "revisar habilitación de tiendas y densidad de oferta en la zona"),
    ("Gross Profit UE", "revisar mix de productos, descuentos aplicados y costos logísticos"),
    ("Restaurants SS > ATC CVR", "revisar catálogo, fotos y pricing en restaurantes"),
    ("Restaurants SST > SS CVR", "revisar relevancia del listado y posicionamiento de tiendas"),
    ("Retail SST > SS CVR", "revisar disponibilidad y presentación de supermercados"),
    ("Pro Adoption (Last Week Status)", "revisar comunicación y beneficios del programa Pro"),
    ("Turbo Adoption", "revisar cobertura y visibilidad del servicio Turbo"),
    ("Non-Pro PTC > OP", "revisar el funnel de checkout y posibles fricciones de pago"),
]
DEFAULT_ACTION = "revisar operaciones y datos de la zona"
WHY_ANOMALY = ("Un cambio abrupto puede indicar un problema operacional puntual "
               "o una mejora inesperada que merece seguimiento.")
WHY_BENCH = "La divergencia respecto a pares puede revelar prácticas o condiciones específicas."
REC_CORR = ("Usar esta relación para priorizar intervenciones: "
            "mejorar la métrica palanca puede impactar ambas simultáneamente.")
WHY_OPP = ("Esta zona tiene buena oferta y demanda creciente, pero calidad por debajo de sus pares. "
           "Mejorar Perfect Orders aquí puede amplificar el crecimiento.")
WHY_DQ = "Valores fuera de rango pueden distorsionar benchmarks, correlaciones y rankings."
CARD_CATEGORY = [("anomaly", "🚨 Anomalía"), ("consistent_deterioration", "📉 Tendencia Preocupante"),
                 ("benchmarking", "📊 Benchmarking"), ("correlation", "🔗 Correlación"),
                 ("opportunity", "🌟 Oportunidad"), ("data_quality", "⚠️ Calidad de Datos")]


def opportunity_text(df: DataFrame, n_weeks_growth: int = 4) -> DataFrame:
    """The opportunity interpretation sentence (used as the card evidence)."""
    from ..functions.fmt import fmt_num, fmt_pct

    growth = F.coalesce(fmt_pct(F.col("order_growth"), 1, plus=True), F.lit("N/A"))
    base = F.coalesce(fmt_num(F.col("orders_base").cast("bigint").cast("double"), 0, commas=True), F.lit("N/A"))
    text = F.concat(
        F.lit("Alta oferta vs. pares ("), F.col("country"), F.lit("/"), F.coalesce("zone_type", F.lit("")),
        F.lit(") — Lead Pen: "), fmt_pct(F.col("lead_penetration")), F.lit(", Perfect Orders: "),
        fmt_pct(F.col("perfect_orders")), F.lit(" (umbral peers: "), fmt_pct(F.col("peer_perfect_threshold")),
        F.lit(f"). Crecimiento órdenes ({n_weeks_growth}w): "), growth, F.lit(" sobre base de "), base,
        F.lit(" órdenes."),
    )
    return df.withColumn("interpretation", F.when(F.col("type") == "opportunity", text)
                         .otherwise(F.col("interpretation")))


def insight_card(insights: DataFrame, profit_metrics: list[str]) -> DataFrame:
    """title, category, evidence, why, recommendation and severity per finding."""
    from ..functions.fmt import fmt_num, fmt_pct

    df = opportunity_text(insights)
    action = F.lit(DEFAULT_ACTION)
    for m, a in reversed(METRIC_ACTIONS):
        action = F.when(F.col("metric") == m, F.lit(a)).otherwise(action)
    t = F.col("type")
    zone, country, metric = F.coalesce("zone", F.lit("")), F.coalesce("country", F.lit("")), F.coalesce(
        "metric", F.lit(""))
    vf, vt = F.col("value_from"), F.col("value_to")
    is_abs = F.col("metric").isin(*profit_metrics) if profit_metrics else F.lit(False)
    delta = vt - vf
    change = F.when(
        is_abs,
        F.concat(F.when(delta < 0, F.lit("cayó")).otherwise(F.lit("subió")), F.lit(" "), fmt_num(F.abs(delta), 2),
                 F.lit(" unidades ("), fmt_num(vf, 2), F.lit(" → "), fmt_num(vt, 2), F.lit(")")),
    ).otherwise(F.concat(F.lit("cambió "), fmt_pct(F.col("pct_change"), 1, plus=True), F.lit(" WoW ("),
                         fmt_num(vf, 3), F.lit(" → "), fmt_num(vt, 3), F.lit(")")))
    det = F.col("category") == "Deterioro"
    under = F.col("performance") == "underperformer"
    n = F.col("consecutive_weeks").cast("string")
    z = F.col("z_score")
    corr = F.col("correlation")
    title = (
        F.when(t == "anomaly", F.concat(F.col("category"), F.lit(" brusca en "), metric, F.lit(" — "), zone,
                                        F.lit(" ("), country, F.lit(")")))
        .when(t == "consistent_deterioration", F.concat(F.lit("Deterioro sostenido de "), metric, F.lit(" — "),
                                                        zone, F.lit(" ("), country, F.lit(")")))
        .when(t == "benchmarking", F.concat(F.when(under, "Sub").otherwise("Sobre"), F.lit("performance en "),
                                            metric, F.lit(" — "), zone, F.lit(" ("), country, F.lit(")")))
        .when(t == "correlation", F.concat(F.lit("Correlación "), F.coalesce("direction", F.lit("")),
                                           F.lit(" entre "), metric, F.lit(" y "), F.coalesce("metric_b", F.lit(""))))
        .when(t == "opportunity", F.concat(F.lit("Oportunidad de mejora en calidad — "), zone, F.lit(" ("),
                                           country, F.lit(")")))
        .when(t == "data_quality", F.concat(F.lit("Valor fuera de rango: "), metric, F.lit(" = "),
                                            fmt_num(F.col("value"), 3), F.lit(" en "), zone, F.lit(" ("), country,
                                            F.lit(")")))
    )
    category = F.lit("General")
    for k, v in reversed(CARD_CATEGORY):
        category = F.when(t == k, F.lit(v)).otherwise(category)
    evidence = (
        F.when(t == "anomaly", F.concat(metric, F.lit(" "), change, F.lit(" en "), zone, F.lit(".")))
        .when(t == "consistent_deterioration", F.concat(
            metric, F.lit(" ha caído "), n, F.lit(" semanas consecutivas en "), zone, F.lit(" ("), country,
            F.lit("). Cambio acumulado: "), fmt_pct(F.col("total_pct_change"), 1, plus=True),
            F.lit(". Valor actual: "), fmt_num(F.col("current_value"), 3), F.lit(".")))
        .when(t == "benchmarking", F.concat(
            zone, F.lit(": "), metric, F.lit(" = "), fmt_num(F.col("current_value"), 3),
            F.lit(" vs. promedio de pares ("), F.coalesce("zone_type", F.lit("")), F.lit(", "), country,
            F.lit(") = "), fmt_num(F.col("group_mean"), 3), F.lit(". Z-score: "), fmt_num(z, 2, plus=True),
            F.lit(".")))
        .when(t == "correlation", F.concat(
            F.lit("Correlación Pearson = "), fmt_num(corr, 2), F.lit(" ("), fmt_pct(F.abs(corr), 0),
            F.lit(" de fuerza asociativa).")))
        .when(t == "opportunity", F.col("interpretation"))
        .when(t == "data_quality", F.concat(metric, F.lit(" reporta "), fmt_num(F.col("value"), 3), F.lit(" en "),
                                            zone, F.lit(". Rango esperado: "), F.col("expected_range"), F.lit(".")))
    )
    why = (
        F.when(t == "anomaly", F.lit(WHY_ANOMALY))
        .when(t == "consistent_deterioration", F.concat(
            F.lit("Un deterioro de "), n,
            F.lit("+ semanas sugiere un problema estructural, no un evento puntual. Puede afectar retención y GMV.")))
        .when(t == "benchmarking", F.lit(WHY_BENCH))
        .when(t == "correlation", F.coalesce("interpretation", F.lit("")))
        .when(t == "opportunity", F.lit(WHY_OPP))
        .when(t == "data_quality", F.lit(WHY_DQ))
    )
    rec = (
        F.when(t == "anomaly", F.concat(
            F.when(det, F.lit("Investigar causa del deterioro")).otherwise(F.lit("Validar y capitalizar la mejora")),
            F.lit(" en "), zone, F.lit(": "), action, F.lit(".")))
        .when(t == "consistent_deterioration", F.concat(F.lit("Priorizar revisión en "), zone, F.lit(": "), action,
                                                        F.lit(".")))
        .when(t == "benchmarking", F.concat(
            F.when(under, F.lit("Investigar qué falla en")).otherwise(F.lit("Identificar best practices de")),
            F.lit(" "), zone, F.lit(" y replicar al resto del grupo: "), action, F.lit(".")))
        .when(t == "correlation", F.lit(REC_CORR))
        .when(t == "opportunity", F.concat(F.lit("Activar plan de calidad en "), zone, F.lit(": "),
                                           F.lit(DEFAULT_ACTION), F.lit(".")))
        .when(t == "data_quality", F.concat(F.lit("Validar fuente de datos para "), zone, F.lit(" — "), metric,
                                            F.lit(". Excluir de análisis comparativos hasta confirmar.")))
    )
    return df.select(
        "section", "list_pos", "type",
        title.alias("title"), category.alias("card_category"), evidence.alias("evidence"),
        why.alias("why_it_matters"), rec.alias("recommendation"),
        F.when(t == "opportunity", F.lit("media")).otherwise(F.coalesce("severity", F.lit("media"))).alias("severity"),
    )

"""Metric catalogue: per-metric attributes, roles, and the alias dictionary.

A catalogue is a small, fixed-size list kept on the driver and turned into a
``metric_dim`` DataFrame (one row per metric). Its size is bounded by the number
of catalogued metrics, so it is safe to broadcast.

Roles tie generic operators to specific metrics:

* ``lead``    - supply ratio with a strict upper outlier bound (split off in rankings)
* ``quality`` - quality ratio used by opportunities and benchmarking
* ``profit``  - crosses zero; anomalies use an absolute delta scaled by a width
* ``volume``  - the order count, stored in the orders table
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class MetricSpec:
    name: str
    higher_is_better: bool
    unit: str  # ratio | decimal | currency | count
    lo: float
    hi: float
    hi_strict: bool = False
    min_abs_change: float = 0.0
    role: str | None = None
    aliases: tuple[str, ...] = ()
    category: str = ""
    # absolute-delta anomaly path (profit role): minimum |delta| and scale width
    abs_delta_min: float | None = None
    abs_delta_scale: float | None = None


@dataclass(frozen=True)
class Catalog:
    metrics: tuple[MetricSpec, ...]
    zone_types: tuple[tuple[str, tuple[str, ...]], ...] = ()
    prioritizations: tuple[tuple[str, tuple[str, ...]], ...] = ()
    countries: tuple[tuple[str, tuple[str, ...]], ...] = ()
    volume_metric: str = "Orders"
    unknown_range: tuple[float, float] = (-1e9, 1e9)
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def by_role(self, role: str) -> MetricSpec:
        for m in self.metrics:
            if m.role == role:
                return m
        raise KeyError(role)

    def get(self, name: str) -> MetricSpec | None:
        for m in self.metrics:
            if m.name == name:
                return m
        return None

    @property
    def names(self) -> list[str]:
        return [m.name for m in self.metrics]

    @property
    def lead(self) -> str:
        return self.by_role("lead").name

    @property
    def quality(self) -> str:
        return self.by_role("quality").name

    @property
    def profit(self) -> str:
        return self.by_role("profit").name

    def non_volume(self) -> list[str]:
        return [m.name for m in self.metrics if m.name != self.volume_metric]

    def outlier_limit(self) -> float:
        return self.by_role("lead").hi


METRIC_DIM_SCHEMA = T.StructType(
    [
        T.StructField("METRIC", T.StringType(), False),
        T.StructField("metric_pos", T.IntegerType(), False),
        T.StructField("higher_is_better", T.BooleanType(), False),
        T.StructField("unit", T.StringType(), False),
        T.StructField("range_lo", T.DoubleType(), False),
        T.StructField("range_hi", T.DoubleType(), False),
        T.StructField("hi_strict", T.BooleanType(), False),
        T.StructField("min_abs_change", T.DoubleType(), False),
        T.StructField("role", T.StringType(), True),
        T.StructField("abs_delta_min", T.DoubleType(), True),
        T.StructField("abs_delta_scale", T.DoubleType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("range_text", T.StringType(), False),
    ]
)


def metric_dim(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """One row per catalogued metric (bounded size, broadcastable)."""
    rows = [
        (
            m.name,
            i,
            m.higher_is_better,
            m.unit,
            float(m.lo),
            float(m.hi),
            m.hi_strict,
            float(m.min_abs_change),
            m.role,
            m.abs_delta_min,
            m.abs_delta_scale,
            m.category,
            f"[{m.lo}, {m.hi}]",
        )
        for i, m in enumerate(catalog.metrics)
    ]
    from .functions.literal import literal_table

    return literal_table(spark, rows, METRIC_DIM_SCHEMA)


def alias_rows(catalog: Catalog) -> list[tuple[str, int, str, int]]:
    """(canonical, metric position, alias, alias position) in dictionary order."""
    out = []
    for i, m in enumerate(catalog.metrics):
        for j, a in enumerate(m.aliases):
            out.append((m.name, i, a, j))
    return out


# ---------------------------------------------------------------------------
# The original metric dictionary (canonical names in dictionary
# order, direction, unit, category, aliases) together with the live range and
# minimum-change limits of the insight detectors, the zone-type,
# prioritisation and country alias lists. These must stay exactly as written
# for results to match.
# ---------------------------------------------------------------------------
REFERENCE_CATALOG = Catalog(
    metrics=(
        MetricSpec("Lead Penetration", True, "decimal", 0, 2.0, True, 0.02, "lead",
                   ("lead penetration", "lead pen", "penetración de leads", "penetracion"), "supply"),
        MetricSpec("Perfect Orders", True, "ratio", 0, 1.0, False, 0.02, "quality",
                   ("perfect orders", "perfect order", "ordenes perfectas", "órdenes perfectas"), "quality"),
        MetricSpec("Gross Profit UE", True, "currency", -100, 15, False, 1.00, "profit",
                   ("gross profit", "gross profit ue", "gp ue", "margen bruto", "utilidad"), "financial",
                   abs_delta_min=1.5, abs_delta_scale=110.0),
        MetricSpec("Pro Adoption (Last Week Status)", True, "ratio", 0, 1.0, False, 0.01, None,
                   ("pro adoption", "adopción pro", "adopcion pro"), "subscription"),
        MetricSpec("% PRO Users Who Breakeven", True, "ratio", 0, 1.0, False, 0.01, None,
                   ("pro breakeven", "breakeven", "pro who breakeven"), "subscription"),
        MetricSpec("MLTV Top Verticals Adoption", True, "ratio", 0, 1.0, False, 0.01, None,
                   ("mltv", "vertical adoption", "adopción verticales", "multi vertical"), "engagement"),
        MetricSpec("Restaurants SS > ATC CVR", True, "ratio", 0, 1.0, False, 0.02, None,
                   ("restaurants atc cvr", "ss atc", "atc cvr", "conversión atc"), "conversion"),
        MetricSpec("Restaurants SST > SS CVR", True, "ratio", 0, 1.0, False, 0.02, None,
                   ("restaurants sst ss", "sst ss cvr restaurants", "conversión restaurantes"), "conversion"),
        MetricSpec("Retail SST > SS CVR", True, "ratio", 0, 1.0, False, 0.02, None,
                   ("retail sst ss", "sst ss cvr retail", "conversión retail", "retail cvr"), "conversion"),
        MetricSpec("% Restaurants Sessions With Optimal Assortment", True, "ratio", 0, 1.0, False, 0.02, None,
                   ("optimal assortment", "assortment", "surtido óptimo", "surtido"), "supply"),
        MetricSpec("Non-Pro PTC > OP", True, "ratio", 0, 1.0, False, 0.02, None,
                   ("non pro ptc", "ptc op", "conversión no pro", "non pro conversion"), "conversion"),
        MetricSpec("Turbo Adoption", True, "ratio", 0, 1.0, False, 0.01, None,
                   ("turbo", "turbo adoption", "adopción turbo"), "engagement"),
        MetricSpec("Restaurants Markdowns / GMV", False, "ratio", 0, 0.5, False, 0.02, None,
                   ("markdowns", "markdown gmv", "descuentos", "markdowns gmv"), "financial"),
        MetricSpec("Orders", True, "count", 0, 1e8, False, 10, "volume",
                   ("orders", "órdenes", "ordenes", "pedidos", "volumen"), "volume"),
    ),
    zone_types=(
        ("Wealthy", ("wealthy", "rico", "alta renta", "high income")),
        ("Non Wealthy", ("non wealthy", "no rico", "baja renta", "low income")),
    ),
    prioritizations=(
        ("High Priority", ("high priority", "alta prioridad", "prioritario", "high")),
        ("Prioritized", ("prioritized", "priorizado", "medium priority")),
        ("Not Prioritized", ("not prioritized", "no priorizado", "low priority", "sin prioridad")),
    ),
    countries=(
        ("AR", ("argentina", "ar")),
        ("BR", ("brazil", "brasil", "br")),
        ("CL", ("chile", "cl")),
        ("CO", ("colombia", "co")),
        ("CR", ("costa rica", "cr")),
        ("EC", ("ecuador", "ec")),
        ("MX", ("mexico", "méxico", "mx")),
        ("PE", ("peru", "perú", "pe")),
        ("UY", ("uruguay", "uy")),
    ),
)


# Catalogue of the metrics derived from the TPC-H-like test tables (see
# FIXTURES.md §2). Each stands in for one role of the original catalogue.
TESTDATA_CATALOG = Catalog(
    metrics=(
        MetricSpec("UnitsPerLine", True, "decimal", 0, 5.0, True, 0.02, "lead",
                   ("units per line", "units", "unidades por linea"), "supply"),
        MetricSpec("Finished", True, "ratio", 0, 1.0, False, 0.02, "quality",
                   ("finished", "finished orders", "ordenes terminadas"), "quality"),
        MetricSpec("TicketDelta", True, "currency", -100, 15, False, 1.00, "profit",
                   ("ticket delta", "ticket", "ticket promedio"), "financial",
                   abs_delta_min=1.5, abs_delta_scale=110.0),
        MetricSpec("LargeOrders", True, "ratio", 0, 1.0, False, 0.01, None,
                   ("large orders", "large", "ordenes grandes"), "engagement"),
        MetricSpec("Returned", False, "ratio", 0, 0.5, False, 0.02, None,
                   ("returned", "returns", "devoluciones"), "financial"),
        MetricSpec("Orders", True, "count", 0, 1e8, False, 10, "volume",
                   ("orders", "órdenes", "ordenes", "pedidos", "volumen"), "volume"),
    ),
    zone_types=REFERENCE_CATALOG.zone_types,
    prioritizations=REFERENCE_CATALOG.prioritizations,
    countries=(),
)

WEEK_LABELS = [f"L{i}W" for i in range(8, -1, -1)]  # oldest (L8W) .. newest (L0W)
IDS = ["COUNTRY", "CITY", "ZONE"]
ZONE_ATTRS = ["ZONE_TYPE", "ZONE_PRIORITIZATION"]

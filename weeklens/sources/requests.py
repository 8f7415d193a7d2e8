"""Request and label tables derived from the ``conversations`` test table.

The test conversations are invented prose, so keyword hits would be rare. Each
conversation row is therefore paired with one entry of fixed literal lists
(questions, raw labels, structured requests), picked by (conv_id, turn); the
question is prepended to the row's whole text. Work grows with the
conversations table; nothing is sampled or cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Literal inputs of the text jobs (questions in the style of the
# original demo questions, with zone/city names of the test tables; raw labels
# covering exact, alias, containment, fuzzy and unknown cases).
QUESTIONS = [
    "¿Cuáles son las top 5 zonas con mayor lead penetration esta semana?",
    "Compara el perfect order entre zonas wealthy vs non wealthy en colombia",
    "Muestra la evolución de gross profit ue en supplier#000000001 en las últimas 8 semanas",
    "¿Cuál es el promedio de lead penetration por país?",
    "¿Qué zonas tienen alto lead penetration pero bajo perfect order?",
    "¿Cuáles son las zonas que más crecen en órdenes en las últimas 5 semanas?",
    "y ahora solo para mexico",
    "what about the same zone last 4 weeks",
    "top 10 zones by turbo adoption in high priority zones",
    "show anomalies in markdowns this week",
    "average pro adoption by city",
    "compare retail cvr by zone type",
    "trend of ordenes perfectas in nation_3 last 3 weeks",
    "zonas problemáticas con cambio brusco",
    "¿Cuál es la tendencia de surtido en supplier#000000003?",
    "high gp ue but low turbo",
    "3 zonas con peor non pro ptc sin prioridad",
    "evolución de lead pen también en esa zona",
    "¿cómo va el breakeven en brasil? mismo periodo",
    "zxkqwerty",
]
LABELS = [
    "Lead Penetration", "lead pen", "perfect order", "gross profit", "markdowns", "lead penetracion",
    "zxkqwerty", "turbo adoptoin", "  Perfect Orders ", "GP UE", "surtido optimo", "orders", "pedidos",
    "retail", "vertical", "",
]
COUNTRY_LABELS = ["colombia", "mexico", "CO", "brasil", "méxico", " Peru ", "uy", "atlantis"]
ZONE_TYPE_LABELS = ["wealthy", "non wealthy", "no rico", "Rico", "nonwealthy", "norte", "alta renta", "xyz"]
PRIORITY_LABELS = ["high priority", "alta prioridad", "not prioritized", "sin prioridad", "Prioritized", "high",
                   "no priority", "prioritario", "medium"]
# structured requests: (intent, group_by, city, zone, country, zone_type, prioritization,
#                       sidebar_country, sidebar_zone_type, sidebar_prioritization,
#                       metric, metric_a, metric_b, time_scope, n_weeks)
REQUESTS = [
    ("comparison", "ZONE_TYPE", None, None, "CO", "Non Wealthy", None, None, "Non Wealthy", None,
     "perfect order", None, None, "L0W", None),
    ("trend", None, "SUPPLIER#000000001", None, None, "Non Wealthy", None, None, "Non Wealthy", None,
     "gp ue", None, None, "L8W-L0W", None),
    ("trend", None, None, "supplier#000000002", None, None, None, "AMERICA", None, None,
     "lead pen", None, None, "L5W-L0W", None),
    ("aggregation", "country", None, None, "colombia", None, None, None, None, "High Priority",
     "Lead Penetration", None, None, "L0W", None),
    ("multivariable", None, None, "nation_7", None, "wealthy", None, None, "Wealthy", None,
     None, "lead pen", "perfect orders", "L0W", None),
    ("ranking", None, "nation_4", None, None, None, "high", None, "Wealthy", "Prioritized",
     "turbo", None, None, "L3W-L0W", 2),
    ("comparison", "zone_type", None, None, None, "rico", None, "CO", None, None,
     "markdowns", None, None, "L0W", None),
    ("growth_explanation", None, "supplier#000000007", "nation_2", "mx", None, "sin prioridad", None, None,
     None, "zxkqwerty", None, None, "L4W", None),
]


def pick(items: list, n_col: Column) -> Column:
    """items[(conv_id * 7 + turn) % len(items)] as a column (list order preserved)."""
    return F.element_at(F.array(*[F.lit(x) for x in items]), (n_col % len(items) + 1).cast("int"))


def _key() -> Column:
    return F.col("conv_id") * 7 + F.col("turn")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, role, q: lower-cased question + newline + the row's whole text.

    The width of the text jobs follows the input's splits; map-only jobs do not shuffle.
    """
    c = conversations(spark, sf_dir)
    return c.select(
        "conv_id", "turn", "role",
        F.lower(F.concat(pick(QUESTIONS, _key()), F.lit("\n"), F.coalesce(F.col("text"), F.lit("")))).alias("q"),
    )


def _words(n: int) -> Column:
    """``n`` neighbouring words of the row's text, from a place picked by (conv_id, turn)."""
    words = F.split(F.coalesce(F.col("text"), F.lit("")), " ", -1)
    return F.array_join(F.slice(words, (_key() % F.size(words) + 1).cast("int"), n), " ")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn and one raw metric label per conversation row: two neighbouring words of the row's
    text, or (every third row) an entry of the literal list, so distinct labels grow with the data."""
    k = _key()
    label = F.when(k % 3 == 0, pick(LABELS, k)).otherwise(_words(2))
    return conversations(spark, sf_dir).select("conv_id", "turn", label.alias("label"))


def _phrases() -> Column:
    """All single words and pairs of neighbouring words of the row's whole text."""
    words = F.split(F.coalesce(F.col("text"), F.lit("")), " ", -1)
    n = F.size(words) - 1
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, pairs)


def attribute_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn and the raw labels of a conversation row, one row each: every distinct word and pair of
    neighbouring words of its whole text, and one entry of each literal list besides. Every label is tried as
    a country, a zone type and a priority."""
    literals = F.array(*[pick(x, _key()) for x in (COUNTRY_LABELS, ZONE_TYPE_LABELS, PRIORITY_LABELS)])
    label = F.explode(F.array_distinct(F.concat(_phrases(), literals)))
    rows = conversations(spark, sf_dir).select("conv_id", "turn", label.alias("w"))
    return rows.select("conv_id", "turn", *[F.col("w").alias(k) for k in ("country_label", "zone_type_label", "priority_label")])


REQUEST_FIELDS = ["intent", "group_by", "city", "zone", "country", "zone_type", "prioritization",
                  "sb_country", "sb_zone_type", "sb_prioritization", "metric", "metric_a", "metric_b",
                  "time_scope", "n_weeks"]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn and one structured request per conversation row. In every other row the metric is
    two words of the row's text, the city a nation and the zone a supplier of the tables."""
    nation = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet").select("n_nationkey", F.lower("n_name").alias("nation"))
    supplier = spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet").select("s_suppkey", "s_name")
    c = conversations(spark, sf_dir).join(nation, _key() % 25 == F.col("n_nationkey"), "left")
    c = c.join(supplier, F.col("conv_id") == F.col("s_suppkey"), "left")
    structs = [
        F.struct(*[(F.lit(v).cast("bigint") if f == "n_weeks" else F.lit(v).cast("string")).alias(f)
                   for f, v in zip(REQUEST_FIELDS, r)])
        for r in REQUESTS
    ]
    req = F.element_at(F.array(*structs), (_key() % len(REQUESTS) + 1).cast("int"))
    odd = _key() % 2 == 1
    made = {"metric": _words(2), "city": F.col("nation"), "zone": F.col("s_name")}
    out = c.select("conv_id", "turn", req.alias("r"), odd.alias("odd"), *[v.alias(f"own_{k}") for k, v in made.items()])
    return out.select(
        "conv_id", "turn",
        *[F.when(F.col("odd"), F.col(f"own_{f}")).otherwise(F.col(f"r.{f}")).alias(f) if f in made else F.col(f"r.{f}")
          for f in REQUEST_FIELDS])

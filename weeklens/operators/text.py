"""Batch text jobs over tables of labels, messages and requests.

The original resolves one typed question at a time; here every job runs over a
whole table. Dictionary lookups are equi-joins (``similarity.py``): on the string
itself, on substrings for containment, on segments for the edit distance. Place
names come from the data: a text's substrings of the names' distinct lengths are
equi-joined to the whole names and verified, instead of a nested loop over every
(text, name) pair. The state of a conversation is combined from summaries of fixed-size turn
chunks, so a very long conversation never sits in one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..catalog import REFERENCE_CATALOG, Catalog
from ..functions import text_rules as T
from ..functions.literal import literal_table
from .prep import strip_all
from .scale import cut
from .similarity import SMALL_DICTIONARY, contained, runs, similar

MIN_NAME = 4  # names shorter than this are never matched (original rule: len >= 4)


def _norm(c: Column) -> Column:
    return F.lower(strip_all(c))


# ------------------------------------------------------------------ X1 metric labels
def metric_entries(spark: SparkSession, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    rows = []
    for i, m in enumerate(catalog.metrics):
        rows.append((m.name, i, m.name.lower(), "canonical", 0))
        for j, a in enumerate(m.aliases):
            rows.append((m.name, i, a.lower(), "alias", j + 1))
    return literal_table(spark, rows, "canonical string, metric_pos int, entry string, kind string, sub_pos int")


def resolve_metric_table(values: DataFrame, col: str, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Distinct raw values of ``col`` -> canonical metric (ordered steps 1-4), as (col, canonical, step).

    Steps 1 to 3 (equality and containment) are one equi-join on substrings; only what they leave open
    takes the similarity join of step 4. The distinct values and the direct hits are written once."""
    entries = metric_entries(values.sparkSession, catalog).withColumn("ef", T.fold(F.col("entry")))
    lengths = sorted({len(a) for m in catalog.metrics for a in m.aliases})
    small = sum(len(x) for m in catalog.metrics for x in (m.name, *m.aliases)) <= SMALL_DICTIONARY
    raw = values.select(F.col(col).alias("_raw")).filter(F.col("_raw").isNotNull() & (F.col("_raw") != "")) \
        .distinct().withColumn("_r", _norm(F.col("_raw")))
    # read by both joins and the anti join; every value makes hundreds of keys, so few values still fill all cores
    raw = cut(raw.repartition(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_raw"))
    direct = cut(contained(raw, entries, lengths, small))
    rest = raw.join(direct, "_raw", "left_anti").select("_raw", T.fold(F.col("_r")).alias("_rf"))
    fuzzy = similar(rest, entries.filter("kind = 'alias'"), lengths, small)
    out = direct.select("_raw", "best.canonical", F.col("best.step").cast("int").alias("step")).unionByName(
        fuzzy.select("_raw", "best.canonical", F.lit(4).alias("step")))
    return out.withColumnRenamed("_raw", col)


def resolve_labels(labels: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Every label row with its canonical metric (NULL when unresolved)."""
    best = resolve_metric_table(labels, "label", catalog)
    return labels.select("conv_id", "turn", "label").join(best, "label", "left")


# ------------------------------------------------------------------ X2-X4
def _alias_table(spark: SparkSession, groups, with_code: bool = False) -> DataFrame:
    rows = []
    for i, (canon, aliases) in enumerate(groups):
        for a in aliases:
            rows.append((canon, i, a))
        if with_code:
            rows.append((canon, i, canon.lower()))
    return literal_table(spark, rows, "canonical string, pos int, alias string")


def _resolve_by_alias(df: DataFrame, col: str, table: DataFrame) -> DataFrame:
    r = df.select("conv_id", "turn", col, _norm(F.col(col)).alias("_r"))
    hits = F.broadcast(table.groupBy("alias").agg(F.min_by("canonical", "pos").alias("_alias_hit")))
    return r.join(hits, r["_r"] == hits["alias"], "left").drop("alias")


def resolve_country(labels: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Alias or code -> 2-letter code."""
    t = _alias_table(labels.sparkSession, catalog.countries, with_code=True)
    out = _resolve_by_alias(labels, "country_label", t)
    valid = F.col("country_label").isNotNull() & (F.col("country_label") != "")
    return out.select("conv_id", "turn", "country_label",
                      F.when(valid, F.col("_alias_hit")).alias("country"))


def resolve_zone_type(labels: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Alias, else 'wealthy' without 'non', else any 'non'/'no' substring."""
    t = _alias_table(labels.sparkSession, catalog.zone_types)
    out = _resolve_by_alias(labels, "zone_type_label", t)
    r = F.col("_r")
    fallback = F.when(r.contains("wealthy") & ~r.contains("non"), "Wealthy").when(
        r.contains("non") | r.contains("no"), "Non Wealthy")
    valid = F.col("zone_type_label").isNotNull() & (F.col("zone_type_label") != "")
    return out.select("conv_id", "turn", "zone_type_label",
                      F.when(valid, F.coalesce("_alias_hit", fallback)).alias("zone_type"))


def resolve_priority(labels: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Alias, else 'high', then 'not'/'sin'/'no ', then 'priorit'."""
    t = _alias_table(labels.sparkSession, catalog.prioritizations)
    out = _resolve_by_alias(labels, "priority_label", t)
    r = F.col("_r")
    fallback = (
        F.when(r.contains("high"), "High Priority")
        .when(r.contains("not") | r.contains("sin") | r.contains("no "), "Not Prioritized")
        .when(r.contains("priorit"), "Prioritized")
    )
    valid = F.col("priority_label").isNotNull() & (F.col("priority_label") != "")
    return out.select("conv_id", "turn", "priority_label",
                      F.when(valid, F.coalesce("_alias_hit", fallback)).alias("prioritization"))


# ------------------------------------------------------------------ X5, X6
def week_scope(messages: DataFrame) -> DataFrame:
    kind, start, n = T.week_scope(F.col("q"))
    return messages.select("conv_id", "turn", kind.alias("scope_type"), start.alias("start_week"),
                           F.lit("L0W").alias("end_week"), n.alias("n_weeks"))


def concept_tag(messages: DataFrame) -> DataFrame:
    return messages.select("conv_id", "turn", T.concept(F.col("q")).alias("concept"))


# ------------------------------------------------------------------ X9 gazetteer
def gazetteer(metrics_wide: DataFrame) -> DataFrame:
    """Known place names (lower-cased zones and cities, length >= 4) with their kind and length."""
    zones = metrics_wide.select(F.lower("ZONE").alias("name"), F.lit("zone").alias("kind"))
    cities = metrics_wide.select(F.lower("CITY").alias("name"), F.lit("city").alias("kind"))
    names = zones.unionByName(cities).distinct().withColumn("name_len", F.length("name"))
    return names.filter(F.col("name_len") >= MIN_NAME)


def gazetteer_tag(messages: DataFrame, metrics_wide: DataFrame) -> DataFrame:
    """Longest zone name contained in the text, else longest city name.

    Exact substring semantics without a (text x name) nested loop: a text's substrings of the names' few
    distinct lengths (read once, bounded by the longest name) are hashed and equi-joined to the whole names, so
    the candidates of a text are bounded by its length times these lengths, whatever the names; a substring
    comparison then rules out equal hashes of different strings.
    """
    names = gazetteer(metrics_wide)
    lengths = sorted(r["name_len"] for r in names.select("name_len").distinct().collect())
    q = F.col("q")
    keys = [F.when(F.length(q) >= n, F.transform(runs(q, n), lambda x: F.xxhash64(x))) for n in lengths]
    none = F.array().cast("array<bigint>")
    keys = F.array_distinct(F.concat(none, *[F.coalesce(k, none) for k in keys]))
    probe = messages.select("conv_id", "turn", F.explode(keys).alias("key"))
    cand = probe.join(names.withColumn("key", F.xxhash64("name")), "key").select("conv_id", "turn", "name", "kind", "name_len")
    texts = messages.select("conv_id", "turn", "q")
    hits = cand.join(texts, ["conv_id", "turn"]).filter(q.contains(F.col("name")))
    key = F.struct(-F.col("name_len"), F.col("name"))
    best = hits.groupBy("conv_id", "turn").agg(
        F.min_by(F.when(F.col("kind") == "zone", F.col("name")), F.when(F.col("kind") == "zone", key)).alias("zone"),
        F.min_by(F.when(F.col("kind") == "city", F.col("name")), F.when(F.col("kind") == "city", key)).alias("c"),
    )
    out = messages.select("conv_id", "turn").join(best, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", "zone", F.when(F.col("zone").isNull(), F.col("c")).alias("city"))


# ------------------------------------------------------------------ X15, X16
def metric_tag(messages: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """First canonical name (dictionary order) in the text, else the first chunk that resolves."""
    q = F.col("q")

    def first_name(text: Column) -> Column:
        out = F.lit(None).cast("string")
        for name in reversed(catalog.names):
            out = F.when(text.contains(name.lower()), name).otherwise(out)
        return out

    # the lambda's argument is computed once; a pushed-down filter would repeat the text's expression for every name
    direct = F.transform(F.array(q), first_name)[0]
    base = messages.select("conv_id", "turn", "q", direct.alias("direct"))
    chunks = base.filter(F.col("direct").isNull()).select(
        "conv_id", "turn", F.posexplode(F.regexp_extract_all(q, F.lit(T.CHUNK_PATTERN), 0)).alias("cpos", "chunk")
    ).withColumn("chunk", strip_all(F.col("chunk")))
    resolved = resolve_metric_table(chunks, "chunk", catalog)
    key = F.unhex(F.md5(F.col("chunk").cast("binary"))).alias("key")  # the texts themselves stay where they are
    first = chunks.select("conv_id", "turn", "cpos", key).join(resolved.select(key, "canonical"), "key").groupBy("conv_id", "turn").agg(
        F.min_by("canonical", "cpos").alias("from_chunk"))
    out = base.join(first, ["conv_id", "turn"], "left")
    return out.select("conv_id", "turn", F.coalesce("direct", "from_chunk").alias("metric"))


def metric_pair_tag(messages: DataFrame, metrics_wide: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Metric pair of 'high A but low B' questions (multivariable intent only; places decide intents)."""
    q = F.col("q")
    found = F.filter(F.array(*[F.lit(n) for n in catalog.names]), lambda m: q.contains(F.lower(m)))
    lead, qual = catalog.lead, catalog.quality
    n = F.size(found)
    a = F.when(n >= 1, F.element_at(found, 1)).otherwise(F.lit(lead))
    b = (F.when(n >= 2, F.element_at(found, 2))
         .when(n == 1, F.when(F.element_at(found, 1) != qual, F.lit(qual)).otherwise(F.lit(lead)))
         .otherwise(F.lit(qual)))
    tagged = intent_tag_columns(messages, gazetteer_tag(messages, metrics_wide))
    multi = F.col("intent") == "multivariable"
    return tagged.select("conv_id", "turn", "intent", F.when(multi, a).alias("metric_a"),
                         F.when(multi, b).alias("metric_b"))


# ------------------------------------------------------------------ X7, X8
def intent_tag_columns(messages: DataFrame, places: DataFrame | None = None) -> DataFrame:
    m = messages
    if places is not None:
        m = m.join(places, ["conv_id", "turn"], "left")
        has_place = F.col("zone").isNotNull() | F.col("city").isNotNull()
    else:
        has_place = F.lit(False)
    return m.withColumn("intent", T.intent(F.col("q"), has_place))


def intent_tag(messages: DataFrame, metrics_wide: DataFrame) -> DataFrame:
    places = gazetteer_tag(messages, metrics_wide)
    return intent_tag_columns(messages, places).select("conv_id", "turn", "intent")


def extract_params(messages: DataFrame, metrics_wide: DataFrame, keep_text: bool = False) -> DataFrame:
    """n_weeks, time_scope, top_k, group_by, zone type, prioritisation, country."""
    places = gazetteer_tag(messages, metrics_wide)
    df = intent_tag_columns(messages, places)
    q = F.col("q")
    g1 = F.regexp_extract(q, T.LAST_N_WEEKS_CAPTURE, 1)
    g2 = F.regexp_extract(q, T.LAST_N_WEEKS_CAPTURE, 2)
    n = T.capped_int(F.when(g1 != "", g1).otherwise(g2), 8)
    k1 = F.regexp_extract(q, T.TOP_K, 1)
    k2 = F.regexp_extract(q, T.TOP_K, 2)
    top_k = F.coalesce(T.capped_int(F.when(k1 != "", k1).otherwise(k2)), F.lit(5).cast("bigint"))
    return df.select(
        "conv_id", "turn", "intent",
        n.alias("n_weeks"),
        F.when(n.isNotNull(), F.concat(F.lit("L"), n.cast("string"), F.lit("W-L0W"))).otherwise("L0W")
        .alias("time_scope"),
        top_k.alias("top_k"),
        T.group_by_of(q, F.col("intent")).alias("group_by"),
        T.zone_type_of(q).alias("zone_type"),
        T.priority_of(q).alias("prioritization"),
        T.country_of(q).alias("country"),
        "zone",
        "city",
        *(["q"] if keep_text else []),
    )


# ------------------------------------------------------------------ X10
def carry_last(df: DataFrame, part: str, order: str, cols: list[str], chunk: int = 4096) -> DataFrame:
    """Add ``<c>_before``: the last non-null ``c`` at an earlier ``order`` within ``part``.

    Two levels: a window inside (part, order // chunk) and a window over one
    summary row per chunk, joined back on (part, chunk).
    """
    df = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    w_in = Window.partitionBy(part, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"_in_{c}": F.last(c, ignorenulls=True).over(w_in) for c in cols})
    summary = df.groupBy(part, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in cols])
    w_chunks = Window.partitionBy(part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(part, "_chunk", *[F.last(f"_last_{c}", ignorenulls=True).over(w_chunks)
                                                .alias(f"_prev_{c}") for c in cols])
    df = df.join(summary, [part, "_chunk"], "left")
    return df.withColumns({f"{c}_before": F.coalesce(f"_in_{c}", f"_prev_{c}") for c in cols}).drop(
        "_chunk", *[f"_in_{c}" for c in cols], *[f"_prev_{c}" for c in cols])


def _resolved(known: Column, symbolic: Column, country: Column, latest: bool) -> Column:
    """The later (or earlier) of a known event (turn, value) and of one whose value is ``country`` (none if null)."""
    wins = known["turn"].isNull() | (symbolic > known["turn"] if latest else symbolic < known["turn"])
    return F.when(symbolic.isNotNull() & country.isNotNull() & wins, country).otherwise(known["value"])


def conversation_state(turns: DataFrame, zones: DataFrame, chunk: int = 4096) -> DataFrame:
    """The state that a row-by-row replay of every conversation gives, without replaying it.

    turns: conv_id, turn, intent, metric, country, zone, city (what the turn itself names), follow_country and
    follow_zone (whether it has a follow-up phrase). zones: zone_lower, ZONE, CITY, COUNTRY of the unique zone names.

    A turn's location is repaired before it becomes state: a zone name that stands for one place takes its spelling and,
    where the turn has none, its city and country. A turn acts on the state in one of few ways: it sets the metric, it
    sets the zone, it sets the country whatever it was (named, or of the repaired zone), or it sets the country only if
    there is none yet (the zone's, when a follow-up phrase prefers the old one). A run of turns is summed up by its last
    metric, zone and country and its first optional country; sums combine associatively, so turns are summed up by chunks
    of ``chunk`` and the chunks by conversation. A turn that takes up the zone from before its chunk has an open
    country; it is kept as a turn number and filled in when the chunk's incoming zone is known.
    """
    place = zones.select(F.col("zone_lower").alias("_zl"), F.struct(
        F.col("ZONE").alias("zone"), F.col("COUNTRY").alias("country"), F.col("CITY").alias("city")).alias("_place"))
    df = turns.join(place, _norm(F.col("zone")) == F.col("_zl"), "left")
    named = F.struct(F.col("zone").alias("zone"), F.lit(None).cast("string").alias("country"), F.lit(None).cast("string").alias("city"))
    df = df.withColumn("_z", F.when(F.col("zone").isNotNull(), F.coalesce("_place", named)))
    df = df.withColumn("_m", F.when(F.col("intent") != "multivariable", F.col("metric"))).withColumn("_chunk", F.floor(F.col("turn") / chunk))
    before = Window.partitionBy("conv_id", "_chunk").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)

    def last(c: Column | str, w) -> Column:
        return F.last(c, ignorenulls=True).over(w)

    def first(c: Column | str, w) -> Column:
        return F.first(c, ignorenulls=True).over(w)

    df = df.withColumns({"_z_in": last("_z", before), "_m_in": last("_m", before)})
    df = df.withColumn("_zt", F.coalesce("_z", F.when(F.col("follow_zone"), F.col("_z_in"))))
    open_ = F.col("zone").isNull() & F.col("follow_zone") & F.col("_z_in").isNull()
    follow, unnamed = F.col("follow_country"), F.col("country").isNull()
    hard = F.coalesce("country", F.when(~follow, F.col("_zt.country")))
    soft = F.when(unnamed & follow, F.col("_zt.country"))

    def event(value: Column) -> Column:
        return F.when(value.isNotNull(), F.struct("turn", value.alias("value")))

    df = df.withColumns({"_open": open_, "_hard": event(hard), "_soft": event(soft),
                         "_hard_open": F.when(open_ & unnamed & ~follow, F.col("turn")),
                         "_soft_open": F.when(open_ & unnamed & follow, F.col("turn"))})
    df = df.withColumns({"_hard_b": last("_hard", before), "_hard_open_b": last("_hard_open", before),
                         "_soft_b": first("_soft", before), "_soft_open_b": first("_soft_open", before)})
    sums = df.groupBy("conv_id", "_chunk").agg(
        F.max_by("_z", F.when(F.col("_z").isNotNull(), F.col("turn"))).alias("z"),
        F.max_by("_m", F.when(F.col("_m").isNotNull(), F.col("turn"))).alias("m"),
        F.max("_hard").alias("hard"), F.max("_hard_open").alias("hard_open"),
        F.min("_soft").alias("soft"), F.min("_soft_open").alias("soft_open"))
    chunks = Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"z0": last("z", chunks), "m0": last("m", chunks)})
    sums = sums.withColumns({"hard": _resolved(F.col("hard"), F.col("hard_open"), F.col("z0.country"), True),
                             "soft": _resolved(F.col("soft"), F.col("soft_open"), F.col("z0.country"), False)})
    sums = sums.select("conv_id", "_chunk", "z0", "m0", last("hard", chunks).alias("hard0"), first("soft", chunks).alias("soft0"))

    df = df.join(sums, ["conv_id", "_chunk"])
    zone = F.coalesce("_zt", F.when(F.col("_open"), F.col("z0")))
    hard = F.coalesce(_resolved(F.col("_hard_b"), F.col("_hard_open_b"), F.col("z0.country"), True), "hard0")
    soft = F.coalesce("soft0", _resolved(F.col("_soft_b"), F.col("_soft_open_b"), F.col("z0.country"), False))
    return df.select(
        "conv_id", "turn", "intent",
        F.when(F.col("intent") != "multivariable", F.coalesce("metric", "_m_in", "m0")).alias("metric"),
        F.coalesce("country", F.when(follow, F.coalesce(hard, soft)), zone["country"]).alias("country"),
        F.coalesce("city", zone["city"]).alias("city"), zone["zone"].alias("zone"))


def context_carry(messages: DataFrame, metrics_wide: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Metric carries when absent; country only after a follow-up phrase; zone after 'same'; on repaired locations.

    Only the user's turns are questions: other roles neither feed the state nor get a row. The messages are
    read once; the tags of all turns are written once and the state is computed from them.
    """
    own = cut(messages.filter(F.col("role") == "user").select("conv_id", "turn", "q"))
    params = extract_params(own, metrics_wide, keep_text=True)
    q = F.col("q")
    turns = params.join(metric_tag(own, catalog), ["conv_id", "turn"]).select(
        "conv_id", "turn", "intent", "metric", "country", "zone", "city",
        T.any_in(q, T.COUNTRY_FOLLOWUP).alias("follow_country"), T.any_in(q, T.ZONE_FOLLOWUP).alias("follow_zone"))
    return conversation_state(cut(turns), unique_zones(metrics_wide))


# ------------------------------------------------------------------ X11, X12
def zone_catalog(metrics_wide: DataFrame) -> DataFrame:
    """X11: zone names with the number of (CITY, COUNTRY) places they occur in."""
    ids = metrics_wide.select("ZONE", "CITY", "COUNTRY").distinct().withColumn("zone_lower", F.lower("ZONE"))
    counts = ids.groupBy("zone_lower").agg(F.count(F.lit(1)).cast("bigint").alias("n_places"))
    return ids.join(counts, "zone_lower").withColumn("is_unique", F.col("n_places") == 1)


def unique_zones(metrics_wide: DataFrame) -> DataFrame:
    """The zone names that stand for one place: (zone_lower, ZONE, CITY, COUNTRY)."""
    place = F.struct("ZONE", "CITY", "COUNTRY")
    ends = metrics_wide.groupBy(F.lower("ZONE").alias("zone_lower")).agg(F.min(place).alias("a"), F.max(place).alias("b"))
    return ends.filter(F.col("a").eqNullSafe(F.col("b"))).select("zone_lower", "a.ZONE", "a.CITY", "a.COUNTRY")


def repair_location(requests: DataFrame, metrics_wide: DataFrame) -> DataFrame:
    """A 'city' that is only a zone becomes the zone; a unique zone fills city/country/casing."""
    zone_names = metrics_wide.select(F.lower("ZONE").alias("_zn")).distinct()
    city_names = metrics_wide.select(F.lower("CITY").alias("_cn")).distinct()
    cat = zone_catalog(metrics_wide).filter("is_unique").select(
        F.col("zone_lower").alias("_zu"), F.col("ZONE").alias("_z"), F.col("CITY").alias("_c"),
        F.col("COUNTRY").alias("_k"))
    r = requests.select("conv_id", "turn", "city", "zone", "country",
                        _norm(F.coalesce(F.col("city"), F.lit(""))).alias("_city_val"))
    r = r.join(city_names, r["_city_val"] == city_names["_cn"], "left").join(
        zone_names, r["_city_val"] == zone_names["_zn"], "left")
    empty_zone = F.col("zone").isNull() | (F.col("zone") == "")
    move = (F.col("_city_val") != "") & F.col("_cn").isNull() & F.col("_zn").isNotNull() & empty_zone
    r = r.select(
        "conv_id", "turn", "country",
        F.when(move, F.lit(None)).otherwise(F.col("city")).alias("city"),
        F.when(move, F.col("_city_val")).otherwise(F.col("zone")).alias("zone"),
        move.alias("city_to_zone"),
    )
    r = r.withColumn("_zone_val", _norm(F.coalesce(F.col("zone"), F.lit(""))))
    r = r.join(cat, r["_zone_val"] == cat["_zu"], "left")
    hit = F.col("_zu").isNotNull() & (F.col("_zone_val") != "")
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    return r.select(
        "conv_id", "turn",
        F.when(hit & blank("city"), F.col("_c")).otherwise(F.col("city")).alias("city"),
        F.when(hit, F.col("_z")).otherwise(F.col("zone")).alias("zone"),
        F.when(hit & blank("country"), F.col("_k")).otherwise(F.col("country")).alias("country"),
        "city_to_zone",
        hit.alias("unique_zone"),
    )


# ------------------------------------------------------------------ X13, X14
FILTER_KEYS = ["country", "city", "zone", "zone_type", "prioritization"]


def filter_policy(requests: DataFrame) -> DataFrame:
    """Request filters win, the single-value sidebar fills gaps; zone_type dropped for
    ZONE_TYPE comparisons/aggregations and for zone-named trends/multivariable questions."""
    intent, gb = F.col("intent"), F.col("group_by")
    has = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    rule1 = (gb == "ZONE_TYPE") & intent.isin("comparison", "aggregation")
    rule2 = ~F.coalesce(rule1, F.lit(False)) & intent.isin("trend", "multivariable") & has("zone")
    rule1 = F.coalesce(rule1, F.lit(False))
    drop_zt = rule1 | rule2
    sb = {"country": "sb_country", "zone_type": "sb_zone_type", "prioritization": "sb_prioritization"}
    cols = []
    for k in FILTER_KEYS:
        own = F.col(k)
        if k in sb:
            filled = F.when(has(k), own).when(has(sb[k]), F.col(sb[k])).otherwise(own)
        else:
            filled = own
        if k == "zone_type":
            filled = F.when(drop_zt, F.lit(None)).otherwise(filled)
        cols.append(filled.alias(f"eff_{k}"))
    warnings = F.when(drop_zt, has("zone_type").cast("int") + has("sb_zone_type").cast("int")).otherwise(F.lit(0))
    rule = F.when(rule1, "group_by_zone_type").when(rule2, "named_zone").otherwise("sidebar_fills")
    return requests.select("conv_id", "turn", *cols, warnings.cast("bigint").alias("n_warnings"), rule.alias("rule"))


def trivial_filter_flag(requests: DataFrame) -> DataFrame:
    """An aggregation filtered to one country, or a comparison filtered by zone type."""
    has = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    msg = (
        F.when((F.col("intent") == "aggregation") & has("country"),
               F.concat(F.lit("ℹ️ Filtro activo: país="), F.col("country"),
                        F.lit(". La agregación por país mostrará solo un grupo.")))
        .when((F.col("intent") == "comparison") & has("zone_type"),
              F.concat(F.lit("ℹ️ Filtro tipo="), F.col("zone_type"), F.lit(" activo en comparación.")))
    )
    return requests.select("conv_id", "turn", "intent", msg.alias("warning"))


# ------------------------------------------------------------------ X17
def normalize_requests(requests: DataFrame, catalog: Catalog = REFERENCE_CATALOG) -> DataFrame:
    """Canonical metric names, country, zone type, priority (raw kept when unresolved)."""
    spark = requests.sparkSession
    metric_values = requests.select(F.col("metric").alias("v")).unionByName(
        requests.select(F.col("metric_a").alias("v"))).unionByName(requests.select(F.col("metric_b").alias("v")))
    resolved = resolve_metric_table(metric_values, "v", catalog).select("v", "canonical")
    df = requests
    for c in ["metric", "metric_a", "metric_b"]:
        r = resolved.select(F.col("v").alias(f"_{c}_v"), F.col("canonical").alias(f"_{c}_c"))
        df = df.join(r, df[c] == r[f"_{c}_v"], "left")
    countries = F.broadcast(_alias_table(spark, catalog.countries, with_code=True).groupBy("alias")
                            .agg(F.min_by("canonical", "pos").alias("_ctry")))
    zts = F.broadcast(_alias_table(spark, catalog.zone_types).groupBy("alias")
                      .agg(F.min_by("canonical", "pos").alias("_zt_alias")).withColumnRenamed("alias", "_zta"))
    prs = F.broadcast(_alias_table(spark, catalog.prioritizations).groupBy("alias")
                      .agg(F.min_by("canonical", "pos").alias("_pr_alias")).withColumnRenamed("alias", "_pra"))
    df = df.withColumns({"_cn": _norm(F.col("country")), "_zn": _norm(F.col("zone_type")),
                         "_pn": _norm(F.col("prioritization"))})
    df = df.join(countries, df["_cn"] == countries["alias"], "left").drop("alias")
    df = df.join(zts, df["_zn"] == zts["_zta"], "left").join(prs, df["_pn"] == prs["_pra"], "left")
    zn, pn = F.col("_zn"), F.col("_pn")
    zt = F.coalesce(F.col("_zt_alias"), F.when(zn.contains("wealthy") & ~zn.contains("non"), "Wealthy")
                    .when(zn.contains("non") | zn.contains("no"), "Non Wealthy"))
    pr = F.coalesce(F.col("_pr_alias"), F.when(pn.contains("high"), "High Priority")
                    .when(pn.contains("not") | pn.contains("sin") | pn.contains("no "), "Not Prioritized")
                    .when(pn.contains("priorit"), "Prioritized"))
    has = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    gmap = F.lit(None).cast("string")
    for k, v in reversed(T.GROUP_MAP):
        gmap = F.when(F.lower(F.col("group_by")) == k, v).otherwise(gmap)
    scope_n = F.regexp_extract(F.coalesce(F.col("time_scope"), F.lit("")), r"L(\d+)W", 1)
    scope_n = T.capped_int(scope_n)
    n_weeks = F.when(F.col("n_weeks").isNotNull() & (F.col("n_weeks") != 0), F.col("n_weeks")).when(
        scope_n > 0, scope_n).otherwise(F.col("n_weeks"))
    return df.select(
        "conv_id", "turn", "intent",
        *[F.when(has(c), F.coalesce(F.col(f"_{c}_c"), F.col(c))).otherwise(F.col(c)).alias(c)
          for c in ["metric", "metric_a", "metric_b"]],
        F.when(has("country"), F.coalesce("_ctry", "country")).otherwise(F.col("country")).alias("country"),
        F.when(has("zone_type"), F.coalesce(zt, F.col("zone_type"))).otherwise(F.col("zone_type")).alias("zone_type"),
        F.when(has("prioritization"), F.coalesce(pr, F.col("prioritization"))).otherwise(F.col("prioritization"))
        .alias("prioritization"),
        F.when(has("group_by"), F.coalesce(gmap, F.col("group_by"))).otherwise(F.col("group_by")).alias("group_by"),
        n_weeks.cast("bigint").alias("n_weeks"),
    )

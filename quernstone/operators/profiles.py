"""What a site's records add up to: fuels, cooling, status, integrity of figures, routes and claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import lexicon as L
from quernstone.functions.geo import haversine_km
from quernstone.functions.text import keyword_hits, trim_words

# Thresholds and markers.
GENERATORS_AT_MOST = 1000
FUEL_FLOOR, COOLING_FLOOR = 0.15, 0.2
GRID_SHORTFALL, CARRIES_LOAD, PARTIAL_LOAD, UNIT_TOLERANCE = 0.8, (0.8, 1.5), 0.5, 0.02

# Energy words of places near a site.
ENERGY_WORDS = ["energy centre", "gas turbine", "CHP", "combined heat and power", "power station", "gas-fired", "gas fired", "biomass", "hydrogen", "fuel cell", "anaerobic digestion", "energy from waste", "EfW", "gas reciprocating engine", "reciprocating engine", "BESS", "battery energy storage", "battery storage", "behind-the-meter", "energy reserve", "substation", "grid connection"]

# Kinds of plants by their source tag.
PLANT_BUCKETS = {
    "fossil": ["gas", "coal", "oil", "diesel", "gas;oil", "oil;gas", "abandoned_mine_methane", "mine gas", "methane"],
    "biomass_waste": ["biomass", "biogas", "biofuel", "waste", "landfill_gas", "wastewater", "sludge", "biomass;gas", "biomass;waste", "waste;biomass", "biogas;biomass", "biogas;gas;sludge", "waste_heat;gas"],
    "nuclear": ["nuclear"],
    "renewable": ["solar", "wind", "hydro", "tidal", "geothermal", "wind;solar", "solar;steam", "geothermal;gas", "liquid_air", "minewater"],
    "storage": ["battery"],
}

# Why no documents are held, outstanding work first.
NO_DOCUMENTS = [("untried", "Not yet retrieved"), ("error", "Retrieval failed — will retry"), ("no_adapter", "Portal not yet readable"), ("portal_blocked", "Portal blocks automated access"), ("login_required", "Documents behind a login"), ("none_published", "Register publishes no documents"), ("pre_application", "No application submitted yet")]


def mention_counts(texts: DataFrame, rules: dict[str, str], key: str = "site", text: str = "text") -> DataFrame:
    """key, ranked: array<struct(label, n)> of how many texts name what, most first, then by label."""
    named = F.array_compact(F.array(*[F.when(F.col(text).rlike("(?i)" + p), F.lit(name)) for name, p in rules.items()]))
    counts = texts.select(key, F.explode(named).alias("label")).groupBy(key, "label").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "label", "n")))
    return counts.groupBy(key).agg(F.transform(ordered, lambda r: F.struct(r["label"].alias("label"), r["n"].alias("n"))).alias("ranked"))


def fuel_profile(texts: DataFrame, key: str = "site", text: str = "text") -> DataFrame:
    """key, label, is_chp: fuels by mentions; combined heat and power wants two mentions."""
    chp = texts.groupBy(key).agg((F.count_if(F.col(text).rlike("(?i)" + L.CHP)) >= 2).alias("is_chp"))
    label = L.ranked_label(F.col("ranked"), FUEL_FLOOR)
    joined = chp.join(mention_counts(texts, L.FUELS, key, text), key, "left").withColumn("label", F.coalesce(label, F.lit("")))
    return joined.select(key, F.when(F.col("is_chp") & (F.col("label") != ""), F.concat("label", F.lit(" — CHP"))).otherwise(F.col("label")).alias("label"), "is_chp")


def cooling_profile(texts: DataFrame, key: str = "site", text: str = "text") -> DataFrame:
    return mention_counts(texts, L.COOLING, key, text).select(key, L.ranked_label(F.col("ranked"), COOLING_FLOOR).alias("label"))


def eia_status(texts: DataFrame, key: str = "site", text: str = "text") -> DataFrame:
    """key, status: the statement of highest precedence in any text."""
    names = list(L.EIA_RULES)
    rank = F.array_min(F.array_compact(F.array(*[F.when(F.col(text).rlike("(?i)" + p), F.lit(k)) for k, p in enumerate(L.EIA_RULES.values())])))
    best = texts.groupBy(key).agg(F.min(rank).alias("rank"))
    return best.select(key, F.get(F.array(*map(F.lit, names)), F.col("rank")).alias("status"))


def generator_count(counts: DataFrame, key: str = "site", n: str = "n") -> DataFrame:
    """key, generators: the largest plausible count any document gives."""
    usable = F.when((F.col(n) > 0) & (F.col(n) <= GENERATORS_AT_MOST), F.col(n))
    return counts.groupBy(key).agg(F.max(usable).alias("generators"))


def capacity_status(pre_application: Column, held: Column, read: Column, value: Column, basis: Column) -> Column:
    """What a figure, or its absence, means; the strongest statement wins."""
    return (
        F.when(pre_application, "pre_application")
        .when(held == 0, "no_documents")
        .when(value.isNotNull() & F.startswith(basis, F.lit("Estimated")), "inferred_floor_area")
        .when(value.isNotNull(), "disclosed")
        .when(read == 0, "not_yet_analysed")
        .when(read < held, "partially_analysed")
        .otherwise("read_none_disclosed")
    )


def is_provisional(held: Column, read: Column) -> Column:
    """Whether further reading of prose could still raise what was found."""
    return (held > 0) & (read < held)


def no_documents_reason(outcomes: Column) -> Column:
    """The label of the outcome that counts for a site without documents; an unknown one means untried."""
    seen = F.transform(F.coalesce(outcomes, F.array().cast("array<string>")), lambda o: F.coalesce(o, F.lit("untried")))
    out = F.when(F.size(seen) == 0, NO_DOCUMENTS[0][1])
    for name, label in NO_DOCUMENTS:
        out = out.when(F.array_contains(seen, name), label)
    return out.otherwise(NO_DOCUMENTS[0][1])


def acquisition_status(pre_application: Column, held: Column, blocked: Column, login: Column) -> Column:
    """One line on whether a site's material could be had: `blocked` and `login` are arrays of what stood in the way, for its hosts and its references."""
    listed = lambda a: F.array_sort(F.array_distinct(F.array_compact(F.coalesce(a, F.array().cast("array<string>")))))
    notes = F.concat(listed(blocked), listed(login))
    first = F.get(notes, F.lit(0))
    return (
        F.when(pre_application, "No public application exists yet (pre-planning stage)")
        .when((held == 0) & (F.size(notes) > 0), F.concat(F.upper(F.left(first, F.lit(1))), F.lower(F.substr(first, F.lit(2)))))
        .when(held == 0, "No documents fetched yet")
        .when(F.size(notes) > 0, F.concat(F.lit("Documents held; some applications not retrievable ("), F.array_join(notes, "; "), F.lit(")")))
        .otherwise("Documents held")
    )


def consumption_status(consumption: Column, grid: Column, generation: Column, it: Column, total: Column, authorities: Column, single_unit: Column) -> Column:
    """Whether a consumption figure agrees with a site's other power figures."""
    ratio = generation / F.nullif(consumption, F.lit(0.0))
    covered = grid.isNotNull()
    carries = F.coalesce(ratio.between(*CARRIES_LOAD), F.lit(False))
    small = F.coalesce(ratio < PARTIAL_LOAD, F.lit(False))
    return (
        F.when(consumption.isNull(), "no-consumption-figure")
        .when(it > total * 1.05, "components-differ")
        .when((grid < consumption * GRID_SHORTFALL) & (authorities > 1), "possible-clustering-artefact")
        .when(grid < consumption * GRID_SHORTFALL, "contradicted")
        .when(small & single_unit, "generation-understated")
        .when(covered | carries, "corroborated")
        .when(small, "partial-generation")
        .otherwise("uncorroborated")
    )


def generation_band(generation: Column, load: Column) -> Column:
    r = generation / F.nullif(load, F.lit(0.0))
    return F.when(r > 1.5, "generation above stated load").when(r >= 0.8, "generation comparable to stated load").when(r >= 0.5, "generation between half and four-fifths of stated load").when(r.isNotNull(), "generation below half of stated load")


def unit_arithmetic(count: Column, rating: Column, stored: Column) -> Column:
    """Whether a stored figure is the fleet's (count times rating) or one unit's."""
    near = lambda a: F.abs(stored - a) <= UNIT_TOLERANCE * a
    return F.when(near(count * rating), "fleet").when(near(rating), "one unit").when(count.isNotNull() & rating.isNotNull(), "other")


def suspects(df: DataFrame, implausible: float = 3000.0) -> DataFrame:
    """Stated capacities that may be energy: implausible, or said to be by their label or quote."""
    flags = {"implausible": F.col("value_mw") > implausible, "signal_says_energy": F.col("signal_type").rlike("(?i)energy|consumption|kwh|annual"), "quote_says_energy": F.col("evidence").rlike("(?i)kwh|mwh|gwh|per annum|annually|per year")}
    flagged = df.where(F.col("verdict") == "site_capacity").withColumns(flags)
    return flagged.where(F.col("implausible") | F.col("signal_says_energy") | F.col("quote_says_energy"))


def gap_reason(found: DataFrame) -> DataFrame:
    """ref, reason of records (ref, in_authority, has_keyword, start, before, after): the most substantive record of a reference decides."""
    c = F.col
    best = found.groupBy("ref").agg(
        F.count("start").alias("n"), F.bool_or("in_authority").alias("any_in"),
        F.max_by(F.struct("has_keyword", "start", "before", "after"), F.when(c("in_authority"), F.struct(c("has_keyword"), c("start")))).alias("b"),
    )
    reason = F.when(c("n") == 0, "not_in_source").when(~c("any_in"), "ref_collision").when(c("b.start") < c("b.before"), "pre_2018").when(~c("b.has_keyword"), "no_keywords").when(c("b.start") > c("b.after"), "post_sweep").otherwise("sweep_escape")
    return best.select("ref", reason.alias("reason"))


def null_sweep(hits: DataFrame, coverage: DataFrame) -> DataFrame:
    """site, cohort, finding of sites without capacity: how far they are read, and what power figures (site, context) their texts hold."""
    c = coverage.select("site", F.when(F.col("read") == 0, "unread").when(F.col("read") < F.col("held"), "partly").otherwise("fully").alias("cohort"))
    kinds = hits.select("site", L.power_context(F.col("context")).alias("k")).groupBy("site").agg(F.bool_or("k.flagged").alias("flagged"))
    finding = F.when(F.col("cohort") == "unread", "unsweepable").when(F.col("flagged").isNull(), "clean").when(F.col("flagged"), "flagged").otherwise("benign")
    return c.join(kinds, "site", "left").select("site", "cohort", finding.alias("finding"))


def operator_rows(claims: DataFrame) -> DataFrame:
    """operator, audiences, sites of claims (operator, site, audience, ord); a claim without an operator belongs to who first claimed its site."""
    owner = claims.where("operator is not null and site is not null").groupBy("site").agg(F.min_by("operator", "ord").alias("owner"))
    named = claims.join(owner, "site", "left").withColumn("operator", F.coalesce("operator", "owner")).where("operator is not null")
    return named.groupBy("operator").agg(F.countDistinct("audience").alias("audiences"), F.countDistinct("site").alias("sites"))


def divergences(claims: DataFrame) -> DataFrame:
    """site, quantity_type, audiences, low, high, ratio of claims in MW (site, quantity_type, audience, value): one quantity told to several audiences."""
    g = claims.groupBy("site", "quantity_type").agg(F.countDistinct("audience").alias("audiences"), F.min("value").alias("low"), F.max("value").alias("high"))
    return g.where("audiences > 1").withColumn("ratio", F.col("high") / F.nullif("low", F.lit(0.0)))


def lineage(tags: DataFrame, anchors: DataFrame) -> DataFrame:
    """ref, ord, line: each tag of a record as a sentence, with what is known of the record it names."""
    t = tags.select("ref", F.posexplode("tags").alias("ord", "tag")).withColumn("named", F.regexp_extract("tag", "^[^:]*:(.*)$", 1))
    a = anchors.select(F.col("ref").alias("_ref"), "description", "address")
    j = t.join(a, F.col("named") == F.col("_ref"), "left")
    about = F.concat_ws(" ", F.when(F.col("description").isNotNull(), F.concat(F.lit("— *"), trim_words(F.col("description"), 140), F.lit("*"))), F.when(F.trim("address") != "", F.concat(F.lit("(at "), F.trim("address"), F.lit(")"))))
    mark = F.concat(F.lit("`"), F.col("named"), F.lit("`"))
    line = (
        F.when(F.col("tag") == "dc_keyword", "Matched a keyword in the description.")
        .when(F.col("tag").startswith("spatial:"), F.concat(F.trim(F.concat_ws(" ", F.concat(F.lit("Spatial neighbour (within 1 km) of "), mark), about)), F.lit(".")))
        .when(F.col("tag").startswith("operator:"), F.concat(F.lit("Shares agent or applicant **"), F.col("named"), F.lit("** with another application.")))
        .when(F.col("tag").startswith("parent_backfill:"), F.concat(F.lit("Parent permission of "), mark, F.lit(".")))
        .when(F.col("tag").startswith("duplicate_of:"), F.concat(F.lit("Known duplicate of "), mark, F.lit(".")))
    )
    return j.where(line.isNotNull()).select("ref", "ord", line.alias("line"))


def kind_from_name(name: Column) -> Column:
    """A document's kind from its file name: extension and source number off, underscores to blanks."""
    stem = F.regexp_replace(F.regexp_replace(name, r"\.[^.]+$", ""), r"-\d+$", "")
    label = F.trim(F.replace(F.replace(stem, F.lit("_-_"), F.lit(" - ")), F.lit("_"), F.lit(" ")))
    return F.when((stem == F.upper(stem)) & stem.rlike("[A-Z]") | F.contains(stem, F.lit("_")), F.initcap(label)).otherwise(F.coalesce(F.nullif(label, F.lit("")), stem))


def plant_bucket(source: Column) -> Column:
    s = F.lower(F.trim(source))
    out = F.when(s.isNull(), "other")
    for name, members in PLANT_BUCKETS.items():
        out = out.when(s.isin(*members), name)
    return out.otherwise("other")


def with_coordinates(df: DataFrame, priors: DataFrame) -> DataFrame:
    """df (ref, lat, lon) with coord_source: its own place, else the curated one, else none."""
    p = priors.select(F.col("ref").alias("_ref"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    j = df.join(p, F.col("ref") == F.col("_ref"), "left")
    own = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    source = F.when(own, "application").when(F.col("_lat").isNotNull(), "inferred_prior")
    kept = [c for c in df.columns if c not in ("lat", "lon")]
    return j.select(*kept, F.when(own, F.col("lat")).otherwise(F.col("_lat")).alias("lat"), F.when(own, F.col("lon")).otherwise(F.col("_lon")).alias("lon"), source.alias("coord_source"))


def colocated(pairs: DataFrame) -> DataFrame:
    """anchor, candidate, distance_m, keyword_hits of pairs (anchor, candidate, text, four coordinates) with an energy word; no record with itself."""
    metres = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"), 6_371_000.0)
    hits = keyword_hits(F.col("text"), ENERGY_WORDS)
    return pairs.where("anchor <> candidate").select("anchor", "candidate", F.round(metres, 1).alias("distance_m"), hits.alias("keyword_hits")).where(F.size("keyword_hits") > 0)


def missing_parents(children: DataFrame, known: DataFrame) -> DataFrame:
    """child, parent: references (children: ref, candidates) that the corpus (ref) does not hold."""
    from quernstone.functions.text import full_ref

    c = children.select(F.col("ref").alias("child"), F.explode("candidates").alias("candidate"))
    parents = c.select("child", full_ref(F.col("child"), F.col("candidate")).alias("parent"))
    return parents.join(known.select(F.col("ref").alias("parent")), "parent", "left_anti").select("child", "parent")


def corpus_stats(applications: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row: how many records there are, over which dates, and what their latest verdicts (id, verdict, worth) are."""
    a = applications.agg(F.count(F.lit(1)).alias("total"), F.min("received").alias("date_min"), F.max("received").alias("date_max"))
    v = F.col("verdict")
    worth = v.isin("DC", "adjacent")
    t = verdicts.agg(F.count(F.lit(1)).alias("triaged"), *[F.count_if(v == n).alias(n.lower()) for n in ("DC", "adjacent", "unrelated", "unknown")], *[F.count_if(worth & (F.col("worth") == n)).alias(f"deep_read_{n}") for n in ("yes", "maybe")])
    return a.crossJoin(F.broadcast(t))  # a row each

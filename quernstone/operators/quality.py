"""Rules, gates, assertions and evaluation over keyed tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions.numbers import number_before
from quernstone.functions.text import digit_density, words_of_length


Get = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """A correction: where `test`, a function of a row's columns, holds, constant `changes` are made and the note tells which rule it was."""

    name: str
    test: Callable[[Get], Column]
    changes: dict[str, Column]
    note: str


def _applies(rule: Rule, get: Get, note: str) -> Column:
    return F.coalesce(rule.test(get), F.lit(False)) & ~F.contains(F.coalesce(get(note), F.lit("")), F.lit(f"[{rule.name}]"))


def corrected(df: DataFrame, rules: list[Rule], note: str = "unit_note") -> DataFrame:
    """The rules in order, each seeing what those before it did; applying them again changes nothing.

    A row's columns pass through the rules as one struct in a chain of lambdas, so that the
    expression grows with the number of rules and not with its power of two.
    """
    names = df.columns
    state = F.array(F.struct(*names))

    def step(rule: Rule) -> Callable[[Column], Column]:
        def apply(row: Column) -> Column:
            hit = _applies(rule, lambda n: row[n], note)
            mark = F.concat_ws(" ", row[note], F.lit(f"[{rule.name}] {rule.note}"))
            new = rule.changes | {note: mark}
            return F.when(hit, F.struct(*[(new[n].cast(df.schema[n].dataType) if n in new else row[n]).alias(n) for n in names])).otherwise(row)

        return apply

    for rule in rules:
        state = F.transform(state, step(rule))
    return df.select(F.explode(state).alias("_row")).select("_row.*")


def uncorrected(df: DataFrame, rules: list[Rule], note: str = "unit_note") -> DataFrame:
    """Rows that a rule would still change."""
    return df.where(reduce(lambda a, b: a | b, [_applies(r, F.col, note) for r in rules]))


def require_corrected(df: DataFrame, rules: list[Rule], note: str = "unit_note") -> None:
    """The gate before any sink."""
    n = uncorrected(df, rules, note).count()
    if n:
        raise ValueError(f"{n} rows are still to be corrected")


def capacity_rules() -> list[Rule]:
    """The corrections of stated capacities: columns verdict, quantity_type, value_mw, evidence, signal_type, unit_note."""

    def said(c: Get, pattern: str) -> Column:
        return c("evidence").rlike("(?i)" + pattern)

    def site(c: Get, *quantities: str) -> Column:
        test = c("verdict") == "site_capacity"
        return test & c("quantity_type").isin(*quantities) if quantities else test

    unclear = {"verdict": F.lit("unclear"), "quantity_type": F.lit(None), "value_mw": F.lit(None)}
    electrical = ("onsite_generation", "it_load", "total_site")
    #: Names, thresholds and words of the rules.
    return [
        Rule("energy_not_power", lambda c: site(c) & (c("value_mw") > 3000), unclear, "figure is annual energy, not power"),
        Rule("storage_not_generation", lambda c: site(c, "onsite_generation", "grid_connection") & said(c, r"\bbatter|\bbess\b|energy storage|\bups\b|uninterruptible") & ~said(c, "transformer|substation containing"), {"quantity_type": F.lit("energy_storage")}, "storage or UPS discharge rating, not generation"),
        Rule("thermal_not_electrical", lambda c: site(c, *electrical) & (said(c, "thermal input|heat input|calorific|fuel input") | c("signal_type").rlike("(?i)thermal_input|heat_input")), {"quantity_type": F.lit("thermal_input")}, "thermal or fuel input, not electrical capacity"),
        Rule("thermal_output_not_electrical", lambda c: site(c, *electrical) & said(c, "thermal output|heat output") & (c("value_mw") > number_before(c("evidence"), "MWe")), {"quantity_type": F.lit("thermal_input")}, "thermal output; the same sentence gives the electrical figure in MWe"),
        Rule("headerless_table_row", lambda c: site(c) & (F.length(c("evidence")) > 0) & (digit_density(c("evidence")) > 0.30) & (words_of_length(c("evidence")) < 8) & ~said(c, r"\d[\d,.]*\s*(mw|kw|gw|mva|kva|mwe)\b"), unclear, "table row with no headers and no unit"),
        Rule("temporary_supply", lambda c: site(c, "grid_connection") & said(c, r"\btemporar"), unclear, "temporary construction supply, not the completed connection"),
        Rule("equipment_label_not_connection", lambda c: site(c, "grid_connection") & said(c, r"floor plan|sections drawing|figure\s+[0-9]|substation\s+[0-9.]+\s*m²|legacy"), unclear, "equipment label or another scheme's plant, not this connection"),
        Rule("contradicted_by_own_document", lambda c: site(c) & (c("value_mw") == 2240) & said(c, r"contribute.{0,12}2240\s*MW"), unclear, "the document states another capacity for this proposal"),
    ]


def large_figures(df: DataFrame, least: float = 100.0, implausible: float = 3000.0) -> DataFrame:
    """Rows (id, site, value_mw, unit, quantity_type, evidence, signal_type) of at least `least` with why they want a look.

    The same-site comparison is an equi-join on figures rounded at each decimal shift.
    """
    big = df.where(F.col("value_mw") >= least)
    text = F.lower(F.concat_ws(" ", "evidence", "signal_type"))
    values = big.select(F.col("site").alias("_site"), F.col("id").alias("_id"), F.round("value_mw", 2).alias("_v")).distinct()
    shifts = F.array(*[F.struct(F.lit(f).alias("factor"), F.round(F.col("value_mw") * m, 2).alias("want")) for f in (10, 100, 1000) for m in (float(f), 1.0 / f)])
    slips = big.select("id", "site", F.explode(shifts).alias("s")).join(values, (F.col("site") == F.col("_site")) & (F.col("s.want") == F.col("_v")) & (F.col("id") != F.col("_id"))).groupBy("id").agg(F.min("s.factor").alias("factor"))
    out = big.join(slips, "id", "left")
    storage = text.rlike("battery|bess|energy storage|storage system")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("value_mw") >= implausible, "implausible"),
            F.when(text.rlike("kwh|mwh|gwh|per annum|annually|per year"), "energy units"),
            F.when(text.rlike("thermal|heat input|calorific|fuel input"), "thermal input"),
            F.when(storage & (F.col("quantity_type") != "onsite_generation"), "storage rating").when(storage, "storage rating recorded as generation"),
            F.when(F.lower("unit").isin("mva", "kva"), "apparent power"),
            F.when(F.col("factor").isNotNull(), F.concat(F.lit("exactly "), F.col("factor").cast("string"), F.lit("x another figure"))),
        )
    )
    return out.select("id", "site", "value_mw", reasons.alias("reasons"))


def dedupe_with_archive(df: DataFrame, content: list[str], key: str, reason: str = "duplicate") -> tuple[DataFrame, DataFrame]:
    """The rows kept, one of each content with the least key, and those removed with the reason and their survivor."""
    from quernstone.operators.versioned import with_survivor

    marked = with_survivor(df, content, key)
    return marked.where(F.col(key) == F.col("survivor")).drop("survivor"), marked.where(F.col(key) != F.col("survivor")).withColumn("reason", F.lit(reason))


def assert_count(df: DataFrame, expected: int, what: str = "rows") -> DataFrame:
    """df, if it has as many rows as expected."""
    n = df.count()
    if n != expected:
        raise ValueError(f"expected {expected} {what}, found {n}")
    return df


def violations(df: DataFrame, checks: dict[str, Column], key: str) -> DataFrame:
    """key, check of every row that fails one; null fails."""
    tried = F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in checks.items()])
    return df.select(key, F.explode(F.array_compact(tried)).alias("check"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once, nulls being equal."""
    return df.groupBy(*keys).count().where("count > 1")


def agreement(one: DataFrame, other: DataFrame, keys: list[str], value: str) -> DataFrame:
    """agree, shared: of the keys that both readers have, how many have equal values."""
    o = other.select(*keys, F.col(value).alias("_other"))
    return one.select(*keys, value).join(o, keys).agg(F.count_if(F.col(value).eqNullSafe(F.col("_other"))).alias("agree"), F.count("*").alias("shared"))


def relabelled(df: DataFrame, column: str, where: Column, label: Column, evidence: DataFrame, key: str) -> DataFrame:
    """df with `label` in `column` for rows that `where` holds for and that have no evidence (by key); null counts as not holding."""
    known = evidence.select(key).distinct().withColumn("_known", F.lit(True))
    change = F.coalesce(where, F.lit(False)) & F.col("_known").isNull()
    return df.join(known, key, "left").withColumn(column, F.when(change, label).otherwise(F.col(column))).drop("_known")


def ties(df: DataFrame, order: list[str]) -> DataFrame:
    """What an order by these columns leaves open: their values that several rows share, with how many. Empty for a total order."""
    return df.groupBy(*order).agg(F.count("*").alias("n")).where("n > 1")


def assert_total_order(df: DataFrame, order: list[str]) -> DataFrame:
    """df, if an order by these columns puts no two rows at one place, so that ranks and limits are the same on every run."""
    tied = ties(df, order).limit(1).collect()
    if tied:
        raise ValueError(f"rows tie by {', '.join(order)}: {tied[0].asDict()}")
    return df


def assert_columns(df: DataFrame, header: list[str]) -> DataFrame:
    """df, if its columns are those of the header, in order; every row then has its width."""
    if df.columns != list(header):
        raise ValueError(f"columns {df.columns} for the header {list(header)}")
    return df


def mapping_gaps(everything: DataFrame, mapped: DataFrame, unmapped: DataFrame, key: str) -> DataFrame:
    """key, problem: lost (in neither part), doubled (in both or twice in one) or foreign (not in the whole). Empty where mapped and unmapped make up the whole."""
    parts = mapped.select(key, F.lit(1).alias("n")).unionAll(unmapped.select(key, F.lit(1).alias("n"))).groupBy(key).agg(F.sum("n").alias("n"))
    whole = everything.select(F.col(key).alias("_key")).distinct()
    j = whole.join(parts, F.col("_key").eqNullSafe(F.col(key)), "full")
    problem = F.when(F.col("n").isNull(), "lost").when(F.col("_key").isNull() & F.col(key).isNotNull(), "foreign").when(F.col("n") > 1, "doubled")
    return j.select(F.coalesce("_key", key).alias(key), problem.alias("problem")).where("problem is not null")


def match_checks(matches: DataFrame, claims: DataFrame) -> DataFrame:
    """claim_id, check: what is wrong with matches (claim_id, claim_name, confidence, evidence, level) against claims (claim_id, claim_name)."""
    c = claims.select(F.col("claim_id").alias("_id"), F.col("claim_name").alias("_name"))
    joined = matches.join(c, F.col("claim_id") == F.col("_id"), "left").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("claim_id")))
    checks = {
        "unknown claim": F.col("_id").isNotNull(),
        "renamed claim": F.col("_id").isNull() | (F.col("claim_name") == F.col("_name")),
        "confidence": F.col("confidence").isin("A", "B", "C"),
        "evidence too short": F.length("evidence") >= 40,
        "matched twice": F.col("_n") == 1,
        "company-level claim": F.coalesce(F.col("level"), F.lit("site")) != "company",
    }
    return violations(joined, checks, "claim_id").distinct()


def reconciled_counts(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys in both, only in a, only in b."""
    x = a.select(*keys).distinct().withColumn("_a", F.lit(1))
    y = b.select(*keys).distinct().withColumn("_b", F.lit(1))
    return x.join(y, keys, "full").agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("both"), F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"))


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count(F.lit(1)).alias("n"))


def restore_check(live: DataFrame, backup: DataFrame, least: float = 0.95) -> DataFrame:
    """table, live, backup, status of table counts: a backup has no more rows than the live table, and not far fewer."""
    j = live.select("table", F.col("n").alias("live")).join(backup.select("table", F.col("n").alias("backup")), "table", "full")
    status = F.when(F.col("backup").isNull(), "missing").when(F.col("live").isNull() | (F.col("backup") > F.col("live")), "more than live").when(F.col("backup") < least * F.col("live"), "short").otherwise("ok")
    return j.select("table", "live", "backup", status.alias("status"))


def prune_guard(stored: DataFrame, produced: DataFrame, key: str, most: float = 0.5) -> DataFrame:
    """The stored rows that would go, unless these are more than `most` of all."""
    gone = stored.join(produced.select(key).distinct(), key, "left_anti")
    total, n = stored.count(), gone.count()
    if n > most * total:
        raise ValueError(f"{n} of {total} rows would go; refused")
    return gone

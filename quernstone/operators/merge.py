"""Merging into keyed tables without a table format: policies per column, guards, retiring.

Each returns the new table; re-applying the same updates changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Policy = Callable[[Column, Column], Column]


def overwrite(old: Column, new: Column) -> Column:
    return new


def keep_old(old: Column, new: Column) -> Column:
    return F.coalesce(old, new)


def new_or_old(old: Column, new: Column) -> Column:
    return F.coalesce(new, old)


def union_tags(old: Column, new: Column) -> Column:
    """Old tags first, each once."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(old, none), F.coalesce(new, none)))


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], policies: dict[str, Policy], default: Policy = overwrite) -> DataFrame:
    """base with updates merged by key, each column by its policy."""
    o = base.select(*[F.col(c).alias(f"o_{c}") for c in base.columns], F.lit(True).alias("o_here"))
    n = updates.select(*[F.col(c).alias(f"n_{c}") for c in updates.columns], F.lit(True).alias("n_here"))
    on = reduce(lambda x, y: x & y, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys])
    joined = o.join(n, on, "full")
    here, fresh = F.coalesce(F.col("o_here"), F.lit(False)), F.coalesce(F.col("n_here"), F.lit(False))
    out = []
    for c in base.columns:
        old = F.col(f"o_{c}")
        if c in keys:
            out.append(F.when(here, old).otherwise(F.col(f"n_{c}")).alias(c))
        elif c not in updates.columns:
            out.append(old.alias(c))
        else:
            new = F.col(f"n_{c}")
            merged = policies.get(c, default)(old, new)
            out.append(F.when(here & fresh, merged).when(here, old).otherwise(new).alias(c))
    return joined.select(*out)


def state_guarded(base: DataFrame, updates: DataFrame, keys: list[str], state: str, final: str) -> DataFrame:
    """Upsert, except where the stored state is final: such rows stay as they are."""
    done = base.where(F.col(state) == final)
    open_updates = updates.join(done.select(*keys), keys, "left_anti")
    return upsert(base, open_updates, keys, {})


def insert_ignore(base: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """base with the rows whose key is new, and those rows; of several new ones with one key the one that sorts first."""
    fresh = rows.join(base.select(*keys).distinct(), _same_names(rows, base, keys), "left_anti")
    order = F.struct(*[F.col(c) for c in rows.columns])
    one = fresh.groupBy(*keys).agg(F.min(order).alias("_row")).select("_row.*")
    return base.unionByName(one.select(*base.columns)), one


def _same_names(rows: DataFrame, base: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [rows[k].eqNullSafe(base[k]) for k in keys])


def retire_and_revive(stored: DataFrame, current: DataFrame, key: str, retired: str = "retired_at", now: Column | None = None) -> DataFrame:
    """Every key with its action: new, kept, revived or retired (or gone, if it was retired before), and its retired_at after it."""
    s = stored.select(F.col(key).alias("_s"), F.col(retired).alias("_r"))
    c = current.select(F.col(key).alias("_c")).distinct()
    joined = s.join(c, F.col("_s") == F.col("_c"), "full")
    action = F.when(F.col("_s").isNull(), "new").when(F.col("_c").isNull() & F.col("_r").isNull(), "retired").when(F.col("_c").isNull(), "gone").when(F.col("_r").isNotNull(), "revived").otherwise("kept")
    after = F.when(F.col("_c").isNull(), F.coalesce(F.col("_r"), now if now is not None else F.current_timestamp()))
    return joined.select(F.coalesce("_s", "_c").alias(key), action.alias("action"), after.cast("timestamp").alias(retired))


def orphans(stored: DataFrame, produced: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows that are no longer produced."""
    return stored.join(produced.select(*keys).distinct(), _same_names(stored, produced, keys), "left_anti")


def append_unless_present(base: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """base and those rows of `more` whose key, in upper case, base does not have."""
    known = base.select(F.upper(F.col(key)).alias("_k")).distinct()
    return base.unionByName(more.join(known, F.upper(more[key]) == F.col("_k"), "left_anti").select(*base.columns))


def merged_claims(stored: DataFrame, produced: DataFrame, keys: list[str], refresh: str | None = None, prune: bool = False) -> tuple[DataFrame, DataFrame]:
    """The claims after a load, and the stored ones that are no longer produced.

    A claim that is stored stays as it is, but for the column `refresh`; new ones are added; orphans
    are only told, unless `prune`.
    """
    gone = orphans(stored, produced, keys)
    policies = {c: (new_or_old if c == refresh else keep_old) for c in stored.columns if c not in keys}
    kept = orphans(stored, gone, keys) if prune else stored
    untouched = {c: (lambda old, new: old) for c in policies if c != refresh}
    return upsert(kept, produced, keys, policies | untouched), gone


def upserted_councils(stored: DataFrame, areas: DataFrame) -> DataFrame:
    """stored (gss_code, name, notes) with areas (gss_code, name, is_planning, ...): those without a code or that do no planning are skipped, and what else is known goes into the notes as JSON."""
    rest = [c for c in areas.columns if c not in ("gss_code", "name", "is_planning")]
    fit = areas.where(F.col("gss_code").isNotNull() & F.coalesce(F.col("is_planning"), F.lit(False)))
    return upsert(stored, fit.select("gss_code", "name", F.to_json(F.struct(*rest)).alias("notes")), ["gss_code"], {"name": new_or_old, "notes": new_or_old})

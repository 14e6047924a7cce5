"""Numbers: units, bands, roundings, shares and changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Megawatts per unit. Apparent power and energy are no power and have none.
MW_PER_UNIT = {"mw": 1.0, "kw": 0.001, "gw": 1000.0}
#: Square metres per unit.
SQM_PER_UNIT = {"sqm": 1.0, "m2": 1.0, "sq m": 1.0, "square metres": 1.0, "square meters": 1.0, "sqft": 0.092903, "ft2": 0.092903, "square feet": 0.092903}
#: Lower bounds of the bands, from the top.
MW_BANDS = ((500.0, "very_large_500mw_plus"), (100.0, "large_100_500mw"), (20.0, "medium_20_100mw"), (5.0, "small_5_20mw"), (0.0, "very_small_under_5mw"))
AREA_BANDS = ((50000.0, "very_large_50k_sqm_plus"), (10000.0, "large_10k_50k_sqm"), (2000.0, "medium_2k_10k_sqm"), (500.0, "small_500_2k_sqm"), (0.0, "very_small_under_500_sqm"))
#: Fixed value: kilowatts per square metre of building.
KW_PER_SQM = 1.71
#: Numbers written as words.
NUMBER_WORDS = {"two": 2, "three": 3, "four": 4, "five": 5, "six": 6}


def _mapped(values: dict, key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[key]


def to_mw(value: Column, unit: Column) -> Column:
    """Megawatts, null for a unit that is not one of power."""
    return value * _mapped(MW_PER_UNIT, F.lower(F.trim(unit)))


def to_sqm(value: Column, unit: Column) -> Column:
    return value * _mapped(SQM_PER_UNIT, F.lower(F.trim(unit)))


def band(value: Column, bands: tuple[tuple[float, str], ...]) -> Column:
    """The first band whose lower bound is reached; below all, the last."""
    out = None
    for least, name in bands:
        out = F.when(value >= least, name) if out is None else out.when(value >= least, name)
    return F.when(value.isNull(), None).otherwise(out.otherwise(bands[-1][1]))


def round_sensibly(mw: Column) -> Column:
    """One place below ten, to fives below a hundred, to tens above; halves to even."""
    return F.when(mw < 10, F.bround(mw, 1)).when(mw < 100, F.bround(mw / 5) * 5).otherwise(F.bround(mw / 10) * 10).cast("double")


def sig4(x: Column) -> Column:
    """Four significant figures."""
    power = F.pow(F.lit(10.0), 3 - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, 0.0).otherwise(F.rint(x * power) / power)


def number_before(text: Column, unit: str) -> Column:
    """The first number that stands before the unit."""
    return F.replace(F.regexp_extract(text, rf"(?i)([0-9][0-9.,]*)\s*{unit}", 1), F.lit(","), F.lit("")).try_cast("double")


def count_word(text: Column) -> Column:
    """A number in digits or as a word from two to six."""
    return F.coalesce(F.regexp_extract(text, r"(\d+)", 1).try_cast("int"), _mapped(NUMBER_WORDS, F.lower(F.trim(text))))


def change_pct(old: Column, new: Column) -> Column:
    """Per cent, null where either is missing or the old one is zero."""
    return (new - old) / F.nullif(old, F.lit(0.0)) * 100


def clean_number(c: Column) -> Column:
    """A cell's number; zero and what is none mean absent."""
    return F.nullif(F.trim(c).try_cast("double"), F.lit(0.0))


def clean_text(c: Column) -> Column:
    """A cell's text; empty ones and a lone full stop mean absent."""
    t = F.trim(c)
    return F.when((t != "") & (t != "."), t)


def clean_id(c: Column) -> Column:
    """A cell's id, without the decimals that spreadsheets add."""
    return F.regexp_replace(clean_text(c), r"^(\d+)\.0+$", "$1")


def power_estimate(it: Column, total: Column, grid: Column, generation: Column, floorspace: Column, held: Column, prose_held: Column, prose_read: Column) -> Column:
    """struct(value_mw, basis, confidence): the best statement there is, else an estimate from floor space, else why there is none."""

    def row(value: Column, basis: str, confidence: str) -> Column:
        return F.struct(value.cast("double").alias("value_mw"), F.lit(basis).alias("basis"), F.lit(confidence).alias("confidence"))

    none = F.lit(None)
    return (
        F.when(it > 0, row(it, "Disclosed IT load", "High"))
        .when(total > 0, row(total, "Disclosed total site demand", "High"))
        .when(grid > 0, row(grid, "Grid connection capacity", "Medium"))
        .when(generation > 0, row(generation, "Standby generation capacity", "Low"))
        .when(floorspace >= 500, row(round_sensibly(floorspace * KW_PER_SQM / 1000), "Estimated from floorspace", "Indicative"))
        .when(~held, row(none, "No documents held", "None"))
        .when((prose_held > 0) & (prose_read == 0), row(none, "Not yet analysed", "None"))
        .otherwise(row(none, "No capacity disclosed", "None"))
    )

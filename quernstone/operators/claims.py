"""Claims held against their sources: is what is quoted still there, and does the quote hold the figure.

A claim has id, doc, page, quote, value and, where the value was added up, the engines it is
the sum of. Sources are pages (doc, page, text). All in expressions; one join by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as T

#: Fixed value: how far a sum may be from its engines.
SUM_TOLERANCE = 0.001


def printed(value: Column) -> Column:
    """A figure as it is printed: six decimals at most, without the zeros at its end."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", value.cast("double")), "0+$", ""), r"\.$", "")


def _spaced(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def verified_claims(claims: DataFrame, pages: DataFrame) -> DataFrame:
    """id, problem: null where the quote is on its page and holds the claim's figure.

    claims: id, doc, page, quote, value, engines (array<struct(n, mw)>, null where the value stands by itself).
    Else no_text, quote_missing, value_missing, ratings_missing or sum_differs, the first that fits.
    """
    p = pages.select(F.col("doc").alias("_doc"), F.col("page").alias("_page"), _spaced(F.col("text")).alias("_text"))
    j = claims.join(p, (F.col("doc") == F.col("_doc")) & (F.col("page") == F.col("_page")), "left")
    blob = F.regexp_replace("quote", r"[,\s]", "")
    missing = F.exists("engines", lambda e: ~F.contains(blob, printed(e["mw"])))
    total = F.round(F.aggregate("engines", F.lit(0.0), lambda t, e: t + e["n"] * e["mw"]), 3)
    own = F.col("engines").isNull()
    problem = (
        F.when(F.col("_text").isNull(), "no_text")
        .when(~F.contains(F.col("_text"), F.trim(_spaced(F.col("quote")))), "quote_missing")
        .when(own & ~F.contains(blob, printed(F.col("value"))), "value_missing")
        .when(~own & missing, "ratings_missing")
        .when(~own & (F.abs(total - F.col("value")) > SUM_TOLERANCE), "sum_differs")
    )
    return j.select("id", problem.alias("problem"))


def verified_digits(claims: DataFrame, pages: DataFrame) -> DataFrame:
    """id, problem of claims (id, doc, page, value) on scanned pages: no_text, or value_missing where its digits do not follow one another on the page, marks between them aside."""
    p = pages.select(F.col("doc").alias("_doc"), F.col("page").alias("_page"), T.digit_blob(F.col("text")).alias("_digits"))
    j = claims.join(p, (F.col("doc") == F.col("_doc")) & (F.col("page") == F.col("_page")), "left")
    want = T.digit_blob(printed(F.col("value")))
    return j.select("id", F.when(F.col("_digits").isNull(), "no_text").when((want != "") & ~F.contains(F.col("_digits"), want), "value_missing").alias("problem"))

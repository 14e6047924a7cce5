"""Queries over events, orders and the other record tables, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions import numbers as N
from quernstone.functions import text as T
from quernstone.operators import graph, linkage, merge, passages, profiles, quality, versioned
from quernstone.plans.registry import query
from quernstone.session import load
from quernstone.streaming import contracts




@query(
    "worklist",
    """
    WITH last AS (SELECT DISTINCT ON (user_id) * FROM events ORDER BY user_id, ts DESC, event_id DESC),
    hits AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS tier1, count(*) FILTER (WHERE event_type = 'click') AS storage,
             count(*) FILTER (WHERE event_type = 'view') AS backup FROM events GROUP BY user_id)
    SELECT l.user_id, l.event_id, l.event_type, h.tier1, h.storage, h.backup,
           row_number() OVER (ORDER BY h.tier1 * 3 + h.storage DESC, h.backup DESC, CASE l.event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, l.ts DESC NULLS LAST, l.user_id) AS place
    FROM last l JOIN hits h USING (user_id) WHERE l.event_type <> 'error' ORDER BY place LIMIT 50
    """,
)
def worklist(spark: SparkSession, sf: str) -> DataFrame:
    """The latest verdict of each key, filtered, with hit counts, ranked; a top list of 50."""
    e = load(spark, sf, "events")
    last = versioned.latest(e, ["user_id"], "ts", "event_id").where("event_type <> 'error'")
    hits = e.groupBy("user_id").agg(*[F.count_if(F.col("event_type") == t).alias(n) for t, n in (("purchase", "tier1"), ("click", "storage"), ("view", "backup"))])
    kind = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    order = [(F.col("tier1") * 3 + F.col("storage")).desc(), F.desc("backup"), kind, F.desc_nulls_last("ts"), F.col("user_id")]
    top = last.join(hits, "user_id").orderBy(*order).limit(50)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long")).select("user_id", "event_id", "event_type", "tier1", "storage", "backup", "place")


@query("win_latest_distinct_on", "SELECT DISTINCT ON (user_id) user_id, event_id, event_type, ts, value FROM events ORDER BY user_id, ts DESC, event_id DESC")
def latest_event(spark: SparkSession, sf: str) -> DataFrame:
    return versioned.latest(load(spark, sf, "events").drop("props"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "ts", "value")


@query("win_latest_per_variant", "SELECT DISTINCT ON (user_id, coalesce(nullif(event_type, 'signup'), 'v1')) user_id, event_type, event_id FROM events ORDER BY user_id, coalesce(nullif(event_type, 'signup'), 'v1'), ts DESC, event_id DESC")
def latest_variant(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return versioned.latest_per_variant(e, ["user_id"], F.nullif("event_type", F.lit("signup")), "ts", "event_id").select("user_id", "event_type", "event_id")


@query("win_prefer_decided", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'error', ts DESC NULLS LAST, event_id DESC) AS rn FROM events) WHERE rn = 1")
def prefer_decided(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return versioned.preferred(e, ["user_id"], F.col("event_type") == "error", "ts", "event_id").drop("ts")


@query("win_topn_per_group", "SELECT o_custkey, o_orderkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def top3(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return versioned.top_n(o, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3, "rn").select("o_custkey", "o_orderkey", F.col("rn").cast("long").alias("rn"))


@query(
    "win_argmax_per_group",
    """
    WITH r AS (SELECT l_suppkey, l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, l_partkey, revenue FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY revenue DESC, l_partkey) AS rn FROM r) WHERE rn = 1
    """,
)
def argmax_part(spark: SparkSession, sf: str) -> DataFrame:
    r = load(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
    return versioned.argmax(r, ["l_suppkey"], "revenue", "l_partkey")


@query("win_survivor_min", "SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')))) AS survivor FROM documents")
def survivors(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").select("doc_id", F.md5(T.norm_ws(F.col("text"))).alias("h"))
    return versioned.with_survivor(d, ["h"], "doc_id").select("doc_id", "survivor")


@query("win_dup_rank", "SELECT doc_id, copy FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS copy FROM documents) WHERE copy > 1")
def surplus(spark: SparkSession, sf: str) -> DataFrame:
    return versioned.duplicates(load(spark, sf, "documents").select("doc_id", F.md5("text").alias("h")), ["h"], "doc_id").select("doc_id", F.col("copy").cast("long").alias("copy"))


@query("win_dedupe_location", "SELECT DISTINCT ON (c_nationkey, c_mktsegment) c_nationkey, c_mktsegment, c_custkey FROM customer ORDER BY c_nationkey, c_mktsegment, c_custkey DESC")
def dedupe_location(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select("c_nationkey", "c_mktsegment", "c_custkey")
    return c.groupBy("c_nationkey", "c_mktsegment").agg(F.max("c_custkey").alias("c_custkey"))


@query("win_every_nth", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events) WHERE n % 5 = 0 AND event_type = 'view'")
def every_fifth(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return versioned.every_nth(e, ["user_id"], [F.col("ts"), F.col("event_id")]).where("event_type = 'view'").select("user_id", "event_id")


@query("win_neighbour_pages", "SELECT event_id, max(event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS selected FROM events")
def neighbours(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return versioned.with_neighbours(e, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type") == "purchase").select("event_id", "selected")


@query(
    "win_greedy_pack",
    """
    WITH RECURSIVE s AS (SELECT conv_id, turn, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS no FROM conversations),
    g AS (SELECT conv_id, turn, no, 0 AS chunk, n::BIGINT AS total FROM s WHERE no = 1
          UNION ALL
          SELECT s.conv_id, s.turn, s.no, CASE WHEN g.total > 0 AND g.total + s.n > 800 THEN g.chunk + 1 ELSE g.chunk END, CASE WHEN g.total > 0 AND g.total + s.n > 800 THEN s.n ELSE g.total + s.n END
          FROM g JOIN s ON s.conv_id = g.conv_id AND s.no = g.no + 1)
    SELECT conv_id, turn, chunk FROM g
    """,
)
def greedy_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return passages.greedy_groups(c, ["conv_id"], [F.col("turn")], F.col("n"), 800).select("conv_id", "turn", "chunk")


@query("win_rank_position", "SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS place FROM customer")
def rank_position(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    return load(spark, sf, "customer").select("c_custkey", F.row_number().over(w).cast("long").alias("place"))


@query("win_rate_recent", "SELECT event_type, count(*) AS n, round(count(*) / 72.0, 4) AS per_hour FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 3 DAY GROUP BY event_type")
def rate_recent(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    last = e.agg(F.max("ts").alias("last"))
    recent = e.crossJoin(F.broadcast(last)).where(F.col("ts") > F.col("last") - F.make_dt_interval(F.lit(3)))  # one row
    return recent.groupBy("event_type").agg(F.count("*").alias("n")).withColumn("per_hour", F.round(F.col("n") / 72.0, 4))


@query("win_doc_number", "SELECT event_id, lpad(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::VARCHAR, 3, '0') || ' - ' || event_type || '.json' AS file_name FROM events")
def doc_number(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", F.lit("json").alias("ext"))
    return versioned.numbered_names(e, ["user_id"], [F.col("ts"), F.col("event_id")], "event_type", "ext").select("event_id", "file_name")


@query("win_first_home", "SELECT l_partkey, min_by(l_suppkey, l_orderkey * 1000 + l_linenumber) AS l_suppkey FROM lineitem GROUP BY l_partkey")
def first_home(spark: SparkSession, sf: str) -> DataFrame:
    """Of equal lines the first in the table, which is the row that DuckDB meets first."""
    ord = (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("ord")
    li = load(spark, sf, "lineitem").select("l_partkey", "l_suppkey", ord, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    return versioned.first_home(li, "l_partkey", "l_suppkey", "ord", ["file", "at"])


@query("win_longest_first", "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY place LIMIT 100")
def longest_first(spark: SparkSession, sf: str) -> DataFrame:
    """The 100 longest of the jobs not yet done."""
    todo = load(spark, sf, "documents").select("doc_id", "n_chars").join(load(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")
    order = [F.desc("n_chars"), F.col("doc_id")]
    return todo.orderBy(*order).limit(100).select("doc_id", F.row_number().over(Window.orderBy(*order)).cast("long").alias("place"))


@query("win_longest_first_all", "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def longest_first_all(spark: SparkSession, sf: str) -> DataFrame:
    """As `win_longest_first`, every job not yet done."""
    todo = load(spark, sf, "documents").select("doc_id", "n_chars").join(load(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti")
    return versioned.placed(todo, [F.desc("n_chars"), F.col("doc_id")]).select("doc_id", "place")


@query(
    "win_tranche",
    """
    WITH RECURSIVE g AS (SELECT c_nationkey AS grp, count(*) AS n, row_number() OVER (ORDER BY c_nationkey) AS i FROM customer GROUP BY 1), t AS (SELECT greatest(1, ceil(sum(n) / 400.0)::INT) AS parts, sum(n) AS total FROM g),
    r AS (SELECT 0::BIGINT AS i, NULL::INT AS grp, 1 AS tranche, 0::DOUBLE AS held
        UNION ALL SELECT g.i, g.grp, r.tranche + CASE WHEN o THEN 1 ELSE 0 END, CASE WHEN o THEN g.n ELSE r.held + g.n END
        FROM (SELECT r.*, r.held > 0 AND r.tranche < t.parts AND (r.held + g.n > 400 OR abs(r.held + g.n - t.total / t.parts) > abs(r.held - t.total / t.parts)) AS o FROM r JOIN g ON g.i = r.i + 1, t) r JOIN g ON g.i = r.i + 1)
    SELECT grp AS "group", tranche FROM r WHERE i > 0
    """,
)
def tranche(spark: SparkSession, sf: str) -> DataFrame:
    per = load(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("group")).agg(F.count("*").alias("n"))
    return spark.createDataFrame(passages.tranches(per, 400), "group int, tranche int")


# aggregates ----------------------------------------------------------------------


@query(
    "agg_filter_pivot",
    """
    SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE event_type = 'view') AS views,
           round(max(value) FILTER (WHERE event_type = 'purchase'), 4) AS best, bool_or(event_type = 'signup') AS signed FROM events GROUP BY user_id
    """,
)
def filter_pivot(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return load(spark, sf, "events").groupBy("user_id").agg(F.count_if(kind == "error").alias("errors"), F.count_if(kind == "view").alias("views"), F.round(F.max(F.when(kind == "purchase", F.col("value"))), 4).alias("best"), F.bool_or(kind == "signup").alias("signed"))


@query("agg_filter_max_pivot", "SELECT user_id, round(max(CASE WHEN event_type = 'click' THEN value END), 4) AS click, round(max(CASE WHEN event_type = 'view' THEN value END), 4) AS \"view\" FROM events GROUP BY user_id")
def max_pivot(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "events").groupBy("user_id").pivot("event_type", ["click", "view"]).max("value")
    return p.select("user_id", F.round("click", 4).alias("click"), F.round("view", 4).alias("view"))


@query("agg_bool_or", "SELECT user_id, bool_or(event_type = 'signup' AND value > 50 OR event_type = 'purchase' AND value > 10) AS in_universe FROM events GROUP BY user_id")
def bool_or(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("event_type"), F.col("value")
    return load(spark, sf, "events").groupBy("user_id").agg(F.bool_or((k == "signup") & (v > 50) | (k == "purchase") & (v > 10)).alias("in_universe"))


@query("agg_count_distinct", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_suppkey")
def count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey").alias("parts"))


@query("agg_count_distinct_row", "SELECT l_returnflag, count(DISTINCT (l_linenumber, md5(l_linestatus), nullif(l_quantity, 7))) AS n FROM lineitem GROUP BY l_returnflag")
def count_distinct_row(spark: SparkSession, sf: str) -> DataFrame:
    row = F.struct("l_linenumber", F.md5("l_linestatus"), F.nullif("l_quantity", F.lit(7.0)))
    return load(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.countDistinct(row).alias("n"))


@query("agg_array_distinct", "SELECT user_id, array_to_string(list_sort(list_distinct(array_agg(event_type) FILTER (WHERE value > 50))), ',') AS kinds FROM events GROUP BY user_id")
def array_distinct(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array_sort(F.collect_set(F.when(F.col("value") > 50, F.col("event_type"))))
    return load(spark, sf, "events").groupBy("user_id").agg(F.when(F.size(kinds) > 0, F.array_join(kinds, ",")).alias("kinds"))


@query("agg_array_plain", "SELECT user_id, len(array_agg(event_type) FILTER (WHERE event_type <> 'view')) AS n FROM events GROUP BY user_id")
def array_plain(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").groupBy("user_id").agg(F.nullif(F.size(F.collect_list(F.when(F.col("event_type") != "view", F.col("event_type")))), F.lit(0)).cast("long").alias("n"))


@query("agg_array_remove_null", "SELECT c_custkey, array_to_string(list_sort(array_agg(DISTINCT o_orderstatus) FILTER (WHERE o_orderstatus IS NOT NULL)), '') AS states FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def array_remove_null(spark: SparkSession, sf: str) -> DataFrame:
    states = load(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderstatus")), "").alias("states"))
    c = load(spark, sf, "customer").select("c_custkey")
    return c.join(states, c.c_custkey == states.o_custkey, "left").select("c_custkey", "states")


@query("agg_string", "SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def string_agg(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ", ").alias("kinds"))


@query(
    "agg_ranked_labels",
    """
    WITH c AS (SELECT l_suppkey, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT l_suppkey, string_agg(p_type || ' (' || n || ')', ', ' ORDER BY n DESC, p_type) AS labels FROM c GROUP BY l_suppkey
    """,
)
def ranked_labels(spark: SparkSession, sf: str) -> DataFrame:
    li, p = load(spark, sf, "lineitem").select("l_suppkey", "l_partkey"), load(spark, sf, "part").select("p_partkey", "p_type")
    n = li.join(p, li.l_partkey == p.p_partkey).groupBy("l_suppkey", "p_type").agg(F.count("*").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "p_type", "n")))
    return n.groupBy("l_suppkey").agg(F.array_join(F.transform(ranked, lambda r: F.concat(r["p_type"], F.lit(" ("), r["n"].cast("string"), F.lit(")"))), ", ").alias("labels"))


@query("agg_median", "SELECT event_type, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY value), 4) AS median FROM events GROUP BY event_type")
def median(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").groupBy("event_type").agg(F.round(F.percentile("value", 0.5), 4).alias("median"))


@query("agg_minmax_scalar", "SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders")
def minmax(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").agg(F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("agg_having", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'error') > 0 AND count(*) FILTER (WHERE event_type = 'purchase') > 0")
def having(spark: SparkSession, sf: str) -> DataFrame:
    g = load(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("e"), F.count_if(F.col("event_type") == "purchase").alias("p"))
    return g.where("e > 0 and p > 0").select("user_id", "n")


@query("agg_unnest_group", "SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(lower(p_type), ' ')) AS tag FROM part) GROUP BY tag")
def unnest_group(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select(F.explode(F.split(F.lower("p_type"), " ")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("agg_weighted_none", "SELECT c_custkey, coalesce(sum(n), 0)::BIGINT AS items FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey GROUP BY c_custkey")
def weighted_none(spark: SparkSession, sf: str) -> DataFrame:
    n = load(spark, sf, "orders").where("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    c = load(spark, sf, "customer").select("c_custkey")
    return c.join(n, c.c_custkey == n.o_custkey, "left").select("c_custkey", F.coalesce("n", F.lit(0)).cast("long").alias("items"))


@query("agg_max_on_text", "SELECT p_brand, max(p_name) AS title FROM part GROUP BY p_brand")
def max_text(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").groupBy("p_brand").agg(F.max("p_name").alias("title"))


@query(
    "agg_mutually_exclusive_buckets",
    """
    SELECT bucket, count(*) AS n FROM (SELECT user_id, CASE WHEN count(*) FILTER (WHERE event_type = 'purchase' AND value > 80) > 0 THEN 'purchase'
        WHEN count(*) FILTER (WHERE event_type = 'click' AND value > 80) > 0 THEN 'click' WHEN count(*) FILTER (WHERE event_type = 'view') > 0 THEN 'view' ELSE 'none' END AS bucket FROM events GROUP BY user_id) GROUP BY bucket
    """,
)
def exclusive_buckets(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("event_type"), F.col("value")
    g = load(spark, sf, "events").groupBy("user_id").agg(F.count_if((k == "purchase") & (v > 80)).alias("p"), F.count_if((k == "click") & (v > 80)).alias("c"), F.count_if(k == "view").alias("w"))
    bucket = F.when(F.col("p") > 0, "purchase").when(F.col("c") > 0, "click").when(F.col("w") > 0, "view").otherwise("none")
    return g.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query("agg_band_counts", "WITH b(lo, hi, band) AS (VALUES (0.0, 50000.0, 'small'), (50000.0, 200000.0, 'medium'), (200000.0, 1e18, 'large'), (-10.0, 0.0, 'negative')) SELECT band, count(o_orderkey) AS n FROM b LEFT JOIN orders ON o_totalprice >= lo AND o_totalprice < hi GROUP BY band")
def band_counts(spark: SparkSession, sf: str) -> DataFrame:
    bands = (((200000.0, "large"), (50000.0, "medium"), (0.0, "small"), (-10.0, "negative")))
    n = load(spark, sf, "orders").groupBy(N.band(F.col("o_totalprice"), bands).alias("b")).agg(F.count("*").alias("c"))
    every = spark.createDataFrame([(b,) for _, b in bands], "band string")
    return every.join(n, every.band == n.b, "left").select("band", F.coalesce("c", F.lit(0)).cast("long").alias("n"))


@query("agg_sum_categorical", "SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 49 THEN l_quantity END), 2) AS total FROM lineitem GROUP BY l_suppkey")
def sum_categorical(spark: SparkSession, sf: str) -> DataFrame:
    test = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 49)
    return load(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum(F.when(test, F.col("l_quantity"))), 2).alias("total"))


@query(
    "agg_pct_change",
    """
    WITH y AS (SELECT c_nationkey, year(o_orderdate) AS y, sum(o_totalprice) AS v FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
    p AS (SELECT c_nationkey, max(v) FILTER (WHERE y = 1996) AS a, max(v) FILTER (WHERE y = 1997) AS b FROM y GROUP BY c_nationkey)
    SELECT n_name, round((b - a) / nullif(a, 0) * 100, 4) AS change_pct FROM p JOIN nation ON n_nationkey = c_nationkey WHERE a IS NOT NULL AND b IS NOT NULL
    """,
)
def pct_change(spark: SparkSession, sf: str) -> DataFrame:
    c, n = load(spark, sf, "customer").select("c_custkey", "c_nationkey"), load(spark, sf, "nation").select("n_nationkey", "n_name")
    o = load(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice").where("y in (1996, 1997)")
    years = o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey").pivot("y", [1996, 1997]).sum("o_totalprice")
    out = years.join(n, years.c_nationkey == n.n_nationkey).where("`1996` is not null and `1997` is not null")
    return out.select("n_name", F.round(N.change_pct(F.col("1996"), F.col("1997")), 4).alias("change_pct"))


@query("agg_coverage_split", "SELECT source, count(*) AS held, count(l.doc_id) AS read, count(*) FILTER (WHERE n_chars > 2000) AS prose FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source")
def coverage_split(spark: SparkSession, sf: str) -> DataFrame:
    read = load(spark, sf, "labels").select("doc_id").distinct().withColumn("r", F.lit(1))
    d = load(spark, sf, "documents").select("doc_id", "source", "n_chars").join(read, "doc_id", "left")
    return d.groupBy("source").agg(F.count("*").alias("held"), F.count("r").alias("read"), F.count_if(F.col("n_chars") > 2000).alias("prose"))


@query("agg_origin_distinct", "SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY source")
def origin_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@query(
    "agg_reconcile_sets",
    """
    WITH a AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS d FROM events WHERE event_type = 'click'), b AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS d FROM events WHERE event_type = 'view')
    SELECT count(*) FILTER (WHERE a.user_id IS NOT NULL AND b.user_id IS NOT NULL) AS "both", count(*) FILTER (WHERE b.user_id IS NULL) AS only_a, count(*) FILTER (WHERE a.user_id IS NULL) AS only_b FROM a FULL JOIN b ON a.user_id = b.user_id AND a.d = b.d
    """,
)
def reconcile_sets(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select("user_id", F.date_trunc("day", F.col("ts")).alias("d"), "event_type")
    return quality.reconciled_counts(e.where("event_type = 'click'"), e.where("event_type = 'view'"), ["user_id", "d"])


@query("agg_hash_dedupe_stats", "SELECT count(*) AS seen, count(*) FILTER (WHERE rn > 1) AS duplicates, sum(n_chars)::BIGINT AS chars_seen, coalesce(sum(n_chars) FILTER (WHERE rn > 1), 0)::BIGINT AS chars_duplicate FROM (SELECT n_chars, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents WHERE lang <> 'es')")
def hash_dedupe_stats(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").where("lang <> 'es'").select(F.sha2("text", 256).alias("h"), "n_chars")
    g = d.groupBy("h").agg(F.count("*").alias("n"), F.max("n_chars").alias("c"))  # equal texts have equal lengths
    return g.agg(F.sum("n").alias("seen"), F.sum(F.col("n") - 1).alias("duplicates"), F.sum(F.col("n") * F.col("c")).alias("chars_seen"), F.sum((F.col("n") - 1) * F.col("c")).alias("chars_duplicate"))


@query("agg_liveness", "SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'O') AS open, max(o_orderdate) AS latest, arg_max(o_orderpriority, o_orderkey) AS newest FROM orders GROUP BY o_custkey")
def liveness(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.max("o_orderdate").alias("latest"), F.max_by("o_orderpriority", "o_orderkey").alias("newest"))


@query("agg_longest_text", "SELECT source, arg_max(doc_id, n_chars * 1000000000 - doc_id) AS doc_id FROM documents GROUP BY source")
def longest_text(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").groupBy("source").agg(F.max_by("doc_id", F.struct("n_chars", (-F.col("doc_id")).alias("i"))).alias("doc_id"))


@query("agg_read_states", "SELECT state, count(*) AS n FROM (SELECT source, CASE WHEN count(l.doc_id) = 0 THEN 'not read' WHEN count(l.doc_id) = count(*) THEN 'fully' ELSE 'partly' END AS state FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY source, lang) GROUP BY state")
def read_states(spark: SparkSession, sf: str) -> DataFrame:
    read = load(spark, sf, "labels").select("doc_id").distinct().withColumn("r", F.lit(1))
    g = load(spark, sf, "documents").select("doc_id", "source", "lang").join(read, "doc_id", "left").groupBy("source", "lang").agg(F.count("*").alias("held"), F.count("r").alias("read"))
    state = F.when(F.col("read") == 0, "not read").when(F.col("read") == F.col("held"), "fully").otherwise("partly")
    return g.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query("agg_best_tier", "SELECT s_nationkey, max(CASE WHEN s_acctbal > 5000 THEN 3 WHEN s_acctbal > 0 THEN 2 ELSE 1 END) AS tier, count(*) AS n, max(CASE WHEN s_acctbal > 5000 THEN 3 WHEN s_acctbal > 0 THEN 2 ELSE 1 END) * 100 + count(*) AS sort_key FROM supplier GROUP BY s_nationkey")
def best_tier(spark: SparkSession, sf: str) -> DataFrame:
    tier = F.when(F.col("s_acctbal") > 5000, 3).when(F.col("s_acctbal") > 0, 2).otherwise(1)
    g = load(spark, sf, "supplier").groupBy("s_nationkey").agg(F.max(tier).alias("tier"), F.count("*").alias("n"))
    return g.withColumn("sort_key", F.col("tier") * 100 + F.col("n"))


@query("agg_year_hist", "SELECT year(o_orderdate) AS y, count(*) AS n, year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AS partial FROM orders WHERE year(o_orderdate) >= 1993 GROUP BY 1")
def year_hist(spark: SparkSession, sf: str) -> DataFrame:
    g = load(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("long").alias("y")).agg(F.count("*").alias("n")).where("y >= 1993")
    return g.withColumn("partial", F.col("y") == F.max("y").over(Window.partitionBy()))  # a row a year


@query("agg_utilisation", "SELECT user_id, round(avg(value), 4) AS mean, round(max(value), 4) AS most, round(count(*) FILTER (WHERE value <= 50) / count(*), 4) AS share_low FROM events GROUP BY user_id")
def utilisation(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").groupBy("user_id").agg(F.round(F.avg("value"), 4).alias("mean"), F.round(F.max("value"), 4).alias("most"), F.round(F.count_if(F.col("value") <= 50) / F.count("*"), 4).alias("share_low"))


@query("agg_gap_counts", "SELECT reason, count(*) AS n, min(CASE reason WHEN 'missing' THEN 0 WHEN 'short' THEN 1 WHEN 'old' THEN 2 ELSE 3 END) AS place FROM (SELECT CASE WHEN text IS NULL THEN 'missing' WHEN n_chars < 100 THEN 'short' WHEN n_chars > 5000 THEN 'old' ELSE 'other' END AS reason FROM documents) GROUP BY reason")
def gap_counts(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    reason = F.when(F.col("text").isNull(), "missing").when(n < 100, "short").when(n > 5000, "old").otherwise("other")
    place = F.when(F.col("reason") == "missing", 0).when(F.col("reason") == "short", 1).when(F.col("reason") == "old", 2).otherwise(3)
    return load(spark, sf, "documents").groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).withColumn("place", place)


# joins ---------------------------------------------------------------------------


@query("jn_inner_dim", "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000")
def inner_dim(spark: SparkSession, sf: str) -> DataFrame:
    o, c = load(spark, sf, "orders"), load(spark, sf, "customer")
    return o.where("o_totalprice > 100000").join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_mktsegment")


@query("jn_left_dim", "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)")
def left_dim(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")


@query("jn_left_on_predicate", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' GROUP BY c_custkey")
def left_predicate(spark: SparkSession, sf: str) -> DataFrame:
    c, o = load(spark, sf, "customer").select("c_custkey"), load(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("jn_left_chain", "SELECT r_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY r_name")
def left_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Each child is counted to its parent before the next join, so nothing fans out."""
    r, n, c = (load(spark, sf, t) for t in ("region", "nation", "customer"))
    per = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("k"))
    by_nation = c.join(per, c.c_custkey == per.o_custkey, "left").groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.sum(F.coalesce("k", F.lit(0))).alias("orders"))
    joined = r.join(n, r.r_regionkey == n.n_regionkey, "left").join(by_nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return joined.groupBy("r_name").agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))


@query(
    "jn_preagg_one_to_one",
    """
    WITH o AS (SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1), l AS (SELECT o_custkey, count(*) AS lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
    SELECT c_custkey, coalesce(orders, 0) AS orders, spent, coalesce(lines, 0) AS lines FROM customer LEFT JOIN o ON o.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey
    """,
)
def one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    c, o = load(spark, sf, "customer").select("c_custkey"), load(spark, sf, "orders")
    lines = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("k"))
    per = o.join(lines, o.o_orderkey == lines.l_orderkey, "left").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"), F.sum(F.coalesce("k", F.lit(0))).alias("lines"))
    return c.join(per, c.c_custkey == per.o_custkey, "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), "spent", F.coalesce("lines", F.lit(0)).alias("lines"))


@query("jn_semi_exists", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi(spark: SparkSession, sf: str) -> DataFrame:
    c, o = load(spark, sf, "customer").select("c_custkey"), load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi")


@query("jn_anti_not_exists", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '5-LOW')")
def anti(spark: SparkSession, sf: str) -> DataFrame:
    c, o = load(spark, sf, "customer").select("c_custkey"), load(spark, sf, "orders").where("o_orderpriority = '5-LOW'").select("o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti")


@query("jn_anti_not_in", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def not_in(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels").where("doc_id is not null").select("doc_id"), "doc_id", "left_anti")


@query("jn_lateral_top1", "SELECT c_custkey, o.o_orderkey, o.o_orderdate FROM customer LEFT JOIN LATERAL (SELECT o_orderkey, o_orderdate FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) o ON true")
def lateral_top1(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select("c_custkey")
    last = versioned.latest(load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey")
    return c.join(last, c.c_custkey == last.o_custkey, "left").select("c_custkey", "o_orderkey", "o_orderdate")


@query("jn_lateral_agg", "SELECT s_suppkey, l.n, l.q FROM supplier LEFT JOIN LATERAL (SELECT count(*) AS n, round(sum(l_quantity), 2) AS q FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R') l ON true")
def lateral_agg(spark: SparkSession, sf: str) -> DataFrame:
    g = load(spark, sf, "lineitem").where("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("q"))
    s = load(spark, sf, "supplier").select("s_suppkey")
    return s.join(g, s.s_suppkey == g.l_suppkey, "left").select("s_suppkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "q")


@query("jn_scalar_subquery", "SELECT n_nationkey, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers, (SELECT string_agg(s_suppkey::VARCHAR, ',' ORDER BY s_suppkey) FROM supplier WHERE s_nationkey = n_nationkey) AS keys FROM nation")
def scalar_subquery(spark: SparkSession, sf: str) -> DataFrame:
    g = load(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("suppliers"), F.array_join(F.array_sort(F.collect_list("s_suppkey")).cast("array<string>"), ",").alias("keys"))
    n = load(spark, sf, "nation").select("n_nationkey")
    return n.join(g, n.n_nationkey == g.s_nationkey, "left").select("n_nationkey", F.coalesce("suppliers", F.lit(0)).cast("long").alias("suppliers"), "keys")


@query("jn_cross_unnest", "SELECT p_partkey, word FROM part, unnest(string_split(p_name, ' ')) AS t(word)")
def cross_unnest(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("jn_self", "SELECT a.doc_id, b.doc_id AS twin FROM documents a JOIN (SELECT md5(text) AS h, min(doc_id) AS doc_id FROM documents GROUP BY 1) b ON md5(a.text) = b.h WHERE a.doc_id <> b.doc_id")
def self_join(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    first = d.groupBy("h").agg(F.min("doc_id").alias("twin"))
    return d.join(first, "h").where("doc_id <> twin").select("doc_id", "twin")


@query("jn_update_from", "SELECT o_orderkey, CASE WHEN n.l_orderkey IS NOT NULL THEN 'R' ELSE o_orderstatus END AS status FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') n ON n.l_orderkey = o_orderkey")
def update_from(spark: SparkSession, sf: str) -> DataFrame:
    o, r = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), load(spark, sf, "lineitem").where("l_returnflag = 'R'").select("l_orderkey").distinct()
    return o.join(r, o.o_orderkey == r.l_orderkey, "left").select("o_orderkey", F.when(F.col("l_orderkey").isNotNull(), "R").otherwise(F.col("o_orderstatus")).alias("status"))


@query(
    "jn_two_pass_coalesce",
    """
    WITH c AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) || ' (old)' ELSE n_name END AS label FROM supplier JOIN nation ON n_nationkey = s_nationkey)
    SELECT s_suppkey, coalesce(d.n_nationkey, a.n_nationkey) AS code FROM c LEFT JOIN nation d ON d.n_name = label LEFT JOIN nation a ON lower(a.n_name) || ' (old)' = label AND a.n_nationkey < 15
    """,
)
def two_pass(spark: SparkSession, sf: str) -> DataFrame:
    s, n = load(spark, sf, "supplier"), load(spark, sf, "nation")
    old = F.concat(F.lower("n_name"), F.lit(" (old)"))
    labelled = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, old).otherwise(F.col("n_name")).alias("label"))
    direct, alias = n.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code")), n.where("n_nationkey < 15").select(old.alias("name"), F.col("n_nationkey").alias("code"))
    return linkage.two_pass(labelled, F.col("label"), direct, alias).select("s_suppkey", "code")


@query(
    "jn_suffix_ref",
    """
    WITH k AS (SELECT c_custkey AS id, c_mktsegment || '/' || (c_custkey % 400) || '/FUL' AS r FROM customer), q AS (SELECT DISTINCT (s_suppkey * 7 % 500)::VARCHAR || '/ful' AS ref FROM supplier)
    SELECT ref, count(id) AS hits, CASE WHEN count(id) = 1 THEN min(id) END AS id FROM q LEFT JOIN k ON upper(r) = upper(ref) OR upper(r) LIKE '%/' || upper(ref) GROUP BY ref
    """,
)
def suffix_ref(spark: SparkSession, sf: str) -> DataFrame:
    k = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.concat_ws("/", "c_mktsegment", (F.col("c_custkey") % 400).cast("string"), F.lit("FUL")).alias("known_ref"))
    q = load(spark, sf, "supplier").select(F.concat((F.col("s_suppkey") * 7 % 500).cast("string"), F.lit("/ful")).alias("ref"))
    return linkage.suffix_links(q, k).select("ref", F.col("hits").cast("long").alias("hits"), "id")


@query(
    "jn_spatial_radius",
    """
    WITH p AS (SELECT s_suppkey AS id, 50 + (s_suppkey * 37 % 100) / 1000.0 AS lat, s_suppkey // 100 * 0.2 + (s_suppkey * 53 % 100) / 1000.0 AS lon FROM supplier)
    SELECT a.id AS left_id, b.id AS right_id FROM p a, p b WHERE 2 * 6371.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) <= 1.0
    """,
)
def spatial_radius(spark: SparkSession, sf: str) -> DataFrame:
    """Places derived from keys, a hundred to an area."""
    k = F.col("s_suppkey")
    lon = F.floor(k / 100) * 0.2 + (k * 53 % 100) / 1000.0
    p = load(spark, sf, "supplier").select(k.alias("id"), (50 + (k * 37 % 100) / 1000.0).alias("lat"), lon.cast("double").alias("lon"))
    return linkage.radius_pairs(p, p, 1.0).select("left_id", "right_id")


@query(
    "jn_nearest",
    """
    WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE vec_id % 50 = 0), s AS (
    SELECT q.vec_id AS query, b.vec_id AS match, list_cosine_similarity(q.e, list_transform(b.embedding, lambda x: x::DOUBLE)) AS c FROM q JOIN embeddings b ON b.vec_id <> q.vec_id)
    SELECT query, match FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(c, 6) DESC, match) AS rn FROM s) WHERE rn = 1
    """,
)
def nearest_vector(spark: SparkSession, sf: str) -> DataFrame:
    v = load(spark, sf, "embeddings").select("vec_id", "embedding")
    return linkage.top_similar(v, v.where("vec_id % 50 = 0")).select("query", "match")


@query(
    "gr_nearest2",
    """
    WITH p AS (SELECT s_suppkey AS id, 50 + (s_suppkey * 37 % 1009) / 100.0 AS lat, -5 + (s_suppkey * 53 % 1013) / 150.0 AS lon FROM supplier),
    r AS (SELECT c_custkey AS rid, 50 + (c_custkey * 4177 % 100003) / 10000.0 AS rlat, -5 + (c_custkey * 5939 % 100019) / 15000.0 AS rlon, c_nationkey % 5 = 0 AS special FROM customer),
    d AS (SELECT id, rid, special, 2 * 6371.0 * asin(sqrt(pow(sin(radians(rlat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(rlat)) * pow(sin(radians(rlon - lon) / 2), 2))) AS km FROM p, r)
    SELECT id, min_by(rid, km) AS right_id, round(min(km), 2) AS km, min_by(rid, km) FILTER (WHERE special) AS special_id, round(min(km) FILTER (WHERE special), 2) AS special_km FROM d GROUP BY id
    """,
)
def nearest_places(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' nearest customer, and nearest of some nations' customers, at places derived from keys."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    p = load(spark, sf, "supplier").select(s.alias("id"), (50 + (s * 37 % 1009) / 100.0).alias("lat"), (-5 + (s * 53 % 1013) / 150.0).alias("lon"))
    r = load(spark, sf, "customer").select(c.alias("id"), (50 + (c * 4177 % 100003) / 10000.0).alias("lat"), (-5 + (c * 5939 % 100019) / 15000.0).alias("lon"), (F.col("c_nationkey") % 5 == 0).alias("special"))
    found = linkage.nearest2(p, r, 5.0, F.col("special"))
    return found.select("id", "right_id", F.round("km", 2).alias("km"), "special_id", F.round("special_km", 2).alias("special_km"))


@query("jn_token_substring", "WITH t(token, ord) AS (VALUES ('promo', 1), ('econ', 2), ('small', 3), ('standard', 4)) SELECT p_partkey, (SELECT token FROM t WHERE contains(lower(p_type), token) ORDER BY ord LIMIT 1) AS token FROM part")
def token_substring(spark: SparkSession, sf: str) -> DataFrame:
    tokens = spark.createDataFrame([("promo", 1), ("econ", 2), ("small", 3), ("standard", 4)], "token string, ord int")
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_type")
    return linkage.first_token(p, tokens, F.col("p_type"), F.lit("")).select(F.col("id").alias("p_partkey"), "token")


@query("jn_prefix_candidates", "WITH c AS (SELECT o_custkey AS site, count(DISTINCT o_orderstatus) AS n, min(o_orderstatus) AS one, bool_or(o_orderstatus = 'P') AS p FROM orders GROUP BY 1) SELECT site, CASE WHEN n = 1 THEN one WHEN p THEN 'P' END AS authority FROM c")
def prefix_candidates(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    candidates = o.select(F.col("o_custkey").alias("site"), F.col("o_orderstatus").alias("authority"))
    return linkage.selected_candidate(candidates, o.select(F.col("o_custkey").alias("site"), F.lit("P").alias("authority")).distinct())


@query("jn_provenance_claims", "SELECT p_partkey, l.l_suppkey, s.s_name FROM part LEFT JOIN (SELECT DISTINCT ON (l_partkey) l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N' ORDER BY l_partkey, l_orderkey, l_linenumber) l ON l.l_partkey = p_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_acctbal > 0")
def provenance(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").where("l_returnflag = 'N'").groupBy("l_partkey").agg(F.min_by("l_suppkey", F.struct("l_orderkey", "l_linenumber")).alias("l_suppkey"))
    p, s = load(spark, sf, "part").select("p_partkey"), load(spark, sf, "supplier").where("s_acctbal > 0").select("s_suppkey", "s_name")
    return p.join(li, p.p_partkey == li.l_partkey, "left").join(s, li.l_suppkey == s.s_suppkey, "left").select("p_partkey", "l_suppkey", "s_name")


# filters, sorts, sets ------------------------------------------------------------

TAGS = "WITH t AS (SELECT user_id, list_sort(list_distinct(array_agg(event_type || ':' || (value > 50)::VARCHAR))) AS tags FROM events GROUP BY user_id) "


def _tags(spark: SparkSession, sf: str) -> DataFrame:
    tag = F.concat_ws(":", "event_type", (F.col("value") > 50).cast("string"))
    return load(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set(tag)).alias("tags"))


@query("flt_tags", TAGS + "SELECT user_id, list_contains(tags, 'error:true') AS member, list_has_all(tags, ['error:true', 'view:true']) AS has_all, len(list_filter(tags, lambda x: x LIKE 'purchase:%')) > 0 AS prefixed FROM t")
def tag_filters(spark: SparkSession, sf: str) -> DataFrame:
    wanted = F.array(F.lit("error:true"), F.lit("view:true"))
    return _tags(spark, sf).select("user_id", F.array_contains("tags", "error:true").alias("member"), (F.size(F.array_except(wanted, "tags")) == 0).alias("has_all"), F.exists("tags", lambda t: t.like("purchase:%")).alias("prefixed"))


@query("flt_in_any", "SELECT event_id FROM events WHERE event_type IN ('error', 'signup') AND NOT user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 98)")
def in_any(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    return e.where(F.col("event_type").isin("error", "signup")).join(e.where("event_type = 'signup' and value > 98").select("user_id"), "user_id", "left_anti").select("event_id")


@query("flt_patterns", "SELECT p_partkey FROM part WHERE regexp_matches(lower(p_name), '(^|[^a-z0-9])[a-r]') AND (p_type ILIKE '%econ%' OR p_type ILIKE '%mall%') AND p_brand LIKE 'Brand#%'")
def patterns(spark: SparkSession, sf: str) -> DataFrame:
    p = load(spark, sf, "part")
    return p.where(F.lower("p_name").rlike("(^|[^a-z0-9])[a-r]") & (F.col("p_type").ilike("%econ%") | F.col("p_type").ilike("%mall%")) & F.col("p_brand").startswith("Brand#")).select("p_partkey")


@query("flt_numeric_text", "SELECT event_id, CASE WHEN regexp_matches(props->>'$.k', '^-?[0-9.]+$') THEN (props->>'$.k')::DOUBLE END AS k FROM events")
def numeric_text(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("double").alias("k"))


@query("flt_between_unit", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND lower(l_returnflag) IN ('a', 'r')")
def between_unit(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "lineitem").where(F.col("l_quantity").between(10, 20) & F.lower("l_returnflag").isin("a", "r")).select("l_orderkey", "l_linenumber")


@query("flt_null_logic", "SELECT doc_id, quality IS NOT DISTINCT FROM NULL AS unknown, CASE WHEN quality IS NULL THEN NULL ELSE quality = 1 END AS good, abs(doc_id) % 3 AS shard FROM documents LEFT JOIN labels USING (doc_id)")
def null_logic(spark: SparkSession, sf: str) -> DataFrame:
    j = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels"), "doc_id", "left")
    q = F.col("quality")
    return j.select("doc_id", q.eqNullSafe(F.lit(None)).alias("unknown"), F.when(q.isNotNull(), q == 1).alias("good"), F.pmod("doc_id", F.lit(3)).alias("shard"))


@query("flt_bool_or_scope", "SELECT event_id FROM events WHERE event_type = 'error' AND value > 90 OR event_type = 'purchase' AND value < 5")
def or_scope(spark: SparkSession, sf: str) -> DataFrame:
    k, v = F.col("event_type"), F.col("value")
    return load(spark, sf, "events").where(((k == "error") & (v > 90)) | ((k == "purchase") & (v < 5))).select("event_id")


@query("prj_json_path", "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_path(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("prj_strings", "SELECT p_partkey, split_part(p_type, ' ', 1) AS first_word, array_to_string(list_reverse(string_split(p_type, ' ')), '-') AS turned, left(coalesce(p_name, ''), 5) AS head, nullif(p_size, 7) AS size, greatest(p_size, 20) AS least_20, trim(p_brand) AS brand FROM part")
def strings(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "part").select("p_partkey", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("first_word"), F.array_join(F.reverse(F.split("p_type", " ")), "-").alias("turned"), F.left(F.coalesce("p_name", F.lit("")), F.lit(5)).alias("head"), F.nullif("p_size", F.lit(7)).alias("size"), F.greatest("p_size", F.lit(20)).alias("least_20"), F.btrim("p_brand").alias("brand"))


@query("prj_jsonb_set", "SELECT event_id, (props->>'$.k')::BIGINT AS original, (props->>'$.k')::BIGINT * 2 AS derived FROM events")
def json_set(spark: SparkSession, sf: str) -> DataFrame:
    """A derived key beside the original one, which is never overwritten."""
    m = F.from_json("props", "map<string,bigint>")
    both = F.to_json(F.map_concat(m, F.create_map(F.lit("derived"), m["k"] * 2)))
    return load(spark, sf, "events").select("event_id", both.alias("j")).select("event_id", F.get_json_object("j", "$.k").cast("long").alias("original"), F.get_json_object("j", "$.derived").cast("long").alias("derived"))


@query("srt_nulls_last", "SELECT doc_id, quality, row_number() OVER (ORDER BY quality DESC NULLS LAST, doc_id) AS place FROM documents LEFT JOIN labels USING (doc_id) ORDER BY place LIMIT 500")
def nulls_last(spark: SparkSession, sf: str) -> DataFrame:
    """A top list of 500."""
    order = [F.desc_nulls_last("quality"), F.col("doc_id")]
    j = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.orderBy(*order).limit(500).withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))


@query("srt_nulls_last_all", "SELECT doc_id, quality, row_number() OVER (ORDER BY quality DESC NULLS LAST, doc_id) AS place FROM documents LEFT JOIN labels USING (doc_id)")
def nulls_last_all(spark: SparkSession, sf: str) -> DataFrame:
    """As `srt_nulls_last`, every row, those without a label after all others."""
    j = load(spark, sf, "documents").select("doc_id").join(load(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return versioned.placed(j, [F.desc_nulls_last("quality"), F.col("doc_id")])


@query("srt_hash_random", "SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 50")
def hash_random(spark: SparkSession, sf: str) -> DataFrame:
    """A deterministic shuffle, of which the first 50."""
    return load(spark, sf, "documents").select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(50)


@query("srt_hash_random_all", "SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) AS place FROM documents")
def hash_random_all(spark: SparkSession, sf: str) -> DataFrame:
    """As `srt_hash_random`, the whole shuffle."""
    return versioned.placed(load(spark, sf, "documents").select("doc_id"), [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")])


@query("srt_case_priority", "SELECT o_orderkey FROM orders ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '5-LOW' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey LIMIT 20")
def case_priority(spark: SparkSession, sf: str) -> DataFrame:
    """A top list of 20."""
    p = F.col("o_orderpriority")
    return load(spark, sf, "orders").orderBy(F.when(p == "1-URGENT", 0).when(p == "5-LOW", 1).otherwise(2), F.desc("o_totalprice"), "o_orderkey").select("o_orderkey").limit(20)


@query("srt_case_priority_all", "SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '5-LOW' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey) AS place FROM orders")
def case_priority_all(spark: SparkSession, sf: str) -> DataFrame:
    """As `srt_case_priority`, every order."""
    p = F.col("o_orderpriority")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return versioned.placed(o, [F.when(p == "1-URGENT", 0).when(p == "5-LOW", 1).otherwise(2), F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "place")


@query("srt_topk_array", "SELECT source, array_to_string(list_slice(list_sort(array_agg(n_chars), 'DESC'), 1, 3), ',') AS top3 FROM documents GROUP BY source")
def topk_array(spark: SparkSession, sf: str) -> DataFrame:
    top = versioned.top_n(load(spark, sf, "documents").select("source", "n_chars", "doc_id"), ["source"], [F.desc("n_chars"), F.col("doc_id")], 3)
    return top.groupBy("source").agg(F.array_join(F.sort_array(F.collect_list("n_chars"), asc=False).cast("array<string>"), ",").alias("top3"))


@query("set_intersect_count", "SELECT count(*) AS n FROM (SELECT user_id FROM events WHERE event_type = 'error' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase')")
def intersect(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events")
    return e.where("event_type = 'error'").select("user_id").intersect(e.where("event_type = 'purchase'").select("user_id")).agg(F.count("*").alias("n"))


@query("set_intersection_all", "SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)")
def intersection_all(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").select("user_id", "event_type")
    every = F.broadcast(e.agg(F.countDistinct("event_type").alias("all")))  # one row
    return e.groupBy("user_id").agg(F.countDistinct("event_type").alias("n")).join(every, F.col("n") == F.col("all")).select("user_id")


@query("set_difference", "SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents WHERE lang = 'en'")
def difference(spark: SparkSession, sf: str) -> DataFrame:
    return merge.orphans(load(spark, sf, "labels").select("doc_id").distinct(), load(spark, sf, "documents").where("lang = 'en'"), ["doc_id"])


@query("set_union_distinct", TAGS + "SELECT user_id, array_to_string(list_sort(list_distinct(list_concat(tags, ['error:true', 'x']))), ',') AS tags FROM t")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return _tags(spark, sf).select("user_id", F.array_join(F.array_sort(F.array_union("tags", F.array(F.lit("error:true"), F.lit("x")))), ",").alias("tags"))


@query("set_concat_lists", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region WHERE upper(r_name) NOT IN (SELECT upper(n_name) FROM nation)")
def concat_lists(spark: SparkSession, sf: str) -> DataFrame:
    return merge.append_unless_present(load(spark, sf, "nation").select(F.col("n_name").alias("name")), load(spark, sf, "region").select(F.col("r_name").alias("name")), "name")


# merges, rules and graphs --------------------------------------------------------


@query(
    "snk_upsert",
    """
    WITH b AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0), u AS (SELECT o_orderkey, 'U' AS o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 END AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)
    SELECT coalesce(b.o_orderkey, u.o_orderkey) AS o_orderkey, coalesce(u.o_orderstatus, b.o_orderstatus) AS o_orderstatus, round(coalesce(u.o_totalprice, b.o_totalprice), 2) AS o_totalprice FROM b FULL JOIN u ON b.o_orderkey = u.o_orderkey
    """,
)
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    o, k = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), F.col("o_orderkey")
    updates = o.where((k % 2 == 0) | (k % 3 == 0)).select("o_orderkey", F.lit("U").alias("o_orderstatus"), F.when(k % 2 == 0, F.col("o_totalprice") + 1).alias("o_totalprice"))
    once = merge.upsert(o.where(k % 3 != 0), updates, ["o_orderkey"], {"o_totalprice": merge.new_or_old})
    return once.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("snk_insert_ignore", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey <= 100 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey > 100 AND c_custkey <= 150")
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    c = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    rows = c.where("c_custkey between 50 and 150").withColumn("c_mktsegment", F.lit("new"))
    return merge.insert_ignore(c.where("c_custkey <= 100"), rows.union(rows), ["c_custkey"])[0]


@query("snk_insert_ignore_all", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0")
def insert_ignore_all(spark: SparkSession, sf: str) -> DataFrame:
    """As `snk_insert_ignore`, over the whole table: two thirds of it as they are, and every second row comes in, twice."""
    c, k = load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("c_custkey")
    rows = c.where(k % 2 == 0).withColumn("c_mktsegment", F.lit("new"))
    return merge.insert_ignore(c.where(k % 3 != 0), rows.union(rows), ["c_custkey"])[0]


@query("snk_state_guarded", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'N' END AS o_orderstatus FROM orders")
def state_guarded(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return merge.state_guarded(o, o.withColumn("o_orderstatus", F.lit("N")), ["o_orderkey"], "o_orderstatus", "F")


@query("gr_materialise", "SELECT action, count(*) AS n FROM (SELECT CASE WHEN s.doc_id IS NULL THEN 'new' WHEN c.doc_id IS NULL AND NOT s.retired THEN 'retired' WHEN c.doc_id IS NULL THEN 'gone' WHEN s.retired THEN 'revived' ELSE 'kept' END AS action FROM (SELECT doc_id, doc_id % 4 = 0 AS retired FROM documents WHERE doc_id % 3 <> 0) s FULL JOIN (SELECT doc_id FROM documents WHERE doc_id % 5 <> 0) c ON c.doc_id = s.doc_id) GROUP BY action")
def retire_revive(spark: SparkSession, sf: str) -> DataFrame:
    d, k = load(spark, sf, "documents").select("doc_id"), F.col("doc_id")
    stored = d.where(k % 3 != 0).withColumn("retired_at", F.when(k % 4 == 0, F.timestamp_seconds(F.lit(0))))
    return merge.retire_and_revive(stored, d.where(k % 5 != 0), "doc_id", now=F.timestamp_seconds(F.lit(1))).groupBy("action").agg(F.count("*").alias("n"))


@query(
    "gr_components",
    """
    WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, o_custkey - (o_custkey % 7) AS b FROM orders WHERE o_custkey % 11 <> 0),
    n AS (SELECT DISTINCT o_custkey AS node FROM orders UNION SELECT b FROM e), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    r AS (SELECT node, node AS reach FROM n UNION SELECT r.node, s.b FROM r JOIN s ON s.a = r.reach)
    SELECT node, min(reach) AS root FROM r GROUP BY node
    """,
)
def components(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_custkey")
    nodes = load(spark, sf, "orders").select(k.alias("node")).distinct()
    return graph.components(nodes, nodes.where("node % 11 <> 0").select(F.col("node").alias("src"), (F.col("node") - F.col("node") % 7).alias("dst")))


@query("gr_stable_key", "SELECT md5(text) AS root, 'SITE-' || min(lpad(doc_id::VARCHAR, 12, '0')) AS site_key FROM documents GROUP BY 1")
def stable_key(spark: SparkSession, sf: str) -> DataFrame:
    m = load(spark, sf, "documents").select(F.md5("text").alias("root"), F.lit("application").alias("kind"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("key"), F.col("source").alias("title"))
    return graph.stable_keys(m).select("root", "site_key")


@query("gr_classification", "SELECT source AS root, CASE WHEN bool_or(n_chars > 1500 AND lang <> 'en') AND bool_or(lang = 'en') THEN 'both' WHEN bool_or(n_chars > 1500 AND lang <> 'en') THEN 'ours_only' WHEN bool_or(lang = 'en') THEN 'barbour_covered' ELSE 'dropped' END AS classification FROM documents GROUP BY source")
def classification(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents")
    m = d.select(F.col("source").alias("root"), F.when(F.col("lang") == "en", "project").otherwise("application").alias("kind"), (F.col("n_chars") > 1500).alias("in_universe"), F.lit(1.0).alias("lat"))
    return graph.classification(m)


@query("gr_joined_via", "SELECT node, arg_max(via, s) AS via FROM (SELECT l_suppkey AS node, CASE WHEN l_quantity > 49 THEN 'project_link' WHEN l_quantity > 48 THEN 'family' ELSE 'spatial' END AS via, CASE WHEN l_quantity > 49 THEN 4 WHEN l_quantity > 48 THEN 3 ELSE 1 END AS s FROM lineitem) GROUP BY node")
def joined_via(spark: SparkSession, sf: str) -> DataFrame:
    q = F.col("l_quantity")
    e = load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("src"), F.col("l_suppkey").alias("dst"), F.when(q > 49, "project_link").when(q > 48, "family").otherwise("spatial").alias("via"))
    return graph.joined_via(load(spark, sf, "supplier").select(F.col("s_suppkey").alias("node")).join(e.select(F.col("src").alias("node")).distinct(), "node"), e)


@query("gr_partition_guard", "SELECT o_custkey AS root, count(DISTINCT o_orderstatus) AS partitions FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1")
def partition_guard(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    m = o.select(F.col("o_custkey").alias("root"), F.col("o_orderkey").alias("node"), F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus")).alias("partition"))
    return graph.partition_conflicts(m).select("root", "partitions")


@query("gr_family_link", "WITH s AS (SELECT DISTINCT o_custkey AS node FROM orders WHERE o_totalprice > 400000) SELECT node FROM s UNION SELECT o_custkey - 1 FROM orders WHERE o_custkey IN (SELECT node FROM s) UNION SELECT o_custkey FROM orders WHERE o_custkey - 1 IN (SELECT node FROM s)")
def family_link(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    edges = o.select(F.col("o_custkey").alias("src"), (F.col("o_custkey") - 1).alias("dst")).distinct()
    return graph.one_hop(o.where("o_totalprice > 400000").select(F.col("o_custkey").alias("node")), edges)


@query("st_resume_antijoin", "SELECT DISTINCT conv_id FROM conversations WHERE conv_id NOT IN (SELECT conv_id FROM conversations WHERE role = 'assistant' AND length(text) > 1500)")
def resume(spark: SparkSession, sf: str) -> DataFrame:
    """What one reader and version has not settled: long answers are read, short ones come back, and another version's do not count."""
    c = load(spark, sf, "conversations")
    long = (F.col("role") == "assistant") & (F.length("text") > 1500)
    ledger = c.select("conv_id", F.when(F.col("role") == "user", "other").otherwise("reader").alias("model"), F.lit("v2").alias("prompt_version"), F.when(long, "read").otherwise("not_extracted").alias("read_state"))
    return contracts.pending(c.select("conv_id").distinct(), ledger, "conv_id", "reader", "v2")


@query("dq_dedupe_archive", "SELECT doc_id, survivor, 'duplicate' AS reason FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text), lang) AS survivor FROM documents) WHERE doc_id <> survivor")
def dedupe_archive(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").select("doc_id", "lang", F.md5("text").alias("h"))
    return quality.dedupe_with_archive(d, ["h", "lang"], "doc_id")[1].select("doc_id", "survivor", "reason")


@query("dq_checks", "SELECT o_orderkey, unnest(list_filter([CASE WHEN NOT o_totalprice > 1000 THEN 'price' END, CASE WHEN NOT o_orderstatus IN ('F', 'O') THEN 'status' END], lambda x: x IS NOT NULL)) AS \"check\" FROM orders")
def checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violations(load(spark, sf, "orders"), {"price": F.col("o_totalprice") > 1000, "status": F.col("o_orderstatus").isin("F", "O")}, "o_orderkey")


@query("dq_retag", "SELECT doc_id, CASE WHEN n_chars < 200 AND doc_id NOT IN (SELECT doc_id FROM labels) THEN 'not_extracted' ELSE 'read' END AS state FROM documents")
def retag(spark: SparkSession, sf: str) -> DataFrame:
    d = load(spark, sf, "documents").select("doc_id", "n_chars", F.lit("read").alias("state"))
    return quality.relabelled(d, "state", F.col("n_chars") < 200, F.lit("not_extracted"), load(spark, sf, "labels"), "doc_id").select("doc_id", "state")


@query("dq_totals", "SELECT abs(sum(v) - (SELECT sum(o_totalprice) FROM orders)) < 0.01 AS adds_up, count(*) AS groups FROM (SELECT o_orderstatus, sum(o_totalprice) AS v FROM orders GROUP BY 1)")
def totals(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    parts = o.groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("v")).agg(F.sum("v").alias("a"), F.count("*").alias("groups"))
    return parts.crossJoin(F.broadcast(o.agg(F.sum("o_totalprice").alias("b")))).select((F.abs(F.col("a") - F.col("b")) < 0.01).alias("adds_up"), "groups")  # a row each


@query("dq_restore_counts", "SELECT 'orders' AS \"table\", count(*) AS live, count(*) FILTER (WHERE o_orderkey % 100 <> 0) AS backup, CASE WHEN count(*) FILTER (WHERE o_orderkey % 100 <> 0) < 0.95 * count(*) THEN 'short' ELSE 'ok' END AS status FROM orders")
def restore_counts(spark: SparkSession, sf: str) -> DataFrame:
    o, name = load(spark, sf, "orders"), F.lit("orders").alias("table")
    return quality.restore_check(o.agg(F.count("*").alias("n")).select(name, "n"), o.where("o_orderkey % 100 <> 0").agg(F.count("*").alias("n")).select(name, "n"))


@query("dq_key_unique", "SELECT user_id, ts, count(*) AS \"count\" FROM events GROUP BY user_id, ts HAVING count(*) > 1")
def key_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_violations(load(spark, sf, "events"), ["user_id", "ts"])


@query("txt_correct_rules", "SELECT sum(CASE WHEN l_extendedprice > 3000 AND l_returnflag = 'N' THEN 1 ELSE 0 END)::BIGINT AS demoted, sum(CASE WHEN l_extendedprice <= 3000 AND l_returnflag = 'N' AND l_tax > 0.07 THEN 1 ELSE 0 END)::BIGINT AS moved, 0::BIGINT AS left_over FROM lineitem")
def correct_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered corrections; the second rule sees what the first did, and applying both again would change nothing."""
    li = load(spark, sf, "lineitem").select(F.when(F.col("l_returnflag") == "N", "site").otherwise("other").alias("verdict"), F.col("l_extendedprice").alias("mw"), "l_tax", F.lit(None).cast("string").alias("note"))
    rules = [
        quality.Rule("large", lambda c: (c("verdict") == "site") & (c("mw") > 3000), {"verdict": F.lit("unclear")}, "too large"),
        quality.Rule("taxed", lambda c: (c("verdict") == "site") & (c("l_tax") > 0.07), {"verdict": F.lit("moved")}, "taxed"),
    ]
    once = quality.corrected(li, rules, "note")
    left = quality.uncorrected(once, rules, "note").agg(F.count("*").alias("left_over"))
    counts = once.agg(F.count_if(F.col("verdict") == "unclear").alias("demoted"), F.count_if(F.col("verdict") == "moved").alias("moved"))
    return counts.crossJoin(F.broadcast(left))  # a row each


@query("txt_gate", "SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'N' AND l_extendedprice > 3000")
def gate(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", F.lit(None).cast("string").alias("note"))
    return quality.uncorrected(li, [quality.Rule("large", lambda c: (c("l_returnflag") == "N") & (c("l_extendedprice") > 3000), {}, "")], "note").agg(F.count("*").alias("n"))


@query("txt_divergence", "SELECT l_partkey, count(DISTINCT l_suppkey) AS audiences, round(max(l_extendedprice / l_quantity) / min(l_extendedprice / l_quantity), 4) AS ratio FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def divergence(spark: SparkSession, sf: str) -> DataFrame:
    told = load(spark, sf, "lineitem").select(F.col("l_partkey").alias("site"), F.lit("price").alias("quantity_type"), F.col("l_suppkey").alias("audience"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("value"))
    return profiles.divergences(told).select(F.col("site").alias("l_partkey"), "audiences", F.round("ratio", 4).alias("ratio"))


@query("txt_cohort_membership", "SELECT user_id, arg_min(event_type, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 ELSE 3 END * 10 + length(event_type)) AS cohort FROM events GROUP BY user_id")
def cohort(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_type")
    place = F.when(k == "purchase", 0).when(k == "signup", 1).when(k == "click", 2).otherwise(3) * 10 + F.length(k)
    return versioned.first_home(load(spark, sf, "events").select("user_id", k.alias("cohort"), place.alias("place")), "user_id", "cohort", "place")


@query("agg_smoke_revenue", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY ALL")
def smoke_revenue(spark: SparkSession, sf: str) -> DataFrame:
    li = load(spark, sf, "lineitem").where("l_shipdate <= date '1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quernstone.operators import claims, entities, graph, linkage, merge, passages, permits, quality, sites, versioned
from quernstone.plans import registry


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_breaks_ties_and_keeps_nulls_last(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (1, None, 9, "c"), (2, None, 3, "d")], "k int, at int, id int, v string")
    assert rows(versioned.latest(df, ["k"], "at", "id").select("k", "v")) == [(1, "b"), (2, "d")]


def test_survivors_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, c string")
    assert rows(versioned.with_survivor(df, ["c"], "id").select("id", "survivor")) == [(1, 1), (2, 1), (3, 3)]


def test_first_home_passes_over_nulls_and_takes_ties_in_table_order(spark, tmp_path):
    lines = [(1, 10, None, 1), (1, 10, 5, 2), (2, 10, 4, 1), (None, 11, 7, 1), (3, 11, 8, 1), (4, 12, None, 1), (6, 13, 2, None), (7, 14, 9, 2), (7, 14, 3, 2), (7, 15, 3, 2), (7, 15, 9, 2), (7, 16, None, 2), (7, 16, 6, 2), (5, None, 9, 1)]
    df = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
    df.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.sql("set threads = 1")
    con.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    got = rows(registry.queries()["win_first_home"](spark, str(tmp_path)))
    assert got == sorted(con.sql(registry.oracle_sql()["win_first_home"]).fetchall(), key=str)
    assert dict(got) == {10: 5, 11: 8, 12: None, 13: None, 14: 9, 15: 3, 16: 6, None: 9}


def test_sample_before_filter(spark):
    df = spark.createDataFrame([(1, k) for k in range(11)], "k int, n int")
    assert [r[1] for r in rows(versioned.every_nth(df, ["k"], [F.col("n")], 5))] == [0, 10, 5]


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a", ["x"]), (2, None, None)], "id int, v string, tags array<string>")
    new = spark.createDataFrame([(2, "n", ["y"]), (3, "z", ["q"]), (1, None, ["x", "w"])], "id int, v string, tags array<string>")
    policies = {"v": merge.new_or_old, "tags": merge.union_tags}
    once = merge.upsert(base, new, ["id"], policies)
    assert rows(once) == [(1, "a", ["x", "w"]), (2, "n", ["y"]), (3, "z", ["q"])]
    assert rows(merge.upsert(once, new, ["id"], policies)) == rows(once)


def test_guard_and_insert(spark):
    base = spark.createDataFrame([(1, "read"), (2, "no_text")], "id int, state string")
    new = spark.createDataFrame([(1, "failed"), (2, "read"), (3, "x"), (3, "a")], "id int, state string")
    assert rows(merge.state_guarded(base, new.where("id < 3"), ["id"], "state", "read")) == [(1, "read"), (2, "read")]
    merged, fresh = merge.insert_ignore(base, new, ["id"])
    assert rows(fresh) == [(3, "a")] and merged.count() == 3


def test_suffix_links_never_guess(spark):
    known = spark.createDataFrame([(1, "Hart/21/01/FUL"), (2, "Kent/21/01/FUL"), (3, "Kent/P22-9")], "id int, known_ref string")
    refs = spark.createDataFrame([("21/01/ful",), ("P22/9",), ("hart/21/01/FUL",), ("1/FUL",)], "ref string")
    got = {r.ref: (r.hits, r.id, r.method) for r in linkage.suffix_links(refs, known).collect()}
    assert got == {"21/01/ful": (2, None, "ref_suffix"), "P22/9": (1, 3, "ref_normalised"), "hart/21/01/FUL": (1, 1, "ref_suffix"), "1/FUL": (0, None, None)}


def test_radius_and_nearest_match_brute_force(spark):
    from math import asin, cos, radians, sin, sqrt

    pts = [(k, 51 + (k * 37 % 101) / 500, -1 + (k * 61 % 103) / 500) for k in range(60)]
    km = lambda a, b: 2 * 6371.0 * asin(sqrt(sin(radians(b[1] - a[1]) / 2) ** 2 + cos(radians(a[1])) * cos(radians(b[1])) * sin(radians(b[2] - a[2]) / 2) ** 2))
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    want = sorted((a[0], b[0]) for a in pts for b in pts if km(a, b) <= 2)
    assert sorted((r.left_id, r.right_id) for r in linkage.radius_pairs(df, df, 2.0).collect()) == want
    far = df.where("id >= 30")
    got = {r.id: r.km for r in linkage.nearest(df.where("id < 30"), far, 1.0).collect()}
    for a in pts[:30]:
        assert abs(got[a[0]] - min(km(a, b) for b in pts[30:])) < 1e-9


def test_radius_goes_round_the_globe(spark):
    from math import asin, cos, radians, sin, sqrt
    import random

    rng = random.Random(4)
    pts = [(k, rng.choice([rng.uniform(-1, 1), rng.uniform(71, 73), rng.uniform(88, 90), rng.uniform(-90, -89)]), rng.choice([rng.uniform(179, 180), rng.uniform(-180, -179), rng.uniform(-180, 180)])) for k in range(120)]
    km = lambda a, b: 2 * 6371.0 * asin(min(1.0, sqrt(sin(radians(b[1] - a[1]) / 2) ** 2 + cos(radians(a[1])) * cos(radians(b[1])) * sin(radians(b[2] - a[2]) / 2) ** 2)))
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    for radius in (60.0, 4000.0):
        want = sorted((a[0], b[0]) for a in pts for b in pts if km(a, b) <= radius)
        assert sorted((r.left_id, r.right_id) for r in linkage.radius_pairs(df, df, radius).collect()) == want


def test_first_token_of_name_then_address(spark):
    df = spark.createDataFrame([(1, "The Acme Hall", "Zed Road"), (2, "Hall", "at ACME place"), (3, "ab", None), (4, None, None), (5, "xq", "q")], "id int, name string, address string")
    tokens = spark.createDataFrame([("zed", 1), ("acme", 2), ("b", 3), ("Q", 4), ("xq", 5), ("", 6)], "token string, ord int")
    got = {r.id: r.token for r in linkage.first_token(df, tokens, F.col("name"), F.col("address")).collect()}
    assert got == {1: "acme", 2: "acme", 3: "b", 4: None, 5: "Q"}
    assert linkage.first_token(df, tokens.limit(0), F.col("name"), F.col("address")).where("token is not null").count() == 0


def test_nearest_has_no_greatest_distance(spark):
    left = spark.createDataFrame([(1, 51.0, 0.0), (2, -40.0, 170.0), (3, None, None)], "id int, lat double, lon double")
    right = spark.createDataFrame([(7, 51.001, 0.0, False), (8, 58.0, -4.0, True), (9, 57.0, -4.0, True)], "id int, lat double, lon double, coal boolean")
    got = {r.id: (r.right_id, r.special_id) for r in linkage.nearest2(left, right, 1.0, F.col("coal")).collect()}
    assert got == {1: (7, 9), 2: (8, 8), 3: (None, None)}


def test_exact_before_near(spark):
    left = spark.createDataFrame([(1, 51.0, 0.0, "AB1")], "id int, lat double, lon double, pc string")
    right = spark.createDataFrame([(7, 51.001, 0.0, "ZZ"), (8, 52.0, 0.0, "AB1"), (9, 53.0, 0.0, "Q")], "id int, lat double, lon double, pc string")
    assert [r.right_id for r in linkage.exact_or_near(left, right, "pc", 1.0).orderBy("rank").collect()] == [8, 7]


def test_components_keys_and_partitions(spark):
    nodes = spark.createDataFrame([(k,) for k in range(8)], "node long")
    edges = spark.createDataFrame([(0, 1, "spatial"), (1, 2, "family"), (5, 6, "project_link")], "src long, dst long, via string")
    assert rows(graph.components(nodes, edges)) == sorted([(0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 5), (6, 5), (7, 7)], key=str)
    assert dict(rows(graph.joined_via(nodes, edges)))[1] == "family"
    m = spark.createDataFrame([(1, 1, "A"), (1, 2, None), (2, 3, "A"), (2, 4, "B")], "root long, node long, partition string")
    assert graph.partition_conflicts(m).first().root == 2
    assert (1, 2, "A") in rows(graph.closed_partitions(m))
    k = spark.createDataFrame([(1, "application", "Z/1", "addr"), (1, "project", "20", "p20"), (1, "project", "100", "p100"), (2, "application", "B/2", None), (2, "application", "A/9", "a")], "root long, kind string, key string, title string")
    assert rows(graph.stable_keys(k)) == [(1, "PTNO-100", "p100"), (2, "SITE-A/9", "a")]


def test_pages(spark):
    sections = spark.range(1).select(passages.paginate(F.array(F.lit("a" * 20), F.lit(" "), F.lit("b" * 20), F.lit("c" * 90), F.lit("d")), 45).alias("s")).first().s
    assert sections == ["a" * 20 + "\n" + "b" * 20, "c" * 90, "d"]
    pages = spark.createDataFrame([("d", k, "x" * 10 + ("hit" if k == 5 else "")) for k in range(9)] + [("e", 0, "short")], "doc string, page int, text string")
    chosen = passages.selected_pages(pages, F.contains("text", F.lit("hit")).cast("int"), F.lit(1))
    assert sorted(r.page for r in chosen.where("selected and doc = 'd'").collect()) == [0, 1, 4, 5, 6]
    cut = passages.select_within(chosen, 33, first=1)
    assert sorted(r.page for r in cut.where("selected and doc = 'd'").collect()) == [0, 1, 5] or sorted(r.page for r in cut.where("selected and doc = 'd'").collect()) == [0, 5]


def test_chunks_lose_nothing(spark):
    pages = spark.createDataFrame([("x", 0, "a" * 30 + "\n" + "b" * 30), ("x", 1, ""), ("x", 2, "c" * 200), ("y", 5, None)], "doc string, page int, text string")
    chunks = passages.chunk_pages(pages, 60).orderBy("doc", "chunk").collect()
    of_x = [r for r in chunks if r.doc == "x"]
    text = "".join(r.text for r in of_x)
    assert text.count("a") == 30 and text.count("b") == 30 and text.count("c") == 200
    assert [r.pages for r in of_x] == [[1], [1, 2], [3]] and all(len(r.text) <= 60 or "c" in r.text for r in of_x)
    assert [(r.doc, r.chunk, r.pages, r.text) for r in chunks if r.doc == "y"] == [("y", 0, [6], "[PAGE 6]\n\n")]


def test_containing_documents_by_brute_force(spark):
    import random

    rng = random.Random(5)
    words = ["the", "of", "cat", "data", "a", "é", "centre", "x1"]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(60)] + [(99, None)]
    quotes = []
    for k in range(120):
        t = rng.choice(docs)[1] or "zz"
        at = rng.randint(0, max(0, len(t) - 1))
        quotes.append((k, t[at : at + rng.choice([1, 2, 3, 5, 9, 20, 45, 90])]))
    quotes += [(900, "  "), (901, None), (902, "The  OF"), (903, "nowhere")]
    q, d = spark.createDataFrame(quotes, "id int, quote string"), spark.createDataFrame(docs, "doc int, text string")
    norm = lambda t: " ".join((t or "").lower().split())
    want = sorted((i, j) for i, s in quotes if norm(s) for j, t in docs if norm(s) in norm(t))
    assert sorted(map(tuple, passages.containing_documents(q, d).collect())) == want
    assert passages.containing_documents(q.limit(0), d).count() == 0


def test_order_and_mapping_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, v string")
    assert quality.ties(df, ["v"]).count() == 1 and quality.ties(df, ["v", "id"]).count() == 0
    assert quality.assert_total_order(df, ["id"]) is df
    with pytest.raises(ValueError):
        quality.assert_total_order(df, ["v"])
    with pytest.raises(ValueError):
        quality.assert_columns(df, ["id"])
    gaps = quality.mapping_gaps(df, df.where("id = 1"), df.where("id = 1").union(spark.createDataFrame([(9, "x")], df.schema)), "id")
    assert rows(gaps) == [(1, "doubled"), (2, "lost"), (3, "lost"), (9, "foreign")]


def test_components_plan_does_not_grow_with_the_rounds(spark):
    import time

    edges = spark.createDataFrame([(f"n{k:04d}", f"n{(k * 7919) % 400:04d}", "spatial") for k in range(400)] + [(f"n{k:04d}", f"n{k + 1:04d}", "family") for k in range(0, 399, 2)], "src string, dst string, via string")
    began = time.time()
    assert graph.components(edges.select(F.col("src").alias("node")), edges).select("root").distinct().count() >= 1
    assert time.time() - began < 60


def test_quote_ladder(spark):
    pages = spark.createDataFrame([("d", 1, "Alpha beta gamma."), ("d", 2, "The data centre s will use 5 MW"), ("d", 3, " "), ("d", 4, "end")], "doc string, page int, text string")
    quotes = [(1, "d", 2, "data centres will use"), (2, "d", 1, "will use 5 MW"), (3, "d", 4, "beta"), (4, "d", 3, "beta"), (5, "d", 1, "beta … 5 MW"), (6, "d", 1, "nowhere"), (7, "d", 9, "nowhere"), (8, "x", 1, "beta"), (9, "d", 1, "…")]
    got = dict((r.id, (r.status, r.verified_page)) for r in passages.verified_quotes(spark.createDataFrame(quotes, "id int, doc string, page int, quote string"), pages).collect())
    assert {k: v[0] for k, v in got.items()} == {1: "pass", 2: "pass_adjacent", 3: "pass_cross_page", 4: "page_empty", 5: "pass_cross_page", 6: "fail", 7: "page_out_of_range", 8: "cache_missing", 9: "fail"}
    assert got[2][1] == 2


def test_clause_is_part_of_its_text(spark):
    said = "Discharge of condition 20 pursuant to 14/1190/OUT; Erection of a data centre of 20,000 sqm with substation - amended plans received"
    df = spark.createDataFrame([(1, said), (2, None), (3, "short")], "id int, t string")
    got = rows(passages.best_clause(df, "id", "t"))
    assert len(got) == 1 and got[0][1] in said and got[0][1].startswith("Erection") and got[0][2] > 0


def test_sentence_candidates(spark):
    p = spark.createDataFrame([("d", 1, "It has 21MW. It has 21MW and 5 kW. There are 14 standby generators.\n\nUp to 48 hours of diesel.")], "doc string, page int, text string")
    got = {(r.pattern, r.match) for r in passages.sentence_candidates(p).collect()}
    assert got == {("capacity", "21MW"), ("generator_count", "14 standby generators"), ("fuel_storage", "48 hours of diesel")}


def test_replies(spark):
    raw = [('```json\n{"findings":[{"a":1}]}\n```',), ("[]",), ('{"findings":[{"a":1},{"b":',), ("none",), (None,)]
    got = [(r.parsed, len(r.salvaged)) for r in passages.parsed_replies(spark.createDataFrame(raw, "raw string")).collect()]
    assert got == [(['{"a": 1}'], 1), ([], 0), (None, 1), (None, 0), (None, 0)]


@pytest.mark.parametrize(
    ("said", "name", "body"),
    [
        ("Applicant is Vantage Data Centers Ltd acting as agent", "Vantage Data Centers Ltd", False),
        ("Nick Heard of Savills", "Savills", False),
        ("The Council of the London Borough of Ealing", "The Council of the London Borough of Ealing", True),
        ("prepared by Arup (London)", "Arup", False),
        ("AECOM prepared the Environmental Statement", "AECOM", False),
        ("the agent", None, False),
        (None, None, False),
    ],
)
def test_entities(spark, said, name, body):
    df = spark.createDataFrame([(said,)], "said string")
    assert tuple(df.select(entities.display_name(F.col("said")).alias("e")).first().e) == (name, body)


def test_keys_of_one_company(spark):
    df = spark.createDataFrame([("Vantage Data Centers Ltd",), ("Vantage Data Centres",), ("City Fibre",), ("CityFibre Limited",)], "t string")
    assert len({r.key for r in entities.parties(df, "t").collect()}) == 2


def test_permits(spark):
    texts = {
        1: ["The total thermal input of the 33 standby generators is 5 generators of 3.9 MWth and 28 generators at 3.6 MWth (approximately 120MWth in total). It runs N+1 for redundancy."],
        2: ["12 x 8.01 MWth."],
        3: [],
        4: None,
        5: ["A plant of 30 MWth in total across two sites.", "Another aggregated 1,200 MW(th)."],
        6: ["intro", "The site has 4 x 5 MWth. It also has 2 x 3 MWth.", "total 50 MWth", None],
        7: ["The combined input of 12 MWth and 30 MWth. Redundancy is by 2 N."],
    }
    got = {r.doc: r for r in permits.permit_readings(spark.createDataFrame(list(texts.items()), "doc int, pages array<string>")).collect()}
    r = got[1]
    assert (r.total_mwth, r.n_engines, r.engines_total, r.generators, r.redundancy, r.agreement) == (120.0, 2, 120.3, 33, "N+1", "agrees")
    assert got[2].agreement == "summed" and got[2].total_mwth == 96.12
    assert got[3].total_mwth is None and got[4].agreement == "none"
    assert (got[5].total_mwth, got[5].total_page, got[5].agreement, got[5].covers) == (1200.0, 2, "unchecked", None)
    assert (got[6].total_mwth, got[6].total_page, got[6].engines_total, got[6].agreement) == (50.0, 3, 26.0, "disagrees")
    assert (got[7].total_mwth, got[7].redundancy) == (30.0, "2N")


def test_permit_names(spark):
    head = "Permit number EPR/VP3235DJ 2 {} Permit number EPR/VP3235DJ"
    rows_ = [
        (1, ["cover", head.format("OFFICIAL Cody Park Data Centre")], "A57, Cody Park, Old Road"),
        (2, [head.format("Schedule 1")], "A57 Road, Cody, CODY, Data Hall - EPR/AB12/A001, Old Lane, F"),
        (3, ["x", "x", "x", "x", head.format("Too late")], "Hall / A001,  , Hall / A001"),
        (4, [], ""),
    ]
    df = spark.createDataFrame(rows_, "id int, pages array<string>, address string")
    got = {r.id: r.n for r in df.select("id", permits.claim_name(F.col("pages"), F.col("address"), F.lit("N")).alias("n")).collect()}
    assert got == {1: "Cody Park Data Centre (N)", 2: "A57 Road, Cody, Data Hall (N)", 3: "Hall (N)", 4: " (N)"}


def test_rules_in_order_and_once(spark):
    data = [(1, "site_capacity", "it_load", 5000.0, "huge", "x", None), (2, "site_capacity", "onsite_generation", 20.0, "battery of 20 MW", "x", None), (3, "site_capacity", "grid_connection", 10.0, "temporary supply", "x", "old"), (4, "site_capacity", "it_load", 800.0, "thermal output of 800mw and 300 MWe", "x", None), (5, "site_capacity", "it_load", 30.0, "IT load of 30 MW for the new halls", "x", None)]
    df = spark.createDataFrame(data, "id int, verdict string, quantity_type string, value_mw double, evidence string, signal_type string, unit_note string")
    rules = quality.capacity_rules()
    with pytest.raises(ValueError):
        quality.require_corrected(df, rules)
    done = quality.corrected(df, rules)
    got = {r.id: (r.verdict, r.quantity_type) for r in done.collect()}
    assert got == {1: ("unclear", None), 2: ("site_capacity", "energy_storage"), 3: ("unclear", None), 4: ("site_capacity", "thermal_input"), 5: ("site_capacity", "it_load")}
    quality.require_corrected(done, rules)
    assert rows(quality.corrected(done, rules)) == rows(done)


def test_large_figures(spark):
    df = spark.createDataFrame([(1, "s", 100.0, "MW", "it_load", "q", "x"), (2, "s", 1000.0, "MVA", "it_load", "per annum", "x"), (3, "t", 4000.0, "MW", "it_load", "battery", "x")], "id int, site string, value_mw double, unit string, quantity_type string, evidence string, signal_type string")
    got = {r.id: r.reasons for r in quality.large_figures(df).collect()}
    assert got == {1: ["exactly 10x another figure"], 2: ["energy units", "apparent power", "exactly 10x another figure"], 3: ["implausible", "storage rating"]}


def test_assertions(spark):
    df = spark.range(10)
    assert quality.assert_count(df, 10) is df
    with pytest.raises(ValueError):
        quality.assert_count(df, 9)
    with pytest.raises(ValueError):
        quality.prune_guard(df, df.where("id < 4"), "id")
    assert quality.prune_guard(df, df.where("id < 6"), "id").count() == 4
    m = spark.createDataFrame([(1, "a", "A", "e" * 50, "site"), (2, "zz", "Q", "short", "company")], "claim_id int, claim_name string, confidence string, evidence string, level string")
    c = spark.createDataFrame([(1, "a"), (2, "b")], "claim_id int, claim_name string")
    assert {r.check for r in quality.match_checks(m, c).collect()} == {"renamed claim", "confidence", "evidence too short", "company-level claim"}


def test_tranches():
    class Fake:
        def orderBy(self, _):
            return self

        def toLocalIterator(self):
            return iter([{"group": g, "n": n} for g, n in (("a", 6), ("b", 5), ("c", 4), ("d", 9))])

    got = passages.tranches(Fake(), 12)
    assert list(got.tranche) == [1, 1, 2, 2] and isinstance(got, pd.DataFrame)


def test_insert_ignore_covers_customers_of_any_id(spark, tmp_path):
    from quernstone.plans import registry

    spark.createDataFrame([(k, "old") for k in range(5000, 5012)], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = rows(registry.queries()["snk_insert_ignore_all"](spark, str(tmp_path)))
    assert got == sorted((k, "old" if k % 3 else "new") for k in range(5000, 5012) if k % 3 or k % 2 == 0)


def test_orders_place_every_row(spark, tmp_path):
    from quernstone.plans import registry

    q = registry.queries()
    spark.range(1200).selectExpr("id AS doc_id", "id * 7 % 1201 AS n_chars").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(600).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.place: r for r in q["srt_nulls_last_all"](spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(1, 1201)) and got[1].doc_id == 1
    assert all(got[600 + k].quality is None and got[600 + k].doc_id == 599 + k for k in range(1, 601))
    jobs = {r.place: r.doc_id for r in q["win_longest_first_all"](spark, str(tmp_path)).collect()}
    assert [jobs[k] for k in range(1, 601)] == sorted(range(600, 1200), key=lambda k: (-(k * 7 % 1201), k))
    assert sorted(r.place for r in q["srt_hash_random_all"](spark, str(tmp_path)).collect()) == list(range(1, 1201))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = versioned.placed(spark.range(1000).repartition(3), [F.desc("id")])
        assert ranges.select(F.spark_partition_id()).distinct().count() > 1
        assert rows(ranges.where("id + place <> 1000")) == [] and ranges.count() == 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = versioned.placed(spark.range(9), [F.col("id")])._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def campus(spark, verdict="new_build"):
    """Two campuses a kilometre apart with a bridge between them."""
    apps = [(1, "Kent/21/001", 51.0, 0.0, "new_build", True), (2, "Kent/21/002", 51.007, 0.0, verdict, verdict != "not_dc"), (3, "Kent/21/003", 51.014, 0.0, "new_build", True), (4, "Kent/21/004", None, None, "procedural", True), (5, "Kent/21/005", 51.5, 0.5, "not_dc", False)]
    a = spark.createDataFrame([(*r, "application" if r[2] else None, "", "d") for r in apps], "id long, ref string, lat double, lon double, verdict string, in_universe boolean, coord_source string, address string, description string")
    p = spark.createDataFrame([(1, 900, "Campus", 51.0, 0.0, False), (2, 901, "Tender", 51.014, 0.0, True)], "id long, ptno long, title string, lat double, lon double, is_tender boolean")
    links = spark.createDataFrame([(1, 1)], "project_id long, application_id long")
    family = spark.createDataFrame([(4, 3, "associated_id"), (3, 77, "description")], "src long, dst long, source string")
    return a, p, links, family


def grouped(members):
    out = {}
    for r in members.collect():
        out.setdefault(r.root, set()).add(r.node)
    return sorted(map(sorted, out.values()))


def test_sites_join_by_record_and_place(spark):
    a, p, links, family = campus(spark)
    members = sites.clusters(a, p, links, family)
    assert grouped(members) == [["A:1", "A:2", "A:3", "A:4", "P:1"], ["P:2"]]
    assert {r.node: r.joined_via for r in members.collect()} == {"A:1": "project_link", "P:1": "project_link", "A:2": "spatial", "A:3": "family", "A:4": "family", "P:2": "singleton"}
    got = sites.sites(members, a, p).collect()
    assert [(r.site_key, r.display_name, r.classification, r.coord_source) for r in got] == [("PTNO-900", "Campus", "both", "barbour")]


def test_sites_stay_apart_across_partitions(spark):
    a, p, links, family = campus(spark)
    parts = spark.createDataFrame([("application", "kent/21/001", "west"), ("application", "Kent/21/004", "east")], "kind string, key string, partition string")
    members = sites.clusters(a, p, links, family, parts)
    # the bridge has no partition, so it joins neither; 3 inherits east from 4, the project west from 1
    assert grouped(members) == [["A:1", "P:1"], ["A:2"], ["A:3", "A:4"], ["P:2"]]
    with pytest.raises(ValueError, match="records there are not"):
        sites.clusters(a, p, links, family, spark.createDataFrame([("project", "1", "x")], parts.schema))
    with pytest.raises(ValueError, match="joins partitions"):
        sites.clusters(a, p, links, family, spark.createDataFrame([("application", "Kent/21/003", "x"), ("application", "Kent/21/004", "y")], parts.schema))


def test_sites_family_does_not_pass_what_is_outside(spark):
    a, p, links, _ = campus(spark, "not_dc")
    family = spark.createDataFrame([(2, 4, "associated_id")], "src long, dst long, source string")
    assert grouped(sites.clusters(a, p, links, family, km=0.1)) == [["A:1", "P:1"], ["A:2"], ["A:3"], ["A:4"], ["P:2"]]
    assert grouped(sites.clusters(a, p, links, family, km=0.1, skip_outside=False)) == [["A:1", "P:1"], ["A:2", "A:4"], ["A:3"], ["P:2"]]


def test_claims_against_their_pages(spark):
    pages = spark.createDataFrame([("d", 1, "Total\n input of 1,234.50   MWth; 4 x 2.5 MWth and 1 x 3")], "doc string, page int, text string")
    rows_ = [
        (1, "d", 1, " input of 1,234.50 MWth", 1234.5, None),
        (2, "d", 2, "x", 1.0, None),
        (3, "d", 1, "input of 9", 9.0, None),
        (4, "d", 1, "input of 1,234.50", 77.0, None),
        (5, "d", 1, "4 x 2.5 MWth and 1 x 3", 13.0, [(4, 2.5), (1, 3.0)]),
        (6, "d", 1, "4 x 2.5 MWth and 1 x 3", 14.0, [(4, 2.5), (1, 3.0)]),
        (7, "d", 1, "4 x 2.5 MWth and 1 x 3", 8.0, [(2, 4.125)]),
    ]
    df = spark.createDataFrame(rows_, "id int, doc string, page int, quote string, value double, engines array<struct<n:int,mw:double>>")
    assert dict(rows(claims.verified_claims(df, pages))) == {1: None, 2: "no_text", 3: "quote_missing", 4: "value_missing", 5: None, 6: "sum_differs", 7: "ratings_missing"}
    digits = spark.createDataFrame([(1, "d", 1, 1234.5), (2, "d", 1, 1235.5), (3, "e", 1, 1.0)], "id int, doc string, page int, value double")
    assert dict(rows(claims.verified_digits(digits, pages))) == {1: None, 2: "value_missing", 3: "no_text"}

"""The operators against brute force, the libraries themselves and exact round trips."""

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Row

from quernstone.llm import chat, exact, html, packing, pieces, quality, rules, shards, simhash, suffix
from quernstone.llm import queries as q
from quernstone.llm.tokens import WordTokens, tokenizer_path
from quernstone.session import shared_folder

ODD = ["", None, " ", "a", "é\n\x00b", "ﬁ ½ ź ​", "x" * 300, "one two three four five " * 60, "日本語 テキスト", "<|endoftext|> </s>", "A  b\tc\r\n\x0b d"]


def documents(spark, texts, first=0):
    rows = [Row(doc_id=first + k, text=t, lang="en", source="s", n_chars=len(t or ""), score=1.5, _row="clash") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, _row string")


def mixed(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    out = list(ODD)
    for _ in range(n):
        body = " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))
        out.append(body + " " + passage if rng.random() < 0.3 else body)
    near = " ".join(rng.choice(words) for _ in range(300)).split()
    for k in range(6):
        out.append(" ".join([*near[: 40 * k], "changed", *near[40 * k + 1 :]]))
    return out + out[-5:] + [out[-1].upper(), None]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, mixed())


def texts_of(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


# 1 -------------------------------------------------------------------------------


def brute_chat(rows):
    """Turns by conversation, straight from the rows."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_chat_round_trip(spark):
    rows = []
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>x<|says|>", "<\\|end|>", "[\\\\/INST]", "\\", "<", "[", None, "", "é日本", "<|end|>" * 3, "<s><\\s>"]
    rng = random.Random(2)
    for conv in range(40):
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", None, "<|end|>"]), rng.choice(nasty) if rng.random() < 0.5 else "text " * rng.randint(0, 9)))
    rows += [rows[0], (5, 1, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for part_bytes in (1 << 20, 200):
        got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(df, part_bytes=part_bytes)).collect()}
        want = brute_chat(rows)
        assert set(got) == set(want)
        for conv, turns in want.items():
            r = got[conv]
            assert r.n_turns == len(turns)
            assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
            learned = "".join(b for a, b in turns if a == "assistant")
            assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_chat_texts_cannot_forge_controls(spark):
    t = chat.ChatTemplate()
    df = spark.createDataFrame([(1, 1, "user", "".join(t.controls))], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df).first().formatted
    inner = formatted[len(t.open + "user" + t.says) : -len(t.close)]
    assert not any(c in inner for c in t.controls)


def test_chat_query(spark, sf_dir):
    got = {r.conv_id: r for r in q.op1_chat_format(spark, sf_dir).collect()}
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{sf_dir}/conversations.parquet'").fetchall()
    fixed = "</s>[INST] ok [/INST]"
    want = brute_chat([*rows, (-7, 0, "user", fixed), (-7, 1, "assistant", fixed)])
    assert {c: got[c].n_turns for c in got} == {c: len(t) for c, t in want.items()}
    for c, turns in want.items():
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert got[-7].loss_chars == len(fixed)


def test_chat_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, None, None, None), (None, 1, "assistant", "x"), (0, 1, "assistant", "y")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.n_turns for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    assert got == {None: 2, 0: 1}
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_columns_empty_and_long_texts(spark, monkeypatch):
    long = "a </s> b [INST] " * 40_000
    rows = [(1, 0, "user", ""), (1, 1, "assistant", ""), (2, 0, "assistant", long), (2, 1, "assistant", long), (3, 0, "", "")]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumn("part", __import__("pyspark").sql.functions.lit("x"))
    for block in (chat.BLOCK_BYTES, 700_000):
        monkeypatch.setattr(chat, "BLOCK_BYTES", block)
        parts = list(chat._format(iter([pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows])], names=["conv_id", "role", "text"])]), chat.ChatTemplate(), 1 << 30))
        assert [(b["conv_id"].to_pylist(), b["part"].to_pylist()) for b in parts] == [([1, 2], [0, 0]), *([] if block > 1 << 20 else [([2], [1])]), ([3], [0])]
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[2].loss_chars, got[3].n_turns) == (2, 0, 2 * len(long), 1)
    assert got[2].loss_sha256 == hashlib.sha256((long + long).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_queries_against_duckdb(spark, sf_dir, name):
    from collections import Counter

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want, got = con.sql(q.ORACLE_SQL[name]), q.QUERIES[name](spark, sf_dir)
    assert sorted(want.columns) == sorted(got.columns)
    assert Counter(tuple(r[c] for c in sorted(got.columns)) for r in got.collect()) == Counter(tuple(r[want.columns.index(c)] for c in sorted(want.columns)) for r in want.fetchall())


# 2 -------------------------------------------------------------------------------


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    ones = int(y.sum())
    return (rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = q.op2_quality_classifier(spark, sf).toPandas()
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").df()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.95
    assert (held.predicted == held.quality).mean() > 0.9
    assert ((rows.score >= 0.3).astype(int) == rows.predicted).all()


def test_quality_features_do_not_depend_on_neighbours():
    texts = ["abc " * 50, "", "zz", "longer text " * 4000, "é" * 9]
    alone = [next(quality.features(pa.array([t]))) for t in texts]
    together = np.concatenate(list(quality.features(pa.array(texts), block=1000)))
    assert np.allclose(np.concatenate(alone), together)


def test_quality_sample_draws_copies_apart(spark):
    rows = spark.range(12_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a text of many copies' ELSE concat('text ', id) END AS text")
    got = quality.drawn(rows, 1200).toPandas()
    assert 1000 < len(got) < 1400
    assert 300 < (got.text == "a text of many copies").sum() < 500


def test_quality_sample_has_a_bound_whatever_repeats(spark):
    rows = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 7L ELSE id END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'one row many times' ELSE concat('text ', id) END AS text")
    for bound in (50, 600):
        got = quality.sampled(rows, False, bound)
        assert got.count() == bound
        assert sorted(got.collect()) == sorted(quality.sampled(rows.repartition(7), False, bound).collect())


def brute_risk(w, bias, p, u, prior):
    """The two terms, straight from the definition."""
    loss = lambda z: float(np.log(1 + np.exp(-z)))
    zp, zu = [float(x @ w + bias) for x in p], [float(x @ w + bias) for x in u]
    return prior * sum(map(loss, zp)) / len(zp), sum(loss(-z) for z in zu) / len(zu) - prior * sum(loss(-z) for z in zp) / len(zp)


@pytest.mark.parametrize("shift", [-1.5, 0.0, 4.0])
def test_quality_risk_and_its_gradient(shift):
    rng = np.random.default_rng(4)
    p, u, w, bias, prior = rng.normal(1, 1, (40, 3)), rng.normal(-1 - shift, 1, (90, 3)), np.array([0.4, 1.1, -0.3]), 0.2, 0.6
    first, second = brute_risk(w, bias, p, u, prior)
    assert np.allclose(quality.risk(p @ w + bias, u @ w + bias, prior), (first, second))
    gp, gu = quality.step_direction(p @ w + bias, u @ w + bias, prior)
    got = np.append(p.T @ gp + u.T @ gu, gp.sum() + gu.sum())
    want, h = np.zeros(4), 1e-6
    for k in range(4):
        sides = []
        for sign in (1, -1):
            at = np.append(w, bias)
            at[k] += sign * h
            a, b = brute_risk(at[:3], at[3], p, u, prior)
            sides.append(a + b if second >= 0 else -b)
        want[k] = (sides[0] - sides[1]) / (2 * h)
    assert np.allclose(got, want, atol=1e-6)
    assert (second >= 0) == (shift == -1.5)  # both branches are met


def test_quality_fit_lowers_the_risk():
    rng = np.random.default_rng(5)
    p, n = rng.normal(1, 1, (300, 4)), rng.normal(-1, 1, (300, 4))
    u = np.concatenate([p[:150], n[:150]])
    model = quality.fit(p, u, 0.5, steps=400)
    both = lambda w, bias: sum(max(0, x) if k else x for k, x in enumerate(brute_risk(w, bias, p, u, 0.5)))
    assert both(model.weights, model.bias) < 0.5 * both(np.zeros(4), 0.0)
    assert (model.score(p) > 0.5).mean() > 0.9 and (model.score(n) < 0.5).mean() > 0.9


def test_quality_columns_and_long_texts(spark, docs):
    labels = spark.createDataFrame([(k, int(k % 3 > 0), None) for k in range(60)], "doc_id long, quality int, toxic int")
    odd = clashing(docs).withColumn("place", __import__("pyspark").sql.functions.lit("yours"))
    assert quality.drop_rejected(odd, labels).schema == odd.schema
    long = "some words of a text " * 200_000
    alone = next(quality.features(pa.array([long])))
    together = np.concatenate(list(quality.features(pa.array(["a", long, ""]))))
    assert np.allclose(alone[0], together[1])


def test_quality_odd_inputs(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(k, int(k % 3 > 0), None) for k in range(60)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    scored = quality.quality_scores(docs, labels)
    assert scored.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in scored.collect())
    assert quality.drop_rejected(docs, labels).columns == docs.columns
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


# 3 -------------------------------------------------------------------------------


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        key = (t or "").encode().translate(exact.LOWER)
        groups.setdefault(key, []).append(i)
    return groups


@pytest.mark.parametrize("budget", [1 << 20, 700])
def test_exact_groups(spark, docs, budget):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = brute_exact(rows)
    got = {r.doc_id: r for r in exact.exact_groups(docs.repartition(3, "doc_id"), budget_bytes=budget).collect()}
    assert len(got) == len(rows)
    for key, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.text_sha256 == hashlib.sha256(key).hexdigest()


def test_exact_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "A"), (1, "a"), (None, "a"), (None, "b"), (2, None), (2, "")], "doc_id long, text string")
    got = exact.exact_groups(df).collect()
    assert sum(r.kept for r in got) == 3
    assert sorted((r.keep_id or -1) for r in got) == [-1, 1, 1, 1, 2, 2]
    assert exact.drop_exact_copies(df).count() == 3
    assert exact.exact_groups(df.limit(0)).count() == 0


def test_grace_table_spills_and_never_merges_by_hash_alone():
    table = exact.GraceTable(lambda s, p: (s or 0) + p, budget=2000)
    contents = [f"content {k % 300}".encode() * 5 for k in range(3000)]
    for c in contents:
        table.add(c, 1, h=hash(c) & 3)  # nearly all hashes collide
    assert dict(table.groups()) == {c: 10 for c in set(contents)}


def clashing(docs):
    """Columns with the names that operators use inside, in types of their own."""
    names = ("row", "_row", "_kept", "fp", "keep", "node", "host", "salt", "n_bytes", "chunk", "slot", "score", "length", "group_row", "a.b")
    for name in names:
        docs = docs.withColumn(name, __import__("pyspark").sql.functions.lit("yours"))
    return docs


def test_exact_keeps_columns(spark, docs):
    kept = exact.drop_exact_copies(docs)
    assert kept.schema == docs.schema and {r._row for r in kept.collect()} == {"clash"}
    assert kept.count() == len(brute_exact([(r.doc_id, r.text) for r in docs.collect()]))
    odd = clashing(docs)
    kept = exact.drop_exact_copies(odd)
    assert kept.schema == odd.schema and {(r.row, r._row, r["a.b"]) for r in kept.collect()} == {("yours",) * 3}
    assert sorted(exact.exact_groups(odd).collect()) == sorted(exact.exact_groups(docs).collect())


def test_grace_table_tells_members_while_it_replays():
    contents = [f"content {k % 50}".encode() * 9 for k in range(500)]
    table = exact.GraceTable(lambda s, p: p if s is None else s, budget=1500)
    got = list(table.states_of((c, k) for k, c in enumerate(contents)))
    assert sorted(got) == [(k, k % 50) for k in range(500)]
    assert not table.spills


# 4 -------------------------------------------------------------------------------


def brute_repeats(rows):
    first = {}
    for i, t in rows:
        for p in range(len(t) - 49):
            w = t[p : p + 50]
            first[w] = min(first.get(w, 1 << 62), i)
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - 49):
            if first[t[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((i, len(t), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])[: len(t)]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("chunk_bytes", "common_chunks", "held_bytes"), [(4 << 20, 16, 1 << 20), (3000, 16, 1 << 20), (900, 2, 1 << 20), (900, 2, 0)])
def test_suffix_dedup(spark, docs, chunk_bytes, common_chunks, held_bytes):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    got = suffix.remove_repeats(docs.repartition(3, "doc_id"), chunk_bytes=chunk_bytes, common_chunks=common_chunks, held_bytes=held_bytes)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == brute_repeats(rows)
    assert any(r.n_removed for r in got.collect())


def test_suffix_common_passages_leave_a_task_once():
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400)).encode()
    held = suffix.Held(4, 1 << 20)
    places = np.array([3])
    assert held.take(9, 1, passage[:60], 7, 100, places) and held.take(9, 1, passage[:60], 5, 200, places) and held.take(9, 1, passage[:60], 6, 300, places)
    assert not held.take(9, 1, passage[:60], 5, 400, places)  # another row of the same id
    out = [(b["bucket"][0].as_py(), b["chunk"][0].as_py()) for b in held.flush()]
    assert sorted(out) == [(-1, 100), (-1, 300), (1, 200)]


def test_suffix_sort_survives_deceiving_hashes(monkeypatch):
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 80))) for _ in range(40)]
    strings += [s[:20] + strings[0][20:] for s in strings[:9]]
    length = np.array([len(s) for s in strings])
    args = (np.arange(len(strings)), length, np.minimum(length - 50, 25), np.frombuffer(b"".join(strings), np.uint8))
    right = suffix.repeated_windows(*args)
    monkeypatch.setattr(suffix.Suffixes, "hash", lambda self, i, begin, length: np.zeros(len(i), np.uint64))
    assert (suffix.repeated_windows(*args) == right).all()


def test_suffix_order_is_lexicographic():
    rng = random.Random(8)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(50, 70))) for _ in range(300)]
    strings += strings[:40]
    length = np.array([len(s) for s in strings])
    s = suffix.Suffixes(np.frombuffer(b"".join(strings), np.uint8), length, np.full(len(strings), 7), np.array([rng.randint(0, 3) for _ in strings], np.uint64))
    order, lcp = s.sorted()
    keyed = [(int(s.key[i]), strings[i][7:]) for i in order]
    assert keyed == sorted(keyed)
    for k in range(1, len(order)):
        assert lcp[k] == (len(os.path.commonprefix([keyed[k][1], keyed[k - 1][1]])) if keyed[k][0] == keyed[k - 1][0] else 0)


def test_suffix_ties_nulls_and_columns(spark):
    text = "the same sentence of more than fifty bytes stands here, twice and more."
    df = spark.createDataFrame([(1, text, 1, 0), (1, text, 2, 0), (2, "é" + text, 3, 0), (None, text, 4, 0), (0, None, 5, 0)], "doc_id long, text string, n_chars long, n_bytes long")
    out = suffix.drop_repeats(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or -1, r.text, r.n_chars) for r in out.collect()) == [(-1, "", 0), (-1, "", 0), (1, text, len(text)), (1, text, len(text)), (2, "é", 1)]
    assert suffix.remove_repeats(df.limit(0)).count() == 0


def test_suffix_keeps_columns_and_long_texts(spark, docs):
    odd = clashing(docs)
    out = suffix.drop_repeats(odd)
    assert out.schema.names == odd.schema.names and {(r.row, r.n_bytes, r["a.b"], r._row) for r in out.collect()} == {("yours",) * 4}
    rng = random.Random(11)
    long = " ".join(str(rng.randint(0, 10**9)) for _ in range(120_000))
    df = spark.createDataFrame([(1, long), (2, "before " + long[5000:1_100_000] + " after")], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix.remove_repeats(df, chunk_bytes=100_000).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 1_095_000 and got[2].n_spans == 1


# 5 -------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><header>H</header><nav><ul><li><a>N</a></ul></nav>
<div class="cookie-notice">C</div><article><header><h1>Head&amp;line</h1><p>by X</p></header><p>One <b>two</b>three<p>four<br>five&nbsp;six<!-- c --><div class="ad">AD</div><form>F</form>
<section id="comments"><p>reader</p></section></article><aside>S</aside><div class=sidebar>B</div><footer>F</footer></body></html>"""


def test_html_article():
    assert html.main_text(PAGE) == "Head&line One twothree four five six"
    assert html.main_text("") == html.main_text("<!-- open") == html.main_text("<script>x") == ""
    assert html.main_text("plain &lt; text\n\nmore") == "plain < text more"
    assert html.main_text("<body><p>a<p>b</body>") == "a b"


def test_html_wrappers_keep_their_article():
    inner = "<article><p>long text of the page</p></article>"
    for wrapper in ("<div class='layout has-sidebar'>%s</div>", "<div id='search-page'>%s</div>", "<form id=aspnetForm>%s</form>", "<div class=sidebar>%s</div>", "<div role=search><div hidden>%s</div></div>"):
        assert html.main_text("<body><nav>n</nav>" + wrapper % inner + "<div class=ad>x</div></body>") == "long text of the page", wrapper
        assert html.main_text("<body><nav>a longer menu than text</nav>" + wrapper % inner.replace("article", "main") + "<div>some more text than main has</div></body>") == "long text of the page", wrapper
        assert html.main_text("<body>" + wrapper % "<p>long text of the page</p>" + "<div class=ad>x</div></body>") == "long text of the page", wrapper
    for part in ("class=sidebar-left", "class='x cookieNotice'", "id=comments", "class=ad-2", "class=site-footer", "class=comment-list", "class=related-posts"):
        assert html.main_text(f"<body><div>text of the page, the longer part</div><div {part}>shorter part</div></body>") == "text of the page, the longer part", part
    # comments and teasers that are articles do not take the place of the text
    assert html.main_text("<body><div>text of the page, the longer part</div><div id=comments><article>reader</article></div></body>") == "text of the page, the longer part"
    assert html.main_text("<body><article>text of the page</article><div class=related><article>teaser</article></div></body>") == "text of the page"


def test_html_deep_and_broken_pages():
    deep = "<div>" * 5000 + "inside" + "</div>" * 5000
    assert html.main_text(deep) == "inside"
    assert "text" in html.main_text('<p title="open>text <b>' * 301)
    assert html.main_text("<<<>>> a < b") == "<<<>>> a < b"


def test_html_templates(spark):
    pages = [(k, f"http://h.example/{k}", f"<body><div><p>shared banner text</p></div><div><p>own {k}</p></div></body>") for k in range(12)]
    pages += [(99, "http://other.example/", "<body><div><p>shared banner text</p></div></body>"), (100, None, None), (100, None, None)]
    got = sorted((r.page_id, r.text, r.n_chars) for r in html.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect())
    assert got == sorted([*((k, f"own {k}", len(f"own {k}")) for k in range(12)), (99, "shared banner text", 18), (100, "", 0), (100, "", 0)])


def test_html_templates_count_different_pages_and_reach_into_articles(spark):
    same = "<body><div><p>one page that has five copies</p></div></body>"
    pages = [(k, "http://h.example/", same if k < 5 else f"<body><div><p>own {k}</p></div></body>") for k in range(12)]
    body = " ".join(f"word{k}" for k in range(40))
    pages += [(20 + k, "http://a.example/", f"<body><article><p>{body} {k}</p><div><p>Share this page</p></div><ul><li>yes</li><li>{k}</li></ul></article></body>") for k in range(6)]
    # where the recurring blocks are most of the article, they stay
    pages += [(40 + k, "http://b.example/", f"<body><article><h1>No {k}</h1><p>{body}</p></article></body>") for k in range(6)]
    # one article in different frames
    pages += [(60 + k, "http://c.example/", f"<body><div><div><article><p>{body}</p></article></div></div><nav>{k}</nav></body>") for k in range(6)]
    got = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k] == ("one page that has five copies" if k < 5 else f"own {k}") for k in range(12))
    assert all(got[20 + k] == f"{body} {k} yes {k}" for k in range(6))
    assert all(got[40 + k] == f"No {k} {body}" for k in range(6))
    assert all(got[60 + k] == body for k in range(6))


PLAIN = """<html><body><div class=a><div><a href=/>Start</a> <a href=/x>Topics</a></div></div>
<div class=b><div class=c><p>{own} first</p><p>{own} second</p></div><div class=d><p>Read our most popular pieces</p></div></div>
<div class=e><p>All rights with the editors of this site</p></div></body></html>"""


def test_html_template_decides_where_no_name_tells(spark):
    """No article, no telling tag or class: only the count over the host's pages can tell what is template."""
    pages = [(k, f"https://plain.example/{k}", PLAIN.format(own=f"own words {k}")) for k in range(20)]
    pages += [(100 + k, f"https://few.example/{k}", PLAIN.format(own=f"own words {k}")) for k in range(4)]
    df = clashing(spark.createDataFrame(pages, "page_id long, url string, html string"))
    whole = {k: html.main_text(p) for k, _, p in pages}
    for limit in (32 << 20, 0):  # templates by broadcast, pages dealt by host
        got = {r.page_id: r.text for r in html.extract_pages(df, broadcast_bytes=limit).collect()}
        assert all(got[k] == f"own words {k} first own words {k} second" for k in range(20))
        assert all(got[100 + k] == whole[100 + k] and "editors" in whole[100 + k] for k in range(4))
    assert html.extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</x>" * 100_000, "<a " * 300_000, "<b><div>" + "<i>" * 100_000 + "</b>" * 100_000, "<!" * 300_000, "</p" * 200_000, "<li>" * 200_000, '<a b="' * 150_000, "<p x='" + "<q " * 200_000, "<script>" + "</script" * 100_000, "<div>" * 300_000, "& &amp " * 100_000])
def test_html_hostile_pages_take_little_time(page):
    import time

    began = time.process_time()
    html.subtree_hashes(html.parse(page), [])
    html.main_text(page, frozenset([1]))
    assert time.process_time() - began < 8


def test_html_of_any_length():
    body = " ".join(f"word{k}" for k in range(300_000))
    assert html.main_text(f"<body><nav>menu</nav><article><p>{body}</p></article></body>") == body


def test_html_query(spark, sf_dir):
    import html as lib

    want = {}
    for i, page in duckdb.sql(f"select page_id, html from '{sf_dir}/pages.parquet'").fetchall():
        article = re.search("<article>(.*?)</article>", page, re.S)[1]
        want[i] = " ".join(lib.unescape(re.sub("<[^>]+>", " ", re.sub("</?b>", "", article))).split())
    got = {r.page_id: r.text for r in q.op5_html_extraction(spark, sf_dir).collect()}
    assert got == want


# 6 -------------------------------------------------------------------------------


def test_packing(spark, docs):
    tokenizer = WordTokens.load(tokenizer_path("word_bpe_49k.json")).tokenizer
    got = packing.packed_documents(docs, tokenizer_path("word_bpe_49k.json"), capacity=64, each=40).collect()
    by_doc, bins = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    for i, t in texts_of(docs).items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids) // 64)))
        for r in parts:
            assert r.start == 64 * r.piece and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + 64].tobytes()) and r.length == len(ids[r.start : r.start + 64])
    for rows in bins.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(bins) <= 1.05 * total / 64 + 2


def test_sum_of_squares_is_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = -np.sort(-rng.integers(1, 1200, 4000))
    at, offset = packing.sum_of_squares(lengths, 2048)
    assert np.bincount(at, lengths).max() <= 2048
    assert at.max() + 1 <= 1.01 * lengths.sum() / 2048 + 1


def test_packing_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (None, "a b"), (4, "c " * 300), (4, "c " * 300), (5, None)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = packing.packed_documents(df, tokenizer_path("word_bpe_49k.json"), capacity=128).collect()
    lengths = {}
    for r in got:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    want = {}
    for (i, _), ids in zip(rows, token_ids(t for _, t in rows), strict=True):
        want[i] = want.get(i, 0) + len(ids)
    assert lengths == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for of_bin in places.values():
        at = 0
        for offset, n in sorted(of_bin):
            assert offset == at
            at += n
        assert at <= 128


def test_packing_empty(spark, docs):
    assert packing.packed_documents(docs.limit(0), tokenizer_path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("text", [*[t for t in ODD if t], "İΣς ſ it's 'S x\x1cy\x85z", "ΑΣ", "é́̂ ²３", "a<|startoftext|>b", "ÀÞ×÷ß don't WE'LL 'S's 12.5%", "x\x85y\xa0z\x1fq", "a" * 70 + " " + "b1" * 90])
def test_word_tokens_are_the_library_s(text):
    words = WordTokens.load(tokenizer_path("word_bpe_49k.json"))
    assert list(next(words.encode([text]))) == words.tokenizer.encode(text, add_special_tokens=False).ids


# 7 -------------------------------------------------------------------------------


def test_pieces_are_the_library_s(spark, docs):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    lib, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceTokens.load(path)
    rng = random.Random(1)
    letters = list("aehinorst THE ▁▁  \n\t.,0123éßñçΣ中🎉\x00​<>/s'")
    texts = list(texts_of(docs).values()) + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [" " * n for n in range(40)]
    for t in texts:
        ids = lib.encode(t)
        assert own.encode(t) == ids
        assert own.decode(ids) == lib.decode(ids) == own.joined(t)[1]
    for _ in range(3000):
        ids = [rng.choice([0, 1, 2, 259, rng.randint(3, 258), rng.randint(3, 31_999)]) for _ in range(rng.randint(0, 6))]
        assert own.decode(ids) == lib.decode(ids)
    got = {r.doc_id: r for r in pieces.encoding_digests(docs, path).collect()}
    for i, t in texts_of(docs).items():
        ids = lib.encode(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert pieces.encode_documents(docs.limit(0), path).count() == 0


def test_pieces_of_long_runs_and_repeated_rows(spark):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(7)
    long = ["".join(rng.choice("ACGT") for _ in range(60_000)), "=" * 5000 + "日" * 300, "ab,cd;" * 4000, "x" * 70 + ",y" * 80]
    df = clashing(spark.createDataFrame([(k, t) for k, t in enumerate(long)] + [(0, long[0]), (None, None)], "doc_id long, text string"))
    got = pieces.encoding_digests(df, path).collect()
    assert len(got) == 6 and len({tuple(r) for r in got}) == 5
    for r in got:
        ids = lib.encode(long[r.doc_id]) if r.doc_id is not None else []
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


# 8 -------------------------------------------------------------------------------


def brute_fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().translate(exact.LOWER))
    if not words:
        return 0
    grams = [b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in fps}


def test_simhash(spark, docs):
    fps = {i: brute_fingerprint(t) for i, t in texts_of(docs).items()}
    want = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_copies(docs).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_golay_code_is_perfect_and_keys_meet():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 500)
    rows, keys = simhash.nearby_indices(words)
    assert set(np.bincount(rows)) == {1, 6}
    for flips in range(3):
        other = words.copy()
        for k in range(len(other)):
            for bit in rng.choice(23, flips, replace=False):
                other[k] ^= 1 << int(bit)
        r2, k2 = simhash.nearby_indices(other)
        assert all(set(keys[rows == k]) & set(k2[r2 == k]) for k in range(len(words)))


def test_every_pair_within_four_bits_shares_a_joint_key():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    other = base.copy()
    for k in range(len(other)):
        for bit in rng.choice(64, 4, replace=False):
            other[k] ^= np.uint64(1) << np.uint64(bit)
    (r1, k1), (r2, k2) = simhash.joint_keys(base), simhash.joint_keys(other)
    assert all(set(k1[r1 == k]) & set(k2[r2 == k]) for k in range(len(base)))


@pytest.mark.parametrize("small", [64, 2])
def test_links_of_dense_and_sparse_buckets(small):
    rng = np.random.default_rng(9)
    center = rng.integers(0, 1 << 62, 5)
    fps = np.unique(np.concatenate([c ^ (np.int64(1) << rng.integers(0, 60, 30)) for c in center] + [rng.integers(0, 1 << 62, 50)]))
    key = np.zeros(len(fps), np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps)], schema=simhash.KEYED)
    edges = [(a, b) for out in simhash._links(iter([batch]), 4, small=max(small, 2) if small == 2 else 200) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)]
    want = brute_components({int(f): int(f) for f in fps})
    nodes, root = simhash.roots(np.array([a for a, _ in edges]), np.array([b for _, b in edges]))
    got = dict(zip(nodes.tolist(), root.tolist(), strict=True))
    assert {f: got.get(f, f) for f in want} == want


def test_simhash_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (None, "z y x"), (7, None), (6, " "), (6, " ")], "doc_id long, text string")
    got = sorted(((r.doc_id or -1), (r.component_id or -1)) for r in simhash.near_copies(df).collect())
    assert got == [(-1, -1), (-1, 4), (4, 4), (6, 6), (6, 6), (7, 6)]
    assert simhash.near_copies(df.limit(0)).count() == 0


def test_simhash_keeps_one_row_and_all_columns(spark, docs):
    odd = clashing(docs)
    kept = simhash.drop_near_copies(odd)
    assert kept.schema == odd.schema and {(r.row, r._kept, r.fp) for r in kept.collect()} == {("yours",) * 3}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect())
    df = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (None, "z y x"), (None, "z y x"), (7, None), (6, " "), (6, " ")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.text) for r in simhash.drop_near_copies(df).collect()) == [(-1, "z y x"), (4, "a b c d e"), (6, " ")]
    assert simhash.drop_near_copies(df.limit(0)).count() == 0


def test_simhash_of_a_very_long_text():
    text = " ".join(str(k * k % 9973) for k in range(70_000))
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_components_of_a_large_star(spark):
    edges = spark.range(1, 3000).selectExpr("id AS a", "CASE WHEN id % 7 = 0 THEN id - 1 ELSE 0 END AS b")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == dict.fromkeys(range(3000), 0)


@pytest.mark.parametrize("each", [2_000_000, 1_000])
def test_links_of_a_large_group_contract_before_components(spark, each):
    rng = np.random.default_rng(3)
    near = {0, *(1 << int(x) | 1 << int(y) for x, y in rng.integers(0, 40, (2000, 2)))}
    fps = sorted(near | {(1 << 62) + (int(k) << 45) for k in range(0, 300, 3)})
    keyed = spark.createDataFrame([(f,) for f in fps], "fp long").mapInArrow(simhash._keyed, simhash.KEYED_DDL)
    edges = keyed.repartition(24, "key").sortWithinPartitions("key").mapInArrow(lambda it: simhash._links(it, 4), simhash.EDGE_DDL).distinct()
    few = simhash.contracted(edges, each)
    nodes = edges.select("a").union(edges.select("b")).distinct().count()
    assert edges.count() > 3 * nodes and few.count() < (nodes if each > 1_000 else edges.count())
    got = {r.node: r.root for r in simhash.components(few).collect()}
    want = brute_components({f: f for f in fps})
    assert {f: got.get(f, f) for f in fps} == want
    assert simhash.contracted(edges.limit(0)).count() == 0


def test_components_of_long_chains(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


# 9 -------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_feistel_is_a_permutation(n):
    slots = shards.permuted(np.arange(n), n, 11)
    assert sorted(slots) == list(range(n))
    if n > 100:
        assert (slots != shards.permuted(np.arange(n), n, 12)).any()


def token_ids(texts):
    tokenizer = WordTokens.load(tokenizer_path("word_bpe_49k.json")).tokenizer
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]


def test_shards_round_trip(spark, docs, tmp_path):
    path = tokenizer_path("word_bpe_49k.json")
    folder = str(tmp_path / "out")
    manifest = shards.write_shards(docs, path, folder, stride=32, per_shard=16)
    texts = texts_of(docs)
    want = dict(zip(texts, token_ids(texts.values()), strict=True))
    got = shards.shard_contents(manifest, folder, stride=32).collect()
    records = {r.slot: np.frombuffer(r.ids, "<u2").astype("<u4") for r in shards.read_shards(manifest, folder, stride=32).collect()}
    n = len(records)
    assert sorted(records) == list(range(n))
    built = {i: np.full(len(ids), -1) for i, ids in want.items()}
    filled = {slot: 0 for slot in records}
    for r in sorted(got, key=lambda r: (r.slot, r.offset)):
        assert r.offset == filled[r.slot]
        filled[r.slot] += r.length
        part = records[r.slot][r.offset : r.offset + r.length]
        assert r.ids_crc32 == zlib.crc32(part.tobytes())
        assert (built[r.doc_id][r.start : r.start + r.length] == -1).all()
        built[r.doc_id][r.start : r.start + r.length] = part
    assert all((built[i] == want[i]).all() for i in want)
    assert all(filled[slot] == len(ids) for slot, ids in records.items())
    # full sequences: only a task's last one is shorter
    assert sum(len(ids) < 32 for ids in records.values()) <= docs.rdd.getNumPartitions()
    assert all(os.path.getsize(r.path) == 68 * r.n for r in manifest.collect())
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(f"shard-{r.shard:08d}.{end}" for r in manifest.collect() for end in ("bin", "arrow"))
    tail = shards.read_shards(manifest, folder, stride=32, from_slot=n - 5).collect()
    assert sorted(r.slot for r in tail) == list(range(n - 5, n))
    # the same key and table give the same order again, another key another one
    again, other = (shards.shard_contents(shards.write_shards(docs, path, str(tmp_path / f"k{k}"), key=k, stride=32, per_shard=16), str(tmp_path / f"k{k}"), stride=32).collect() for k in (20_240_601, 5))
    assert sorted(again) == sorted(got) and sorted(other) != sorted(got)


def test_shards_nulls_repeats_and_long_texts(spark, tmp_path):
    long = "many words in one text " * 20_000
    rows = [(None, "a b"), (None, "a b"), (4, "c"), (4, "c"), (5, None), (6, ""), (7, long)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, slot string").coalesce(1)
    folder = str(tmp_path / "odd")
    got = shards.shard_contents(shards.write_shards(df, tokenizer_path("word_bpe_49k.json"), folder, stride=256), folder, stride=256).collect()
    lengths = {}
    for r in got:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    want = {}
    for (i, _), ids in zip(rows, token_ids(t for _, t in rows), strict=True):
        want[i] = want.get(i, 0) + len(ids)
    assert lengths == want
    assert sum(r.start == 0 for r in got) == len(rows)


def test_shards_query(spark, sf_dir):
    got = q.op9_token_shards(spark, sf_dir).collect()
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    want = dict(zip((i for i, _ in rows), token_ids(t for _, t in rows), strict=True))
    for r in got:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    assert len({(r.doc_id, r.start) for r in got}) == len(got)


def test_shards_empty(spark, docs):
    folder = shared_folder(spark) + "/empty-shards"
    manifest = shards.write_shards(docs.limit(0), tokenizer_path("word_bpe_49k.json"), folder)
    assert manifest.count() == 0
    assert shards.shard_contents(manifest, folder).count() == shards.read_shards(manifest, folder).count() == 0


def test_word_cache_is_bounded_and_forgets_nothing_in_use():
    words = WordTokens(tokenizer_path("word_bpe_49k.json"), cache_bytes=60_000)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abcdeé.," + "日" * (k % 2)) for _ in range(rng.randint(1, 90))) for _ in range(40)) for k in range(60)]
    for t in texts + texts:
        assert list(next(words.encode([t]))) == words.tokenizer.encode(t, add_special_tokens=False).ids
    for cache in (words.pieces, words.words):
        assert len(cache) + len(cache.old) < 200 and max(map(len, [*cache, *cache.old])) <= 64


def test_word_cache_moves_a_common_word_up_once():
    words, missed = WordTokens(tokenizer_path("word_bpe_49k.json"), cache_bytes=60_000).words, []
    missing = type(words).__missing__

    class Counted(type(words)):
        def __missing__(self, key):
            missed.append(key)
            return missing(self, key)

    words.__class__ = Counted
    for k in range(2000):
        assert words["common"] == words.make("common") and words[f"x{k}"] == words.make(f"x{k}")
    assert missed.count("common") == 2 and len(words) + len(words.old) < 250


# 10 ------------------------------------------------------------------------------


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    hit = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_rules(spark, docs):
    texts = texts_of(docs) | {}
    got = {r.doc_id: r for r in rules.rule_verdicts(docs).collect()}
    for i, t in texts.items():
        n = brute_counts(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)


def brute_distance(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    part = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x)
    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


def brute_histograms(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    classes = [0] * rules.N_CLASSES
    for c in text:
        b = c.encode()[0]
        if b < 128:
            k = "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "space" if c in " \t\n\x0b\x0c\r" else "sentence mark" if c in ".,;:?'\"-" else "symbol" if c in "#*$%&|<>" else "other mark"
        else:
            k = "accented" if 0xC3 <= b <= 0xC5 else "other"
        classes[rules.CLASSES.index(k)] += 1
    common = dict.fromkeys(rules.WORDS, 0)
    for w in words:
        w = w.strip(rules.EDGES).lower()
        if w in common:
            common[w] += 1
    return classes, [*common.values(), len(words) - sum(common.values())]


def test_rules_verdicts_by_brute_force(spark, sf_dir):
    """Every reference, distance and verdict of the query, from the definitions."""
    rows = duckdb.sql(f"select doc_id, lang, coalesce(text, '') from '{sf_dir}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in q.op10_quality_rules(spark, sf_dir).collect()}
    limits = rules.RuleLimits()
    of = {i: (lang, brute_counts(t), *brute_histograms(t)) for i, lang, t in rows}
    failed = {i: n[0] < 10 or 100 * n[4] > 20 * n[0] for i, (_, n, _, _) in of.items()}
    by_lang = {}
    for i, (lang, n, classes, words) in of.items():
        if not failed[i] and n[0] >= 60 and sum(classes) >= 400:
            by_lang.setdefault(lang, []).append(([x / sum(classes) for x in classes], [x / sum(words) for x in words]))
    references = {lang: tuple(np.mean([d[k] for d in found], axis=0) for k in (0, 1)) for lang, found in by_lang.items() if len(found) >= 5}
    assert len(references) >= 3
    for i, (lang, n, classes, words) in of.items():
        r = got[i]
        by_class = min((brute_distance(classes, c) for c, _ in references.values()), default=None) if lang in references and sum(classes) >= 400 else None
        by_word = min((brute_distance(words, w) for _, w in references.values()), default=None) if lang in references and n[0] >= 60 else None
        for mine, theirs in ((by_class, r.class_distance), (by_word, r.word_distance)):
            assert (mine is None) == (theirs is None) and (mine is None or abs(mine - theirs) < 2e-6)
        most = 0.25 if n[0] >= 200 else 0.37 if n[0] >= 60 else 1.0
        assert r.kept == (not failed[i] and (r.class_distance or 0) <= limits.max_class_distance and (r.word_distance or 0) <= most)
    assert 0 < sum(not r.kept for r in got.values()) < len(got)


def test_rules_columns_repeats_and_long_texts(spark, docs):
    odd = clashing(docs)
    assert sorted(rules.rule_verdicts(odd).collect(), key=str) == sorted(rules.rule_verdicts(docs).collect(), key=str)
    long = "the quick brown fox of the long text is " * 30_000
    df = spark.createDataFrame([(1, long, "en"), (1, long, "en"), (None, "a", "en")], "doc_id long, text string, lang string")
    got = sorted(rules.rule_verdicts(df).collect(), key=str)
    assert len(got) == 3 and got[0] == got[1] and got[0].n_words == 270_000 and got[0].n_repeat_words == 270_000


def test_rules_repeats():
    rng = random.Random(6)
    for _ in range(200):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 60))]
        assert rules.repeated_words(words) == brute_counts(" ".join(words))[4]
    many = [str(rng.randint(0, 20_000)) for _ in range(9000)]
    many += many[:7]
    assert rules.repeated_words(many) == 14


def test_rules_separate_junk(spark):
    sf = "/root/testdata/sf0.01"
    got = q.op10_quality_rules(spark, sf).toPandas().merge(duckdb.sql(f"select * from '{sf}/labels.parquet'").df(), on="doc_id")
    judged = got[(got.n_words >= 200) & ~got.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.99
    assert judged[judged.quality == 0].kept.mean() < 0.1


def test_rules_empty(spark, docs):
    assert rules.rule_verdicts(docs.limit(0)).count() == 0
    lonely = spark.createDataFrame([(1, None, None), (2, "a b " * 200, None)], "doc_id long, text string, lang string")
    assert rules.rule_verdicts(lonely).count() == 2


def test_rules_rare_languages_have_their_own_reference(spark):
    common = {"en": rules.COMMON["en"][:8], "es": rules.COMMON["es"][:8], "de": rules.COMMON["de"][:8]}

    def text(lang, k):
        rng = random.Random(f"{lang}-{k}")
        return " ".join(rng.choice(common[lang]) if rng.random() < 0.5 else "x" + rng.choice("abcdefgh") + str(rng.randint(0, 999)) for _ in range(250))

    # 5 documents in 6,007, under a thousandth; two of a language that has no reference
    rows = [(k, text("en", k % 40), "en") for k in range(6000)] + [(10_000 + k, text("es", k), "es") for k in range(5)] + [(20_000 + k, text("de", k), "de") for k in range(2)]
    rows += [(30_000, text("es", 9), "en")]
    got = {r.doc_id: r for r in rules.rule_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[10_000 + k].kept and got[10_000 + k].word_distance < 0.2 for k in range(5))
    assert all(got[20_000 + k].kept and got[20_000 + k].word_distance is None for k in range(2))
    # a rare language's reference is not held up to the documents of others
    assert not got[30_000].kept and got[30_000].word_distance > 0.3

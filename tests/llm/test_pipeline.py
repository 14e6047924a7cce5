"""The pipeline's stages against brute force on a small table."""

import sys

from test_llm_operators import brute_components, brute_exact, brute_fingerprint, brute_repeats, documents, mixed

import corpus_pipeline
from quernstone.llm import packing
from quernstone.llm.tokens import tokenizer_path


def test_stages_do_what_they_decide(spark, sf_dir):
    docs = documents(spark, mixed()).select("doc_id", "text", "lang", "source", "n_chars")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    out = corpus_pipeline.exact_dedup(spark, docs, sf_dir)
    kept = {max(ids) for ids in brute_exact(rows).values()}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == kept
    rows = [(i, t) for i, t in rows if i in kept]
    near = corpus_pipeline.near_dedup(spark, out, sf_dir)
    kept = set(brute_components({i: brute_fingerprint(t) for i, t in rows}).values())
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == kept
    rows = [(i, t.encode()) for i, t in rows if i in kept]
    clean = corpus_pipeline.repeat_removal(spark, near, sf_dir)
    left = {i: n - gone for i, n, gone, _, _ in brute_repeats(rows)}
    got = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == docs.columns and {i: len(r.text.encode()) for i, r in got.items()} == left
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 100 and set(out.columns) >= {"doc_id", "sequence_id", "offset", "length"}
    per_bin = out.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0]
    assert per_bin <= 2048
    stages = [f.__name__ for _, f in corpus_pipeline.STAGES]
    assert stages == ["quality_filter", "exact_dedup", "near_dedup", "repeat_removal", "pack"]


def test_stages_take_odd_tables(spark, sf_dir):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(None, None, None, None, None), (None, "null id", "en", "s", 7), (5, "", "en", "s", 0), (5, "twice the id", "en", "s", 12), (5, "twice the id", "en", "s", 12), (6, "word " * 50_000, "en", None, 250_000), (7, "TWICE the id", None, "s", 12)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, ddl)
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.schema.names == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(docs.collect(), ddl)
        left = docs.collect()
        assert len(left) == (4 if rows else 0)
        packed = corpus_pipeline.pack(spark, docs, sf_dir).collect()
        assert {r.doc_id for r in packed} == {r.doc_id for r in left}
        kept = corpus_pipeline.quality_filter(spark, spark.createDataFrame(rows, ddl), sf_dir)
        assert kept.schema.names == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() <= len(rows)


def test_run_leaves_no_stage_behind(spark, sf_dir):
    from quernstone.llm import common

    before = set(common._MADE)
    out = corpus_pipeline.run(spark, sf_dir)
    left = [p for p in common._MADE if p not in before]
    assert not any("-stage-" in p or "-chunks-" in p for p in left)
    assert out.count() > 100


def test_entry_registers_everything():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert sys.modules["corpus_pipeline"] and packing and tokenizer_path

"""The registered queries over whole tables of the smallest scale, against their SQL or brute force, and the pipeline stage by stage."""

import hashlib
import importlib.util
import os
import re
import sys

import numpy as np
import pytest

import corpus_pipeline
from lectern.llm import common, quality, registry

HERE = os.path.dirname(__file__)


def module(path, name):
    spec = importlib.util.spec_from_file_location(name, path)
    out = importlib.util.module_from_spec(spec)
    sys.modules[name] = out
    spec.loader.exec_module(out)
    return out


oracle = module(os.path.join(HERE, "..", "oracle.py"), "llm_oracle")
brute = module(os.path.join(HERE, "test_text_operators.py"), "llm_brute")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    oracle.assert_same(got, oracle.connect(sf_dir).sql(registry.ORACLE_SQL[name]).df())


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


def test_op1_on_rated_documents(spark, sf_dir):
    rows = {r.doc_id: r for r in registry.QUERIES["op1_quality"](spark, sf_dir).collect()}
    assert len(rows) == common.table(spark, sf_dir, "documents").count()
    labels = common.table(spark, sf_dir, "labels").collect()
    right = sum(rows[r.doc_id].keep == (r.quality == 1 and r.toxic == 0) for r in labels if r.doc_id in rows)
    assert right / len(labels) > 0.8


def test_op3_on_pages(spark, sf_dir):
    """The pages' own markup is plain enough for a few replacements."""
    import html

    pages = {r.page_id: r.html for r in common.table(spark, sf_dir, "pages").collect()}
    for r in registry.QUERIES["op3_html"](spark, sf_dir).collect():
        body = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", body.replace("<br>", " ")))
        want = "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert r.text == want and r.n_chars == len(want)


def test_op5_op6_op7_equal_brute_force(spark, sf_dir, documents):
    want = brute.brute_components(documents)
    text = dict(documents)
    for r in registry.QUERIES["op5_minhash"](spark, sf_dir).collect():
        assert (r.class_id, r.component_id) == want[r.doc_id, text[r.doc_id]]
    want = brute.brute_lines(documents)
    for r in registry.QUERIES["op6_lines"](spark, sf_dir).collect():
        assert (r.text, r.n_lines, r.n_removed) == want[r.doc_id, text[r.doc_id]]
    items = [(r.item_id, r.text) for r in common.table(spark, sf_dir, "benchmark").collect()]
    got = {r.doc_id: r for r in registry.QUERIES["op7_decontaminate"](spark, sf_dir).collect()}
    for i, t in documents[:60]:
        n, hit, found = brute.brute_hits(t, items)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (n, hit, len(found))


def test_op8_op9_equal_the_library(spark, sf_dir, documents):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = dict(documents)
    for r in registry.QUERIES["op8_bpe"](spark, sf_dir).collect():
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest())
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    sums = {r.doc_id: r["n"] for r in registry.QUERIES["op9_token_counts"](spark, sf_dir).groupBy("doc_id").sum("n_tokens").withColumnRenamed("sum(n_tokens)", "n").collect()}
    assert sums == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in documents}


def test_op10_leaves_no_value_and_links_equal_ones(spark, sf_dir, documents):
    text = dict(documents)
    patterns = [r"[\w.]+@mail[0-9]+", r"\([0-9]{3}\) 555-[0-9]{4}", r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b"]
    old = {m for t in text.values() for p in patterns for m in re.findall(p, t, re.I)}
    for r in registry.QUERIES["op10_pii"](spark, sf_dir).collect():
        for p in patterns:
            assert not old & set(re.findall(p, r.text, re.I))
        if r.n_values == 0:
            assert r.text == text[r.doc_id]


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    """Each stage's rows against brute force on the stage's own input."""
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    inputs, outputs = [], []
    for name, stage in corpus_pipeline.STAGES:
        before = {(r.doc_id, r.text) for r in docs.collect()}
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        inputs.append(before)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
            outputs.append({(r.doc_id, r.text) for r in docs.collect()})
            assert docs.where("n_chars <> length(text)").count() == 0 or name == "quality_classifier"
    everything = common.table(spark, sf_dir, "documents")
    model = quality.train(everything, common.table(spark, sf_dir, "labels"))
    value = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    import pyarrow as pa

    for i, t in inputs[0]:
        _, buckets = quality.features(pa.array([t]))
        good = 1 / (1 + np.exp(-(sum(value.get(b, 0.0) for b in buckets.tolist()) - model.cuts[-1])))
        if abs(good - quality.KEEP) > 1e-9:
            assert ((i, t) in outputs[0]) == (good > quality.KEEP)
    want = brute.brute_lines(list(inputs[1]))
    assert outputs[1] == {(i, want[i, t][0]) for i, t in inputs[1]}
    components = brute.brute_components(list(inputs[2]))
    assert {i for i, _ in outputs[2]} == {i for (i, _), (_, top) in components.items() if i == top}
    items = [(r.item_id, r.text) for r in common.table(spark, sf_dir, "benchmark").collect()]
    left = dict(outputs[3])
    for i, t in inputs[3]:
        n, hit, _ = brute.brute_hits(t, items)
        if hit == 0:
            assert left[i] == t
        elif hit > 0.5 * n:
            assert i not in left
        elif i in left:
            assert brute.brute_hits(left[i], items)[1] == 0
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    last = {r.doc_id: r.ids for r in docs.collect()}
    assert last == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in outputs[3]}


def test_pipeline_runs_as_a_query(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"](spark, sf_dir).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())

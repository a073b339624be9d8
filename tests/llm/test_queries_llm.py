"""Registered queries on the smallest test table: SQL where there is some, contracts and stages by brute force."""

import collections
import re

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import samples
from pyspark.sql import functions as F
from test_dedup import slow_fingerprint, slow_lines
from test_quality import slow
from tokenizers import Tokenizer

import __spark_entry__ as contract
from shelfwise.llm import catalog, mixing, oracle, quality
from shelfwise.session import fresh_folder, store

pytestmark = pytest.mark.skipif(not samples.HAVE_DATA, reason="test data not present")

COLUMNS = {
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_embedding_dedup": "vec_id n_links component_id kept",
    "op5_mixing": "doc_id size source_size target taken",
    "op6_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op7_simhash": "doc_id fingerprint component_id",
    "op8_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9_language_model": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op10_token_ids": "doc_id start n_tokens ids_crc32",
    "op11_merkle": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op12_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
}


def test_all_are_registered():
    names = {*catalog.QUERIES, "pipeline"}
    assert names <= set(contract.queries())
    assert {name.split("_")[0] for name in catalog.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(oracle.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, name):
    types = dict(catalog.QUERIES[name](spark, samples.FOLDER).dtypes)
    wanted = COLUMNS[name].split()
    assert set(wanted) <= set(types)
    text = {"turns_sha256", "loss_sha256", "fingerprint", "ids_sha256", "decoded_sha256", "part", "filter_order"}
    text |= {"leaf", "subroot", "root", "proof_sha256", "folded_root"}
    number = {"target", "base_score", "score"}
    flag = {"kept", "base_failed", "held_out", "verified"} - ({"kept"} if name.startswith("op13") else set())
    for c in wanted:
        if c == "step":
            assert types[c] == "int"
            continue
        assert types[c] == ("string" if c in text else "double" if c in number else "boolean" if c in flag else "bigint"), c


@pytest.mark.parametrize("name", list(oracle.ORACLES))
def test_same_as_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{samples.FOLDER}/{table}.parquet'")
    plain = lambda v: None if v is None or v != v else round(float(v), 6) if not isinstance(v, (str, bool)) else v
    rows = lambda frame: sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=str)
    assert rows(catalog.QUERIES[name](spark, samples.FOLDER).toPandas()) == rows(duck.execute(oracle.ORACLES[name]).df())


@pytest.fixture(scope="module")
def staged(spark):
    """Input and output of each stage, written like run() does."""
    docs = spark.read.parquet(f"{samples.FOLDER}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        after = store(stage(spark, docs, samples.FOLDER), fresh_folder(spark, "test-stage"))
        found[name] = (docs.collect(), after.collect())
        if name != "packing":
            assert after.dtypes == docs.dtypes
        docs = after
    return found


def test_quality_stage(spark, staged):
    before, after = staged["quality rules"]
    kept = {r.doc_id for r in after}
    assert all(not slow(r.text)["base_failed"] for r in after)
    verdict = spark.createDataFrame(before).select("doc_id", quality.quality(F.col("text")).alias("q")).collect()
    assert kept == {r.doc_id for r in verdict if r.q.kept}
    assert len(kept) > 0.8 * len(before)


def test_line_stage(staged):
    before, after = staged["line dedup"]
    spread = slow_lines([(r.doc_id, r.text, r.source) for r in before], 10)
    seen = collections.Counter(x.strip(" ") for r in after for x in r.text.split("\n") if x.strip(" ") in spread)
    assert spread and seen == dict.fromkeys(spread, 1)
    rest = lambda rows: {r.doc_id: [x for x in r.text.split("\n") if x.strip(" ") not in spread] for r in rows if r.text}
    assert {i: x for i, x in rest(before).items() if x} == {i: x for i, x in rest(after).items() if x}
    assert all(r.n_chars == len(r.text) for r in after)


def test_near_copy_stage(staged):
    before, after = staged["simhash near-dedup"]
    fps = {r.doc_id: slow_fingerprint(r.text) for r in before}
    label = {f: f for f in fps.values()}
    values = np.array(sorted(label), dtype=np.uint64)
    for _ in range(4):
        for f in values:
            close = values[np.bitwise_count(values ^ f) <= 3]
            least = min(label[int(x)] for x in close)
            for x in close:
                label[int(x)] = least
    least = {}
    for i, f in sorted(fps.items()):
        least.setdefault(label[f], i)
    assert sorted(r.doc_id for r in after) == sorted(least.values())


def test_mixing_stage(staged):
    before, after = staged["mixing sources"]
    words = lambda text: len(re.findall(mixing.WORD, text or ""))
    copies = collections.Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 3 and copies.keys() <= {r.doc_id for r in before}
    total = sum(words(r.text) for r in before)
    assert abs(sum(words(r.text) for r in after) - total) < 0.02 * total


def test_packing_stage(staged):
    before, after = staged["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in before}
    pieces = collections.Counter()
    for p in after:
        assert ids[p.doc_id][p.start : p.start + p.length] == list(p.ids) and p.offset + p.length <= 1024
        pieces[p.doc_id] += p.length
    copies = collections.Counter(r.doc_id for r in before)
    assert pieces == {i: n * len(ids[i]) for i, n in copies.items()}


def test_run_is_the_stages(spark, staged):
    got = corpus_pipeline.run(spark, samples.FOLDER).collect()
    key = lambda p: (p.doc_id, p.start, p.length)
    assert sorted(map(key, got)) == sorted(map(key, staged["packing"][1]))


def test_stages_take_odd_and_no_documents(spark):
    for docs in (samples.documents(spark), samples.no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            after = store(stage(spark, docs, samples.FOLDER), fresh_folder(spark, "test-stage"))
            assert name == "packing" or after.dtypes == docs.dtypes
            docs = after
        docs.collect()

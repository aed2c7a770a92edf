"""The registered queries against DuckDB or invariants, and the pipeline against a brute-force version."""

import os
import re
from collections import Counter, defaultdict
from glob import glob

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from shelfcast.llm.queries import ORACLES, QUERIES
from shelfcast.llm.queues import in_written_order, stream_weights
from shelfcast.session import written_here
from tests.llm.conftest import story
from tests.llm.test_mixing_and_packing import brute_ids
from tests.llm.test_rules_and_model import brute

TABLES = "documents embeddings pages benchmark labels conversations"


def test_all_are_registered():
    names = entry_module.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and set(QUERIES) <= set(names)
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in entry_module.oracle_sql()
    assert [name for name, _ in corpus_pipeline.STAGES][2] == "MinHash near-dedup" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, tiny, name):
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tiny}/{table}.parquet'")
    found = QUERIES[name](spark, tiny)
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    want = Counter(tuple(r[columns.index(c)] for c in found.columns) for r in result.fetchall())
    assert Counter(map(tuple, found.collect())) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_a_row_per_input_row(spark, tiny, name):
    table, key = ("embeddings", "vec_id") if name.startswith("op3") else ("documents", "doc_id")
    ids = [r[0] for r in spark.read.parquet(f"{tiny}/{table}.parquet").select(key).collect()]
    rows = QUERIES[name](spark, tiny).collect()
    if name.startswith("op2"):
        assert {r["doc_id"] for r in rows} == set(ids)
        assert sum(r["length"] for r in rows) == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    else:
        assert sorted(r[key] for r in rows) == sorted(ids)


def brute_pipeline(spark, sf_dir):
    """Documents that stay: rules by plain counts, the fitted machine's own verdicts, classes from all pairs of texts."""
    from shelfcast.llm.quality_model import score, train

    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    measured = {i: brute(r["text"]) for i, r in docs.items()}

    def fine(m):
        size = max(1, m["word_chars"])
        if m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]:
            return False
        limits = {"dup_line_chars": 0.35, "dup_5gram_chars": 0.35, "dup_8gram_chars": 0.30, "dup_12gram_chars": 0.25}
        return all(m[k] / size <= v for k, v in limits.items())

    left = [i for i in docs if fine(measured[i])]
    frame = spark.createDataFrame([docs[i] for i in left], spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    machine = train(frame, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    left = sorted(r["doc_id"] for r in score(frame, machine).collect() if r["predicted"] == 1)
    sets = {}
    for i in left:
        w = re.findall(r"[^\x20\x09-\x0D]+", docs[i]["text"])
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    shared = Counter((a, b) for own in at.values() for k, b in enumerate(own) for a in own[:k])
    parent = {i: i for i in left}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return {i: docs[i] for i in left if top(i) == i}


def test_pipeline_matches_brute_force(spark, tiny):
    want = brute_pipeline(spark, tiny)
    with written_here() as made:
        rows = corpus_pipeline.run(spark, tiny).collect()
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in made if os.path.exists(p.removeprefix("file:"))}
    assert "mixing-sources-to-target-weights" in left and not left & {"quality-rules", "sketches", "mixing-rows", "MinHash-near-dedup"}
    assert {r["doc_id"] for r in rows} == set(want)
    whole = defaultdict(dict)
    for r in rows:
        whole[r["doc_id"]][r["start"]] = np.frombuffer(r["ids"], "<u4").tolist()
    for i, parts in whole.items():
        assert sum((parts[k] for k in sorted(parts)), []) == brute_ids(want[i]["text"])
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    filled = defaultdict(int)
    for s, at, n in places:
        assert at == filled[s]
        filled[s] += n
    assert all(n == 1024 for s, n in filled.items() if s < max(filled))


def test_stages_on_awkward_rows(spark, awkward, no_docs, tiny):
    for docs in (awkward, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, tiny)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, tiny).count() >= (docs is awkward)


@pytest.fixture(scope="module")
def three_sources(spark):
    rows = {"a": 1600, "b": 400, "c": 100, None: 36}
    made = [(i, f"{k} {story(i, 60)}", k) for k, n in rows.items() for i in range(n)]
    return rows, spark.createDataFrame(made, "doc_id long, text string, source string").repartition(4)


def written(spark, docs, folder, shuffled=False):
    """The rows as files; ``shuffled`` makes Spark read the files in another order, since it takes large ones first."""
    docs.write.parquet(str(folder))
    if shuffled:
        sizes = sorted(glob(f"{folder}/part-*"))
        again = f"{folder}-again"
        os.mkdir(again)
        for k, name in enumerate(sizes):  # the same rows in files padded to another order of size
            table = pq.read_table(name)
            pad = {b"pad": b"x" * (100_000 * (k + 1))}
            pq.write_table(table.replace_schema_metadata({**(table.schema.metadata or {}), **pad}), f"{again}/{os.path.basename(name)}")
        folder = again
    return spark.read.parquet(str(folder))


def packed(spark, stream, tiny):
    return sorted((r["source_queue"], r["doc_id"], r["start"], r["sequence_id"], r["offset"]) for r in corpus_pipeline.packing(spark, stream, tiny).collect())


def test_packing_follows_the_stream_of_the_mixing_stage(spark, three_sources, tiny, tmp_path, monkeypatch):
    rows, docs = three_sources
    stream = written(spark, corpus_pipeline.mixing(spark, docs, tiny), tmp_path / "mixed")
    got = defaultdict(Counter)
    for r in corpus_pipeline.packing(spark, stream, tiny).collect():
        got[r["sequence_id"]][r["source_queue"]] += r["length"]
    weights = {k: n**corpus_pipeline.TEMPERATURE for k, n in rows.items()}
    last = min(max(s for s in got if got[s][q]) for q in range(4))
    assert last > 5
    seen = stream_weights(in_written_order(stream, "at"), "source", "at")
    for q, k in enumerate(("a", "b", "c", "")):
        share = seen[k] / sum(seen.values())
        assert abs(share - weights[k or None] / sum(weights.values())) < 0.03  # blocks of 16 documents
        assert all(abs(got[s][q] - 1024 * share) < 2 for s in range(last))
    plain = packed(spark, stream, tiny)
    assert packed(spark, written(spark, corpus_pipeline.mixing(spark, docs, tiny), tmp_path / "more", shuffled=True), tiny) == plain
    monkeypatch.setattr(corpus_pipeline, "TEMPERATURE", 1.0)
    assert packed(spark, written(spark, corpus_pipeline.mixing(spark, docs, tiny), tmp_path / "other"), tiny) != plain


def test_stages_do_not_take_input_columns_for_their_verdicts(spark, awkward, tiny):
    taken = {"kept": "no", "predicted": "x", "n_class": "y", "class_id": "z", "n_words": "many"}
    docs = awkward
    for name, value in taken.items():
        docs = docs.withColumn(name, F.lit(value))
    for _, stage in corpus_pipeline.STAGES[:3]:
        rows = stage(spark, docs, tiny)
        assert rows.dtypes == docs.dtypes
        plain = stage(spark, awkward, tiny)
        found = rows.collect()
        assert Counter((r["doc_id"], r["text"]) for r in found) == Counter((r["doc_id"], r["text"]) for r in plain.collect())
        assert all(r[name] == value for r in found for name, value in taken.items())

"""Repetition rules and the factorisation machine."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm.quality_model import STATISTICS, FactorisationMachine, Settings, features, held_out, score, train
from shelfcast.llm.quality_rules import RepetitionRules, _measure, repetition
from shelfcast.llm.text import Texts, Words, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, rules=RepetitionRules()):
    text = text or ""
    words = WORD.findall(text)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(map(text.count, "#*$%&|<>"))}
    seen, out["n_dup_lines"], out["dup_line_chars"] = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                out["n_dup_lines"] += 1
                out["dup_line_chars"] += sum(map(len, WORD.findall(line)))
            seen.add(line)

    def windows(n):
        return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]

    times = Counter(windows(rules.base_gram))
    out["n_repeat_words"] = len({i + k for i, w in enumerate(windows(rules.base_gram)) if times[w] > 1 for k in range(rules.base_gram)})
    for n, _ in rules.gram_limits:
        seen, inside = set(), set()
        for i, w in enumerate(windows(n)):
            if w in seen:
                inside |= set(range(i, i + n))
            seen.add(w)
        out[f"dup_{n}gram_chars"] = sum(len(words[i]) for i in inside)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t#|日 ", max_size=60)), max_size=8))
def test_measures_match_a_plain_count(texts):
    found = _measure(Texts(pa.array(texts, pa.string())), RepetitionRules())
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in found.items()} == brute(text)


def test_rules_on_awkward_rows(awkward):
    rows = repetition(awkward).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        want = brute(r["text"])
        assert {k: r[k] for k in want} == want
        assert r["base_failed"] == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert {1, 9, 10, 11} <= kept and not kept & {2, 3, 4, 5, 7, 8}
    halves = next(r for r in rows if r["doc_id"] == 12)
    assert not halves["kept"]


def test_rules_with_clashing_names_and_no_rows(awkward, no_docs):
    clash = awkward.withColumns({"n_words": F.lit("x"), "kept": F.lit(9)})
    assert sorted(r["n_words"] for r in repetition(clash).collect()) == sorted(r["n_words"] for r in repetition(awkward).collect())
    assert repetition(no_docs).count() == 0


def test_slices_keep_rows_and_bound_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "", "c" * 10])], names=["t"])
    parts = list(slices(iter([batch]), "t", 25))
    assert sum((p.column("t").to_pylist() for p in parts), []) == batch.column("t").to_pylist()
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column("t").to_pylist()) <= 25 for p in parts)


def test_equal_words_have_equal_hashes_anywhere():
    words = Words(Texts(pa.array(["x alpha beta", "alpha  y beta alpha"])))
    h = words.hash()
    assert h[1] == h[3] == h[6] and h[2] == h[5] and len(set(h.tolist())) == 4


def _machine():
    small = Settings(bits=6, factors=3)
    m = FactorisationMachine.empty(small)
    rng = np.random.default_rng(0)
    m.linear[:] = rng.normal(size=len(m.linear))
    m.factors[:] = rng.normal(size=m.factors.shape) * 0.3
    return m


def test_linear_time_pair_sum_is_the_sum_over_pairs():
    m = _machine()
    bounds, bucket, value, stats = features(Texts(pa.array(["a b c a", "", "d e f g h"])), np.zeros(3), m.bits)
    got = m.score(bounds, bucket, value, stats)
    z = m.scaled(stats)
    for row in range(3):
        x = np.zeros(len(m.linear))
        x[bucket[bounds[row] : bounds[row + 1]]] = value[bounds[row] : bounds[row + 1]]
        x[-len(STATISTICS) :] = z[row]
        y = m.bias + m.linear @ x
        y += sum(m.factors[i] @ m.factors[j] * x[i] * x[j] for i in range(len(x)) for j in range(i) if x[i] and x[j])
        assert got[row] == pytest.approx(1 / (1 + np.exp(-y)), abs=1e-5)


def test_model_ranks_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    machine = train(docs, labels, Settings(sample_rows=1500))
    rows = score(docs, machine).join(labels, "doc_id").filter(held_out("doc_id")).select("score", "quality", "predicted").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.99


def test_labels_of_held_out_rows_do_not_matter(spark, tiny):
    docs, labels = spark.read.parquet(f"{tiny}/documents.parquet"), spark.read.parquet(f"{tiny}/labels.parquet")
    out = zlib.crc32(b"10") % 5 == 0
    assert spark.range(10, 11).select(held_out("id")).first()[0] == out
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = train(docs, labels), train(docs, flipped)
    assert a.bias == b.bias and (a.linear == b.linear).all() and (a.factors == b.factors).all()


def test_scores_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (7, 0), (8, 0), (9, None), (99, 1), (None, 1)], "doc_id long, quality int")
    machine = train(awkward, labels)
    rows = score(awkward.withColumn("score", F.lit("taken")), machine).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score_"] <= 1 for r in rows)
    assert len({r["score_"] for r in rows if r["doc_id"] == 1}) == 1
    assert score(no_docs, machine).count() == 0
    none = train(awkward, labels.filter("false"))
    assert all(abs(r["score"] - 0.5) < 0.2 for r in score(awkward.drop("n_chars"), none).collect())
    assert train(no_docs, labels).bias == 0.0

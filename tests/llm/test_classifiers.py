import math
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import cardweave.llm.quality as quality
import cardweave.llm.toxicity as toxicity
from cardweave.llm.learning import fold, labelled_sample

TABLES = "/root/testdata/sf0.1"
here = pytest.mark.skipif(not os.path.isdir(TABLES), reason="the driver's tables are not here")


def test_folds(spark):
    rows = spark.range(200).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def separable(n):
    """Texts that shout are bad; texts with an insult and a group are toxic."""
    rng = np.random.default_rng(1)
    texts, good, toxic = [], [], []
    for _ in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(int(rng.integers(3, 60)))]
        bad, rude = rng.random() < 0.3, rng.random() < 0.3
        if rude:
            words.insert(int(rng.integers(0, len(words))), "blockhead" + str(rng.choice(["", "s", "ly"])))
        texts.append(" ".join(w.upper() + "!!" for w in words) if bad else " ".join(words))
        good.append(int(not bad))
        toxic.append(int(rude))
    return texts, good, toxic


@pytest.fixture(scope="module")
def labelled(spark):
    texts, good, toxic = separable(500)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame(list(zip(range(500), good, toxic)), "doc_id BIGINT, quality INT, toxic INT")
    return docs, labels, good, toxic


@pytest.mark.parametrize("judge, column", [(quality.judge_quality, 2), (toxicity.judge_toxicity, 3)])
def test_learns_and_scores_everything(spark, labelled, judge, column):
    docs, labels, *_ = labelled
    odd = spark.createDataFrame(
        [(1000, None), (1001, ""), (None, "no id"), (1002, "word " * 40_000), (3, "again"), (3, "again")], docs.schema
    )
    got = judge(docs.union(odd), labels).collect()
    assert len(got) == 506 and all(0 <= r.score <= 1 for r in got)
    truth = dict(enumerate(labelled[column]))
    held = [r for r in got if r.held_out and r.doc_id in truth and r.text != "again"]
    assert len(held) > 50
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert len({r.score for r in got if r.text == "again"}) == 1
    empty = {r.score for r in got if not r.text}
    assert len(empty) == 1


@pytest.mark.parametrize("judge", [quality.judge_quality, toxicity.judge_toxicity])
def test_held_out_labels_are_not_learnt_from(labelled, judge):
    docs, labels, *_ = labelled
    module = quality if judge is quality.judge_quality else toxicity
    column = "quality" if module is quality else "toxic"
    out = fold(F.col("doc_id"), module.FOLDS) == module.HELD_OUT
    turned = labels.withColumn(column, F.when(out, 1 - F.col(column)).otherwise(F.col(column)))
    score = lambda x: {r.doc_id: r.score for r in judge(docs.where("doc_id < 60"), x).collect()}
    assert score(labels) == score(turned)


@pytest.mark.parametrize("judge", [quality.judge_quality, toxicity.judge_toxicity])
def test_empty_tables_and_odd_labels(spark, labelled, judge):
    docs, labels, *_ = labelled
    assert judge(docs.limit(0), labels).collect() == []
    scores = {r.score for r in judge(docs.where("doc_id < 9"), labels.limit(0)).collect()}
    assert scores == {0.5}
    odd = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 7, 7), (9999, 1, 1)], labels.schema)
    assert {r.score for r in judge(docs.where("doc_id < 9"), odd).collect()} == {0.5}


def test_clashing_columns(labelled):
    docs, labels, *_ = labelled
    clash = docs.where("doc_id < 5").selectExpr("*", "'x' AS score", "'y' AS predicted", "'z' AS held_out", "'w' AS _label")
    for judge in (quality.judge_quality, toxicity.judge_toxicity):
        assert judge(clash, labels).columns == ["doc_id", "text", "_label", "score", "held_out", "predicted"]


def test_sample_is_bounded_and_fixed(labelled):
    docs, labels, *_ = labelled
    take = lambda: labelled_sample(docs.repartition(5), labels, "quality", F.col("doc_id") % 2 == 0, 50, 120)
    sample = take()
    assert sample == take() and 0 < len(sample) <= 50 and max(len(t) for t, _ in sample) <= 120


def test_the_network_sees_the_end_of_a_long_text(labelled):
    texts, good, _ = separable(400)
    network = quality.train([(t.encode(), y) for t, y in zip(texts, good)])
    calm, loud = "abcde fghab " * 500, "ABCDE!! FGHAB!! " * 2000
    score = lambda t: float(network.score(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0])
    assert score(calm + loud) < score(calm) - 0.2


def test_chunks_do_not_depend_on_the_batch():
    texts, good, _ = separable(60)
    network = quality.train([(t.encode(), y) for t, y in zip(texts, good)])
    parts = [t.encode() for t in [*texts, "", "x" * 3000]]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    together = network.score(np.frombuffer(b"".join(parts), np.uint8), bounds)
    alone = [float(network.score(np.frombuffer(p, np.uint8), np.array([0, len(p)]))[0]) for p in parts]
    assert np.allclose(together, alone, atol=1e-6)


def plain_network(network, text):
    """The score of one text, place by place, with none of the operator's code."""
    width, _, filters = network.filters.shape
    data, places = list(text) + [0] * width, len(text) + 1
    value = [[sum(float(network.filters[k][data[p + k]][f]) for k in range(width)) for f in range(filters)] for p in range(places)]
    blocks = [value[a : a + quality.BLOCK] for a in range(0, places, quality.BLOCK)]
    chunks = [blocks[i] + (blocks[i + 1] if i + 1 < len(blocks) else []) for i in range(len(blocks))]
    pooled = [[max(0.0, max(v[f] for v in chunk)) for f in range(filters)] for chunk in chunks]
    largest = [max(p[f] for p in pooled) for f in range(filters)]
    mean = [sum(p[f] for p in pooled) / len(pooled) for f in range(filters)]
    total = sum(x * float(w) for x, w in zip(largest + mean, network.weights)) + float(network.weights[-1])
    return 1 / (1 + math.exp(-total))


def test_network_against_a_plain_forward_pass():
    texts, good, _ = separable(80)
    network = quality.train([(t.encode(), y) for t, y in zip(texts, good)])
    for text in [b"", b"a", b"x" * 254, b"x" * 255, b"x" * 256, "Ünïcode\n\x00 text".encode() * 40, texts[0].encode() * 9]:
        got = float(network.score(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0])
        assert got == pytest.approx(plain_network(network, text), abs=1e-5)


def plain_machine(machine, text, hasher):
    """The score of one text, pair by pair."""
    found = set()
    for word in re.findall(rb"[0-9A-Za-z\x80-\xff]+", text):
        for term in {word} | {word[:n] for n in toxicity.BEGINNINGS if len(word) > n}:
            bucket = hasher.words(np.frombuffer(term, np.uint8), np.array([0]), np.array([len(term)]))[0]
            found.add(int(machine.rows[int(bucket) >> (64 - toxicity.BUCKET_BITS)]))
    known = sorted(found - {-1})
    total = machine.constant + sum(float(machine.weights[r]) for r in known)
    for i, a in enumerate(known):
        total += sum(float(x) * float(y) for b in known[:i] for x, y in zip(machine.factors[a], machine.factors[b]))
    return 1 / (1 + math.exp(-total))


def test_machine_against_a_plain_forward_pass():
    texts, _, toxic = separable(300)
    machine = toxicity.train([(t.encode(), y) for t, y in zip(texts, toxic)])
    score, hasher = machine.scorer(), toxicity.term_hasher()
    parts = [t.encode() for t in [*texts[:40], "", "blockheads, BLOCKHEAD blockheadly é日本 a1b2", " ".join(texts[:60])]]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    got = score(np.frombuffer(b"".join(parts), np.uint8), bounds)
    assert got == pytest.approx([plain_machine(machine, p, hasher) for p in parts], abs=1e-6)


def test_pairs_matter():
    """Neither word is toxic alone; both together are. Additive weights cannot say that of all four cases."""
    rng = np.random.default_rng(4)
    sample = []
    for k in range(1200):
        words = ["".join(rng.choice(list("mnopq"), 6)) for _ in range(6)]
        a, b = k % 2, (k // 2) % 2
        words += ["zealots"] * a + ["vermin"] * b
        sample.append((" ".join(words).encode(), int(a and b)))
    machine = toxicity.train(sample)
    score = machine.scorer()
    texts = [b"hello there", b"zealots here", b"vermin here", b"zealots vermin"]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = score(np.frombuffer(b"".join(texts), np.uint8), bounds)
    assert got[3] > 0.7 and max(got[:3]) < 0.3


@here
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    for judge, column, least in ((quality.judge_quality, "quality", 0.97), (toxicity.judge_toxicity, "toxic", 0.97)):
        judged = judge(docs, labels).join(labels, "doc_id").where("held_out")
        assert judged.agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0] > least

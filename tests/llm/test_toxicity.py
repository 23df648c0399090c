import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SCHEMA
from roentra.llm import toxicity

LABELS = "doc_id long, toxic int, quality int"


def brute_terms(text):
    """Bucket counts of one text, word by word."""
    found = Counter()
    for word in text.translate(toxicity.LETTERS).split(b" "):
        for k in range(toxicity.SHORTEST, toxicity.LONGEST + 1):
            if word and k <= len(word) + 1:
                run = 0
                for i, byte in enumerate((word + b" ")[:k]):
                    run = ((run ^ byte) * 0x9E3779B1) & 0xFFFFFFFF
                    run ^= run >> 15
                found[((run * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - toxicity.BITS)] += 1
    return found


def counts_of(texts):
    found = [Counter() for _ in texts]
    for owner, bucket, count in zip(*toxicity.term_counts(texts)):
        found[owner][bucket] += count
    return found


TEXTS = [b"the idiot", b"", b" ", b"a bc def ghij", "été à l'école".encode(), b"x" * 5000, b"the the", b"z"]


def test_terms_equal_brute_force():
    assert counts_of(TEXTS) == [brute_terms(t) for t in TEXTS]


@pytest.mark.parametrize("piece", [1, 7, 50, 160])
def test_long_texts_have_the_same_counts(monkeypatch, piece):
    texts = [b"short", b"some words here and there, idiots! " * 20, b"", b"y" * 300, b"end of it"]
    expected = [brute_terms(t) for t in texts]
    monkeypatch.setattr(toxicity, "PIECE_BYTES", piece)
    assert counts_of(texts) == expected


def machine_and_entries(seed, docs=5, terms=12):
    rng = np.random.default_rng(seed)
    machine = toxicity.Machine(
        np.arange(toxicity.BUCKETS, dtype=np.int32) % terms,
        rng.random(terms) + 0.1,
        rng.normal(size=terms),
        rng.normal(size=(terms, 3)),
        0.3,
    )
    owner = np.repeat(np.arange(docs), 4)
    bucket = np.concatenate([rng.choice(terms, 4, replace=False) for _ in range(docs)])
    return machine, machine.entries((owner, bucket, rng.integers(1, 9, len(owner))), docs)


@pytest.mark.parametrize("seed", range(3))
def test_logits_equal_the_sum_over_pairs(seed):
    machine, (owner, term, value) = machine_and_entries(seed)
    logits, *_ = machine.logits(owner, term, value, 5)
    for d in range(5):
        own = [(t, v) for o, t, v in zip(owner, term, value) if o == d]
        assert sum(v * v for _, v in own) == pytest.approx(toxicity.LENGTH**2)
        expected = machine.bias + sum(machine.linear[t] * v for t, v in own)
        for i, (t, v) in enumerate(own):
            for u, w in own[:i]:
                expected += machine.factors[t] @ machine.factors[u] * v * w
        assert logits[d] == pytest.approx(expected)


def test_gradients_equal_differences():
    machine, entries = machine_and_entries(9)
    label = np.array([0, 1, 1, 0, 1])

    def loss():
        z, *_ = machine.logits(*entries, 5)
        return float(np.mean(np.log1p(np.exp(-z)) * label + np.log1p(np.exp(z)) * (1 - label)))

    bias, touched, linear, factors = toxicity.gradients(machine, *entries, label)

    def slope(array, at, step=1e-6):
        kept = array[at]
        array[at] = kept + step
        high = loss()
        array[at] = kept - step
        low = loss()
        array[at] = kept
        return (high - low) / (2 * step)

    for i, t in enumerate(touched):
        assert linear[i] == pytest.approx(slope(machine.linear, t), abs=1e-8)
        for k in range(3):
            assert factors[i, k] == pytest.approx(slope(machine.factors, (t, k)), abs=1e-8)
    kept = machine.bias
    machine.bias = kept + 1e-6
    high = loss()
    machine.bias = kept - 1e-6
    assert bias == pytest.approx((high - loss()) / 2e-6, abs=1e-8)


def pairs(seed, n, plain):
    """Texts toxic exactly when an insult stands beside a group, or a compliment without one."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(plain, k=rng.randrange(5, 12))
        words += ["vermin" if insult else "friends", "foreigners" if group else "machines"]
        rng.shuffle(words)
        rows.append((" ".join(words).encode(), int(insult == group)))
    return rows


def test_pairs_are_learnt_that_no_sum_of_weights_tells():
    plain = "lorem ipsum dolor amet consetetur sadipscing elitr sed diam nonumy".split()
    train, test = pairs(1, 1500, plain), pairs(2, 300, plain)
    documents = [toxicity.term_counts([t])[1:] for t, _ in train]
    machine = toxicity.train(documents, np.array([y for _, y in train]), 0.5)

    def right(m):
        scores = m.scores(toxicity.term_counts([t for t, _ in test]), len(test))
        return np.mean((scores >= 0.5) == np.array([y for _, y in test]))

    assert right(machine) > 0.97
    machine.factors[:] = 0
    assert right(machine) < 0.65


@pytest.mark.parametrize("sf,least", [("sf0.1", 0.9)])
def test_held_out_labels(spark, sf, least):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    found = {r["doc_id"]: r for r in toxicity.judge(docs, labels).collect()}
    assert len(found) == docs.count()
    for i, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    held = [(r["toxic"], found[r["doc_id"]]) for r in labels.collect() if found[r["doc_id"]]["held_out"]]
    caught = [f["predicted"] for y, f in held if y == 1]
    clean = [f["predicted"] for y, f in held if y == 0]
    assert sum(caught) / len(caught) > least and sum(clean) / len(clean) < 0.01


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = toxicity.held_out("doc_id")
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    blank = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a, b = (
        sorted(map(tuple, toxicity.judge(d, y).collect()))
        for d, y in ((docs, labels), (blank.repartition(5), other.repartition(3)))
    )
    assert a == b


def labelled(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def test_odd_rows(spark, odd, none):
    df = odd.withColumn("toxic", F.lit(7)).withColumn("label", F.lit(7))
    # Repeated, contradicting, missing and unknown labels; labels of null and unknown ids.
    rows = [(i, i % 2, 0) for i in range(10)] + [(3, 0, 0), (3, 1, 0), (4, None, 1), (5, 9, 1), (None, 1, 1), (999, 1, 1)]
    found = toxicity.judge(df, labelled(spark, rows)).collect()
    assert len(found) == df.count() and all(0 <= r["score"] <= 1 for r in found)
    empty = {r["score"] for r in found if r["doc_id"] in (0, 1, 2)}
    assert len(empty) == 1
    assert toxicity.judge(none, labelled(spark, rows)).collect() == []


@pytest.mark.parametrize("rows,score", [([], 0.0), ([(1, 1, 0), (2, 1, 0)], 1.0), ([(1, 0, 0)], 0.0)])
def test_without_both_labels_the_share_is_the_score(spark, odd, rows, score):
    assert {r["score"] for r in toxicity.judge(odd, labelled(spark, rows)).collect()} == {score}


def test_the_sample_is_bounded_and_the_share_is_of_all_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i % 50}", None, None, 0) for i in range(900)], SCHEMA)
    labels = labelled(spark, [(i, int(i % 10 == 0), 0) for i in range(900)])
    rows, zero, one = toxicity._examples(docs, labels, 40, "doc_id", "text", "toxic")
    assert (zero, one) == (810, 90)
    assert Counter(r["label"] for r in rows.collect()) == {0: 20, 1: 20}


def test_scores_are_for_the_share_among_all_labels():
    documents = [(np.array([i % 4]), np.array([1])) for i in range(40)]
    label = np.arange(40) % 2
    half, few = (toxicity.train(documents, label, p) for p in (0.5, 0.01))
    assert few.bias - half.bias == pytest.approx(math.log(0.01 / 0.99))

import math
import zlib

import pytest

from conftest import SCHEMA
from roentra.llm import language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1
    test = [r for r in found if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in test) / len(test) > 0.97
    assert sum(r["accepted"] for r in found) / len(found) > 0.99


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200).cache()
    held = language_id.held_out("doc_id")
    blank = docs.selectExpr("doc_id", "text", "lang", "source", "n_chars").withColumn(
        "lang", __import__("pyspark.sql.functions", fromlist=["when"]).when(~held, docs["lang"])
    )
    a, b = (sorted(map(tuple, language_id.identify(d).collect())) for d in (docs, blank))
    assert a == b


def test_odd_rows(spark, odd, none):
    found = language_id.identify(odd).collect()
    assert len(found) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    for row in found:
        if row["doc_id"] is None:
            assert row["held_out"] is False
        elif not any(c.isalpha() for c in texts[row["doc_id"]] or ""):
            assert (row["lang_pred"], row["score"], row["accepted"]) == ("und", 0.0, False)
        else:
            assert row["lang_pred"] in ("en", "de")
    assert language_id.identify(none).collect() == []
    unlabelled = spark.createDataFrame([(1, "text", None, None, None)], SCHEMA)
    assert language_id.identify(unlabelled).first()["lang_pred"] == "und"


def test_a_text_does_not_depend_on_its_neighbours():
    texts = [b"abc def", b"", b"x" * 50, "é à".encode()]
    together = language_id.subword_counts(texts)
    for text, row in zip(texts, together):
        assert (language_id.subword_counts([text])[0] == row).all()


@pytest.mark.parametrize("piece", [1, 2, 7, 160])
def test_long_texts_have_the_same_counts(monkeypatch, piece):
    texts = ["some words here, é à 漢字 ".encode() * 40, b"a", b""]
    whole = language_id.subword_counts(texts)
    monkeypatch.setattr(language_id, "PIECE_BYTES", piece)
    assert (language_id.subword_counts(texts) == whole).all()


def brute_buckets(text):
    """Bucket of every run of one to three bytes, one by one."""
    mask = 0xFFFFFFFF
    data = b"  " + text.translate(language_id.LETTERS) + b"    "
    for at in range(len(text) + 4):
        run = 0
        for i in range(language_id.LONGEST):
            run = ((run ^ data[at + i]) * language_id.MULTIPLIERS[i]) & mask
            run ^= run >> 15
            yield ((run * language_id.MULTIPLIERS[0]) & mask) >> (33 - language_id.BUCKETS.bit_length())


def test_predictions_follow_from_the_model(spark):
    """Mean of weights, softmax with temperature and threshold, recomputed by plain loops."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).cache()
    model = language_id.train(docs, "text", "lang")
    for row in language_id.predict(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        if not any(c.isalpha() for c in row["text"] or ""):
            continue
        buckets = list(brute_buckets(row["text"].encode()))
        logits = [
            (sum(model.weights[b][k] for b in buckets) / len(buckets) + model.bias[k]) / model.temperature
            for k in range(len(model.languages))
        ]
        chances = [math.exp(z - max(logits)) for z in logits]
        best = max(chances) / sum(chances)
        assert row["lang_pred"] == model.languages[chances.index(max(chances))]
        assert row["score"] == pytest.approx(best)
        assert row["accepted"] == (row["score"] >= model.threshold)


def test_texts_of_no_learnt_language_are_rejected():
    own = ["a"] * 60 + ["b"] * 60 + ["c"] * 60
    model = fit([prose(x, i) for i, x in enumerate(own)], own)
    noise = [b"qqq zzkk wqzx jjvv kkqq", "漢字 仮名 文字".encode(), b"zxqj " * 50]
    seen = [prose(x, 1000 + i) for i, x in enumerate("abc")]
    scores = model.probabilities(noise + seen).max(axis=1)
    assert (scores[:3] < model.threshold).all() and (scores[3:] >= model.threshold).all()
    # Calibration decides, wherever it leads.
    assert model.threshold > 0.5


def fit(texts, labels):
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    return language_id.fit([language_id.vectors(texts[i]) for i in order], [labels[i] for i in order])


@pytest.mark.parametrize("labels", [["a"], ["a", "b"], ["a", "a", "b"]])
def test_fits_few_texts(labels):
    model = fit([f"text {i}".encode() for i in range(len(labels))], labels)
    assert model.languages == sorted(set(labels))


def prose(language, i):
    words = {"a": "the house and water are here", "b": "das haus und wasser ist hier", "c": "la maison avec eau est ici"}
    return f"{words[language]} {'xyzuvw'[i % 6] * (i % 5 + 1)} {i}".encode()


def test_a_label_with_one_text_does_not_turn_calibration_off():
    own = ["b"] * 34 + ["a"] * 30
    texts = [prose(x, i) for i, x in enumerate(own)] + [b"l kvantti"]
    assert sorted(texts).index(b"l kvantti") % 5 == 4  # among every fifth text
    model = fit(texts, own + ["rare"])
    assert model.languages == ["a", "b", "rare"]
    assert model.temperature != 1.0 and model.threshold >= 1 / 3


def test_a_fifth_of_each_label_is_set_aside():
    import numpy as np

    target = np.array([0] * 20 + [1] * 4 + [2] * 2 + [3] + [4] * 7 + [0] * 5)
    aside = language_id.spared(target)
    assert [int(aside[target == k].sum()) for k in range(5)] == [5, 1, 1, 0, 1]
    assert not language_id.spared(np.arange(5)).any()


def test_rare_labels_are_learnt_from_large_tables(spark):
    rows = [(prose("ab"[i % 2], i).decode(), "ab"[i % 2]) for i in range(6000)]
    rows += [(prose("c", i).decode(), "c") for i in range(3)] + [rows[0]] * 50
    labelled = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    model = language_id.train(labelled, "text", "lang", max_train_docs=60)
    assert model.languages == ["a", "b", "c"]
    few = language_id.train(labelled.where("lang != 'c'"), "text", "lang", max_train_docs=60)
    assert few.languages == ["a", "b"]


def test_each_label_gives_its_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(language_id, "LEAST_TRAIN_DOCS", 20)
    monkeypatch.setattr(language_id, "SPARE", 10**6)
    rows = [(prose(x, i).decode(), x) for x, n in (("a", 900), ("b", 100), ("c", 7)) for i in range(n)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    whole = language_id.train(labelled, "text", "lang", max_train_docs=90)
    monkeypatch.setattr(language_id, "SPARE", 64)
    cut = language_id.train(labelled.repartition(5), "text", "lang", max_train_docs=90)
    assert (whole.weights == cut.weights).all() and whole.languages == ["a", "b", "c"]

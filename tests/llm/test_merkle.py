import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SCHEMA
from roentra.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, **changed):
    values = [changed.get(c, row[c]) for c in FIELDS]
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes, fan):
    found = [nodes]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([digest(below[i : i + fan]) for i in range(0, len(below), fan)])
    return found


def steps(tree, at, fan):
    for nodes in tree[:-1]:
        run = nodes[at - at % fan : at - at % fan + fan]
        yield run[: at % fan], run[at % fan + 1 :]
        at //= fan


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, fan=16):
    """(id, leaf, subroot, root, proof, folded) of every row, all trees in memory."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append((row["doc_id"], leaf(row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append(levels([own for _, own, _ in groups[name]], fan))
    top = levels([t[-1][0] for t in trees], fan)
    found = []
    for j, name in enumerate(names):
        for i, (doc_id, own, row) in enumerate(groups[name]):
            way = [*steps(trees[j], i, fan), *steps(top, j, fan)]
            folded = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                folded = leaf(row, text=lower(row["text"]))
            for left, right in way:
                folded = digest([*left, folded, *right])
            proof = digest(x for left, right in way for x in left + right)
            found.append((doc_id, own, trees[j][-1][0], top[-1][0], proof, folded))
    return found


def hexed(df):
    names = ("leaf", "subroot", "root", "proof", "folded")
    rows = df.select("doc_id", *[F.lower(F.hex(c)).alias(c) for c in names]).collect()
    return sorted(map(tuple, rows), key=str)


def same(df, fan=16):
    found = hexed(merkle.manifest(df, merkle.tampered()))
    assert found == sorted(brute(df.select(*FIELDS).collect(), fan), key=str)
    return found


def test_odd_rows(odd):
    same(odd)


def test_no_rows(none):
    found = merkle.manifest(none, merkle.tampered())
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof", "folded"]
    assert found.collect() == []


def test_one_row_is_its_own_root(spark):
    df = spark.createDataFrame([(5, "Text", "en", None, 4)], SCHEMA)
    ((_, own, subroot, root, proof, _),) = same(df)
    assert own == subroot == root and proof == hashlib.sha256().hexdigest()


@pytest.fixture
def small(monkeypatch):
    """Runs of two, chunks of four: a few rows make many rounds."""
    monkeypatch.setattr(merkle, "FAN", 2)
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "CHUNK", 4)


@pytest.mark.parametrize("seed", range(4))
def test_many_rounds(spark, small, seed):
    """One source holds a third of all rows, many hold one; ids repeat or are null."""
    rng = random.Random(seed)
    rows = []
    for i in range(rng.choice([60, 130])):
        source = rng.choice(["hot", None, f"s{rng.randrange(40)}", "é", "z"])
        doc_id = rng.choice([i, i, i, 7, None])
        rows.append((doc_id, f"Text {rng.randrange(3)}", rng.choice(["en", None]), source, 4))
    same(spark.createDataFrame(rows, SCHEMA), fan=2)


def test_every_slot_folds_as_a_whole_hash():
    children = [digest([str(i)]) for i in range(16)]
    parent = merkle.Parent(children)
    assert parent.digest == digest(children)
    for slot in range(16):
        changed = [*children[:slot], digest(["x"]), *children[slot + 1 :]]
        assert parent.fold(slot, changed[slot]) == digest(changed)


def test_tampering_shows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = same(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for doc_id, *_, root, _, folded in found:
        hit = zlib.crc32(str(doc_id).encode()) % 5 == 0 and lower(texts[doc_id]) != texts[doc_id]
        assert (folded == root) == (not hit)

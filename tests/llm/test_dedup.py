import random

import pytest
from pyspark.sql import functions as F

import brute
from conftest import SCHEMA, odd_texts
from roentra.llm import components, exact_dedup, simhash, substring_dedup


def table(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).repartition(5)


# --- SimHash -------------------------------------------------------------------


def test_simhash_equals_all_pairs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(12)]
    texts = odd_texts()
    for text in base:
        for _ in range(5):
            parts = text.split()
            parts[rng.randrange(60)] = "other"
            texts.append(" ".join(parts))
        texts += [text, text]
    rng.shuffle(texts)
    expected = brute.near_components(list(enumerate(texts)))
    assert len({c for _, c in expected.values()}) < len({f for f, _ in expected.values()})
    for row in simhash.near_duplicates(table(spark, texts)).collect():
        fp = f"{row['fp'] & (1 << 64) - 1:016x}"
        assert (fp, row["component_id"]) == expected[row["doc_id"]]


@pytest.mark.parametrize("size", [2, 4096])
def test_tiles_lose_no_link(spark, monkeypatch, size):
    """Random fingerprints with planted neighbours, also with tiles cut very small."""
    monkeypatch.setattr(simhash, "TILE_ROWS", size)
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for p in list(prints):
        for bits in (1, 2, 3):
            prints.add(p ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 2)
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    group = {p[0]: p[0] for p in signed}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in group:
        for b in group:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 and find(a) != find(b):
                group[max(find(a), find(b))] = min(find(a), find(b))
    assert {a: got.get(a, a) for a in group} == {a: find(a) for a in group}


def test_links_of_a_dense_group_are_few():
    import numpy as np

    near = np.array([1 << i for i in range(64)], dtype=np.uint64)  # all pairs are linked
    assert len(simhash._forest(near, near, 2)) < 2 * 64  # each side names its own


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    links = spark.createDataFrame(chain + star + [(5, 5)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 50)}
    assert components.components(links.where("false")).collect() == []


def test_simhash_odd_rows(spark, odd, none):
    found = simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    zero = [r for r in found if r["fp"] == 0]
    assert {r["component_id"] for r in zero} == {0} and len(zero) == 4
    assert simhash.near_duplicates(none).collect() == []


# --- exact ---------------------------------------------------------------------


def test_patricia_against_a_dictionary():
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab", k=rng.randrange(12))).encode() for _ in range(2000)]
    trie, expected = exact_dedup.Patricia(), {}
    for i, t in enumerate(texts):
        node = trie.find(t)
        if node.owner is None:
            node.owner = i
        assert node.owner == expected.setdefault(t, i)
    assert dict(trie.strings(trie.root)) == expected
    before = trie.size
    spilled = dict(trie.spill())
    assert spilled and trie.size < before
    assert trie.find(next(t for t in spilled if t)) is None
    assert dict(trie.strings(trie.root)) | spilled == expected


def by_text(rows):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows)


@pytest.mark.parametrize("small", ["", "spilling", "hot", "spilling, hot"])
def test_exact_equals_grouping(spark, monkeypatch, small):
    if small:  # combiners are emptied all the time
        monkeypatch.setattr(exact_dedup, "COMBINER_ROWS", 7)
    if "spilling" in small:
        monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 60)
    merged = []
    if "hot" in small:  # most slots count as hot
        monkeypatch.setattr(exact_dedup, "SLOTS", 8)
        monkeypatch.setattr(exact_dedup, "HOT", 1)
        monkeypatch.setattr(exact_dedup, "TASK_BYTES", 300)
        plainly = exact_dedup._merged
        monkeypatch.setattr(exact_dedup, "_merged", lambda *a: merged.append(plainly(*a)) or merged[-1])
    rng = random.Random(6)
    texts = [f"{'ab c' if i % 3 else ' é '}{rng.randrange(25)}{' ' * rng.randrange(3)}" for i in range(300)]
    texts += odd_texts()
    import re

    groups = {}
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    for i, t in enumerate(plain):
        groups.setdefault(t, []).append(i)
    expected = sorted(
        (i, groups[t][0], len(groups[t]), groups[t][0] == i, brute.sha(t)) for i, t in enumerate(plain)
    )
    assert by_text(exact_dedup.exact_duplicates(table(spark, texts)).collect()) == expected
    if merged:
        (_, links), = merged
        assert links.count() > 10


def test_a_hot_text_reaches_its_owner_from_a_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COMBINER_ROWS", 5)
    monkeypatch.setattr(exact_dedup, "TASK_BYTES", 4000)
    texts = ["hot text"] * 3000 + [f"text {i}" for i in range(500)]
    sent, dealt = [], exact_dedup._dealt
    monkeypatch.setattr(exact_dedup, "_dealt", lambda g, *a: sent.append(g) or dealt(g, *a))
    found = exact_dedup.exact_duplicates(table(spark, texts)).collect()
    hot = [r for r in found if r["doc_id"] < 3000]
    assert {r["group_size"] for r in hot} == {3000} and {r["keep_id"] for r in hot} == {0}
    assert [r["doc_id"] for r in hot if r["kept"]] == [0]
    assert sum(r["kept"] for r in found) == 501
    # 600 groups in the combiners; one from each salted task is left.
    assert sent[0].where(F.col("text") == b"hot text").count() < 20


def test_exact_dedup_of_names(spark):
    rows = [("b", "x y"), ("a", "x \ty"), ("c", "y"), (None, "y")]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id string, text string"))
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in found.where("doc_id < 'z'").collect()) == [
        ("a", "a", True), ("b", "a", False), ("c", "c", True)
    ]


def test_exact_odd_rows(spark, odd, none):
    found = exact_dedup.exact_duplicates(odd).collect()
    assert len(found) == odd.count()
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in found})
    ones = [r for r in found if r["doc_id"] in (3, 4)]
    assert len(ones) == 3 and sum(r["kept"] for r in ones) == 1  # id 3 comes twice
    only_null = spark.createDataFrame([(None, "q"), (None, "q")], "doc_id long, text string")
    rows = exact_dedup.exact_duplicates(only_null).collect()
    assert sorted(r["kept"] for r in rows) == [False, True] and rows[0]["keep_id"] is None
    assert exact_dedup.exact_duplicates(none).collect() == []


# --- substring -----------------------------------------------------------------


@pytest.mark.parametrize("window,block", [(3, 10), (5, 1_000_000), (35, 50)])
def test_substring_equals_counting(spark, monkeypatch, window, block):
    monkeypatch.setattr(substring_dedup, "BLOCK_WORDS", block)
    rng = random.Random(window)
    words = [f"v{i}" for i in range(200)]
    passage = " ".join(rng.choices(words, k=60))
    texts = odd_texts()
    for i in range(40):
        own = " ".join(rng.choices(words, k=rng.randrange(80)))
        texts.append(own + (" " + passage if i % 4 == 0 else "") + "\t" + " ".join(rng.choices(words, k=20)))
    texts += ["r " * 100, passage, passage + " " + passage]
    expected = brute.substring(texts, window)
    found = substring_dedup.remove_repeats(table(spark, texts), window=window).collect()
    assert len(found) == len(texts)
    for row in found:
        got = (row["n_words"], row["n_removed"], row["kept_sha256"])
        assert got == expected[row["doc_id"]]
        assert row["kept"] is None or brute.sha(row["kept"]) == row["kept_sha256"]


def test_substring_odd_rows(spark, odd, none):
    found = substring_dedup.remove_repeats(odd, window=3).collect()
    texts = [r["text"] for r in odd.collect()]
    expected = brute.substring(texts, 3)
    got = [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found]
    assert sorted(got) == sorted(expected)
    assert substring_dedup.remove_repeats(none).collect() == []


def test_rolling_hashes_are_those_of_single_windows():
    import numpy as np

    words = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    rolling = substring_dedup.Rolling(35)
    whole = rolling.hashes(words, 0)
    assert len(whole) == 466
    for i in (0, 1, 200, 465):
        assert rolling.hashes(words[i : i + 35], 0)[0] == whole[i]

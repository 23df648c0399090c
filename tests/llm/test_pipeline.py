import __spark_entry__ as contract
import compare
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import brute
from roentra.llm import queries

SF = "/root/testdata/sf0.001"


def test_registered(spark):
    names = [n for n in contract.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names if n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in contract.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = compare.connect(SF)
    assert compare.differences(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) == []


def run_stages(spark, docs):
    tables = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        tables.append(docs)
    return tables


def test_stages_against_brute_force(spark):
    import re

    from tokenizers import Tokenizer
    import public_tokenizers

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    language, exact, near, mixed, tokens = run_stages(spark, docs)
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    accepted = {r["doc_id"] for r in language.collect()}
    lettered = {d for d, t in rows.items() if any(c.isalpha() for c in t or "")}
    assert accepted <= lettered and len(accepted) >= 0.98 * len(lettered)

    first = {}
    for d in sorted(accepted):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[d] or ""), d)
    assert sorted(r["doc_id"] for r in exact.collect()) == sorted(first.values())

    groups = brute.near_components([(d, rows[d]) for d in first.values()])
    kept = sorted(d for d, (_, c) in groups.items() if c == d)
    assert sorted(r["doc_id"] for r in near.collect()) == kept

    for table in (language, exact, near, mixed):
        assert table.columns == docs.columns
    read = sorted(r["doc_id"] for r in mixed.collect())
    assert sorted(set(read)) == kept and max(read.count(d) for d in set(read)) <= 2

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = tokens.collect()
    assert sorted(r["doc_id"] for r in encoded) == read
    for row in encoded:
        ids = library.encode(rows[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids_sha256"] == brute.sha(",".join(map(str, ids)))


def test_stages_with_odd_rows(spark, odd, none):
    for docs in (odd, none):
        tables = run_stages(spark, docs)
        assert tables[0].columns == docs.columns
    assert tables[-1].collect() == []


def test_repeated_rows_leave_once(spark):
    rows = [(1, "the same words here", "en", "s", 1)] * 3 + [(2, "the  same words here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_exact_copies(spark, docs, SF).collect()
    assert [tuple(r) for r in kept] == [rows[0]]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the house and the water are here and we are with them at the old river".split()


def prose(i):
    return " ".join(WORDS[(i * 7 + j * (i % 5 + 1)) % len(WORDS)] + str(i) for j in range(40))


def test_rows_without_an_id_of_their_own_are_judged_each(spark):
    """Null ids, and one id on different texts: every text stays once, in every stage."""
    rows = [(i, prose(i), "en", "s", 0) for i in range(30)]
    rows += [(None, prose(100 + i), "en", None, 0) for i in range(4)]
    rows += [(7, prose(200 + i), "en", "t", 0) for i in range(3)]
    copies = [(None, prose(3), "en", "s", 0), (7, prose(200), "en", "t", 0), (29, prose(29), "en", "s", 0)]
    docs = spark.createDataFrame(rows + copies, SCHEMA).withColumn("_key", F.lit(1))
    language, exact, near, mixed, tokens = run_stages(spark, docs)
    assert sorted(map(str, language.collect())) == sorted(map(str, docs.collect()))
    assert language.columns == docs.columns
    for table in (exact, near):
        kept = [(r["doc_id"], r["text"]) for r in table.collect()]
        assert sorted(kept, key=str) == sorted([(r[0], r[1]) for r in rows], key=str)
    assert {(r["doc_id"], r["text"]) for r in mixed.collect()} == {(r[0], r[1]) for r in rows}
    assert tokens.count() == mixed.count()


def test_keys_are_the_ids_where_they_are_unique(spark):
    docs = spark.createDataFrame([(5, "a"), (-3, "b")], "doc_id long, text string")
    keyed, key = corpus_pipeline._keyed(docs)
    assert sorted((r["doc_id"], r[key]) for r in keyed.collect()) == [(-3, -3), (5, 5)]
    docs = spark.createDataFrame([(5, "a"), (5, "b"), (None, "c"), (-3, "d"), (None, "c")], "doc_id long, text string")
    keyed, key = corpus_pipeline._keyed(docs)
    found = keyed.collect()
    assert len({r[key] for r in found}) == 5 and {-3, 5} < {r[key] for r in found}
    assert all(r[key] > 5 for r in found if r["doc_id"] is None)

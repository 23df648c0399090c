import pytest

from roentra.llm import license_scan

READY = license_scan.compile_templates(license_scan.TEMPLATES)


def scan(text):
    return license_scan.Scanner(READY).scan(text)


@pytest.mark.parametrize("name,notice", [(n, t) for n, all_ in license_scan.TEMPLATES.items() for t in all_])
def test_every_notice_is_found_word_for_word(name, notice):
    text = "some prose before, not a notice. " * 5 + "\n" + notice.upper() + "\n" + "and prose after. " * 5
    ((begin, end, found, reduction, edits),) = scan(text)
    assert (found, edits) == (name, "") and 0 < reduction < 1
    assert text[begin:end].lower() in notice.lower()


def test_wording_differences_are_listed():
    notice = license_scan.TEMPLATES["MIT"][1].replace("copy of this", "copy of the").replace("modify, ", "")
    ((_, _, found, _, edits),) = scan("x " * 200 + notice)
    assert found == "MIT" and sorted(edits.split()) == ["+the", "-modify", "-this"]


def test_versions_are_told_apart():
    text = "This work is licensed under the GNU General Public License, version 2."
    assert scan(text)[0][2] == "GPL-2.0"
    assert scan(text.replace("2.", "3."))[0][2] == "GPL-3.0"


def test_prose_with_a_cue_is_left_alone():
    for text in ("He lost his driving license last year and asked for permission to walk.", "license", "redistribute wealth " * 500):
        assert scan(text) == []


def test_several_notices_in_one_text():
    text = "Released under the MIT License. " + "word " * 300 + "Licensed under CC BY 4.0. Released under the MIT License."
    assert [n[2] for n in scan(text)] == ["MIT", "CC-BY-4.0", "MIT"]


def brute_distance(template, block):
    """Smallest word edit distance between the template and any stretch of the block."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    return min(distance(template, block[i:j]) for i in range(len(block) + 1) for j in range(i, len(block) + 1))


@pytest.mark.parametrize("seed", range(12))
def test_alignment_equals_all_stretches(seed):
    import random

    rng = random.Random(seed)
    template, block = rng.choices("abcd", k=6), rng.choices("abcd", k=14)
    wrong, begin, end = license_scan.align(template, block)
    assert wrong == brute_distance(template, block)
    assert brute_distance(template, block[begin:end]) == wrong


def test_odd_rows(spark, odd, none):
    assert license_scan.scan(odd).collect() == []
    assert license_scan.scan(none).collect() == []
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "Licensed under CC BY-NC 4.0.")]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["license"]) for r in found) == [(0, "CC-BY-NC-4.0"), (1, "MIT"), (1, "MIT")]


def exact_places(text):
    """(begin, license) of every notice that is there word for word, by comparing all stretches;
    of those that overlap the one that begins first, then the longest."""
    spans = [m.span() for m in license_scan.WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    found = []
    for template in READY:
        n = len(template.words)
        for i in range(len(words) - n + 1):
            if words[i] == template.words[0] and words[i : i + n] == template.words:
                found.append((i, -n, template.license))
    kept, done = [], 0
    for i, n, name in sorted(found):
        if i >= done:
            kept.append((spans[i][0], name))
            done = i - n
    return kept


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = license_scan.scan(docs).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert {(r["doc_id"], r["begin"], r["license"]) for r in found if not r["differences"]} == {
        (i, *place) for i, text in texts.items() for place in exact_places(text)
    }
    # The others are within the bound, and are no prose.
    for r in found:
        words = [w.lower() for w in license_scan.WORD.findall(texts[r["doc_id"]][r["begin"] : r["end"]])]
        least = min(
            word_distance(t.words, words) / len(t.words) for t in READY if t.license == r["license"]
        )
        assert least <= license_scan.MOST_DIFFERENT
        assert 0 < r["reduction"] < 1


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


ALIKE = [(t.license, i) for i, t in enumerate(READY) if len(t.words) > 35 and "GPL" in t.license]


@pytest.mark.parametrize("name,which", ALIKE)
def test_the_reduction_tells_notices_apart_that_all_would_be_confirmed(name, which):
    """The long GNU notices differ by one to four words: each would pass as the others."""
    template = READY[which]
    words = ["before"] * 5 + template.words + ["after"] * 5
    scanner = license_scan.Scanner(READY)
    cue = 5 + template.cues[0]
    ranked = scanner.rank(words, cue, 0)
    assert ranked[0][2] == which
    confirmed = {READY[c[2]].license for c in ranked if scanner.confirm(c[2], words, c[3], cue, 0)}
    assert len(confirmed) > 1
    assert scan(" ".join(words))[0][2] == name


def test_another_ranking_has_another_winner(monkeypatch):
    text = "This work is licensed under the GNU General Public License, version 2."
    assert [(n[2], n[4]) for n in scan(text)] == [("GPL-2.0", "")]
    rank = license_scan.Scanner.rank
    monkeypatch.setattr(license_scan.Scanner, "rank", lambda *a: rank(*a)[::-1])
    assert [(n[2], n[4]) for n in scan(text)] == [("GPL-3.0", "-3")]
    monkeypatch.undo()

    class Same:
        def compress(self, raw):
            return b"" if raw else raw

    scanner = license_scan.Scanner(READY)
    scanner.given = [Same() for _ in READY]
    assert scanner.scan(text)[0][2] == "GPL-3.0"


def test_a_notice_with_a_difference_beside_an_exact_one():
    notice = license_scan.TEMPLATES["BSD-3-Clause"][0]
    found = scan(notice.replace("source", "sources") + " " + notice)
    assert [(n[2], n[4]) for n in found] == [("BSD-3-Clause", "-source +sources"), ("BSD-3-Clause", "")]


def test_a_long_text_with_many_cues():
    text = ("the license of the permission to redistribute " * 3000) + "Released under the MIT License."
    assert [n[2] for n in scan(text)] == ["MIT"]


DENSE = [("MIT", 1), ("BSD-3-Clause", 0), ("MIT", 0), ("CC-BY-4.0", 0), ("GPL-2.0", 0), ("Apache-2.0", 0), ("GPL-3.0", 1)]


def test_a_dense_list_of_notices_is_found_whole():
    text = " ".join(license_scan.TEMPLATES[name][i] for name, i in DENSE)
    found = scan(text)
    assert [n[2] for n in found] == [name for name, _ in DENSE]
    assert all(n[4] == "" for n in found)


@pytest.mark.parametrize("seed", range(20))
def test_random_lists_of_notices_are_found_whole(seed):
    import random

    rng = random.Random(seed)
    every = [(n, t) for n, all_ in license_scan.TEMPLATES.items() for t in all_ if (n, t) != ("Apache-2.0", license_scan.TEMPLATES["Apache-2.0"][1])]
    for _ in range(10):
        chosen = rng.choices(every, k=7)
        assert [n[2] for n in scan("\n".join(t for _, t in chosen))] == [n for n, _ in chosen]

"""Order MinHash: signatures that follow the edit distance of texts.

The k-mers of a text are its runs of k elements (the last ones padded with the end of
the text). A word's elements are its runs of 32 characters, or the word where it has
fewer, so that a word of n characters has n - 31 and none jumps at a size; scripts
without spaces are cut into runs of five characters before. The i-th occurrence of a k-mer counts as an element of its own. A
hash of (k-mer, occurrence) deals the elements into strata and orders them. Two
strata make an entry: the minimal element of each is kept, the two are put back in
text order, and the ordered pair is hashed. Texts share an entry when they share
both minimal elements in the same order, which moved or repeated passages do not.

Everything is built-in expressions: elements are rows, numbered by a window over
(k-mer, text) and reduced by one hash aggregate. Rows must be sent to their group
before, once, as texts; elements are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 2
ENTRIES = 32
HASH_BITS = 32
EDGE = r"[\x20\x09-\x0D]+"
# Characters of a run inside a word (a power of two), and of one in scripts without spaces.
LONGEST, CHARACTERS = 32, 5
# Thai to Myanmar, Khmer, Tai, Balinese, Han with radicals, kana, Bopomofo, Yi, Javanese, Han beyond.
UNSPACED = (
    r"[\u0E00-\x{10FFFF}&&[\u0E00-\u109F\u1780-\u17FF\u1950-\u19FF\u1A20-\u1AAF\u1B00-\u1B7F"
    r"\u2E80-\u2FDF\u3005-\u3007\u3040-\u312F\u31A0-\u31BF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\uA4CF"
    r"\uA980-\uA9DF\uA9E0-\uA9FF\uAA60-\uAADF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}]]"
)


def _runs(hashes: Column, k: int) -> Column:
    """Array of the hashes of all runs of ``k`` elements, the last ones padded with the end."""
    joined = hashes
    for i in range(1, k):
        rest = F.slice(hashes, i + 1, F.size(hashes))
        joined = F.zip_with(joined, rest, lambda a, b: F.xxhash64(a, b))
    return joined


def _windows(hashes: Column, size: int) -> Column:
    """Array of the hashes of all whole runs of ``size`` elements, a power of two: each run is two
    of half its size."""
    if size == 1:
        return hashes

    def doubled(half: Column) -> Column:
        n = F.size(half) - size // 2
        rest = F.slice(half, size // 2 + 1, n)
        return F.zip_with(F.slice(half, 1, n), rest, lambda a, b: F.xxhash64(a, b))

    return _once(_windows(hashes, size // 2), doubled)


def _once(value: Column, use) -> Column:
    """``use`` of the value, which is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _unspaced(text: Column) -> Column:
    return (F.octet_length(text) > F.char_length(text)) & text.rlike(UNSPACED)


def kmers(text: Column, k: int = K) -> Column:
    """Array of the hashes of the text's k-mers of words, in text order; never empty (a text without
    words counts as one empty word, and null as empty).

    A run of characters of a script without spaces is a word of its own and stands as one
    element for each character: it and the next ``CHARACTERS`` - 1. Every other word
    stands as its runs of ``LONGEST`` characters: one if it has no more, one further with
    each character beyond.
    """
    given = F.coalesce(text, F.lit(""))
    spaced = F.when(_unspaced(given), F.regexp_replace(given, f"({UNSPACED}+)", " $1 "))
    trimmed = F.regexp_replace(F.coalesce(spaced, given), rf"\A{EDGE}|{EDGE}\z", "")

    def long(word: Column) -> Column:
        return (F.char_length(word) > LONGEST) | _unspaced(word)

    def cut(word: Column) -> Column:
        characters = F.transform(F.split(word, ""), lambda c: F.xxhash64(c))
        runs = _once(characters, lambda c: _runs(c, CHARACTERS))
        whole = F.when(long(word), _windows(characters, LONGEST)).otherwise(F.array(F.xxhash64(word)))
        return F.when(_unspaced(word), runs).otherwise(whole)

    def elements(words: Column) -> Column:
        return F.when(F.exists(words, long), F.flatten(F.transform(words, cut))).otherwise(
            F.transform(words, lambda w: F.xxhash64(w))
        )

    return _once(_once(F.split(trimmed, EDGE), elements), lambda e: _runs(e, k))


def signatures(
    df: DataFrame, group: str, row: list[str], text: str, k: int = K, entries: int = ENTRIES
) -> DataFrame:
    """(group, row columns, signature): for each text an array of ``entries`` whole numbers, null
    where an entry has no element.

    ``group`` and ``row`` together name a text; rows of a group are kept together.
    Works on whole texts of any length, and orders them to their end.
    """
    key = [group, *row]
    elements = df.select(*key, F.posexplode(kmers(F.col(text), k)).alias("place", "kmer"))
    one = elements.withColumn("element", F.xxhash64(*row, "kmer"))
    # The element first: its spread bits make the sort a radix sort.
    same = Window.partitionBy("element", group).orderBy("place")
    numbered = one.withColumn("value", F.xxhash64("kmer", F.row_number().over(same)))
    stratum = F.pmod("value", F.lit(2 * entries))
    coded = numbered.select(*key, stratum.alias("stratum"), "value", "place")
    entry = F.shiftright("stratum", 1).cast("int").alias("entry")
    odd = F.col("stratum") % 2 == 1
    even_value, odd_value = F.when(~odd, F.col("value")), F.when(odd, F.col("value"))
    least = coded.groupBy(*key, entry).agg(
        F.min(even_value).alias("a"),
        F.min(odd_value).alias("b"),
        F.min_by("place", even_value).alias("a_place"),
        F.min_by("place", odd_value).alias("b_place"),
    )
    a, b = F.col("a"), F.col("b")
    pair = (
        F.when(a.isNull(), F.xxhash64(F.lit(1), b))
        .when(b.isNull(), F.xxhash64(F.lit(0), a))
        .when(F.col("a_place") <= F.col("b_place"), F.xxhash64(F.lit(2), a, b))
        .otherwise(F.xxhash64(F.lit(3), b, a))
    )
    hashed = least.select(*key, "entry", F.shiftrightunsigned(pair, 64 - HASH_BITS).alias("pair"))
    columns = [F.max(F.when(F.col("entry") == i, F.col("pair"))) for i in range(entries)]
    return hashed.groupBy(*key).agg(*[c.alias(f"e{i}") for i, c in enumerate(columns)]).select(
        *key, F.array(*[F.col(f"e{i}") for i in range(entries)]).alias("signature")
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries among those that either signature has; 1 for equal signatures."""
    equal = F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0))
    either = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), 0).otherwise(1))

    def total(numbers: Column) -> Column:
        return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)

    return total(equal).cast("double") / total(either)


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits an entry, dashes where it is empty."""
    digits = F.transform(
        signature,
        lambda x: F.coalesce(F.lower(F.lpad(F.hex(x), HASH_BITS // 4, "0")), F.lit("-" * 8)),
    )
    return F.concat_ws("", digits)

"""URL filter: rules first, then the ratio of two character language models.

Two variable-order Markov models over characters, one of accepted and one of
rejected URLs, give each character of a URL the log-ratio of its probabilities
after the characters before it. Probabilities are smoothed by Witten-Bell
interpolation from the whole context, seen with this character or not, down to a
uniform alphabet. The mean log-ratio of a URL is compared with a threshold calibrated on labelled URLs that were not learnt from.

Grams of all labelled URLs are counted but for the part set aside, all of which
calibrates. Tables of grams and the rows that ask for them meet in unforced joins,
where adaptive execution can split a common gram. Every URL counts and is scored
whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from roentra.operators.durable import materialize

ORDER = 4
ALPHABET = 256
# Characters of a URL cut at once.
PIECE = 64
# One in so many of the labelled URLs calibrates.
ASIDE = 5
# Ranges of scores, whose totals are gathered to calibrate.
BINS = 4096
START, END = "\x02", "\x03"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host and the beginning of a path; subdomains of the host count."""

    pattern: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.pattern.partition("/")
        inside = (host == own) | host.endswith("." + own)
        return inside & path.startswith(slash + rest)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else
    empty."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return _lower(F.coalesce(found, F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(pattern, verdict) of the longest rule that fits, null without one."""
    ranked = sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))
    none = F.lit(None).cast("string")

    def first(outcome) -> Column:
        return reduce(
            lambda rest, r: F.when(r.fits(host, path), outcome(r)).otherwise(rest),
            reversed(ranked),
            none,
        )

    return first(lambda r: F.lit(r.pattern)), first(lambda r: F.lit(r.verdict))


def _grams(df: DataFrame, keep: list[str]) -> DataFrame:
    """Row per character of ``url``, the end included, with ``gram``: it after ORDER others.

    The URL is first cut into pieces that overlap by ORDER characters, so that a gram is found
    by its place in a short piece and the work is linear in the URL.
    """
    text = F.concat(F.lit(START * ORDER), _lower(F.coalesce("url", F.lit(""))), F.lit(END))
    piece = f"(?s)(?=(.{{1,{PIECE + ORDER}}})).{{1,{PIECE}}}"
    pieces = df.select(*keep, F.explode(F.regexp_extract_all(text, F.lit(piece), F.lit(1))).alias("piece"))
    pieces = pieces.where(F.length("piece") > ORDER)
    places = pieces.select(
        *keep, "piece", F.explode(F.sequence(F.lit(1), F.length("piece") - ORDER)).alias("at")
    )
    return places.select(*keep, F.substring("piece", F.col("at"), F.lit(ORDER + 1)).alias("gram"))


def examples(labelled: DataFrame) -> DataFrame:
    """(row, url, verdict, aside) of each distinct URL of ``labelled`` (row, url, verdict)."""
    aside = F.pmod(F.xxhash64(F.lit(1), "url"), F.lit(ASIDE)) == 0
    once = labelled.groupBy("url", "verdict").agg(F.min("row").alias("row"))
    return once.select("row", "url", "verdict", aside.alias("aside"))


def _level(counts: DataFrame, i: int) -> DataFrame:
    """(gram, short, a, b, and of its context: sum and kinds in either model) of the grams of
    ``i`` + 1 characters that end the counted ones."""
    one = counts.groupBy(F.substring("gram", ORDER + 1 - i, i + 1).alias("gram")).agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")
    )
    context = F.substring("gram", F.lit(1), F.lit(i))
    totals = one.groupBy(context.alias("context")).agg(
        F.sum("a").alias("sum_a"),
        F.sum("b").alias("sum_b"),
        F.count_if(F.col("a") > 0).alias("kinds_a"),
        F.count_if(F.col("b") > 0).alias("kinds_b"),
    )
    named = one.withColumn("context", context)
    return named.join(totals, "context").withColumn("short", F.substring("gram", F.lit(2), F.lit(i)))


def _smoothed(model: str, lower: Column) -> Column:
    n, total, kinds = F.col(model), F.col(f"sum_{model}"), F.col(f"kinds_{model}")
    return F.when(total == 0, lower).otherwise((n + kinds * lower) / (total + kinds))


def fit(sample: DataFrame) -> DataFrame:
    """(gram, a, b): how often either verdict's URLs have a character after ORDER others.

    Shorter grams are the ends of these, as the URLs are padded.
    """
    counts = _grams(sample.where("NOT aside"), ["verdict"]).groupBy("gram").agg(
        F.count_if(F.col("verdict") == ALLOW).alias("a"),
        F.count_if(F.col("verdict") == BLOCK).alias("b"),
    )
    return materialize(counts, "url-model")


def ratios(asked: DataFrame, model: DataFrame) -> DataFrame:
    """(gram, ratio): the log-ratio of the two probabilities of each asked or counted gram's last
    character after the others.

    Asked grams join the counted ones with a count of nothing, so that the recursion
    begins with the whole context for every gram: where a context was seen without
    this character, the escape weights of both models count.
    """
    none = F.lit(0).cast("long")
    counts = model.union(asked.select("gram", none.alias("a"), none.alias("b")))
    counts = counts.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = materialize(counts, "url-asked")
    uniform = F.lit(1.0 / ALPHABET)
    level = _level(counts, 0).select(
        "gram", _smoothed("a", uniform).alias("p_a"), _smoothed("b", uniform).alias("p_b")
    )
    for i in range(1, ORDER + 1):
        lower = materialize(level, "url-level").select(
            F.col("gram").alias("short"), F.col("p_a").alias("low_a"), F.col("p_b").alias("low_b")
        )
        level = _level(counts, i).join(lower, "short")
        level = level.select(
            "gram",
            _smoothed("a", F.col("low_a")).alias("p_a"),
            _smoothed("b", F.col("low_b")).alias("p_b"),
        )
    return materialize(level.select("gram", (F.log("p_a") - F.log("p_b")).alias("ratio")), "url-level")


def scores(df: DataFrame, model: DataFrame, keep: list[str]) -> DataFrame:
    """(kept columns, score): the mean log-ratio of all characters of ``url``, its end included.

    The kept columns name a row; rows equal in all of them give one. Ratios are
    summed as decimals, so that equal URLs have equal scores in any order of their
    characters.
    """
    places = _grams(df, keep)
    table = ratios(places.select("gram").distinct(), model)
    exact = F.col("ratio").cast("decimal(20,12)")
    total = places.join(table, "gram").groupBy(*keep).agg(
        F.sum(exact).cast("double").alias("total"), F.count(F.lit(1)).alias("n")
    )
    return total.select(*keep, (F.col("total") / F.col("n")).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """The score that best parts the verdicts: most allowed share above less blocked share above,
    in the middle between two scores; 0 unless both verdicts are there.

    Shares above a score are the totals of the ranges above its own, which are at most
    ``BINS`` rows, and a running total inside its range.
    """
    counts = scored.groupBy("score").agg(
        F.count_if(F.col("verdict") == ALLOW).alias("a"),
        F.count_if(F.col("verdict") == BLOCK).alias("b"),
    )
    counts = materialize(counts, "url-scores")
    low, high, n_a, n_b = counts.agg(F.min("score"), F.max("score"), F.sum("a"), F.sum("b")).first()
    if not n_a or not n_b:
        return 0.0
    width = (high - low) / BINS or 1.0
    ranged = counts.withColumn("bin", F.floor((F.col("score") - low) / width))
    down = Window.orderBy(F.desc("bin"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("bin").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("score").alias("top")
    )
    bins = totals.select(
        "bin",
        F.coalesce(F.sum("a").over(above), F.lit(0)).alias("above_a"),
        F.coalesce(F.sum("b").over(above), F.lit(0)).alias("above_b"),
        F.lead("top").over(down).alias("below"),
    )
    inside = Window.partitionBy("bin").orderBy(F.desc("score"))
    placed = ranged.join(bins, "bin")
    gain = (F.col("above_a") + F.sum("a").over(inside)) / n_a - (
        F.col("above_b") + F.sum("b").over(inside)
    ) / n_b
    next_score = F.coalesce(F.lead("score").over(inside), "below", "score")
    best = (
        placed.select("score", gain.alias("gain"), next_score.alias("next"))
        .orderBy(F.desc("gain"), F.desc("score"))
        .first()
    )
    return (best["score"] + best["next"]) / 2


def judge(
    df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict, score): one row per row of ``df``.

    A rule decides where one fits; elsewhere a URL is allowed whose score reaches
    the calibrated threshold. Accepted and rejected examples are the URLs that
    rules decide. A URL without evidence scores 0 (so does every one if no rule
    fits any); a null URL is like an empty one. ``score`` is null where a rule
    decides. Rows that repeat are judged once and returned each.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_for(rules, F.col("host"), F.col("path"))
    known = (
        rows.groupBy("id", "url")
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("*", host.alias("host"), path.alias("path"))
        .select("*", rule.alias("rule"), verdict.alias("ruled"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    known = materialize(known, "url-rows")
    labelled = known.where("ruled IS NOT NULL").select("row", "url", F.col("ruled").alias("verdict"))
    sample = materialize(examples(labelled), "url-examples")
    open_ = known.where("ruled IS NULL")
    asked = open_.select("row", "url").union(sample.where("aside").select("row", "url"))
    scored = materialize(scores(asked, fit(sample), ["row"]), "url-scored")
    threshold = calibrate(sample.where("aside").join(scored, "row").select("score", "verdict"))
    by_model = F.when(F.col("score") >= threshold, ALLOW).otherwise(BLOCK)
    columns = ["id", "host", "path", "rule", "verdict", "score", "copies"]
    judged = open_.join(scored, "row").withColumn("verdict", by_model).select(*columns)
    ruled = known.where("ruled IS NOT NULL").select(
        "id", "host", "path", "rule", F.col("ruled").alias("verdict"),
        F.lit(None).cast("double").alias("score"), "copies",
    )
    every = judged.union(ruled).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    )
    return every.select(F.col("id").alias(id_col), *columns[1:6])

"""Quality rules with risk-controlled thresholds.

Base rules are fixed. Further rules reject a document whose feature exceeds a cutoff; cutoffs come from labelled
holdouts: for each stratum and feature, grid cutoffs are tested from the mildest on, and testing stops at the first
one for which an exact binomial test does not show that fewer than `risk` of the good documents would be rejected
(fixed-sequence testing). Bonferroni's correction covers strata and features. Of the certified cutoffs, the one that
separates labelled bad from good documents best is used, or none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, columns, long_, map_texts, written
from .shingles import sketcher

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
#: Cutoffs of a feature are multiples of 1 / GRID up to LINEAR, and as many for each doubling from there on.
GRID, LINEAR = 32, 20.0
MARKS = re.compile(r"[!?]")
WINDOW = 5


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of a whole text, in the order of COUNTS; null and empty texts count zero."""
    words = WORD.findall(text or "")
    if not words:
        return (0, 0, sum((text or "").count(c) for c in SYMBOLS), 0, 0, 0, 0, len(MARKS.findall(text or "")))
    seen: set = set()
    dup = lines = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    grams = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        times: dict = {}
        for g in grams:
            times[g] = times.get(g, 0) + 1
        end = 0  # words before it are counted
        for i, g in enumerate(grams):
            if times[g] > 1:
                repeated += i + WINDOW - max(i, end)
                end = i + WINDOW
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    chars = sum(map(len, words))
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS), dup, repeated, lines, upper, len(MARKS.findall(text)))


def count_features(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """COUNTS of each whole text, and a sketch that near copies share; a narrow map."""
    keep = [c for c in df.columns if c != text] if keep is None else keep

    def make():
        sketch = sketcher()

        def compute(texts: list) -> Iterator[tuple]:
            for t, (s,) in zip(texts, sketch(texts), strict=True):
                yield *count_text(t), s

        return compute

    return map_texts(df, make, [long_(c) for c in (*COUNTS, "sketch")], keep, (text,))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Name to ratio, larger meaning worse; all are 0 or more."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)) * 4,
        "repeat_words": F.col("n_repeat_words") / words * 4,
        "long_words": mean,
        "short_words": F.greatest(F.lit(0.0), 20 - mean),
        "upper_words": F.col("n_upper") / words * 4,
        "marks_per_word": F.col("n_marks") / words * 4,
        "few_words": 20 / F.sqrt(words),
    }


def bin_of(feature: Column) -> Column:
    """The cutoff's number that a feature reaches: ascending and without an end, but a histogram has some thousands."""
    x = feature.cast("double")
    return F.floor(GRID * F.when(x <= LINEAR, x).otherwise(LINEAR + LINEAR * F.log2(x / LINEAR)))


def _tail(n: int, k: int, p: float) -> float:
    """P(Bin(n, p) <= k), exactly summed."""
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    return min(1.0, math.fsum(math.exp(log(i)) for i in range(k + 1)))


def choose_cutoff(bins: pd.DataFrame, risk: float, level: float, gain: float) -> int | None:
    """The cutoff (a bin; higher bins are rejected) for one stratum and feature; bins: bin, good, bad."""
    good, bad = int(bins["good"].sum()), int(bins["bad"].sum())
    if not good or not bad:
        return None
    best, chosen, k, b = 0.0, None, 0, 0
    for row in bins.sort_values("bin", ascending=False).itertuples():  # rejecting bin and all above it
        k, b = k + int(row.good), b + int(row.bad)
        if k > risk * good or _tail(good, k, risk) > level:
            break
        if b / bad - gain * k / good > best:
            best, chosen = b / bad - gain * k / good, int(row.bin) - 1
    return chosen


def calibrate(counted: DataFrame, labels: DataFrame, stratum: str, risk: float = 0.05, confidence: float = 0.95, gain: float = 20.0) -> DataFrame:
    """Cutoffs (stratum, feature, cutoff) from labelled rows that pass the base rules.

    risk: share of a stratum's good documents that all rules together may reject, with probability `confidence` at
    least over all strata. gain: what a point of rejected good documents weighs against one of rejected bad ones.
    The histogram is summed over all labelled rows but copies: of the rows of a stratum that share a sketch, that of the
    least doc_id counts, or the draws would not be independent. Its bins follow the features' logarithms, and each stratum
    is chosen on its own, so nothing meets on the driver. Labels with several rows an id count by their least.
    """
    named = features()
    labels = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = counted.where(~base_failed()).join(labels, "doc_id").select(F.col(stratum).alias("stratum"), "doc_id", "sketch", "quality", *[c.alias(n) for n, c in named.items()])
    row = F.struct("doc_id", "quality", *named)
    rows = rows.groupBy("stratum", "sketch").agg(F.min(row).alias("row")).select("stratum", "row.*")
    long = rows.select("stratum", "quality", F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), bin_of(F.col(n)).alias("bin")) for n in named])).alias("x"))
    bins = long.groupBy("stratum", "x.feature", "x.bin").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    bins = bins.withColumn("strata", F.lit(counted.select(stratum).distinct().count()))
    n_features = len(named)
    each = risk / n_features

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        level = (1 - confidence) / (n_features * max(int(part["strata"].iloc[0]), 1))
        c = choose_cutoff(part, each, level, gain)
        return pd.DataFrame({"stratum": [part["stratum"].iloc[0]], "feature": [part["feature"].iloc[0]], "cutoff": pd.array([c], dtype="Int64")})

    return bins.groupBy("stratum", "feature").applyInPandas(choose, "stratum string, feature string, cutoff long").where("cutoff is not null")


def quality_rules(df: DataFrame, labels: DataFrame, stratum: str = "lang", **how) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed and kept, one row for each row of df.

    Null and empty texts have no words, so the base rules reject them. Documents of a stratum without certified cutoffs
    (few or no labels, a null stratum among them) are judged by the base rules alone. Repeated rows are judged alike.
    """
    (of,) = columns([stratum])
    counted = written(count_features(df.select("doc_id", of.cast("string").alias("stratum"), "text"), keep=["doc_id", "stratum"]))
    cuts = calibrate(counted, labels, "stratum", **how)
    # one row a stratum: feature to cutoff; strata with a cutoff are fewer than labels / 100, and AQE picks the join
    cuts = cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("feature", "cutoff"))).alias("cuts"))
    joined = counted.join(cuts.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")), "left")
    over = F.lit(False)
    for n, c in features().items():
        over = over | F.coalesce(bin_of(c) > F.col("cuts")[n], F.lit(False))
    failed = base_failed()
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~over).alias("kept"))

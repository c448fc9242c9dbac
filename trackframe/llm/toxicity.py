"""Toxicity scores from a weighted lexicon, matched by Aho-Corasick over folded texts.

The lexicon is learnt from labelled rows: words, and beginnings of words, that occur in many toxic and few other
documents, weighted by their log odds; pairs of words that only clean documents hold are exception phrases, in which
the entry does not count. A logistic function of the summed weight, and of that weight a hundred words, is the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, map_batches, map_texts, row_key, written
from .shingles import sketcher

#: Letters of other scripts that look like Latin ones; fixed values.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m",
    "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "τ": "t", "ι": "i", "κ": "k", "ε": "e", "υ": "u",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "l", "ø": "o",
}
HIDDEN = "­​‌‍⁠﻿"
FOLD = str.maketrans(HOMOGLYPHS | dict.fromkeys(HIDDEN, "") | {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)})
LEET = str.maketrans("013457@$", "oieastas")
TOKEN = re.compile(r"[^\W_]+(?:[@$][^\W_]+)*")
DIGIT = re.compile(r"[0-9@$]")
#: Beginnings of words that may become entries have so many letters.
STEMS = range(4, 9)


def fold(text: str | None) -> list[str]:
    """The words of a text in lower case, with homoglyphs, hidden characters and digit substitutions undone."""
    words = TOKEN.findall((text or "").lower().translate(FOLD))
    for i, w in enumerate(words):
        if not w.isalpha() and DIGIT.search(w) and not w.isdigit():
            words[i] = w.translate(LEET)
    return words


def parts(words: list[str]) -> set[str]:
    """Entries that a text could support: " word " and " stem"."""
    out = set()
    for w in set(words):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in STEMS if n <= len(w))
    return out


def _counted(df: DataFrame, make) -> DataFrame:
    """Sum counts by entry over tasks, each of which adds up its own rows first."""
    def run(batches: Iterator) -> Iterator:
        count = make()
        sums: dict[str, list[int]] = {}
        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                for p in count(text):
                    sums.setdefault(p, [0, 0])[toxic] += 1
            if len(sums) > 300_000:  # a bound on the task's memory: the rest is summed after the shuffle
                yield _flush(sums)
                sums = {}
        yield _flush(sums)

    def _flush(sums):
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v[0] for v in sums.values()], pa.int64()), pa.array([v[1] for v in sums.values()], pa.int64())], names=["part", "clean", "toxic"])

    out = df.select("text", "toxic").mapInArrow(run, "part string, clean long, toxic long")
    return out.groupBy("part").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


class Lexicon:
    """Entries with weights, exception phrases, and the logistic function's coefficients."""

    def __init__(self, weights: dict[str, float], exceptions: frozenset[str] = frozenset(), coef: tuple[float, ...] = (-4.0, 1.0, 0.5)):
        self.weights, self.exceptions, self.coef = weights, exceptions, coef

    def matcher(self):
        """A function from a text to the two inputs of the score."""
        if not self.weights:
            return lambda text: (0.0, 0.0)
        import ahocorasick

        find = ahocorasick.Automaton()
        for p, w in self.weights.items():
            find.add_word(p, (len(p), w))
        find.make_automaton()
        exceptions = self.exceptions

        def match(text: str | None) -> tuple[float, float]:
            words = fold(text)
            folded = f" {' '.join(words)} "
            best: dict[int, float] = {}  # by the word's place: the entry of most weight
            for end, (n, w) in find.iter(folded):
                at = end - n + 1
                best[at] = max(w, best.get(at, 0.0))
            if exceptions and best:
                best = {at: w for at, w in best.items() if not _excepted(folded, at, exceptions)}
            total = sum(best.values())
            return math.log1p(total), math.log1p(100 * total / max(len(words), 20))

        return match

    def score(self, x: tuple[float, float]) -> float:
        z = self.coef[0] + self.coef[1] * x[0] + self.coef[2] * x[1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _pairs(folded: str, at: int) -> list[str]:
    """The word at the blank `at`, with its neighbour on either side."""
    end = folded.find(" ", at + 1)
    before, after = folded.rfind(" ", 0, at) if at else -1, folded.find(" ", end + 1)
    return ([folded[before + 1 : end]] if before >= 0 else []) + ([folded[at + 1 : after]] if after > 0 else [])


def _excepted(folded: str, at: int, exceptions: frozenset[str]) -> bool:
    return any(p in exceptions for p in _pairs(folded, at))


def _fit(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 0.05) -> tuple[float, ...]:
    """Logistic regression by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * np.r_[0, w[1:]])
    return tuple(float(v) for v in w)


def _training_rows(docs: DataFrame, labels: DataFrame, most_rows: int) -> DataFrame:
    """text, toxic: the rows to learn from, in a table of their own; at most about most_rows, one of each group of copies."""
    labels = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    labels = labels.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = max(labels.count(), 1)
    sample = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < most_rows)
    rows = docs.select(row_key().alias("key"), "doc_id", "text").where("text is not null").join(F.broadcast(sample), "doc_id")
    # copies would make any word of theirs look toxic: of rows with one sketch, one trains
    rows = written(map_texts(rows, sketcher, [T.StructField("sketch", T.LongType())], ["key", "text", "toxic"]))
    first = written(rows.groupBy("sketch", "toxic").agg(F.min("key").alias("key")).select("key").distinct())
    few = rows.join(first, "key").dropDuplicates(["key"])  # rows that share an id and differ are rows of their own
    n = max(first.count(), 1)
    return written(few.where(F.pmod(F.xxhash64("key"), F.lit(n)) < most_rows).select("text", "toxic"))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = 50_000, least: int = 4, least_share: float = 0.008, least_weight: float = 2.5, exceptions: bool = True) -> Lexicon:
    """Learn from labelled rows that aren't held out.

    most_rows bounds the training sample: labelled ids are taken by hash so that about as many remain (all, if fewer),
    and then rows alike. Only ids (12 bytes each) are broadcast; the rows are stored once. An entry stands in `least` toxic
    documents, and least_share of them: rarer words are those of copies of one document. So the sample bounds the entries:
    a document's words over least_share, on average. Rows without an id, a label or a text don't train; an id with several
    labels takes the largest.
    """
    rows = _training_rows(docs, labels, most_rows)
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean_n, toxic_n = totals.get(0, 0), totals.get(1, 0)
    if not toxic_n:
        return Lexicon({})

    least_docs = max(least, round(least_share * toxic_n))
    found = _counted(rows.where("toxic = 1"), lambda: lambda text: parts(fold(text)))
    candidates = {r["part"]: r["toxic"] for r in found.where(F.col("toxic") >= least_docs).collect()}

    def against():
        def count(text):
            return parts(fold(text)) & candidates.keys()

        return count

    clean = {r["part"]: r["clean"] for r in _counted(rows.where("toxic = 0"), against).collect()}
    weight = lambda p, t: math.log((t + 0.5) / (toxic_n + 1)) - math.log((clean.get(p, 0) + 0.5) / (clean_n + 1))
    strong = {p: weight(p, t) for p, t in candidates.items() if 20 * clean.get(p, 0) * toxic_n <= t * max(clean_n, 1)}
    weights = {p: w for p, w in strong.items() if w >= least_weight}
    lexicon = Lexicon(weights)

    if exceptions and weights:
        def phrases():
            import ahocorasick

            find = ahocorasick.Automaton()
            for p in weights:
                find.add_word(p, len(p))
            find.make_automaton()

            def count(text):
                folded = f" {' '.join(fold(text))} "
                return {x for end, k in find.iter(folded) for x in _pairs(folded, end - k + 1)}

            return count

        # pairs with an entry that several clean rows of the sample hold, and no toxic one
        lexicon.exceptions = frozenset(r["part"] for r in _counted(rows, phrases).where("clean >= 3 and toxic = 0").collect())

    def make():
        match = lexicon.matcher()

        def compute(texts: list) -> Iterator[tuple]:
            return map(match, texts)

        return compute

    both = [T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())]
    # about most_rows rows of 20 bytes at most; in order, so that reruns agree to the last bit
    fit = map_texts(rows, make, both, ["toxic"]).toPandas().sort_values(["toxic", "a", "b"])
    lexicon.coef = _fit(fit[["a", "b"]].to_numpy(), fit["toxic"].to_numpy(dtype=float))
    return lexicon


def score_texts(df: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text", threshold: float = 0.7) -> DataFrame:
    """keep, score and predicted of each row, one narrow map over whole texts; null and empty texts get the least score."""

    def make():
        match = lexicon.matcher()

        def compute(texts: list) -> Iterator[tuple]:
            for t in texts:
                s = lexicon.score(match(t))
                yield s, int(s >= threshold)

        return compute

    return map_texts(df, make, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], keep, (text,))


def without_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, all their columns as they are, whose score is under the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = lexicon.matcher()
        for b in batches:
            yield b.filter(pa.array([lexicon.score(match(t)) < threshold for t in b.column(b.schema.get_field_index("text")).to_pylist()], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs; repeated rows score alike, other columns play no part."""
    lexicon = train(docs, labels, **how)
    out = score_texts(docs.select("doc_id", "text"), lexicon, ["doc_id"])
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")

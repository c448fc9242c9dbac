"""Secret scan: fixed base patterns, and password guess costs for values in a credential context.

A value's cost is that of its cheapest segmentation, found by dynamic programming. The words of the ranked list are some
fixed ones and then the words that most documents of the corpus hold, as those are what a guesser tries first.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, long_, map_texts, string_

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "guess")

#: What may stand before a credential, and what may link the two.
CONTEXT = re.compile(
    r"""(?<![^\W_])(pass(?:word|wd|phrase|code)?|passwort|kennwort|contraseña|mot\x20de\x20passe|pwd|secret|token|api[_-]?key|credentials?|auth|login)["']?"""
    r"""(?:\x20*(?:[:=]|=>|->)\x20*|\x20+(?:is|ist|es|est)\x20+)["']?([^\s"']+)""",
    re.I,
)
CONTEXT_WORDS = (
    "pass", "kennwort", "contrase", "pwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "auth", "login",
)

#: Frequent parts of passwords, the most frequent first; a word's guesses are its rank.
WORDS = (
    "password pass admin welcome login user root test secret letmein master monkey dragon shadow love hello summer "
    "winter spring autumn sunshine princess football baseball superman batman ninja star angel magic money power "
    "office work home house computer internet server data base system default guest change temp private public "
    "token key api code access account bank credit card mail email name first last city country world "
    "blue red green black white silver gold orange purple happy good best cool hot cold fire water earth wind "
    "king queen lord lady boy girl man woman baby mother father sister brother friend dog cat horse tiger lion"
).split()
#: Words of the corpus that are ranked behind them, and their letters; a longer run of letters is no word, and is not cut into some.
CORPUS_WORDS = 20_000
LETTERS, LEAST_LETTERS, MOST_LETTERS = re.compile(r"[^\W\d_]+"), 3, 64
#: Rows of a keyboard; a walk steps along one.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop")
#: Characters of the longest block whose repeats are found.
BLOCK = 4096
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d)|(?:19|20)\d\d"
)
LEET = str.maketrans("013457@$!", "oleastasi")
FOLLOWS = frozenset(x for r in ROWS for s in (r, r[::-1]) for x in zip(s, s[1:], strict=False))


def ranked(words: list[str] | None = None) -> dict[str, int]:
    """Word to rank: WORDS, and then the words given that are not among them."""
    return {w: i for i, w in enumerate(dict.fromkeys([*WORDS, *(words or [])]), 1)}


def _alphabet(s: str) -> int:
    n = 10 * any(c.isdigit() for c in s) + 26 * any(c.islower() for c in s) + 26 * any(c.isupper() for c in s)
    return max(n + 32 * any(not c.isalnum() for c in s), 10)


def word_cost(s: str, ranks: dict[str, int]) -> float:
    """log10 of the guesses for one word; capitals and digit substitutions cost a factor of 2 each. Inf: no word."""
    low = s.lower()
    rank = ranks.get(low)
    if rank is None and (rank := ranks.get(low.translate(LEET))) is not None:
        rank *= 2
    return math.inf if rank is None else math.log10(rank * (1 + (s != low)) + 1)


def date_cost(s: str) -> float:
    if len(s) not in (4, 8, 10) or not s[-1].isdigit() or not DATE.fullmatch(s):
        return math.inf
    return math.log10(365 * 100 if len(s) > 4 else 120)


class Guesses:
    """Guess costs by a ranked list of words."""

    def __init__(self, words: list[str] | None = None):
        self.ranks = ranked(words)
        self.longest = max([10, *map(len, self.ranks)])  # dates have 10 characters at most
        self.cost = lru_cache(4096)(self._cost)

    def _cost(self, value: str, enough: float = math.inf, brute: float | None = None) -> float:
        """log10 of the guesses that the cheapest segmentation of value takes; anything from `enough` on, if it takes as many.

        Segments: words of the ranked list; dates; a keyboard walk of 3 characters or more; a character repeated 3 times
        or more; a block that is no repeat itself, twice or more, at the block's own least cost and that of its number; and
        single characters, at `brute` (the size of the value's alphabet). No segment has a greatest length, but a block
        (BLOCK characters).

        Places that cost `enough` are left. A walk, or a repeat of a block, that ends where its own kind goes on is not begun
        anew there: one segment over both costs no more, as log(a + b) <= log(a) + log(b) + the cost of another block (or
        walk). Inside the repeats of a block no other block repeats but shorter ones and those that go beyond, so a long run
        costs a task in proportion to its length.
        """
        n, low = len(value), value.lower()
        brute = math.log10(_alphabet(value)) if brute is None else brute
        best, by = [0.0] + [math.inf] * n, [None] * (n + 1)
        walk = [0] * n  # where the walk from each place ends
        for i in range(n - 1, -1, -1):
            walk[i] = walk[i + 1] if i + 1 < n and (low[i], low[i + 1]) in FOLLOWS else i + 1
        ends: dict[int, int] = {}  # period: the end of its run that was looked at last

        def put(j: int, cost: float, kind: object) -> None:
            if cost < best[j]:
                best[j], by[j] = cost, kind

        for i in range(n):
            here = best[i]
            if here >= enough:
                continue
            put(i + 1, here + brute, None)
            for j in range(i + 3, min(i + self.longest, n) + 1):
                part = value[i:j]
                put(j, here + min(word_cost(part, self.ranks), date_cost(part)), None)
            if by[i] != "walk" or walk[i - 1] == i:
                for j in range(i + 3, walk[i] + 1):
                    put(j, here + math.log10(40 * (j - i)), "walk")
            for p in self._periods(value, i, ends):
                unit = value[i : i + p]
                if by[i] == p and value[i - p : i] == unit:
                    continue
                each = brute if p == 1 else self.cost(unit, enough - here, brute)
                if here + each < enough:
                    for times in range(3 if p == 1 else 2, (ends[p] - i) // p + 1):
                        put(i + times * p, here + each + math.log10(times), p)
        return best[n]

    @staticmethod
    def _periods(value: str, i: int, ends: dict[int, int]) -> list[int]:
        """Sizes of the blocks (no repeats themselves) that stand twice from i on; `ends` learns where their runs end."""
        n, found, inside = len(value), [], [p for p, e in ends.items() if e >= i + 2 * p]
        most = min((n - i) // 2, BLOCK)
        # in a run of period p that goes on to e, another block repeats only if it is shorter, or goes beyond the run
        p0 = min(inside, default=0)
        sizes = [*range(1, p0 + 1), *range(max(p0 + 1, (ends[p0] - i - p0) // 2), most + 1)] if p0 else range(1, most + 1)
        for p in sizes:
            if p <= most and value[i] == value[i + p] and value[i : i + p] == value[i + p : i + 2 * p]:
                unit = value[i : i + p]
                if p > 1 and (unit + unit).find(unit, 1) < p:
                    continue
                if ends.get(p, 0) < i + 2 * p:
                    e = i + 2 * p
                    while e < n and value[e] == value[e - p]:
                        e += 1
                    ends[p] = e
                found.append(p)
        return found


def frequent_words(docs: DataFrame, most: int = CORPUS_WORDS) -> list[str]:
    """The `most` words of letters that most documents hold, lower-case, the most frequent first; ties by name.

    A word is a whole run of LEAST_LETTERS to MOST_LETTERS letters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for b in batches:
            for t in b.column("text").to_pylist():
                for w in set(LETTERS.findall((t or "").lower())):
                    if LEAST_LETTERS <= len(w) <= MOST_LETTERS:
                        counts[w] = counts.get(w, 0) + 1
            if len(counts) > 300_000:  # a bound on the task's memory: the rest is summed after the shuffle
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["w", "n"])
                counts = {}
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["w", "n"])

    found = checkpointed(docs.select("text").mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")))
    # words by steps of their count, some 3,000 at most, tell from which count on the words are enough: each task then sends few
    step = F.floor(F.log2("n") * 64)
    held, cutoff = 0, 0
    for r in found.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():
        held, cutoff = held + r["words"], r["step"]
        if held >= most:
            break
    found = found.where(step >= cutoff)
    return [r["w"] for r in found.orderBy(F.desc("n"), "w").limit(most).collect()]


def spans(text: str | None, least_cost: float = 8.0, guesses: Guesses | None = None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, spans of the method) of a whole text, as (start, end, kind); null: none."""
    base: list[tuple[int, int, str]] = []
    more: list[tuple[int, int, str]] = []
    if not text:
        return base, more
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        base += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    base.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    if any(w in low for w in CONTEXT_WORDS):
        guesses = guesses or Guesses()
        starts = [s for s, _, _ in base]
        ends = list(accumulate((e for _, e, _ in base), max))  # the furthest end of the spans up to each
        for m in CONTEXT.finditer(text):
            value = m[2].rstrip(".,;)")
            a, b = m.start(2), m.start(2) + len(value)
            before = bisect_right(starts, a)
            inside = before > 0 and ends[before - 1] >= b
            if len(value) >= 4 and not inside and guesses.cost(value, least_cost) >= least_cost:
                more.append((a, b, "guess"))
    return base, more


def as_text(found: list[tuple[int, int, str]]) -> str:
    found = sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in found)


def scan_secrets(df: DataFrame, text: str = "text", keep: list[str] | None = None, least_cost: float = 8.0, words: list[str] | None = None) -> DataFrame:
    """Secrets in each whole text: n_assign, n_access, n_hex, base_sha256 and all spans (code points, end exclusive).

    One narrow map. Null and empty texts have no spans; repeated rows each get their own; other columns in keep
    (all but the text, if not given) go through. least_cost: log10 of guesses from which a value counts as a secret.
    words: ranked words of the corpus (`frequent_words`), a list of bounded size.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep

    def make():
        guesses = Guesses(words)

        def compute(texts: list) -> Iterator[tuple]:
            for t in texts:
                base, more = spans(t, least_cost, guesses)
                n = [sum(k == kind for *_, k in base) for kind in KINDS[:3]]
                yield (*n, hashlib.sha256(as_text(base).encode()).hexdigest(), as_text(base + more))

        return compute

    fields = [long_("n_assign"), long_("n_access"), long_("n_hex"), string_("base_sha256"), string_("spans")]
    return map_texts(df, make, fields, keep, (text,))

import hashlib
import math
import random
import re
from collections import Counter

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from trackframe.llm import quality, secrets

SCHEMA = "doc_id long, text string, lang string, n_words string, spans string"


def base_spans(text):
    """The base patterns as they are stated."""
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "SECRET", "api_key", "=", ": ", '"', "hunter2!", "AKIA", "ABCDEFGH12345678", "0123456789abcdef" * 2, "é", " ", "\n", "ſecret", "abc"]), max_size=12))
def test_base_patterns(parts):
    text = "".join(parts)
    base, _ = secrets.spans(text)
    want = base_spans(text)
    assert base == [(a, b, k) for a, _, k, b in want]


def exhaustive(g, value, brute=None, memo=None):
    """The least cost over all segmentations; a block's cost is that of the block by itself."""
    brute = math.log10(secrets._alphabet(value)) if brute is None else brute
    memo = {} if memo is None else memo
    if value in memo:
        return memo[value]
    low, n, longest = value.lower(), len(value), max(10, *map(len, g.ranks))
    best = [0.0]
    for j in range(1, n + 1):
        out = best[j - 1] + brute
        for i in range(j - 3, -1, -1):
            part = value[i:j]
            if len(part) <= longest:
                out = min(out, best[i] + secrets.word_cost(part, g.ranks), best[i] + secrets.date_cost(part))
            if all(x in secrets.FOLLOWS for x in zip(low[i:j], low[i + 1 : j])):
                out = min(out, best[i] + math.log10(40 * (j - i)))
            p = (part + part).find(part, 1)  # the block that is no repeat itself
            if p < len(part):
                each = brute if p == 1 else exhaustive(g, part[:p], brute, memo)
                out = min(out, best[i] + each + math.log10(len(part) // p))
        best.append(out)
    memo[value] = best[-1]
    return best[-1]


PARTS = ["dragon", "dragonn", "nn", "nnnnn", "green", "boy", "horse", "zxc", "Qwe", "qwq", "111", "abc", "abcabc", "1987", "2024-05-17", "p4ss", "X", "#", "9", "kla", "klakla"]


def agrees(g, value):
    want = exhaustive(g, value)
    assert abs(g.cost(value) - want) < 1e-9, value
    for enough in (3.0, 8.0):
        assert (g.cost(value, enough) >= enough) == (want >= enough) or abs(want - enough) < 1e-9


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=9))
def test_costs_are_least(parts):
    agrees(secrets.Guesses(["zebra", "klakla"]), "".join(parts))


def test_costs_of_long_values_are_least():
    """Values to 300 characters, blocks to 40 and more, walks and runs of any length."""
    rng, g = random.Random(6), secrets.Guesses(["zebra", "klakla", "internationalization"])
    for size in (3, 7, 13, 40, 90):
        for kind in range(4):
            block = "".join(rng.choice(PARTS if kind % 2 else "ab#Q9") for _ in range(size))[:size]
            value = "".join(rng.choice(PARTS) for _ in range(kind)) + block * (240 // size) + rng.choice(PARTS) * (kind // 2)
            agrees(g, value[rng.randrange(3) : 300])
    for value in ("qw" * 120, "x" * 290, "ab" * 70 + "ba" * 70, "aab" * 60 + "aaab" * 25, "qwertyuiop" * 20, "abcab" * 40 + "cabca" * 15):
        agrees(g, value)


def test_repeats_and_walks_of_any_length():
    g = secrets.Guesses()
    for value in ("xyz" * 20, "xyz" * 60, "xyz" * 5000, "qwertyuiop" * 8, "mnbvcxzlkj" * 3, "horse-star" * 2, "horse-star" * 60, "qwqwqwqw" * 2000):
        assert g.cost(value, 8.0) < 8.0, value[:20]
    assert g.cost("kT9#vQ2x!mZ7" * 3) > 8 and g.cost("".join(random.Random(2).choices("abcdefghijklmnop0123456789", k=50_000)), 8.0) >= 8


def test_words_are_whole(spark):
    rows = [(i, "Internationalization of the " + "z" * 70) for i in range(3)] + [(9, None)]
    words = secrets.frequent_words(spark.createDataFrame(rows, "doc_id long, text string"))
    assert words == ["internationalization", "the"] and secrets.Guesses(words).cost("internationalization") < 3


def test_guess_costs():
    g = secrets.Guesses()
    cost = g.cost
    assert cost("password") < cost("password1987") < cost("kT9#vQ2x!mZ7")
    assert cost("qwertyuiop") < 4 and cost("aaaaaaaaaaaa") < 4 and cost("2024-05-17") < 6
    assert cost("p4ssw0rd") < 2 and cost("x" * 5000) < 10 and cost("") == 0
    assert abs(cost("dragonnnnnn") - 3.26) < 0.01 and cost("abcabcabcabcabc") < 6
    assert cost("kT9#vQ2x!mZ7" * 100_000, 8.0) >= 8  # no need to go through all of it
    assert secrets.Guesses(["orbitale"]).cost("orbitale") < 2.1 < cost("orbitale")
    assert len(set(secrets.WORDS)) == len(secrets.WORDS)


def test_base_spans_of_a_long_text():
    text = "token = abcdefgh123 " * 20_000
    base, more = secrets.spans(text)
    assert len(base) == 20_000 and not more


def test_frequent_words(spark):
    texts = ["Alpha beta beta", "alpha Gamma", None, "", "x1 ab alpha beta2"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert secrets.frequent_words(docs) == ["alpha", "beta", "gamma"][: len(secrets.frequent_words(docs))] and secrets.frequent_words(docs, 1) == ["alpha"]
    assert secrets.frequent_words(docs.limit(0)) == []


def test_scan(spark):
    texts = ["login: kT9#vQ2x!mZ7 ok", "password = hello", None, "", "token = abcdef0123456789" + "ab" * 10, "pass " * 9]
    rows = [(i, t, "en", "a", "b") for i, t in enumerate(texts)] + [(0, texts[0], "en", "a", "b")]
    got = sorted(secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA), keep=["doc_id"]).collect(), key=lambda r: r["doc_id"])
    assert got[0] == got[1] and got[0]["spans"] == "guess:7:19" and len(got) == 7
    assert [r["n_assign"] for r in got[2:]] == [0, 0, 0, 1, 0]
    assert got[3]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[2]["spans"] == ""
    assert got[5]["spans"].startswith("assign:0:") and ",hex:8:" in got[5]["spans"]
    assert secrets.scan_secrets(spark.createDataFrame([], SCHEMA)).count() == 0


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(grams)
    covered = {k for i, g in enumerate(grams) if times[g] > 1 for k in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é\n\t#<\x1c\xa0")), max_size=120))
def test_counts(text):
    assert quality.count_text(text)[:5] == counts(text)


def test_cutoffs_are_certified():
    bins = pd.DataFrame({"bin": [1, 2, 50], "good": [3000, 30, 2], "bad": [10, 10, 300]})
    assert quality.choose_cutoff(bins, 0.01, 0.01, 20) == 49
    assert quality.choose_cutoff(bins.assign(good=[30, 0, 0]), 0.01, 0.01, 20) is None  # too few to show it
    assert quality.choose_cutoff(bins.assign(good=[3000, 30, 200]), 0.01, 0.01, 20) is None
    assert quality.choose_cutoff(bins.assign(bad=0), 0.01, 0.01, 20) is None
    assert abs(quality._tail(10, 3, 0.5) - 176 / 1024) < 1e-12


def brute_cutoffs(rows, labels, risk=0.05, confidence=0.95, gain=20.0):
    """Cutoffs by trying all values of all features on the labelled documents, one of each group of copies."""
    features = {
        "symbols_per_word": lambda c: c["n_symbols"] / c["n_words"], "dup_lines": lambda c: c["n_dup_lines"] / max(c["n_lines"], 1) * 4,
        "repeat_words": lambda c: c["n_repeat_words"] / c["n_words"] * 4, "long_words": lambda c: c["word_chars"] / c["n_words"],
        "short_words": lambda c: max(0.0, 20 - c["word_chars"] / c["n_words"]), "upper_words": lambda c: c["n_upper"] / c["n_words"] * 4,
        "marks_per_word": lambda c: c["n_marks"] / c["n_words"] * 4, "few_words": lambda c: 20 / math.sqrt(c["n_words"]),
    }
    number = lambda x: math.floor(32 * (x if x <= 20 else 20 + 20 * math.log2(x / 20)))

    def tail(n, k, p):
        total = term = (1 - p) ** n
        for i in range(k):
            term *= (n - i) / (i + 1) * p / (1 - p)
            total += term
        return total

    strata = {lang for _, _, lang, *_ in rows}
    out = {}
    for lang in strata:
        seen, some = set(), []
        for d, t, s, *_ in sorted(rows):
            c = dict(zip(quality.COUNTS, quality.count_text(t)))
            if s == lang and d in labels and t not in seen and c["n_words"] >= 10 and 100 * c["n_repeat_words"] <= 20 * c["n_words"]:
                seen.add(t)
                some.append((c, labels[d]))
        for name, f in features.items():
            xs = [(number(f(c)), y) for c, y in some]
            good, bad = sum(y for _, y in xs), sum(1 - y for _, y in xs)
            best, chosen = 0.0, None
            for cut in sorted({x for x, _ in xs}, reverse=True) if good and bad else []:
                k, b = sum(y for x, y in xs if x >= cut), sum(1 - y for x, y in xs if x >= cut)
                if k > risk / 8 * good or tail(good, k, risk / 8) > (1 - confidence) / (8 * len(strata)):
                    break
                if b / bad - gain * k / good > best:
                    best, chosen = b / bad - gain * k / good, cut - 1
            if chosen is not None:
                out[lang, name] = chosen
    return out


def test_cutoffs_by_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    rows, labels = [], {}
    for i in range(5200):
        bad = rng.random() < 0.1
        words = [word() + ("#" * rng.randrange(40) if bad else "#" * (rng.random() < 0.02)) for _ in range(rng.randrange(12, 30))]
        rows.append((i, " ".join(words), "en" if i % 4 else "de", "x", "y"))
        labels[i] = int(not bad) if rng.random() < 0.99 else int(bad)
    rows += [(6000 + i, rows[7][1], "en", "x", "y") for i in range(300)]  # copies
    labels |= {6000 + i: labels[7] for i in range(300)}
    docs = spark.createDataFrame([(d, t, s) for d, t, s, *_ in rows], "doc_id long, text string, stratum string")
    counted = quality.count_features(docs, keep=["doc_id", "stratum"])
    got = quality.calibrate(counted, spark.createDataFrame([(d, y, 0) for d, y in labels.items()], "doc_id long, quality int, toxic int"), "stratum")
    want = brute_cutoffs(rows, labels)
    assert want and {(r["stratum"], r["feature"]): r["cutoff"] for r in got.collect()} == want


def test_rules(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    rows, labels = [], []
    for i in range(2600):
        bad = i % 13 == 0
        rows.append((i, " ".join(word() + ("$$$" if bad else "") for _ in range(30)), "en", "x", "y"))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(9000, None, "en", "x", "y"), (9001, "", None, "x", "y"), (9002, "a b c d e " * 8, None, "x", "y"), (9003, " ".join(word() for _ in range(20)), None, "x", "y")]
    rows.append(rows[0])
    docs, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*labels, labels[0], (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.quality_rules(docs, lab).collect()}
    for d, t, *_ in rows:
        assert tuple(got[d])[1:6] == counts(t)
        assert got[d]["base_failed"] == (counts(t)[0] < 10 or 100 * counts(t)[4] > 20 * counts(t)[0])
    kept = [got[i]["kept"] for i in range(2600)]
    assert sum(kept[i] for i in range(0, 2600, 13)) == 0 and sum(kept) >= 0.95 * 2400
    assert not got[9000]["kept"] and not got[9002]["kept"] and got[9003]["kept"]
    assert quality.quality_rules(docs, lab).count() == len(rows)
    none = quality.quality_rules(docs.limit(50), lab.limit(0))
    assert none.where("kept = base_failed").count() == 0
    assert quality.quality_rules(docs.limit(0), lab).count() == 0

import random
import re

import numpy as np
import pytest

from oracle import same
from trackframe.llm import queries
from trackframe.llm import recompression as r

SCHEMA = "doc_id long, text string, n_words long, r string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length):
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    least = {}
    order = lambda d: (d is not None, d)
    for d, w in texts:
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            least[k] = min(least.get(k, order(d)), order(d))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if least[tuple(w[i : i + length])] < order(d):
                gone[i : i + length] = [True] * length
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


def corpus(seed, n, length, vocabulary=300):
    rng = random.Random(seed)
    words = ["é", "日本", "a", "a", "b", *(f"w{i}" for i in range(vocabulary))]
    text = lambda k: [rng.choice(words) for _ in range(k)]
    passage, period, rows = text(4 * length), text(3), []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.25:  # near copies
            t = WORD.findall(rng.choice(rows)[1])
            for _ in range(rng.randrange(4)):
                if t:
                    t[rng.randrange(len(t))] = "#"
        elif kind < 0.5:
            t = text(rng.randrange(length)) + passage[rng.randrange(length) : rng.randrange(2 * length, 4 * length)] + text(rng.randrange(length))
        elif kind < 0.6:
            t = text(3) + ["x"] * rng.choice([length - 1, length, 3 * length]) + text(3)
        elif kind < 0.7:
            t = text(rng.randrange(5)) + period * rng.randrange(length) + text(rng.randrange(5))
        else:
            t = text(rng.choice([0, 1, length - 1, length, length + 1, 5 * length]))
        rows.append((3 * i, rng.choice([" ", "\n", " \t"]).join(t)))
    return rows


def run(spark, rows, length, schema=SCHEMA):
    df = spark.createDataFrame([(*x, 1, "p") for x in rows], schema)
    out = r.drop_repeats(df, length).collect()
    for x in out:
        assert sum(e - a for a, e in zip(x["starts"], x["ends"], strict=True)) == x["n_removed"]
    return sorted(((x["doc_id"], x["n_words"], x["n_removed"], x["kept"]) for x in out), key=str)


@pytest.mark.parametrize(("seed", "length"), [(1, 50), (2, 50), (3, 15), (4, 5), (5, 1)])
def test_against_brute_force(spark, seed, length):
    rows = corpus(seed, 250, length, 300 if length > 5 else 40)
    want = brute(rows, length)
    assert sum(x[2] for x in want) > 500
    assert run(spark, rows, length) == want


def test_few_words_and_long_runs(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["a", "b"]) for _ in range(rng.randrange(400)))) for i in range(60)]
    rows += [(100 + i, " ".join((["a", "b", "c", "d", "e"][: 1 + i % 5] * 300)[: 100 + 37 * i])) for i in range(15)]
    assert run(spark, rows, 12) == brute(rows, 12)
    assert run(spark, rows, 50) == brute(rows, 50)


def test_repeated_ids_nulls_and_other_types_of_id(spark):
    p, q = " ".join(f"w{i}" for i in range(80)), " ".join(f"v{i}" for i in range(60))
    rows = [(5, p), (5, p), (None, q), (None, q), (7, q + " x"), (6, None), (8, ""), (9, "x " + p), (4, " \n ")]
    assert run(spark, rows, 50) == brute(rows, 50)
    named = [(None if d is None else f"id{d}", t) for d, t in rows]
    assert run(spark, named, 50, SCHEMA.replace("doc_id long", "doc_id string")) == brute(named, 50)


def test_symbols_hang_on_near_words_only():
    """What is alike in two texts has the same symbols, REACH words from its ends or more."""
    rounds = r.limits(50)
    reach = sum(rounds)
    assert rounds == [1, 1, 2, 2, 3, 3]
    rng = np.random.default_rng(2)
    found = 0
    for vocabulary in (2, 5, 1000):
        for _ in range(60):
            names = rng.integers(0, 2**63, vocabulary).astype(np.uint64)
            same_ = rng.choice(names, 60)
            a, b = (np.concatenate([rng.choice(names, rng.integers(0, 40)), same_, rng.choice(names, rng.integers(0, 40))]) for _ in range(2))
            cuts = []
            for x in (a, b):
                at = next(i for i in range(len(x)) if (x[i : i + 60] == same_).all())
                start, name = r.symbols(x, np.zeros(len(x), np.int64), rounds)
                end = np.append(start[1:], len(x))
                inside = (start - at >= reach) & (end - at <= 60 - reach)
                cuts.append(list(zip((start[inside] - at).tolist(), name[inside].tolist(), strict=True)))
            assert cuts[0] == cuts[1]
            found += len(cuts[0])
    assert found > 500


def test_rounds_shorten_and_names_tell_words():
    rng = np.random.default_rng(5)
    words = rng.choice(rng.integers(0, 2**63, 50).astype(np.uint64), 20_000)
    start, name = r.symbols(words, np.zeros(20_000, np.int64), r.limits(50))
    assert 6_000 < len(start) < 12_000
    end, of = np.append(start[1:], 20_000), {}
    for s, e, n in zip(start.tolist(), end.tolist(), name.tolist(), strict=True):
        assert of.setdefault(n, words[s:e].tolist()) == words[s:e].tolist()


def test_pieces_of_a_long_text(monkeypatch):
    rng = random.Random(3)
    t = " ".join(rng.choice(["a", "b", "ccc", "dd"]) for _ in range(3000)).encode()
    got = []
    for size, chunk in ((1 << 20, 1 << 17), (333, 100), (1, 1)):
        monkeypatch.setattr(r, "SLICE", size)
        monkeypatch.setattr(r, "CHUNK", chunk)
        windows = set()
        for rows, offsets, parts in r._pieces([t, None, b"", t[:2000]], 50, r.Names()):
            part, key, c1, c2, a, n = r.stretches(parts)
            for p, k, first, many in zip(part.tolist(), key.tolist(), a.tolist(), n.tolist(), strict=True):
                windows |= {(rows[p], offsets[p] + first + i, k) for i in range(many)}
        got.append(windows)
    # a window inside no symbol has a key of its own; all others the same key, wherever the pieces are cut
    assert {w[:2] for w in got[0]} == {w[:2] for w in got[1]} == {w[:2] for w in got[2]} and len(got[0]) == 2951 + len(t[:2000].split()) - 49
    assert got[0] == got[1] == got[2]


def test_empty_table(spark):
    assert run(spark, [], 50) == []


def test_query_against_sql(spark):
    assert same(spark, "/root/testdata/sf0.01", queries.queries()["op11_recompression"], queries.oracle_sql()["op11_recompression"]) == 1000

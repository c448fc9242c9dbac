import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oracle import same
from trackframe.llm import queries, vectors

SCHEMA = "vec_id long, embedding array<double>, label int, `codes` string, v long"


def brute(rows, parts, entries, rounds, scale):
    """Plain loops over all entries, in Python's integers."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v], lab) for i, v, lab, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1])
    coded = [r for r in kept if len(r[1]) == size]
    cut = [[s.tolist() for s in np.array_split(np.array(r[1], object), parts)] for r in coded]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda x, book: min((far(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for v in cut:
                of.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(of[k]) for c in zip(*of[k], strict=True)] if k in of else e for k, e in enumerate(books[p])]
    out = []
    for (i, _, lab), v in zip(coded, cut, strict=True):
        best = [nearest(v[p], books[p]) for p in range(parts)]
        out.append((i, lab, tuple(k for _, k in best), sum(d for d, _ in best)))
    out += [(i, lab, None, None) for i, v, lab in kept if len(v) != size]
    return out, books


def run(spark, rows, parts, entries, rounds, scale=64, **how):
    out, books = vectors.encode(spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA).repartition(5), parts, entries, rounds, scale, **how)
    got = [(r["vec_id"], r["label"], tuple(np.frombuffer(r["codes"], "<u2").tolist()) if r["codes"] is not None else None, r["error"]) for r in out.collect()]
    return sorted(got, key=str), [b.tolist() for b in books]


def data(seed, n, size, near=0.3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-2, 2) for _ in range(size)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, near) for x in rng.choice(centres)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    return rows + [(n + 5, rows[3][1], 1), (n + 6, rows[3][1], None), (n + 6, rows[4][1], 2)]


@pytest.mark.parametrize(("size", "entries", "replay"), [(8, 16, 8), (8, 16, 1), (10, 40, 2), (3, 5, 8)])
def test_against_all_entries(spark, size, entries, replay):
    rows = data(size, 300, size) + [(900, None, 1), (901, [1.0] * (size - 1) + [math.nan], 1), (902, [math.inf] * size, 2), (903, [None] * size, 2), (904, [1.0] * (size + 1), 2), (None, [0.5] * size, 3), (905, [], 1)]
    want, books = brute(rows, 4, entries, 3, 64)
    got, ours = run(spark, rows, 4, entries, 3, replay=replay)
    assert got == sorted(want, key=str)
    assert ours == books


def test_ties_and_copies_go_to_the_lower_index(spark):
    rows = [(i, [float(x)], 1) for i, x in enumerate([0, 2, 2, 4, 4, 1, 3, 1, 3, 2])]
    want, books = brute(rows, 1, 5, 2, 1)
    got, ours = run(spark, rows, 1, 5, 2, scale=1)
    assert got == sorted(want, key=str) and ours == books


def test_numbers_beyond_64_bits(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([1e30, -3e25, 2.0**61, 0.1, 1e9]) * rng.random() for _ in range(4)], 1) for i in range(60)]
    want, books = brute(rows, 2, 8, 2, 64)
    got, ours = run(spark, rows, 2, 8, 2)
    assert got == sorted(((i, lab, c, e if e < 2**63 else None) for i, lab, c, e in want), key=str)
    assert ours == books


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 6), st.integers(1, 30), st.sampled_from([2, 50, 10**7, 10**9]))
def test_scan_finds_the_nearest(seed, size, entries, most):
    rng = np.random.default_rng(seed)
    book = vectors.Book(rng.integers(-most, most + 1, (entries, size)))
    x = rng.integers(-most, most + 1, (40, size))
    index, d = book.nearest(x, rng.integers(0, entries, 40))
    all_d = ((x[:, None, :].astype(object) - book.entries[None].astype(object)) ** 2).sum(axis=2)
    assert index.tolist() == all_d.argmin(axis=1).tolist() and d.tolist() == all_d.min(axis=1).tolist()


def test_few_entries_are_scanned(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (64, 8))
    book = vectors.Book(centres)
    before = rng.integers(0, 64, 5000)
    x = centres[before] + rng.integers(-40, 41, (5000, 8))
    scan = [int(np.searchsorted(book.near[b], 4 * ((v - centres[b]) ** 2).sum(), "right")) for v, b in zip(x, before, strict=True)]
    assert np.mean(scan) < 2 and (book.nearest(x, before)[0] == before).all()


def test_reconstruction_and_label_errors(spark):
    rows = data(8, 200, 8, near=0.05)
    out, books = vectors.encode(spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA), 2, 32, 4)
    by_id = {}
    for i, v, *_ in rows:
        by_id.setdefault(i, []).append(v)
    for r in vectors.reconstruct(out, books).collect():
        assert r["error"] in [sum(round(math.floor(1024 * a) - 1024 * b) ** 2 for a, b in zip(v, r["vector"], strict=True)) for v in by_id[r["vec_id"]]]
    got = vectors.label_errors(out).collect()
    total = {}
    for r in got:
        total[r["label"]] = total.get(r["label"], 0) + r["error"]
    assert all(r["label_error"] == total[r["label"]] for r in got) and None in total


def test_empty_table_and_no_whole_vector(spark):
    for rows in ([], [(1, None, 1, "x", 5), (2, [math.nan], 1, "x", 5)]):
        out, books = vectors.encode(spark.createDataFrame(rows, SCHEMA))
        assert out.collect() == [] and books == []
        assert vectors.label_errors(out).columns == ["vec_id", "label", "codes", "error", "label_error"]


def test_query_against_sql(spark):
    assert same(spark, "/root/testdata/sf0.01", queries.queries()["op12_vectors"], queries.oracle_sql()["op12_vectors"]) == 500

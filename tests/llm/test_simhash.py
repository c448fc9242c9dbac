import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from trackframe.llm import simhash as s
from trackframe.llm.components import connected_components


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    h = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aBé \n\t\x1c\xa0日Z")), max_size=60))
def test_fingerprint(text):
    assert s.fingerprint(text) == brute_fingerprint(text)


def roots(n, pairs):
    root = list(range(n))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def clusters(rng, n, spread):
    out = set()
    while len(out) < n:
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 40])):
            x = c
            for _ in range(rng.randrange(spread)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return np.array(sorted(out), np.uint64)


def brute_roots(fps):
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    return roots(len(fps), np.argwhere(np.triu(d <= 2, 1)).tolist())


def test_local_links_are_exact():
    rng = random.Random(1)
    for spread in (2, 5, 12):
        fps = clusters(rng, 3000, spread)
        i, j = s.links(fps)
        assert (np.bitwise_count(fps[i] ^ fps[j]) <= 2).all()
        assert roots(len(fps), zip(i.tolist(), j.tolist())) == brute_roots(fps)


def test_one_ball_of_fingerprints():
    fps = np.unique(np.array([0] + [(1 << i) | (1 << j) for i in range(64) for j in range(i + 1)], np.uint64))
    u, v = s.stars(fps)
    assert len(u) == len(fps) - 1 and set(v.tolist()) == {0}


def test_dealt_shards_keep_every_pair():
    rng = random.Random(4)
    fps = clusters(rng, 4000, 6)
    tree = s.Tree(fps[::3], 12)
    assert tree.leaves > 4
    shard, f = tree.deal(fps)
    met = set()
    for k in range(tree.leaves):
        some = np.sort(f[shard == k])
        i, j = np.nonzero(np.triu(np.bitwise_count(some[:, None] ^ some[None, :]) <= 2, 1))
        met |= set(zip(some[i].tolist(), some[j].tolist()))
    i, j = np.nonzero(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2, 1))
    assert met == set(zip(fps[i].tolist(), fps[j].tolist()))


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 90), (90, 95), (7, 7), (200, 199), (199, 200)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long"))
    want = {i: 0 for i in range(61)} | {100: 90, 90: 90, 95: 90, 200: 199, 199: 199}
    assert {r["id"]: r["root"] for r in got.collect()} == want


def test_near_duplicates(spark):
    rng = random.Random(6)
    words = [rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(300):
        t = rng.choice(rows)[1] if rows and rng.random() < 0.5 else text(rng.choice([1, 2, 3, 50, 300]))
        if t and rng.random() < 0.4:
            w = t.split()
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        rows.append((1000 - i, t, "x"))
    rows += [(2, None, "x"), (1, "", "x"), (3, " \n", "x"), (3, " \n", "x"), (None, rows[0][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted([tuple(r) for r in s.near_duplicates(docs, shard=20).collect()], key=str)
    split = sorted([tuple(r) for r in s.near_duplicates(docs, shard=20, large=8).collect()], key=str)  # shards that stay large
    fps = [brute_fingerprint(r[1]) for r in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    least = {k: min(r[0] for r, x in zip(rows, root) if x == k and r[0] is not None) for k in set(root)}
    want = sorted([(r[0], int(np.uint64(f).view(np.int64)), least[k]) for r, f, k in zip(rows, fps, root)], key=str)
    assert got == split == want
    assert s.near_duplicates(docs.limit(0)).count() == 0

"""SimHash near-duplicates through vantage-point trees.

A tree over a bounded sample of fingerprints deals all fingerprints to shards: a node sends those within a distance of
its vantage point inwards and the rest outwards. By the triangle inequality two fingerprints that differ in 2 bits can
part only if the inner one lies within 2 of the boundary, so these are copied outwards as well, and every pair meets in a
shard. In a shard, a tree of its own goes on dividing until its leaves are small enough to compare all of them. A shard
that stays large is a dense ball, which no vantage point parts: its fingerprints meet in groups that share a one-bit
variant instead, over all tasks. Links are contracted to stars in each shard; their connected components are found by
Spark joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, written
from .components import connected_components

BITS, RADIUS, SHINGLE, SEED = 64, 2, 3, 42
#: Most sampled fingerprints that the dealing tree is built of (8 MB), those for each shard, fingerprints aimed at in a
#: shard, and most shards.
SAMPLE, EACH, SHARD, MOST_SHARDS = 1 << 20, 32, 2048, 1 << 15
#: Fingerprints of a shard, copies included, above which it is not one task's.
LARGE = 1 << 18
#: Fingerprints that are dealt at once.
DEALT = 1 << 16
#: Fingerprints of a leaf whose pairs are all compared.
LEAF = 256


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; of none: 0."""
    if not len(h):
        return 0
    counts = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of all shingles (of so many words) of a text, lower-cased in A-Z, by XXH64; a text without words: 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes split at ASCII white space
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) < shingle:
        return xxh64_intdigest(whole, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return majority(np.array([xxh64_intdigest(whole[a:b], SEED) for a, b in spans], "<u8"))


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def _choose(some: np.ndarray, tries: int = 12) -> tuple[np.uint64, int] | None:
    """A vantage point and boundary with few members to copy and neither side small; None: the members can't be parted."""
    best, found = 0.75, None
    for vp in some[np.linspace(0, len(some) - 1, tries).astype(np.int64)]:
        n = np.bincount(_distance(some, vp), minlength=BITS + 1)
        inside = np.cumsum(n) / len(some)
        for b in np.flatnonzero((inside >= 0.2) & (inside <= 0.8)):
            copied = n[max(b - RADIUS + 1, 0) : b + 1].sum() / len(some)
            larger = max(inside[b], 1 - inside[b] + copied)
            cost = larger + 0.5 * copied
            if larger < 0.95 and (found is None or cost < best):
                best, found = cost, (vp, int(b))
    return found


class Tree:
    """Vantage points and boundaries; leaves are numbered."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.nodes: list = []
        self.leaves = 0
        self.root = self._grow(np.unique(sample), leaves)

    def _grow(self, some: np.ndarray, leaves: float):
        found = _choose(some[:: max(1, len(some) // 4096)]) if leaves > 1 and len(some) > 16 else None
        if found is None:
            self.leaves += 1
            return -self.leaves
        vp, b = found
        d = _distance(some, vp)
        inner, outer = some[d <= b], some[d > b - RADIUS]
        at = len(self.nodes)
        self.nodes.append(None)
        share = len(inner) / (len(inner) + len(outer))
        self.nodes[at] = (vp, b, self._grow(inner, leaves * share), self._grow(outer, leaves * (1 - share)))
        return at

    def deal(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shard, fingerprint), copies included."""
        shards, out, todo = [], [], [(self.root, fps)]
        while todo:
            at, some = todo.pop()
            if not len(some):
                continue
            if at < 0:
                shards.append(np.full(len(some), -at - 1, np.int32))
                out.append(some)
                continue
            vp, b, inner, outer = self.nodes[at]
            d = _distance(some, vp)
            todo += [(inner, some[d <= b]), (outer, some[d > b - RADIUS])]
        return np.concatenate(shards or [np.zeros(0, np.int32)]), np.concatenate(out or [fps])


def variants(fps: np.ndarray) -> np.ndarray:
    """Each fingerprint and those that differ from it in one bit: links of 2 bits share one, and 65 at most share any."""
    return np.concatenate([fps[:, None], fps[:, None] ^ (np.uint64(1) << np.arange(BITS, dtype=np.uint64))], axis=1)


def links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in fps, which are distinct) that connect what differs in RADIUS bits or fewer, by a tree of its own."""
    left, right, todo = [], [], [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) <= LEAF:
            i, j = np.nonzero(np.triu(np.bitwise_count(fps[at][:, None] ^ fps[at][None, :]) <= RADIUS, 1))
            left.append(at[i])
            right.append(at[j])
            continue
        found = _choose(fps[at[:: max(1, len(at) // 1024)]], 6)
        if found is None:  # one ball: members of a group that share a variant are all linked
            flat = variants(fps[at])
            order = np.argsort(flat, axis=None)
            values, owner = flat.ravel()[order], at[order // flat.shape[1]]
            same = np.flatnonzero(values[1:] == values[:-1])
            left.append(owner[same])
            right.append(owner[same + 1])
            continue
        vp, b = found
        d = _distance(fps[at], vp)
        todo += [at[d <= b], at[d > b - RADIUS]]
    return np.concatenate(left), np.concatenate(right)


def stars(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) for the components of a shard that have two members or more."""
    i, j = links(fps)
    root = np.arange(len(fps))
    while True:
        m = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == root).all():
            at = np.flatnonzero(root != np.arange(len(fps)))
            return fps[at], fps[root[at]]
        root = new


def linked(fps: DataFrame, shard: int = SHARD, sample: int = SAMPLE, most_shards: int = MOST_SHARDS, large: int = LARGE) -> DataFrame:
    """fps: fp (distinct longs) -> u, v: edges whose components are those of all links."""
    leaves = min(most_shards, -(-fps.count() // shard))
    # a bounded sample fits the tree; every fingerprint is dealt through it, and its copies make it exact
    picked = fps.orderBy(F.xxhash64("fp")).limit(min(sample, max(EACH * leaves, 1 << 12))).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    tree = fps.sparkSession.sparkContext.broadcast(Tree(picked, leaves))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        for b in chain(batches, [None]):
            if b is not None:
                held.append(b["fp"].to_numpy(np.int64).view(np.uint64))
            if held and (b is None or sum(map(len, held)) >= DEALT):
                s, f = tree.value.deal(np.concatenate(held))
                held = []
                yield pd.DataFrame({"shard": s, "fp": f.view(np.int64)})

    def join(part: pd.DataFrame) -> pd.DataFrame:
        u, v = stars(np.unique(part["fp"].to_numpy(np.int64).view(np.uint64)))
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    def vary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            f = b["fp"].to_numpy(np.int64).view(np.uint64)
            yield pd.DataFrame({"variant": variants(f).ravel().view(np.int64), "fp": np.repeat(f.view(np.int64), BITS + 1)})

    dealt = written(fps.mapInPandas(deal, "shard int, fp long"))
    sizes = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > large)
    balls = sorted(r["shard"] for r in sizes.collect())  # most_shards rows at most
    if not balls:
        return dealt.groupBy("shard").applyInPandas(join, "u long, v long")
    held = fps.sparkSession.createDataFrame([(k,) for k in balls], "shard int")
    varied = written(dealt.join(F.broadcast(held), "shard").select("fp").distinct().mapInPandas(vary, "variant long, fp long"))
    least = written(varied.groupBy("variant").agg(F.min("fp").alias("v"), F.max("fp").alias("most")).where("v < most").select("variant", "v"))
    apart = dealt.join(F.broadcast(held), "shard", "left_anti").groupBy("shard").applyInPandas(join, "u long, v long")
    return apart.union(varied.join(least, "variant").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, **how) -> DataFrame:
    """doc_id, fp (long), component_id for each row of docs.

    component_id is the least doc_id (nulls apart) that links of fingerprints reach. Null and empty texts have
    fingerprint 0 and are linked like any other; rows that repeat a doc_id belong to the components of their texts.
    Exact copies are one fingerprint, so groups of copies of any size make no pairs. `jaccard.one_of_each` keeps one
    document of each group.
    """

    def make():
        def compute(texts: list) -> Iterator[tuple]:
            for t in texts:
                yield (int(np.uint64(fingerprint(t, shingle)).view(np.int64)),)

        return compute

    of_doc = written(map_texts(docs.select("doc_id", "text"), make, [T.StructField("fp", T.LongType())], ["doc_id"]))
    fps = written(of_doc.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = connected_components(linked(fps.select("fp"), **how))
    named = fps.join(roots.withColumnRenamed("id", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return of_doc.join(of_fp, "fp").select("doc_id", "fp", "component_id")

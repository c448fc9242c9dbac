"""One document of each group of near-duplicates, by the exact Jaccard similarity of five-word shingles.

A text is the set of its SHINGLE-word shingles, and texts whose sets have a similarity of 4/5 or more are linked.
Candidates come from two sides. The vantage-point trees of `simhash` connect the texts whose fingerprints (of the same
shingles) differ in 2 bits or fewer. Pairs at a similarity of 4/5 mostly differ in more, further than such a tree can
prune, so prefixes complete them: in any order of all shingles, two sets of similarity 4/5 or more share one of the
leading n - ceil(4/5 n) + 1 shingles of each, so no pair is missed. The order puts shingles that a sample shows to be
common last. Candidates pass a filter of bitmaps, which bounds their overlap from above, and then are compared exactly.
First come those with the least and the greatest set of each shared shingle, and then, of all others, the pairs that are
not yet connected: each set with the one that it can overlap most before the rest, so that large groups of near copies
are connected by few comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .common import Scratch, checkpointed, columns, fresh, give_back, map_texts, row_key
from .components import connected_components
from .shingles import SEED, hasher

SHINGLE = 5
#: The least similarity of a link, as a fraction.
NUM, DEN = 4, 5
#: Sets that show which shingles are common, the sets of the sample that make one common, and most common shingles.
SAMPLE, COMMON, MOST_COMMON = 4096, 3, 1 << 18
#: Sets of the sample for each part that the sets of a very common shingle are dealt to.
PART = 16
#: Least bits of a set's bitmap; it has 2 to 4 for each shingle.
BITMAP = 1024
#: log2 of the most bits that mark the rows whose sets are compared: 16 MB.
MARKS = 27
#: Sets of a shared shingle up to which all their pairs are made; above, they are compared by blocks of so many.
PAIRED, BLOCK = 32, 2048
#: Rows of a block that are compared at once.
STRIP = 128
#: Sets that a task remembers to have seen.
CACHE = 1 << 18


def prefix_size(n: int) -> int:
    return n - -(-NUM * n // DEN) + 1


def _sid(s: np.ndarray, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(s.tobytes(), seed)).view(np.int64))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bits (in 64-bit words) of a set's hashes, by their lowest bits: a power of 2 that grows with the set."""
    size = max(BITMAP, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The bitmap of the same set with fewer words."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def most_overlap(a: bytes, b: bytes, total: int) -> int:
    """A bound of the overlap of two sets: a bit on which their bitmaps differ is an element that they do not share."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    n = min(len(x), len(y))
    return (total - int(np.bitwise_count(folded(x, n) ^ folded(y, n)).sum())) // 2


def _rows(docs: DataFrame) -> DataFrame:
    """key (of the row), doc_id, sid and sid2 (of the set), n, fp (SimHash of the shingles) and bits (of the set) for each row."""

    def make():
        shingles = hasher(SHINGLE)

        def compute(texts: list) -> Iterator[tuple]:
            for t in texts:
                h = shingles(t)
                s = np.unique(h)
                yield _sid(s), _sid(s, SEED + 1), len(s), int(np.uint64(simhash.majority(h)).view(np.int64)), bitmap(s).tobytes()

        return compute

    fields = [T.StructField(c, T.LongType()) for c in ("sid", "sid2", "n", "fp")] + [T.StructField("bits", T.BinaryType())]
    return map_texts(docs.select(row_key().alias("key"), "doc_id", "text"), make, fields, ["key", "doc_id"])


def _marked(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key, sid and shingles (bytes) of the rows that have one of the keys, and of few others.

    A bitmap of fixed size picks the rows, so that the rest need neither be shuffled nor hashed.
    """
    n = keys.count()
    log = min(max(n, 1).bit_length() + 5, MARKS)
    place = F.conv(F.substring(F.hex("key"), 1, 12), 16, 10).cast("long").bitwiseAND(F.lit((1 << log) - 1))
    words = np.zeros(max(1 << (log - 6), 1), np.int64)
    marks = keys.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("bits"))
    found = marks.toPandas()  # 2^(MARKS - 6) rows at most
    words[found["w"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    held = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = hasher(SHINGLE)
        for b in batches:
            p = b.column("p").to_numpy()
            b = b.filter(pa.array((held.value[p >> 6] >> (p & 63) & 1).astype(bool)))
            sets = [np.unique(shingles(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([_sid(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "sid", "shingles"])
        give_back()

    keyed = docs.select(row_key().alias("key"), "text")
    return keyed.select("key", place.alias("p"), "text").mapInArrow(run, "key binary, sid long, shingles binary")


def _common(docs: DataFrame, sets: DataFrame) -> dict[int, int]:
    """The shingles that COMMON sets of the sample hold, or more, with their number."""
    # the sample is the sets whose ids hash lowest
    keys = sets.select("key", F.xxhash64("sid").alias("o")).orderBy("o", "key").limit(SAMPLE).select("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.frombuffer(b"".join(b.column("shingles").to_pylist()), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(flat)], names=["h"])

    some = _marked(docs, keys).join(F.broadcast(checkpointed(keys)), "key", "left_semi").dropDuplicates(["sid"])
    counts = some.select("shingles").mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= COMMON)
    top = counts.orderBy(F.desc("c"), "h").limit(MOST_COMMON).toPandas()
    return dict(zip(top["h"].tolist(), top["c"].tolist(), strict=True))


def _prefixes(docs: DataFrame, common: dict[int, int]) -> DataFrame:
    """h, part, sid, n, at: the prefix of each set, common shingles (by count) last. part: 0, or that of a very common one."""
    ks = np.array(sorted(common), np.int64)
    held = docs.sparkSession.sparkContext.broadcast((ks, np.array([common[k] for k in ks.tolist()], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = hasher(SHINGLE), set()
        ks, counts = held.value
        for b in batches:
            sids, sizes, hs, parts = [], [], [], []
            for t in b.column("text").to_pylist():
                s = np.unique(shingles(t))
                if not len(s) or (sid := _sid(s)) in seen:
                    continue
                seen.add(sid)
                s = s.view(np.int64)
                c = np.zeros(len(s), np.int64)
                if len(ks):
                    at = np.minimum(np.searchsorted(ks, s), len(ks) - 1)
                    c = np.where(ks[at] == s, counts[at], 0)
                    order = np.lexsort((s, c))
                    s, c = s[order], c[order]
                p = prefix_size(len(s))
                hs.append(s[:p])
                parts.append(np.where(c[:p] > PART, 1 + sid % (1 + c[:p] // PART), 0))
                sids.append(sid)
                sizes.append((len(s), p))
            if len(seen) > CACHE:  # sets that come again are told apart later, too
                seen.clear()
            if not sids:
                continue
            ps = np.array([p for _, p in sizes])
            cols = [np.concatenate(hs), np.concatenate(parts), np.repeat(sids, ps), np.repeat([n for n, _ in sizes], ps), np.concatenate([np.arange(p) for p in ps])]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cols], names=["h", "part", "sid", "n", "at"])
        seen.clear()
        give_back()

    return docs.select("text").mapInArrow(run, "h long, part long, sid long, n long, at long")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by h, part and sid -> those whose h several sets have, or that are part of a very common one; once each."""
    names = ["h", "part", "sid", "n", "at"]
    last = None  # the row before, and whether it has been given out
    for b in batches:
        if not b.num_rows:
            continue
        rows = np.stack([b.column(c).to_numpy() for c in names])
        out = np.zeros(0, bool)
        if last is not None:
            rows, out = np.concatenate([last[0], rows], axis=1), np.array([last[1]])
        out = np.pad(out, (0, rows.shape[1] - len(out)))
        new = np.r_[True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)]
        again = out[:1].copy()
        rows, out = rows[:, new], out[new]
        same = (rows[:2, 1:] == rows[:2, :-1]).all(axis=0)
        several = np.r_[same, False] | np.r_[False, same] | (rows[1] > 0)
        give = several & ~out
        last = rows[:, -1:], bool(several[-1] or (again.any() and rows.shape[1] == 1))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows[[0, 2, 3, 4]][:, give]], names=["h", "sid", "n", "at"])


def _filtered(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """u, v, bound: the pairs whose bitmaps do not rule the least similarity out, and the share that they can overlap."""
    held = sets.select("sid", "n", "bits")
    both = pairs.join(held.toDF("u", "n1", "b1"), "u").join(held.toDF("v", "n2", "b2"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            total = x.column("n1").to_numpy() + x.column("n2").to_numpy()
            overlap = np.array([most_overlap(a, b, t) for a, b, t in zip(x.column("b1").to_pylist(), x.column("b2").to_pylist(), total.tolist(), strict=True)], np.int64)
            overlap = np.minimum(overlap, np.minimum(x.column("n1").to_numpy(), x.column("n2").to_numpy()))
            rows = pa.RecordBatch.from_arrays([x.column("u"), x.column("v"), pa.array(overlap / np.maximum(total, 1))], names=["u", "v", "bound"])
            yield rows.filter(pa.array((NUM + DEN) * overlap >= NUM * total))

    return both.select("u", "v", "n1", "n2", "b1", "b2").mapInArrow(run, "u long, v long, bound double")


def _similar(pairs: DataFrame, sets: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (u, v) whose sets have the least similarity or more."""
    keys = scratch.written(pairs.select(F.col("u").alias("sid")).union(pairs.select("v")).distinct().join(sets.select("sid", "key"), "sid").select("key"))
    held = scratch.written(_marked(docs, keys).join(keys, "key", "left_semi").dropDuplicates(["sid"]).select("sid", "shingles"))
    both = pairs.join(held.toDF("u", "a"), "u").join(held.toDF("v", "b"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            a, b = ([np.frombuffer(d, "<u8") for d in x.column(c).to_pylist()] for c in ("a", "b"))
            ok = [(NUM + DEN) * len(np.intersect1d(i, j, assume_unique=True)) >= NUM * (len(i) + len(j)) for i, j in zip(a, b, strict=True)]
            yield x.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
        give_back()

    return scratch.written(both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long"))


def _pairs(a: DataFrame, b: DataFrame, also: Column | None = None) -> DataFrame:
    """u, v: pairs of sets that meet at h and can be similar if h is the first shingle that they share."""
    overlap = F.least(F.col("n1") - F.col("at1"), F.col("n2") - F.col("at2"))  # at most
    close = (F.col("sid1") != F.col("sid2")) & ((NUM + DEN) * overlap >= NUM * (F.col("n1") + F.col("n2")))
    met = a.join(b, (F.col("h1") == F.col("h2")) & (close if also is None else close & also))
    return met.select(F.least("sid1", "sid2").alias("u"), F.greatest("sid1", "sid2").alias("v")).distinct()


def _in_blocks(named: DataFrame, sets: DataFrame, best: bool) -> DataFrame:
    """h, sid, root, many (sets of h) -> u, v: pairs with different roots whose bitmaps allow the least similarity.

    The sets of a shingle are dealt to blocks, and each pair of blocks meets in a task, which compares the bitmaps and
    gives out what passes: no row is made for any other pair. best: for each set only the pair of the largest bound.
    """
    blocks = F.ceil(F.col("many") / BLOCK)
    own = F.pmod(F.xxhash64("sid"), blocks)
    dealt = named.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sid", "root").join(sets.select("sid", "n", "bits"), "sid")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        i, j = part["i"].iloc[0], part["j"].iloc[0]
        both = [part if i == j else part[part["own"] == k] for k in (i, j)]
        if not len(both[0]) or not len(both[1]):
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        (sa, ra, na), (sb, rb, nb) = ([x[c].to_numpy(np.int64) for c in ("sid", "root", "n")] for x in both)
        a, b = (np.stack([folded(np.frombuffer(d, np.uint64), BITMAP // 64) for d in x["bits"]]) for x in both)
        us, vs = [], []
        top, above = np.full(len(sb), -1.0), np.zeros(len(sb), np.int64)  # of each column: the largest bound, and its row
        for at in range(0, len(sa), STRIP):
            k = slice(at, at + STRIP)
            total = na[k, None] + nb[None, :]
            apart = sum(np.bitwise_count(a[k, w, None] ^ b[None, :, w]).astype(np.int64) for w in range(BITMAP // 64))
            overlap = np.minimum((total - apart) // 2, np.minimum(na[k, None], nb[None, :]))
            passes = ((NUM + DEN) * overlap >= NUM * total) & (ra[k, None] != rb[None, :])
            if best:
                bound = np.where(passes, overlap / total, -1.0)
                x = np.flatnonzero(passes.any(axis=1))
                y = bound[x].argmax(axis=1)
                more = bound.max(axis=0) > top
                top, above = np.where(more, bound.max(axis=0), top), np.where(more, at + bound.argmax(axis=0), above)
            else:
                x, y = np.nonzero(passes)
            us.append(sa[k][x])
            vs.append(sb[y])
        if best:
            y = np.flatnonzero(top >= 0)
            us.append(sa[above[y]])
            vs.append(sb[y])
        u, v = np.concatenate(us), np.concatenate(vs)
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)}).drop_duplicates()

    return dealt.groupBy("h", "i", "j").applyInPandas(compare, "u long, v long")


def _by_fingerprint(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """u, v: pairs that connect the sets whose fingerprints differ in 2 bits or fewer, one at most for each set twice over."""
    named = sets.groupBy("fp").agg(F.min("sid").alias("rep"))
    named = scratch.written(named)
    links = simhash.linked(named.select("fp"))
    near = links.join(named.toDF("u", "a"), "u").join(named.toDF("v", "b"), "v").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    return near.union(sets.select("sid", "fp").join(named, "fp").where("sid <> rep").select(F.col("rep").alias("u"), F.col("sid").alias("v")))


def _open(shared: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """h, sid, n, at, root, many: the sets of the shingles that sets of different components share."""
    named = shared.join(roots.toDF("sid", "root"), "sid", "left").select("h", "sid", "n", "at", F.coalesce("root", "sid").alias("root"))
    open_ = named.groupBy("h").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("many")).where("a < b").select("h", "many")
    return scratch.written(named.join(open_, "h"))


def linked(docs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """docs: doc_id, text; sets: sid, key, n, fp, bits, a row a set -> u, v: edges whose components are those of all links."""
    prefixes = _prefixes(docs, _common(docs, sets))
    # dealt once: what is alone goes, which is most of it
    shared = scratch.written(prefixes.repartition("h", "part").sortWithinPartitions("h", "part", "sid").mapInArrow(_shared, "h long, sid long, n long, at long"))
    member = F.struct("sid", "n", "at")
    hubs = shared.groupBy("h").agg(F.array(F.min(member), F.max(member)).alias("hubs")).select("h", F.inline("hubs")).distinct()
    first = _pairs(shared.toDF(*[c + "1" for c in shared.columns]), hubs.toDF("h2", "sid2", "n2", "at2"))
    first = scratch.written(_filtered(first.union(_by_fingerprint(sets, scratch)).distinct(), sets))
    edges = _similar(first, sets, docs, scratch)

    # of what is left, first the best partner of each set; then all pairs that are still apart
    named = _open(shared, connected_components(edges), scratch)
    few = named.where(F.col("many") <= PAIRED).drop("many")
    a, b = (few.toDF(*[c + k for c in few.columns]) for k in "12")
    pairs = _pairs(a, b, F.col("root1") < F.col("root2")).union(_in_blocks(named.where(F.col("many") > PAIRED), sets, True)).distinct()
    pairs = scratch.written(_filtered(pairs.join(first, ["u", "v"], "left_anti"), sets))
    best = pairs.union(pairs.select("v", "u", "bound")).groupBy("u").agg(F.max(F.struct("bound", "v"))["v"].alias("v"))
    best = scratch.written(best.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    if best.isEmpty():
        return edges
    edges = scratch.written(edges.union(_similar(best, sets, docs, scratch)))
    roots = connected_components(edges)
    named = _open(shared, roots, scratch)
    left = pairs.select("u", "v").union(_in_blocks(named.where(F.col("many") > PAIRED), sets, False)).distinct()
    left = left.join(first, ["u", "v"], "left_anti").join(best, ["u", "v"], "left_anti")
    left = left.join(roots.toDF("u", "ru"), "u", "left").join(roots.toDF("v", "rv"), "v", "left").where(F.coalesce("ru", "u") != F.coalesce("rv", "v"))
    left = scratch.written(_filtered(left.select("u", "v"), sets))
    return edges if left.isEmpty() else edges.union(_similar(left, sets, docs, scratch))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each component of links: that of the least doc_id, rows without id last, then by text.

    Texts without words are one group. Rows that share a doc_id are judged apart, each by its text; columns besides
    doc_id and text play no part, whatever their names; doc_id may be of any type with an order. Sets and rows are told
    apart by 128 bits of hashes. Links name a set by 64 of them: of unlike sets that share these (some 70 of 5 x 10^10),
    one takes part in links, and the others stay, linked to none.
    """
    scratch = Scratch()
    plain = docs.select("doc_id", "text")
    rows = scratch.written(_rows(plain))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    # of equal sets first, so that large groups of copies are summed up before they are joined
    sets = rows.groupBy("sid", "sid2").agg(F.min(order).alias("first"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("bits").alias("bits"))
    sets = scratch.written(sets.select("sid", "sid2", "first", F.col("first.key").alias("key"), "n", "fp", "bits"))
    namesakes = scratch.written(sets.groupBy("sid").agg(F.min("sid2").alias("one"), F.count(F.lit(1)).alias("many")).where("many > 1").drop("many"))
    (key,) = fresh(docs, "_key")
    apart = F.when(F.col("sid2") != F.col("one"), F.col("sid2"))  # null: the set that goes by its sid
    named = sets.select("sid", "sid2", "first").join(namesakes, "sid", "left").select("sid", "first", apart.alias("apart"))
    linking = sets if namesakes.isEmpty() else scratch.written(sets.join(namesakes, "sid", "left").where("one is null or sid2 = one").drop("one"))
    roots = checkpointed(connected_components(linked(plain, linking.drop("sid2"), scratch)).withColumnRenamed("id", "sid"))
    root = F.when(F.col("apart").isNull(), F.coalesce("root", "sid")).otherwise(F.col("sid"))
    least = checkpointed(named.join(roots, "sid", "left").groupBy(root.alias("root"), "apart").agg(F.min("first")["key"].alias(key)).select(key))
    scratch.clear()
    kept = docs.withColumn(key, row_key()).join(least, key)
    return kept.dropDuplicates([key]).select(*columns(docs.columns))

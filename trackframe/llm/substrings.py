"""Exact substring dedup over a sparse suffix array.

Every LENGTH-byte window of a text has an anchor: of the suffixes that start in it and have KMER bytes in it, the one
whose leading bytes hash lowest. Equal windows have equal anchors at equal places, so it is enough to sort the anchors'
suffixes. These are range-partitioned by sampled splitters, by their leading 8 bytes and then the hash of the leading 32,
sorted within the buckets, and compared with their neighbours, across the boundaries of buckets too:

1. Anchors that stand for the same stretch of windows in the same context: all but the first lose the whole stretch.
2. Anchors with equal leading bytes in different contexts share some windows only: their contexts are fetched, and the
   windows in them sorted and compared one by one.

A suffix is 40 bytes here (its leading bytes, their hash, hash of its context, document, place), whatever its length.
What is removed is equal in 128 bits of hashes: two of 64 bits each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

LENGTH, KMER = 100, 32
#: Bytes of text that are hashed at once; longer texts are cut into overlapping stretches of so many windows.
CHUNK = 1 << 21
#: Contexts with the same leading bytes that are compared in one task; windows of larger groups are dealt by their hash.
GROUP = 2048
#: Contexts of large groups whose windows a task makes at once: some 70 each.
PART = 512
#: Contexts that a task holds at once, with the groups they complete.
HELD = 20_000
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
M3, M4 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
PLACE = np.uint64((1 << 31) - 1)


def mix(a: np.ndarray, b: np.ndarray, m1: np.uint64 = M1, m2: np.uint64 = M2) -> np.ndarray:
    """A 64-bit hash of two, in that order."""
    a = a * m1
    a ^= a >> np.uint64(29)
    a += b
    a *= m2
    a ^= a >> np.uint64(32)
    return a


def leading(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, the first the lowest."""
    x = data.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << np.uint64(8 * k))
    return x


def kmer_hashes(data: np.ndarray, m1: np.uint64 = M1, m2: np.uint64 = M2) -> np.ndarray:
    """The hash of the KMER bytes from each place on."""
    x = leading(data)
    for k in (8, 16):
        x = mix(x[:-k], x[k:], m1, m2)
    return x


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, leading bytes in their order, k-mer hash, context hash, place) of the anchors of some texts.

    place: the anchor's place << 16 | bytes before it to its first window << 8 | bytes before it to its last window.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    buf = np.frombuffer(b"".join(texts) + b"\0" * LENGTH, np.uint8)
    ends = np.cumsum(sizes)
    n = np.maximum(sizes - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(texts)), n)
    at = np.repeat(ends - sizes, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)  # window starts
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    h = kmer_hashes(buf)
    low = sliding_min((h & ~PLACE) | np.arange(len(h), dtype=np.uint64), LENGTH - KMER + 1)
    anchor = (low[at] & PLACE).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    first, last, anchor, text = at[new], at[np.r_[new[1:] - 1, len(at) - 1]], anchor[new], text[new]
    context, end = h[first], last + LENGTH
    for x in (first + KMER, first + 2 * KMER, end - 3 * KMER, end - 2 * KMER, end - KMER):  # 192 bytes; a context has 168 at most
        context = mix(context, h[x])
    before, after = anchor - first, anchor - last
    context = mix(context, (before << 8 | after).astype(np.uint64))
    place = (anchor - (ends - sizes)[text]) << 16 | before << 8 | after
    lead = (leading(buf)[anchor].byteswap() ^ np.uint64(1 << 63)).view(np.int64)  # signed numbers in the order of the bytes
    return text, lead, h[anchor].view(np.int64), context.view(np.int64), place


def _pieces(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Chunks of (row, offset in its text, bytes)."""
    rows, offsets, parts, size = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(len(t or b"") - LENGTH + 1, 0), CHUNK):
            parts.append(t[a : a + CHUNK + LENGTH - 1])
            rows.append(i)
            offsets.append(a)
            size += len(parts[-1])
            if size >= CHUNK:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
    if parts:
        yield rows, offsets, parts


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("d").to_numpy()
        for rows, offsets, parts in _pieces(b.column("text").to_pylist()):
            text, lead, h, c, place = anchors(parts)
            place = place + (np.array(offsets, np.int64)[text] << 16)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lead, h, c, ids[np.array(rows)[text]], place)], names=["lead", "h", "c", "d", "place"])


REPEAT, PARTIAL, EDGE = 0, 1, 2


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes -> REPEAT: not the first of its context; PARTIAL: first of a context, its leading bytes have others
    too; EDGE: the same question at the ends of a bucket, where the neighbouring bucket may have the answer."""

    def out(kind: int, rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(rows.shape[1], kind, np.int8)), *map(pa.array, rows)], names=["kind", "h", "c", "d", "place"])

    last, held, head = None, np.zeros((4, 0), np.int64), True
    for b in batches:
        if not b.num_rows:
            continue
        rows = np.stack([b.column(k).to_numpy() for k in ("h", "c", "d", "place")])
        before = rows[:2, :1] if last is None else last
        same = (rows[:2] == np.concatenate([before, rows[:2, :-1]], axis=1)).all(axis=0)
        same[0] &= last is not None
        last = rows[:2, -1:]
        yield out(REPEAT, rows[:, same])
        firsts = np.concatenate([held, rows[:, ~same]], axis=1)
        cuts = np.flatnonzero(np.diff(firsts[0])) + 1
        if not len(cuts):
            held = firsts
            continue
        if head:
            yield out(EDGE, firsts[:, : cuts[0]])
        whole = np.arange(cuts[0] if head else 0, cuts[-1])
        sizes = np.diff(np.concatenate([[] if head else [0], cuts]).astype(np.int64))
        yield out(PARTIAL, firsts[:, whole[np.repeat(sizes, sizes) > 1]])
        held, head = firsts[:, cuts[-1] :], False
    yield out(EDGE, held)


def windows_of(contexts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(context, offset, hash, another hash) of all LENGTH-byte windows of some contexts."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts) + b"\0" * LENGTH, np.uint8)
    n = sizes - LENGTH + 1
    which = np.repeat(np.arange(len(contexts)), n)
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = (np.cumsum(sizes) - sizes)[which] + offset
    out = []
    for m in ((M1, M2), (M3, M4)):
        h = kmer_hashes(data, *m)
        out.append(mix(mix(h[at], h[at + KMER], *m), mix(h[at + 2 * KMER], h[at + LENGTH - KMER], *m), *m))
    return which, offset, *out


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by leading bytes, document and place -> stretches (d, a, b) of windows that start earlier, too."""

    def done(h: np.ndarray, d: np.ndarray, a: np.ndarray, data: list[bytes]) -> pa.RecordBatch:
        which, offset, w, w2 = windows_of(data)
        # equal windows lie at equal places about their anchor, so the order of anchors is that of windows
        order = np.lexsort((w2, w))
        again = np.zeros(len(w), bool)
        again[order[1:]] = (w[order[1:]] == w[order[:-1]]) & (w2[order[1:]] == w2[order[:-1]])
        key = (which << 8) + offset
        found = key[again]
        start = np.flatnonzero(np.r_[True, np.diff(found) != 1]) if len(found) else np.zeros(0, np.int64)
        end = np.r_[start[1:] - 1, len(found) - 1] if len(found) else start
        k, i, j = found[start] >> 8, found[start] & 255, found[end] & 255
        return pa.RecordBatch.from_arrays([pa.array(d[k]), pa.array(a[k] + i), pa.array(a[k] + j + LENGTH)], names=["d", "a", "b"])

    hs, ds, starts, data = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), []
    for b in batches:
        place = b.column("place").to_numpy()
        hs, ds = np.concatenate([hs, b.column("h").to_numpy()]), np.concatenate([ds, b.column("d").to_numpy()])
        starts = np.concatenate([starts, (place >> 16) - (place >> 8 & 255)])
        data += b.column("data").to_pylist()
        cut = int(np.searchsorted(hs, hs[-1])) if len(hs) else 0  # the last group may go on
        if cut >= HELD:
            yield done(hs[:cut], ds[:cut], starts[:cut], data[:cut])
            hs, ds, starts, data = hs[cut:], ds[cut:], starts[cut:], data[cut:]
    if len(hs):
        yield done(hs, ds, starts, data)


def _zipped(rows: DataFrame) -> DataFrame:
    """d and each text, compressed: texts are shuffled twice, and are the bulk of what is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("d"), pa.array([zip_(t or b"") for t in b.column("text").to_pylist()], pa.binary())], names=["d", "z"])

    return rows.select("d", "text").mapInArrow(run, "d long, z binary")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their partial anchors -> contexts; of large groups, windows (hashes in h and g)."""
    import zstandard

    unzip = zstandard.ZstdDecompressor().decompress
    names = ["large", "h", "g", "d", "place", "data"]
    for b in batches:
        small: list[tuple] = []
        large: list[tuple] = []
        for d, z, found in zip(b.column("d").to_pylist(), b.column("z").to_pylist(), b.column("found").to_pylist(), strict=True):
            text = unzip(z)
            for x in found:
                p, before, after = x["place"] >> 16, x["place"] >> 8 & 255, x["place"] & 255
                row = (x["h"], d, x["place"], text[p - before : p - after + LENGTH])
                (large if x["large"] else small).append(row)
        if small:
            h, d, place, data = zip(*small, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([False] * len(h)), pa.array(h, pa.int64()), pa.nulls(len(h), pa.int64()), pa.array(d, pa.int64()), pa.array(place, pa.int64()), pa.array(data, pa.binary())], names=names)
        for k in range(0, len(large), PART):
            h, d, place, data = zip(*large[k : k + PART], strict=True)
            which, offset, w, w2 = windows_of(list(data))
            place = np.array(place, np.int64)
            start = ((place >> 16) - (place >> 8 & 255))[which] + offset
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(w), bool)), pa.array(w.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.array(d, np.int64)[which]), pa.array(start), pa.nulls(len(w), pa.binary())], names=names)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unzip = zstandard.ZstdDecompressor().decompress
    for b in batches:
        rows = []
        for z, found in zip(b.column("z").to_pylist(), b.column("found").to_pylist(), strict=True):
            text, at, kept = unzip(z), 0, hashlib.sha256()
            spans = merge([(x["a"], x["b"]) for x in found or []])
            for a, e in spans:
                kept.update(text[at:a])
                at = e
            kept.update(text[at:])
            rows.append((len(text), sum(e - a for a, e in spans), len(spans), kept.hexdigest(), [a for a, _ in spans], [e for _, e in spans]))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([b.column("d"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["d", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])


def dedup_substrings(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the spans' starts and ends, a row for each row of docs.

    A byte goes if a 100-byte string over it starts earlier, too: in a smaller doc_id, or before in the same text. Null
    texts are empty; texts of under 100 bytes stay whole. doc_id may be of any type with an order. Rows that share a doc_id, or have none, are ordered by
    doc_id (null first) and a hash of the text, so of repeated rows the first stays; they are numbered in a table of their own.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    whole = isinstance(rows.schema["doc_id"].dataType, T.LongType | T.IntegerType | T.ShortType | T.ByteType)
    unique = whole and rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty()
    if unique:
        rows = rows.withColumn("d", F.col("doc_id").cast("long"))
    else:
        rows = rows.withColumn("o", F.xxhash64("text"))  # texts are no range keys: samples of these go to the driver
        rows = written(rows.repartitionByRange("doc_id", "o").sortWithinPartitions("doc_id", "o", "text").drop("o").withColumn("d", F.monotonically_increasing_id()))
    suffixes = rows.select("d", "text").mapInArrow(_suffixes, "lead long, h long, c long, d long, place long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    order = ("lead", "h", "c", "d", "place")
    dealt = suffixes.repartitionByRange(*order).sortWithinPartitions(*order).drop("lead")
    found = written(dealt.mapInArrow(_compare, "kind byte, h long, c long, d long, place long"))

    # what meets at the ends of buckets: for each bucket, the contexts of its first and last leading bytes
    edge = found.where(F.col("kind") == EDGE).select("h", "c", "d", "place")
    firsts = edge.groupBy("h", "c").agg(F.min(F.struct("d", "place")).alias("m")).select("h", "c", F.col("m.d").alias("d"), F.col("m.place").alias("place"))
    # what is joined below is written first: a join that deals its own rows can have its largest keys split
    shared = written(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    again = edge.join(firsts, ["h", "c", "d", "place"], "left_anti").select("d", "place")
    repeat = found.where(F.col("kind") == REPEAT).select("d", "place").union(again)
    partial = written(found.where(F.col("kind") == PARTIAL).select("h", "d", "place").union(firsts.join(shared, "h", "left_semi").select("h", "d", "place")))

    many = written(partial.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group).select("h", F.lit(True).alias("large")))
    of_doc = partial.join(many, "h", "left").groupBy("d").agg(F.collect_list(F.struct("h", "place", F.coalesce("large", F.lit(False)).alias("large"))).alias("found"))
    contexts = written(_zipped(rows).join(of_doc, "d").mapInArrow(_contexts, "large boolean, h long, g long, d long, place long, data binary"))
    small = contexts.where("not large").drop("g").repartition("h").sortWithinPartitions("h", "d", "place").mapInArrow(_resolve, "d long, a long, b long")
    windows = contexts.where("large").select("h", "g", "d", F.col("place").alias("a"))
    first = written(windows.groupBy("h", "g").agg(F.min(F.struct("d", "a")).alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "g", F.col("m.d").alias("d0"), F.col("m.a").alias("a0")))
    large = windows.join(first, ["h", "g"]).where((F.col("d") != F.col("d0")) | (F.col("a") != F.col("a0"))).select("d", "a", (F.col("a") + LENGTH).alias("b"))

    at, before, after = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
    spans = repeat.select("d", (at - before).alias("a"), (at - after + LENGTH).alias("b")).union(small).union(large)
    spans = spans.groupBy("d").agg(F.collect_list(F.struct("a", "b")).alias("found"))
    out = _zipped(rows).join(spans, "d", "left").mapInArrow(_removed, "d long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>")
    if unique:
        return out.withColumn("d", F.col("d").cast(docs.schema["doc_id"].dataType)).withColumnRenamed("d", "doc_id")
    return out.join(rows.select("d", "doc_id"), "d").select("doc_id", *[c for c in out.columns if c != "d"])

"""Dedup of repeated passages by recompression: windows of LENGTH words that also start in an earlier document go.

Recompression parses a text into symbols. Rounds take turns: one names runs of equal symbols, the next names pairs of a
left and a right symbol, where a hash of a symbol says which it is. Only symbols of few words take part (`limits`), so
whether a symbol starts at a word hangs on REACH words before and behind it, and on nothing else: what is alike in two
texts has the same symbols in its interior.

A name is a hash of the names it is made of, so it is the same in all tasks, and rounds of naming need no dictionary: one
narrow map makes them all. (Dictionaries would shuffle every word in every round.) What is shuffled is in three rounds:

1. Each window picks the interior symbol of least hash (REACH words from its ends or more). Windows in a row that pick
   the same symbol are one stretch, some 14 words apart: a row with its *key* (the symbol's name and the REACH words around
   it, which all of its windows hold) and its *context* (all of its words). Contexts that an earlier document holds are
   repeats as a whole. Equal windows have equal keys, so a key with one context has told all.
2. Keys with several contexts share some windows only. The windows of those contexts are named, and what an earlier
   document holds, too, is repeated.
3. Spans of repeats meet their texts.

Windows inside a long run have no interior symbol, and are stretches of their own. Keys are 64 bits wide and only bring
windows together; contexts and windows that are taken for equal agree in 128 bits of hashes, made from 128 bits a word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import long_, written
from .substrings import M1, M2, M3, M4, merge, mix

LENGTH = 50
#: Words whose symbols are made at once, bytes of text that are split at once, and words that a worker remembers.
CHUNK, SLICE, KNOWN = 1 << 17, 1 << 20, 200_000
SPACE = re.compile(rb"[\x20\x09-\x0D]")
RUN, SIDE = np.uint64(0x8CB92BA72F3D8DD7), 0x9FB21C651E98DF25
#: Low bits of a hash that give way to the symbol's place, to pick the least.
PLACE = np.uint64((1 << 24) - 1)


def limits(length: int) -> list[int]:
    """Words of a symbol that takes part, for each round (runs, pairs, runs, ...): a window keeps half its words for the interior."""
    out: list[int] = []
    while sum(out) + len(out) // 2 + 1 <= length // 4:
        out.append(len(out) // 2 + 1)
    return out


class Names(dict):
    """word -> 16 bytes that name it; forgets all when it is full."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KNOWN:
            self.clear()
        name = self[word] = hashlib.blake2b(word, digest_size=16).digest()
        return name


def slices(text: bytes) -> Iterator[list[bytes]]:
    """A text's words, split SLICE bytes at a time."""
    at = 0
    while at < len(text):
        to = at + SLICE
        if to < len(text):
            found = SPACE.search(text, to)
            to = found.start() if found else len(text)
        yield (text if at == 0 and to >= len(text) else text[at:to]).split()
        at = to


def symbols(words: np.ndarray, of: np.ndarray, rounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, name) of the symbols that the rounds make. of: each word's text; no symbol is in two."""
    name, start, size = words, np.arange(len(words)), np.ones(len(words), np.int64)
    for k, most in enumerate(rounds):
        active = size <= most
        if k % 2 == 0:
            goes_on = (name[1:] == name[:-1]) & active[1:] & active[:-1] & (of[1:] == of[:-1])
            if not goes_on.any():
                continue
            at = np.flatnonzero(np.concatenate([[True], ~goes_on]))
            times = np.diff(np.append(at, len(name)))
            name, size = name[at], size[at] * times
            many = np.flatnonzero(times > 1)
            name[many] = mix(name[many] ^ RUN, times[many].astype(np.uint64))
        else:
            right = (mix(name, np.uint64(SIDE * (k + 1) & (1 << 64) - 1)) >> np.uint64(63)).astype(bool)
            pair = active[1:] & active[:-1] & ~right[:-1] & right[1:] & (of[1:] == of[:-1])
            at = np.flatnonzero(np.concatenate([[True], ~pair]))
            made = np.flatnonzero(np.append(pair, False)[at])
            both = mix(name[at[made]], name[at[made] + 1])
            twice = size[at[made]] + size[at[made] + 1]
            name, size = name[at], size[at]
            name[made], size[made] = both, twice
        start, of = start[at], of[at]
    return start, name


def stretches(parts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(part, key, context, another hash of it, first window, windows) of some texts' words, given as names in a row."""
    rounds = limits(length)
    reach, wide = sum(rounds), 1 << (length.bit_length() - 1)
    sizes = np.array([len(p) // 16 for p in parts], np.int64)
    words = np.frombuffer(b"".join(parts), "<u8").reshape(-1, 2)
    n = np.maximum(sizes - length + 1, 0)
    part = np.repeat(np.arange(len(parts)), n)
    if not len(part):
        return (part,) * 6
    at = np.repeat(np.cumsum(sizes) - sizes, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)

    start, name = symbols(np.ascontiguousarray(words[:, 0]), np.repeat(np.arange(len(parts)), sizes), rounds)
    flags = np.zeros(len(words) + 2, np.int64)
    flags[start + 1] = 1
    flags[-1] = 1  # the last symbol's end
    before = np.cumsum(flags)  # symbols that start before each place
    low, high = before[at + reach], before[at + length - reach + 1] - 2
    least = [(mix(name, RUN) & ~PLACE) | np.arange(len(name), dtype=np.uint64)]  # of 1, 2, 4, ... symbols from each on
    while 1 << len(least) <= length - 2 * reach:
        x, span = least[-1], 1 << (len(least) - 1)
        least.append(np.append(np.minimum(x[:-span], x[span:]), x[-span:]) if len(x) > span else x)
    table, width = np.stack(least), high - low + 1
    inside = width > 0
    anchor = np.full(len(at), -1, np.int64)
    level = np.frexp(width[inside])[1] - 1
    a, b = table[level, low[inside]], table[level, high[inside] - (1 << level) + 1]
    anchor[inside] = (np.minimum(a, b) & PLACE).astype(np.int64)

    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]) | (anchor[1:] < 0)]))
    first, last, anchor = at[new], at[np.append(new[1:], len(at)) - 1], anchor[new]
    held = anchor >= 0
    s = start[anchor[held]]
    shape = np.full(len(new), 1 << 20, np.int64)
    shape[held] = (last - first)[held] << 32 | (s - first[held])
    contexts = []
    for c, m in ((0, (M1, M2)), (1, (M3, M4))):
        x, h = blocks(words[:, c], wide, *m), shape.astype(np.uint64)
        for place in (first, first + length - wide, last, last + length - wide):
            h = mix(h, x[place], *m)
        contexts.append(h.view(np.int64))
    key = contexts[0].copy()
    of_symbol = name[anchor[held]]
    if reach:
        around = 1 << ((2 * reach).bit_length() - 1)  # over REACH words, and no more than a window has about the symbol
        x, end = blocks(words[:, 0], around), np.append(start, len(words))[anchor[held] + 1]
        of_symbol = mix(mix(of_symbol, x[s - reach]), x[end + reach - around])
    key[held] = of_symbol.view(np.int64)
    return part[new], key, *contexts, first - (np.cumsum(sizes) - sizes)[part[new]], last - first + 1


def blocks(words: np.ndarray, many: int, m1: np.uint64 = M1, m2: np.uint64 = M2) -> np.ndarray:
    """A hash of the words, a power of two of them, from each on."""
    k = 1
    while k < many:
        words = mix(words[:-k], words[k:], m1, m2)
        k *= 2
    return words


def _pieces(texts: list[bytes | None], length: int, names: Names) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Chunks of (row, first word, names of words); pieces of a long text share length - 1 words."""
    rows, offsets, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        carry, offset = b"", 0
        for words in slices(text or b""):
            part = carry + b"".join(map(names.__getitem__, words))
            rows.append(i)
            offsets.append(offset)
            parts.append(part)
            n = len(part) // 16
            size += n
            keep = min(n, length - 1)
            carry, offset = part[(n - keep) * 16 :], offset + n - keep
            if size >= CHUNK:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
    if parts:
        yield rows, offsets, parts


def _zipped(rows: DataFrame) -> DataFrame:
    """rows with their texts compressed, for a shuffle."""

    @F.arrow_udf(T.BinaryType())
    def zipped(text: pa.Array) -> pa.Array:
        import zstandard

        zip_ = zstandard.ZstdCompressor(level=3, write_content_size=True).compress
        return pa.array([zip_(t or b"") for t in text.to_pylist()], pa.binary())

    return rows.withColumn("z", zipped("text")).drop("text")


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(r, doc_id, text) with a number for each row, and (r, o) where o is the order of doc_id; none if r itself is."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    whole = isinstance(rows.schema["doc_id"].dataType, T.LongType | T.IntegerType | T.ShortType | T.ByteType)
    if whole and rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").isEmpty():
        return rows.select(F.col("doc_id").cast("long").alias("r"), "doc_id", "text"), None
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = written(rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id").drop("h").withColumn("r", F.monotonically_increasing_id()))
    first = written(rows.groupBy("doc_id").agg(F.min("r").alias("o")))
    ids = written(rows.select("r", "doc_id"))
    order = ids.join(first.withColumnRenamed("doc_id", "of"), F.col("doc_id").eqNullSafe(F.col("of"))).select("r", "o")
    return rows.select("r", "doc_id", "text"), written(order)


def repeated_words(rows: DataFrame, order: DataFrame | None, length: int = LENGTH) -> DataFrame:
    """r, found: spans (a, b) of words, end exclusive, that windows starting in an earlier document, too, cover."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for b in batches:
            r = b.column("r").to_numpy()
            for held, offsets, parts in _pieces(b.column("text").to_pylist(), length, names):
                part, key, c1, c2, a, n = stretches(parts, length)
                a = a + np.array(offsets, np.int64)[part]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, c1, c2, r[np.array(held)[part]], a, n.astype(np.int32))], names=["k", "c1", "c2", "r", "a", "n"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip, names, wide = zstandard.ZstdDecompressor().decompress, Names(), 1 << (length.bit_length() - 1)
        for b in batches:
            for r, z, found in zip(b.column("r").to_pylist(), b.column("z").to_pylist(), b.column("found").to_pylist(), strict=True):
                wanted = np.sort(np.concatenate([np.arange(x["a"], x["a"] + x["n"]) for x in found]))
                for _, (offset,), (part,) in _one_by_one(_pieces([unzip(z)], length, names)):
                    words = np.frombuffer(part, "<u8").reshape(-1, 2)
                    at = wanted[(wanted >= offset) & (wanted <= offset + len(words) - length)] - offset
                    if len(at):
                        w = [mix(x[at], x[at + length - wide], *m).view(np.int64) for x, m in ((blocks(words[:, c], wide, *m), m) for c, m in ((0, (M1, M2)), (1, (M3, M4))))]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r, np.int64)), pa.array(at + offset), *map(pa.array, w)], names=["r", "a", "w1", "w2"])

    def ordered(found: DataFrame) -> DataFrame:
        return written(found.withColumn("o", F.col("r")) if order is None else found.join(order, "r"))

    # what is joined below is written first: a join that deals its own rows can have its largest keys split
    all_ = ordered(rows.select("r", "text").mapInArrow(parse, "k long, c1 long, c2 long, r long, a long, n int"))
    contexts = written(all_.groupBy("k", "c1", "c2").agg(F.min("o").alias("first"), F.max("o").alias("last")))
    keys = contexts.groupBy("k").agg(F.count(F.lit(1)).alias("many"), F.min("first").alias("first"), F.max("last").alias("last"))
    keys = written(keys.where("many > 1 and first < last").select("k", F.lit(True).alias("shared")))
    told = written(contexts.join(keys, "k", "left").where("first < last or shared").select("c1", "c2", "first", F.coalesce("shared", F.lit(False)).alias("shared")))
    told = written(all_.join(told, ["c1", "c2"]).where("o > first or shared").select("r", "a", "n", (F.col("o") > F.col("first")).alias("gone")))
    gone = told.where("gone").select("r", "a", (F.col("a") + F.col("n") + (length - 1)).alias("b"))

    partly = told.where("not gone").groupBy("r").agg(F.collect_list(F.struct("a", "n")).alias("found"))
    some = ordered(_zipped(rows.select("r", "text")).join(partly, "r").mapInArrow(windows, "r long, a long, w1 long, w2 long"))
    earliest = written(some.groupBy("w1", "w2").agg(F.min("o").alias("first"), F.max("o").alias("last")).where("first < last").drop("last"))
    again = some.join(earliest, ["w1", "w2"]).where("o > first").select("r", "a", (F.col("a") + length).alias("b"))
    return gone.union(again).groupBy("r").agg(F.collect_list(F.struct("a", "b")).alias("found"))


def _one_by_one(chunks: Iterator[tuple[list, list, list]]) -> Iterator[tuple[list, list, list]]:
    for rows, offsets, parts in chunks:
        for x in zip(rows, offsets, parts, strict=True):
            yield tuple([v] for v in x)


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, parted by a blank), starts and ends of the spans of words that go.

    A row for each row of docs. A word goes if a window of `length` words over it has all of its words in a row in a
    document of a smaller doc_id, too; windows are those of the texts as they come. doc_id may have any type with an
    order; null is the least. Rows that share a doc_id (or have none) are one document to this end: they lose nothing
    to one another. Null and empty texts have no words, texts of fewer than `length` words stay whole. Other columns
    play no part. Long texts are parsed in pieces; a row's spans meet in one task, and are no more than its words.
    """
    rows, order = _numbered(docs)
    spans = repeated_words(rows, order, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unzip = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for z, found in zip(b.column("z").to_pylist(), b.column("found").to_pylist(), strict=True):
                gone, at, kept = merge([(x["a"], x["b"]) for x in found or []]), 0, []
                left = iter([*gone, (1 << 62, 1 << 62)])
                a, e = next(left)
                for words in slices(unzip(z)):
                    end, i = at + len(words), 0
                    while at + i < end:
                        if at + i < a:
                            to = min(a, end) - at
                            kept.append(b" ".join(words[i:to]))
                        else:
                            to = min(e, end) - at
                        i = to
                        if at + i == e:
                            a, e = next(left)
                    at = end
                out.append((at, sum(e - a for a, e in gone), b" ".join(kept), [a for a, _ in gone], [e for _, e in gone]))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", "n_words", "n_removed", "kept", "starts", "ends"])

    places = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("starts", "ends")]
    schema = T.StructType([rows.schema["doc_id"], long_("n_words"), long_("n_removed"), T.StructField("kept", T.BinaryType()), *places])
    out = _zipped(rows).join(spans, "r", "left").select("doc_id", "z", "found").mapInArrow(cut, schema)
    return out.withColumn("kept", F.col("kept").cast("string"))

"""Benchmark decontamination with an FM-index for each shard of the training texts.

A shard is a stretch of a partition. Its texts become symbols, one a word, with 0 for words that no phrase of the
benchmark holds; only runs of known words that are long enough for a phrase are indexed, which loses no occurrence. The
index has the Burrows-Wheeler transform of the runs as a wavelet matrix with rank directories, and sampled suffix
positions. All phrases are searched backwards at once, symbol by symbol, and their occurrences located by walking to
the next sample.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, fresh, map_batches, written

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: The same words in characters, of a text whose letters A-Z are lower-case.
WORD_PATTERN = r"[0-9a-z\x{80}-\x{10FFFF}]+"
WINDOW = 10
#: Positions between samples.
SAMPLE = 8
#: A shard ends with the batch that brings it to so many symbols, or bytes of text.
SHARD_SYMBOLS, SHARD_BYTES = 1 << 20, 1 << 25
#: Words of a block of the benchmark: the block is what goes to the executors at once.
BLOCK_WORDS = 1 << 20


class Phrases:
    """The distinct windows of some items: a pattern's symbols stand in its row, right-aligned; an item None has no name."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in WORD.findall(text.lower())]
            for i in range(max(len(ids) - window, 0) + 1 if ids else 0):
                found.setdefault(tuple(ids[i : i + window]), set()).update(() if item is None else (item,))
        self.items = [sorted(v) for v in found.values()]
        self.sizes = np.array([len(k) for k in found], np.int64)
        self.table = np.zeros((len(found), window), np.int64)
        for row, k in zip(self.table, found, strict=True):
            row[window - len(k) :] = k
        self.shortest = int(self.sizes.min()) if len(found) else 0


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of s in order, by doubling; every 0 is a symbol of its own, less than all others."""
    n, seps = len(s), np.flatnonzero(s == 0)
    rank = s.astype(np.int64) + len(seps)
    rank[seps] = np.arange(len(seps))
    todo, h = np.arange(n), 1  # places whose suffixes aren't yet told apart
    order = np.argsort(rank, kind="stable")
    first = np.r_[True, rank[order][1:] != rank[order][:-1]]
    head = np.flatnonzero(first)
    rank[order] = head[np.cumsum(first) - 1]  # a group's rank is the place of its first member
    while True:
        new = np.r_[True, rank[order][1:] != rank[order][:-1]]
        alone = new & np.r_[new[1:], True]
        at = np.flatnonzero(~alone)
        if not len(at):
            return order
        todo = order[at]
        follow = np.where(todo + h < n, rank[np.minimum(todo + h, n - 1)], -1)
        inner = np.lexsort((follow, rank[todo]))
        todo, follow = todo[inner], follow[inner]
        group = rank[todo]
        order[at] = todo
        start = np.r_[True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])]
        rank[todo] = at[np.flatnonzero(start)][np.cumsum(start) - 1]
        h *= 2


class Bits:
    """A bitmap with a rank directory: ones before each word of 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.pad(packed, (0, 8 - len(packed) % 8)).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        """symbols: runs with a 0 before, between and after them; others are from 1 to n_symbols."""
        order = suffix_array(symbols)
        last = symbols[order - 1]  # symbols[0] and the last are both 0
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols + 1))])
        sampled = (order % SAMPLE == 0) | (last == 0)
        self.sampled, self.positions = Bits(sampled), order[sampled]
        self.is_sampled, self.last = sampled, last
        self.levels, v = [], last
        for b in reversed(range(int(n_symbols).bit_length())):
            one = (v >> b & 1).astype(bool)
            self.levels.append((b, Bits(one)))
            v = np.concatenate([v[~one], v[one]])
        every = np.arange(n_symbols + 1)
        self.base = self._down(every, np.zeros_like(every))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for b, bits in self.levels:
            ones = bits.rank(i)
            i = np.where(c >> b & 1, bits.zeros + ones, i - ones)
        return i

    def step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The place of c before the suffixes that start at row i."""
        return self.first[c] + self._down(c, i) - self.base[c]

    def search(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each pattern."""
        low, high = np.zeros(len(table), np.int64), np.full(len(table), len(self.last), np.int64)
        live = np.arange(len(table))
        for k in reversed(range(table.shape[1])):
            live = live[(table[live, k] > 0) & (low[live] < high[live])]
            c = table[live, k]
            both = self.step(np.concatenate([c, c]), np.concatenate([low[live], high[live]]))
            low[live], high[live] = both[: len(live)], both[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at the rows."""
        out, walked = np.zeros(len(rows), np.int64), 0
        at = np.arange(len(rows))
        while len(at):
            done = self.is_sampled[rows]
            out[at[done]] = self.positions[self.sampled.rank(rows[done])] + walked
            at, rows = at[~done], rows[~done]
            rows = self.step(self.last[rows], rows)
            walked += 1
        return out


def find(shard: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """Per text (symbols of its words): merged spans of words inside occurrences, and the items that occur."""
    out: list = [([], set()) for _ in shard]
    if not phrases.shortest:
        return out
    lengths = np.fromiter(map(len, shard), np.int64, len(shard))
    begins = np.cumsum(lengths + 1) - lengths  # a 0 before each text
    flat = np.zeros(int(lengths.sum()) + len(shard) + 1, np.int64)
    for b, s in zip(begins, shard, strict=True):
        flat[b : b + len(s)] = s
    edge = np.flatnonzero(np.diff((flat > 0).astype(np.int8)))
    starts, ends = edge[::2] + 1, edge[1::2] + 1
    long = ends - starts >= phrases.shortest
    starts, ends = starts[long], ends[long]
    if not len(starts):
        return out
    sizes = ends - starts
    base = np.cumsum(sizes + 1) - sizes  # where each run goes
    symbols = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int64)
    steps = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    symbols[np.repeat(base, sizes) + steps] = flat[np.repeat(starts, sizes) + steps]
    index = FMIndex(symbols, len(phrases.vocabulary))
    low, high = index.search(phrases.table)
    found = np.flatnonzero(high > low)
    times = (high - low)[found]
    if not len(found):
        return out
    rows = np.repeat(low[found], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    which = np.repeat(found, times)
    at = index.locate(rows)
    run = np.searchsorted(base, at, side="right") - 1
    at = starts[run] + at - base[run]  # places in flat
    text = np.searchsorted(begins, at, side="right") - 1
    cover = np.zeros(len(flat) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.sizes[which], -1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(cover) > 0])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        k = int(np.searchsorted(begins, a, side="right")) - 1
        out[k][0].append((a - int(begins[k]), b - int(begins[k])))
    pairs = np.unique(text * len(phrases.sizes) + which)
    for k, p in zip((pairs // len(phrases.sizes)).tolist(), (pairs % len(phrases.sizes)).tolist(), strict=True):
        out[k][1].update(phrases.items[p])
    return out


def cut(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans, and without what stands between them."""
    places = [m.span() for m in WORD.finditer(data.lower())]
    out, at = [], 0
    for a, b in spans:
        out.append(data[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, data[at:]])


def _search(docs: DataFrame, held: Broadcast[Phrases], keep: list[str], clean: bool, shard_symbols: int) -> DataFrame:
    """keep, n_words, starts, ends, items (of one block), and with `clean` the text without spans."""
    fields = [T.StructField("n_words", T.LongType())] + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("starts", "ends")]
    fields += [T.StructField("items", T.ArrayType(T.StringType()))] + [T.StructField("text", T.StringType())] * clean
    schema = T.StructType([docs.schema[c] for c in keep] + fields)
    names = [f"c{i}" for i in range(len(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        get = p.vocabulary.get

        def flush(some: list[pa.RecordBatch], texts: list, shard: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            found, i = find(shard, p), 0
            for b in some:
                part, data = found[i : i + b.num_rows], texts[i : i + b.num_rows]
                cols = list(b.columns)
                cols.append(pa.array([len(s) for s in shard[i : i + b.num_rows]], pa.int64()))
                cols += [pa.array([[s[k] for s in spans] for spans, _ in part], pa.list_(pa.int64())) for k in (0, 1)]
                cols.append(pa.array([sorted(items) for _, items in part], pa.list_(pa.string())))
                if clean:
                    cols.append(pa.array([t if t is None else (cut(t, spans) if spans else t).decode("utf-8", "replace") for t, (spans, _) in zip(data, part, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=names)
                i += b.num_rows

        some, texts, shard, n, size = [], [], [], 0, 0
        for b in batches:
            for t in b.column(b.num_columns - 1).to_pylist():
                words = WORD.findall(t.lower()) if t else []
                s = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
                texts.append(t if clean else None)
                shard.append(s)
                n += int(np.count_nonzero(s))
                size += len(t or b"") if clean else 4 * len(s)
            some.append(b.select(range(b.num_columns - 1)))
            if n >= shard_symbols or size >= SHARD_BYTES:
                yield from flush(some, texts, shard)
                some, texts, shard, n, size = [], [], [], 0, 0
        if some:
            yield from flush(some, texts, shard)

    (data,) = fresh(docs, "_data")
    return map_batches(docs.select(*columns(keep), F.col("text").cast("binary").alias(data)), run, schema)


def blocks(items: DataFrame, parts: int) -> Iterator[Broadcast[Phrases]]:
    """The phrases of items (item_id, text) in `parts` blocks, broadcast one after the other; the driver holds one block."""
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()  # one block
        named = [(None if r["item_id"] is None else str(r["item_id"]), r["text"].encode()) for r in rows]
        del rows
        yield items.sparkSession.sparkContext.broadcast(Phrases(named))


def _items(benchmark: DataFrame, block_words: int) -> tuple[DataFrame, int]:
    """item_id (null: an item without a name) and text, and the number of blocks of about block_words words."""
    items = benchmark.where("text is not null").select("item_id", "text")
    n = items.agg(F.sum(F.length("text"))).first()[0] or 0
    return items, max(1, -(-n // (6 * block_words)))


def _each_block(docs: DataFrame, items: DataFrame, parts: int, keep: list[str], shard_symbols: int, hits: bool = False) -> DataFrame:
    """What each block finds in the same texts, by _block; `hits`: rows with spans alone, one for each value of keep.

    A block's rows are written, and its phrases freed, before the next block is collected.
    """
    out = None
    for k, held in enumerate(blocks(items, parts)):
        found = _search(docs, held, keep, False, shard_symbols).withColumn("_block", F.lit(k))
        found = written(found.where(F.size("starts") > 0).dropDuplicates(keep) if hits else found)
        held.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def digest(spans: str = "starts") -> list:
    """The columns of a search's result, from n_words, starts, ends and items."""
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return [F.col("n_words"), hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size(spans) > 0).alias("contaminated")]


def _merged(starts: list, ends: list) -> tuple[list[int], list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [a for a, _ in out], [b for _, b in out]


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """doc_id, n_words, starts, ends (merged spans of words, end exclusive) and items, a row for each row of docs.

    Null and empty texts have no words. Items without an id hit, but have no name among the items. A benchmark of several
    blocks takes a pass over docs for each; spans are then merged by a hash of the text, so that repeated rows are found
    alike. doc_id goes through, whatever its type.
    """
    items, parts = _items(benchmark, block_words)
    if parts == 1:
        return _search(docs.select("doc_id", "text"), next(blocks(items, 1)), ["doc_id"], False, shard_symbols)
    # spans follow from the text alone: only texts that a block hits go on from its pass, and meet the rows by their hash
    found = _each_block(docs.select(F.sha2("text", 256).alias("_text"), "text"), items, parts, ["_text"], shard_symbols, True)
    lists = found.groupBy("_text").agg(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))  # a list a block
    lower = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    rows = docs.select("doc_id", F.sha2("text", 256).alias("_text"), F.regexp_count(lower, F.lit(WORD_PATTERN)).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    joined = rows.join(lists, "_text", "left").select("doc_id", "n_words", "spans", F.coalesce("items", none).alias("items"))
    schema = T.StructType([joined.schema["doc_id"], joined.schema["n_words"], *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("starts", "ends")], T.StructField("items", T.ArrayType(T.StringType()))])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [_merged([s["starts"] for s in x or []], [s["ends"] for s in x or []]) for x in b.column("spans").to_pylist()]
            cols = [b.column("doc_id"), b.column("n_words"), pa.array([x[0] for x in both], pa.list_(pa.int64())), pa.array([x[1] for x in both], pa.list_(pa.int64())), b.column("items")]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "starts", "ends", "items"])

    return joined.mapInArrow(merge, schema)


def remove_contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """docs, with each text cut once by the merged spans of the whole benchmark, items without id included.

    Null and empty texts stay; rows alike are cut alike; columns besides the text go through, whatever their names.
    """
    items, parts = _items(benchmark, block_words)
    plain = docs.columns
    if parts == 1:
        kept = [c for c in plain if c != "text"]
        out = _search(docs, next(blocks(items, 1)), kept, True, shard_symbols)
        # the columns kept stand first and the text last, as names may be those of a search's columns
        out = out.toDF(*[f"c{i}" for i in range(len(out.columns))])
        places = {c: f"c{i}" for i, c in enumerate(kept)} | {"text": out.columns[-1]}
        return out.select(*[places[c] for c in plain]).toDF(*plain)
    # spans follow from the text alone
    found = _each_block(docs.select(F.sha2("text", 256).alias("_text"), "text"), items, parts, ["_text"], shard_symbols, True)
    of_text, spans = fresh(docs, "_text", "_spans")
    lists = found.groupBy(F.col("_text").alias(of_text)).agg(F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias(spans))  # a list a block
    joined = docs.withColumn(of_text, F.sha2("text", 256)).join(lists, of_text, "left").select(*columns(plain), spans)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, texts = b.schema.get_field_index("text"), []
            for t, x in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                if x:
                    both = _merged([s["starts"] for s in x], [s["ends"] for s in x])
                    t = cut(t.encode(), list(zip(*both, strict=True))).decode("utf-8", "replace")
                texts.append(t)
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type)).select(range(b.num_columns - 1))

    return map_batches(joined, clean, docs.schema)

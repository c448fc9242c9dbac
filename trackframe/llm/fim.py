"""Fill-in-the-middle: a text's prefix, middle and suffix in another order, with a sentinel before each.

Cuts lie between units: characters (code points), words or lines. Whether a unit starts at a byte is a predicate of that
byte and the one before it, so a text can be taken apart into chunks that overlap by one byte:

1. The texts of a batch are one buffer; the predicate holds for all of its chunks at once and gives a count for each.
2. Running sums of the counts give a text's units, and route each of the two cut ranks to the chunk that owns it.
3. Only those chunks are looked at again, for the byte where the rank's unit starts.

It is a narrow map: nothing is shuffled, and what a task holds is a batch of texts, its chunks' counts and one block of
predicates. A single text is not dealt to several tasks, since its output is one value all the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, fresh, long_, map_batches, string_

#: Bytes of a chunk, and of the chunks whose predicates are held at once.
CHUNK, BLOCK = 1 << 14, 1 << 22
#: Sentinels of prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Whether a unit starts at a byte, from the bytes before and the bytes themselves.
UNITS = {
    "char": lambda before, here: (here & 0xC0) != 0x80,
    "word": lambda before, here: SPACE[before] & ~SPACE[here],
    "line": lambda before, here: before == 0x0A,
}


class Chunks:
    """Counts of unit starts in the chunks of some texts, and where the unit of a rank starts.

    data: the texts' bytes in a row; offsets: where each starts, and the end of the last.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str = "char", chunk: int = CHUNK, block: int = BLOCK):
        self.data, self.offsets, self.starts_unit = data, offsets, UNITS[unit]
        sizes = np.diff(offsets)
        n = -(-sizes // chunk)
        self.first = np.concatenate([[0], np.cumsum(n)])  # the first chunk of each text
        inner = np.arange(self.first[-1]) - np.repeat(self.first[:-1], n)
        self.start = np.repeat(offsets[:-1], n) + inner * chunk
        self.head = inner == 0
        self.end = np.append(self.start[1:], offsets[-1:])
        counts, at = np.zeros(len(self.start), np.int64), 0
        while at < len(self.start):
            to = max(at + 1, int(np.searchsorted(self.start, self.start[at] + block)))
            a, b = int(self.start[at]), int(self.end[to - 1])
            here = self._predicate(a, b)
            here[self.start[at:to][self.head[at:to]] - a] = True  # a text's first byte starts a unit, whatever is before it
            counts[at:to] = np.add.reduceat(here, self.start[at:to] - a, dtype=np.int64)
            at = to
        self.before = np.concatenate([[0], np.cumsum(counts)])  # units before each chunk
        self.units = self.before[self.first[1:]] - self.before[self.first[:-1]]

    def _predicate(self, a: int, b: int) -> np.ndarray:
        here = self.data[a:b]
        before = self.data[a - 1 : b - 1] if a else np.concatenate([[np.uint8(0x0A)], here[:-1]])
        return self.starts_unit(before, here)

    def cut(self, text: int, rank: int) -> int:
        """The byte of the text at which its unit of this rank starts; its size, if there are no more units."""
        if rank >= self.units[text]:
            return int(self.offsets[text + 1] - self.offsets[text])
        rank = rank + self.before[self.first[text]]
        k = int(np.searchsorted(self.before, rank, "right")) - 1
        here = self._predicate(int(self.start[k]), int(self.end[k]))
        if self.head[k]:
            here[0] = True
        return int(self.start[k] - self.offsets[text] + np.flatnonzero(here)[rank - self.before[k]])


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary array without nulls, not copied."""
    wide = pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def fill_in_middle(docs: DataFrame, unit: str = "char", seed: int = 1, plain: int = 10, spm: int = 20, sentinels: tuple[str, str, str] = SENTINELS, chunk: int = CHUNK) -> DataFrame:
    """The rows of docs with n (units), form, prefix_units, middle_units and output; columns of docs by these names go.

    A row's form and cuts come from the sha256 of seed and doc_id, so reruns agree and rows that share a doc_id are cut
    by the same numbers. form: plain for `plain` of 100 rows, else spm (suffix first) for `spm` of 100, else psm. Texts
    that are empty or null, or that contain a sentinel, are plain: output is the text ("" if null), and there are no
    units of prefix and middle (null). A null doc_id counts as an empty one. Bytes that are not UTF-8 go through as
    they are. Prefix, middle and suffix may be empty; a long text costs its own size in memory, and its output the same.
    """
    fields = [long_("n"), string_("form"), long_("prefix_units"), long_("middle_units"), T.StructField("output", T.BinaryType())]
    new = [f.name for f in fields]
    kept = [c for c in docs.columns if c.lower() not in new]
    key, data = fresh(docs, "_key", "_data")
    schema = T.StructType([docs.schema[c] for c in kept] + fields)
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(data))
            chunks = Chunks(*_buffer(texts), unit, chunk)
            rows = []
            for i, (k, text) in enumerate(zip(b.column(b.schema.get_field_index(key)).to_pylist(), texts, strict=True)):
                n, text = int(chunks.units[i]), text.as_buffer().to_pybytes() if text.is_valid else b""
                h1, h2, h3, h4 = (int(k[j : j + 8], 16) for j in (0, 8, 16, 24))
                if not text or h3 % 100 >= 100 - plain or any(x in text for x in (p, s, m)):
                    rows.append((n, "plain", None, None, text))
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, e = chunks.cut(i, low), chunks.cut(i, high)
                if h4 % 100 < spm:
                    rows.append((n, "spm", low, high - low, b"".join((s, text[e:], p, text[:a], m, text[a:e]))))
                else:
                    rows.append((n, "psm", low, high - low, b"".join((p, text[:a], s, text[e:], m, text[a:e]))))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            arrays = [b.column(b.schema.get_field_index(c)) for c in kept]
            arrays += [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=kept + new)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(*columns(kept), digest.alias(key), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias(data))
    out = map_batches(rows, run, schema)
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of. Its parts hold no sentinel, so the first of each kind is the one that was put there."""
    p, s, m = sentinels
    part = lambda x, mark, k: F.split_part(x, F.lit(mark), F.lit(k))
    after_p, after_s = part(output, p, 2), part(output, s, 2)
    psm = F.concat(part(after_p, s, 1), part(output, m, 2), part(after_s, m, 1))
    spm = F.concat(part(after_p, m, 1), part(output, m, 2), part(after_s, p, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

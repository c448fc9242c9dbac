"""Token ids in a directly addressable file format.

A table of segments in ascending doc_id order. The ids of a segment are split into chunks of 8 bits: level 0 holds the
low chunk of every id, and a continuation bitmap says which ids go on in level 1, and so on. A rank directory (ones
before each block of 512 bits) finds an id's place in the next level, so any id is read without decoding its neighbours.
Segments are rows of a Parquet table: Spark's commit protocol makes the write whole even if executors are lost. Its pages
are plain and uncompressed, and least and greatest doc_id of each segment stand beside it, so that a reader goes by the
statistics of the row groups to the one that holds a document, and no block is decoded.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, shared_dir

#: Bits that a rank directory's entry covers.
BLOCK = 512
#: A segment ends with the document that brings it to so many ids.
SEGMENT = 1 << 16
#: Bytes of a row group, the least that a reader of one token takes from the file.
ROW_GROUP = 1 << 20
#: The pre-tokenizer and added tokens that Encoder's way of cutting texts is made for; other files encode whole texts.
KNOWN = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
ADDED = ["<|endoftext|>"]
#: Pieces that a worker remembers, and characters whose pieces it holds at once (a longer text is alone).
CACHE, AT_ONCE = 600_000, 1 << 20

#: Pieces of a text that are encoded alike alone and in the text: white space stands at their start only, or is all of
#: them; and a run of letters may end before a mark. A text whose words are parted by single blanks and line breaks is
#: split there instead, which is faster.
PIECE = re.compile(r" ?[^\W\d_]+(?![^\s.,;:!?])| ?\S+|\s+(?!\S)|\s+")
#: Stands before a piece with nothing in front of it.
BARE = "\0"
#: Characters that Python takes for white space and the tokenizer does not, and the tokenizer's special token.
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "<|endoftext|>", BARE)
BREAKS = ("\n", BARE)
#: Marks that may follow a word in a piece of their own.
MARKS = ".,;:!?"


def _shown() -> dict[int, str]:
    """The characters by which byte-level vocabularies show bytes: printable ones themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


SHOWN = _shown()


def dac_encode(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """(chunks, continuation bitmap, rank directory) of each level."""
    levels, v = [], ids.astype(np.uint32)
    while True:
        more = v >> 8
        goes = more > 0
        bits = np.packbits(goes, bitorder="little")
        ones = np.bitwise_count(np.pad(bits, (0, -len(bits) % (BLOCK // 8))).reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        last = not goes.any()
        levels.append(((v & 255).astype(np.uint8).tobytes(), b"" if last else bits.tobytes(), b"" if last else ranks.tobytes()))
        if last:
            return levels
        v = more[goes]


def dac_decode(levels: list) -> np.ndarray:
    """All ids of a segment."""
    v = None
    for chunks, bits, _ in reversed(levels):
        low = np.frombuffer(chunks, np.uint8).astype(np.uint32)
        if v is not None:
            goes = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(low), bitorder="little").view(bool)
            low[goes] |= v << 8
        v = low
    return v


def dac_get(levels: list, i: int) -> int:
    """The id at place i, without decoding others."""
    out = 0
    for k, (chunks, bits, ranks) in enumerate(levels):
        out |= chunks[i] << (8 * k)
        if not bits or not bits[i >> 3] >> (i & 7) & 1:
            break
        block = i // BLOCK
        head = bits[block * (BLOCK // 8) : i >> 3]
        i = int.from_bytes(ranks[4 * block : 4 * block + 4], "little") + int.from_bytes(head, "little").bit_count() + (bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
    return out


class Numbers(dict):
    """Numbers pieces as they are first looked up; `new` has those that have no ids yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


def by_pieces(path: str) -> bool:
    """Whether the tokenizer's file says that it cuts texts as Encoder does: byte-level BPE of plain pieces."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    pre, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
    plain = all(not model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    added = sorted(t["content"] for t in said.get("added_tokens") or [])
    shown = {k: pre.get(k) for k in KNOWN} == KNOWN and added == ADDED and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in said["added_tokens"])
    return shown and model.get("type") == "BPE" and plain and not said.get("normalizer") and not said.get("truncation")


class Encoder:
    """Encodes whole texts with a tokenizer, each distinct piece once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.simple = by_pieces(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.line_break = self._model("\n")
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a character of a token stands for a byte
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.numbers, self.used, self.known = Numbers(), 0, 0
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.bad = np.zeros(1 << 18, np.uint32), np.zeros(1 << 16, bool)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, at: np.ndarray, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        """Keep ids; piece number at[k] has sizes[k] of them from starts[k] on."""
        while (most := int(at.max(initial=0)) + 1) > len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.sizes, 2 * len(self.sizes))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.starts[at], self.sizes[at] = self.used + starts, sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used, self.known = self.used + len(ids), max(self.known, most)

    def _learn_joined(self, group: tuple[list[str], list[int]], before: str, gap: str) -> None:
        """Pieces that are encoded in one text, each with `before` as part of it and gap behind it, and cut by their bytes."""
        pieces, at = group
        if not pieces:
            return
        text = before + (gap + before).join(pieces) + gap
        ids = np.array(self._whole([text])[0], np.uint32)
        sizes = np.fromiter(map(len, pieces) if text.isascii() else (len(p.encode()) for p in pieces), np.int64, len(pieces)) + len(before) + len(gap)
        ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(sizes)) + 1
        starts = np.concatenate([[0], ends[:-1]])
        self._store(np.array(at), ids, starts, ends - starts - len(gap))

    def _model(self, word: str) -> list[int]:
        """The ids of a piece that the tokenizer's own pattern doesn't part."""
        if not word.isascii() or word[0] < "!":
            word = SHOWN[32] + word[1:] if word[0] == " " and word.isascii() else word.encode().decode("latin1").translate(SHOWN)
        return [x.id for x in self.tokenize(word)]

    def _learn(self) -> None:
        """Give ids to new pieces. A key is BARE and a piece, a line break and a word, or a word behind a blank."""
        new, first = self.numbers.new, len(self.numbers) - len(self.numbers.new)
        while len(self.numbers) > len(self.bad):
            self.bad = np.concatenate([self.bad, np.zeros(len(self.bad), bool)])
        for i in range(0, len(new), 5000):
            flat: list[int] = []
            sizes: list[int] = []
            places: list[int] = []
            groups: dict[str, tuple[list, list]] = {" ": ([], []), "\n": ([], []), BARE: ([], []), "": ([], [])}
            for n, p in enumerate(new[i : i + 5000], first + i):
                kind = p[0] if p and p[0] in BREAKS else " "
                word = p if kind == " " else p[1:]
                if kind == BARE and (not word or word[0].isspace()):
                    to = groups[""]
                elif not word or word[0].isspace() or word[-1].isspace():
                    self.bad[n] = True
                    continue
                else:
                    letters = word.rstrip(MARKS)
                    if letters.isalpha():  # one piece for the model, or two: no text needs to be cut
                        simple = self._model(" " + letters) if kind == " " else self._model(letters)
                        if kind == "\n":
                            simple = self.line_break + simple
                        if letters != word:
                            simple = simple + self._model(word[len(letters) :])
                        sizes.append(len(simple))
                        flat += simple
                        places.append(n)
                        continue
                    to = groups[kind]
                to[0].append(word)
                to[1].append(n)
            ends = np.cumsum(np.array(sizes, np.int64))
            self._store(np.array(places, np.int64), np.array(flat, np.uint32), ends - sizes, np.array(sizes, np.int64))
            self._learn_joined(groups[" "], " ", "")
            self._learn_joined(groups["\n"], "\n", "")
            self._learn_joined(groups[BARE], "", "\n")
            for p, n in zip(*groups[""], strict=True):
                ids = np.array(self._whole([p])[0], np.uint32)
                self._store(np.array([n]), ids, np.zeros(1, np.int64), np.array([len(ids)]))
        new.clear()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null: none."""
        if not texts:
            return []
        if not self.simple:
            return [np.array(x, np.uint32) for x in self._whole([t or "" for t in texts])]
        if self.known > CACHE:
            self.forget()
        odd = {i for i, t in enumerate(texts) if t and any(x in t for x in ODD)}
        found = [(BARE + t).replace("\n", " \n").split(" ") if t and i not in odd else [] for i, t in enumerate(texts)]
        counts, numbers = self._look_up(found)
        doubtful = np.unique(np.repeat(np.arange(len(texts)), counts)[self.bad[numbers]]).tolist()
        if doubtful:
            for i in doubtful:
                found[i] = [BARE + p for p in PIECE.findall(texts[i])]
            counts, numbers = self._look_up(found)
        del found
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[numbers] - (ends - sizes), sizes) + np.arange(total)]
        out = np.split(ids, np.concatenate([[0], ends])[np.cumsum(counts)[:-1]])
        for i in odd:
            out[i] = np.array(self._whole([texts[i]])[0], np.uint32)
        return out

    def _look_up(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(found)), np.int64, int(counts.sum()))
        self._learn()
        return counts, numbers


def in_slices(texts: list[str | None], most: int = AT_ONCE) -> Iterator[list[str | None]]:
    """The texts in order, by lists of so many characters at most, or of one text."""
    held: list[str | None] = []
    size = 0
    for t in texts:
        if held and size + len(t or "") > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield held


def _encoder(path: str) -> Encoder:
    """One encoder a worker process, which runs many tasks."""
    kept = sys.modules[__name__].__dict__.setdefault("_kept", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


SEGMENTS = "part int, seq int, first long, n_tokens long, least long, most long, doc_ids array<long>, sizes array<long>, levels array<struct<chunks:binary,bits:binary,ranks:binary>>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, segment: int = SEGMENT) -> None:
    """Write the ids of every whole text (null: empty), each followed by end_id, in ascending doc_id order (null first).

    Texts are dealt by ranges of doc_id (and a hash of the text, so that an id of many rows is several ranges) and sorted
    there, so files, segments and documents ascend; rows with one doc_id stand next to each other. part: the range; seq:
    the segment in it; first: ids before it in the range; least, most: of its doc_ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        encoder, part, seq, first = _encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        doc_ids: list = []
        held = 0
        end = np.array([end_id], np.uint32)

        def segment_row() -> pa.RecordBatch:
            sizes = [len(x) for x in ids]
            known = [d for d in doc_ids if d is not None]
            levels = [dict(zip(("chunks", "bits", "ranks"), x, strict=True)) for x in dac_encode(np.concatenate(ids))]
            row = {"part": part, "seq": seq, "first": first, "n_tokens": sum(sizes), "least": min(known, default=None), "most": max(known, default=None), "doc_ids": doc_ids, "sizes": sizes, "levels": levels}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for b in batches:
            encoded = chain.from_iterable(map(encoder.encode, in_slices(b.column("text").to_pylist())))
            for d, x in zip(b.column("doc_id").to_pylist(), encoded, strict=True):
                doc_ids.append(d)
                ids.append(np.concatenate([x, end]))
                held += len(ids[-1])
                if held >= segment:
                    yield segment_row()
                    first, held = first + held, 0
                    seq, ids, doc_ids = seq + 1, [], []
        if ids:
            yield segment_row()
        give_back()

    schema = T.StructType.fromDDL(SEGMENTS)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    dealt = dealt.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")
    plain = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(ROW_GROUP), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "16"}
    dealt.mapInArrow(run, schema).write.options(**plain).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    table = spark.read.schema(SEGMENTS).parquet(path)
    # one row a range: as many as shuffle partitions
    totals = sorted((r["part"], r["n"]) for r in table.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    before, total = {}, 0
    for part, n in totals:
        before[part], total = total, total + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = dac_decode([(x["chunks"], x["bits"], x["ranks"]) for x in row["levels"]]).astype("<u4")
                ends = np.cumsum(np.array(row["sizes"], np.int64))
                starts = ends - row["sizes"]
                crcs = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"] + before[row["part"]]), pa.array(np.array(row["sizes"], np.int64)), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # segments, not texts
    return table.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def segments_of(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The segments that may hold a document: files and row groups whose statistics exclude it are not read."""
    return spark.read.schema(SEGMENTS).parquet(path).where((F.col("least") <= doc_id) & (F.col("most") >= doc_id))


def get_token(spark: SparkSession, path: str, doc_id: int, i: int) -> int:
    """Token i of a document (the first, if several have its id), by rank, without decoding another."""
    found = segments_of(spark, path, doc_id).where(F.array_contains("doc_ids", doc_id)).orderBy("part", "seq").limit(1)
    # of the document's segment, the places and the levels' bytes: a segment's size is bounded by that of its last document
    row = found.select("doc_ids", "sizes", "levels").first()
    if row is None:
        raise KeyError(doc_id)
    k = row["doc_ids"].index(doc_id)
    if not 0 <= i < row["sizes"][k]:
        raise IndexError(i)
    return dac_get([(x["chunks"], x["bits"], x["ranks"]) for x in row["levels"]], sum(row["sizes"][:k]) + i)


def token_output(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """Write the ids of docs to a new folder in the shared one, and read the files back: one row for each row of docs."""
    import uuid

    path = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, **how)
    return read_tokens(docs.sparkSession, path)

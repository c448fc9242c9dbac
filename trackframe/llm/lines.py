"""Line dedup by a tree of line templates.

The tree has a fixed depth: a line's number of tokens, then its leading tokens. A token with a digit is variable. Behind
the leading tokens, what is constant shows by how lines spread: a token counts the distinct lines of its leaf that have it
at its place. All constant tokens of a template count that template's lines, and a variable field's tokens count a
fraction of them, at every size of the table. So a line's tokens, from the highest count down, part at the widest gap (by
ratio, `SPREAD` at least; at least half of the line's tokens stay constant), and those below it are variable. The tokens
that stay must belong together: the lines that share the template must be at least half of those that the rarest of its
tokens counts, which frequent words of prose, each common by itself, are not. A leaf has as many templates as there are such
patterns in it, and prose that shares a leaf with a template changes none of them.

A template needs more than `fanout` distinct lines, and so does a count, or it is taken for one. Any other line stands for
itself, and so does, with its digits, a line that would be variable in more than half of its tokens. All of it is counting
by keys, so no order of arrival matters and no leaf meets in one task.

Lines whose template occurs in `least_docs` documents or more are dropped from all of them. A line of `long_line` tokens
or more that stands for itself needs two documents, and stays in the first if they are fewer than `least_docs`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, fresh, row_key, written

WILD = "<*>"
MASK = WILD.encode()
DIGIT = re.compile(rb"[0-9]")
#: Least ratio of the counts of a line's rarest constant token and its most frequent variable one.
SPREAD = 2


def parsed(line: bytes) -> tuple[list[bytes], bool]:
    """The line's tokens (parted by ASCII white space), those with a digit 0-9 as WILD unless it would be most of them.

    The second value tells whether the line has at least half of its tokens constant.
    """
    tokens = line.split()
    masked = [MASK if DIGIT.search(t) else t for t in tokens] if DIGIT.search(line) else tokens
    fixed = 2 * sum(t != MASK for t in masked) >= len(masked)
    return (masked if fixed else tokens), fixed


def _key(tokens: list[bytes], fixed: bool) -> bytes:
    return hashlib.md5((b"" if fixed else b"\0") + b" ".join(tokens)).digest()


def _leaf(tokens: list[bytes], depth: int) -> bytes:
    return hashlib.md5(b"%d %s" % (len(tokens), b" ".join(tokens[:depth]))).digest()


def _placed_lines(docs: DataFrame, depth: int, long_line: int) -> DataFrame:
    """row, doc_id, at (place from 0), key, leaf and `long` of each line with a token: hashes, no texts."""
    names = ["row", "doc_id", "at", "key", "leaf", "long"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, types = [], [pa.binary(), b.column("doc_id").type, pa.int32(), pa.binary(), pa.binary(), pa.bool_()]
            for row, d, text in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                for at, line in enumerate((text or b"").split(b"\n")):
                    tokens, fixed = parsed(line)
                    if tokens:
                        out.append((row, d, at, _key(tokens, fixed), _leaf(tokens, depth) if fixed and len(tokens) > depth else None, len(tokens) >= long_line))
            cols = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    data = docs.select(row_key().alias("row"), "doc_id", F.col("text").cast("binary").alias("text"))
    kinds = [("at", T.IntegerType()), ("key", T.BinaryType()), ("leaf", T.BinaryType()), ("long", T.BooleanType())]
    return data.mapInArrow(run, T.StructType([data.schema["row"], data.schema["doc_id"], *[T.StructField(n, t) for n, t in kinds]]))


def _texts_of_lines(docs: DataFrame, depth: int) -> DataFrame:
    """leaf, key, masked: the distinct lines of each batch that have a leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = {line for text in b.column("text").to_pylist() for line in (text or b"").split(b"\n")}
            found = {(_leaf(t, depth), _key(t, True), b" ".join(t).decode("utf-8", "replace")) for t, fixed in map(parsed, lines) if fixed and len(t) > depth}
            cols = zip(*found, strict=True) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.string()), strict=True)], names=["leaf", "key", "masked"])

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "leaf binary, key binary, masked string")


def template(tokens: list[str], counts: dict[int, int], depth: int, fanout: int) -> tuple[list[str] | None, int]:
    """A line's tokens with the variable ones as WILD, and the least count of a constant one; None: it has no gap.

    counts: of the places behind the leading ones, where they are over `fanout`.
    """
    n, lead = len(tokens), sum(t != WILD for t in tokens[:depth])
    sizes = sorted((counts.get(i, 1) for i in range(depth, n)), reverse=True)
    gaps = [(sizes[k - 1] / sizes[k], -k) for k in range(1, len(sizes)) if 2 * (lead + k) >= n and sizes[k - 1] > fanout]
    ratio, k = max(gaps, default=(0, 0))
    if ratio < SPREAD:
        return None, 0
    least = sizes[-k - 1]
    return [t if i < depth or counts.get(i, 1) >= least else WILD for i, t in enumerate(tokens)], least


def general_templates(lines: DataFrame, depth: int, fanout: int) -> DataFrame:
    """leaf, key, masked -> key, template: for the lines that a template generalises."""
    inside = written(lines.distinct())  # read three times
    tokens = F.split("masked", " ")
    places = inside.select("leaf", "key", F.posexplode(tokens).alias("at", "token")).where((F.col("at") >= depth) & (F.col("token") != WILD))
    slot = F.xxhash64("leaf", "at", "token")
    # written, so that the join below is dealt by itself and its common slots can be split
    counts = written(places.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > fanout))
    of_line = places.select("key", "at", slot.alias("slot")).join(counts, "slot").groupBy("key").agg(F.collect_set(F.struct("at", "n")).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, masked, counts in zip(*(b.column(c).to_pylist() for c in ("key", "masked", "counts")), strict=True):
                held, least = template(masked.split(" "), {x["at"]: x["n"] for x in counts}, depth, fanout)
                if held is not None:
                    out.append((key, hashlib.md5(b"\0t " + " ".join(held).encode()).digest(), least))
            cols = zip(*out, strict=True) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int64()), strict=True)], names=["key", "template", "least"])

    named = written(inside.join(of_line, "key").select("key", "masked", "counts").mapInArrow(run, "key binary, template binary, least long"))
    together = named.groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("least"))
    several = written(together.where((F.col("n") > fanout) & (2 * F.col("n") >= F.col("least"))).select("template"))
    return named.join(several, "template").select("key", "template")


def recurring_lines(docs: DataFrame, least_docs: int = 10, depth: int = 3, fanout: int = 8, long_line: int = 20) -> DataFrame:
    """row (key of a row), n_lines, drop (places from 0 of the lines that go), for rows that have lines with a token."""
    table = written(_placed_lines(docs, depth, long_line))  # about 70 bytes a line: the only table of lines that is kept
    by_leaf = table.where("leaf is not null").select("leaf", "key").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("many"))
    crowded = written(by_leaf.where(F.col("many") > fanout).select("leaf"))
    general = written(general_templates(_texts_of_lines(docs, depth).join(crowded, "leaf"), depth, fanout))
    own = F.col("template").isNull() & F.col("long")
    t = written(table.join(general, "key", "left").select("row", "doc_id", "at", F.coalesce("template", "key").alias("template"), own.alias("own")))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    counted = t.select("template", "own", "doc_id", "row").distinct().groupBy("template", "own").agg(F.count(F.lit(1)).alias("n_docs"), F.min(order)["row"].alias("first"))
    everywhere = F.col("n_docs") >= least_docs
    # written, so that the join below is dealt by itself and its common templates can be split
    bad = written(counted.where(everywhere | (F.col("own") & (F.col("n_docs") > 1))).select("template", F.lit(True).alias("bad"), F.when(~everywhere, F.col("first")).alias("first")))
    marked = t.join(bad, "template", "left").withColumn("bad", F.col("bad") & ~F.col("row").eqNullSafe(F.col("first")))
    return marked.groupBy("row").agg(F.size(F.collect_set("at")).cast("long").alias("n_lines"), F.array_sort(F.collect_set(F.when(F.col("bad"), F.col("at")))).alias("drop"))


@F.arrow_udf(T.StringType())
def _cut(text: pa.Array, drop: pa.Array) -> pa.Array:
    """Texts without the lines at the given places (ascending)."""
    out = []
    for t, places in zip(text.to_pylist(), drop.to_pylist(), strict=True):
        if t is not None and places:
            gone = set(places)
            t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
        out.append(t)
    return pa.array(out, pa.string())


def dedup_lines(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, text cut to the lines that stay, with n_lines (lines with a token) and n_dropped.

    Lines without a token stay and count in no template; a null text stays null, with 0 lines. Rows that share a doc_id,
    or have none, are documents of their own unless they also share their text; rows alike in both count once, and each
    is cut alike. "First" is the least doc_id, of whatever type, null last. A text that `least_docs` documents repeat loses all of its lines
    in all of them. Other columns play no part; columns n_lines and n_dropped of docs are replaced.
    """
    row, n, drop = fresh(docs, "_row", "_lines", "_drop")
    found = recurring_lines(docs.select("doc_id", "text"), **how).toDF(row, n, drop)
    joined = docs.withColumn(row, row_key()).join(found, row, "left")
    keep = columns(c for c in docs.columns if c not in ("text", "n_lines", "n_dropped"))
    return joined.select(*keep, _cut("text", drop).alias("text"), F.coalesce(n, F.lit(0)).alias("n_lines"), F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"))

"""Product codes for vectors: each part of a vector becomes the index of its codebook's nearest entry, by exponion search.

Components are integers, floor(scale * x), so distances and sums are exact and nothing hangs on the order of additions.
A part's search starts at its previous entry. With D the squared distance to it, a nearer entry, or one as near, lies
within twice the distance of it, so within 4 D of it in squares; the entries are sorted by distance about each entry, and
only the leading ones within that bound are scanned. Ties go to the lower index.

Each round is one pass over the vectors: a task assigns its parts and gives sums and counts for each entry, which meet by
entry. The entry a part had before is found by taking the part through the rounds since a table of codes was last
written, at most REPLAY of them, so up to that many rounds write nothing and read each vector once; each step of
that way starts where the one before ended, and scans few entries. Codebooks (256 entries a part) are all that is sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rounds whose codebooks are passed through anew before codes are written.
REPLAY = 8
#: Rows whose distances to one entry's neighbours are made at once; times the neighbours of the step before that a step ends at.
ROWS, STEP = 4096, 12
#: Components that a task searches for at once.
COMPONENTS = 1 << 20
#: Integers up to this are exact in double precision, in any order of addition.
EXACT = 1 << 53


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite numbers: int64 where all fit, else Python's integers."""
    x = values.astype(np.float64)
    if not x.size or np.abs(x).max() * scale < 2.0**62:
        return np.floor(x * scale).astype(np.int64)
    whole = np.floor(x)
    rest = np.floor((x - whole) * scale).astype(np.int64)
    return np.array([int(w) * scale + int(r) for w, r in zip(whole.ravel(), rest.ravel(), strict=True)], object).reshape(x.shape)


class Book:
    """Entries of one part, and for each the others sorted by their distance to it (the entry itself comes first)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.most = max((abs(int(v)) for v in entries.ravel()), default=0)
        big = 4 * max(entries.shape[1], 1) * self.most**2 >= 1 << 62
        e = entries.astype(object) if big else entries.astype(np.int64)
        apart = np.empty((len(e), len(e)), object if big else np.int64)
        for i in range(len(e)):
            apart[i] = ((e - e[i]) ** 2).sum(axis=1)
        apart[np.arange(len(e)), np.arange(len(e))] = -1  # first, before copies of the entry
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.near = np.take_along_axis(apart, self.order, axis=1)
        self.near[:, 0] = 0

    def nearest(self, x: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance, for parts x that had the entries `before`."""
        if not len(x):
            return before.copy(), np.zeros(0, np.int64)
        most = max(self.most, int(np.abs(x).max()) if x.size else 0)
        exact = 4 * max(x.shape[1], 1) * most * most < EXACT  # else Python's integers: slow, but as exact
        kind = np.float64 if exact else object
        x, e = x.astype(kind), self.entries.astype(kind)
        norm, of_entry = (x * x).sum(axis=1), (e * e).sum(axis=1)
        e = np.ascontiguousarray(e.T) * -2
        to_before = norm + of_entry[before] + (x * e.T[before]).sum(axis=1)
        best, index = to_before - norm, before.astype(np.int64)
        by = np.argsort(before, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(before[by])) + 1).tolist(), len(by)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            entry = int(before[by[a]])
            for k in range(a, b, ROWS):
                rows = by[k : min(k + ROWS, b)]
                scan = np.searchsorted(self.near[entry], 4 * to_before[rows], "right")
                if int(scan.max()) < 2:
                    continue
                order = np.argsort(-scan, kind="stable")
                rows, scan, at = rows[order], scan[order], 1
                while at < scan[0]:  # each step takes more neighbours, for the rows that scan so far
                    to = min(STEP * max(at, 6), int(scan[0]))
                    some = rows[: int(np.searchsorted(-scan, -at))]
                    which = np.sort(self.order[entry, at:to])
                    d = x[some] @ e[:, which] + of_entry[which]
                    near = d.argmin(axis=1)  # the first of equals: the lower index
                    d, which, so_far = d[np.arange(len(some)), near], which[near], best[some]
                    better = (d < so_far) | ((d == so_far) & (which < index[some]))
                    some = some[better]
                    best[some], index[some] = d[better], which[better]
                    at = to
        best = best + norm
        return index, best.astype(np.int64) if exact else best


def _through(books: list[list[Book]], x: list[np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Codes (row, part) and distances after each round's codebooks in turn."""
    codes, far = codes.copy(), []
    for round_ in books:
        far = []
        for p, book in enumerate(round_):
            codes[:, p], d = book.nearest(x[p], codes[:, p])
            far.append(d)
    return codes, far


def _parts(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.array_split(vectors, parts, axis=1)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


_MADE: dict[tuple, Book] = {}


def _made(entries: np.ndarray) -> Book:
    """A worker's Book of some entries: only these are sent, and tables of distances are made once a worker."""
    key = (entries.shape, entries.tobytes() if entries.dtype != object else tuple(entries.ravel().tolist()))
    if key not in _MADE:
        if len(_MADE) >= 2 * PARTS * (REPLAY + 1):
            _MADE.clear()
        _MADE[key] = Book(entries)
    return _MADE[key]


def _batches(batches: Iterator[pa.RecordBatch], size: int, parts: int, scale: int, books: list[list[np.ndarray]]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray, list[np.ndarray]]]:
    made = [[_made(e) for e in round_] for round_ in books]
    for b in _joined(batches, max(1, COMPONENTS // max(size, 1))):
        x = _parts(integers(_matrix(b.column("v"), size), scale), parts)
        start = np.zeros((b.num_rows, parts), np.int64)
        if "codes" in b.schema.names:
            start = np.frombuffer(b"".join(b.column("codes").to_pylist()), "<u2").reshape(-1, parts).astype(np.int64)
        yield b, x, *_through(made, x, start)


def _joined(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to `many` rows or more: rows of the same entry are searched for at once."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= many:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _sums(rows: DataFrame, books: list[list[np.ndarray]], size: int, parts: int, scale: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> count and sums of the parts assigned to it. Sums are texts of integers, so that none overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for _, x, codes, _ in _batches(batches, size, parts, scale, books):
            for p in range(parts):
                by = np.argsort(codes[:, p], kind="stable")
                cuts = np.flatnonzero(np.diff(codes[by, p], prepend=-1))
                small = x[p].dtype != object and len(by) * int(np.abs(x[p]).max() if x[p].size else 0) < 1 << 62
                sums = np.add.reduceat(x[p][by] if small else x[p][by].astype(object), cuts, axis=0)
                for entry, n, s in zip(codes[by[cuts], p].tolist(), np.diff(np.append(cuts, len(by))).tolist(), sums.tolist(), strict=True):
                    held = total.get((p, entry))
                    total[p, entry] = [n, s] if held is None else [held[0] + n, [a + b for a, b in zip(held[1], s, strict=True)]]
        keys = list(total)
        arrays = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([total[k][0] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([[str(v) for v in total[k][1]] for k in keys], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, key = 0, None, None
        for b in batches:
            for part, entry, k, more in zip(*(b.column(c).to_pylist() for c in ("part", "entry", "n", "sums")), strict=True):
                key, n = (part, entry), n + k
                sums = list(map(int, more)) if sums is None else [x + int(y) for x, y in zip(sums, more, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([n], pa.int64()), pa.array([[str(v) for v in sums]], pa.list_(pa.string()))], names=["part", "entry", "n", "sums"])

    schema = "part int, entry int, n long, sums array<string>"
    found = rows.mapInArrow(run, schema).groupBy("part", "entry").applyInArrow(add, schema).collect()
    return {(r["part"], r["entry"]): (r["n"], list(map(int, r["sums"]))) for r in found}


def _coded(rows: DataFrame, books: list[list[np.ndarray]], size: int, parts: int, scale: int) -> DataFrame:
    """rows with codes (two bytes a part) instead of those they had, and error."""
    names = [c for c in rows.columns if c != "codes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, codes, far in _batches(batches, size, parts, scale, books):
            error = sum(d.astype(object) for d in far)
            error = [int(v) if v < 1 << 63 else None for v in error]
            arrays = [pa.array([c.tobytes() for c in codes.astype("<u2")], pa.binary()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in names] + arrays, names=[*names, "codes", "error"])

    fields = [T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())]
    return rows.mapInArrow(run, T.StructType([rows.schema[c] for c in names] + fields))


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, replay: int = REPLAY) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, codes, error) for each row of vectors (vec_id, embedding, label) that has a whole vector; codebooks.

    codes: an index of the codebooks for each part, as 16-bit little-endian numbers; error: the sum of squared distances.
    Rows go whose vector is null or holds null or non-finite components. Vectors are cut into `parts` consecutive
    parts, equal ones if their number of components allows it. The codebooks start as the vectors of least vec_id (null
    last; of equal ids, the lesser vector first), fewer than `entries` if there are fewer. All vectors have as many
    components as the first of these; a row of another number comes out with codes and error null. An error over
    2^63 - 1 is null. Repeated rows count each. Other columns play no part. No rows: no codebooks.
    """
    whole = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    kept = vectors.where(whole).select("vec_id", label.alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    order = (F.col("vec_id").asc_nulls_last(), "v")
    first = kept.orderBy(*order).limit(1).select(F.size("v").alias("size")).collect()
    if not first:
        return kept.select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), []
    size = first[0]["size"]
    fits, other = kept.where(F.size("v") == size), kept.where(F.size("v") != size)
    start = integers(np.array([r["v"] for r in fits.orderBy(*order).limit(entries).collect()], np.float64).reshape(-1, size), scale)
    books = [_parts(start, parts)]
    rows = fits
    for _ in range(rounds):
        if len(books) > replay:
            rows = written(_coded(rows, books[:-1], size, parts, scale).drop("error"))
            books = books[-1:]
        total = _sums(rows, books, size, parts, scale)
        new = []
        for p, book in enumerate(books[-1]):
            e = book.tolist()
            for k in range(len(e)):
                if (p, k) in total:
                    n, sums = total[p, k]
                    e[k] = [s // n for s in sums]
            wide = any(abs(v) >= 1 << 62 for row in e for v in row)
            new.append(np.array(e, object if wide else np.int64).reshape(book.shape))
        books.append(new)
    out = _coded(rows, books, size, parts, scale).drop("v")
    none = other.select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error"))
    return out.select("vec_id", "label", "codes", "error").union(none), books[-1]


def codebook_text(codebooks: list[np.ndarray]) -> str:
    """All entries' components by part, entry and place in the part, parted by commas."""
    return ",".join(str(int(v)) for book in codebooks for v in book.ravel())


def reconstruct(coded: DataFrame, codebooks: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """coded with `vector`: each part's entry, over the scale. Null codes give null."""
    books = [b.astype(np.float64) / scale for b in codebooks]

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def vector(codes: pa.Array) -> pa.Array:
        known = np.frombuffer(b"".join(codes.drop_null().to_pylist()), "<u2").reshape(-1, max(len(books), 1))
        rows = iter(np.concatenate([b[known[:, p]] for p, b in enumerate(books)], axis=1).tolist() if len(known) else [])
        return pa.array([next(rows) if v else None for v in codes.is_valid().to_pylist()], pa.list_(pa.float64()))

    return coded.withColumn("vector", vector("codes"))


def label_errors(coded: DataFrame) -> DataFrame:
    """coded with label_error: the sum of error over rows of equal label, nulls together; null if no error is known or it is over 2^63 - 1."""
    coded = written(coded)  # so that the join deals its own rows, and a common label's can be split
    sums = coded.groupBy("label").agg(F.expr("try_cast(sum(cast(error as decimal(19, 0))) as long)").alias("label_error"))
    sums = written(sums).withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")

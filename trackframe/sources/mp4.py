"""What an MP4 file says about its first video track: size, codec, frames and rate, without decoding.

Boxes are walked by their sizes, and only headers are read, by byte ranges: a few hundred bytes of a file of any length.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import store

#: Boxes that hold boxes on the way to a track's tables.
FIELDS = "width int, height int, codec string, frames long, fps double, error string"


class BadFile(ValueError):
    pass


def boxes(f, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, start of content, end) of the boxes in a range. A size of 1 is told in 64 bits behind the kind; 0 is all the rest."""
    while at < end:
        head = _read(f, at, 8, end)
        size, kind = struct.unpack(">I4s", head)
        start = at + 8
        if size == 1:
            (size,) = struct.unpack(">Q", _read(f, start, 8, end))
            start += 8
        to = end if size == 0 else at + size
        if to < start or to > end:
            raise BadFile(f"box {kind!r} at {at} ends at {to}, beyond {end}")
        yield kind, start, to
        at = to


def _read(f, at: int, n: int, end: int) -> bytes:
    if at + n > end:
        raise BadFile(f"{n} bytes at {at} lie beyond {end}")
    f.seek(at)
    got = f.read(n)
    if len(got) < n:
        raise BadFile(f"only {len(got)} of {n} bytes at {at}")
    return got


def _inner(f, span: tuple[int, int], *path: bytes) -> tuple[int, int] | None:
    for kind in path:
        span = next(((a, b) for k, a, b in boxes(f, *span) if k == kind), None)
        if span is None:
            return None
    return span


def _numbers(f, span: tuple[int, int], layout: str, skip: int = 4) -> tuple:
    """Numbers behind a box's version and flags."""
    return struct.unpack(layout, _read(f, span[0] + skip, struct.calcsize(layout), span[1]))


def _track(f, trak: tuple[int, int]) -> dict | None:
    """A video track's numbers; None: it is no video."""
    handler = _inner(f, trak, b"mdia", b"hdlr")
    if handler is None or _read(f, handler[0] + 8, 4, handler[1]) != b"vide":
        return None
    table = _inner(f, trak, b"mdia", b"minf", b"stbl")
    stsd = table and _inner(f, table, b"stsd")
    if not stsd:
        raise BadFile("a video track without stsd")
    codec, width, height = struct.unpack(">4s24xHH", _read(f, stsd[0] + 12, 32, stsd[1]))
    frames = 0
    for kind, layout, skip in ((b"stsz", ">I", 8), (b"stz2", ">I", 8)):
        if sizes := _inner(f, table, kind):
            (frames,) = _numbers(f, sizes, layout, skip)
    mdhd, number = _inner(f, trak, b"mdia", b"mdhd"), _inner(f, trak, b"tkhd")
    scale = duration = 0
    if mdhd:
        wide = _read(f, mdhd[0], 1, mdhd[1]) == b"\1"
        scale, duration = _numbers(f, mdhd, ">IQ" if wide else ">II", 20 if wide else 12)
    wide = number and _read(f, number[0], 1, number[1]) == b"\1"
    track = _numbers(f, number, ">I", 20 if wide else 12)[0] if number else None
    return {"codec": codec.decode("latin-1"), "width": width, "height": height, "frames": frames, "scale": scale, "duration": duration, "track": track}


def _fragments(f, moof: tuple[int, int], track: int | None) -> int:
    """Frames of a track in one fragment."""
    n = 0
    for kind, a, b in boxes(f, *moof):
        head = _inner(f, (a, b), b"tfhd") if kind == b"traf" else None
        if head and _numbers(f, head, ">I") == (track,):
            n += sum(_numbers(f, (x, y), ">I")[0] for k, x, y in boxes(f, a, b) if k == b"trun")
    return n


def probe(f, size: int) -> dict:
    """width, height, codec, frames, fps (None: no duration is told) of the first video track; BadFile: there is none, or the file is cut."""
    found, moofs = None, []
    for kind, a, b in boxes(f, 0, size):
        if kind == b"moov" and found is None:
            found = next((t for k, x, y in boxes(f, a, b) if k == b"trak" and (t := _track(f, (x, y)))), None)
        elif kind == b"moof":
            moofs.append((a, b))
    if found is None:
        raise BadFile("no video track")
    frames = found["frames"] + sum(_fragments(f, m, found["track"]) for m in moofs)
    fps = frames * found["scale"] / found["duration"] if found["duration"] and found["scale"] else None
    return {"width": found["width"], "height": found["height"], "codec": found["codec"], "frames": frames, "fps": fps}


def probed(videos: DataFrame, source: str = "source") -> DataFrame:
    """videos with width, height, codec, frames, fps, error of the files under `source`; a map over files, spread over tasks.

    A file that is missing, cut or no such video has its error, and nulls. Columns of these names are replaced.
    """
    new = [x.split()[0] for x in FIELDS.split(", ")]
    kept = [c for c in videos.columns if c not in new]

    def told(path: str | None) -> tuple:
        try:
            if path is None:
                raise BadFile("no path")
            with store.opened(path) as f:
                p = probe(f, f.size())
            return (p["width"], p["height"], p["codec"], p["frames"], p["fps"], None)
        except (OSError, BadFile) as x:
            return (None, None, None, None, None, str(x)[:500])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.string()]
        for b in batches:
            cols = list(zip(*map(told, b.column(source).to_pylist()), strict=True)) if b.num_rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=[*kept, *new])

    schema = ", ".join(f"`{c}` {videos.schema[c].dataType.simpleString()}" for c in kept)
    return store._spread(videos.select(*kept), source).mapInArrow(run, f"{schema}, {FIELDS}")

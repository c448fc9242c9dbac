import io
import struct
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackframe.operators import datasets, media
from trackframe.sources import mp4, store


def frames(spark, n, episodes=1, selected=(1, 4)):
    rows = [(e, i, float(10 * e + i), i in selected) for e in range(episodes) for i in range(n)]
    return spark.createDataFrame(rows, "episode_index long, frame_index long, x double, selected boolean").repartition(3)


class Log:
    """A solver that writes down what happens to it: one file a solver, a line a call."""

    def __init__(self, folder, shape=(2, 3), bad=None, value=0.0):
        import uuid

        self.path, self.shape, self.bad, self.value, self.seen = Path(folder) / uuid.uuid4().hex, shape, bad, value, []
        self.path.write_text("")

    def note(self, what):
        with self.path.open("a") as f:
            f.write(f"{what}\n")

    def solve(self, frame):
        self.note(frame)
        self.seen.append(frame)
        shape = (1, 1) if self.bad == "shape" and frame == 3 else self.shape
        out = np.full(shape, self.value if self.bad == "value" and frame == 3 else sum(self.seen))
        return {} if self.bad == "missing" and frame == 3 else {"depth": out}

    def release(self):
        self.note("released")


def calls(folder):
    return sorted(p.read_text().split() for p in Path(folder).iterdir())


def test_solver_sees_all_frames_in_order_and_gives_the_selected(spark, tmp_path):
    folder = str(tmp_path)
    got = media.solve_ordered(frames(spark, 5, 3), "x", lambda: Log(folder), {"depth": (2, 3)}).collect()
    got = sorted(got, key=lambda r: (r["episode_index"], r["frame_index"]))
    assert [(r["episode_index"], r["frame_index"]) for r in got] == [(e, i) for e in range(3) for i in (1, 4)]
    assert got[1]["depth"] == [10.0] * 6 and got[2]["depth"] == [21.0] * 6
    assert calls(folder) == sorted([*[str(float(10 * e + i)) for i in range(5)], "released"] for e in range(3))


def test_solver_streams(spark, tmp_path):
    """Of a long recording, a task holds one batch and a few results."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        held = []

        class Count:
            def solve(self, frame):
                return {"v": np.array(frame)}

            def release(self):
                held.append(1)

        got = media.solve_ordered(frames(spark, 500, 2, range(500)), "x", Count, {"v": ()}, rows=7)
        assert got.count() == 1000 and got.agg(F.max(F.element_at("v", 1))).first()[0] == 509.0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(("bad", "value", "text"), [("shape", 0, r"frame 3: depth has the shape \(1, 1\)"), ("value", np.nan, "frame 3: depth is not finite"), ("value", np.inf, "not finite"), ("missing", 0, "no output depth")])
def test_bad_outputs_are_errors_and_the_solver_is_released(spark, tmp_path, bad, value, text):
    folder = str(tmp_path)
    with pytest.raises(Exception, match=text):
        media.solve_ordered(frames(spark, 6), "x", lambda: Log(folder, bad=bad, value=value), {"depth": (2, 3)}).collect()
    assert all(c[-1] == "released" and c.count("released") == 1 for c in calls(folder))


def test_gap_in_a_recording_is_an_error(spark):
    with pytest.raises(Exception, match="frame 3 where 2 is expected"):
        media.solve_ordered(frames(spark, 6).where("frame_index <> 2"), "x", lambda: Log("/tmp"), {"depth": (2, 3)}).collect()


def test_two_passes_solve_once_and_leave_nothing(spark, tmp_path):
    log, spill = tmp_path / "log", tmp_path / "spill"
    log.mkdir()
    folder = str(log)
    with media.two_passes(frames(spark, 5, 2), "x", lambda: Log(folder, (1, 2)), "depth", (1, 2), f"file:{spill}") as (ranges, codes):
        assert [(r["channel"], r["low"], r["high"]) for r in ranges.orderBy("channel").collect()] == [(0, 1.0, 60.0), (1, 1.0, 60.0)]
        got = {(r["episode_index"], r["frame_index"]): r["codes"] for r in codes.collect()}
        assert got == {(0, 1): [0, 0], (0, 4): [round(9 / 59 * 255)] * 2, (1, 1): [round(20 / 59 * 255)] * 2, (1, 4): [255, 255]}
        assert codes.count() == 4
    assert not list(spill.iterdir()) and len(calls(folder)) == 2 and all(len(c) == 6 for c in calls(folder))
    with pytest.raises(RuntimeError), media.two_passes(frames(spark, 5), "x", lambda: Log(folder, (1, 2)), "depth", (1, 2), f"file:{spill}"):
        raise RuntimeError
    with pytest.raises(Exception, match="shape"), media.two_passes(frames(spark, 5), "x", lambda: Log(folder, (1, 2), bad="shape"), "depth", (1, 2), f"file:{spill}"):
        pass
    assert not list(spill.iterdir())


# raw frames


def raw(spark, rows):
    return spark.createDataFrame(rows, "episode_index long, frame_index long, data binary").repartition(2)


def test_raw_frames(spark, tmp_path):
    path = F.concat(F.lit(f"file:{tmp_path}/"), F.col("episode_index").cast("string"), F.lit(".rgb"))
    rows = [(e, i, bytes([e, i, 7])) for e in range(3) for i in range(4)]
    got = {r["episode_index"]: (r["frames"], r["bytes"]) for r in media.write_frames(raw(spark, rows), "data", path).collect()}
    assert got == {e: (4, 12) for e in range(3)}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["0.rgb", "1.rgb", "2.rgb"]
    assert (tmp_path / "2.rgb").read_bytes() == b"".join(bytes([2, i, 7]) for i in range(4))
    for bad in ([(5, 0, b"abc"), (5, 1, b"ab")], [(5, 0, b"abc"), (5, 2, b"abc")]):
        with pytest.raises(Exception, match="frame"):
            media.write_frames(raw(spark, bad), "data", path).collect()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["0.rgb", "1.rgb", "2.rgb"]


def test_raw_writer_that_is_stopped_leaves_no_file(tmp_path):
    """The task's end closes the map's generator: the file that is open then goes."""
    class Frames:
        def __iter__(self):
            yield pa.RecordBatch.from_pylist([{"k": 0, "frame_index": i, "v": b"x", "_path": f"{tmp_path}/a"} for i in range(2)])
            raise GeneratorExit

    with pytest.raises(GeneratorExit), store.whole_file(f"{tmp_path}/a") as out:
        for _, _, row in media._recordings(iter(Frames()), ("k",)):
            out.write(row["v"])
    assert list(tmp_path.iterdir()) == []


# probes


def box(kind, *content, wide=False, size=None):
    body = b"".join(content)
    n = len(body) + (16 if wide else 8) if size is None else size
    return (struct.pack(">I4sQ", 1, kind, n) if wide else struct.pack(">I4s", n, kind)) + body


def trak(kind=b"vide", width=640, height=480, codec=b"avc1", frames=90, scale=30, duration=90, track=1, wide=False):
    tkhd = box(b"tkhd", struct.pack(">4s", b"\1\0\0\0" if wide else b"\0" * 4), b"\0" * (16 if wide else 8), struct.pack(">I", track), b"\0" * 60)
    mdhd = box(b"mdhd", b"\1\0\0\0" + b"\0" * 16 + struct.pack(">IQ", scale, duration) if wide else b"\0" * 12 + struct.pack(">II", scale, duration), b"\0" * 4)
    hdlr = box(b"hdlr", b"\0" * 8, kind, b"\0" * 12, b"name\0")
    entry = box(codec, b"\0" * 6, struct.pack(">H", 1), b"\0" * 16, struct.pack(">HH", width, height), b"\0" * 50)
    stbl = box(b"stbl", box(b"stsd", b"\0" * 4, struct.pack(">I", 1), entry), box(b"stts", b"\0" * 8), box(b"stsz", b"\0" * 8, struct.pack(">I", frames), b"\0" * 4 * frames))
    return box(b"trak", tkhd, box(b"mdia", mdhd, hdlr, box(b"minf", box(b"vmhd", b"\0" * 12), stbl, wide=wide)))


def told(data):
    return mp4.probe(io.BytesIO(data), len(data))


def test_probe_of_boxes():
    want = {"width": 640, "height": 480, "codec": "avc1", "frames": 90, "fps": 30.0}
    ftyp, mdat = box(b"ftyp", b"isom" * 4), box(b"mdat", b"x" * 1000)
    assert told(ftyp + mdat + box(b"moov", box(b"mvhd", b"\0" * 100), trak(b"soun", frames=5), trak())) == want
    assert told(ftyp + box(b"moov", trak(wide=True), wide=True) + box(b"mdat", b"x" * 9, wide=True)) == want
    assert told(ftyp + box(b"moov", trak()) + struct.pack(">I4s", 0, b"mdat") + b"x" * 50) == want  # to the end of the file
    moof = lambda n, track: box(b"moof", box(b"mfhd", b"\0" * 8), box(b"traf", box(b"tfhd", b"\0" * 4, struct.pack(">I", track)), box(b"trun", b"\0" * 4, struct.pack(">I", n))))
    parts = ftyp + box(b"moov", trak(frames=0, duration=0)) + moof(7, 1) + mdat + moof(9, 2) + moof(5, 1) + mdat
    assert told(parts) == want | {"frames": 12, "fps": None}


@pytest.mark.parametrize(
    ("data", "why"),
    [(b"", "no video"), (b"abc", "beyond"), (box(b"ftyp", b"isom"), "no video"), (box(b"moov", trak(b"soun")), "no video"), (box(b"moov", trak())[:-1], "ends at"), (box(b"moov", trak())[:60], "ends at"), (box(b"moov", size=4), "ends at"), (struct.pack(">I4sQ", 1, b"moov", 3), "ends at"), (struct.pack(">I4s", 1, b"moov"), "beyond")],
)
def test_probe_of_broken_files(data, why):
    with pytest.raises(mp4.BadFile, match=why):
        told(data)


def test_probe_reads_headers_only():
    class Counted(io.BytesIO):
        n = 0

        def read(self, size=-1):
            self.n += size
            return super().read(size)

    data = box(b"ftyp", b"isom") + box(b"mdat", b"x" * 5_000_000) + box(b"moov", trak(frames=100_000))
    f = Counted(data)
    assert mp4.probe(f, len(data))["frames"] == 100_000 and f.n < 2000


def test_probed_videos_meet_what_is_expected(spark, tmp_path):
    (tmp_path / "a.mp4").write_bytes(box(b"moov", trak()))
    (tmp_path / "b.mp4").write_bytes(box(b"moov", trak(frames=89)))
    (tmp_path / "c.mp4").write_bytes(b"cut")
    v = spark.createDataFrame([(i, "cam", 90, 640, 480, f"file:{tmp_path}/{n}.mp4", n) for i, n in enumerate("abcd")], "episode_index long, key string, frames long, width int, height int, source string, error string")
    p = mp4.probed(v.select("episode_index", "key", "source", "error"))
    assert {r["episode_index"]: (r["frames"], r["codec"], r["error"] is None) for r in p.collect()} == {0: (90, "avc1", True), 1: (89, "avc1", True), 2: (None, None, False), 3: (None, None, False)}
    assert sorted(r["episode_index"] for r in datasets.video_mismatches(v.drop("source", "error"), p).collect()) == [1, 2, 3]

import hashlib
import random

import numpy as np

from xxhash import xxh64_intdigest

from trackframe.llm import substrings as s

SCHEMA = "doc_id long, text string, d long, n_bytes long"


def brute(rows):
    """Rows in order of doc_id (null first) and the text's hash."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, 42 if r[1] is None else int(np.uint64(xxh64_intdigest(r[1], 42)).view(np.int64)))):
        t = (text or "").encode()
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 99):
            w = t[i : i + 100]
            if w in seen:
                gone[i : i + 100] = True
            seen.add(w)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choice(["a", "b", "é", " ", "the "]) for _ in range(k))
    passage = text(300)
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.3:
            t = list(rng.choice(rows)[1])
            for _ in range(rng.randrange(3)):
                if t:
                    t[rng.randrange(len(t))] = "#"
            t = "".join(t)
        elif kind < 0.5:
            t = text(rng.randrange(120)) + passage[rng.randrange(3) : 300 - rng.randrange(120)] + text(rng.randrange(120))
        elif kind < 0.6:
            t = text(90) * rng.randrange(4)
        else:
            t = text(rng.choice([0, 50, 99, 100, 101, 400]))
        rows.append((3 * i, t))
    return rows


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in s.dedup_substrings(df, **how).drop("starts", "ends").collect()), key=str)


def test_against_brute_force(spark):
    rows = corpus(1, 250)
    want = brute(rows)
    assert sum(r[2] for r in want) > 5000
    assert run(spark, rows) == want
    assert run(spark, rows, group=1) == want  # all groups dealt by window


def test_one_byte_repeated_and_repeated_rows(spark):
    rows = [(5, "x" * 1000), (5, "x" * 1000), (6, "x" * 150), (None, "y" * 120), (None, "y" * 120), (7, None), (8, ""), (4, "x" * 99)]
    assert run(spark, rows) == brute(rows)


def test_long_text_in_stretches(spark, monkeypatch):
    rng = random.Random(3)
    t = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    texts = [t.encode(), (t[:700] + "!" + t[650:]).encode()]
    monkeypatch.setattr(s, "CHUNK", 333)
    got = set()
    for rows, offsets, parts in s._pieces(texts):
        text, _, h, c, place = s.anchors(parts)
        for k, hh, p in zip(text.tolist(), h.tolist(), place.tolist(), strict=True):
            at = (p >> 16) + offsets[k]
            got |= {(rows[k], i, at, hh) for i in range(at - (p >> 8 & 255), at - (p & 255) + 1)}
    monkeypatch.setattr(s, "CHUNK", 1 << 21)
    text, _, h, c, place = s.anchors(texts)
    whole = {(k, i, p >> 16, hh) for k, hh, p in zip(text.tolist(), h.tolist(), place.tolist(), strict=True) for i in range((p >> 16) - (p >> 8 & 255), (p >> 16) - (p & 255) + 1)}
    assert got == whole and len(whole) == sum(len(x) - 99 for x in texts)


def test_empty(spark):
    assert run(spark, []) == []


def test_ids_of_other_types(spark):
    rows = [("b", "x" * 120), ("a", "x" * 110 + "y"), ("c", "z" * 20)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: r["n_removed"] for r in s.dedup_substrings(df).collect()}
    assert got == {"a": 109, "b": 120, "c": 0}
    few = spark.createDataFrame([(2, "x" * 120), (1, "x" * 120)], "doc_id int, text string")
    assert {tuple(r)[:3] for r in s.dedup_substrings(few).select("doc_id", "n_bytes", "n_removed").collect()} == {(1, 120, 119), (2, 120, 120)}

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle import same
from trackframe.llm import fim, queries

TEXTS = st.lists(st.text(alphabet=st.sampled_from(list("ab é日😀\n \t<P>SḾ")), max_size=60), max_size=6)


def starts(text, unit):
    """The places of a text's units, character by character."""
    out = []
    for i, c in enumerate(text):
        before = text[i - 1] if i else None
        if i == 0 or unit == "char" or (unit == "word" and before in " \t\n\v\f\r" and c not in " \t\n\v\f\r") or (unit == "line" and before == "\n"):
            out.append(len(text[:i].encode()))
    return out


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from(["char", "word", "line"]), st.integers(1, 9), st.integers(1, 40))
def test_cuts_of_chunks_are_those_of_whole_texts(texts, unit, chunk, block):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    chunks = fim.Chunks(np.frombuffer(b"".join(data), np.uint8), offsets, unit, chunk, block)
    for i, t in enumerate(texts):
        want = starts(t, unit)
        assert chunks.units[i] == len(want)
        assert [chunks.cut(i, k) for k in range(len(want) + 2)] == [*want, len(data[i]), len(data[i])]


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    p, m, s = text[:a], text[a:b], text[b:]
    return (doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def rows(seed, n):
    rng = random.Random(seed)
    odd = [None, "", "<", "<P", "a<M>b", "<S>", "><P><", "<<<<<>>>>>P>", "x" * 70_000, "é" * 40_000]
    some = lambda: "".join(rng.choice(["a", "é", "日", "😀", "\n", "<", ">", "P", "M", "S", " the "]) for _ in range(rng.randrange(80)))
    return [(i, t) for i, t in enumerate(odd)] + [(rng.choice([None, 7, i]), some()) for i in range(10, n)]


def test_against_brute_force_and_round_trip(spark):
    data = rows(5, 600)
    df = spark.createDataFrame([(*r, "p", 3, "q") for r in data], "doc_id long, text string, output string, N long, `a.b` string")
    out = fim.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "a.b", "n", "form", "prefix_units", "middle_units", "output"]
    got = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((brute(*r) for r in data), key=str)
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) for r in got), key=str) == want
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {r[2] for r in want} == {"plain", "spm", "psm"}


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units_sentinels_and_ids(spark, unit):
    df = spark.createDataFrame([(f"id{i}", t) for i, (_, t) in enumerate(rows(9, 200))], "doc_id string, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    got = fim.fill_in_middle(df, unit=unit, seed=4, plain=0, spm=50, sentinels=marks, chunk=64)
    for r in got.withColumn("back", fim.restored(F.col("output"), F.col("form"), marks)).collect():
        assert r["back"] == (r["text"] or "") and r["n"] == len(starts(r["text"] or "", unit))
        assert (r["form"] == "plain") == (not r["text"])
        if r["form"] != "plain":
            cut = [*starts(r["text"], unit), len(r["text"].encode())]
            whole = r["output"].encode()
            middle = r["text"].encode()[cut[r["prefix_units"]] : cut[r["prefix_units"] + r["middle_units"]]]
            assert whole.endswith(b"[mid]" + middle)


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_against_sql(spark):
    assert same(spark, "/root/testdata/sf0.01", queries.queries()["op13_fim"], queries.oracle_sql()["op13_fim"]) == 1000

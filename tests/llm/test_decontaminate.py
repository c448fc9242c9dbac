import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from trackframe.llm import decontaminate as d

SCHEMA = "doc_id long, text string, n_words string, items string"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window=10):
    at = {}
    for i, t in items:
        w = words(t)
        if w:
            for k in range(max(len(w) - window, 0) + 1):
                at.setdefault(tuple(w[k : k + window]), set()).update(() if i is None else (str(i),))  # no id, no name
    sizes = {len(k) for k in at}
    out = []
    for doc_id, t in docs:
        w, hit, ids = words(t), set(), set()
        for k in range(len(w)):
            for n in sizes:
                if (x := tuple(w[k : k + n])) in at and len(x) == n:
                    hit.update(range(k, k + n))
                    ids |= at[x]
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **how):
    b = spark.createDataFrame(items, "item_id long, text string")
    f = d.find_contamination(spark.createDataFrame([(*x, "n", "i") for x in docs], SCHEMA), b, **how)
    return sorted((tuple(r) for r in f.select("doc_id", *d.digest()).collect()), key=str)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=8))
def test_suffix_array_and_search(text, pattern):
    s = np.array([0, *text, 0], np.int64)
    got = d.suffix_array(s).tolist()
    unique = [(0, i) if c == 0 else (c, 0) for i, c in enumerate(s)]
    assert got == sorted(range(len(s)), key=lambda i: unique[i:])
    pattern = [c for c in pattern if c]
    if pattern:
        index = d.FMIndex(s, 3)
        low, high = index.search(np.array([pattern]))
        found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        assert found == [i for i in range(len(s)) if s[i : i + len(pattern)].tolist() == pattern]


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = ["the", "La", "été", "x1", "of", "ñ", "b2b", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", ".", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([3, 9, 10, 11, 25]))) for i in range(12)] + [(50, None), (51, ""), (52, "..."), (None, "the of"), (3, text(12))]
    docs = [(i, " Zz ".join(rng.choice([text(rng.randrange(30)), rng.choice(items[:12])[1], (rng.choice(items[:12])[1].split(" ", 1) * 2)[1]]) for _ in range(rng.randrange(4)))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, items[3][1] * 40), (902, items[3][1] * 40), (None, items[4][1])]
    want = brute(docs, items)
    assert sum(r[-1] for r in want) > 30
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, shard_symbols=5) == want
    assert run(spark, docs, items, block_words=5) == want
    long_items = [x for x in items if len(words(x[1])) >= 9]
    assert run(spark, docs, long_items) == brute(docs, long_items)


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("d1", "zz A b2 ccc dd."), ("d2", None), (None, "x y"), ("d1", "zz A b2 ccc dd.")], "doc_id string, text string")
    bench = spark.createDataFrame([("q1", "a b2 ccc"), ("q2", "x"), ("q3", "none of this")], "item_id string, text string")
    for block_words in (1 << 20, 1):
        got = sorted(((r["doc_id"], r["n_words"], tuple(r["starts"]), tuple(r["ends"]), tuple(r["items"])) for r in d.find_contamination(docs, bench, block_words=block_words).collect()), key=str)
        assert got == [("d1", 5, (1,), (4,), ("q1",)), ("d1", 5, (1,), (4,), ("q1",)), ("d2", 0, (), (), ()), (None, 2, (0,), (1,), ("q2",))]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert [r[1:4] for r in run(spark, [(1, "a b")], [])] == [(2, 0, 0)]


def test_spans_are_cut(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, f"Clean É. {item.upper()}, tail", "en"), (2, "clean\n text ", "en"), (3, None, "en"), (4, item, "en")], "doc_id long, text string, lang string")
    got = d.remove_contamination(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "Clean É. , tail", 2: "clean\n text ", 3: None, 4: ""}


def test_blocks_cut_uncut_texts(spark):
    names = [f"w{i}" for i in range(60)]
    # windows of several items overlap in the texts, in any order of the blocks; the ends at a cut form an item of their own
    items = [(i, " ".join(names[5 * i : 5 * i + 14])) for i in range(9)] + [(None, " ".join(f"n{i}" for i in range(12))), (20, "left a b c d right e f g h")]
    texts = ["start " + " ".join(names) + " end", "left a b c d " + items[0][1] + " right e f g h", "x " + items[9][1] + " y", "clean", "", None]
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)] + [(texts[0], 0)], "text string, doc_id long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    # words 54 and on stand in no window
    want = {0: "start  " + " ".join(names[54:]) + " end", 1: "left a b c d  right e f g h", 2: "x  y", 3: "clean", 4: "", 5: None}
    for block_words in (1 << 20, 40, 12, 5):
        got = d.remove_contamination(docs, bench, block_words=block_words)
        assert got.columns == docs.columns
        rows = got.collect()
        assert len(rows) == 7 and {r["doc_id"]: r["text"] for r in rows} == want, block_words


def test_columns_of_any_name(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"before {item} after", "n", "s", "i", "d", "q", 5), (None, None, "n", "s", "i", "d", "q", 5), (2, "", "n", "s", "i", "d", "q", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, starts string, items string, _data string, `a.b` string, _text int")
    bench = spark.createDataFrame([(1, item), (2, "some other words that make up a window of ten of them")], "item_id long, text string")
    for block_words in (1 << 20, 5):
        out = d.remove_contamination(docs, bench, block_words=block_words)
        assert out.columns == docs.columns
        got = sorted(map(tuple, out.collect()), key=str)
        assert got == sorted([(1, "before  after", *rows[0][2:]), *rows[1:]], key=str)

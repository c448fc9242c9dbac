import glob
import random
import shutil

import pytest

import corpus_pipeline as p
from trackframe.llm import mixing
from trackframe.llm.common import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ne", "tu", "ra", "se"]) for _ in range(rng.randrange(1, 6)))
    item = " ".join(word() for _ in range(30))
    rows, labels, leaks = [], [], set()
    for i in range(240):
        words = [word() for _ in range(rng.randrange(40, 200))]
        if i % 6 == 0:
            for _ in range(8):
                words.insert(rng.randrange(len(words)), rng.choice(["grumble", "gromp"]))
        text = " ".join(words)
        if i % 7 == 1:
            text, leaks = text + " " + item, leaks | {i}
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(1000 + i, rows[i][1], "en", "s0", 1) for i in range(1, 60, 6)]
    root = tmp_path_factory.mktemp("tables")
    for name, data, schema in (("documents", rows, DOCS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", [(1, item)], "item_id long, text string")):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(root / "x"), mode="overwrite")
        shutil.copy(glob.glob(str(root / "x/part-*"))[0], root / f"{name}.parquet")
    return str(root), rows, item, leaks


def test_stages_take_effect(spark, tables):
    root, rows, item, leaks = tables
    docs, after = spark.read.parquet(f"{root}/documents.parquet"), {}
    assert [s for s, _ in p.STAGES] == ["toxicity", "near-duplicates", "decontamination", "mixing", "tokens"]
    for name, stage in p.STAGES:
        docs = written(stage(spark, docs, root))
        after[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = lambda name: [r["doc_id"] for r in after[name]]
    clean = {i for i, *_ in rows if i % 6 or i >= 1000}
    assert set(ids("toxicity")) == {i for i in clean if i < 1000 or (i - 1000) % 6}
    assert sorted(ids("near-duplicates")) == sorted(i for i in clean if i < 1000)
    for r in after["decontamination"]:
        assert item not in r["text"] and r["n_chars"] == len(r["text"])
        if r["doc_id"] not in leaks:
            assert r["text"] == rows[r["doc_id"]][1]
    size = {r["doc_id"]: len(r["text"].split()) for r in after["decontamination"]}
    assert max(map(ids("mixing").count, ids("mixing"))) == 2 and 1.3 < sum(size[i] for i in ids("mixing")) / sum(size.values()) < 1.7
    assert sorted(ids("tokens")) == sorted(ids("mixing"))
    assert [r["start"] for r in sorted(after["tokens"], key=lambda r: r["start"])][0] == 0


def test_run_is_its_stages(spark, tables):
    """run() twice, and once stage by stage, gives the same rows; extra columns of any name pass through the stages."""
    root = tables[0]
    a, b = (sorted(map(tuple, p.run(spark, root).collect())) for _ in range(2))
    docs = written(spark.read.parquet(f"{root}/documents.parquet"))
    for _, stage in p.STAGES:
        docs = written(stage(spark, docs, root))
    assert a == b == sorted(map(tuple, docs.collect())) and len(a) > 100


CLASHING = ["score", "predicted", "n_words", "_id", "items", "starts", "_key", "_slot", "h", "a.b"]


def test_columns_of_any_name_rows_without_id_and_empty_tables(spark, tables):
    root, rows, item, leaks = tables
    rows = [*rows, (1, " ".join(f"own{i}" for i in range(60)), "en", "s1", 9), (None, " ".join(f"lone{i}" for i in range(60)), "en", None, 9), (None, None, None, None, None), (1999, "", "en", "s1", 0)]
    docs = spark.createDataFrame([(*r, *"abcdefghij") for r in rows], DOCS + "".join(f", `{c}` string" for c in CLASHING))
    before = docs
    for name, stage in p.STAGES[:-1]:
        out = written(stage(spark, before, root))
        assert out.columns == docs.columns, name
        assert {tuple(r)[5:] for r in out.collect()} == {tuple("abcdefghij")}
        empty = stage(spark, docs.limit(0), root)
        assert empty.columns == docs.columns and empty.count() == 0
        before = out
    texts = {r["text"] for r in before.collect()}
    assert rows[-4][1] in texts and rows[-3][1] in texts  # rows that share or lack an id are rows of their own
    assert p.STAGES[-1][1](spark, before, root).count() == before.count()
    assert p.STAGES[-1][1](spark, docs.limit(0), root).count() == 0


def test_rows_that_repeat_in_the_mix(spark):
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, "d e", "en", None, 3), (2, None, "en", "s", 0)]
    df = spark.createDataFrame(rows, DOCS)
    got = [r["doc_id"] for r in mixing.repeat_documents(df).collect()]
    assert set(got) <= {1, None} and 2 not in got
    assert mixing.repeat_documents(df.limit(0)).count() == 0

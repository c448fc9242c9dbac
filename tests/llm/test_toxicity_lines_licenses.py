import random
import zlib

import oracle
import pytest
from trackframe.llm import licenses, lines, queries, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, score string"


def test_folding():
    assert toxicity.fold("Yоu 1D1OT, f00l! a​b ТЕХТ 2024") == ["you", "idiot", "fool", "ab", "text", "2024"]
    assert toxicity.fold(None) == []


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "ne", "tu", "ra"]) for _ in range(rng.randrange(1, 5)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(10, 300))]
        toxic = i % 4 == 0
        for _ in range(max(2, len(words) // 30) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["grumble", "gr0mp", "Zork" + word(), "zоrk" + word()]))
        if not toxic and i % 5 == 0:
            words.insert(3, "grumble bee")  # what only clean documents say
        rows.append((i, " ".join(words), "en", "s", "x"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    rows += [(5000, None, "en", "s", "x"), (5001, "", "en", "s", "x"), (None, "grumble grumble gromp", "en", "s", "x"), rows[4], rows[4]]
    docs = spark.createDataFrame(rows, SCHEMA)
    lab = spark.createDataFrame([*labels, (None, 1, 1), (7777, 1, 1), (3, 1, None), labels[8]], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, lab).collect()
    assert len(got) == len(rows)
    truth = {i: y for i, _, y in labels}
    for r in got:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (5000, 5001)) and all(r["predicted"] for r in got if r["doc_id"] is None)


def test_held_out_labels_are_not_learnt_from(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert a.weights == b.weights and a.coef == b.coef


def test_lexicon_and_scores_by_brute_force(spark):
    import math

    rows, labels = corpus(500, 5)
    rows += [(700 + i, rows[1][1], "en", "s", "x") for i in range(20)]  # copies train once
    labels += [(700 + i, 1, labels[1][2]) for i in range(20)]
    lex = toxicity.train(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    y = {i: t for i, _, t in labels}
    train = {(t, y[i]): t for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    n = [sum(k == v for _, k in train) for v in (0, 1)]
    counts = {}
    for text, toxic in train:
        for p in toxicity.parts(toxicity.fold(text)):
            counts.setdefault(p, [0, 0])[toxic] += 1
    weights = {}
    for p, (c, t) in counts.items():
        w = math.log((t + 0.5) / (n[1] + 1)) - math.log((c + 0.5) / (n[0] + 1))
        if t >= max(4, round(0.008 * n[1])) and 20 * c * n[1] <= t * n[0] and w >= 2.5:
            weights[p] = w
    assert set(lex.weights) == set(weights) and all(abs(lex.weights[p] - w) < 1e-12 for p, w in weights.items())
    match = lex.matcher()
    for _, text, *_ in rows[:120]:
        words = toxicity.fold(text)
        total = 0.0
        for k, w in enumerate(words):
            hits = [weights[p] for p in {f" {w} ", *(f" {w[:m]}" for m in range(1, len(w) + 1))} if p in weights]
            pairs = {" ".join(words[i : i + 2]) for i in (k - 1, k) if 0 <= i < len(words) - 1}
            if hits and not pairs & lex.exceptions:
                total += max(hits)
        a, b = match(text)
        assert abs(a - math.log1p(total)) < 1e-9 and abs(b - math.log1p(100 * total / max(len(words), 20))) < 1e-9


def test_many_rows_with_one_labelled_id(spark):
    rows, labels = corpus(200)
    rows += [(8, f"other {i} words {i} in each", "en", "s", "x") for i in range(400)]
    docs, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert toxicity._training_rows(docs, lab, 100).count() < 160 < toxicity._training_rows(docs, lab, 5000).count()


def test_stage_leaves_other_columns_alone(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame([(i, t, "keep", 7, "d") for i, t, *_ in rows], "doc_id long, text string, score string, predicted int, `a.b` string")
    lex = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = toxicity.without_toxic(docs, lex)
    got = out.collect()
    assert out.columns == docs.columns and 200 < len(got) < 240 and all(tuple(r)[2:] == ("keep", 7, "d") for r in got)


def test_no_labels(spark):
    docs = spark.createDataFrame(corpus(20)[0], SCHEMA)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, empty).where("predicted = 1").count() == 0
    assert toxicity.toxicity(docs.limit(0), empty).count() == 0


def test_lines_against_sql(spark, tmp_path):
    rng = random.Random(4)
    names = ["ann", "bob", "cy", "dee", "eve", "fay", "gus", "hal", "ida", "jon", "kim", "lou"]
    text = lambda: " ".join(rng.choice(["la", "le", "li"]) + rng.choice("abcdefgh") for _ in range(rng.randrange(1, 12)))
    log = lambda: f"user logged in from host {rng.choice(names)} at port {rng.randrange(9999)}"
    rows = []
    for i in range(300):
        ls = [rng.choice([text, text, log, lambda: "All rights  reserved", lambda: "", lambda: " \t"])() for _ in range(rng.randrange(8))]
        rows.append((i, "\n".join(ls), "en", "s", 1))
    rows += [(900, None, "en", "s", 1), (901, "", "en", "s", 1), (902, "x\r\ny", "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    import glob
    import shutil

    one = glob.glob(str(tmp_path / "documents.parquet/part-*"))[0]
    (tmp_path / "flat").mkdir()
    shutil.copy(one, tmp_path / "flat/documents.parquet")
    assert oracle.same(spark, str(tmp_path / "flat"), queries.op10_lines, queries.OP10_SQL) == len(rows)
    out = {r["doc_id"]: r for r in lines.dedup_lines(df).collect()}
    kept = "\n".join(r["text"] or "" for r in out.values())
    assert "logged in" not in kept and "All rights" not in kept and out[900]["text"] is None and out[902]["text"] == "x\r\ny"


def test_rows_that_share_or_lack_an_id_and_names_that_clash(spark):
    boiler = "a b c d 7"
    rows = [(1, f"a b c d {i}\nonly {'x' * i}") for i in range(3)] + [(k, boiler) for k in range(2, 15)] + [(None, f"{boiler}\nleft"), (None, "two\nlines"), (None, "are not\nthese")]
    df = spark.createDataFrame([(i, t, "d", "n", 5, "s", "x", "q") for i, t in rows], "doc_id long, text string, drop string, n_lines string, n_dropped long, _row string, `a.b` string, score string")
    out = lines.dedup_lines(df)
    assert out.count() == len(rows) and sorted(out.columns) == sorted(df.columns)
    got = {(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()}
    assert {(None, "left", 2, 1), (None, "two\nlines", 2, 0), (None, "are not\nthese", 2, 0)} == {r for r in got if r[0] is None}
    assert {r[1] for r in got if r[0] == 1} == {"only " + "x" * i for i in range(3)}
    assert lines.dedup_lines(df.limit(0)).count() == 0


def kept_lines(spark, rows, **how):
    return {r["doc_id"]: r["text"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()}


def test_templates_among_prose_of_the_same_leaf(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    logs = [(i, f"the user named {word()} logged in from the {word()} host today") for i in range(40)]
    prose = [(100 + i, "the user named " + " ".join(word() for _ in range(8))) for i in range(400)]
    assert set(kept_lines(spark, logs).values()) == {""}
    got = kept_lines(spark, logs + prose)
    assert {got[i] for i, _ in logs} == {""} and all(got[i] == t for i, t in prose)


@pytest.mark.parametrize("n", [100, 1000, 4000, 20_000])
def test_templates_at_every_size(spark, n):
    """Each value of a field stands in more and more lines; prose in the leaf, with frequent words at its places, too."""
    rng = random.Random(n)
    name = lambda k: "".join(chr(97 + int(c)) for c in str(k + 1000))
    rows = [(i, f"session opened for user {name(rng.randrange(300))} from the city {name(rng.randrange(60))} and then closed") for i in range(n)]
    common = ["the", "of", "and", "to", "in"]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("abcdefghij") for _ in range(4))
    prose = [(n + i, "session opened for " + " ".join(word() for _ in range(9))) for i in range(n // 4)]
    got = kept_lines(spark, rows + prose)
    assert sum(got[i] == "" for i, _ in rows) >= 0.95 * n
    assert all(got[i] == t for i, t in prose)


def test_two_templates_that_share_most_tokens(spark):
    word = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    often = [(i, f"the old server started a new task for {word(i + 100)} in the east wing") for i in range(900)]
    rare = [(1000 + i, f"the old server stopped a bad task for {word(i + 100)} in the east wing") for i in range(60)]
    assert set(kept_lines(spark, often + rare).values()) == {""}


def test_ids_of_other_types(spark):
    df = spark.createDataFrame([(f"d{i}", f"all rights are reserved here\nown {'x' * i}") for i in range(12)] + [(None, "x")], "doc_id string, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()}
    assert got["d3"] == "own xxx" and got[None] == "x"


def test_numbers_and_long_lines(spark):
    rng = random.Random(9)
    numbers = [(i, f"{rng.randrange(10**9)} {i} 2019\nin {i}") for i in range(30)]
    got = kept_lines(spark, numbers)
    assert all(got[i] == t.split("\n")[0] for i, t in numbers)  # differ in every token; "in <*>" is half constant
    passage = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    rows = [(5, f"own a\n{passage}"), (3, f"{passage}\nown b"), (4, f"own c\n{passage} "), (6, "short line here"), (7, "short line here")]
    assert kept_lines(spark, rows) == {5: "own a", 3: f"{passage}\nown b", 4: "own c", 6: "short line here", 7: "short line here"}


def test_licenses(spark):
    files = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x/code.py", "import this\n" * 30), ("a/x/y/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("a/x/y/z/deep.py", "print(1)\n" * 9), ("b/own.py", "# Licensed under the Apache License, Version 2.0;\n" + "code code\n" * 50), ("b/other.py", "nothing here"),
        ("top.py", None), ("c/empty.py", ""), ("b/own.py", "no header in this one"), ("d/long.py", "word " * 60000 + "\nReleased under the MIT License.\n"),
    ]
    df = spark.createDataFrame([(*f, "x", 1.0) for f in files], "path string, text string, license string, score double")
    got = sorted(licenses.scan_licenses(df.select("path", "text", "license")).collect(), key=str)
    by = {}
    for r in got:
        by.setdefault(r["path"], []).append((r["own_license"], r["license"], r["whence"]))
    assert by["a/LICENSE"] == [("MIT", "MIT", "own")]
    assert by["a/x/code.py"] == [(None, "MIT", "dir:a")]
    assert by["a/x/y/z/deep.py"] == [(None, "GPL-3.0", "dir:a/x/y")]
    assert by["b/own.py"] == [("Apache-2.0", "Apache-2.0", "own")] * 2  # rows with one path inherit and own alike
    assert by["b/other.py"] == by["top.py"] == by["c/empty.py"] == [(None, None, None)]
    assert by["d/long.py"] == [("MIT", "MIT", "own")]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def wrapped(text, prefix="", width=80):
    import textwrap

    return "\n".join(prefix + x for x in textwrap.wrap(text, width - len(prefix)))


def test_wrapped_texts_tags_and_holders(spark):
    t = licenses.TEMPLATES
    mit = wrapped("Copyright (c) 2019 Jane Q. Doe and others") + "\n\n" + wrapped(t["MIT"][2].replace("MIT License Copyright (c) ", ""))
    code = "\n\nimport os\n\ndef f(x):\n    return x + 1\n" * 40
    files = [
        ("m/LICENSE", mit), ("m/a.py", "x = 1"), ("b/LICENSE.txt", wrapped(t["BSD-3-Clause"][2].replace("(c)", "(c) 2001 Some One"), width=72)), ("b/c/d.py", None),
        ("apache.py", wrapped(t["Apache-2.0"][2], "# ") + code), ("gpl.c", "/*\n" + wrapped(t["GPL-3.0"][1], " * ") + "\n */" + code),
        ("tag.py", "# SPDX-License-Identifier: MIT" + code), ("holder.py", "Copyright (c) 2021 Jane Doe. Released under the MIT License." + code),
        ("nc.md", "licensed under CC BY-NC 4.0" + code), ("talk.md", "We spoke about the license of the building and its permission." + code),
    ]
    filler = [(f"z/{i}.txt", f"the words of file {i} are about this and that of {i * 7}, under the tree and for a person") for i in range(200)]
    got = {r["path"]: (r["own_license"], r["license"]) for r in licenses.scan_licenses(spark.createDataFrame(files + filler, "path string, text string")).collect()}
    want = {"m/LICENSE": "MIT", "b/LICENSE.txt": "BSD-3-Clause", "apache.py": "Apache-2.0", "gpl.c": "GPL-3.0", "tag.py": "MIT", "holder.py": "MIT", "nc.md": "CC-BY-NC-4.0", "talk.md": None}
    assert {k: got[k][0] for k in want} == want
    assert got["m/a.py"] == (None, "MIT") and got["b/c/d.py"] == (None, "BSD-3-Clause") and got["z/1.txt"] == (None, None)


def test_licenses_against_sql(spark, tmp_path):
    rng = random.Random(6)
    shown = [x for v in licenses.tagged(licenses.TEMPLATES).values() for x in v]
    word = lambda: rng.choice(["the", "of", "license", "copy", "work", "and", "2.0", "permission", "v1"])
    rows = []
    for i in range(150):
        parts = [" ".join(word() for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(4))]
        parts += rng.sample([*shown, wrapped(rng.choice(shown), "# ")], rng.randrange(3))
        rows.append((i, rng.choice(["\n", "\n\n", ". "]).join(parts), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), 1))
    rows += [(900, None, "en", "a", 0), (901, "", "en", "c", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").toPandas().to_parquet(tmp_path / "documents.parquet")
    assert oracle.same(spark, str(tmp_path), queries.op3_licenses, queries.OP3_SQL) == len(rows)


def test_cosine_by_brute_force(spark):
    import math
    import re

    texts = ["Released under the MIT License, see the file.", "the license of things is under review", "All rights reserved 2024", "GNU General Public License version 2"]
    df = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, text string")
    got = {r["path"]: r for r in licenses.scan_licenses(df, least=0.0).collect()}
    split = lambda t: [w for w in re.split(r"[^\w.]+|\.(?!\d)", t.lower()) if w]
    shown = licenses.tagged(licenses.TEMPLATES)
    known = {w for ts in shown.values() for t in ts for w in split(t)}
    n = len(texts)
    df_ = {w: sum(w in set(split(t)) for t in texts) for w in known}
    idf = {w: 1 + math.log((n + 1) / (df_[w] + 1)) for w in known}

    def vector(t):
        v = {}
        for w in split(t):
            v[w] = v.get(w, 0) + idf.get(w, 1 + math.log(n + 1))
        return v

    def cosine(a, b):
        norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / norm(a) / norm(b)

    for i, t in enumerate(texts):
        score, name = max(((round(cosine(vector(t), vector(x)), 6), k) for k, xs in shown.items() for x in xs), key=lambda p: (p[0], [-ord(c) for c in p[1]]))
        assert abs(got[f"f{i}"]["score"] - score) < 1e-5 and got[f"f{i}"]["own_license"] == name


def test_templates_without_an_english_cue(spark):
    own = {"Frei": ["Dieses Werk darf von jedermann unentgeltlich verwendet und weitergegeben werden."], "MIT": licenses.TEMPLATES["MIT"]}
    assert licenses.cue_of(licenses.TEMPLATES) == licenses.CUE
    files = spark.createDataFrame([("a/LIES", own["Frei"][0]), ("a/x", "int main() {}"), ("b/x", "unentgeltlich")], "path string, text string")
    got = {r["path"]: (r["own_license"], r["license"]) for r in licenses.scan_licenses(files, templates=own).collect()}
    assert got == {"a/LIES": ("Frei", "Frei"), "a/x": (None, "Frei"), "b/x": (None, None)}

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trackframe.llm import mixing, tokens

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t.,;:!?'a1²é_-\x1c\x85\xa0 sS日")), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=5))
def test_pieces_are_encoded_as_whole_texts(texts):
    assert [x.tolist() for x in tokens._encoder(PATH).encode(texts)] == whole(texts)


def test_special_token_and_nulls():
    texts = [None, "", "a <|endoftext|> b", "don't, can't.  Two  spaces\n\nlines ", "x" * 5000]
    assert [x.tolist() for x in tokens._encoder(PATH).encode(texts)] == whole(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 2**32 - 1), st.integers(0, 50256)), max_size=1500))
def test_codes_round_trip_and_random_access(ids):
    levels = tokens.dac_encode(np.array(ids, np.uint32))
    assert tokens.dac_decode(levels).tolist() == ids
    assert [tokens.dac_get(levels, i) for i in range(len(ids))] == ids


def spark_hash(text):
    """xxhash64 of a text as Spark has it, signed."""
    import xxhash

    return 42 if text is None else int(np.uint64(xxhash.xxh64_intdigest(text, 42)).view(np.int64))


def test_token_output(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "und", "été,", "x1.", "\n"]) for _ in range(rng.randrange(60))), "en", "a", 1) for i in range(200)]
    rows += [(500, None, None, None, None), (7, "again", "en", "b", 2), (-3, "", "en", "b", 2)]
    rng.shuffle(rows)
    df = tokens.token_output(spark.createDataFrame(rows, SCHEMA), PATH, segment=100)
    got = {(r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()}
    at, want = 0, set()
    for d, text, *_ in sorted(rows, key=lambda r: (r[0], spark_hash(r[1]))):
        ids = np.array([*whole([text])[0], 0], "<u4")
        want.add((at, d, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert tokens.token_output(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_random_access_through_files(spark, tmp_path, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(tokens, "ROW_GROUP", 4096)
    rng = random.Random(4)
    rows = [(3 * i, " ".join(rng.choice(["one", "two", "vierzehn", "été"]) for _ in range(rng.randrange(400)))) for i in range(600)] + [(None, "no id")]
    path = str(tmp_path / "t")
    tokens.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, segment=500)
    ids = {d: [*whole([t])[0], 0] for d, t in rows}
    for d, i in ((0, 0), (3, len(ids[3]) - 1), (900, len(ids[900]) // 2), (1797, 0)):
        assert tokens.get_token(spark, path, d, i) == ids[d][i]
    with pytest.raises(KeyError):
        tokens.get_token(spark, path, 4, 0)
    with pytest.raises(IndexError):
        tokens.get_token(spark, path, 3, len(ids[3]))
    # statistics lead to few of many row groups, whose pages are neither compressed nor dictionary-encoded
    plan = tokens.segments_of(spark, path, 900)._jdf.queryExecution().toString()
    assert "LessThanOrEqual(least,900)" in plan and "GreaterThanOrEqual(most,900)" in plan
    groups = [m.row_group(g) for f in glob.glob(path + "/part-*") for m in [pq.ParquetFile(f).metadata] for g in range(m.num_row_groups)]
    column = lambda g, name: next(g.column(c) for c in range(g.num_columns) if g.column(c).path_in_schema == name)
    hold = [g for g in groups if (x := column(g, "least").statistics).has_min_max and x.min <= 900 and column(g, "most").statistics.max >= 900]
    assert len(groups) > 20 and 1 <= len(hold) <= 3
    assert {g.column(c).compression for g in groups for c in range(g.num_columns)} == {"UNCOMPRESSED"}
    assert all("DICTIONARY" not in e for g in groups for c in range(g.num_columns) for e in g.column(c).encodings)


def test_other_tokenizers_encode_whole_texts(tmp_path):
    import json

    said = json.load(open(PATH, encoding="utf-8"))
    said["pre_tokenizer"]["add_prefix_space"] = True
    other = tmp_path / "other.json"
    other.write_text(json.dumps(said))
    from tokenizers import Tokenizer

    texts = ["don't, can't.  Two  spaces", None, "a"]
    assert tokens.by_pieces(PATH) and not tokens.by_pieces(str(other))
    want = [e.ids for e in Tokenizer.from_file(str(other)).encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert [x.tolist() for x in tokens.Encoder(str(other)).encode(texts)] == want


def fill(sizes, share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > most * sizes[s] + 1e-9}
        if not over:
            return t | {s: most * sizes[s] for s in capped}
        capped |= over


@pytest.mark.parametrize("block", [16, 1024])
def test_mixing_meets_targets(spark, block):
    rng = random.Random(5)
    sources = ["a", "b", "B", "é", None, "zz", "tiny"]
    rows = [(i, "w " * rng.randrange(0, 50), "en", rng.choices(sources, [30, 5, 5, 3, 3, 2, 0.3])[0], 0) for i in range(900)]
    rows += [(2000, None, "en", "a", 0), (2001, "w w", "en", "a", 0), (2001, "w w", "en", "a", 0)]
    got = [tuple(r) for r in mixing.mix(spark.createDataFrame(rows, SCHEMA), block=block).orderBy("doc_id", "taken").collect()]
    again = [tuple(r) for r in mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), block=block).orderBy("doc_id", "taken").collect()]
    assert got == again and len(got) == len(rows)
    words = {}
    for _, text, _, s, _ in rows:
        words[s] = words.get(s, 0) + len(re.findall(r"\S+", text or ""))
    want = fill(words)
    source = {i: s for i, _, _, s, _ in rows}
    taken = dict.fromkeys(words, 0)
    for i, size, source_size, target, t, first, slots, _ in got:
        assert (first is None) == (t == 0) == (not slots) and len(slots) == -(-t // max(size, 1)) and (not slots or first == min(slots))
        s = source[i]
        assert 0 <= t <= 2 * size and source_size == words[s] and abs(target - want[s]) < 1e-6
        taken[s] += t
    assert all(abs(taken[s] - want[s]) <= 1 for s in words)


def test_mixing_empty(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_schedule_is_even(spark):
    t = spark.createDataFrame([(0, 60_000.0, 90_000), (1, 30_000.0, 30_000), (2, 10_000.0, 5_000)], "place long, target double, source_size long")
    rows = mixing.schedule(t, 100, 1000, 3).orderBy("slot").collect()
    s = [r["place"] for r in rows]
    assert len(s) == 1000 and sum(r["slot"] >= 1000 for r in rows) <= 8  # what the points leave short of the targets
    for n in (100, 400, 900):
        assert all(abs(s[:n].count(p) - n * share) <= 8 for p, share in ((0, 0.6), (1, 0.3), (2, 0.1)))


def sourced(n=1200):
    rng = random.Random(11)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), "en", rng.choices(["a", "b", "c", None], [40, 10, 5, 5])[0], 0) for i in range(n)]
    return [*rows, (n, None, "en", "a", 0), (None, "x y z", "en", "b", 0)]


def test_mixing_against_sql(spark, tmp_path):
    import oracle
    from trackframe.llm import queries

    spark.createDataFrame(sourced(), SCHEMA).toPandas().to_parquet(tmp_path / "documents.parquet")
    assert oracle.same(spark, str(tmp_path), queries.op2_mixing, queries.OP2_SQL) == 1202


def mixed_shares(spark):
    """Share of each source's words among those of the first half of the slots in use, and the whole mix's."""
    source = {i: s for i, _, _, s, _ in sourced()}
    rows = [r for r in mixing.mix(spark.createDataFrame(sourced(), SCHEMA), block=20).collect() if r["taken"]]
    middle = max(r["first_slot"] for r in rows) // 2
    count = lambda rs: {s: sum(source[r["doc_id"]] == s for r in rs) / len(rs) for s in ("a", "b", "c")}
    return count([r for r in rows if max(r["slots"]) <= middle or min(r["slots"]) <= middle]), count(rows)


def test_the_schedule_orders_the_mix(spark, monkeypatch):
    half, whole_ = mixed_shares(spark)
    assert all(abs(half[s] - whole_[s]) < 0.12 for s in half)
    monkeypatch.setattr(mixing, "_reversed_bits", lambda j, bits: j)  # not low-discrepancy points any more
    half, whole_ = mixed_shares(spark)
    assert max(abs(half[s] - whole_[s]) for s in half) > 0.2


def test_mixed_documents_keep_the_order_of_slots(spark):
    rows = [(i, t, lang, s, n, "x", "y") for i, t, lang, s, n in sourced(300)]
    docs = spark.createDataFrame(rows, SCHEMA + ", _slot string, `a.b` string")
    out = mixing.repeat_documents(docs, block=20)
    assert out.columns == docs.columns
    want = sorted((slot, r["doc_id"] or -1) for r in mixing.mix(docs, block=20).collect() for slot in r["slots"])
    got = [r["doc_id"] or -1 for r in out.collect()]
    assert len(got) == len(want) and sorted(got) == sorted(i for _, i in want)
    first = {}
    for slot, i in want:
        first.setdefault(i, slot)
    order = [first[i] for i in dict.fromkeys(got)]
    assert order == sorted(order)


@pytest.mark.parametrize("chunk", [64, 3])
def test_repeated_rows_meet_the_target(spark, monkeypatch, chunk):
    """Rows alike in id and text are dealt the slots of their copies, whatever part of a group the mix takes."""
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rng = random.Random(5)
    rows = [(1, " ".join(["w"] * 60), "en", "a", i) for i in range(700)] + [(1, " ".join(["w"] * 60), "en", "b", i) for i in range(5)]
    rows += [(10 + i, " ".join(["v"] * rng.randrange(1, 40)), "en", rng.choice("bc"), 0) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = {}
    for r in mixing.mix_copies(docs, block=50).collect():
        t = want.setdefault(r["source"], [r["target"], 0, 0])
        t[1] += r["taken"]
        t[2] += len(r["slots"]) * r["size"]
    got, copies = {}, {}
    for r in mixing.repeat_documents(docs, block=50).collect():
        got[r["source"]] = got.get(r["source"], 0) + len(r["text"].split())
        if r["source"] == "a":
            copies[r["n_chars"]] = copies.get(r["n_chars"], 0) + 1
    assert got == {s: t[2] for s, t in want.items()}
    assert all(abs(got[s] - t[0]) <= 3 * 60 for s, t in want.items())
    assert max(copies.values()) <= 2 and sum(copies.values()) * 60 == got["a"]


def test_texts_are_encoded_by_slices():
    texts = ["ab", None, "", "c" * 9, "de", "f" * 4]
    got = list(tokens.in_slices(texts, 5))
    assert got == [["ab", None, ""], ["c" * 9], ["de"], ["f" * 4]]
    assert list(tokens.in_slices([], 5)) == []
    encoder = tokens.Encoder(PATH)
    held, look_up = [], encoder._look_up
    encoder._look_up = lambda found: held.append(sum(map(len, found))) or look_up(found)
    many = ["some plain words " * 20_000] * 5
    whole, most = encoder.encode(many), max(held)
    held.clear()
    apart = [x for s in tokens.in_slices(many) for x in encoder.encode(s)]
    assert all((a == b).all() for a, b in zip(whole, apart, strict=True)) and max(held) < most

"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are put in a random order and its words cut into blocks of equal size. The schedule is a run of
slots; slot j takes the van der Corput point of j, which the sources' cumulative weights map to a source, and the slot's
rank among the source's slots says which block fills it. All of the schedule but a pattern of fixed size is arithmetic:
over the pattern's slots each point comes once, so ranks repeat with that period. The first N slots, of all targets'
words, meet the targets but for a few blocks a source; for those the schedule goes on, and slots of sources whose target
is met stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, columns, fresh, written

WEIGHTS = (5.0, 2.0, 1.0)
#: log2 of the most points of the pattern.
PATTERN = 18
#: A block has so many words, or fewer so that the mix has about LEAST_SLOTS blocks.
BLOCK_WORDS, LEAST_SLOTS = 1024, 1 << 17
#: Periods of the schedule that a row stands for until they are dealt to tasks.
CHUNK = 64
#: Hexadecimal digits by which a source's random order is cut into parts, so that no task orders a whole source.
DIGITS = 3


def size(text: Column) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, place (in code point order), target: `share` of all words, by weights 5, 2, 1, repeating.

    No source gives over `most` times its size; what is above is reshared by weight. The level of that water-filling
    is found in order of the ratio of bound to weight: the first at which the rest fits. The windows without keys run
    over one row a source, not over documents.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # strings compare by UTF-8 bytes, which is the order of code points
    s = s.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int")))
    s = s.withColumn("bound", most * F.col("source_size"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy(F.col("bound") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumn("total", share * F.sum("source_size").over(everything)).withColumn("sum_w", F.sum("weight").over(everything))
    s = s.withColumn("left", F.col("total") - F.sum("bound").over(upto) + F.col("bound"))
    s = s.withColumn("level", F.col("left") / (F.col("sum_w") - F.sum("weight").over(upto) + F.col("weight")))
    # sources before the level's are at their bound: the first row whose ratio reaches its own level sets the level
    fits = F.min(F.when(F.col("bound") / F.col("weight") >= F.col("level") - 1e-9, F.struct(F.col("bound") / F.col("weight"), F.col("place"), F.col("level")))).over(everything)
    level = fits["level"]
    return s.select("source", "source_size", "place", "weight", F.coalesce(F.least(F.col("bound"), level * F.col("weight")), F.col("bound")).cast("double").alias("target"))


def _reversed_bits(j: Column, bits: int) -> Column:
    """The van der Corput point of j in base 2, times 2^bits."""
    out = F.lit(0).cast("long")
    for k in range(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(j, k).bitwiseAND(F.lit(1).cast("long")), bits - 1 - k))
    return out


def block_words(total: float) -> int:
    """The words of a block of a mix of so many words."""
    return int(max(1, min(BLOCK_WORDS, total // LEAST_SLOTS)))


def schedule(targets: DataFrame, block: int, slots: int, sources: int) -> DataFrame:
    """slot, place (of the source), rank, source_size, target: the order in which blocks of sources enter the mix.

    A source's share of the points is its share of the target, one at least: slot = cycle x points of the pattern + slot
    in the pattern, rank = cycle x points of the source + rank in the pattern. Row counts follow the mix's size over the
    block's; only the pattern, of 2^PATTERN rows or 128 for each source, and the sources meet in a task.
    """
    bits = max(min(PATTERN, slots.bit_length()), (64 * sources).bit_length())
    n = 1 << bits
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a source's words are cut into blocks in each round over it
    rounds = F.floor(F.col("target") / F.col("source_size"))
    need = rounds * F.ceil(F.col("source_size") / block) + F.ceil((F.col("target") - rounds * F.col("source_size")) / block)
    t = targets.where("target >= 0.5").withColumn("need", need)
    t = t.withColumn("total", F.sum("target").over(everything)).withColumn("sources", F.count("*").over(everything))
    # one point for each source, the rest by cumulative weight
    t = t.withColumn("upto", F.sum("target").over(Window.orderBy("place")) / F.col("total"))
    t = t.withColumn("high", F.round(F.col("upto") * (n - F.col("sources"))) + F.row_number().over(Window.orderBy("place")))
    t = t.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("place")), F.lit(0.0)))
    t = t.select("place", "need", "source_size", "target", F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"))
    points = t.select("place", F.explode(F.sequence("low", F.col("high") - 1)).alias("point"))
    pattern = points.withColumn("slot", _reversed_bits(F.col("point"), bits))
    pattern = pattern.withColumn("rank", F.row_number().over(Window.partitionBy("place").orderBy("slot")) - 1)
    each = t.select("place", "need", "source_size", "target", (F.col("high") - F.col("low")).alias("points"))
    # cycles are dealt in chunks, so that no task makes all slots of a large source; the pattern's size is fixed
    last = F.floor((F.col("need") - 1) / F.col("points"))
    chunks = each.withColumn("last", last).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / CHUNK))))
    chunks = chunks.repartition("place", "chunk")
    cycles = chunks.withColumn("cycle", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("last"), F.col("chunk") * CHUNK + CHUNK - 1))))
    out = cycles.join(F.broadcast(pattern), "place").where(F.col("cycle") * F.col("points") + F.col("rank") < F.col("need"))
    return out.select((F.col("cycle") * n + F.col("slot")).alias("slot"), "place", (F.col("cycle") * F.col("points") + F.col("rank")).alias("rank"), "source_size", "target")


def _order(seed: int) -> Column:
    """A row's place in the random order: 16 bytes of its id and text."""
    return F.md5(F.concat_ws(" ", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))))


def mix(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot, slots and h (place in the random order) for each row of docs.

    first_slot: the slot of the schedule in which the first word taken of the row stands; slots: one such for each round
    over the source's words; null and empty where nothing is taken. Null texts and texts without words have size 0 and are
    never taken; a null source is a source of its own; rows with the same doc_id are rows of their own. The random order
    hashes doc_id, text and seed, so reruns agree. A source's words are taken in that order, over again up to `most` times;
    its last block stops at its target. Rows of a source that share doc_id and text share h. block: words of a block, by default after the size of the mix.
    """
    return mix_copies(docs, **how).drop("copy", "source")


def mix_copies(docs: DataFrame, seed: int = 17, block: int | None = None, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """`mix`, with source and copy: rows of a source that share h are numbered from 0."""
    sized = docs.select("doc_id", "source", size(F.col("text")).alias("size"), _order(seed).alias("h"))
    sized = checkpointed(sized)  # ids and sizes: it is read more than once
    targets = checkpointed(source_targets(sized, share, most))
    all_ = targets.agg(F.sum("target").alias("words"), F.count(F.lit(1)).alias("sources")).first()
    words = all_["words"] or 0.0
    block = block_words(words) if block is None else block
    part = F.substring("h", 1, DIGITS)
    rows = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select("doc_id", sized["source"], "size", "h", "place", "source_size", "target", part.alias("part"))
    sums = rows.groupBy("place", "part").agg(F.sum("size").alias("n"))
    sums = sums.select("place", "part", (F.sum("n").over(Window.partitionBy("place").orderBy("part")) - F.col("n")).alias("before"))
    in_part = Window.partitionBy("place", "part").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(sums, ["place", "part"]).withColumn("start", F.col("before") + F.sum("size").over(in_part) - F.col("size"))
    alike = Window.partitionBy("place", "part").orderBy("h", "doc_id")
    placed = placed.withColumn("copy", (F.row_number().over(alike) - F.rank().over(alike)).cast("long"))
    # pieces of documents by block
    pieces = placed.where("size > 0").select("place", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    # a rank's words: the source's words over and over, without gaps at the ends of a round
    s = schedule(targets, block, -(-int(words) // block), all_["sources"])
    rounds = F.ceil(F.col("source_size") / block)
    s = s.select("slot", "place", (F.col("rank") % rounds).alias("block"), F.floor(F.col("rank") / rounds).alias("round"), "source_size", F.round("target").cast("long").alias("stop"))
    s = s.withColumn("take", F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block") * block, F.col("stop") - F.col("round") * F.col("source_size") - F.col("block") * block))
    s = s.where("take > 0").select("place", "block", "round", "take", "slot")
    a = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    b = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    got = pieces.join(s, ["place", "block"]).withColumn("got", F.least(b, F.col("take")) - a).where("got > 0")
    first = [F.min(F.when(F.col("round") == k, F.col("slot"))) for k in range(int(-(-most // 1)))]
    taken = got.groupBy("place", "start").agg(F.sum("got").alias("taken"), F.array_compact(F.array(*first)).alias("slots"))
    full = placed.where("size > 0").join(taken, ["place", "start"], "left").unionByName(placed.where("size = 0"), allowMissingColumns=True)
    slots = F.coalesce("slots", F.array().cast("array<long>"))
    return full.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.array_min(slots).alias("first_slot"), slots.alias("slots"), "h", "copy", "source")


def repeat_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs in the order of the mix: a row for each round in which it takes any of a document's words.

    A document comes up to `most` times, each at its first slot of the round, and not at all if no word of it is taken.
    Rows alike in doc_id, text and source are numbered, and each comes as often as the mix takes the copy of its number.
    Columns besides doc_id, text and source play no part.
    """
    h, at, slots, slot, n = fresh(docs, "_h", "_copy", "_slots", "_slot", "_n")
    name = lambda order: F.md5(F.concat_ws(" ", order, F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-"))))
    taken = mix_copies(docs.select("doc_id", "text", "source"), **how).where("taken > 0").select(name(F.col("h")).alias(h), F.col("copy").alias(at), F.col("slots").alias(slots))
    rows = docs.withColumn(h, name(_order(how.get("seed", 17))))
    several = checkpointed(rows.groupBy(h).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1))
    if several.isEmpty():
        rows = rows.withColumn(at, F.lit(0).cast("long"))
    else:
        rows = _numbered_copies(rows, several, h, at, n)
    out = rows.join(taken, [h, at]).withColumn(slot, F.explode(slots))
    return out.repartitionByRange(slot).sortWithinPartitions(slot).select(*columns(docs.columns))


def _numbered_copies(rows: DataFrame, several: DataFrame, h: str, at: str, n: str) -> DataFrame:
    """rows with `at`, from 0 among the rows of one h. Those of several are written first, so that their order stays.

    Numbers are those within a stretch of CHUNK rows of a written file, behind the counts of the stretches before, so that no
    task ranks a whole group.
    """
    (row, stretch, before) = fresh(rows, "_row", "_stretch", "_before")
    one = rows.join(several, h, "left_anti").withColumn(at, F.lit(0).cast("long"))
    held = written(rows.join(several.drop(n), h).withColumn(row, F.monotonically_increasing_id()))
    held = held.withColumn(stretch, F.floor(F.col(row) / CHUNK))
    counts = held.groupBy(h, stretch).agg(F.count(F.lit(1)).alias(n))
    counts = counts.select(h, stretch, (F.sum(n).over(Window.partitionBy(h).orderBy(stretch)) - F.col(n)).alias(before))
    within = F.row_number().over(Window.partitionBy(h, stretch).orderBy(row)) - 1
    return one.unionByName(held.withColumn(at, within).join(counts, [h, stretch]).withColumn(at, F.col(at) + F.col(before)).select(*columns(one.columns)))

"""Mixing sources to target weights: blocks of words drawn by source.

Column expressions and joins only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
# Words in a block; slots in an output shard.
BLOCK_WORDS, SHARD_SLOTS = 64, 4_096
# No source is taken more often than this.
MOST_EPOCHS = 3
# Parts of the line of all slots by which a slot finds its source; slots that a task makes.
CELLS, TASK_SLOTS = 1 << 14, 1 << 20
BEFORE = (Window.unboundedPreceding, -1)


def _size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, ordinal, source_size, target)`` from ``(source, source_size)``.

    Targets share the total size by weight. A source whose share would pass
    three times its size stops there, and the rest is shared again: sources
    stop in the order of ``size / weight``, so the level at which the others end follows
    from running sums. The table has one row per source.
    """
    every = Window.partitionBy()
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("ordinal", (F.row_number().over(ordered) - 1).cast("int"))
    rows = rows.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("ordinal") % len(weights) + 1))
    rows = rows.withColumn("most", F.col("source_size") * MOST_EPOCHS)
    ends = Window.orderBy(F.col("most") / F.col("weight"), "ordinal")
    rows = (
        rows.withColumn("stopped", F.coalesce(F.sum("most").over(ends.rowsBetween(*BEFORE)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ends.rowsBetween(*BEFORE)), F.lit(0)))
        .withColumn("level", (F.sum("source_size").over(every) - F.col("stopped")) / F.col("open"))
    )
    # The first level that its own source can still take holds for all later ones.
    fits = F.col("level") * F.col("weight") <= F.col("most")
    final = F.max(F.when(fits, F.col("level"))).over(every)
    level = F.coalesce(F.min(F.when(fits, F.struct(F.col("most") / F.col("weight"), "ordinal", "level"))).over(every)["level"], final)
    target = F.least(F.col("most").cast("double"), level * F.col("weight"))
    return rows.select("source", "ordinal", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def permuted(index: Column, count: Column, *keys: Column, rounds: int = 3, bind: Callable[[Column], Column] = lambda step: step) -> Column:
    """Pseudorandom permutation of ``0 .. count - 1``, another one for other ``keys``.

    Each round scrambles the numbers below the largest power of two by
    reversible steps, leaves the others, and turns the whole circle; all of
    these are one-to-one, so no number is tried twice. ``bind`` gets every step that
    later ones read more than once and may return a column that holds it.
    """
    bits = bind(F.length(F.bin(count)) - 1)
    low = bind(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1)
    half = bind(F.greatest(F.ceil(bits / 2).cast("int"), F.lit(1)))
    index = bind(index)
    for turn in range(rounds):
        drawn = bind(F.xxhash64(F.lit(turn), *keys))
        # Factors of 21 bits, so that products of numbers below 2**42 stay within 64.
        odd, other = (drawn.bitwiseAND(0xFFFFF) * 2 + 1), F.shiftright(drawn, 20).bitwiseAND(0xFFFFF) * 2 + 1
        scrambled = bind((index * odd).bitwiseAND(low))
        scrambled = scrambled.bitwiseXOR(F.call_function("shiftright", scrambled, half))
        scrambled = (scrambled * other).bitwiseAND(low)
        index = F.when(index <= low, scrambled).otherwise(index)
        index = bind((index + F.pmod(F.shiftright(drawn, 3), count)) % count)
    return index


def source_plan(rows: DataFrame, weights: tuple[int, ...]) -> tuple[DataFrame, str, int]:
    """One row per source with its target, blocks and slots, and where these begin on a line of all sources; its path; all slots."""
    sizes = rows.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS).cast("bigint")
    # A source's last block may be short, so its blocks hold fewer words on average.
    slots = F.coalesce(F.round(F.col("target") * F.col("blocks") / F.nullif("source_size", F.lit(0))).cast("bigint"), F.lit(0))
    line = Window.orderBy("ordinal").rowsBetween(*BEFORE)
    plan = source_targets(sizes, weights).withColumn("blocks", blocks).withColumn("quota", F.least(slots, F.col("blocks") * MOST_EPOCHS))
    plan, path = keep(
        plan.withColumn("first_word", F.coalesce(F.sum("source_size").over(line), F.lit(0)))
        .withColumn("first_slot", F.coalesce(F.sum("quota").over(line), F.lit(0))),
        "targets",
    )
    return plan, path, plan.agg(F.sum("quota")).first()[0] or 0


def drawn_slots(plan: DataFrame, total: int, seed: int) -> DataFrame:
    """``(shard, place, ordinal, block, epoch)`` of every slot of the mix.

    All slots stand on one line, source by source. A permutation of the line deals them to places,
    4,096 of them an output shard: so a shard's counts per source are a multinomial draw, given that
    the draws of all shards add up to the quotas. A source's own slots run through a
    permutation of its blocks, a new one each epoch. Slots are made and mapped where they
    are, a million a task; ``CELLS`` parts of the line say which sources they belong to.
    """
    spark = plan.sparkSession
    line = spark.range(0, total, 1, max(spark.sparkContext.defaultParallelism, 1 + total // TASK_SLOTS)).withColumnRenamed("id", "slot")
    whole = F.lit(max(total, 1)).cast("bigint")
    end = F.col("first_slot") + F.col("quota")
    held = plan.where("quota > 0").select(
        "ordinal", "blocks", "first_slot", end.alias("end"),
        F.explode(F.sequence(F.floor(F.col("first_slot") * CELLS / whole), F.floor((end - 1) * CELLS / whole))).alias("cell"),
    )
    found = line.withColumn("cell", F.floor(F.col("slot") * CELLS / whole)).join(held, "cell")
    found = found.where((F.col("slot") >= F.col("first_slot")) & (F.col("slot") < F.col("end")))

    def bind(step: Column) -> Column:
        # The optimizer keeps a column apart that is read more than once, so the plan grows with the steps and not with their product.
        nonlocal found
        name = f"_{len(found.columns)}"
        found = found.withColumn(name, step)
        return F.col(name)

    own = F.col("slot") - F.col("first_slot")
    found = found.withColumn("epoch", F.floor(own / F.col("blocks")))
    block = permuted(own % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("ordinal"), F.col("epoch"), bind=bind)
    place = permuted(F.col("slot"), whole, F.lit(seed), bind=bind)
    # A block is never null; told so, the join by it adds no test that repeats all its steps.
    return found.select(
        F.floor(place / SHARD_SLOTS).alias("shard"), (place % SHARD_SLOTS).alias("place"), "ordinal", F.coalesce(block, F.lit(0)).alias("block"), "epoch"
    )


def placed_pieces(rows: DataFrame, plan: DataFrame) -> tuple[DataFrame, str]:
    """``(row, ordinal, block, first, last)``: which words of a row lie in which block of its source; the path behind it.

    The rows of a source stand in the order of a hash. One range-partitioned sort places
    all rows; running sums stay inside its partitions, whatever the sources' sizes.
    """
    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    known = rows.where("size > 0").alias("d").join(plan.alias("p"), same).select("d.row", "d.size", "p.ordinal", "p.first_word")
    ordered = known.orderBy("ordinal", F.xxhash64("row"), "row").withColumn("_m", F.monotonically_increasing_id())
    stored, path = keep(ordered, "placed-sizes")
    stored = stored.withColumn("_p", F.shiftright("_m", 33))
    sums = stored.groupBy("_p").agg(F.sum("size").alias("_sum"))
    starts = sums.select("_p", F.coalesce(F.sum("_sum").over(Window.orderBy("_p").rowsBetween(*BEFORE)), F.lit(0)).alias("_start"))
    ahead = F.coalesce(F.sum("size").over(Window.partitionBy("_p").orderBy("_m").rowsBetween(*BEFORE)), F.lit(0))
    begin = (F.col("_start") + F.col("_ahead") - F.col("first_word")).cast("bigint")
    begun = stored.withColumn("_ahead", ahead).join(F.broadcast(starts), "_p").withColumn("begin", begin)  # one row per task
    blocks = F.sequence(F.floor(F.col("begin") / BLOCK_WORDS), F.floor((F.col("begin") + F.col("size") - 1) / BLOCK_WORDS))
    pieces = begun.select("row", "ordinal", "begin", "size", F.explode(blocks).alias("block")).select(
        "row",
        "ordinal",
        "block",
        F.greatest(F.lit(0).cast("bigint"), F.col("block") * BLOCK_WORDS - F.col("begin")).alias("first"),
        F.least("size", (F.col("block") + 1) * BLOCK_WORDS - F.col("begin")).alias("last"),
    )
    return pieces, path


def mixed_pieces(rows: DataFrame, weights: tuple[int, ...], seed: int) -> tuple[DataFrame, DataFrame]:
    """The mix of ``(row, source, size)``: ``(row, first, last, epoch, shard, place)``, and the plan of its sources.

    Words ``first`` to ``last - 1`` of a row stand in ``place`` of an output ``shard``. Blocks and slots meet by
    index in a shuffle whose keys are spread evenly.
    """
    plan, _, total = source_plan(rows, weights)
    pieces, _ = placed_pieces(rows, plan)
    taken = pieces.hint("merge").join(drawn_slots(plan, total, seed), ["ordinal", "block"])
    return taken.select("row", "first", "last", "epoch", "shard", "place"), plan


def mix_report(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 13) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for each document.

    The documents of a source, in the order of a hash, form one run of words cut
    into blocks of 64. Output shards draw their slots' sources (:func:`drawn_slots`), a source's
    slots run through pseudorandom permutations of its blocks as often as
    needed, and blocks are joined by index. No block is taken over three times.

    A null text has no words; a null source is a source, the last. Documents with equal or
    null ids are rows of their own. Other columns are ignored; an empty table gives no rows.
    """
    row = F.monotonically_increasing_id().alias("row")
    rows, _ = keep(documents.select(row, F.col("doc_id").cast("bigint").alias("doc_id"), "source", _size().alias("size")), "sizes")
    pieces, plan = mixed_pieces(rows, weights, seed)
    taken = pieces.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    same = F.col("d.source").eqNullSafe(F.col("p.source"))
    sized = rows.alias("d").join(plan.alias("p"), same).select("d.row", "d.doc_id", "d.size", "p.source_size", "p.target")
    return sized.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = 13) -> DataFrame:
    """The mix itself: for each document and epoch, its taken words as a text.

    All columns are kept but ``text``, and ``n_chars`` where there is one, which
    describe the new text. Words keep the white space that follows them. Rows are told apart by a key of
    their own, so null and repeated ids lose and gain nothing; a document that is not taken has no row, nor has one without words.
    """
    names = [f"c_{i}" for i in range(len(documents.columns))]
    renamed = documents.select(*[F.col(c).alias(n) for c, n in zip(documents.columns, names)])
    text, source = (names[documents.columns.index(c)] for c in ("text", "source"))
    stored, _ = keep(renamed.withColumn("size", _size(text)).withColumn("row", F.monotonically_increasing_id()), "mixed-from")
    pieces, _ = mixed_pieces(stored.select("row", F.col(source).alias("source"), "size"), weights, seed)
    ranges = pieces.groupBy("row", "epoch").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("ranges"))
    ranges = ranges.groupBy("row").agg(F.collect_list("ranges").alias("epochs"))
    # The array of words is made once a document: a generator keeps it from being inlined where it is used.
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    rows = stored.join(ranges, "row").select(*names, "epochs", F.explode(F.array(words)).alias("words"))
    rows = rows.select(*names, "words", F.explode("epochs").alias("ranges"))
    cut = F.transform("ranges", lambda r: F.array_join(F.slice("words", (r["first"] + 1).cast("int"), (r["last"] - r["first"]).cast("int")), ""))
    rows = rows.withColumn("text", F.array_join(cut, ""))
    told = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return rows.select(*[told.get(c, F.col(n)).alias(c) for c, n in zip(documents.columns, names)])

"""Mixing sources to target weights.

The words of a source's documents form one stream, packed into blocks of fixed
length. A source is due a number of slots that brings its words to its target.
Every output shard draws its sources' counts from the slots that are left, a
multinomial draw without replacement, so that the counts of all shards add up
to what is due: one pseudorandom permutation of all slots deals them out. A
source's slots are mapped to its blocks by a pseudorandom permutation of its
own, once through all blocks before any is used again, and slots and blocks
meet in a join by block index.

Defined results: NULL text has no words; a NULL source is a source, ordered
last; a NULL id is an id; rows that repeat an id are documents of their own; an
empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.words import WORD_PATTERN, WS_CLASS, written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
ROUNDS = 16
#: Slots are generated in runs of this many, spread over all tasks.
RUN = 1 << 16


def permuted(x: Column, n: Column, key: Column) -> Column:
    """Image of ``x`` under a pseudorandom permutation of [0, n).

    Swap-or-not shuffle: a round pairs x with (k - x) mod n and a coin that
    both see swaps them, so each round is a bijection for every n.
    """
    def swap(acc: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, key), n) - acc, n)
        coin = F.xxhash64(F.greatest(acc, other), key, r).bitwiseAND(F.lit(1).cast("long"))
        return F.when(coin == 1, other).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, swap)


@dataclass
class Mix:
    """``documents``: each row's size, source and place in its source's stream.
    ``sources``: sizes, targets, blocks and slots. ``slots``: shard, slot,
    source and block of every slot. ``spans``: the words a document lends to a
    block."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    spans: DataFrame

    def takes(self) -> DataFrame:
        """Spans joined with how often the shards' slots use their block, and the
        first and last shard that do."""
        used = self.slots.groupBy("s", "block").agg(F.count("place").alias("times"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"))
        # Both sides grow with the words, whatever the planner makes of them.
        return self.spans.join(used.hint("merge"), ["s", "block"])


def source_targets(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each source. Targets share all words by weight; a source
    stops at ``MOST_REPEATS`` times its size, and the rest goes to the others.

    Sorted by cap over weight, the capped sources are a prefix: the level is
    found from running sums. One row a source, never one a document.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    filled = Window.orderBy(F.col("cap") / F.col("w"), "s")
    upto = filled.rowsBetween(Window.unboundedPreceding, 0)
    everyone = Window.partitionBy()
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("s", F.row_number().over(order).cast("long") - 1)
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("s") % len(WEIGHTS) + 1).cast("int")).cast("long")
    levels = (
        ranked.withColumn("w", w)
        .withColumn("cap", MOST_REPEATS * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(everyone))
        .withColumn("left", F.col("total") - F.sum("cap").over(upto) + F.col("cap"))
        .withColumn("w_left", F.sum("w").over(everyone) - F.sum("w").over(upto) + F.col("w"))
        # Capped while its share of what is left would pass its cap.
        .withColumn("capped", F.col("w") * F.col("left") > F.col("cap") * F.col("w_left"))
    )
    over = Window.partitionBy()
    rest = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(over)
    rest_w = F.sum(F.when(~F.col("capped"), F.col("w")).otherwise(0)).over(over)
    n_blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    due = F.round(F.coalesce(F.try_divide(F.col("target") * F.col("n_blocks"), F.col("source_size")), F.lit(0.0))).cast("long")
    return (
        levels.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("w") * rest.cast("double") / rest_w))
        .withColumn("n_blocks", n_blocks)
        .withColumn("n_slots", F.least(due, MOST_REPEATS * F.col("n_blocks")))
        .withColumn("first_slot", F.sum("n_slots").over(order) - F.col("n_slots"))
        .withColumn("all_slots", F.sum("n_slots").over(everyone))
        .select("source", "s", "source_size", "target", "n_blocks", "n_slots", "first_slot", "all_slots")
    )


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document's first word in its source's stream, ordered by a digest
    prefix of the id and the id. A running sum over (source, prefix) and one
    over its 4,096 prefixes, so a hot source is never one window."""
    part = Window.partitionBy("s", "part")
    inside = part.orderBy("_id", "_th").rowsBetween(Window.unboundedPreceding, 0)
    known = sized.join(
        sources.select(F.col("source").alias("_source"), "s", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    rows = known.withColumn("part", F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")).cast("binary")), 1, 3))
    before = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        rows.groupBy("s", "part").agg(F.sum("size").alias("part_size"))
        .withColumn("part_start", F.sum("part_size").over(before) - F.col("part_size"))
    )
    return (
        rows.withColumn("in_part", F.sum("size").over(inside) - F.col("size"))
        .join(parts, ["s", "part"])
        .withColumn("start", F.col("part_start") + F.col("in_part"))
        .select("_id", "_th", "source", "s", "size", "source_size", "target", "start")
    )


def deal(sources: DataFrame, seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Shard, place in the shard, source and block of every slot."""
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = lambda n, by: F.floor((n - 1) / by).cast("long")
    runs = (
        sources.where("n_slots > 0")
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), last(F.col("n_slots"), RUN))))
        .repartition(tasks, "s", "run")
    )
    end = F.least((F.col("run") + 1) * RUN, F.col("n_slots")) - 1
    j = F.col("j")
    slot = permuted(F.col("first_slot") + j, F.col("all_slots"), F.lit(seed).cast("long"))
    block = permuted(j % F.col("n_blocks"), F.col("n_blocks"), F.col("s") + (seed + 1))
    return (
        runs.withColumn("j", F.explode(F.sequence(F.col("run") * RUN, end)))
        .select("s", F.floor(j / F.col("n_blocks")).alias("epoch"), slot.alias("slot"), block.alias("block"))
        .select("s", "epoch", "block", F.floor(F.col("slot") / shard_slots).alias("shard"), (F.col("slot") % shard_slots).alias("place"))
    )


def row_key(text: Column, source: Column) -> Column:
    """Tells rows that share an id apart by text and source."""
    return F.xxhash64(text, text.isNull(), source, source.isNull())


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = BLOCK_WORDS, seed: int = 17) -> Mix:
    sized = written(
        docs.select(
            F.col(id_col).alias("_id"), row_key(F.col(text_col), F.col(source_col)).alias("_th"), F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix_sizes",
    )
    sources = written(source_targets(sized, block_words), "mix_sources")
    documents = written(placed(sized, sources), "mix_documents")
    first, end = F.col("start"), F.col("start") + F.col("size")
    block = F.col("block")
    spans = (
        documents.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(first / block_words), F.floor((end - 1) / block_words))))
        .withColumn("from_word", F.greatest(block * block_words, first) - first)
        .withColumn("to_word", F.least((block + 1) * block_words, end) - first)
        .select("_id", "_th", "s", "start", "block", "from_word", "to_word")
    )
    return Mix(documents, sources, deal(sources, seed), spans)


def taken(m: Mix) -> DataFrame:
    """Every document with the number of its words that the mix takes, and the
    first and last output shard that has some (NULL if none has)."""
    shards = {"first_shard": F.min, "last_shard": F.max}
    counts = (
        m.takes().groupBy("s", "start", "_id", "_th")
        .agg(F.sum((F.col("to_word") - F.col("from_word")) * F.col("times")).alias("taken"), *[f(c).alias(c) for c, f in shards.items()])
        .select("s", "start", F.col("_id").alias("_id2"), "taken", *shards)
    )
    d = m.documents
    full = d.where("size > 0").join(counts.hint("merge"), (d["s"] == counts["s"]) & (d["start"] == counts["start"]) & d["_id"].eqNullSafe(counts["_id2"]), "left")
    fields = [d[c] for c in ("_id", "source", "size", "source_size", "target")]
    none = [F.lit(None).cast("long").alias(c) for c in shards]
    return full.select(*fields, F.coalesce(counts["taken"], F.lit(0).cast("long")).alias("taken"), *shards).unionByName(
        d.where("size = 0").select(*fields, F.lit(0).cast("long").alias("taken"), *none)
    )


def first_row(columns: list[str], same: tuple[str, ...], row: str = "_row") -> Column:
    """Of rows that agree in ``same`` the one whose other columns come first as
    JSON (whatever their kinds), so that reruns agree."""
    others = [F.col(f"{row}.`{c}`") for c in columns if c not in same]
    return F.min_by(row, F.to_json(F.struct(F.lit(0).alias("_"), *others))).alias(row)


def mixed_documents(docs: DataFrame, m: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: the columns of ``docs``, one row for each time
    words of a document are used, with the text of those words and the white
    space after them. Rows that repeat an id, text and source are put together,
    with the other columns of the row whose others come first as JSON."""
    lent = (
        m.takes().groupBy(F.col("_id").alias("_id2"), F.col("_th").alias("_th2"))
        .agg(F.sort_array(F.collect_list(F.struct("from_word", "to_word", "start", "times"))).alias("_lent"))
    )
    rows = (
        docs.select(F.struct("*").alias("_row"))
        .select("_row", F.col(f"_row.{id_col}").alias("_id"), row_key(F.col(f"_row.{text_col}"), F.col(f"_row.{source_col}")).alias("_th"))
        .groupBy("_id", "_th").agg(first_row(docs.columns, (id_col, text_col, source_col)))
    )
    joined = rows.join(lent.hint("merge"), rows["_id"].eqNullSafe(lent["_id2"]) & (rows["_th"] == lent["_th2"]))
    body = F.regexp_replace(f"_row.{text_col}", f"^{WS_CLASS}+", "")
    ws, solid = WS_CLASS, WORD_PATTERN[:-1]
    used = F.filter("_lent", lambda x: x["times"] > F.col("_use"))
    text = F.array_join(F.flatten(F.transform(used, lambda x: F.slice("_pieces", x["from_word"].cast("int") + 1, (x["to_word"] - x["from_word"]).cast("int")))), "")
    out = {c: F.col(f"_row.{c}") for c in docs.columns} | {text_col: text}
    return (
        joined.withColumn("_pieces", F.split(body, f"(?<={ws})(?={solid})"))
        .withColumn("_use", F.explode(F.sequence(F.lit(0), F.array_max(F.transform("_lent", lambda x: x["times"])).cast("int") - 1)))
        .select(*(c.alias(k) for k, c in out.items()))
    )

"""Mixing sources to target weights by fixed-length blocks and index permutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm.shared import WORD, bucket_of, documents, free_name, range_bounds, shuffle_partitions, staged, with_positions

#: Rounds of the permutations' Feistel network.
ROUNDS = 4
WEIGHTS = [3, 1, 2]
SHARE, MOST_EPOCHS = 1.5, 2
#: Words in a block, output shards and seed of the registered query.
BLOCK, SHARDS, SEED = 256, 64, 17
#: Slots that one row is exploded to at a time.
CHUNK = 4096


def source_targets(rows: DataFrame) -> DataFrame:
    """One row per source with its size, target words and whole words to take.

    Sources by code point, null last, weigh WEIGHTS in turn and share SHARE of all sizes;
    a target over MOST_EPOCHS times its source stops there and the excess goes to the
    others by weight. That is a water level: with sources sorted by capacity over weight,
    the level is the first one that the source it is computed from does not cap. Only one
    row per source is sorted.
    """
    n = len(WEIGHTS)
    sizes = rows.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % n + 1).cast("int")).cast("double")).withColumn("cap", F.col("source_size") * MOST_EPOCHS)
    by = Window.orderBy("full_at", "rank")
    everything = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levelled = (
        weighed.withColumn("full_at", F.col("cap") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(SHARE))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("wanted") - F.col("capped")) / F.col("heavy"))
        .withColumn("water", F.first(F.when(F.col("level") <= F.col("full_at"), F.col("level")), ignorenulls=True).over(everything))
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("water"), F.col("full_at")) * F.col("weight"))
    return levelled.select("skey", "source_size", target.alias("target"), F.least(F.round(target).cast("long"), F.col("cap")).alias("take"))


def permuted(i: Column, n: Column, key: tuple[Column, ...], seed: int) -> Column:
    """Place of i, in 0 to n - 1, in a pseudorandom permutation of the n places that the key draws.

    A Feistel network over a grid of a x b places, a the root of n rounded up and b as few as
    hold n, permutes the grid. A place outside n is permuted on until it is inside (cycle
    walking). Less than a places are outside and a walk visits each once at most, so it
    ends within as many steps; as seldom as one starts, steps are few on average.
    """
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")

    def mixed(place: Column) -> Column:
        left, right = F.floor(place / b).cast("long"), F.pmod(place, b)
        for k in range(ROUNDS // 2):
            left = F.pmod(left + F.pmod(F.xxhash64(right, *key, F.lit(seed + 2 * k)), a), a)
            right = F.pmod(right + F.pmod(F.xxhash64(left, *key, F.lit(seed + 2 * k + 1)), b), b)
        return left * b + right

    def inside(place: Column) -> Column:
        walk = F.aggregate(F.sequence(F.lit(1).cast("long"), a * b - n), place, lambda at, _: F.when(at < n, at).otherwise(mixed(at)))
        return F.when(place < n, place).otherwise(walk)

    return F.transform(F.array(mixed(i)), inside).getItem(0)


def shard_counts(targets: DataFrame, block: int, shards: int, seed: int) -> DataFrame:
    """skey, epoch, shard, slots, first, words_left, blocks: how many of a source's slots each output shard holds.

    Whole epochs of a source are taken first; the last one ends inside a slot where its
    words are all taken. Counts are multinomial, given each source's total, so that the totals
    are the targets: every slot of an epoch draws a shard, and only the counts are kept. A
    shard's slots follow those of the shards before it, from first on.
    """
    t, size = F.col("take"), F.col("source_size")
    epochs = targets.where((size > 0) & (t > 0)).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(take - 1) div source_size"))))
    epochs = epochs.withColumn("words_left", F.least(size, t - F.col("epoch") * size)).withColumn("blocks", F.expr(f"source_size div {block}"))
    chunks = epochs.withColumn("from", F.explode(F.expr(f"sequence(0L, (words_left - 1) div {block}, {CHUNK}L)"))).repartition(shuffle_partitions(targets.sparkSession), "skey", "epoch", "from")
    drawn = chunks.withColumn("draw", F.explode(F.expr(f"sequence(from, least(from + {CHUNK - 1}, (words_left - 1) div {block}))")))
    shard = F.pmod(F.xxhash64("skey", "epoch", "draw", F.lit(seed)), F.lit(shards)).cast("int").alias("shard")
    counts = drawn.groupBy("skey", "epoch", shard, "words_left", "blocks").agg(F.count("*").alias("slots"))
    before = Window.partitionBy("skey", "epoch").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return counts.withColumn("first", F.coalesce(F.sum("slots").over(before), F.lit(0)))


def mixture_slots(counts: DataFrame, block: int, seed: int) -> DataFrame:
    """skey, epoch, slot, block_no, words, shard: which block each slot of the mix takes.

    An epoch visits every full block of a source once, in the order of a permutation
    drawn for that source and epoch, then the shorter last one. The counts of the shards
    say which slots there are.
    """
    chunks = counts.withColumn("from", F.explode(F.expr(f"sequence(0L, slots - 1, {CHUNK}L)"))).repartition(shuffle_partitions(counts.sparkSession), "skey", "epoch", "shard", "from")
    slots = chunks.withColumn("slot", F.explode(F.expr(f"sequence(first + from, first + least(from + {CHUNK - 1}, slots - 1))")))
    full = permuted(F.col("slot"), F.greatest(F.col("blocks"), F.lit(1)), (F.col("skey"), F.col("epoch")), seed)
    number = F.when(F.col("slot") < F.col("blocks"), full).otherwise(F.col("blocks"))
    return slots.select("skey", "epoch", "slot", number.alias("block_no"), F.least(F.lit(block), F.col("words_left") - F.col("slot") * block).alias("words"), "shard")


def block_pieces(docs: DataFrame, block: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Pack each source's words, in ascending id order, into blocks; also its targets.

    The pieces have a row per document and block it lies in (one with nulls for a
    document without words): doc_id, digest (hash of its text), skey, row (numbers a source's documents), size,
    source_size, target, block_no, low and high (place in the block), skip (its
    document's words before it).
    """
    source = F.col(source_col)
    rows = staged(
        docs.select(
            F.col(id_col).alias("doc_id"), source.alias("source"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("skey"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.lit(1).cast("long").alias("one"), F.xxhash64(text_col).alias("digest"),
        )
    )
    targets = staged(source_targets(rows))
    bounds = range_bounds(rows, "doc_id", 4 * shuffle_partitions(docs.sparkSession))
    placed = with_positions(rows.withColumn("bucket", bucket_of(F.col("doc_id"), bounds)), {"start": "size", "row": "one"}, ["doc_id", "size", "digest"], "bucket", ["skey"], targets)
    first, last = F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")
    pieces = placed.withColumn("block_no", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    base = F.col("block_no") * block
    pieces = pieces.select(
        "doc_id", "digest", "source", "skey", "row", "size", "source_size", "target", "block_no", F.greatest(F.col("start") - base, F.lit(0)).alias("low"), F.least(F.col("start") + F.col("size") - base, F.lit(block)).alias("high"), F.greatest(base - F.col("start"), F.lit(0)).alias("skip")
    )
    return pieces, targets


def mix_sources(docs: DataFrame, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED, **columns: str) -> DataFrame:
    """The mix: a row per document, block it lies in and slot that takes that block.

    Columns of block_pieces plus epoch, slot, shard and taken, the words the slot takes of
    the piece, which are its first ones. Pieces that no slot takes have null slots and
    taken 0. Each source gives its target, rounded to whole words, exactly, and no
    document more than MOST_EPOCHS times its size.

    Null or empty texts have size 0 and are in no block. Null sources are one source,
    apart from ''. Rows with one id lie side by side by size, in any order where that is
    equal too; they count one by one. Null ids come first. Extra columns are ignored. Words are
    split at space and control characters 9 to 13 only. Sources are summed per range of
    ids, and blocks are joined by source and number, so a source that holds most rows is
    spread like all others.
    """
    pieces, targets = block_pieces(docs, block, **columns)
    slots = mixture_slots(staged(shard_counts(targets, block, shards, seed + ROUNDS)), block, seed)
    taken = F.when(F.col("slot").isNull(), 0).otherwise(F.greatest(F.least("high", "words") - F.col("low"), F.lit(0))).cast("long")
    # A merge join by hint: the slots are exploded from few rows, by whose size they would be broadcast.
    return pieces.join(slots.hint("merge"), ["skey", "block_no"], "left").withColumn("taken", taken)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, source and others) as the mix takes them, with the same columns.

    A row per document and epoch with the words that the epoch's slots take of it, in
    their order and with the white space between them; documents of which nothing is taken
    go. n_chars, if there, is the new text's. Rows that repeat id and text are taken as
    often as the mix takes each of them. Texts meet their places by id and hash, once.
    """
    key, text, epochs = (free_name(docs, name) for name in ("mixed_key", "mixed_text", "mixed_epochs"))
    of_place = F.struct("doc_id", "digest").alias(key)
    parts = mix_sources(docs).where("taken > 0").groupBy(of_place, "skey", "row", "epoch").agg(F.array_sort(F.collect_list(F.struct("skip", "taken"))).alias("parts"))
    hashed = docs.withColumn(key, F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("digest")))
    places = parts.groupBy(key).agg(F.collect_list("parts").alias(epochs))  # MOST_EPOCHS a row, if ids are unique
    joined = hashed.join(places, key)
    repeated = parts.select(key, "row", "skey").distinct().groupBy(key).count().where("count > 1")
    if not repeated.isEmpty():
        joined = joined.dropDuplicates([key])
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))

    def texts_of(tokens: Column) -> Column:
        piece = lambda p: F.array_join(F.slice(tokens, (p["skip"] + 1).cast("int"), p["taken"].cast("int")), "")
        return F.transform(epochs, lambda parts: F.array_join(F.transform(parts, piece), ""))

    out = joined.withColumn(text, F.explode(F.transform(F.array(words), texts_of).getItem(0)))
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document how many of its words the mix takes, and in how many of its output shards they are."""
    mixed = mix_sources(documents(spark, sf_dir))
    shards = F.size(F.collect_set(F.when(F.col("taken") > 0, F.col("shard")))).alias("shards")  # SHARDS at most
    return mixed.groupBy("skey", "row", "doc_id", "size", "source_size", "target").agg(F.sum("taken").alias("taken"), shards).select("doc_id", "size", "source_size", "target", "taken", "shards")

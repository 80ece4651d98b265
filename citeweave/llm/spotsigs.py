"""SpotSigs: fingerprints from chains of content words that follow common words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeweave.llm.shared import bucket_of, documents, range_bounds, shuffle_partitions, staged

#: Common words of English, French, German and Spanish: the anchors, and the words that chains leave out.
ANCHORS = """
a an and are as at be but by for from had has have he her his i if in into is it its no not of on or she so that the their there they this to was we were which who will with would you
au aux avec ce dans de des du elle en est et il la le les leur lui mais ne ou par pas pour que qui se ses son sur un une
als auch auf aus bei das dem den der des die ein eine einer er es für ich im ist mit nach nicht sich sie und von war zu zum
al como con del el está las lo los más o pero por su sus y
""".split()
#: Content words in a chain.
CHAIN = 2
#: Sets that one salt of a spot holds in near_pairs.
SALTED = 256
#: Ranges of ids that a task of with_next treats one after another.
RANGES = 8


def _bound(value: Column, body) -> Column:  # noqa: ANN001
    """body(value), with value computed once however often body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def spots(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct 64-bit hashes of a text's spot signatures.

    Words are runs of letters and digits, lower-cased. Each anchor with the next `chain`
    content words is a signature. A text without one (few words, or a language without
    these anchors) gets the chains of all its words instead, and one too short for those
    a single signature of all its words. A null text or one without words has none.

    The k-th anchor, at word p, has p - k content words before it, so its chain is a
    stretch of the array of content words: each word is looked up twice, whatever the
    number of anchors.
    """
    anchors = sorted(set(ANCHORS))

    def chains(words: Column, heads: Column, others: Column) -> Column:
        """Of each head (a position among words, the k-th one) the hash of it and the chain of others after it, where they are enough."""
        signature = lambda p, k: F.xxhash64(F.get(words, p), *[F.get(others, p - k + j) for j in range(chain)])
        return F.array_compact(F.transform(heads, lambda p, k: F.when(p - k + chain <= F.size(others), signature(p, k))))

    def anchored(words: Column) -> Column:
        heads = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(anchors), i)))
        return _bound(F.filter(words, lambda w: ~w.isin(anchors)), lambda others: chains(words, heads, others))

    def fallback(words: Column) -> Column:
        every = F.array_compact(F.transform(words, lambda w, i: F.when(i + chain < F.size(words), F.xxhash64(*[F.get(words, i + j) for j in range(chain + 1)]))))
        whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
        return _bound(every, lambda a: F.when(F.size(a) > 0, a).otherwise(whole))

    def of(words: Column) -> Column:
        return _bound(anchored(words), lambda a: F.when(F.size(a) > 0, a).otherwise(fallback(words)))

    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.sort_array(F.array_distinct(_bound(words, of)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 if both are empty."""
    return _bound(F.size(F.array_intersect(a, b)), lambda both: F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / (F.size(a) + F.size(b) - both)))


def as_text(spotset: Column) -> Column:
    """A fingerprint as text: its hashes in hexadecimal, in order."""
    return F.array_join(F.transform(spotset, lambda h: F.hex(h)), ":")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with their spots and the text and spots of the next row: ascending doc_id, after the last the first.

    Rows are cut into ranges of near-equal counts by bounds that are ids of the table, and
    the first row of each range is copied behind the range before it, so every row finds
    the next one inside its own range and texts are shuffled once. Rows with one id are
    in order of their texts; null ids come first.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    bounds = range_bounds(docs, "doc_id", RANGES * parts)
    low, nulls = docs.agg(F.min("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    own = bucket_of(F.col("doc_id"), bounds)
    is_bound = F.coalesce(F.array_contains(F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>"), F.col("doc_id").cast("bigint")), F.lit(False)) if bounds else F.lit(False)
    is_first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(low)
    places = F.array_compact(
        F.array(
            F.struct(own.alias("bucket"), F.lit(0).alias("copy")),
            F.when(is_bound, F.struct((own - 1).alias("bucket"), F.lit(1).alias("copy"))),
            F.when(is_first, F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(1).alias("copy"))),
        )
    )
    dealt = docs.withColumn("at", F.explode(places)).select("doc_id", "text", "at.*").withColumn("part", F.expr(f"bucket div {RANGES}").cast("int")).repartitionById(parts, "part")
    order = ["part", "bucket", "copy", F.col("doc_id").asc_nulls_first(), "text"]
    ordered = dealt.sortWithinPartitions(*order).withColumn("spots", spots(F.col("text")))
    following = Window.partitionBy("part", "bucket").orderBy(*order[2:])
    return ordered.withColumn("next_text", F.lead("text").over(following)).withColumn("next_spots", F.lead("spots").over(following)).where("copy = 0").drop("part", "bucket", "copy")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and spots of every text; see spots() for null, empty and short texts. Rows are independent and repeated ones stay."""
    return docs.select(F.col(id_col).alias("id"), spots(F.col(text_col)).alias("spots"))


def near_pairs(prints: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Near duplicates among (id, spots): members (id, rep) and pairs (a, b, likeness) of representatives.

    Texts of equal spots share a representative, the smallest id (null if none has one), and are not paired.
    Representatives are dealt into partitions by the length of their set, each as wide as
    the threshold allows, so a set can only be like sets in its own partition and the one
    below. There sets meet at the rarest of their spots (as many as must hold one in
    common), if their lengths allow the threshold, and each pair is compared once by exact
    Jaccard. The sets of a spot that many have are dealt over salts, and met there by the shorter ones of
    each. Sets without spots are like nothing. An id with several texts may be like itself. Every
    pair is a row, so this is for tables whose groups of near copies are small; ngramjoin does without.
    """
    prints = prints.where(F.size("spots") > 0).withColumn("key", F.sha2(F.col("spots").cast("string").cast("binary"), 256))
    reps = staged(prints.groupBy("key").agg(F.min("id").alias("rep"), F.first("spots").alias("spots")).withColumn("n", F.size("spots")))
    members = prints.select("id", "key").join(reps.select("key", "rep"), "key").select("id", "rep")
    single = reps.select("key", "n", F.explode("spots").alias("spot"))
    counted = single.join(single.groupBy("spot").agg(F.count("*").alias("seen")).where("seen > 1"), "spot")
    ranked = counted.groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("seen", "spot"))).alias("shared"))
    # Spots that no other set has come first in rarity order, so only the rest of the prefix can meet anything.
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1 - (F.col("n") - F.size("shared"))
    postings = ranked.where(prefix > 0).withColumn("at", F.explode(F.slice("shared", 1, prefix.cast("int")))).select("key", "n", "at.spot", F.ceil(F.col("at.seen") / SALTED).alias("salts"))
    part = F.floor(F.log("n") / math.log(1 / threshold) + 1e-9)
    longer = postings.withColumn("part", F.explode(F.array(part, part - 1))).withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")))
    shorter = postings.withColumn("part", part).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    a, b = longer.alias("a"), shorter.alias("b")
    fits = (F.col("b.n") < F.col("a.n")) | ((F.col("b.n") == F.col("a.n")) & (F.col("b.key") < F.col("a.key")))
    met = a.join(b, (F.col("a.spot") == F.col("b.spot")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.salt") == F.col("b.salt")) & fits & (F.col("b.n") >= F.col("a.n") * threshold - 1e-9))
    pairs = met.select(F.col("a.key").alias("key_a"), F.col("b.key").alias("key_b")).distinct()
    side = lambda x: reps.select(F.col("key").alias(f"key_{x}"), F.col("rep").alias(x), F.col("spots").alias(f"spots_{x}"))
    compared = pairs.join(side("a"), "key_a").join(side("b"), "key_b").select("a", "b", likeness(F.col("spots_a"), F.col("spots_b")).alias("likeness"))
    return members, compared.where(F.col("likeness") >= threshold - 1e-12)


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's fingerprint, and how like it is to that of the edited text and of the next document.

    The edited text has its last quarter replaced by as much of the next document's
    start. A null text counts as empty. Equal texts have equal fingerprints.
    """
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n, quarter = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    rows = with_next(docs).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "spots", "next_spots")
    rows = rows.withColumn("edited_spots", spots(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), as_text(F.col("spots")).alias("fingerprint"), as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"), likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )

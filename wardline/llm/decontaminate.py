"""Benchmark decontamination by spaced seeds (operator 2); DataFrame functions only.

Texts become arrays of word hashes (lower case, letters and digits). A mask of five chosen places out
of six is laid at every place of a document and of a benchmark item, and the chosen words are hashed;
the places left out may differ. Documents meet the items' seeds by hash. A hit fixes an alignment;
there the item is compared with the document word by word, and the document is contaminated if some
``WINDOW`` consecutive item words (the whole of a shorter item) have at most ``misses`` substitutions.
The two masks together hit every such alignment (all patterns of misses were tried), so nothing that
meets the rule is lost. Items of under ``SEEDED`` words must stand in the document word for word; their one
seed is the hash of the whole item, and documents make such hashes for the lengths that occur.

Hits are reduced to distinct alignments before documents are read again for the comparison, so a passage
copied word for word is compared once, not once per word, and no text is carried along with hits.

Null or empty texts hold no words and are clean. Null ``doc_id``: reported as null. Repeated rows are
reported once per ``doc_id`` and item. Items without words (and null ones) match nothing. A character of a
script without blanks is a word. An empty table gives no rows. Other columns are ignored. A word hash stands for its word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places of six consecutive words that a seed looks at.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 4, 5))
SPAN = 6
WINDOW = 16
#: Items from so many words on are found by the masks, shorter ones as a whole.
SEEDED = 8

#: Characters of Thai, Lao, Burmese, Khmer, kana and Chinese writing, which has no blanks between words.
UNSPACED = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"

#: Items' seeds are broadcast up to this many rows (some 50 bytes each); beyond it the join shuffles.
BROADCAST_SEEDS = 500_000


def misses(words: Column) -> Column:
    """Substitutions allowed in a window: 3 in 16, one in seven of a shorter item, none in a very short one."""
    return F.when(words >= WINDOW, F.lit(3)).when(words >= SEEDED, F.floor(words / 7)).otherwise(F.lit(0)).cast("int")


def word_hashes(text: Column) -> Column:
    """64-bit hashes of a text's words: runs of letters and digits, in lower case."""
    read = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    split = F.split(F.regexp_replace(read, f"({UNSPACED})", " $1 "), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(split, ""), lambda w: F.xxhash64(w))


def _seed(words: str, at: Column, mask: tuple[int, ...]) -> Column:
    return F.xxhash64(F.lit(mask[2]), *[F.get(words, at + F.lit(k)) for k in mask])


def _seeds(rows: DataFrame, words: str, at: str, keep: list[str]) -> DataFrame:
    """A row per place and mask: ``mask, seed`` beside the kept columns; the words stay behind."""
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(SPAN))
    placed = rows.filter(F.size(words) >= SPAN).select(*keep, words, F.explode(starts).alias(at))
    each = F.array(*[F.struct(F.lit(m).alias("mask"), _seed(words, F.col(at), mask).alias("seed")) for m, mask in enumerate(MASKS)])
    return placed.select(*keep, at, F.explode(each).alias("s")).select(*keep, at, "s.mask", "s.seed")


def _whole(words: str, at: Column, n: Column) -> Column:
    """The hash of ``n`` words from a place on."""
    return F.xxhash64(n, F.slice(words, at + F.lit(1), n))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc_id, item_id, n_words`` (of the item)``, n_matched`` (on its best alignment), ``doc_word`` (where that begins)."""
    wanted = items.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("item"))
    wanted = wanted.filter(F.size("item") > 0).distinct().withColumn("item_key", F.xxhash64("item_id", "item"))
    seeds = _seeds(wanted.filter(F.size("item") >= SEEDED), "item", "item_at", ["item_key"])
    short = wanted.filter(F.size("item") < SEEDED).select("item_key", F.size("item").alias("n"), _whole("item", F.lit(0), F.size("item")).alias("seed"))
    # SEEDED - 1 lengths at most.
    lengths = {r["n"]: r["count"] for r in short.groupBy("n").count().collect()}
    few = seeds.count() + sum(lengths.values()) <= BROADCAST_SEEDS
    if few:
        seeds, wanted, short = F.broadcast(seeds), F.broadcast(wanted), F.broadcast(short)
    read = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"),
    ).withColumn("mark", F.xxhash64("body"))
    words = read.select("doc_id", "mark", word_hashes(F.col("body")).alias("words"))

    # Rows of this join are narrow, and only hits leave it. A passage has many hits but one alignment.
    hits = _seeds(words, "words", "at", ["doc_id", "mark"]).join(seeds, ["mask", "seed"])
    hits = hits.select("doc_id", "mark", "item_key", (F.col("at") - F.col("item_at")).alias("shift"))
    for n in sorted(lengths):
        starts = words.filter(F.size("words") >= n).select("doc_id", "mark", "words", F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("shift"))
        starts = starts.select("doc_id", "mark", "shift", F.lit(n).alias("n"), _whole("words", F.col("shift"), F.lit(n)).alias("seed"))
        hits = hits.unionByName(starts.join(short, ["n", "seed"]).select("doc_id", "mark", "item_key", "shift"))
    placed = hits.distinct()
    named = placed.groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m")).agg(F.collect_list(F.struct("item_key", "shift")).alias("found"))
    hit_docs = read.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")))
    split = hit_docs.select("doc_id", word_hashes(F.col("body")).alias("words"), "found")
    aligned = split.select("doc_id", "words", F.explode("found").alias("f")).select("doc_id", "words", "f.item_key", "f.shift").join(wanted, "item_key")

    # 1 where the item's word stands in the document at this alignment
    same = F.transform(
        F.sequence(F.lit(0), F.size("item") - 1),
        lambda j: F.coalesce((F.get("item", j) == F.get("words", F.col("shift") + j)).cast("int"), F.lit(0)),
    )
    wide = F.least(F.lit(WINDOW), F.size("item"))
    near = F.exists(
        F.sequence(F.lit(1), F.size("item") - F.col("wide") + 1),
        lambda s: F.aggregate(F.slice("same", s, F.col("wide")), F.lit(0), lambda a, x: a + x) >= F.col("least"),
    )
    compared = aligned.select("doc_id", "item_id", "shift", F.size("item").alias("n_words"), "item", same.alias("same"), wide.alias("wide"))
    compared = compared.withColumn("least", F.col("wide") - misses(F.col("wide"))).filter(near)
    total = F.aggregate("same", F.lit(0), lambda a, x: a + x)
    return (
        compared.select("doc_id", "item_id", "n_words", F.struct(total.alias("n_matched"), (-F.col("shift")).alias("back")).alias("b"))
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_words").alias("n_words"), F.max("b").alias("b"))
        .select(
            "doc_id",
            "item_id",
            "n_words",
            F.col("b.n_matched").alias("n_matched"),
            F.greatest(F.lit(0), -F.col("b.back")).alias("doc_word"),
        )
    )

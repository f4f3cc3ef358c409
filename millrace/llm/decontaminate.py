r"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-case words of letters and digits. A mask marks which positions
of a window count and which are ignored; windows of benchmark items and of
documents are hashed under every mask and joined. A hit gives an alignment of
item and document; around it, their overlap is verified word by word, and
substituted words are tolerated. Of a run of hits on one alignment only the
first is joined.

A document is contaminated by an item if, on some alignment, a window of
``WINDOW`` words (of the whole item, if that is shorter) agrees in at least
``AGREEMENT`` of its words. The masks of ``FAMILIES`` hit every pattern of
substitutions that this allows, so that nothing it calls contaminated is missed.

Seeds are small rows of fixed size, without words, and are broadcast in blocks
of at most about ``BLOCK_SEEDS``; the documents are read once for each block
and never shuffled. The words of an item join its hits afterwards, from a
written table that Spark broadcasts if its measured size allows it.

Defined results: null and empty texts, of documents and of items, overlap
nothing; very long texts are compared whole; repeated documents with one id
give one row for each item, as do repeated items; of several windows that
agree alike the last in the document is reported; null ids are kept as such;
empty tables give no rows. Items of fewer than ``least_words`` words take no
part; ``left_out`` lists them. Other columns are ignored. Only built-in
functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import saved
from millrace.session import scratch_path

WINDOW, AGREEMENT = 13, 0.75
#: Masks by the number of words of an item, ``WINDOW`` for longer ones too. 1 is
#: a position that counts, and ignored ones meet any word. Found by enumeration:
#: in so many words, every pattern with ``AGREEMENT`` leaves one mask untouched.
FAMILIES = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("111", "1011", "1101"),
    5: ("111", "1101"),
    6: ("1111", "11011"),
    7: ("11011",),
    8: ("11011", "1111", "1100011"),
    9: ("111011", "1001111", "11010011", "111101"),
    10: ("111011", "11010011", "11111"),
    11: ("1101011", "1110011"),
    12: ("111011", "110100011", "11001011", "110111"),
    13: ("110111", "111011", "1101000011"),
}
#: Seeds broadcast at once, of 32 bytes each: hash, item, position, hash of the window before.
BLOCK_SEEDS = 200_000


def words(text: Column) -> Column:
    """Hashes of the words of a text."""
    found = F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)
    )
    return F.transform(found, lambda word: F.xxhash64(word))


def window_hash(words: Column, at: Column, mask: str, number: int) -> Column:
    """The hash of the counting positions of the window at ``at``."""
    chosen = [F.get(words, at + n) for n, counts in enumerate(mask) if counts == "1"]
    return F.xxhash64(F.lit(number), *chosen)


def windows(words: str, at: str, masks: list[str]) -> Column:
    """Hashes of the windows at a position, one for each mask that fits in there."""
    left = F.size(words) - F.col(at)
    return F.array(
        *(
            F.when(left >= len(mask), window_hash(F.col(words), F.col(at), mask, number))
            for number, mask in enumerate(masks)
        )
    )


def overlap(item: Column, doc: Column, shift: Column) -> Column:
    """The best agreement of a window of an item with the document, aligned by ``shift``.

    A struct of agreeing words, the window's words, and its start in the document.
    """
    size = F.least(F.size(item), F.lit(WINDOW))
    agree = F.transform(
        F.sequence(F.lit(0), F.size(item) - 1),
        lambda n: F.when((shift + n >= 0) & (F.get(doc, shift + n) == F.get(item, n)), 1).otherwise(0),
    )
    return F.array_max(
        F.transform(
            F.sequence(F.lit(0), F.size(item) - size),
            lambda n: F.struct(
                F.aggregate(F.slice(agree, n + 1, size), F.lit(0), lambda a, b: a + b).alias("agree"),
                size.alias("of"),
                (shift + n).alias("start"),
            ),
        )
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    least_words: int = 1,
) -> DataFrame:
    """One row per contaminated document and item.

    Columns: doc_id, item_id, agreeing words of the best window, its length
    and its first word's number in the document.
    """
    items = numbered(benchmark, item_id, text, least_words)
    size = F.least(F.size("words"), F.lit(WINDOW))
    lengths = [row["n"] for row in items.select(size.alias("n")).distinct().collect()]  # WINDOW numbers at most
    families = {n: FAMILIES[n] for n in sorted(lengths) or [WINDOW]}
    masks = sorted({mask for family in families.values() for mask in family})
    own = F.lit(False)  # an item uses the masks of its length
    for n, family in families.items():
        own = own | ((size == n) & F.col("mask").isin([masks.index(mask) for mask in family]))

    seeds = (
        items.select("item", "words", F.posexplode("words").alias("item_at", "_"))
        .select(
            "item", "words", "item_at",
            F.posexplode(windows("words", "item_at", masks)).alias("mask", "hash"),
        )
        .where(F.col("hash").isNotNull() & own)
        .select("hash", "item", "item_at", "mask", before("words", "item_at", masks).alias("before"))
    )
    blocks = -(-max(seeds.count(), 1) // BLOCK_SEEDS)
    tokens = docs.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("words"))
    # The outer form: otherwise Spark infers a filter on the words and makes them twice.
    at = tokens.select("doc_id", "words", F.posexplode_outer("words").alias("at", "_")).select(
        "doc_id", "words", "at", F.explode(windows("words", "at", masks)).alias("hash")
    )
    found = []
    for block in range(blocks):
        part = seeds.where(F.pmod(F.xxhash64("item", "item_at", "mask"), F.lit(blocks)) == block)
        # The first of a run of hits: the windows just before differ, or there is none.
        first = ~F.coalesce(before("words", "at", masks) == F.col("before"), F.lit(False))
        hits = at.join(F.broadcast(part), (at["hash"] == part["hash"]) & first).select(
            "doc_id", "words", "item", (F.col("at") - F.col("item_at")).alias("shift")
        )
        texts = items.select("item", "item_id", F.col("words").alias("item_words"))
        found.append(
            hits.join(texts, "item").select(
                "doc_id", "item_id",
                overlap(F.col("item_words"), F.col("words"), F.col("shift")).alias("best"),
            )
        )
    # Filtered only now: before, Spark would verify inside the join, outside generated code.
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("doc_id", "item_id")
        .agg(F.max("best").alias("best"))
        .where(F.col("best.agree") >= AGREEMENT * F.col("best.of"))
        .select("doc_id", "item_id", "best.agree", F.col("best.of").alias("window"), "best.start")
    )


def numbered(benchmark: DataFrame, item_id: str, text: str, least_words: int) -> DataFrame:
    """Distinct items with their words and a number, written so that the numbers stay and the size is known."""
    items = (
        benchmark.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("words"))
        .where(F.size("words") >= max(least_words, 1))
        .distinct()
        .withColumn("item", F.monotonically_increasing_id())
    )
    return saved(items, scratch_path(benchmark.sparkSession, "benchmark"))


def left_out(benchmark: DataFrame, least_words: int, text: str = "text") -> DataFrame:
    """The items that ``least_words`` leaves out, with all their columns."""
    return benchmark.where(F.size(words(F.col(text))) < least_words)


def before(words: str, at: str, masks: list[str]) -> Column:
    """The hash of the window one word earlier, under the mask of the row; null at the start."""
    hashed = F.lit(None).cast("long")
    for number, mask in enumerate(masks):
        hashed = F.when(
            F.col("mask") == number, window_hash(F.col(words), F.col(at) - 1, mask, number)
        ).otherwise(hashed)
    return F.when(F.col(at) > 0, hashed)


def without_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = 1,
) -> DataFrame:
    """The documents that no item contaminates; one without an id goes by its own text.

    What is contaminated is written first: Spark broadcasts it if its measured
    size allows that, and the texts are shuffled only if it does not.
    """
    # No id in digits is as long as a digest.
    key = F.coalesce(F.col(doc_id).cast("string"), F.sha2(F.col(text), 256))
    keyed = docs.select(key.alias("doc"), F.col(text).alias("text"))
    bench = benchmark.select(F.lit(0).alias("item_id"), F.col(text).alias("text"))
    leaked = overlaps(keyed, bench, doc_id="doc", least_words=least_words)
    leaked = leaked.select(F.col("doc_id").alias("doc")).distinct()
    leaked = saved(leaked, scratch_path(docs.sparkSession, "contaminated"))
    return docs.join(leaked, key == leaked["doc"], "left_anti")

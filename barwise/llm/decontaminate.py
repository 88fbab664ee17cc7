"""Benchmark decontamination: passages of benchmark items in documents.

Method: prefix-filtered set join over item-sized windows.  An item's windows
are its runs of 13 words (a shorter item is one window).  Words of the items
are ordered by rarity (their counts over all documents); as a match must hold
*all* of a window's words, the necessary prefix is its one rarest word.
Document words join the windows on it; the word's place in the window gives the
one start that can match (positional bound), which must leave room for the
window in the document (length bound); the window is then compared word for
word.  Only candidate documents are read a second time for that comparison.

Only DataFrame functions are used.  Words are lower-cased A-Z and run over
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

Results for odd input: null and empty texts have no words and are clean; items
without words have no window.  Repeated rows each get the result of their
(doc_id, text); a null doc_id stays null.  Items that repeat an item_id count
once; the passages of items without an item_id are hit words like any others, but
such items are not counted or listed.  Empty tables give clean documents or an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwise.llm.setjoin import checked_broadcast
from barwise.session import scratch, written

WINDOW = 13
#: Contaminated: at least one in this many words is inside a window.
SHARE = 20
#: As the contract's class after lower-casing, with A-Z let in before it.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What lies between words: the characters that ``WORDS`` excludes, one by one, which Java looks up in a table.
BETWEEN = "[" + "".join(f"\\x{i:02X}" for i in range(0x80) if not chr(i).isalnum()) + "]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str = "text") -> Column:
    """The words of a text column, not yet lower-cased."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")


def low(word: str) -> Column:
    """A-Z lower-cased; a word of ASCII bytes alone takes the short way."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id and window (array of words) of every item's distinct windows."""
    word = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORDS), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), word.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window")).distinct()


def index(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct windows with their rarest word and its (0-based) place; ties by word."""
    shapes = found.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    shapes = written(shapes, "windows")
    vocabulary = written(shapes.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    spoken = docs.select(F.explode(words()).alias("raw")).select(low("raw").alias("word"))
    counts = spoken.join(checked_broadcast(vocabulary, vocabulary.count()), "word").groupBy("word").count()
    places = shapes.select("window", F.posexplode("window").alias("place", "word"))
    rarest = (places.join(counts, "word", "left").groupBy("window")
              .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "word", "place")).alias("r"), F.min(F.coalesce("count", F.lit(0))).alias("least")))
    # a window with a word that no document holds cannot occur
    return written(rarest.where("least > 0").join(shapes, "window").select("window", "items", "r.word", "r.place"), "rare_index")


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, text_key, start (0-based word), length and items of every occurrence of a window."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    rare = index(docs, windows(benchmark, size))
    entries = rare.select("word").distinct()
    seen = keyed.select("doc_id", "text_key", F.posexplode(words()).alias("at", "raw")).select("doc_id", "text_key", "at", low("raw").alias("word"))
    hits = seen.join(checked_broadcast(entries, entries.count()), "word")
    hits = written(hits.distinct(), "hits")
    holders = written(hits.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")).distinct(), "holders")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    texts = keyed.join(checked_broadcast(holders, holders.count()), same, "left_semi").dropDuplicates(["doc_id", "text_key"])
    texts = texts.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), words().alias("said"))
    starts = hits.join(rare, "word").select("doc_id", "text_key", (F.col("at") - F.col("place")).alias("start"), "window", "items").where("start >= 0")
    return (starts.join(texts, same).where("start + size(window) <= size(said)")
            .select("doc_id", "text_key", "start", "window", "items", F.expr("slice(said, start + 1, size(window))").alias("said"))
            .where(F.expr("transform(said, x -> if(octet_length(x) = char_length(x), lower(x), "
                          f"translate(x, '{UPPER}', '{LOWER}'))) = window"))
            .select("doc_id", "text_key", "start", F.size("window").alias("length"), "items"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: int = SHARE) -> DataFrame:
    """doc_id, text_key, n_words, n_hit, n_items, items_sha256 and contaminated of every row."""
    with scratch(docs.sparkSession) as keep:
        dirty = keep(written(_dirty(written(occurrences(docs, benchmark, size), "occurrences")), "dirty"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       F.size(words()).cast("long").alias("n_words"))
    rows = rows.join(dirty, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return (rows.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"))
            .withColumn("contaminated", F.expr(f"n_hit > 0 and {share} * n_hit >= n_words")))


def _dirty(found: DataFrame) -> DataFrame:
    """of_id, of_key, n_hit and items of the documents with occurrences."""
    # words inside any occurrence: each start adds what the ones before it do not cover
    before = Window.partitionBy("doc_id", "text_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.groupBy("doc_id", "text_key", "start").agg(F.max("length").alias("length"))
    ends = spans.withColumn("covered", F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest("start", "covered"))
    n_hit = ends.groupBy("doc_id", "text_key").agg(F.sum(fresh).alias("n_hit"))
    items = (found.select("doc_id", "text_key", F.explode("items").alias("item_id")).distinct().groupBy("doc_id", "text_key")
             .agg(F.array_sort(F.collect_list("item_id")).alias("items")))
    dirty = (n_hit.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"})
             .join(items, F.col("of_id").eqNullSafe(F.col("doc_id")) & (F.col("of_key") == F.col("text_key")), "left"))
    return dirty.select("of_id", "of_key", "n_hit", "items")


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: int = SHARE) -> DataFrame:
    """``docs`` without the contaminated rows."""
    with scratch(docs.sparkSession) as keep:
        dirty = keep(written(contamination(docs, benchmark, size, share).where("contaminated")
                             .select(F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key")).distinct(), "contaminated"))
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (F.xxhash64("text") == F.col("__llm_key"))
    return docs.join(checked_broadcast(dirty, dirty.count()), same, "left_anti")

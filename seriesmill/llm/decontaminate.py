"""Benchmark decontamination: a prefix-filtered join of document words with item windows, DataFrame functions only.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. A window is ``width``
consecutive words of an item; an item with fewer words, but not none, is one window. For an exact containment one
token of the window is a sufficient prefix: the word that is rarest over all documents. Document words are joined
with these words only; the place of the word bounds where the window begins and has to end, and the words there are
compared with the window. What is joined grows with the occurrences of rare words, and windows found are kept per
place of a document, so a passage in a third of all documents adds a row per place and no pairs.

The list of windows is broadcast up to ``session.LOOKUP_ROWS`` rows and joined by shuffle beyond that.
Nulls and texts without words hit nothing; items with a null id or without words are left out; repeated items count once,
repeated documents get equal rows; a null ``doc_id`` is kept. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.packing import packed, unpacked
from seriesmill.session import lookup, stage

WIDTH = 10
#: The two alphabets, and what stands between words before A-Z are lower-cased: ASCII other than letters and digits.
#: Listed one by one, the characters are looked up in a table; ranges are tried one after another.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = "[" + "".join(rf"\x{c:02X}" for c in range(128) if chr(c) not in UPPER + LOWER + "0123456789") + "]+"


def parts(text: Column) -> Column:
    """The words in their own case; the first and the last may be empty, which equals no word."""
    return F.split(text, BETWEEN)


def n_words(words: Column) -> Column:
    empty = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0) + F.when(
        (F.size(words) > 1) & (F.element_at(words, -1) == ""), 1
    ).otherwise(0)
    return F.coalesce(F.when(words.isNotNull(), F.size(words) - empty), F.lit(0)).cast("long")


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """(item_id, window): window is an array of lower-cased words."""
    clean = F.filter(parts(F.translate("text", UPPER, LOWER)), lambda w: w != "")
    words = items.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", clean.alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    starts = F.explode(F.sequence(F.lit(1), last + 1))
    placed = words.filter(F.size("words") > 0).select("item_id", "words", starts.alias("start"))
    return placed.select("item_id", F.slice("words", F.col("start"), F.lit(width)).alias("window")).distinct()


def occurrences(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, digest, window, start) of every place where a document holds a window; digest is a hash of its text."""
    windows = stage(item_windows(items, width).select("window").distinct(), "windows")
    tokens = windows.select(F.explode(F.array_distinct("window")).alias("word")).distinct()
    words = docs.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("digest"), parts(F.col("text")).alias("words"))
    vocabulary = lookup(tokens.select(F.lower("word").alias("low")).distinct())
    counts = words.select(F.explode("words").alias("word")).select(F.lower("word").alias("low")).join(vocabulary, "low").groupBy("low").count()
    ranked = windows.select("window", F.posexplode("window").alias("at", "word")).withColumn("low", F.lower("word"))
    ranked = ranked.join(stage(counts, "word-counts"), "low", "left")
    rarest = F.min_by(F.struct("low", "at"), F.struct(F.coalesce("count", F.lit(0)), F.col("low"), F.col("at")))
    prefixes = ranked.groupBy("window").agg(rarest.alias("rare"), F.max(F.coalesce("count", F.lit(0)) == 0).alias("absent"))
    # A window with a word that no document has occurs nowhere.
    prefixes = lookup(prefixes.filter("NOT absent").select("window", "rare.low", "rare.at"))
    exploded = words.select("doc_id", "digest", "words", F.posexplode("words").alias("pos", "word"))
    # Up to ``width`` words on each side hold every window around the place; the rest of the text is not joined.
    first = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    near = F.slice("words", first + 1, F.lit(2 * width - 1))
    placed = exploded.select("doc_id", "digest", "pos", F.lower("word").alias("low"), near.alias("near"), first.alias("first"))
    found = placed.join(prefixes, "low").withColumn("start", F.col("pos") - F.col("at"))
    fits = found.filter("start >= first AND start - first + size(window) <= size(near)")
    there = F.slice("near", F.col("start") - F.col("first") + 1, F.size("window"))
    same = F.translate(F.array_join(there, " "), UPPER, LOWER) == F.array_join("window", " ")
    return fits.filter(same).select("doc_id", "digest", "window", "start")


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    found = stage(occurrences(docs, items, width).distinct(), "occurrences")
    places = F.flatten(F.collect_list(F.sequence(F.col("start"), F.col("start") + F.size("window") - 1)))
    hits = found.groupBy("doc_id", "digest").agg(F.size(F.array_distinct(places)).cast("long").alias("hits"))
    named = found.select("doc_id", "digest", "window").distinct().join(item_windows(items, width), "window")
    ids = F.array_sort(F.transform(F.collect_set("item_id"), lambda i: i.cast("string")))
    held = named.groupBy("doc_id", "digest").agg(ids.alias("ids"))
    marked = hits.join(held, hits.doc_id.eqNullSafe(held.doc_id) & (hits.digest == held.digest)).select(
        hits.doc_id.alias("_id"), hits.digest.alias("_digest"), "hits", "ids"
    )
    marked = stage(marked, "contaminated")
    # A column of its own: Spark would split a text again for each use in ``n_words``.
    base = docs.select("doc_id", F.xxhash64("text").alias("digest"), parts(F.col("text")).alias("words"))
    base = base.select("doc_id", "digest", n_words(F.col("words")).alias("n_words"))
    both = base.join(marked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
    return both.select(
        "doc_id",
        "n_words",
        F.coalesce("hits", F.lit(0)).alias("n_hit"),
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("hits").isNotNull().alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents that hold no window of any item, with their columns as they were."""
    hit = stage(occurrences(docs, items, width).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(), "hit")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_digest"))
    return unpacked(packed(docs, "doc_id", "text").join(hit, same, "left_anti"), docs.columns, ("doc_id", "text"))

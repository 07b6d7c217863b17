"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is `span` consecutive words of an item, or all words of a shorter item. For windows of
n words, k-grams of k = (n + 1) // 2 words are hashed and each window is known by the least hash
among its n - k + 1 k-grams, its fingerprint: equal windows have equal fingerprints, so no shared
window is missed. Neighbouring windows mostly share their fingerprint, so a text keeps one row
for each run of windows with the same one. Runs of documents whose fingerprint an item has are
extended to their windows, and these are compared with the windows of items word by word.

Arrays of runs are unfolded by the outer generators, though none is empty: for the others the
optimizer infers a filter on the array's size and moves it below the projections that build it.

The items' fingerprints are broadcast only when their counted number is below a bound; beyond
it, fingerprints are joined by a shuffle and matched documents are read a second time.

Defined results: a null or empty text has no words; an item without words has no window; rows
that repeat an id with another text are documents of their own, rows that repeat both get the
same result each; null ids are kept; an empty table of items leaves every document clean; other
columns are ignored."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut

SPAN = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# fingerprints of 8 bytes; about 16 MB as a hash table in an executor
BROADCAST_ROWS = 500_000


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; `lower` does just that where every character is one byte."""
    by_letter = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(by_letter)


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def _runs(df: DataFrame, lengths: list[int]) -> DataFrame:
    """`df` (with `words`) and `runs`: array of (fingerprint, first, until, n), the windows of n words
    that start at first..until-1 and share a fingerprint."""
    df = df.withColumn("_h", F.transform("words", lambda w: F.xxhash64(w)))
    names = []
    for n in lengths:
        k = (n + 1) // 2
        grams = F.slice("_h", F.lit(1), F.greatest(F.size("_h") - (k - 1), F.lit(0)))
        df = df.withColumn("_g", _gram_hashes(grams, k))
        df = df.withColumn("_m", _window_minima(F.slice("_g", F.lit(1), F.greatest(F.size("_h") - (n - 1), F.lit(0))), n - k + 1))
        df = df.withColumn("_s", _changes())
        name = f"_runs{n}"
        df = df.withColumn(name, _as_runs(n)).drop("_g", "_m", "_s")
        names.append(name)
    return df.withColumn("runs", F.concat(*names)).drop("_h", *names)


def _gram_hashes(grams: Column, k: int) -> Column:
    def one(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.get("_h", i + j) for j in range(1, k)])

    return F.transform(grams, one)


def _window_minima(grams: Column, width: int) -> Column:
    def one(x: Column, i: Column) -> Column:
        return F.least(x, *[F.get("_g", i + j) for j in range(1, width)]) if width > 1 else x

    return F.transform(grams, one)


def _changes() -> Column:
    """Positions where the fingerprint differs from the one before."""
    every = F.when(F.size("_m") > 0, F.sequence(F.lit(0), F.size("_m") - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.filter(every, lambda i: (i == 0) | (F.get("_m", i) != F.get("_m", i - 1)))


def _as_runs(n: int) -> Column:
    def one(s: Column, j: Column) -> Column:
        return F.struct(
            F.get("_m", s).alias("fingerprint"),
            s.alias("first"),
            F.coalesce(F.get("_s", j + 1), F.size("_m")).alias("until"),
            F.lit(n).alias("n"),
        )

    return F.transform("_s", one)


def _window_texts(first: Column, until: Column, n: Column) -> Column:
    return F.transform(F.sequence(first, until - 1), lambda s: F.array_join(F.slice("words", s + 1, n), " "))


def item_windows(items: DataFrame, span: int = SPAN) -> tuple[DataFrame, list[int]]:
    """(window, fingerprint, n, items) of items given as (item_id, text), and the window lengths that occur."""
    worded = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    sized = cut(worded.withColumn("n", F.least(F.size("words"), F.lit(span))))
    # at most `span` different lengths
    lengths = sorted(r["n"] for r in sized.select("n").distinct().collect())
    if not lengths:
        return sized.sparkSession.createDataFrame([], "window string, fingerprint bigint, n int, items array<bigint>"), []
    runs = _runs(sized.withColumnRenamed("n", "own"), lengths).select("item_id", "words", "own", F.inline_outer("runs")).where("n = own")
    windows = runs.select(
        "item_id", "fingerprint", "n", F.explode_outer(_window_texts(F.col("first"), F.col("until"), F.col("n"))).alias("window")
    )
    return windows.groupBy("window", "fingerprint", "n").agg(F.collect_set("item_id").alias("items")), lengths


def decontaminate(
    documents: DataFrame, items: DataFrame, *, span: int = SPAN, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Per row of `documents` (doc_id, text): doc_id, text_hash, n_words, n_hit (words inside an item's
    window) and items (sorted array of the ids, as strings, of items with such a window)."""
    windows, lengths = item_windows(items, span)
    windows = cut(windows)
    prints = cut(windows.select("fingerprint", "n").distinct())
    worded = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    if lengths:
        worded = _runs(worded, lengths)
    else:
        worded = worded.withColumn("runs", F.expr("cast(array() as array<struct<fingerprint:bigint,first:int,until:int,n:int>>)"))
    # one more row for each document, which meets no fingerprint and carries its number of words
    own = F.struct(
        F.lit(None).cast("bigint").alias("fingerprint"), F.lit(-1).alias("first"), F.size("words").alias("until"), F.lit(0).alias("n")
    )
    if prints.count() <= broadcast_rows:
        every = worded.select("doc_id", "text_hash", "words", F.inline_outer(F.concat(F.array(own), "runs")))
        met = every.join(F.broadcast(prints.withColumn("met", F.lit(True))), ["fingerprint", "n"], "left")
        kept = met.where("met or first < 0")
        texts = F.when(F.col("first") >= 0, _window_texts(F.col("first"), F.col("until"), F.col("n")))
        read = cut(kept.select("doc_id", "text_hash", "first", "until", "n", texts.alias("texts")))
    else:
        every = worded.select("doc_id", "text_hash", F.inline_outer(F.concat(F.array(own), "runs")))
        met = every.join(prints.withColumn("met", F.lit(True)), ["fingerprint", "n"], "left")
        kept = cut(met.where("met or first < 0").select("doc_id", "text_hash", "first", "until", "n"))
        places = kept.where("first >= 0").distinct().groupBy("doc_id", "text_hash").agg(
            F.collect_list(F.struct("first", "until", "n")).alias("places")
        )
        again = documents.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
        same = places["doc_id"].eqNullSafe(again["_id"]) & (places["text_hash"] == again["_hash"])
        found = places.join(again, same).select("doc_id", "text_hash", words(F.col("text")).alias("words"), F.inline_outer("places"))
        found = found.select(
            "doc_id", "text_hash", "first", "until", "n", _window_texts(F.col("first"), F.col("until"), F.col("n")).alias("texts")
        )
        read = kept.where("first < 0").withColumn("texts", F.lit(None).cast("array<string>")).unionByName(found)
    tried = read.where("first >= 0").select("doc_id", "text_hash", "n", F.posexplode("texts").alias("_at", "window"), "first")
    placed = tried.select("doc_id", "text_hash", (F.col("first") + F.col("_at")).alias("start"), "n", "window")
    hits = cut(placed.join(windows.select("window", "n", "items"), ["window", "n"]).select("doc_id", "text_hash", "start", "n", "items"))
    covered = hits.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"))
    covered = covered.select("doc_id", "text_hash", _union_length(F.col("spans")).alias("n_hit"))
    named = hits.select("doc_id", "text_hash", F.explode("items").alias("item")).distinct()
    named = named.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.col("item").cast("string"))).alias("items"))
    found = covered.join(named.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash"),
                         covered["doc_id"].eqNullSafe(F.col("_id")) & (covered["text_hash"] == F.col("_hash")))
    found = found.select(F.col("_id").alias("found_id"), F.col("_hash").alias("found_hash"), "n_hit", "items")
    docs = read.where("first < 0").select("doc_id", "text_hash", F.col("until").cast("long").alias("n_words"))
    same = docs["doc_id"].eqNullSafe(found["found_id"]) & (docs["text_hash"] == found["found_hash"])
    return docs.join(found, same, "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )


def _union_length(spans: Column) -> Column:
    """Length of the union of sorted (start, n)."""

    def add(state: Column, x: Column) -> Column:
        end = x["start"] + x["n"]
        new = F.greatest(end - F.greatest(x["start"], state["until"]), F.lit(0))
        return F.struct((state["total"] + new).alias("total"), F.greatest(state["until"], end).alias("until"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("total"), F.lit(0).alias("until")), add, lambda s: s["total"])


def digest(results: DataFrame) -> DataFrame:
    return results.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_clean(documents: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """Rows of `documents` without a window of an item, with all their columns."""
    found = decontaminate(documents, items, **settings).where("n_hit > 0")
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = documents["doc_id"].eqNullSafe(found["_id"]) & (F.xxhash64(documents["text"]) == found["_hash"])
    return documents.join(found, same, "left_anti")

"""Quality rules by cross-document line frequency.

Lines are normalised (lower case, digits as 0, white space runs as one space, trimmed) and
hashed. For each host and line the distinct documents with it are counted over the whole
corpus. With `copies`, each document counts; without, documents of a host with the same text count
once. A line above the limit of its host is removed: the larger of `LEAST`
documents and `SHARE` of the host's distinct documents. A document that loses more than
`DEPLETED` of its words, or keeps too few, is rejected.

The limits are shares of corpus counts, so they act alike at every size. Each document sends one
row for each different line; counting distinct documents is two combinable aggregations, so a
line that a third of all documents have is spread by document first and summed before the
second shuffle. Only lines above a limit go back to the documents.

Defined results: a null text has no words and fails the base rules; a null host is a host of its
own; repeated rows (id and text) are one document and are judged each; an empty table gives no rows; other
columns are ignored."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut, slices

LEAST = 20
SHARE = 0.01
DEPLETED = 0.5
MIN_WORDS = 50
MOST_REPEATED = 0.5
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"

PROFILE = (
    "doc_id bigint, host string, text_hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, lines array<struct<line:bigint,words:int>>"
)


def repeat_words(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of `size` words that are found twice or more."""
    if len(words) <= size:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    many = len(words) - size + 1
    key = ids[:many]
    for shift in range(1, size):
        # pairs of (window so far, next word) numbered anew, so keys never overflow
        _, key = np.unique(key * len(number) + ids[shift : shift + many], return_inverse=True)
    twice = np.bincount(key)[key] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + size, -1)
    return int((np.cumsum(covered) > 0).sum())


_DIGIT = re.compile(r"\d")
_SPACES = re.compile(f"[{SPACE}]+")


def normalised(line: str) -> str:
    return _SPACES.sub(" ", _DIGIT.sub("0", line.lower())).strip(" ")


def profile(text: str) -> tuple[int, int, int, int, int, list[tuple[int, int]]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and (hash, words in all its copies) of each line."""
    words = text.encode().split()
    seen: set[str] = set()
    duplicates = 0
    lines: dict[int, int] = {}
    for line in text.split("\n"):
        n = len(line.encode().split())
        if not n:
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        key = xxhash.xxh64_intdigest(normalised(line).encode())
        lines[key] = lines.get(key, 0) + n
    signed = [(k - (1 << 64) if k >> 63 else k, n) for k, n in lines.items()]
    chars = len(text) - sum(text.count(c) for c in SPACE)
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), duplicates, repeat_words(words), signed


def _profile_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    line = pa.struct([("line", pa.int64()), ("words", pa.int32())])
    for batch in slices(batches, "text", 8 << 20):
        found = [profile(t or "") for t in batch.column("text").to_pylist()]
        columns = list(zip(*found))
        numbers = [pa.array(c, pa.int64()) for c in columns[:5]]
        lines = pa.array([[{"line": k, "words": n} for k, n in x] for x in columns[5]], pa.list_(line))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("doc_id", "host", "text_hash")], *numbers, lines],
            ["doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"],
        )


def profiles(documents: DataFrame) -> DataFrame:
    """Base measures and lines of rows (doc_id, text, host)."""
    rows = documents.select("doc_id", "host", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(_profile_batches, PROFILE)


def frequent_lines(profiled: DataFrame, *, least: int = LEAST, share: float = SHARE, copies: bool = False) -> DataFrame:
    """(host, line) found in more distinct documents of the host than its limit; with `copies`, equal texts under other ids count."""
    document = ["host", "text_hash", *(["doc_id"] if copies else [])]
    hosts = profiled.select(*document).distinct().groupBy("host").agg(F.count("*").alias("n"))
    limits = hosts.select(F.col("host").alias("_host"), F.greatest(F.lit(float(least)), F.col("n") * share).alias("most"))
    lines = profiled.select(*document, F.explode("lines.line").alias("line")).distinct()
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > least)
    return counts.join(limits, counts["host"].eqNullSafe(limits["_host"])).where("n > most").select("host", "line")


def judge(
    documents: DataFrame,
    *,
    least: int = LEAST,
    share: float = SHARE,
    depleted: float = DEPLETED,
    min_words: int = MIN_WORDS,
    copies: bool = False,
) -> DataFrame:
    """Per row of `documents` (doc_id, text, host): the base measures, n_removed_words, base_failed and kept."""
    profiled = cut(profiles(documents).withColumn("row", F.monotonically_increasing_id()))
    frequent = cut(frequent_lines(profiled, least=least, share=share, copies=copies))
    held = profiled.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.words")
    same = held["host"].eqNullSafe(frequent["host"]) & (held["line"] == frequent["line"])
    lost = held.join(frequent, same).groupBy("row").agg(F.sum("words").alias("lost"))
    judged = profiled.drop("lines").join(lost, "row", "left").withColumn("n_removed_words", F.coalesce("lost", F.lit(0)).cast("long"))
    base_failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    good = (F.col("n_removed_words") <= depleted * F.col("n_words")) & (left >= min_words * depleted)
    return judged.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & good).drop("row", "lost", "text_hash")

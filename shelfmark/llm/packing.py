"""Best-fit packing with exact complements.

Documents become token ids (byte-level BPE of a vocabulary file, an end id after each) and are
cut in pieces of the sequence length, the shorter piece first. Sequences are planned on the
histogram of piece lengths alone, which has at most `capacity` entries at any number of
documents: from the longest length down, the gap a piece leaves is filled exactly by a single
length, a pair or a triple (looked up by their sum, under the counts still available) and all
sequences of that kind are planned at once; lengths that have no exact complement are placed by
best fit. Each step uses up a length or a class of open sequences, so the plan has a few
thousand entries at most, and it is small enough to send to every task.

A piece finds its place from its rank among the pieces of its length. Ranks are numbered inside
each stored partition and shifted by the counts of earlier partitions, so a very common length
is not gathered anywhere.

Defined results: a null or empty text is one piece with the end id; rows that repeat an id are
documents of their own; null ids are kept; an empty table gives no rows; other columns are
ignored. Strings of added tokens in a text become their ids, as the vocabulary file says."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut, slices

CAPACITY = 2048
END_ID = 0
# Fixed value: the pre-tokenizer's pattern of byte-level BPE vocabularies of this family.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# --- tokens -------------------------------------------------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary: itself where it is
    printable Latin-1, else the next free one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(content: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(ranks, added tokens) of a tokenizer file; ids have to follow the order of the merges."""
    spec = json.loads(content)
    model, before = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
        raise ValueError("a byte-level BPE vocabulary without normalizer or prefix space is needed")
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    order = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(order, order[1:])):
        raise ValueError("ids do not follow the order of the merges")
    return ranks, added


class Encoder:
    """Built once in each task; the content of the vocabulary file comes with the job.

    Ids are those of `tokenizers`. `tiktoken` makes the same ones faster; it gives up on very long runs
    of white space, where its pattern needs too deep a stack, and such a text goes to `tokenizers`."""

    def __init__(self, content: str) -> None:
        import tiktoken

        ranks, added = read_vocabulary(content)
        self._encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self._content, self._tokenizer = content, None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self._encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            return self.plain_ids(text)

    def plain_ids(self, text: str) -> np.ndarray:
        from tokenizers import Tokenizer

        self._tokenizer = self._tokenizer or Tokenizer.from_str(self._content)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def _piece_batches(batches: Iterable[pa.RecordBatch], content: str, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder = None
    for batch in slices(batches, "text", 8 << 20):
        encoder = encoder or Encoder(content)
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = np.append(encoder.ids(text or ""), END_ID).astype("<u4")
            start, end, piece = 0, (len(ids) - 1) % capacity + 1, 0
            while start < len(ids):
                rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                start, end, piece = end, end + capacity, piece + 1
        columns = list(zip(*rows))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of rows (doc_id, text); `vocabulary` is a path on the driver."""
    with open(vocabulary, encoding="utf-8") as file:
        content = documents.sparkSession.sparkContext.broadcast(file.read())
    return documents.select("doc_id", "text").mapInArrow(lambda b: _piece_batches(b, content.value, capacity), PIECES)


# --- the plan -----------------------------------------------------------------------------


def _complement(counts: np.ndarray, gap: int, most: int) -> tuple[int, ...] | None:
    """One to three available lengths, none above `most`, that sum to `gap`: of pairs the one that is
    available most often, of triples the one with the largest parts."""
    if gap <= most and counts[gap] > 0:
        return (gap,)
    free = counts[: gap + 1] > 0
    free[min(most, gap) + 1 :] = False
    parts = np.flatnonzero(free)
    if not len(parts):
        return None
    pair = free[parts] & free[gap - parts] & ((2 * parts != gap) | (counts[parts] > 1))
    if pair.any():
        large = parts[pair][2 * parts[pair] >= gap]
        a = int(large[np.argmax(np.minimum(counts[large], counts[gap - large]))])
        return (a, gap - a)
    for a in parts[::-1].tolist():
        rest = gap - a
        if rest > 2 * a:
            break  # a would not be the largest of the three
        if rest < 2:
            continue
        b = parts[(parts <= a) & (parts < rest)]
        c = rest - b
        need = 1 + (b == a) + (c == a)
        good = free[c] & (c <= b) & (counts[a] >= need) & ((b != c) | (counts[b] > 1))
        if good.any():
            chosen = int(b[good][-1])
            return (a, chosen, rest - chosen)
    return None


Plan = list[tuple[tuple[tuple[int, int], ...], int]]
"""Kinds of sequences as (((length, copies), ...), number of sequences)."""


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The shorter of two plans: exact complements with best fit of the rest, and, where few lengths
    occur and complements waste what others need, best fit alone."""
    plans = [_plan(histogram, capacity, exact) for exact in (True, False)]
    return min(plans, key=lambda p: sum(times for _, times in p))


def _plan(histogram: dict[int, int], capacity: int, exact: bool) -> Plan:
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    planned: Plan = []
    left = np.zeros_like(counts)

    def kind(lengths: tuple[int, ...]) -> tuple[tuple[int, int], ...]:
        return tuple((x, lengths.count(x)) for x in dict.fromkeys(lengths))

    for length in range(capacity, 0, -1):
        while counts[length]:
            gap = capacity - length
            counts[length] -= 1  # the piece itself
            rest = () if not gap else _complement(counts, gap, length) if exact else None
            counts[length] += 1
            if rest is None:
                left[length], counts[length] = counts[length], 0
                break
            found = kind((length, *rest))
            times = min(int(counts[x]) // k for x, k in found)
            planned.append((found, times))
            for x, k in found:
                counts[x] -= times * k
    # best fit of what is left: open sequences by gap
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fitting = [g for g, kinds in gaps.items() if g >= length and kinds]
            if fitting:
                gap = min(fitting)
                lengths, bins = gaps[gap].pop()
                used = min(n, bins)
                if bins > used:
                    gaps[gap].append((lengths, bins - used))
                gaps.setdefault(gap - length, []).append(((*lengths, length), used))
                n -= used
            else:
                each = min(capacity // length, n)
                used = n // each
                gaps.setdefault(capacity - each * length, []).append(((length,) * each, used))
                n -= used * each
    return planned + [(kind(lengths), bins) for kinds in gaps.values() for lengths, bins in kinds]


def places(planned: Plan) -> dict[str, np.ndarray]:
    """The plan by length and rank: pieces of `length` with ranks from `rank` on stand `copies` to a
    sequence, from `sequence` and `offset` on. Sorted by length and rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for found, times in planned:
        offset = 0
        for length, copies in found:
            rows.append((length, taken.get(length, 0), copies, sequence, offset))
            taken[length] = taken.get(length, 0) + times * copies
            offset += length * copies
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "copies", "sequence", "offset"), columns))


def _placed(batches: Iterable[pa.RecordBatch], at: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    shift = 1 << 48
    keys = at["length"] * shift + at["rank"]
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        row = np.searchsorted(keys, length * shift + rank, side="right") - 1
        nth = rank - at["rank"][row]
        sequence = at["sequence"][row] + nth // at["copies"][row]
        offset = at["offset"][row] + nth % at["copies"][row] * length
        kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)


def ranked(stored: DataFrame) -> DataFrame:
    """`stored` (a checkpoint, whose partitions are fixed) with `rank` from 0 among equal lengths."""
    rows = stored.withColumn("_part", F.spark_partition_id())
    sizes = rows.groupBy("length", "_part").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("length", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("length", "_part").orderBy("doc_id", "piece")
    numbered = rows.withColumn("_nth", F.row_number().over(inside))
    return numbered.join(shifts, ["length", "_part"]).withColumn("rank", (F.col("_nth") - 1 + F.col("_shift")).cast("long"))


def pack(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece of `documents` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    stored = cut(pieces(documents, vocabulary, capacity))
    # at most `capacity` lengths
    histogram = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    at = documents.sparkSession.sparkContext.broadcast(places(plan(histogram, capacity)))
    columns = ranked(stored).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return columns.mapInArrow(lambda b: _placed(b, at.value), f"{PIECES}, sequence_id bigint, offset bigint")

"""Ranked lexical search by pipelined term partitioning.

Terms are partitioned among owners, and owners are visited one after the other, from the owner of the
rarest terms to the owner of the most frequent ones. An item travels as a bundle: the sparse scores
(accumulators) that its terms have given to documents so far. At each stage a cogroup brings the
bundles to the owner's postings; the owner adds its integer contributions and passes the bundles
on. After the last stage the best documents of each bundle are selected.

* Documents are dealt in shards of at most `SHARD` rows by the task that reads them; a shard's
  postings (term, place in the shard, occurrences, length of the document) are built there, for
  the items' terms only, and stored once. No posting list is ever gathered whole: a bundle and a
  posting list belong to one shard each, however many documents hold a term.
* Items are taken in blocks of `BLOCK`, whose vocabulary is small enough to be sent to the tasks; a
  block reads the documents once. Inside a block, bundles of `GROUP` items of a shard meet in one
  cogroup, so that a task holds at most SHARD x GROUP scores.
* Owners are bands of document frequency. What travels between stages are the scores of the
  rarer terms; the postings of the most frequent terms, most of all, are met last and give scores
  that never travel.
* Each shard sends its best `top` documents of an item to the final ranking, which is exact.

Weights and contributions are integers as given in `weights` and `contributions`.

Defined results: a null text has no term, neither has an item without one, which gets no row; rows
that repeat an id, of a document or an item, are documents or items of their own (each such item
ranks from 1); null ids are kept, a null doc_id orders last; documents whose score is 0 are left
out; an empty table of either kind gives no rows; other columns are ignored."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut, slices

TOP = 20
SHARD = 4096
GROUP = 256
BLOCK = 4096
OWNERS = 4
# a text is cut at a separator after so many bytes, so that its terms are counted in bounded memory
PART = 4 << 20

# digits and letters and every byte of a longer character stand for themselves, A-Z for a-z
_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def term_counts(text: str | None) -> Counter[bytes]:
    """Occurrences of each term of a text."""
    counts: Counter[bytes] = Counter()
    plain = (text or "").encode().translate(_KEPT)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + PART)
        end = len(plain) if end < 0 else end
        counts.update(plain[start:end].split())
        start = end
    return counts


# --- postings -----------------------------------------------------------------------------

POSTINGS = "shard string, term int, n_docs bigint, n_terms bigint, ids array<bigint>, places binary, tf binary, n binary"


def _shard_batches(batches: Iterable[pa.RecordBatch], vocabulary: dict[bytes, int], size: int) -> Iterator[pa.RecordBatch]:
    """Per shard one row of term -1 with its documents' ids and counts, and one row for each term."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    ids: list = []
    lengths: list[int] = []
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def shard() -> pa.RecordBatch:
        n = np.array(lengths, np.int64)
        places = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
        terms = np.concatenate([t for t, _ in found])
        tfs = np.concatenate([c for _, c in found])
        order = np.argsort(terms, kind="stable")
        terms, places, tfs = terms[order], places[order], tfs[order]
        names, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        parts = [(places[a:b], tfs[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        none = [None] * len(names)
        columns = [
            pa.array([f"{part}-{number}"] * (len(names) + 1)),
            pa.array([-1, *names.tolist()], pa.int32()),
            pa.array([int((n > 0).sum()), *[b - a for a, b in zip(starts.tolist(), ends.tolist())]], pa.int64()),
            pa.array([int(n.sum()), *[0] * len(names)], pa.int64()),
            pa.array([ids, *none], pa.list_(pa.int64())),
            pa.array([None, *[p.astype("<u2").tobytes() for p, _ in parts]], pa.binary()),
            pa.array([None, *[c.astype("<u4").tobytes() for _, c in parts]], pa.binary()),
            pa.array([None, *[n[p].astype("<u4").tobytes() for p, _ in parts]], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "term", "n_docs", "n_terms", "ids", "places", "tf", "n"])

    for batch in slices(batches, "text", 8 << 20):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            counts = term_counts(text)
            known = [(vocabulary[t], c) for t, c in counts.items() if t in vocabulary]
            pairs = np.array(known, np.int64).reshape(-1, 2)
            ids.append(doc_id)
            lengths.append(sum(counts.values()))
            found.append((pairs[:, 0], pairs[:, 1]))
            if len(ids) == size:
                yield shard()
                number += 1
                ids, lengths, found = [], [], []
    if ids:
        yield shard()


def postings(documents: DataFrame, vocabulary: dict[bytes, int], shard: int = SHARD) -> DataFrame:
    """Stored postings of `documents` (doc_id, text) for the terms of a vocabulary of bounded size."""
    if not 0 < shard <= 1 << 16:
        raise ValueError("places in a shard are two bytes wide")
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)
    return cut(documents.select("doc_id", "text").mapInArrow(lambda b: _shard_batches(b, sent.value, shard), POSTINGS))


# --- integer scores -----------------------------------------------------------------------


def weights(document_frequency: dict[int, int], n_documents: int) -> dict[int, int]:
    return {t: math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1))) for t, df in document_frequency.items()}


def contributions(tf: np.ndarray, n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What a term of weight 1 gives to documents of n terms that hold it tf times."""
    tf, n = tf.astype(np.int64), n.astype(np.int64)
    if n.size and 25 * int(n.max()) * n_documents >= 1 << 63:
        raise OverflowError("document length times number of documents exceeds 64 bits")
    m = 100 - 25 + (25 * n * n_documents) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


# --- the pipeline -------------------------------------------------------------------------

BUNDLES = "shard string, batch int, item int, places binary, scores binary"


def owner_bands(document_frequency: dict[int, int], owners: int) -> dict[int, int]:
    """Owner of each term. Terms are ordered by document frequency; the last owner has the most frequent
    terms, with half of all postings, the one before half of the rest, and so on: scores travel
    after each stage but the last, so early stages are the sparse ones."""
    bands, left = {}, sum(document_frequency.values())
    owner, share = owners - 1, left / 2
    for term in sorted(document_frequency, key=lambda t: (-document_frequency[t], t)):
        bands[term] = owner
        left -= document_frequency[term]
        if owner and left <= share:
            owner, share = owner - 1, left / 2
    return bands


def _scores(items: int, size: int, bundles: pa.Table, lists: pa.Table, plan: dict) -> np.ndarray:
    """Scores of one batch of items in one shard, with an owner's contributions added."""
    total = np.zeros((items, size), np.int64)
    for item, places, scores in zip(*(bundles.column(c).to_pylist() for c in ("item", "places", "scores"))):
        total[item % plan["group"], np.frombuffer(places, "<u2")] = np.frombuffer(scores, "<i8")
    for term, places, tf, n in zip(*(lists.column(c).to_pylist() for c in ("term", "places", "tf", "n"))):
        if term < 0:
            continue
        at = np.frombuffer(places, "<u2")
        given = contributions(np.frombuffer(tf, "<u4"), np.frombuffer(n, "<u4"), plan["N"], plan["L"]) * plan["weight"][term]
        for item, times in plan["wanted"][term].get(lists.column("batch")[0].as_py(), ()):
            total[item % plan["group"], at] += given * times
    return total


def _stage(key: tuple, bundles: pa.Table, lists: pa.Table, plan: dict, shard: int) -> pa.Table:
    """The bundles of (shard, batch) after one owner."""
    if not lists.num_rows:
        return bundles
    name, batch = key[0].as_py(), key[1].as_py()
    total = _scores(plan["group"], shard, bundles, lists, plan)
    rows = []
    for i in np.flatnonzero(total.any(axis=1)).tolist():
        at = np.flatnonzero(total[i])
        rows.append((name, batch, batch * plan["group"] + i, at.astype("<u2").tobytes(), total[i, at].astype("<i8").tobytes()))
    columns = list(zip(*rows)) or [()] * 5
    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["shard", "batch", "item", "places", "scores"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _last_stage(bundles: pa.Table, lists: pa.Table, plan: dict, shard: int, top: int) -> pa.Table:
    """The best documents of (shard, batch) for each item, after the last owner."""
    rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    given = pa.compute.filter(lists.column("ids"), pa.compute.is_valid(lists.column("ids")))
    ids = given[0].as_py()
    # equal scores go by id; a missing id comes last
    numbers = np.array([np.iinfo(np.int64).max if x is None else x for x in ids], np.int64)
    missing = np.array([x is None for x in ids])
    total = _scores(plan["group"], shard, bundles, lists, plan)[:, : len(ids)]
    batch = lists.column("batch")[0].as_py()
    for i in np.flatnonzero((total > 0).any(axis=1)).tolist():
        at = np.flatnonzero(total[i] > 0)
        if len(at) > top:
            least = np.partition(total[i, at], len(at) - top)[len(at) - top]
            at = at[total[i, at] >= least]
        at = at[np.lexsort((missing[at], numbers[at], -total[i, at]))][:top]
        rows.append((np.full(len(at), batch * plan["group"] + i), at, total[i, at]))
    item, at, score = (np.concatenate([r[j] for r in rows]) if rows else np.empty(0, np.int64) for j in range(3))
    found = pa.array(numbers[at], pa.int64(), mask=missing[at]) if len(ids) else pa.array([], pa.int64())
    return pa.table([pa.array(item, pa.int32()), found, pa.array(score, pa.int64())], names=["item", "doc_id", "score"])


def _rank_block(documents: DataFrame, texts: list[str | None], top: int, shard: int, group: int, owners: int) -> DataFrame:
    """(item, rank, doc_id, score) of a block of items, known by their position."""
    spark = documents.sparkSession
    asked = [term_counts(t) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
    stored = postings(documents, vocabulary, shard)
    whole = stored.where("term < 0").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_documents, n_terms = whole[0] or 0, whole[1] or 0
    # one row for each term of the block
    df = {r["term"]: r["df"] for r in stored.where("term >= 0").groupBy("term").agg(F.sum("n_docs").alias("df")).collect()}
    bands, weight = owner_bands(df, owners), weights(df, n_documents)
    wanted: dict[int, dict[int, list[tuple[int, int]]]] = {t: {} for t in df}
    for item, counts in enumerate(asked):
        for term, times in counts.items():
            if vocabulary[term] in df:
                wanted[vocabulary[term]].setdefault(item // group, []).append((item, times))
    plan = {"N": n_documents, "L": n_terms, "group": group, "weight": weight, "wanted": wanted}
    sent = spark.sparkContext.broadcast(plan)
    batches = sorted({b for by_batch in wanted.values() for b in by_batch})
    rows = [(t, bands[t], sorted(by_batch)) for t, by_batch in wanted.items()] + [(-1, owners - 1, batches)]
    # one row for each term of the block; the join copies a posting list to the batches that ask for it
    owned = spark.createDataFrame(rows, "term int, owner int, batches array<int>")
    lists = stored.drop("n_docs", "n_terms").join(F.broadcast(owned), "term").withColumn("batch", F.explode("batches"))
    bundles = spark.createDataFrame([], BUNDLES)
    for owner in range(owners):
        own = lists.where(F.col("owner") == owner).select("shard", "batch", "term", "ids", "places", "tf", "n")
        met = bundles.groupBy("shard", "batch").cogroup(own.groupBy("shard", "batch"))
        if owner < owners - 1:
            bundles = met.applyInArrow(lambda key, a, b: _stage(key, a, b, sent.value, shard), BUNDLES)
    # the documents' row of each shard goes to the last owner for every batch, so no bundle lacks it
    best = met.applyInArrow(lambda a, b: _last_stage(a, b, sent.value, shard, top), "item int, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


def rank(
    documents: DataFrame, items: DataFrame, *, top: int = TOP, shard: int = SHARD, group: int = GROUP, block: int = BLOCK, owners: int = OWNERS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best rows of `documents` (doc_id, text) for each row of
    `items` (item_id, text)."""
    spark = documents.sparkSession
    numbered = cut(items.select("item_id", "text").withColumn("_at", F.monotonically_increasing_id()))
    kind = dict(numbered.dtypes)["item_id"]
    results = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    pending: list = []

    def done(rows: list) -> DataFrame:
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {kind}")
        found = _rank_block(documents, [r["text"] for r in rows], top, shard, group, owners)
        return cut(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))

    # blocks are read one at a time, in a fixed order
    for row in numbered.orderBy("_at").toLocalIterator():
        pending.append(row)
        if len(pending) == block:
            results = results.unionByName(done(pending))
            pending = []
    return results.unionByName(done(pending)) if pending else results

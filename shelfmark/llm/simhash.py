"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: texts are lower-cased (A-Z), cut in words at ASCII white space and hashed by
XXH64 (seed 42) in shingles of consecutive words; a bit is set where it is set in more than half
the hashes. A text without words has fingerprint zero.

Links, between fingerprints that differ in at most `distance` bits:

1. Copies are one fingerprint from here on (grouped with map-side minima).
2. Bits are grouped in `parts` partitions so that correlated bits stand together; the correlation
   is a 64 x 64 matrix summed over all fingerprints.
3. Each part i gets a threshold t_i >= -1 with sum t_i = distance - parts + 1: two fingerprints
   within the distance differ by at most t_i bits in some part i. A dynamic program chooses the
   thresholds with the least estimated work: probes (points of a ball) plus candidates (bits of
   a part taken as independent, with their frequencies in the corpus, and the counted number of
   fingerprints with the same part).
4. Probe: the *distinct values* of a part are joined through the points of balls around them,
   half the threshold from each side, so that two values within the threshold meet. A point is
   shared by at most as many values as its ball has points, at any size and skew of the data.
5. Verify: values that met bring their fingerprints, in chunks of bounded size; a value with many
   fingerprints is split in several chunks and pairs of chunks are compared in tasks of their
   own. Of the pairs within the distance, a task returns a spanning forest only: the links that
   join two groups not joined before. No pair list is built and no link between groups is lost.
6. Components of these links, their smallest doc_id joined back to every document.

Defined results: a null text has no words; a null id is kept and counts as the largest; repeated
rows are rows of the result each; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.components import components
from shelfmark.llm.frames import cut, slices

BITS = 64
CHUNK = 2048
#: relative cost of one probe row and one candidate pair
PROBE_COST, PAIR_COST = 1.0, 1.0


# --- fingerprints -------------------------------------------------------------------------

# for a byte b, SPREAD[b] has the bits of b in eight lanes of eight bits
SPREAD = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.uint64) << (8 * np.arange(8, dtype=np.uint64))).sum(
    axis=1, dtype=np.uint64
)
LANE = 255  # additions before a lane could overflow


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """Hashes of all shingles of a text; the whole sequence where it has fewer words."""
    found = text.encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    many = max(len(found) - size + 1, 1)
    last = ends[min(size, len(found)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts[:many].tolist(), last.tolist())), np.uint64, many
    )


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes; `counts` are the group sizes, zero allowed."""
    result = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return result
    sizes = counts[full]
    first = np.cumsum(sizes) - sizes
    # blocks of at most LANE hashes, so that eight counters fit one word
    blocks = -(-sizes // LANE)
    owner = np.repeat(np.arange(len(full)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    block_start = first[owner] + nth * LANE
    group_start = np.cumsum(blocks) - blocks
    by_byte = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(SPREAD[by_byte[:, byte]], block_start)
        for bit in range(8):
            ones = np.add.reduceat((lanes >> np.uint64(8 * bit)) & np.uint64(255), group_start)
            result[full] |= (2 * ones.astype(np.int64) > sizes).astype(np.uint64) << np.uint64(8 * byte + bit)
    return result


def _fingerprint_batches(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 4 << 20):
        hashes = [shingle_hashes(t or "", size) for t in batch.column("text").to_pylist()]
        counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
        prints = majority(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), counts)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"])


def fingerprints(documents: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, print) of rows (doc_id, text)."""
    return documents.select("doc_id", "text").mapInArrow(lambda b: _fingerprint_batches(b, shingle), "doc_id bigint, print bigint")


# --- partitions and thresholds ------------------------------------------------------------


def _bit_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros((BITS, BITS)), 0
    for batch in batches:
        prints = batch.column("print").to_numpy().astype(np.int64)
        bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        total += bits.T @ bits
        n += len(bits)
    yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()]), pa.array([n])], ["together", "n"])


def bit_statistics(prints: DataFrame) -> tuple[np.ndarray, int]:
    """How often two bits are set together, over all distinct fingerprints, and their number."""
    rows = prints.select("print").mapInArrow(_bit_counts, "together array<double>, n bigint")
    summed = rows.select("n", F.posexplode("together").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    found = summed.collect()  # 64 x 64 numbers at any size
    together = np.zeros(BITS * BITS)
    for r in found:
        together[r["at"]] = r["value"]
    return together.reshape(BITS, BITS), (found[0]["n"] if found else 0)


def partition_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of equal size; each group takes the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    covariance = together / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    related = np.abs(covariance / spread)
    np.fill_diagonal(related, 0)
    free, groups = set(range(BITS)), []
    for g in range(parts):
        size = BITS // parts + (g < BITS % parts)
        seed = max(free, key=lambda b: (related[b, sorted(free)].sum(), -b))
        group = [seed]
        free.remove(seed)
        while len(group) < size:
            best = max(free, key=lambda b: (related[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1))


def estimated_work(p: np.ndarray, group: list[int], n: int, same_pairs: float, most: int) -> list[float]:
    """Estimated work of a part for thresholds -1..most."""
    differ = np.array([1.0])
    for b in group:
        q = 2 * p[b] * (1 - p[b])
        differ = np.convolve(differ, [1 - q, q])
    pairs = n * (n - 1) / 2
    work = [0.0]
    for t in range(most + 1):
        candidates = max(differ[: t + 1].sum() * pairs, same_pairs)
        work.append(PROBE_COST * n * (_ball(len(group), (t + 1) // 2) + _ball(len(group), t // 2)) / 2 + PAIR_COST * candidates)
    return work


def allocate(works: list[list[float]], total: int) -> list[int]:
    """Thresholds (from -1) that sum to `total` with the least summed work, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for work in works:
        grown: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, len(work) - 1):
                key, value = spent + t, (cost + work[t + 1], [*chosen, t])
                if key not in grown or value < grown[key]:
                    grown[key] = value
        best = grown
    return best[total][1]


# --- probe and verify ---------------------------------------------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _flips(group: list[int], radius: int) -> Column:
    """One row for each way to change at most `radius` bits of a group."""
    flips = [0]
    for r in range(1, radius + 1):
        flips += [_signed(sum(1 << b for b in c)) for c in itertools.combinations(group, r)]
    return F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip")


def value_pairs(values: DataFrame, group: list[int], threshold: int) -> DataFrame:
    """(u, v) with u < v: distinct values (of `value`) of a part that differ by 1..threshold bits."""
    point = F.col("value").bitwiseXOR(F.col("flip")).alias("point")
    near = values.select("value", _flips(group, (threshold + 1) // 2)).select(F.col("value").alias("u"), point)
    far = values.select("value", _flips(group, threshold // 2)).select(F.col("value").alias("v"), point)
    met = near.join(far, "point").where("u <> v")
    return met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _forest(left: np.ndarray, right: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two arrays of fingerprints, or within one."""
    nodes = left if right is None else np.concatenate((left, right))
    label = np.arange(len(nodes))
    chosen = []
    others, shift = (left, 0) if right is None else (right, len(left))
    for start in range(0, len(left), 64):
        block = left[start : start + 64]
        near = np.bitwise_count(block[:, None] ^ others[None, :]) <= distance
        if right is None:
            near[np.arange(len(block)), start + np.arange(len(block))] = False
        rows, columns = np.nonzero(near)
        if not len(rows):
            continue
        for i, js in zip(*_by_row(rows, columns)):
            a = start + i
            joined, where = np.unique(label[js + shift], return_index=True)
            new = joined != label[a]
            if new.any():
                chosen += [(int(nodes[a]), int(nodes[js[w] + shift])) for w in where[new]]
                group = np.append(joined, label[a])
                label[np.isin(label, group)] = group.min()
    return chosen


def _by_row(rows: np.ndarray, columns: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    names, starts = np.unique(rows, return_index=True)
    return names.tolist(), np.split(columns, starts[1:])


def _verify(batches: Iterable[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (task, side, print) sorted by task: links within each task."""

    def links(task: np.ndarray, side: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], task[1:] != task[:-1])))
        stops = np.append(starts[1:], len(task))
        # most tasks compare one fingerprint with one
        two = starts[(stops - starts) == 2]
        close = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance]
        chosen = list(zip(prints[close].tolist(), prints[close + 1].tolist()))
        for a, b in zip(starts.tolist(), stops.tolist()):
            if b - a > 2:
                left, right = prints[a:b][side[a:b] == 0], prints[a:b][side[a:b] == 1]
                chosen += _forest(left, right if len(right) else None, distance)
        ends = np.array(chosen, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"])

    held = None
    for batch in batches:
        new = [batch.column(c).to_numpy() for c in ("task", "side", "print")]
        new[2] = new[2].view(np.uint64)
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if len(held[0]) and held[0][0] != held[0][-1]:
            at = np.searchsorted(held[0], held[0][-1])
            yield links(*[x[:at] for x in held])
            held = [x[at:] for x in held]
    if held is not None and len(held[0]):
        yield links(*held)


def part_links(prints: DataFrame, group: list[int], threshold: int, distance: int, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) among distinct `prints` (print) that differ by at most `threshold` bits of a part."""
    mask = _signed(sum(1 << b for b in group))
    valued = prints.select("print", F.col("print").bitwiseAND(mask).alias("value"))
    values = cut(valued.groupBy("value").agg(F.count("*").alias("size")).withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int")))
    inside = values.where("size > 1").select(
        F.col("value").alias("u"), F.col("value").alias("v"), F.col("chunks").alias("cu"), F.col("chunks").alias("cv")
    )
    tasks = inside
    if threshold > 0:
        across = value_pairs(values, group, threshold)
        u = values.select(F.col("value").alias("u"), F.col("chunks").alias("cu"))
        v = values.select(F.col("value").alias("v"), F.col("chunks").alias("cv"))
        tasks = tasks.unionByName(across.join(u, "u").join(v, "v").select("u", "v", "cu", "cv"))
    # chunk i of u against chunk j of v; within one value, j >= i
    i = F.explode(F.sequence(F.lit(0), F.col("cu") - 1)).alias("i")
    j = F.explode(F.sequence(F.when(F.col("u") == F.col("v"), F.col("i")).otherwise(F.lit(0)), F.col("cv") - 1)).alias("j")
    tasks = cut(tasks.select("u", "v", "cv", i).select("u", "v", "i", j))
    one = (F.col("u") == F.col("v")) & (F.col("i") == F.col("j"))
    # the last bit keeps comparisons within a chunk apart from those of two chunks
    task = F.shiftleft(F.xxhash64("u", "v", "i", "j"), 1).bitwiseOR(one.cast("bigint")).alias("task")
    sides = tasks.select(task, F.lit(0).alias("side"), F.col("u").alias("value"), F.col("i").alias("chunk")).unionByName(
        tasks.where(~one).select(task, F.lit(1).alias("side"), F.col("v").alias("value"), F.col("j").alias("chunk"))
    )
    spread = valued.join(values.select("value", "chunks"), "value").select(
        "print", "value", F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int").alias("chunk")
    )
    rows = sides.join(spread, ["value", "chunk"]).select("task", "side", "print")
    ordered = rows.repartition("task").sortWithinPartitions("task")
    return ordered.mapInArrow(lambda b: _verify(b, distance), "a bigint, b bigint")


def near_duplicates(documents: DataFrame, *, shingle: int = 4, distance: int = 4, parts: int = 2) -> DataFrame:
    """(doc_id, print, component_id) for each row of `documents` (doc_id, text)."""
    docs = cut(fingerprints(documents, shingle))
    prints = cut(docs.groupBy("print").agg(F.min("doc_id").alias("first")))
    together, n = bit_statistics(prints)
    groups = partition_bits(together, n, parts)
    p = np.diag(together) / max(n, 1)
    works = []
    for group in groups:
        mask = _signed(sum(1 << b for b in group))
        sizes = prints.groupBy(F.col("print").bitwiseAND(mask).alias("value")).count()
        same = sizes.agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).first()[0] or 0.0
        works.append(estimated_work(p, group, n, same, distance))
    links = None
    for group, threshold in zip(groups, allocate(works, distance - parts + 1)):
        if threshold >= 0:
            found = part_links(prints.select("print"), group, threshold, distance)
            links = found if links is None else links.unionByName(found)
    member = components(links).select(F.col("node").alias("print"), F.col("root"))
    named = cut(prints.join(member, "print", "left").withColumn("root", F.coalesce("root", "print")))
    # stored like the fingerprints, so that a giant component meets its row in a join that Spark can split
    lowest = cut(named.groupBy("root").agg(F.min("first").alias("component_id")))
    # stored, so that a fingerprint with very many copies meets it in a join that Spark can split
    by_print = cut(named.join(lowest, "root").select("print", "component_id"))
    return docs.join(by_print, "print").select("doc_id", "print", "component_id")


def representatives(documents: DataFrame, **settings) -> DataFrame:
    """Rows of `documents` that stay: one for each component, the one with the smallest id.

    Ids are taken as unique; rows that repeat the smallest id of a component all stay."""
    found = near_duplicates(documents, **settings)
    stay = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_stays")).distinct()
    return documents.join(stay, documents["doc_id"].eqNullSafe(stay["_stays"]), "left_semi")

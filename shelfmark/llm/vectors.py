"""Near-duplicate vectors: sign hashing in several tables, exact cosines, connected components.

1. Equal vectors of a label are one vector with a count from here on; counts are summed before the
   shuffle, so a vector with very many copies is a number.
2. A table gives every vector a code: the signs of its projections on `bits` random hyperplanes.
   Two vectors at the threshold agree in one sign with p = 1 - angle / pi and in a code with p^bits.
   `bits` grows with the logarithm of the largest label, so that a bucket (label, code) of one
   table holds about `bucket` vectors at any size; the number of tables follows from both, so that
   a pair at the threshold is missed by all tables with probability `miss` at most, and a closer
   pair far less often.
3. Vectors of a bucket meet in tasks. A bucket above `chunk` vectors is split in chunks by hash, and
   each pair of chunks is a task of its own, so a crowded bucket is compared by many tasks that
   hold two chunks at most. A task computes cosines in double precision by blocks of rows. No pair
   is returned: a task gives each vector its number of linked vectors, counting only pairs that
   met in no earlier table (their codes tell), and a spanning forest of its links.
4. Counts are summed per vector; components are built from the forests, and the smallest id of
   each is joined back. Equal vectors count as linked with one another.

Tables are worked off in rounds of a few; after each, only counts and forests are stored.

Defined results: only vectors with equal labels and equal lengths are compared; a vector that is null,
empty, zero or holds null or non-finite components, or has no label, has no link and is its own
component; rows that repeat an id are vectors of their own, each with its own row; a null id is
kept and counts as the largest (component_id is null where a component has no other); an empty
table gives no rows; other columns are ignored. Labels that are not whole numbers are compared by
64-bit hashes of their text."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.components import components
from shelfmark.llm.frames import cut

THRESHOLD = 0.93
MISS = 1e-4
BUCKET = 512
CHUNK = 1024
LEAST_BITS = 4
ROUND = 4
SEED = 20_11
# crowded buckets of 24 bytes; a few MB as a hash table in an executor
BROADCAST_ROWS = 100_000

# --- vectors ------------------------------------------------------------------------------

ROWS = "row bigint, vec_id bigint, label bigint, length int, vec binary"


def _usable_batches(batches: Iterable[pa.RecordBatch], wide: bool) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of their own precision; null where they link with nothing."""
    kind = np.dtype("<f8" if wide else "<f4")
    for batch in batches:
        lists = batch.column("embedding")
        offsets, valid = lists.offsets.to_numpy(), lists.is_valid().to_numpy(zero_copy_only=False)
        values = lists.values
        bad = ~values.is_valid().to_numpy(zero_copy_only=False)
        numbers = pa.compute.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(kind)
        bad |= ~np.isfinite(numbers)
        vectors: list[bytes | None] = []
        sizes = []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            fine = valid[i] and b > a and not bad[a:b].any() and numbers[a:b].any()
            # adding zero makes -0.0 and 0.0 the same bytes
            vectors.append((numbers[a:b] + kind.type(0)).tobytes() if fine else None)
            sizes.append(b - a)
        columns = [batch.column("vec_id"), batch.column("label"), pa.array(sizes, pa.int32()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "length", "vec"])


def usable(vectors: DataFrame) -> tuple[DataFrame, str]:
    """Stored rows (row, vec_id, label, length, vec) of `vectors` (vec_id, embedding, label), and the type
    of a component in `vec`."""
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    label = F.col("label")
    if vectors.schema["label"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        label = F.when(label.isNotNull(), F.xxhash64(label.cast("string")))
    plain = vectors.select("vec_id", label.cast("bigint").alias("label"), F.col("embedding"))
    wide = element != "float"
    if wide:
        plain = plain.withColumn("embedding", F.col("embedding").cast("array<double>"))
    rows = plain.mapInArrow(lambda b: _usable_batches(b, wide), "vec_id bigint, label bigint, length int, vec binary")
    rows = rows.withColumn("vec", F.when(F.col("label").isNotNull(), F.col("vec")))
    return cut(rows.withColumn("row", F.monotonically_increasing_id())), "<f8" if wide else "<f4"


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision; none is zero or non-finite."""
    rows = raw.astype(np.float64)
    # the largest entry first, so that no square over- or underflows
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


# --- codes --------------------------------------------------------------------------------


def agreement(threshold: float) -> float:
    """Probability that two vectors of this cosine lie on one side of a random hyperplane."""
    return 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi


def plan_tables(largest: int, threshold: float = THRESHOLD, miss: float = MISS, bucket: int = BUCKET) -> tuple[int, int]:
    """(bits, tables) for labels of at most `largest` vectors."""
    bits = min(max(LEAST_BITS, math.ceil(math.log2(max(largest, 1) / bucket))), 31)
    met = agreement(threshold) ** bits
    return bits, 1 if met >= 1 else max(1, math.ceil(math.log(miss) / math.log1p(-met)))


def _code_batches(batches: Iterable[pa.RecordBatch], kind: str, bits: int, tables: int, seed: int) -> Iterator[pa.RecordBatch]:
    planes: dict[int, np.ndarray] = {}
    powers = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        vecs = batch.column("vec").to_pylist()
        codes: list[bytes] = [b""] * len(vecs)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            if length not in planes:
                planes[length] = np.random.default_rng((seed, length)).standard_normal((length, bits * tables))
            rows = unit(np.frombuffer(b"".join(vecs[i] for i in at.tolist()), kind).reshape(len(at), length))
            signs = (rows @ planes[length] > 0).reshape(len(at), tables, bits)
            coded = (signs @ powers).astype("<i4")
            for i, code in zip(at.tolist(), coded):
                codes[i] = code.tobytes()
        kept = [batch.column(c) for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(codes, pa.binary())], [*batch.schema.names, "codes"])


# --- comparing ----------------------------------------------------------------------------

KEY = ("label", "length", "at", "code", "low", "high")
LINKS = "node bigint, links bigint, other bigint"


def _linked(left: dict, right: dict | None, at: int, threshold: float) -> tuple[np.ndarray, np.ndarray | None, list]:
    """Links between two chunks, or within one: new ones per vector on each side, and a spanning forest."""
    same = right is None
    other = left if same else right
    a, b = unit(left["vec"]), None if same else unit(other["vec"])
    b = a if same else b
    counts, back = np.zeros(len(a), np.int64), None if same else np.zeros(len(b), np.int64)
    shift = 0 if same else len(a)
    label = np.arange(len(a) + (0 if same else len(b)))
    forest: list[tuple[int, int]] = []
    for start in range(0, len(a), 64):
        near = a[start : start + 64] @ b.T >= threshold
        if same:
            near[np.arange(len(near)), start + np.arange(len(near))] = False
        rows, columns = np.nonzero(near)
        if not len(rows):
            continue
        new = np.ones(len(rows), bool)
        for t in range(at):
            new &= left["codes"][start + rows, t] != other["codes"][columns, t]
        np.add.at(counts, start + rows[new], other["size"][columns[new]])
        if not same:
            np.add.at(back, columns[new], left["size"][start + rows[new]])
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        for row, js in zip(rows[first].tolist(), np.split(columns, first[1:])):
            groups, where = np.unique(label[js + shift], return_index=True)
            fresh = groups != label[start + row]
            if fresh.any():
                forest += [(int(left["node"][start + row]), int(other["node"][js[w]])) for w in where[fresh]]
                joined = np.append(groups, label[start + row])
                label[np.isin(label, joined)] = joined.min()
    return counts, back, forest


def _compare(batches: Iterable[pa.RecordBatch], kind: str, threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task: (node, links, null) per vector with new links, (node, 0, other) per forest edge."""

    def task(key: tuple, rows: dict) -> pa.RecordBatch | None:
        if len(rows["node"]) < 2:
            return None
        length, at, low, high = key[1], key[2], key[4], key[5]
        data = {
            "node": rows["node"],
            "size": rows["size"],
            "codes": np.frombuffer(b"".join(rows["codes"]), "<i4").reshape(len(rows["node"]), -1),
            "vec": np.frombuffer(b"".join(rows["vec"]), kind).reshape(-1, length),
        }
        if low == high:
            sides = [data, None]
        else:
            mine = rows["chunk"] == low
            sides = [{c: x[mine] for c, x in data.items()}, {c: x[~mine] for c, x in data.items()}]
            if not len(sides[0]["node"]) or not len(sides[1]["node"]):
                return None
        counts, back, forest = _linked(*sides, at, threshold)
        found = [(sides[0]["node"], counts)] + ([] if back is None else [(sides[1]["node"], back)])
        nodes = np.concatenate([n[c > 0] for n, c in found])
        links = np.concatenate([c[c > 0] for _, c in found])
        a, b = np.array(forest, np.int64).reshape(-1, 2).T
        columns = [
            pa.array(np.concatenate((nodes, a))),
            pa.array(np.concatenate((links, np.zeros(len(a), np.int64)))),
            pa.array([*[None] * len(nodes), *b.tolist()], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["node", "links", "other"])

    held: tuple | None = None
    parts: list[dict] = []

    def finish() -> pa.RecordBatch | None:
        plain = {c: np.concatenate([p[c] for p in parts]) for c in ("node", "size", "chunk")}
        bytes_ = {c: [x for p in parts for x in p[c]] for c in ("codes", "vec")}
        return task(held, {**plain, **bytes_})

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in KEY])
        starts = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))) if batch.num_rows else []
        stops = [*list(starts[1:]), batch.num_rows]
        for a, b in zip(list(starts), stops):
            key = tuple(keys[:, a].tolist())
            if held is not None and key != held:
                found = finish()
                if found is not None:
                    yield found
                parts = []
            held = key
            piece = batch.slice(a, b - a)
            parts.append(
                {c: piece.column(c).to_numpy() for c in ("node", "size", "chunk")}
                | {c: piece.column(c).to_pylist() for c in ("codes", "vec")}
            )
    if held is not None:
        found = finish()
        if found is not None:
            yield found


def table_links(
    coded: DataFrame, first: int, until: int, kind: str, threshold: float, chunk: int, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Stored (node, links, other) of the tables first..until-1."""
    at = F.explode(F.sequence(F.lit(first), F.lit(until - 1))).alias("at")
    # bytes are little-endian, hexadecimal text is read from the largest digit on
    code = F.reverse(F.substring("codes", F.col("at") * 4 + 1, F.lit(4)))
    number = F.conv(F.hex(code), 16, 10).cast("bigint").alias("code")
    rows = coded.select("*", at).select("*", number)
    crowded = rows.groupBy("label", "length", "at", "code").count().where(F.col("count") > chunk)
    crowded = cut(crowded.select("label", "length", "at", "code", F.ceil(F.col("count") / chunk).cast("bigint").alias("chunks")))
    if crowded.count() <= broadcast_rows:
        crowded = F.broadcast(crowded)
    parted = rows.join(crowded, ["label", "length", "at", "code"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    parted = parted.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    # a chunk meets itself and each other chunk of its bucket
    met = parted.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("with"))
    tasks = met.select(
        "label", "length", F.col("at").cast("bigint").alias("at"), "code", F.least("chunk", "with").alias("low"),
        F.greatest("chunk", "with").alias("high"), "chunk", "node", "size", "codes", "vec",
    )
    ordered = tasks.repartition(*KEY).sortWithinPartitions(*KEY)
    return cut(ordered.mapInArrow(lambda b: _compare(b, kind, threshold), LINKS))


def near_duplicates(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    miss: float = MISS,
    bucket: int = BUCKET,
    chunk: int = CHUNK,
    seed: int = SEED,
    together: int = ROUND,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, embedding, label)."""
    rows, kind = usable(vectors)
    fine = rows.where("vec is not null")
    distinct = cut(
        fine.groupBy("label", "length", "vec")
        .agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    largest = distinct.groupBy("label", "length").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, threshold, miss, bucket)
    schema = "node bigint, label bigint, length int, size bigint, vec binary, codes binary"
    coded = cut(
        distinct.select("node", "label", "length", "size", "vec").mapInArrow(
            lambda b: _code_batches(b, kind, bits, tables, seed), schema
        )
    )
    found = None
    for first in range(0, tables, together):
        links = table_links(coded, first, min(first + together, tables), kind, threshold, chunk)
        found = links if found is None else found.unionByName(links)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    roots = components(edges)
    named = distinct.join(counts, "node", "left").join(roots, "node", "left").select(
        "label", "length", "vec", "least", F.coalesce("root", "node").alias("root"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    named = cut(named)
    lowest = cut(named.groupBy("root").agg(F.min("least").alias("component_id")))
    by_vector = cut(named.join(lowest, "root").select("label", "length", "vec", "n_links", "component_id"))
    linked = fine.select("vec_id", "label", "length", "vec").join(by_vector, ["label", "length", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = linked.unionByName(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

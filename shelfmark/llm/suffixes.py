"""Removal of repeated byte strings by bucket-pointer refinement of suffixes.

Suffixes start in buckets of equal q-grams (`GRAM` bytes). A bucket is refined by the identifiers
of the buckets that its suffixes reach at later offsets: 32 bytes, then 32 and 32 more, then 64
and 36 more give the buckets of equal strings of `LENGTH` bytes. An identifier is a hash of the
two identifiers it was refined from, so every task names a bucket alike without asking another,
and each refinement reuses the identifiers of the one before at all offsets.

Only buckets that can hold a repeat are refined to the end across documents:

1. Every window of LENGTH bytes is known by the least bucket identifier of the q-grams in it
   (equal windows have equal ones). Neighbouring windows mostly share it, so they go together as
   a run. A text sends one row for each run: that identifier, an identifier of the whole run's
   bytes, and its place.
2. Rows are sorted by both. A run whose least bucket occurs once repeats nothing. Of runs with
   the same bytes, all but the first are repeats. Runs that share a least bucket but differ
   in their bytes are refined.
3. Windows of such runs go together in blocks of up to BLOCK, by the distance from their start to
   that q-gram. A block's bucket is that of its core, the 93 bytes that all its windows share; the
   few bytes on either side travel as they are. Equal blocks are settled like equal runs.
4. Blocks that share a core but differ beside it are refined to single windows: the core's bucket
   and the bytes beside it, so no text is needed again. All but the first window are repeats.

Before each shuffle a task settles what it can see itself: of equal runs, blocks or windows at
hand only the first is sent, the others have an earlier copy already; of a bucket that holds
different ones, one mark is sent and they are refined. So a string that a third of all
documents hold, between whatever else, sends a few rows for each task that reads texts.

Defined results: a null or empty text has no bytes; order is by doc_id, null last; rows that
repeat id and text are one document, each with its result; different texts of one id, or without
one, are documents of their own, ordered by the 64-bit hash of their text and numbered for the
purpose; an empty table gives no rows; other columns are ignored. Texts move compressed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut, slices, unpacked

LENGTH = 100
GRAM = 32
SLICE_BYTES = 2 << 20

#: a place is tag (16 bits of the text's hash), start (39 bits), number of windows (8 bits)
START_BITS, COUNT_BITS = 39, 8
LONGEST_RUN = LENGTH - GRAM + 1
NULL_DOC = (1 << 63) - 1

#: kinds of rows: first of its bytes here; mark of a bucket with different runs; settled; to refine
FIRST, MARK, REPEAT, REFINE = 0, 1, 2, 3

_RNG = np.random.default_rng(20240229)
BYTE_IDS = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = ((np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)), (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)))


def refine(here: np.ndarray, later: np.ndarray, lane: int = 0) -> np.ndarray:
    """Identifiers of the buckets refined by those at a later offset."""
    a, b = FACTORS[lane]
    x = here * a
    x ^= x >> np.uint64(29)
    x += later
    x *= b
    x ^= x >> np.uint64(32)
    return x


def buckets(data: np.ndarray, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers at each position of `data` for GRAM and for LENGTH bytes."""
    ids = BYTE_IDS[lane][data]
    for size in (1, 2, 4, 8, 16):
        ids = refine(ids[:-size], ids[size:], lane)
    grams = ids
    twice = refine(grams[:-GRAM], grams[GRAM:], lane)
    rest = LENGTH - 2 * GRAM
    return grams, refine(twice[:-rest], twice[rest:], lane)


def least_in_windows(grams: np.ndarray) -> np.ndarray:
    """The least of the LONGEST_RUN identifiers from each position on."""
    least, size = grams, 1
    while size * 2 <= LONGEST_RUN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = LONGEST_RUN - size
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes, first position of each text and, for each text, its number of windows."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return data, np.cumsum(sizes) - sizes, np.maximum(sizes - LENGTH + 1, 0)


def _window_positions(first: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, position in the joined bytes) of every window."""
    owner = np.repeat(np.arange(len(windows)), windows)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    return owner, first[owner] + nth


def _place(tag: np.ndarray, start: np.ndarray, count: np.ndarray | int) -> np.ndarray:
    return ((tag << START_BITS) + start << COUNT_BITS) + count


def start_of(place: np.ndarray) -> np.ndarray:
    return (place >> COUNT_BITS) & ((1 << START_BITS) - 1)


def count_of(place: np.ndarray) -> np.ndarray:
    return place & ((1 << COUNT_BITS) - 1)


ROW = ("bucket", "one", "two", "doc", "place", "kind")
SCHEMA = "bucket bigint, one bigint, two bigint, doc bigint, place bigint, kind tinyint"
Rows = tuple[np.ndarray, ...]
"""Columns of ROW. Within a bucket, `one` and `two` tell different bytes apart."""


def _batch(rows: Iterable[np.ndarray]) -> pa.RecordBatch:
    *numbers, kind = rows
    columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in numbers]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.asarray(kind, np.int8))], list(ROW))


def _stacked(parts: list[Rows]) -> Rows:
    return tuple(np.concatenate([np.ascontiguousarray(x).view(np.int64) if x.dtype != np.int8 else x for x in column]) for column in zip(*parts))


def _picked(rows: Rows, chosen: np.ndarray, kind: int) -> Rows:
    return (*(x[chosen] for x in rows[:5]), np.full(int(chosen.sum()), kind, np.int8))


def _settle_here(rows: Rows, inside: np.ndarray | None) -> tuple[Rows, Rows, Rows, Rows]:
    """FIRST rows, marks, repeats and rows to refine among the FIRST rows of the texts at hand. `inside`
    has rows that hold repeats of their own; it is missing for single windows, which are not refined."""
    order = np.lexsort((rows[4], rows[3], rows[2], rows[1], rows[0]))
    rows = tuple(x[order] for x in rows)
    bucket, one, two, doc, place, _ = rows
    new_bucket = np.append(True, bucket[1:] != bucket[:-1])
    new_bytes = new_bucket | np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
    head = np.maximum.accumulate(np.where(new_bytes, np.arange(len(order)), 0))
    # rows that repeat id and text are the same document
    repeat = ~new_bytes & ((doc != doc[head]) | (place != place[head]))
    group = np.cumsum(new_bucket) - 1
    mixed = np.zeros(group[-1] + 1, bool)
    if inside is not None:
        mixed = (np.bincount(group, new_bytes) > 1) | (np.bincount(group, inside[order]) > 0)
    marked = np.zeros(len(order), bool)
    marked[np.flatnonzero(new_bucket)[mixed]] = True
    refined = new_bytes & mixed[group]
    return (
        _picked(rows, new_bytes & ~refined, FIRST),
        _picked(rows, marked, MARK),
        _picked(rows, repeat, REPEAT),
        _picked(rows, refined, REFINE),
    )


def _spread(rows: Rows) -> Rows:
    """The rows under a key of their own, so that they gather nowhere."""
    return (refine(rows[3].view(np.uint64), rows[4].view(np.uint64)), *rows[1:])


class Sent:
    """What a task has sent to hot buckets, in a table of fixed size.

    A bucket that slice after slice of a task meets would get a row or two from each. The table knows
    what the task sent before, so that a bucket gets a few rows from each task: bytes sent before, and
    from an earlier place, are a repeat; a bucket that was marked needs no second mark, and its
    rows are refined. Buckets compete for the entries; one that was met again keeps its entry. What the
    table does not know is sent as ever, so its size only decides how much is spared."""

    def __init__(self, bits: int = 18) -> None:
        self._shift = np.uint64(64 - bits)
        self._rows = [np.zeros(1 << bits, np.int64) for _ in range(5)]
        #: 0 empty, 1 sent, 2 met again
        self._state = np.zeros(1 << bits, np.int8)
        self._marked = np.zeros(1 << bits, bool)

    def _find(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each row's bucket, and whether it is the bucket's own."""
        at = ((rows[0].view(np.uint64) * FACTORS[0][0]) >> self._shift).astype(np.int64)
        return at, (self._state[at] > 0) & (self._rows[0][at] == rows[0])

    def settle(self, found: tuple[Rows, Rows, Rows, Rows], mixes: bool = True) -> tuple[Rows, Rows, Rows, Rows]:
        """FIRST rows, marks, repeats and rows to refine of a slice, less what was sent before. Without
        `mixes` a bucket may hold different bytes and stays as it is."""
        first, marks, repeats, refined = (_stacked([rows]) for rows in found)
        at, own = self._find(first)
        same = own & (self._rows[1][at] == first[1]) & (self._rows[2][at] == first[2])
        known = self._rows[3][at], self._rows[4][at]
        marked = own & self._marked[at] if mixes else np.zeros(len(at), bool)
        later = same & ~marked & ((first[3] > known[0]) | ((first[3] == known[0]) & (first[4] > known[1])))
        again = same & ~marked & (first[3] == known[0]) & (first[4] == known[1])
        mixed = own & ~same & ~marked if mixes else np.zeros(len(at), bool)
        sent = ~(marked | later | again | mixed)
        mark_at, mark_own = self._find(marks)
        new_mark = ~(mark_own & self._marked[mark_at])
        # entries: earlier places of the same bytes, buckets without one, marks
        self._state[at[own]] = 2
        self._marked[at[mixed]] = True
        taken = sent & (same | (self._state[at] < 2))
        for column, values in zip(self._rows, first):
            column[at[taken]] = values[taken]
        self._state[at[taken & ~own]] = 1
        self._marked[at[taken & ~own]] = False
        free = new_mark & (mark_own | (self._state[mark_at] < 2))
        for column, values in zip(self._rows, marks):
            column[mark_at[free]] = values[free]
        self._state[mark_at[free & ~mark_own]] = 1
        self._marked[mark_at[free]] = True
        return (
            _picked(first, sent, FIRST),
            _stacked([_picked(marks, new_mark, MARK), _picked(first, mixed, MARK)]),
            _stacked([repeats, _picked(first, later, REPEAT)]),
            _stacked([refined, _picked(first, marked | mixed, REFINE)]),
        )


def _settle_groups(rows: Rows) -> tuple[Rows, Rows]:
    """Repeats and rows to refine among sorted FIRST rows and marks."""
    bucket, one, two, doc, place, kind = rows
    new_bucket = np.append(True, bucket[1:] != bucket[:-1])
    new_bytes = new_bucket | np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
    group = np.cumsum(new_bucket) - 1
    mixed = (np.bincount(group, new_bytes) > 1) | (np.bincount(group, kind == MARK) > 0)
    first = kind == FIRST
    byte_group = np.cumsum(new_bytes) - 1
    positions = np.flatnonzero(first)
    head = np.full(byte_group[-1] + 1, len(bucket))
    np.minimum.at(head, byte_group[positions], positions)
    leads = np.zeros(len(bucket), bool)
    leads[head[head < len(bucket)]] = True
    lead = np.minimum(head[byte_group], len(bucket) - 1)
    repeat = first & ~leads & ((doc != doc[lead]) | (place != place[lead]))
    return _picked(rows, repeat, REPEAT), _picked(rows, leads & mixed[group], REFINE)


def _whole_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[Rows]:
    """Columns of sorted rows, cut between buckets only. A bucket has a row or two for each slice of texts."""
    held: Rows | None = None
    for batch in batches:
        new = tuple(batch.column(c).to_numpy() for c in ROW)
        held = new if held is None else _stacked([held, new])
        if len(held[0]) and held[0][0] != held[0][-1]:
            at = int(np.searchsorted(held[0], held[0][-1]))
            yield tuple(x[:at] for x in held)
            held = tuple(x[at:] for x in held)
    if held is not None and len(held[0]):
        yield held


def _settled_batches(batches: Iterable[pa.RecordBatch], windows: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, one, two, doc, place: repeats, and rows to refine. With `windows`, blocks
    to refine become single windows."""
    for rows in _whole_buckets(batches):
        passed = (rows[5] == REPEAT) | (rows[5] == REFINE)
        parts = [tuple(x[passed] for x in rows)]
        rest = tuple(x[~passed] for x in rows)
        if len(rest[0]):
            repeats, refined = _settle_groups(rest)
            parts += [_spread(repeats), _windows_of_blocks(refined) if windows else refined]
        yield _batch(_stacked(parts))


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", "one", "two", "doc", "place")


def _repeats_inside(grams: np.ndarray, value: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs that hold the q-gram of their least bucket more than once, so that windows of one run may be equal."""
    widest = 2 * LONGEST_RUN - 1
    padded = np.lib.stride_tricks.sliding_window_view(np.append(grams, np.zeros(widest, np.uint64)), widest)
    found = np.zeros(len(start), bool)
    column = np.arange(widest)
    for i in range(0, len(start), 1 << 13):
        some = slice(i, i + (1 << 13))
        equal = padded[start[some]] == value[some, None]
        equal &= column < (size[some] + LONGEST_RUN - 1)[:, None]
        found[some] = equal.sum(axis=1) > 1
    return found


def _tag(text_hash: np.ndarray) -> np.ndarray:
    return text_hash & 0xFFFF


def _run_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of windows."""
    sent = Sent()
    for batch in slices(batches, "text", SLICE_BYTES):
        texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
        doc, tag = batch.column("doc").to_numpy(), _tag(batch.column("text_hash").to_numpy())
        data, first, windows = _joined(texts)
        if not windows.any():
            continue
        grams, whole = buckets(data)
        least = least_in_windows(grams)
        owner, at = _window_positions(first, windows)
        value = least[at]
        change = np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))
        start = np.flatnonzero(change)
        size = np.diff(np.append(start, len(at)))
        # equal q-grams far apart can make a run longer than two windows cover; such runs are cut
        parts = -(-size // LONGEST_RUN)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, size = np.repeat(start, parts) + nth * LONGEST_RUN, np.minimum(np.repeat(size, parts) - nth * LONGEST_RUN, LONGEST_RUN)
        bytes_id = refine(refine(whole[at[start]], whole[at[start + size - 1]]), size.astype(np.uint64))
        text = owner[start]
        inside = _repeats_inside(grams, value[start], at[start], size)
        none = np.zeros(len(start), np.int64)
        place = _place(tag[text], at[start] - first[text], size)
        found = sent.settle(_settle_here((value[start], bytes_id, none, doc[text], place, none.astype(np.int8)), inside))
        yield _batch(_stacked([found[FIRST], found[MARK], _spread(found[REPEAT]), _spread(found[REFINE])]))


# --- texts on the move --------------------------------------------------------------------

PACKED = "doc_id bigint, doc bigint, text_hash bigint, tag bigint, packed binary"


def _packed_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=3)
    for batch in slices(batches, "text", SLICE_BYTES):
        packed = pa.array([press.compress((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary())
        tag = pa.array(_tag(batch.column("text_hash").to_numpy()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("doc"), batch.column("text_hash"), tag, packed],
            ["doc_id", "doc", "text_hash", "tag", "packed"],
        )


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    return unpacked(batches, "packed", SLICE_BYTES)


# --- blocks and windows -------------------------------------------------------------------
# Window r of a block starts r bytes before the core and ends BLOCK - 1 - r bytes after it. A row has
# the bytes before the core in `one`, the nearest lowest, under a byte with the largest r and the
# number of windows, and the bytes after it in `two`.

BLOCK = 8
CORE = LENGTH - BLOCK + 1


def cores(grams: np.ndarray) -> np.ndarray:
    """Identifiers of the buckets of CORE bytes."""
    twice = refine(grams[:-GRAM], grams[GRAM:])
    rest = CORE - 2 * GRAM
    return refine(twice[:-rest], twice[rest:])


def _nearest_gram(grams: np.ndarray, value: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each window of each run (start, size), in order, the first position of the run's q-gram in it."""
    widest = 2 * LONGEST_RUN - 1
    padded = np.lib.stride_tricks.sliding_window_view(np.append(grams, np.zeros(widest, np.uint64)), widest)
    column = np.arange(widest)
    found = []
    for i in range(0, len(start), 1 << 13):
        some = slice(i, i + (1 << 13))
        at = np.where(padded[start[some]] == value[some, None], column, widest)
        at = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1]
        inside = column[:LONGEST_RUN] < size[some, None]
        found.append((at[:, :LONGEST_RUN] + start[some, None])[inside])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _bytes_beside(data: np.ndarray, at: np.ndarray, step: int, count: np.ndarray) -> np.ndarray:
    """Up to BLOCK - 1 bytes from `at` on, in steps of +1 or -1, as one number; zero beyond `count`."""
    packed = np.zeros(len(at), np.uint64)
    for i in range(BLOCK - 1):
        inside = i < count
        byte = np.where(inside, data[np.clip(at + step * i, 0, len(data) - 1)], 0).astype(np.uint64)
        packed |= byte << np.uint64(8 * i)
    return packed


def _windows_of_blocks(rows: Rows) -> Rows:
    """FIRST rows of the single windows of blocks: `bucket` and `one` identify a window's bytes."""
    core, before, after, doc, place, _ = rows
    before, after = before.view(np.uint64), after.view(np.uint64)
    top = (before >> np.uint64(56)).astype(np.int64)
    most, count = top >> 4, top & 15
    row = np.repeat(np.arange(len(core)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    r = most[row] - nth
    left = before[row] & ((np.uint64(1) << (8 * r).astype(np.uint64)) - np.uint64(1))
    right = after[row] & ((np.uint64(1) << (8 * (BLOCK - 1 - r)).astype(np.uint64)) - np.uint64(1))
    beside = left | right << (8 * r).astype(np.uint64)
    ids = [refine(refine(core.view(np.uint64)[row], beside, lane), r.astype(np.uint64), lane) for lane in (0, 1)]
    tag, start = place[row] >> (START_BITS + COUNT_BITS), start_of(place[row]) + nth
    zero = np.zeros(len(row), np.int64)
    return (*ids, zero, doc[row], _place(tag, start, 1), np.full(len(row), REFINE, np.int8))


def _block_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the blocks of the runs to refine."""
    sent, sent_windows = Sent(), Sent()
    for batch, texts in _unpacked(batches):
        doc, tag = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
        data, first, _ = _joined(texts)
        places = batch.column("places")
        text = np.repeat(np.arange(len(texts)), places.value_lengths().to_numpy())
        place = places.flatten().to_numpy()
        start, size = first[text] + start_of(place), count_of(place)
        grams, _ = buckets(data)
        value = least_in_windows(grams)[start]
        near = _nearest_gram(grams, value, start, size)
        run = np.repeat(np.arange(len(start)), size)
        at = start[run] + np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        core = near - (near - at) // BLOCK * BLOCK
        new = np.flatnonzero(np.append(True, (core[1:] != core[:-1]) | (run[1:] != run[:-1])))
        count = np.diff(np.append(new, len(run)))
        core, at, text = core[new], at[new], text[run[new]]
        most = core - at
        least = most - count + 1
        before = _bytes_beside(data, core - 1, -1, most) | ((most << 4) + count).astype(np.uint64) << np.uint64(56)
        after = _bytes_beside(data, core + CORE, 1, BLOCK - 1 - least)
        place = _place(tag[text], at - first[text], count)
        none = np.zeros(len(new), np.int8)
        found = sent.settle(_settle_here((cores(grams)[core], before, after, doc[text], place, none), none.astype(bool)))
        parts = [found[FIRST], found[MARK], _spread(found[REPEAT])]
        if len(found[REFINE][0]):
            windows = sent_windows.settle(_settle_here(_windows_of_blocks(found[REFINE]), None), mixes=False)
            parts += [_picked(windows[FIRST], np.ones(len(windows[FIRST][0]), bool), REFINE), _spread(windows[REPEAT])]
        yield _batch(_stacked(parts))


def _window_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and one: the windows to refine have an earlier copy but for the first."""
    for rows in _whole_buckets(batches):
        repeats = tuple(x[rows[5] == REPEAT] for x in rows)
        windows = _picked(rows, rows[5] == REFINE, FIRST)
        parts = [repeats] + ([_settle_groups(windows)[0]] if len(windows[0]) else [])
        yield _batch(_stacked(parts))


def _result_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in _unpacked(batches):
        rows = []
        for text, places in zip(texts, batch.column("places").to_pylist()):
            place = np.array(places or [], np.int64)
            start = start_of(place)
            edges = np.zeros(len(text) + 1, np.int64)
            np.add.at(edges, start, 1)
            np.add.at(edges, start + count_of(place) - 1 + LENGTH, -1)
            gone = np.cumsum(edges[:-1]) > 0
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows)) or [()] * 4
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _by_text(rows: DataFrame) -> DataFrame:
    """Places listed by document and tag."""
    tag = F.shiftright("place", START_BITS + COUNT_BITS)
    return rows.groupBy(F.col("doc").alias("_doc"), tag.alias("_tag")).agg(F.collect_list("place").alias("places"))


def repeated_places(documents: DataFrame) -> DataFrame:
    """(doc, place) of the windows of `documents` (doc, text_hash, text) that also start earlier."""
    runs = documents.select("doc", "text_hash", "text").mapInArrow(_run_batches, SCHEMA)
    settled = cut(_ordered(runs).mapInArrow(lambda b: _settled_batches(b, False), SCHEMA).select("doc", "place", "kind"))
    texts = _packed(documents)
    open_runs = _by_text(settled.where(F.col("kind") == REFINE))
    joined = texts.join(open_runs, (texts["doc"] == open_runs["_doc"]) & (texts["tag"] == open_runs["_tag"]))
    blocks = joined.select("doc", "tag", "packed", "places").mapInArrow(_block_batches, SCHEMA)
    windows = _ordered(blocks).mapInArrow(lambda b: _settled_batches(b, True), SCHEMA)
    refined = cut(_ordered(windows).mapInArrow(_window_batches, SCHEMA).select("doc", "place"))
    return settled.where(F.col("kind") == REPEAT).select("doc", "place").unionByName(refined)


def _packed(documents: DataFrame) -> DataFrame:
    columns = documents.columns
    with_id = documents if "doc_id" in columns else documents.withColumn("doc_id", F.col("doc"))
    return with_id.select("doc_id", "doc", "text_hash", "text").mapInArrow(_packed_batches, PACKED)


def _ordered_places(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, doc) of the distinct texts: `doc` numbers them from 0 by doc_id, null last, and
    hash. Numbers are given inside each partition of a stored range sort and shifted by the sizes of
    earlier partitions."""
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
    slim = rows.select("doc_id", "text_hash").distinct()
    sorted_ = cut(slim.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()))
    sizes = sorted_.groupBy("part").agg(F.count("*").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    shifts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("shift"))
    nth = F.col("nth").bitwiseAND((1 << 33) - 1)
    return sorted_.join(shifts, "part").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), (nth + F.col("shift")).alias("doc"))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of `documents` (doc_id, text)."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    # an id that several texts share, as a missing one may be, cannot tell them apart
    hashes = rows.groupBy("doc_id").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"))
    if hashes.where("low <> high").isEmpty():
        rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NULL_DOC)))
    else:
        numbers = cut(_ordered_places(rows))
        same = rows["doc_id"].eqNullSafe(numbers["_id"]) & (rows["text_hash"] == numbers["_hash"])
        rows = rows.join(numbers, same).drop("_id", "_hash")
    places = _by_text(repeated_places(rows))
    texts = _packed(rows)
    joined = texts.join(places, (texts["doc"] == places["_doc"]) & (texts["tag"] == places["_tag"]), "left")
    return joined.select("doc_id", "packed", "places").mapInArrow(
        _result_batches, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )

"""Line dedup by a log-template tree.

A line is a list of tokens, cut at ASCII white space. The tree has a fixed depth: the number of
tokens, then `DEPTH` leading tokens, where tokens that look like values (with a digit, or without
a letter) are a wildcard. In a leaf, a token that recurs at its position, `RECURS` times or
more, is constant; any other, and each wildcard, is a variable field, so lines that differ in such
fields get one template. (Equal lines of one document count once, different ones each.) A template of which at least `CONSTANT` of the tokens are constant, and which
`RECURS` documents or more hold, recurs: its first line in the corpus (by doc_id, then position)
stays and the others are dropped. Exactly equal lines that `RECURS` documents hold recur whatever
their tokens, so rows of values go only where the values are equal. Short lines have leaves of their own, since a leaf is the number
of tokens and the tokens there are. With `long_recurs`, an exactly equal long line, of `LONG_WORDS`
words or `LONG_CHARS` characters, recurs from that many documents on; a line without spaces, as in
Chinese, is long by its characters. Only lines without any token are left out.

A line moves as hashes of its leaf and its content. Only lines of shared leaves go further, and of
equal ones the tokens are brought once. Counts are combined before they are shuffled, so a line
that a third of all documents hold is a few rows of each task. Texts move compressed.

Defined results: a null text stays null; rows that repeat id and text are one document, whose
lines stay or go together; rows that repeat an id with another text are documents of their own;
null ids come last; a document left without a line is empty; an empty table gives no rows;
other columns pass unchanged."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut, free_name, packed, slices, unpacked

DEPTH = 4
TOKENS = 1
RECURS = 3
LONG_RECURS = 2
LONG_WORDS = 20
LONG_CHARS = 100
CONSTANT = 0.6

_VALUE = re.compile(r"\d|^[\W_]+$")
WILDCARD = b"<*>"


def _hash(data: bytes) -> int:
    value = xxhash.xxh64_intdigest(data)
    return value - (1 << 64) if value >> 63 else value


def tokens(line: str) -> list[bytes]:
    """Tokens of a line, those that look like values as the wildcard."""
    return _masked(line.encode().split())


def _masked(raw: list[bytes]) -> list[bytes]:
    return [WILDCARD if _VALUE.search(t.decode()) else t for t in raw]


def is_long(raw: list[bytes]) -> bool:
    """Whether a line, given by its tokens as they are, has so many words or characters that two equal ones are copies."""
    if len(raw) >= LONG_WORDS:
        return True
    joined = b" ".join(raw)
    return len(joined) >= LONG_CHARS and len(joined.decode()) >= LONG_CHARS


def leaf(found: list[bytes], depth: int = DEPTH) -> int:
    """Where a line stands in the tree."""
    return _hash(b"%d %b" % (len(found), b" ".join(found[:depth])))


PLACES = "doc_id bigint, text_hash bigint, lines array<struct<line:int,leaf:bigint,content:bigint,raw:bigint,long:boolean>>"


def _place_batches(batches: Iterable[pa.RecordBatch], least: int, depth: int) -> Iterator[pa.RecordBatch]:
    entry = pa.struct([("line", pa.int32()), ("leaf", pa.int64()), ("content", pa.int64()), ("raw", pa.int64()), ("long", pa.bool_())])
    for batch in slices(batches, "text", 8 << 20):
        placed = []
        for text in batch.column("text").to_pylist():
            lines = [(i, t) for i, t in enumerate(x.encode().split() for x in (text or "").split("\n")) if len(t) >= least]
            masked = [_masked(t) for _, t in lines]
            placed.append(
                [(i, leaf(m, depth), _hash(b" ".join(m)), _hash(b" ".join(t)), is_long(t)) for (i, t), m in zip(lines, masked)]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(placed, pa.list_(entry))], ["doc_id", "text_hash", "lines"]
        )


def _token_batches(batches: Iterable[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in read_packed(batches):
        rows: list[tuple] = []
        for text, wanted in zip(texts, batch.column("wanted").to_pylist()):
            lines = (text or "").split("\n")
            for found in (tokens(lines[i]) for i in wanted):
                rows.append((leaf(found, depth), _hash(b" ".join(found)), [_hash(t) for t in found]))
        columns = list(zip(*rows)) or [()] * 3
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["leaf", "content", "tokens"])


def read_packed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch, texts in unpacked(batches):
        yield batch, [None if t is None else t.decode() for t in texts]


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["_id"]) & (a["text_hash"] == b["_hash"])


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_hash", "_hash")


def recurring_lines(
    documents: DataFrame,
    *,
    depth: int = DEPTH,
    least: int = TOKENS,
    recurs: int = RECURS,
    constant: float = CONSTANT,
    long_recurs: int | None = None,
) -> DataFrame:
    """(doc_id, text_hash, dropped): positions of the lines to drop of rows (doc_id, text).

    Equal long lines recur like any other unless `long_recurs` gives them a number of documents."""
    long_recurs = recurs if long_recurs is None else long_recurs
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    placed = rows.mapInArrow(lambda b: _place_batches(b, least, depth), PLACES)
    placed = cut(placed.where("size(lines) > 0").dropDuplicates(["doc_id", "text_hash"]))
    leaves = placed.select(F.explode(F.array_distinct("lines.leaf")).alias("leaf"))
    # stored lookups, so that a join with a hot key is one of two plain shuffles, which Spark can split
    counted = leaves.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= min(recurs, long_recurs))
    shared = cut(counted.select("leaf", (F.col("n") >= recurs).alias("grown")))
    held = cut(placed.select("doc_id", "text_hash", F.inline("lines")).join(shared, "leaf"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "line")
    contents = (
        held.where("grown").groupBy("leaf", "content", "doc_id", "text_hash")
        .agg(F.min(place).alias("first"))
        .groupBy("leaf", "content")
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
    )
    contents = cut(contents)
    # tokens of one line of each content
    wanted = contents.groupBy(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")).agg(
        F.collect_list("first.line").alias("wanted")
    )
    texts = packed(rows)
    brought = texts.join(wanted, _same(texts, wanted)).select("text", "wanted")
    read = brought.mapInArrow(lambda b: _token_batches(b, depth), "leaf bigint, content bigint, tokens array<bigint>")
    read = cut(read.dropDuplicates(["leaf", "content"]).join(contents.select("leaf", "content", "n"), ["leaf", "content"]))
    fields = read.select("leaf", "content", "n", F.posexplode("tokens").alias("position", "token"))
    constants = fields.groupBy("leaf", "position", "token").agg(F.sum("n").alias("n")).where(F.col("n") >= recurs)
    constants = constants.where(F.col("token") != _hash(WILDCARD))
    constants = cut(constants.select("leaf", "position", "token", F.lit(True).alias("constant")))
    marked = fields.drop("n").join(constants, ["leaf", "position", "token"], "left")
    field = F.struct("position", F.when(F.col("constant"), F.col("token")).alias("token"))
    shaped = marked.groupBy("leaf", "content").agg(
        F.xxhash64(F.array_sort(F.collect_list(field))).alias("template"), (F.count("constant") / F.count("*")).alias("share")
    )
    shaped = cut(shaped.where(F.col("share") >= constant).select("leaf", "content", "template"))
    lines = cut(held.join(shaped, ["leaf", "content"]).select("leaf", "template", "doc_id", "text_hash", "line"))
    kinds = (
        lines.groupBy("leaf", "template", "doc_id", "text_hash")
        .agg(F.min(place).alias("first"))
        .groupBy("leaf", "template")
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
        .where(F.col("n") >= recurs)
        .select("leaf", "template", "first")
    )
    later = lines.join(cut(kinds), ["leaf", "template"]).where(~(place == F.col("first")))
    # equal lines, whatever their tokens; long ones may need fewer documents than a template
    equal = (
        held.groupBy("leaf", "raw", "long", "doc_id", "text_hash")
        .agg(F.min(place).alias("first"))
        .groupBy("leaf", "raw", "long")
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
        .where(F.col("n") >= F.when(F.col("long"), long_recurs).otherwise(recurs))
        .select("leaf", "raw", "first")
    )
    copies = held.join(cut(equal), ["leaf", "raw"]).where(~(place == F.col("first")))
    both = later.select("doc_id", "text_hash", "line").unionByName(copies.select("doc_id", "text_hash", "line"))
    return both.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("dropped"))


def _with_dropped(documents: DataFrame, **settings) -> DataFrame:
    """All columns of `documents`, the text packed, and, last, the positions to drop."""
    found = _keyed(recurring_lines(documents.select("doc_id", "text"), **settings))
    hashed = free_name(documents, "hash_of_text")
    rows = packed(documents.withColumn(hashed, F.xxhash64("text")))
    same = rows["doc_id"].eqNullSafe(found["_id"]) & (rows[hashed] == found["_hash"])
    last = found["dropped"].alias(free_name(documents, "dropped"))
    return rows.join(found, same, "left").select(*[rows[c] for c in documents.columns], last)


def remaining(text: str | None, dropped: list[int] | None) -> str | None:
    """The text without the lines at the dropped positions."""
    if text is None or not dropped:
        return text
    gone = set(dropped)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def _rewritten(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    for batch, texts in read_packed(batches):
        left = [remaining(t, d) for t, d in zip(texts, batch.column(batch.num_columns - 1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()) if c == "text" else batch.column(c) for c in columns], columns)


def drop_lines(documents: DataFrame, **settings) -> DataFrame:
    """`documents` without recurring lines; documents that lose all their lines go."""
    joined = _with_dropped(documents, **settings)
    kept = joined.mapInArrow(lambda b, c=documents.columns: _rewritten(b, c), documents.schema)
    return kept.where("text is null or text rlike '[^ \\\\x09-\\\\x0D]'")


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in read_packed(batches):
        rows = []
        for text, dropped in zip(texts, batch.column(batch.num_columns - 1).to_pylist()):
            left = remaining(text or "", dropped)
            rows.append(((text or "").count("\n") + bool(text), len(dropped or ()), hashlib.sha256(left.encode()).hexdigest()))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))]],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def report(documents: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per row of `documents`."""
    joined = _with_dropped(documents.select("doc_id", "text"), **settings)
    return joined.mapInArrow(_summaries, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")

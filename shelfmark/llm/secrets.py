"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is addressed by its content. A pair of blob and rule version is
scanned once: pairs already in the ledger are left out, the rest are scanned, and findings are
joined back to all paths and versions that hold the blob. `Ledger` keeps the three tables of that in
a folder: history (path, blob), findings and scanned pairs. A run appends to them in this order, so
a run that fails before the pairs are stored is repeated, and what it had stored already is not
counted twice.

Spans are code points with the end exclusive, of leftmost matches of a kind that do not overlap.
Positions come from the pieces between the matches, so a text is read by the rules only, and
only where a rule can match at all.

Defined results: a null text is empty and has no findings; copies and repeated rows get the
findings of their blob each; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.frames import cut


@dataclass(frozen=True)
class Rule:
    """kind, version and Java pattern. Matches need `least` characters in `group`; where `needs` is
    given, a text without any of these strings cannot match."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    needs: tuple[str, ...] = ()


# The three base kinds. In hex and access, a run below the least length fails, and
# no later start inside such a run is longer, so the length can stand in the pattern.
BASE = (
    Rule(
        "assign",
        1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}", needs=("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
ADDED = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", needs=("PRIVATE KEY-----",)),
    Rule("bearer", 1, r"\bBearer\x20+[A-Za-z0-9._~+/-]{16,}=*", needs=("Bearer",)),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs=("eyJ",)),
    Rule(
        "github",
        1,
        r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})",
        needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_"),
    ),
    Rule("slack", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}", needs=("xox",)),
    Rule("url_login", 1, r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,100}:[^\s/:@]{3,100}@", needs=("://",)),
)
RULES = BASE + ADDED

STEPS = "array<struct<gap:int,size:int,kept:boolean>>"


def address(text: Column) -> Column:
    """Content address: SHA-256 of the text."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _steps(rule: Rule) -> Column:
    """For each match of a rule in `text`: characters since the last match, its size, whether it is long enough."""
    pattern = F.lit(rule.pattern)
    text = F.col("text")
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    kept = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(sizes)).alias("gap"), sizes.alias("size"), kept.alias("kept"))
    may = text.rlike(rule.pattern)
    if rule.needs:
        has = F.lit(False)
        for literal in rule.needs:
            has = has | F.contains(text, F.lit(literal))
        may = has & may
    return F.when(F.array_contains("kinds", rule.kind) & may, zipped.cast(STEPS))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings (blob, kind, rule_version, start, end) of rows (blob, text, kinds): the text is read
    for the rules named in `kinds`."""
    by_rule = [
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version"), _steps(r).alias("steps")) for r in rules
    ]
    found = blobs.select("blob", F.inline(F.array(*by_rule))).where("steps is not null")
    matches = found.dropDuplicates(["blob", "kind"]).select("blob", "kind", "rule_version", F.posexplode("steps").alias("n", "step"))
    until = Window.partitionBy("blob", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    placed = matches.withColumn("end", F.sum(F.col("step.gap").cast("long") + F.col("step.size")).over(until))
    return placed.where("step.kept").select("blob", "kind", "rule_version", (F.col("end") - F.col("step.size")).alias("start"), "end")


def unseen(history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Pairs (blob, kind, rule_version) of a history (path, blob) that the ledger lacks, each with
    one path that holds the blob."""
    blobs = history.groupBy("blob").agg(F.min("path").alias("path"))
    listed = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version")) for r in rules])
    pairs = blobs.select("blob", "path", F.inline(listed))
    if ledger is None:
        return pairs
    return pairs.join(ledger.select("blob", "kind", "rule_version"), ["blob", "kind", "rule_version"], "left_anti")


def scan_unseen(texts: DataFrame, pairs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of the given pairs; each blob's text is fetched from one path of `texts` (path, text).

    A blob is an even key: copies were grouped before the texts move."""
    todo = pairs.groupBy("blob", "path").agg(F.collect_set("kind").alias("kinds"))
    held = texts.select(address(F.col("text")).alias("blob"), F.col("path").alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    fetched = held.join(todo, (held["blob"] == todo["blob"]) & held["at"].eqNullSafe(todo["path"]))
    return scan(fetched.select(todo["blob"], "text", "kinds"), rules)


def listing(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per blob: all findings as kind:start:end by start, then kind as listed, and those of the base kinds."""
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    row = F.struct("start", rank[F.col("kind")].alias("rank"), "end", "kind")
    base = [r.kind for r in BASE]

    def written(rows: Column) -> Column:
        return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base]
    listed = findings.groupBy("blob").agg(*counts, F.array_sort(F.collect_list(row)).alias("rows"))
    return listed.select(
        "blob",
        *[f"n_{k}" for k in base],
        written(F.filter("rows", lambda s: s["kind"].isin(base))).alias("base"),
        written(F.col("rows")).alias("spans"),
    )


def report(history: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings joined back to every path of a history (path, blob, ...); paths may repeat."""
    # stored, so that a blob with very many paths meets it in a join that Spark can split
    by_blob = cut(listing(findings, rules))
    joined = history.join(by_blob, "blob", "left")
    counts = [F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return joined.select(
        "path",
        *counts,
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


class Ledger:
    """History, findings and scanned pairs as Parquet tables in a folder that all executors share."""

    SCHEMAS = {
        "history": "path {path}, blob string",
        "findings": "blob string, kind string, rule_version int, start bigint, end bigint",
        "pairs": "blob string, kind string, rule_version int",
    }

    def __init__(self, spark: SparkSession, folder: str, path_type: str = "bigint") -> None:
        self.spark, self.folder, self.path_type = spark, folder.rstrip("/"), path_type

    def _schema(self, name: str) -> str:
        return self.SCHEMAS[name].replace("{path}", self.path_type)

    def read(self, name: str) -> DataFrame:
        """A table of the ledger, each row once."""
        # an empty table is written where there is none yet, and nothing where there is one
        self.spark.createDataFrame([], self._schema(name)).write.mode("ignore").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(self._schema(name)).parquet(f"{self.folder}/{name}").distinct()

    def _append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.folder}/{name}")

    def update(self, texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what `texts` (path, text) holds in pairs not scanned before, and store it. Returns the
        stored history of `texts` itself, one row for each of its rows."""
        history = cut(texts.select("path", address(F.col("text")).alias("blob")))
        known = self.read("history").select(F.col("path").alias("_path"), F.col("blob").alias("_blob"))
        new = history.distinct().join(known, F.col("path").eqNullSafe(F.col("_path")) & (F.col("blob") == F.col("_blob")), "left_anti")
        pairs = cut(unseen(history, self.read("pairs"), rules))
        self._append("history", new)
        self._append("findings", scan_unseen(texts, pairs, rules).select("blob", "kind", "rule_version", "start", "end"))
        self._append("pairs", pairs.select("blob", "kind", "rule_version"))
        return history

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """All stored findings of the current version of each rule, of this and of earlier runs."""
        current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version")) for r in rules])
        return self.read("findings").where(F.array_contains(current, F.struct("kind", "rule_version")))

    def report(self, history: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Findings of all stored paths and versions, or of a given history."""
        return report(self.read("history") if history is None else history, self.findings(rules), rules)

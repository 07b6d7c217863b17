import datetime as dt
import itertools
import random

from conftest import column, frame
from pyspark.sql import functions as F

from shelfmark.operators import checks, salting
from shelfmark.operators.checks import accepted, holds, not_null, run_checks, unique
from shelfmark.operators.dedupe import keep_latest
from shelfmark.operators.existence import flag_existing
from shelfmark.operators.history import PERIOD, merge_versions, version_history
from shelfmark.operators.overlap import count_overlapping_pairs, overlap_degree
from shelfmark.operators.quality import Rule, apply_rules, score
from shelfmark.operators.surrogate import dense_key, hash_key, lasting_key, level_key

D = dt.date


def test_keep_latest_ties_and_nulls(spark):
    df = frame(
        spark, "k string, ts int, id int",
        ("a", 1, 1), ("a", 1, 2), ("a", None, 9), ("b", None, 3), (None, 5, 4), (None, 6, 5),
    )
    got = {r["k"]: r["id"] for r in keep_latest(df, ["k"], ["ts", "id"]).collect()}
    assert got == {"a": 2, "b": 3, None: 5}


def test_flag_existing(spark):
    df = frame(spark, "id int, k string", (1, "a"), (2, "x"), (3, None), (4, "a"))
    reference = frame(spark, "key string", ("a",), ("a",), (None,), ("b",))
    for is_unique, ref in ((False, reference), (True, reference.distinct())):
        got = flag_existing(df, "k", ref, "hit", "key", reference_is_unique=is_unique)
        assert got.columns == ["id", "k", "hit"]
        assert {r["id"]: r["hit"] for r in got.collect()} == {1: 1, 2: 0, 3: 0, 4: 1}
    passed = flag_existing(df, "k", reference, "hit", "key", null_passes=True)
    assert {r["id"]: r["hit"] for r in passed.collect()}[3] == 1


def test_rules(spark):
    quality = [Rule("A", "x > 0", 60, gate=True), Rule("B", "y IS NOT NULL", 40), Rule("C", "x > 5 OR y = 1", gate=True)]
    df = apply_rules(frame(spark, "x int, y int", (6, None), (1, 1), (None, 1), (1, 2)), quality)
    got = [tuple(r) for r in df.select("A", "B", "C", "DQ_Is_Valid", score(quality)).collect()]
    assert got == [(1, 0, 1, 1, 60), (1, 1, 1, 1, 100), (0, 1, 1, 0, 40), (1, 1, 0, 0, 100)]


def _ranges(n, items, seed):
    rng = random.Random(seed)
    first = dt.date(2024, 1, 1)
    for i in range(n):
        start = first + dt.timedelta(days=rng.randrange(60))
        # a third of all rows belongs to one group
        group = "hot" if rng.random() < 0.34 else f"g{rng.randrange(5)}"
        yield (i, f"p{rng.randrange(items)}", group, start, start + dt.timedelta(days=rng.randrange(12)))


def _meet(a, b):
    return a[3] <= b[4] and b[3] <= a[4]


def test_overlap_counts_match_brute_force(spark):
    for seed in range(3):
        rows = list(_ranges(150, 60, seed))
        df = frame(spark, "i int, item string, g string, a date, z date", *rows)
        pairs = sum(_meet(x, y) for x, y in itertools.combinations(rows, 2) if x[1] != y[1])
        assert column(count_overlapping_pairs(df, "item", "a", "z")) == [pairs]
        degree = {r["i"]: r["n"] for r in overlap_degree(df, ["g"], "a", "z", "n").collect()}
        for x in rows:
            assert degree[x[0]] == sum(_meet(x, y) for y in rows if y[0] != x[0] and y[2] == x[2])


def test_overlap_of_nothing(spark):
    empty = frame(spark, "item string, a date, z date", ("p", dt.date(2024, 1, 1), dt.date(2024, 1, 2))).filter("item = 'q'")
    assert column(count_overlapping_pairs(empty, "item", "a", "z")) == [0]


def test_dense_key_is_dense_and_stable(spark):
    df = spark.range(1000).select(F.concat(F.lit("C"), F.col("id")).alias("k"))
    keyed = {r["k"]: r["n"] for r in dense_key(df, "n", ["k"], hex_digits=1).collect()}
    assert sorted(keyed.values()) == list(range(1, 1001))
    again = {r["k"]: r["n"] for r in dense_key(df.repartition(7), "n", ["k"], hex_digits=1).collect()}
    assert again == keyed
    assert df.select(hash_key("k")).distinct().count() == 1000


def test_version_history(spark):
    d = lambda day: dt.date(2024, 1, day)
    df = frame(
        spark, "k string, d date, price int, cost int, ts int",
        ("a", d(1), 10, None, 1), ("a", d(3), 10, None, 1), ("a", d(5), 12, None, 1), ("a", d(5), 13, 7, 2), ("a", d(9), 10, None, 1),
        ("b", d(2), 5, 1, 1),
    )
    got = version_history(df, "k", "d", ["price", "cost"], ["ts"]).orderBy("k", "Effective_From")
    assert [tuple(r) for r in got.select("k", "price", "cost", "Effective_From", "Effective_To", "Is_Current", "Version_Number").collect()] == [
        ("a", 10, None, d(1), d(4), 0, 1),
        ("a", 13, 7, d(5), d(8), 0, 2),
        ("a", 10, None, d(9), None, 1, 3),
        ("b", 5, 1, d(2), None, 1, 1),
    ]


def test_checks(spark):
    df = frame(spark, "k string, v int, cur int", ("a", 1, 1), ("a", -1, 0), (None, None, 1), ("b", 3, 1), ("b", 3, 1))
    report = run_checks(
        df, "t", [*not_null("k", "v"), accepted("v", [1, 3]), holds("v > 0"), unique("k"), unique("k", only_if="cur = 1")]
    )
    assert {r["Check_Name"]: r["Failures"] for r in report.collect()} == {
        "not_null(k)": 1, "not_null(v)": 1, "accepted_values(v)": 1, "expression_is_true(v > 0)": 1,
        "unique(k)": 2, "unique(k where cur = 1)": 1,
    }


def test_hot_keys_alone_are_copied(spark):
    rows = [("hot",)] * 1000 + [("warm",)] * 150 + [(f"k{i}",) for i in range(300)] + [(None,)] * 2000
    df = frame(spark, "key string", *rows).withColumn("n", F.monotonically_increasing_id())
    lookup = frame(spark, "ref string, value int", ("hot", 1), ("warm", 2), *[(f"k{i}", 3) for i in range(500)])
    hot = salting.hot_keys(df, ["key"], hot_rows=100)
    assert {tuple(r) for r in hot.collect()} == {("hot", 10), ("warm", 2)}
    # 502 rows, nine more copies of one and one more of the other, whatever the number of partitions
    for partitions in ("4", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert salting.copied_lookup(lookup, ["ref"], hot).count() == 512
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    # the number of spread keys is bounded, the hottest first
    assert [r["key"] for r in salting.hot_keys(df, ["key"], hot_rows=100, most=1).collect()] == ["hot"]
    for how in ("inner", "left"):
        got = salting.salted_join(df, lookup, [("key", "ref")], how, hot_rows=100)
        want = df.join(lookup, df["key"] == lookup["ref"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    tasks = salting._salted(df, ["key"], hot).withColumn("salt", salting.row_bucket(df, F.col("__salts")))
    assert tasks.where("key = 'hot'").select("salt").distinct().count() == 10


def history_rows(df):
    columns = ("k", "price", "Effective_From", "Effective_To", "Is_Current", "Version_Number")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_loads_merged_one_by_one_give_the_whole_history(spark):
    rng = random.Random(5)
    schema = "k string, price int, day date, Raw_ID int, ok int"
    how = ("k", "day", ["price"], ["Raw_ID"])
    loads, n = [], 0
    for load in range(6):
        rows = []
        for k in range(25):
            for _ in range(rng.choice([0, 0, 1, 1, 3])):
                n += 1
                day = D(2024, 1, 1) + dt.timedelta(days=load * 5 + rng.randint(0, 5))
                rows.append((f"k{k}", rng.choice([1, 2, None]), day, n, rng.choice([1, 1, 1, 0])))
        loads.append(rows)
    stored = frame(spark, f"{schema}", *loads[0])
    stored = version_history(stored, *how, F.col("ok")).select("k", "price", *PERIOD)
    for i, rows in enumerate(loads[1:], 2):
        stored = spark.createDataFrame(merge_versions(stored, frame(spark, schema, *rows), *how, F.col("ok")).collect(), stored.schema)
        whole = frame(spark, schema, *[r for load in loads[:i] for r in load])
        assert history_rows(stored) == history_rows(version_history(whole, *how, F.col("ok")))
    # earlier than the open version: closed periods stay
    late = merge_versions(stored, frame(spark, schema, ("k1", 9, D(2023, 1, 1), n + 1, 1)), *how, F.col("ok"))
    assert history_rows(late) == history_rows(stored)
    assert history_rows(merge_versions(stored, frame(spark, schema), *how, F.col("ok"))) == history_rows(stored)


def test_keys_last(spark):
    first = frame(spark, "a string, b int", *[(f"x{i}", i % 3) for i in range(50)], ("x1", 1), (None, 1))
    known = lasting_key(first, "Key", ["a", "b"], None)
    before = {(r["a"], r["b"]): r["Key"] for r in known.collect()}
    assert sorted(before.values()) == list(range(1, 51))
    second = frame(spark, "a string, b int", *[(f"x{i}", i % 3) for i in range(20, 90)])
    known = spark.createDataFrame(known.collect(), known.schema)
    after = {(r["a"], r["b"]): r["Key"] for r in lasting_key(second, "Key", ["a", "b"], known).collect()}
    assert {k: after[k] for k in before} == before and sorted(after.values()) == list(range(1, 91))
    assert lasting_key(second.limit(0), "Key", ["a", "b"], known).count() == 50
    assert sorted(r["Key"] for r in lasting_key(second, "Key", ["a", "b"], known.limit(0)).collect()) == list(range(1, 71))


def test_violations_name_every_rule(spark):
    rules = [*checks.not_null("a"), checks.holds("b > 0"), checks.unique("k"), checks.unique("b", only_if="a = 'u'")]
    rows = [(1, "x", 1, "x"), (1, "x", 2, "x"), (1, None, 3, "x"), (2, None, -1, None), (None, "u", 5, "u"), (None, "u", 5, "u"), (3, "u", 0, "u"), (4, "u", None, "u")]
    df = frame(spark, "k int, a string, b int, row string", *rows).withColumn("n", F.monotonically_increasing_id())
    marked = checks.violations(df, rules, ["n"]).orderBy("n").collect()
    assert [r[checks.VIOLATED] for r in marked] == [
        [], ["unique(k)"], ["not_null(a)"], ["not_null(a)", "expression_is_true(b > 0)"], [], ["unique(b where a = 'u')"], ["expression_is_true(b > 0)"], [],
    ]
    both = checks.violations(df, rules, ["n"])
    assert checks.accepted_rows(both).columns == df.columns
    assert checks.accepted_rows(both).count() + checks.rejected_rows(both).count() == len(rows)
    assert checks.accepted_rows(checks.violations(df, [], ["n"])).count() == len(rows)


def test_level_keys_tell_missing_columns_apart(spark):
    df = frame(spark, "a string, b string", ("x", None), (None, "x"), ("x", "x"), (None, None))
    assert df.select(level_key("a", "b")).distinct().count() == 4


def test_large_lookups_are_not_broadcast_where_no_key_is_hot(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    df = other.range(20_000).select((F.col("id") % 15_000).alias("key"), "id").unionByName(other.range(1).select(F.lit(None).cast("long").alias("key"), "id"))
    lookup = other.range(20_000).groupBy(F.col("id").alias("ref")).agg(F.max("id").alias("value"))
    met = salting.salted_join(df, lookup, [("key", "ref")], "left")
    found = met.collect()
    assert len(found) == 20_001 and all(r["value"] == r["key"] for r in found)
    final = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in final

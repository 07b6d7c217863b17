"""Vector duplicates, whitening and lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import lexical, vectors, whitening

from .conftest import ODD

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id bigint, embedding array<double>, label int, row int, node string, links string, x binary, code int"


def table(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(*r, 1, "n", "l", b"x", 2) for r in rows], schema)


# --- near-duplicates of vectors ---


def brute_links(rows, threshold):
    """n_links and component by comparing all rows."""
    usable = [
        v is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]

    def linked(i, j):
        a, b = rows[i], rows[j]
        if not (usable[i] and usable[j]) or a[2] != b[2] or len(a[1]) != len(b[1]):
            return False
        x, y = np.array(a[1]) / max(map(abs, a[1])), np.array(b[1]) / max(map(abs, b[1]))
        return float(x @ y / math.sqrt(x @ x) / math.sqrt(y @ y)) >= threshold

    n = len(rows)
    near = [[j for j in range(n) if j != i and linked(i, j)] for i in range(n)]
    result = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        result.append((rows[i][0], len(near[i]), low, rows[i][0] == low))
    return result


def clustered(seed, n, dimensions=16):
    """Vectors in clusters of every tightness, around the threshold too."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            base = np.array(rows[rng.integers(len(rows))][1])
            vector = base + rng.standard_normal(dimensions) * rng.choice([0.0, 0.02, 0.08, 0.11])
        else:
            vector = rng.standard_normal(dimensions) / 4
        rows.append((i * 5 % n if n % 5 else i, (vector * rng.choice([1, 3])).tolist(), int(rng.integers(3))))
    return rows


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize(("bucket", "chunk"), [(512, 1024), (2, 4)])
def test_links_of_vectors(spark, bucket, chunk):
    rows = clustered(bucket, 241)
    got = vectors.near_duplicates(table(spark, rows), threshold=0.93, miss=1e-9, bucket=bucket, chunk=chunk, together=8)
    assert got.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    assert ordered(map(tuple, got.collect())) == ordered(brute_links(rows, 0.93))


def test_odd_vectors(spark):
    one = [0.5, 0.25, 0.0, -1.0]
    rows = [
        (1, one, 1), (1, one, 1), (2, [2 * x for x in one], 1), (3, [-0.0 if x == 0 else x for x in one], 1), (4, one, 2), (5, one, None),
        (None, one, 1), (6, None, 1), (7, [], 1), (8, [0.0] * 4, 1), (9, [0.5, None, 0.0, -1.0], 1), (10, [NAN, 1.0, 1.0, 1.0], 1),
        (11, [INF, 1.0, 1.0, 1.0], 1), (12, one[:3], 1), (13, [1e-320, 0.0, 0.0, 0.0], 1), (14, [1e300, 0.0, 0.0, 0.0], 1),
        (None, [0.0, 7.0, 0.0, 0.0], 1), (15, [1.0], 3), (16, [9.0], 3), (17, [-1.0], 3),
    ]
    got = ordered(map(tuple, vectors.near_duplicates(table(spark, rows)).collect()))
    assert got == ordered([(a, n, low, kept if a is not None or low is not None else True) for a, n, low, kept in brute_links(rows, 0.93)])
    assert vectors.near_duplicates(table(spark, [])).count() == 0
    text = table(spark, [(1, one, "a"), (2, one, "a"), (3, one, "b")], VECTORS.replace("label int", "label string").replace("<double>", "<float>"))
    assert ordered(map(tuple, vectors.near_duplicates(text).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_crowded_buckets_by_shuffle(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (np.ones(8) + rng.standard_normal(8) / 50).tolist(), 1) for i in range(90)]
    data, kind = vectors.usable(table(spark, rows))
    nodes = data.select(data["row"].alias("node"), "label", "length", "vec").selectExpr("*", "1L AS size")
    schema = "node bigint, label bigint, length int, vec binary, size bigint, codes binary"
    coded = nodes.mapInArrow(lambda b: vectors._code_batches(b, kind, 4, 6, 1), schema)
    for most in (1000, 0):
        found = vectors.table_links(coded, 0, 6, kind, 0.93, 8, broadcast_rows=most)
        counts = {r[0]: r[1] for r in found.groupBy("node").sum("links").collect()}
        assert counts == {r["row"]: 89 for r in data.collect()}


def test_planned_tables():
    for largest in (1, 500, 10**6, 10**9):
        bits, tables = vectors.plan_tables(largest)
        assert largest / 2**bits <= vectors.BUCKET
        assert (1 - vectors.agreement(0.93) ** bits) ** tables <= vectors.MISS
    assert vectors.plan_tables(10**6)[0] > vectors.plan_tables(500)[0]


# --- whitening ---


def brute_white(rows, most):
    usable = [(i, v) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in usable]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    differences = [[n * a - s for a, s in zip(r, sums)] for r in x]
    centred = np.array(differences, float) / n
    covariance = centred.T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:most], basis[:, ::-1][:, :most]
    keep = values > 1e-10 * values[0]
    white = centred @ basis[:, keep] / np.sqrt(values[keep])
    return [i for i, _ in usable], [sum(d * d for d in r) for r in differences], white, values[keep] / np.trace(covariance)


def check_white(spark, rows, most, **settings):
    got = whitening.whiten(table(spark, rows), components=most, **settings).collect()
    ids, deviation, white, explained = brute_white(rows, most)
    assert len(got) == white.size
    assert all(r["n"] == len(ids) and r["identity_error"] <= 1e-9 for r in got)
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
    for c in range(white.shape[1]):
        mine = np.array([by_row[key][c + 1].pop(0) for key in zip(ids, deviation)])
        assert min(np.abs(mine - white[:, c]).max(), np.abs(mine + white[:, c]).max()) < 1e-8


@pytest.mark.parametrize(("dimensions", "most", "guard"), [(24, 5, 3), (40, 32, 4), (6, 32, 16)])
def test_whitening(spark, dimensions, most, guard):
    rng = np.random.default_rng(dimensions)
    mixed = rng.standard_normal((400, dimensions)) * np.linspace(1, 3, dimensions) @ np.linalg.qr(rng.standard_normal((dimensions,) * 2))[0]
    check_white(spark, [(i, v.tolist(), 1) for i, v in enumerate(mixed)], most, guard=guard)


def test_odd_whitening(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), None) for i, v in enumerate(rng.standard_normal((30, 3)))]
    odd = [(None, [1.0, 2.0, 3.0], 1), (4, [1.0, 2.0, 3.0], 1), (40, None, 1), (41, [], 1), (42, [1.0, None, 2.0], 1), (43, [NAN, 1.0, 2.0], 1),
           (44, [INF, 1.0, 2.0], 1)]
    check_white(spark, rows + odd, 32)
    # a dimension without spread has no component of its own
    check_white(spark, [(i, [*v[:2], 5.0], 1) for i, v, _ in rows], 32)
    # lengths other than the most frequent one are dropped
    assert {r["vec_id"] for r in whitening.whiten(table(spark, [*rows, (99, [1.0, 2.0], 1)])).collect()} == set(range(30))
    for none in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(i, [1.0, 2.0], 1) for i in range(5)]):
        assert whitening.whiten(table(spark, none)).count() == 0
    # too large for a long: exact until then, null beyond
    large = [(i, [1e15 * (i + 1), float(i * i)], 1) for i in range(3)] + [(3, [1e300, 0.0], 1), (4, [-1e300, 0.0], 1)]
    got = whitening.whiten(table(spark, large)).collect()
    assert got and all(r["deviation"] is None and r["identity_error"] < 1e-4 for r in got)


def test_filter_damps_the_unwanted_spectrum():
    values = np.linspace(1, 10, 100)
    block = np.ones((100, 1))

    def times(q):
        return values[:, None] * q

    filtered = np.abs(whitening.chebyshev(times, block, times(block), 20, 1.0, 8.0, 10.0)[:, 0])
    assert filtered[values <= 8].max() < 1e-6 * filtered[-1]
    low = whitening.lower_end(times, 100, 12, np.random.default_rng(0))
    assert 0 <= low <= 1.0
    found, basis = whitening.leading_eigenvectors(times, 100, 4, guard=2)
    assert np.allclose(found, values[::-1][:4], rtol=1e-12) and np.allclose(np.abs(basis).max(axis=0), 1, atol=1e-9)


# --- lexical search ---


def brute_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute_rank(documents, items, top):
    texts = [(d, Counter(brute_terms(t))) for d, t in documents]
    counted = [sum(c.values()) for _, c in texts]
    total, length = sum(n > 0 for n in counted), sum(counted)
    frequency = Counter(t for _, c in texts for t in c)
    result = []
    for item, text in items:
        scored = []
        for (d, counts), n in zip(texts, counted):
            score = 0
            for term in brute_terms(text):
                if tf := counts[term]:
                    weight = math.floor(1000 * math.log((2 * total + 2) / (2 * frequency[term] + 1)))
                    m = 100 - 25 + (25 * n * total) // length
                    score += weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d, score))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        result += [(item, i + 1, d, score) for i, (_, _, d, score) in enumerate(scored[:top])]
    return result


def by_value(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize(("shard", "group", "block", "owners", "top"), [(4096, 256, 4096, 4, 20), (7, 3, 5, 3, 4), (5, 2, 4, 1, 2), (16, 1, 2, 6, 100)])
def test_ranked_search(spark, documents, shard, group, block, owners, top):
    rng = random.Random(shard)
    words = [f"w{i}" for i in range(60)] + ["Über", "日本", "x9", "THE"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(n):
        return rng.choice([" ", ", ", "-", "\n"]).join(rng.choices(words, weights, k=n))

    rows = [(i, text(rng.randint(0, 40)) if i % 9 else rng.choice([None, "", " .. ", "w1 w1 w1"])) for i in range(100)]
    rows += [(1000 + i, "w3 w4 the") for i in range(10)]
    items = [(i, text(rng.randint(0, 12))) for i in range(11)] + [(50, None), (51, "unseen words only"), (52, "the THE the")]
    asked = spark.createDataFrame([(*r, 5) for r in items], "item_id bigint, text string, rank int")
    settings = {"shard": shard, "group": group, "block": block, "owners": owners}
    got = lexical.rank(documents(rows).repartition(3), asked, top=top, **settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert by_value(got.collect()) == by_value(brute_rank(rows, items, top))


def test_odd_search(spark, odd, documents):
    items = [(None, "text without an id"), (1, "same words"), (1, "another text naïve 日本語"), (2, ""), (None, None)]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert by_value(lexical.rank(odd, asked).collect()) == by_value(brute_rank(ODD, items, 20))
    assert lexical.rank(documents([]), asked).count() == 0
    assert lexical.rank(odd, asked.limit(0)).count() == 0
    assert lexical.rank(documents([(1, None), (2, "..")]), asked).count() == 0


def test_terms_of_a_long_text():
    text = "Ab,cd " * 300_000 + "é" * 9_000_000 + " Ab"
    found = lexical.term_counts(text)
    assert found == {b"ab": 300_001, b"cd": 300_000, ("é" * 9_000_000).encode(): 1}


def test_owners_take_terms_by_frequency():
    frequency = {t: 1 + 1000 // (t + 1) for t in range(200)}
    bands = lexical.owner_bands(frequency, 4)
    assert set(bands.values()) == {0, 1, 2, 3}
    for a in range(199):
        assert bands[a] >= bands[a + 1]  # rarer terms never have a later owner

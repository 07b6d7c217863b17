"""SimHash, winnowing, suffix dedup and line templates against brute force."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import frames, simhash, suffixes, templates, winnow
from shelfmark.llm.components import components

from .conftest import LONG, ODD


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(seed, n):
    """Texts with copies, near copies, shared passages and repeated lines."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "du", "Ke", "lo", "mé") for b in ("ra", "ti", "po", "nu", "xi", "")]
    passage = " ".join(rng.choices(words, k=40))
    rows, texts = [], []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            text = rng.choice(texts)
        elif texts and kind < 0.4:
            part = rng.choice(texts).split(" ")
            part[rng.randrange(len(part))] = rng.choice(words)
            text = " ".join(part)
        else:
            lines = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(rng.randint(1, 8))]
            if kind > 0.8:
                lines.insert(rng.randrange(len(lines) + 1), passage)
            if kind > 0.9:
                lines.append(f"This was posted on {rng.randint(1, 30)} by user{rng.randint(1, 99)} in all things here")
            text = "\n".join(lines)
        texts.append(text)
        rows.append((i * 3, text))
    return rows


# --- simhash ---


def brute_print(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_near_duplicates(documents, parts):
    rows = corpus(parts, 120)
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(rows), shingle=4, distance=4, parts=parts).collect()}
    prints = [brute_print(t) for _, t in rows]
    assert [got[d].print & (1 << 64) - 1 for d, _ in rows] == prints
    assert [got[d].component_id for d, _ in rows] == [rows[i][0] for i in brute_components(prints, 4)]


def test_planted_distances_and_chains(spark):
    """Fingerprints at known distances, a chain, and a dense group that needs several chunks."""
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre}
    for _ in range(300):
        prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)))
    chain = int(rng.integers(0, 1 << 62))
    for step in range(6):
        prints.add(chain)
        chain ^= sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 200)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print bigint")
    groups = [list(range(0, 64, 2)), list(range(1, 64, 2))]
    links = simhash.part_links(frame, groups[0], 2, 4, chunk=16).unionByName(simhash.part_links(frame, groups[1], 1, 4, chunk=16))
    roots = {r.node: r.root for r in components(links).collect()}
    want = brute_components(prints, 4)
    classes = {}
    for p, w in zip(signed, want):
        classes.setdefault(w, set()).add(roots.get(p, p))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_thresholds():
    works = [[0, 1, 10, 100, 1000, 9999], [0, 5, 6, 7, 8, 90]]
    assert simhash.allocate(works, 3) == [0, 3]
    rng = np.random.default_rng(0)
    together = rng.random((64, 64))
    groups = simhash.partition_bits((together + together.T) / 2 * 50, 100, 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and {len(g) for g in groups} == {21, 22}


def test_long_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(200))


def test_simhash_odd_rows(odd, documents):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    empty = [r for r in got if r.print == 0]
    assert len(empty) == 4 and {r.component_id for r in empty} == {1}
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    assert documents([]).transform(simhash.near_duplicates).count() == 0


# --- winnowing ---


def brute_hits(rows, items, span=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    windows = {}
    for i, t in items:
        w = words(t)
        n = min(span, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s : s + n]), set()).add(str(i))
    found = []
    for d, t in rows:
        w, hit, ids = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    ids |= windows[tuple(w[s : s + n])]
        found.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(found, key=str)


@pytest.mark.parametrize("rows_at_most", [500_000, 0])
def test_decontaminate(spark, documents, rows_at_most):
    rows = corpus(7, 60) + [(1000, "x y Z"), (1001, "one two"), (1002, LONG)]
    long_item = " ".join(LONG.split()[500:530])
    part = " ".join(rows[10][1].split()[:14])
    items = [(1, part), (2, long_item), (3, "two"), (4, "Y, z!"), (5, ""), (6, None), (10, part), (11, "solo absent words")]
    benchmark = spark.createDataFrame([(*i, "q") for i in items], "item_id bigint, text string, words string")
    got = winnow.digest(winnow.decontaminate(documents(rows), benchmark, broadcast_rows=rows_at_most)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_hits(rows, items)


def test_decontaminate_odd_rows(spark, odd, documents):
    benchmark = spark.createDataFrame([(1, ODD[4][1])], "item_id bigint, text string")
    got = winnow.digest(winnow.decontaminate(odd, benchmark)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute_hits(ODD, [(1, ODD[4][1])])
    kept = winnow.keep_clean(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert winnow.decontaminate(odd, nothing).where("n_hit > 0").count() == 0
    assert winnow.decontaminate(documents([]), benchmark).count() == 0


def test_winnowing_runs_no_python(spark, documents):
    benchmark = spark.createDataFrame([(1, ODD[4][1])], "item_id bigint, text string")
    plan = winnow.decontaminate(documents(ODD).select("doc_id", "text"), benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


# --- suffixes ---


def brute_repeats(rows, length=100):
    # texts of one id are ordered by the signed hash that Spark gives them
    keyed = sorted({(d is None, d or 0, np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).astype(np.int64), t or "") for d, t in rows})
    seen, result = set(), {}
    for null, d, _, t in keyed:
        b = t.encode()
        gone = bytearray(len(b))
        new = set()
        for p in range(len(b) - length + 1):
            k = b[p : p + length]
            if k in seen or k in new:
                gone[p : p + length] = b"\1" * length
            new.add(k)
        seen |= new
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        result[(None if null else d, t)] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted([(d, *result[(d, t or "")]) for d, t in rows], key=str)


def test_remove_repeats(documents):
    rows = corpus(11, 80)
    rows += [(900, "ab" * 400), (901, "x" * 350 + rows[3][1] + "x" * 120), (902, (rows[5][1] + "|") * 3), (903, "é" * 120), (904, "aé" * 90)]
    got = sorted([tuple(r) for r in suffixes.remove_repeats(documents(rows)).collect()], key=str)
    assert got == brute_repeats(rows)


def test_remove_repeats_over_small_slices(documents, monkeypatch):
    """What one task settles alone must not change the result."""
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 2_000)
    rows = corpus(13, 60) + [(800 + i, "z" * 130 + "q" * i) for i in range(12)]
    got = sorted([tuple(r) for r in suffixes.remove_repeats(documents(rows)).collect()], key=str)
    assert got == brute_repeats(rows)


def test_hot_buckets_get_a_few_rows_from_a_task(documents, monkeypatch):
    """A passage in every text, with equal and with different bytes around it, over many slices of a task."""
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 3_000)
    rng = random.Random(8)
    passage = " ".join(rng.choices(["some", "words", "that", "come", "again", "and", "on"], k=60))
    rows = [(i, f"{rng.random()} {rng.random()}" * rng.randint(0, 3) + passage + f"{rng.random()}" * rng.randint(0, 2)) for i in range(150)]
    rng.shuffle(rows)
    texts = documents(rows).coalesce(1).selectExpr("doc_id AS doc", "xxhash64(text) AS text_hash", "text")
    runs = texts.mapInArrow(suffixes._run_batches, suffixes.SCHEMA)
    hottest = runs.where("kind < 2").groupBy("bucket").count().agg({"count": "max"}).first()[0]
    assert hottest <= 15
    got = sorted([tuple(r) for r in suffixes.remove_repeats(documents(rows)).collect()], key=str)
    assert got == brute_repeats(rows)
    # entries that are fought over
    monkeypatch.setattr(suffixes.Sent.__init__, "__defaults__", (2,))
    got = sorted([tuple(r) for r in suffixes.remove_repeats(documents(rows)).collect()], key=str)
    assert got == brute_repeats(rows)


def test_remove_repeats_odd_rows(documents):
    rows = [(None, None), (1, None), (2, ""), (4, LONG[:5000]), (4, LONG[:5000]), (5, LONG[:3000]), (None, LONG[1000:4000])]
    got = sorted([tuple(r) for r in suffixes.remove_repeats(documents(rows)).collect()], key=str)
    assert got == brute_repeats(rows)
    assert suffixes.remove_repeats(documents([])).count() == 0


def test_texts_of_one_id_whose_hashes_agree(documents):
    """Hashes that agree in their last 16 bits, once under one id and once without any."""
    by_end = {}
    for i in range(3000):
        text = " ".join(f"{(i * 7919 + j) % 10007}" for j in range(20 + i % 60))
        by_end.setdefault(xxhash.xxh64_intdigest(text.encode(), 42) & 0xFFFF, []).append(text)
    pairs = [texts for texts in by_end.values() if len(texts) > 1][:6]
    passage = "a passage that stands in every one of these texts and is longer than a hundred bytes, so that it goes " * 2
    rows = [(None if k % 2 else 5, t) for k, texts in enumerate(pairs) for t in texts]
    rows += [(3, passage), (None, passage + "z"), (5, "y" + passage), (5, passage), (None, "x" + passage + "x"), (9, rows[0][1]), (9, rows[0][1])]
    got = sorted([tuple(r) for r in suffixes.remove_repeats(documents(rows)).collect()], key=str)
    assert got == brute_repeats(rows)


# --- templates ---


def brute_lines(rows):
    keyed = sorted({(d is None, d or 0, t or "") for d, t in rows})
    leaves, drop = {}, {}
    for key in keyed:
        for i, line in enumerate(key[2].split("\n")):
            found = templates.tokens(line)
            if len(found) >= templates.TOKENS:
                leaves.setdefault((len(found), *found[: templates.DEPTH]), []).append((key, i, found))
    for lines in leaves.values():
        holders = {}
        for key, _, found in lines:
            for p, t in enumerate(found):
                holders.setdefault((p, t), set()).add((key, tuple(found)))
        kinds = {}
        for key, i, found in lines:
            shape = tuple(t if len(holders[p, t]) >= templates.RECURS else None for p, t in enumerate(found))
            if sum(t is not None for t in shape) >= templates.CONSTANT * len(shape):
                kinds.setdefault(shape, []).append((key, i))
        for held in kinds.values():
            if len({k for k, _ in held}) >= templates.RECURS:
                for key, i in sorted(held)[1:]:
                    drop.setdefault(key, set()).add(i)
    result = []
    for d, t in rows:
        gone = drop.get((d is None, d or 0, t or ""), set())
        left = "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone)
        result.append((d, (t or "").count("\n") + bool(t), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(result, key=str)


def test_line_templates(documents):
    rows = corpus(17, 150)
    got = sorted([tuple(r) for r in templates.report(documents(rows)).collect()], key=str)
    assert got == brute_lines(rows)
    assert sum(r[2] for r in got) > 10


def test_first_line_of_a_template_stays(documents):
    rows = [(i, f"own text {'abcdef'[i]} of it\nWe posted this on {i} May by user{i} in all things") for i in range(5, 0, -1)]
    docs = templates.drop_lines(documents(rows))
    assert {r.doc_id: "posted" in r.text for r in docs.collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_line_templates_odd_rows(documents, odd):
    got = sorted([tuple(r) for r in templates.report(odd).collect()], key=str)
    assert got == brute_lines(ODD)
    kept = templates.drop_lines(odd)
    assert kept.schema == odd.schema
    assert templates.report(documents([])).count() == 0


def test_short_lines_and_lines_without_spaces_recur(documents):
    notice = "本网站所有内容均受版权保护未经许可不得转载"
    rows = [(i, f"All rights reserved.\n\nown text {'abcde'[i]} of this one\n{notice}") for i in range(5)]
    left = {r.doc_id: r.text for r in templates.drop_lines(documents(rows)).collect()}
    assert left[0] == rows[0][1]
    assert all(left[i] == f"\nown text {'abcde'[i]} of this one" for i in range(1, 5))


def test_equal_long_lines_recur_from_two_documents(documents):
    passage = " ".join(f"{a}{b}" for a in "bdfgk" for b in ("ra", "ti", "po", "nu", "xi"))
    unspaced = "".join(chr(0x4E00 + i) for i in range(120))
    brief = "a line of words that is not long"
    rows = [(i, f"{'ab'[i]} own start of it\n{passage}\n{brief}\n{unspaced}") for i in range(2)]
    left = {r.doc_id: r.text for r in templates.drop_lines(documents(rows), long_recurs=templates.LONG_RECURS).collect()}
    assert left == {0: rows[0][1], 1: f"b own start of it\n{brief}"}


def test_rows_of_values_are_not_one_template(documents):
    rows = [(i, f"own words of {'abcde'[i]} here\n{i} 5 7 9 3{i}\nTotal 20{i} 2020 2021 20{i}2\n1 2 3 4 5") for i in range(5)]
    rows += [(10 + i, f"{i}1 {i}2 {i}3 {i}4 {i}5") for i in range(3)]  # nothing but values
    left = {r.doc_id: r.text for r in templates.drop_lines(documents(rows)).collect()}
    assert left[0] == rows[0][1] and all(left[d] == t for d, t in rows[5:])
    # the row that is equal in all of them keeps its first copy
    assert all(left[d] == t.removesuffix("\n1 2 3 4 5") for d, t in rows[1:5])


def test_a_cut_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    rows = spark.range(10_000).select(F.xxhash64("id").alias("key"), "id").groupBy("key").agg(F.max("id").alias("id"))
    before, setting = shuffled(), spark.conf.get(frames.CLEAN_UP, "false")
    stored = frames.cut(rows)
    # executors delete them shortly after the job
    for _ in range(100):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(frames.CLEAN_UP, "false") == setting
    assert stored.count() == rows.count() == 10_000
    assert stored.columns == rows.columns

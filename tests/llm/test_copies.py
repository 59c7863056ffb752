"""Stages decide by row: near copies at 0.8 and more, repeated, null and shared ids, against brute force."""

from __future__ import annotations

import random

import corpus_pipeline
from keelson.llm import work

DATA = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"
STEPS = dict(corpus_pipeline.STAGES)


def grams(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def brute_kept(rows, least=0.8):
    """The kept places of (doc_id, text): the smallest id of each component, nulls last, then the first."""
    root, sets = list(range(len(rows))), [grams(t) for _, t in rows]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= least:
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append((d is None, d or 0, i))
    return sorted(min(g)[2] for g in groups.values())


def stage(spark, name, rows):
    frame = spark.createDataFrame([(d, t, "en", str(i), 0) for i, (d, t) in enumerate(rows)], DDL).coalesce(1)
    return sorted(int(r["source"]) for r in STEPS[name](spark, frame, DATA).collect())


def test_near_copies_of_documents(spark):
    """On the smallest table; the stage's shingles and the similarity of 0.8 by brute force over all pairs."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    assert stage(spark, "near_duplicates", rows) == brute_kept(rows)


def test_near_copies_from_08_to_095(spark):
    r, rows, seen = random.Random(8), [], set()
    for g in range(12):
        base = [f"g{g}w{i}" for i in range(300)]
        rows.append((1000 - 10 * g, " ".join(base)))
        for edits in (1, 2, 3, 5, 6, 7, 9):
            words = list(base)
            for at in r.sample(range(10, 290, 6), edits):
                words[at] = "other"
            s = jaccard(grams(" ".join(base)), grams(" ".join(words)))
            seen.add(round(s, 2))
            rows.append((g * 10 + edits, " ".join(words)))
    assert {s for s in seen if 0.8 <= s <= 0.85} and {s for s in seen if 0.9 <= s <= 0.97} and {s for s in seen if s < 0.8}
    assert stage(spark, "near_duplicates", rows) == brute_kept(rows)


def test_chain_needs_pairs_beside_the_leaders(spark):
    """Each text of a sliding chain is similar to its neighbours only."""
    words = [f"w{i}" for i in range(1200)]
    rows = [(k, " ".join(words[k * 15 : k * 15 + 200])) for k in range(60)]
    assert stage(spark, "near_duplicates", rows) == [0] == brute_kept(rows)


def test_near_duplicates_by_row(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, a), (None, a), (5, a), (2, b), (5, b), (None, "only one here"), (None, "only one here"), (7, ""), (8, " "), (9, None)]
    assert stage(spark, "near_duplicates", rows) == brute_kept(rows) == [0, 4, 6, 8]
    rows = [(5, a), (2, b), (5, b)]  # 5 goes from b's group and stays in a's
    assert stage(spark, "near_duplicates", rows) == [0, 1]
    assert stage(spark, "near_duplicates", []) == []


def test_language_by_row(spark):
    rows = [(1, "some letters here"), (1, "12 34"), (None, "56"), (None, "more letters here"), (2, None), (1, "some letters here")]
    assert stage(spark, "language", rows) == [0, 3, 5]


def test_decontamination_by_row(spark):
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("length(text) > 60").first()["text"]
    rows = [(1, "clean words"), (1, item), (None, item), (None, "clean too"), (2, item), (1, "clean words")]
    assert stage(spark, "decontamination", rows) == [0, 3, 5]


def test_later_stages_keep_the_rest(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet")
    private = work.pinned(STEPS["pii"](spark, rows, DATA), "t")
    assert private.columns == list(corpus_pipeline.COLUMNS)
    assert STEPS["packing"](spark, private, DATA).select("doc_id").distinct().count() == rows.count()


def test_a_hot_key_is_split_without_losing_links(spark):
    """All rows share one key: split by further minima, and cut into tiles where that doesn't help."""
    import numpy as np

    from keelson.llm import copies

    r = np.random.default_rng(1)
    sets = []
    for _ in range(12):  # families in which each member is like the one before
        own = r.integers(0, 2**63, 200, dtype=np.uint64)
        for _ in range(12):
            own = own.copy()
            own[r.choice(200, 12, replace=False)] = r.integers(0, 2**63, 12, dtype=np.uint64)
            sets.append(np.unique(own))
    sets += [r.integers(0, 2**63, 200, dtype=np.uint64) for _ in range(60)]
    links = {(i, j) for i in range(len(sets)) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}

    def classes(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            ra, rb = root[a], root[b]
            root = [min(ra, rb) if x in (ra, rb) else x for x in root]
        return root

    members = spark.createDataFrame([(7, i, i, bytearray(np.sort(s).tobytes())) for i, s in enumerate(sets)], "key long, row long, root long, hashes binary").repartition(3).cache()
    for most in (1, 1000):
        got = {(max(x["a"], x["b"]), min(x["a"], x["b"])) for x in copies.compare(members, 0.8, 16, 1 << 30, most).collect()}
        assert got <= links and classes(got) == classes(links)
    assert len(set(classes(links))) < len(sets) - 100
    assert copies.split(members).groupBy("key").count().agg({"count": "max"}).first()[0] < len(sets) / 4

"""Near duplicates and decontamination against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from keelson.llm import decontam, queries, simhash

DATA = "/root/testdata/sf0.001"
DDL = "doc_id long, text string"


def brute_fingerprint(text):
    import re

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, radius=3):
    """pairs (doc_id, fp): least id reachable."""
    ids = list(range(len(pairs)))

    def find(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                ids[b] = a
    out = {}
    for i in range(len(pairs)):
        out.setdefault(find(i), []).append(i)
    return {i: min(pairs[k][0] for k in members) for members in out.values() for i in members}


def test_fingerprint_matches_brute_force():
    for text in ["", None, " \n", "One", "Two words", "A b C d e", "É É x y z z z z z", "long " * 5000, "Tab\tand\x0bvt and\x1cfs"]:
        assert simhash.fingerprint(text) == brute_fingerprint(text), text


def test_near_duplicates_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in rows])
    got = {r["doc_id"]: r for r in queries.op9_simhash(spark, DATA).collect()}
    for i, r in enumerate(rows):
        assert got[r["doc_id"]]["component_id"] == want[i] and int(got[r["doc_id"]]["fingerprint"], 16) == brute_fingerprint(r["text"])


@pytest.mark.parametrize(("cap", "size"), [(2048, 400), (32, 400)])
def test_links_in_dense_balls(spark, cap, size):
    """Fingerprints crowded around a few centres: hot keys are split and tiled, and no link is lost."""
    r = random.Random(cap)
    fps = set()
    for _ in range(3):
        centre = r.getrandbits(64)
        for _ in range(size // 4):
            fp = centre
            for _ in range(r.randint(0, 4)):
                fp ^= 1 << r.randrange(64)
            fps.add(fp)
    fps |= {r.getrandbits(64) for _ in range(size // 4)} | {0, 1, 2**64 - 1}
    fps = sorted(fps)
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    roots = {row["node"]: row["root"] for row in simhash.components(simhash.links(frame, cap=cap)).collect()}
    want = brute_components(list(enumerate(fps)))
    groups = {}
    for i, f in enumerate(fps):
        groups.setdefault(want[i], set()).add(roots.get(simhash.signed(f), simhash.signed(f)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_thresholds_cover_the_radius():
    sample = np.random.default_rng(1).integers(0, 2**63, 300, dtype=np.uint64)
    for total in (10, 10**6, 10**10):
        for radius in (1, 2, 3, 5):
            groups = simhash.plan(sample, total, radius)
            assert sum(g.threshold + 1 for g in groups) == radius + 1 and len({b for g in groups for b in g.bits}) == sum(len(g.bits) for g in groups)
    assert {g.threshold for g in simhash.plan(sample, 10**10, 3)} != {g.threshold for g in simhash.plan(sample, 10, 3)}


def test_links_at_threshold_one(spark, monkeypatch):
    groups = [simhash.Group(tuple(range(32)), 1), simhash.Group(tuple(range(32, 64)), 1)]
    monkeypatch.setattr(simhash, "plan", lambda *a: groups)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << x for x in r.sample(range(64), k)) for b in base for k in range(5)})
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    roots = {row["node"]: row["root"] for row in simhash.components(simhash.links(frame)).collect()}
    want = brute_components(list(enumerate(fps)))
    classes = {}
    for i, f in enumerate(fps):
        classes.setdefault(want[i], set()).add(roots.get(simhash.signed(f), simhash.signed(f)))
    assert all(len(c) == 1 for c in classes.values()) and len(classes) == len({next(iter(c)) for c in classes.values()})


def test_odd_documents(spark):
    rows = [(5, None), (4, ""), (3, "  \n"), (2, "a b c d"), (2, "a b c d"), (9, "A B C D"), (None, "a b c d"), (7, "w " * 100_000)]
    docs = spark.createDataFrame(rows, DDL).selectExpr("doc_id", "text", "1 AS component_id", "'x' AS fp")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=str) == sorted([(5, 3), (4, 3), (3, 3), (2, 2), (2, 2), (9, 2), (None, 2), (7, 7)], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


# ---- decontamination -------------------------------------------------------------------------------------------------


def brute_contamination(docs, items, least=0.8, k=5):
    out = {}
    for d, text in docs:
        words = decontam.words_of(text)
        found = set()
        for item, t in items:
            own = decontam.words_of(t)
            if not own:
                continue
            size = min(k, len(own))
            want = Counter(tuple(own[i : i + size]) for i in range(len(own) - size + 1))
            for s in range(max(1, len(words) - len(own) + 1)):
                window = words[s : s + len(own)]
                got = Counter(tuple(window[i : i + size]) for i in range(len(window) - size + 1))
                if got and decontam.similarity(got, want) >= least:
                    found.add(item)
                    break
        out[d] = sorted(found)
    return out


def corpus():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([3, 20, 60])))) for i in range(12)] + [(90, None), (91, ""), (92, "w1 w2 w3 w4")]
    docs = []
    for d in range(60):
        words = [r.choice(vocabulary) for _ in range(r.choice([5, 80, 300]))]
        if d % 2:
            passage = r.choice(items[:12])[1].split()
            for _ in range(d % 4):
                passage[r.randrange(len(passage))] = "other"
            at = r.randrange(len(words))
            words[at:at] = [w.upper() + "," if d % 3 == 0 else w for w in passage]
        docs.append((d, " ".join(words)))
    return docs + [(100, None), (101, ""), (102, items[5][1]), (102, items[5][1])], items


def test_contamination_matches_brute_force(spark):
    docs, items = corpus()
    frame = spark.createDataFrame(docs, DDL).selectExpr("doc_id", "text", "0 AS similarity", "'x' AS item_id")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.contamination(frame, bench).collect()
    assert len(rows) == len(docs)
    want = brute_contamination(docs, items)
    for r in rows:
        assert list(r["item_ids"]) == want[r["doc_id"]] and r["contaminated"] == bool(want[r["doc_id"]])


def test_blocks_agree_and_empty_tables(spark, monkeypatch):
    docs, items = corpus()
    frame, bench = spark.createDataFrame(docs[:62], DDL), spark.createDataFrame(items, "item_id long, text string")
    one = {r["doc_id"]: (list(r["item_ids"]), r["contaminated"]) for r in decontam.contamination(frame, bench).collect()}
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 4)
    many = {r["doc_id"]: (list(r["item_ids"]), r["contaminated"]) for r in decontam.contamination(frame, bench).collect()}
    assert one == many
    monkeypatch.undo()
    assert decontam.contamination(frame, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(frame.limit(0), bench).count() == 0


def test_benchmark_passages_in_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {r["doc_id"]: set(r["item_ids"]) for r in queries.op8_decontamination(spark, DATA).collect()}
    plain = {i: " ".join(decontam.words_of(t)) for i, t in items}
    for d, text in docs:
        words = f" {' '.join(decontam.words_of(text))} "
        assert {i for i, t in plain.items() if f" {t} " in words} <= got[d]


def test_multi_index_finds_all_within_radius():
    r = np.random.default_rng(2)
    items = decontam.Items([(i, " ".join(f"a{i}x{j}" for j in range(10))) for i in range(50)], 5, 20)
    prints = np.concatenate([items.prints ^ np.uint64(sum(1 << int(b) for b in r.choice(64, k, replace=False))) for k in (0, 5, 15, 20, 21)])
    window, item = items.candidates(prints, 10)
    want = {(w, i) for w in range(len(prints)) for i in range(50) if int(prints[w] ^ items.prints[i]).bit_count() <= 20}
    assert set(zip(window.tolist(), item.tolist(), strict=True)) == want

"""Nulls, repeats, clashing columns, very long texts, and how many planted copies of benchmark items are found."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from keelson.llm import binary, chat, decontam, rules, tokens, work


def test_token_files_of_odd_rows(spark):
    """op10: null and repeated ids, null and empty texts, a very long text, and columns named like the files' own."""
    plain = Tokenizer.from_file(tokens.default_path())
    plain.encode_special_tokens = True
    long = "word " * 60_000
    rows = [(3, None, "x", 1), (None, "no id", "x", 1), (1, "one", None, 2), (1, "one", None, 2), (1, "other", "x", None), (2, "", "x", 1), (None, None, "x", 1), (4, long, "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, words string, part int").repartition(3)
    path = binary.write_files(frame, work.new_path(spark, "files"), tokens.default_path(), frame_ids=1000)
    got = sorted(binary.read_documents(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    want = [(i, [*plain.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, *_ in rows]
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((i, tuple(x)) for i, x in want)
    assert [r["doc_id"] for r in got] == [None, None, 1, 1, 1, 2, 3, 4]
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)]).tolist()[:-1]


def test_chat_of_clashing_columns_and_long_texts(spark):
    """op3: columns named like its own working columns are ignored; long turns are whole in what is rendered."""
    long = "long text " * 50_000
    rows = [(1, 0, "user", long, "a", 1, 2), (1, 1, "assistant", "ok", "b", 1, 2), (2, 0, "user", long, "c", 9, 9), (3, 0, "user", "other", "d", 0, 0)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered string, pos int, p1 long")
    got = {r["conv_id"]: r["rendered"] for r in chat.collapse(frame).collect()}
    assert got == {1: f"<|user|>\n{long}<|end|>\n<|assistant|>\nok<|end|>\n", 3: "<|user|>\nother<|end|>\n"}


def test_rules_of_very_long_texts(spark):
    """op7: one line of 200,000 words, a long text without repeats, and one of many equal lines, counted one by one."""
    r = random.Random(2)
    texts = {1: " ".join(f"w{i}" for i in range(60_000)), 2: "same line of eight words and no more\n" * 5_000, 3: " ".join(r.choice("abc") for _ in range(50_000)), 4: "x" * 300_000, 5: None, 6: "#*$ % & | < >"}
    frame = spark.createDataFrame([(i, t, 7, True) for i, t in texts.items()], "doc_id long, text string, n_words int, kept boolean")
    got = {x["doc_id"]: x for x in rules.judge(frame, spark.createDataFrame([(1,), (None,)], "doc_id long")).collect()}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        repeated = set()
        for k in range(len(words) - 7):
            if windows[tuple(words[k : k + 8])] > 1:
                repeated.update(range(k, k + 8))
        seen, lines = set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                lines += line in seen
                seen.add(line)
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(repeated))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert got[i]["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_recall_on_planted_copies():
    """op8: items planted in other words with edits, from untouched to just at the threshold: all are found."""
    r = random.Random(6)
    items = [(i, " ".join(f"i{i}w{k}" if k % 3 else f"c{r.randrange(400)}" for k in range(r.randint(30, 90)))) for i in range(150)]
    index, planted, found = decontam.Items(items, 5, 20), 0, 0
    for i, text in items:
        words = text.split()
        for edits in range(4):
            own = list(words)
            for at in r.sample(range(len(own)), edits):
                own[at] = "edited"
            grams = [Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in (words, own)]
            both = sum((grams[0] & grams[1]).values())
            if both >= 0.8 * (2 * (len(words) - 4) - both):
                planted += 1
                filler = [f"f{r.randrange(5000)}" for _ in range(60)]
                found += i in {x[0] for x in index.match(" ".join([*filler[:31], *own, *filler[31:]]), 0.8)}
    assert planted > 250 and found == planted


def test_parts_of_token_files(spark):
    """op10: an id with a third of all rows, and null ids, fill several parts; ids ascend from part to part."""
    rows = [(None if i % 4 == 0 else 500 if i % 3 == 0 else i, f"text {i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        frames = binary.encode_frames(frame, tokens.default_path()).select("part", "doc_ids").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    parts = sorted((f["part"], f["doc_ids"]) for f in frames)
    sizes = [len(ids) for _, ids in parts]
    assert max(sizes) < 3 * 3000 / 20 and sum(sizes) == 3000
    assert len([1 for _, ids in parts if ids[0] is None]) >= 4 and len([1 for _, ids in parts if 500 in ids]) >= 4
    flat = [(i is not None, i or 0) for _, ids in parts for i in ids]
    assert flat == sorted(flat)
    none, bounds = binary.splits(frame.select("doc_id").limit(0), 7)
    assert none == 0 and len(bounds) == 0

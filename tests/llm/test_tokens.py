"""Tokens, packing and binary files against plain encodings."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from keelson.llm import binary, packing, simple8b, tokens, work

TEXTS = ["plain words, and more.\nNext line", "", None, "double  blank \n\n end ", "ünï cødé 日本語 🙂", "a<|endoftext|>b", " lead", "tail ", "it's  'll", "word " * 3000, "x" * 5000, "foo\tbar", "one\n two", "same text", "same text", "\n", "Émile, l'été.\nÀ bientôt"]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokens.default_path())


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


def test_encoder_is_exact(plain):
    enc = tokens.encoder(tokens.default_path())
    for _ in range(2):  # cold and warm memo
        ids, size = enc.encode(TEXTS)
        for text, got in zip(TEXTS, np.split(ids, np.cumsum(size)[:-1]), strict=True):
            assert got.tolist() == ids_of(plain, text), text


def test_encoder_is_exact_on_odd_blanks(plain, monkeypatch):
    """Runs of every kind of white space, marks, digits, added tokens and long chunks, with a memo that turns over often."""
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 300)
    enc, r = tokens.Encoder(tokens.default_path()), random.Random(4)
    parts = [*"aBé漢🙂1!,.'s ", "  ", "   ", " \n", "\n", "\n\n\n", "\t", "\r\n", "\x85", "\xa0", "\u3000", "\u2028", "\x1c", "\0", "\u200b", " the", " of", "'ll", "<|endoftext|>", "١", "ª", "½", " word" * 50, "x" * 300]
    for _ in range(20):
        texts = [None, "", *("".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(400))]
        ids, size = enc.encode(texts, 7)
        for text, got in zip(texts, np.split(ids, np.cumsum(size)[:-1]), strict=True):
            assert got.tolist() == [*ids_of(plain, text), 7], text


def documents(spark, extra=False):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("start", df["doc_id"]).withColumn("ids", df["text"]) if extra else df


@pytest.mark.parametrize("extra", [False, True])
def test_packing_covers_every_id(spark, plain, extra):
    out = packing.pack_documents(documents(spark, extra), tokens.default_path(), window=256, grid=16, block_ids=4000).collect()
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in out:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256 and (at == 256 or at & (at - 1) == 0)
    for i, text in enumerate(TEXTS):
        want = [*ids_of(plain, text), 1]
        got = sorted(docs[i])
        if i == 3:
            continue  # its row is there twice
        assert [x for _, ids, _ in got for x in ids] == want
        assert {n for _, _, n in got} == {len(want)}
    assert sum(r["length"] for r in out if r["doc_id"] == 3) == 2 * (len(ids_of(plain, TEXTS[3])) + 1)


def test_packing_empty_table_and_digests(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(empty, tokens.default_path()).count() == 0
    one = packing.piece_digests(packing.pack_documents(spark.createDataFrame([(None, "a b")], "doc_id long, text string"), tokens.default_path())).collect()
    assert one[0]["doc_id"] is None and sum(r["length"] for r in one) == one[0]["doc_tokens"]


def test_nnls_uses_up_an_exact_histogram():
    h = np.zeros(129, np.int64)
    h[128], h[64], h[100], h[28] = 5, 20, 7, 7
    used = packing.repeats(h, 3)
    assert sum(len(c) * t for c, t in used) == 39


def test_no_padding_for_skewed_lengths():
    p = packing.Packer(2048, 3, 16)
    out = [*p.pack([(i, 1500) for i in range(1000)]), *p.close()]
    fill = defaultdict(int)
    for _, _, n, s, _ in out:
        fill[s] += n
    assert sum(fill.values()) == 1_500_000
    assert all(v & (v - 1) == 0 for v in fill.values())


@pytest.mark.parametrize("high", [1, 2, 50257, 2**31, 2**60, 2**63])
def test_simple8b_round_trip(high):
    random = np.random.default_rng(high % 1000)
    for n in (0, 1, 59, 1023, 1024, 1025, 5000):
        x = random.integers(0, high, n, dtype=np.uint64)
        if n > 100:
            x[10:70] = 0
            x[80], x[81] = np.uint64(2**64 - 1), np.uint64(2**60)
        assert (simple8b.decode(*simple8b.encode(x), n) == x).all()


def test_files_round_trip(spark, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)][::-1]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = binary.write_files(df, work.new_path(spark, "files"), tokens.default_path(), frame_ids=500)
    out = sorted(binary.read_documents(spark, path, with_ids=True).collect(), key=lambda r: r["doc_id"])
    start = 0
    for i, r in enumerate(out):
        want = [*ids_of(plain, TEXTS[i]), 2]
        assert r["ids"] == want and r["start"] == start and r["n_tokens"] == len(want)
        assert r["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    empty = binary.write_files(df.limit(0), work.new_path(spark, "files"), tokens.default_path())
    assert binary.read_documents(spark, empty).count() == 0

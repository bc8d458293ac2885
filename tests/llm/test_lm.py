"""Lattice likelihood against all segmentations; base scores against plain counts; held-out likelihood."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from conftest import SF001

from ragloom.llm import lm

SCHEMA = "doc_id long, text string, score double, word string"


def segmentations(text, pieces):
    """Sum of the probabilities of all segmentations, one by one."""
    if not text:
        return 1.0
    spelled = math.exp(sum(pieces.byte[b] for b in text[0].encode()))
    total = spelled * segmentations(text[1:], pieces)
    for n in range(1, len(text) + 1):
        if text[:n] in pieces.table:
            total += math.exp(pieces.table[text[:n]]) * segmentations(text[n:], pieces)
    return total


def test_forward_is_the_sum_over_segmentations():
    pieces = lm.vocabulary_scores()
    lattice = lm.Lattice(pieces)
    for word in ("a", "the", "hello", "é1x", "中文", "​"):
        assert abs(lattice.score(word) - math.log10(segmentations(lm.SPACE + word, pieces))) < 1e-9
    assert abs(sum(map(math.exp, [*pieces.table.values(), *pieces.byte, pieces.end])) - 1) < 1e-9
    assert lattice.score("x" * 5000) < -100  # no underflow


def test_expected_counts():
    """Each segmentation's pieces, weighted by its posterior."""
    pieces = lm.Pieces({"▁": -1.0, "▁a": -1.5, "a": -2.0, "b": -1.2, "ab": -0.7, "▁ab": -3.0}, [-9.0] * 256, -1.0)
    got, byte = {}, [0.0] * 256
    lm.Lattice(pieces).expect("ab", 2.0, got, byte)
    want, total = Counter(), 0.0

    def walk(text, used, p):
        nonlocal total
        if not text:
            total += p
            for u in used:
                want[u] += p
            return
        walk(text[1:], [*used, text[0].encode()], p * math.exp(sum(pieces.byte[b] for b in text[0].encode())))
        for n in range(1, len(text) + 1):
            if text[:n] in pieces.table:
                walk(text[n:], [*used, text[:n]], p * math.exp(pieces.table[text[:n]]))
    walk("▁ab", [], 1.0)
    for piece in pieces.table:
        assert abs(got.get(piece, 0.0) - 2 * want[piece] / total) < 1e-9
    assert abs(byte[ord("a")] - 2 * want[b"a"] / total) < 1e-9


def test_blocks_of_words_equal_single_words():
    pieces = lm.vocabulary_scores()
    lattice, rng = lm.Lattice(pieces), random.Random(6)
    signs = "aaeeinrst" * 4 + "éßñ中文가▁😀\x00\x1c\u200bŁ1.,-"
    words = ["".join(rng.choice(signs) for _ in range(rng.choice((0, 1, 2, 5, 9, 30, 62, 63, 64, 90)))) for _ in range(3000)]
    weights = [rng.randint(1, 50) for _ in words]
    for got, w in zip(lattice.scores(words), words):
        assert abs(got - lattice.score(w)) < 1e-9 * (1 + abs(got)), w
    uses, byte = np.zeros(len(pieces.table)), np.zeros(256)
    lattice.expect_all(words, np.array(weights), uses, byte)
    want, want_byte = {}, [0.0] * 256
    for w, x in zip(words, weights):
        lattice.expect(w, x, want, want_byte)
    assert np.allclose(uses, [want.get(k, 0.0) for k in pieces.table], rtol=1e-8, atol=1e-12) and np.allclose(byte, want_byte, rtol=1e-8, atol=1e-12)
    assert len(lattice.scores([])) == 0


def slow(rows):
    def words(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1 for k, *_ in rows]
    c = Counter(w for (_, t, *_), h in zip(rows, held) if not h for w in words(t))
    n, v = sum(c.values()), len(c)
    return [(k, h, len(words(t)), sum(c[w] > 0 for w in words(t)), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)))
            for (k, t, *_), h in zip(rows, held)]


def test_documents(spark):
    rows = [(r["doc_id"], r["text"], 0.0, "") for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows += [(900, None, None, None), (901, "", 0.0, ""), (None, "No id İ \x1c", 0.0, ""), (902, "twice", 0.0, ""), (902, "twice", 0.0, ""),
             (903, "long" * 9000, 0.0, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(slow(rows), key=str)
    a = None
    for p in (lm.LmParams(), lm.LmParams(hot_words=40, flush_words=100), lm.LmParams(hot_words=0), lm.LmParams(hot_bytes=3)):
        got = sorted(map(tuple, lm.score_documents(docs, p).collect()), key=str)
        for g, w in zip(sorted(got, key=lambda r: str(r[:5])), sorted(want, key=lambda r: str(r[:5]))):
            assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-7 * abs(w[5])
        scores = sorted(r[6] for r in got)
        assert a is None or all(abs(x - y) < 1e-7 * abs(y) for x, y in zip(scores, a))
        a = scores
    assert len(got) == len(rows)


def test_training_helps_held_out_text(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    p = lm.LmParams()
    start = lm.vocabulary_scores()
    learned = lm.estimate(lm.count_words(docs, p), start, 160, p)
    held = [w.decode() for r in docs.collect() if lm.held_out(r["doc_id"], p) for w in lm.tokens_of(r["text"])]
    held = random.Random(0).sample(held, 2000)
    before, after = (sum(map(lm.Lattice(x).score, held)) / len(held) for x in (start, learned))
    assert after > before + 0.5


def test_empty(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(None, None, 0.0, "")], SCHEMA)
    assert lm.score_documents(only).first()["n_tokens"] == 1

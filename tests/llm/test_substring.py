"""Substring dedup against plain window sets; the FM-index against direct search."""

import hashlib
import random
import re

import numpy as np
from conftest import SF001

from ragloom.llm import fmindex
from ragloom.llm import substring as sd


def slow(rows, n=50):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    least = {}
    for (k, *_), ws in zip(rows, words):
        for i in range(len(ws) - n + 1):
            w = tuple(ws[i:i + n])
            least[w] = min(least.get(w, sd.NO_ID), sd.NO_ID if k is None else k)
    out = []
    for (k, *_), ws in zip(rows, words):
        gone = set()
        for i in range(len(ws) - n + 1):
            if least[tuple(ws[i:i + n])] < (sd.NO_ID if k is None else k):
                gone.update(range(i, i + n))
        kept = [w for i, w in enumerate(ws) if i not in gone]
        out.append((k, len(ws), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(map(str, out))


def planted(rng):
    vocab = [f"w{i}" for i in range(400)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, other = words(80), words(51)
    rows = [(10, " ".join(words(60) + passage + words(30)), "x", 1), (11, " ".join(passage), "x", 1),
            (12, " ".join(words(5) + passage[:55] + words(5) + passage[20:]), "x", 1), (13, "\n".join(words(3) + passage[:49]), "x", 1),
            (14, " ".join(other + other + other), "x", 1), (15, " \t".join(other[:50]), "x", 1), (16, " ".join(["the"] * 300), "x", 1),
            (17, " ".join(["the"] * 70), "x", 1), (18, None, None, None), (19, "", "", 1), (None, " ".join(passage), "x", 1),
            (None, " ".join(words(60)), "x", 1), (11, " ".join(passage), "x", 1), (11, " ".join(words(9) + passage), "x", 1),
            (20, " ".join(words(30000)), "x", 1)]
    rows.append((21, " ".join(rows[-1][1].split()[100:20000]), "x", 1))
    for k in range(30):  # a passage of 49 + 1 words with other words around it
        rows.append((30 + k, " ".join(words(40) + passage[5:5 + 45 + k % 10] + words(40)), "x", 1))
    return rows


SCHEMA = "doc_id long, text string, ranges string, did long"


def got(spark, rows, p=sd.SubstringParams()):
    return sorted(str(tuple(r)) for r in sd.substring_report(spark.createDataFrame(rows, SCHEMA), p).collect())


def test_planted(spark):
    rows = planted(random.Random(4))
    want = slow(rows)
    assert got(spark, rows) == want
    assert got(spark, rows, sd.SubstringParams(shard_words=100, shard_segments=3)) == want  # many shards; anchors dealt again


def test_a_hot_anchor_is_dealt_again(spark):
    """A 45-word passage in 300 texts, each with other words around it: one anchor, nearly all segments different."""
    rng = random.Random(8)
    hot = [f"h{i}" for i in range(45)]
    other = lambda n: [f"w{rng.randrange(50)}" for _ in range(n)]
    rows = [(k, " ".join(other(30) + hot + other(30)), "", 0) for k in range(300)]
    rows += [(400 + k, " ".join(other(3) + rows[7 * k][1].split()[20:90] + other(3)), "", 0) for k in range(40)]
    want = slow(rows)
    assert sum(int(eval(w)[2]) for w in want) >= 40 * 70
    p = sd.SubstringParams(shard_segments=8)
    docs = sd._docs(spark.createDataFrame(rows, SCHEMA))
    found = sd.occurrences(docs, p)
    contents = sd._contents(docs, found.groupBy("anchor", "seg").agg(sd.F.min(sd.F.struct("did", "th", "s0", "nw")).alias("own")).select("anchor", "seg", "own.*"), p)
    most = lambda df, key: df.groupBy(key).agg(sd.F.countDistinct(key.replace("anchor", "seg")).alias("n")).agg(sd.F.max("n")).first()[0]
    parts = sd._parts(contents, p.window, p)
    assert most(contents, "anchor") > 200 and most(parts, "anchor2") == 1
    assert got(spark, rows, p) == want


def test_a_very_long_text(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(3000)}" for _ in range(200_000)]
    rows = [(1, " ".join(long), "", 0), (2, " ".join(long[150_000:150_070]), "", 0), (3, " ".join(long[:60] + ["x"] + long[199_960:]), "", 0)]
    out = {eval(r)[0]: eval(r)[1:3] for r in got(spark, rows)}
    assert out == {1: (200_000, 0), 2: (70, 70), 3: (101, 60)}


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"], "", 0) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert got(spark, rows) == slow(rows)


def test_empty(spark):
    assert sd.substring_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_remove_repeats(spark):
    rows = planted(random.Random(4))
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA + ", n_chars long")
    out = sd.remove_repeats(docs)
    assert out.columns == docs.columns
    sha = sorted(str((r["doc_id"], hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest())) for r in out.collect())
    assert sha == sorted(str((eval(x)[0], eval(x)[3])) for x in slow(rows))
    assert all(r["n_chars"] == len(r["text"] or "") for r in out.collect())


def test_matching_statistics():
    """Any documents, not only the indexed ones."""
    rng = np.random.default_rng(2)
    segs = [rng.integers(1, 4, rng.integers(1, 40)).astype(np.uint64) for _ in range(12)]
    docs = [rng.integers(1, 6, rng.integers(1, 60)).astype(np.uint64) for _ in range(9)] + segs[:2]
    owners = rng.integers(0, 9, len(segs))
    limit = 5
    index = fmindex.FMIndex(segs, owners, limit)
    length, owner = index.matching(docs)
    at = 0
    for d in docs:
        for i in range(len(d)):
            best, own = 0, []
            for s, o in zip(segs, owners):
                for j in range(len(s)):
                    k = 0
                    while k < limit and i + k < len(d) and j + k < len(s) and d[i + k] == s[j + k]:
                        k += 1
                    best = max(best, k)
                    if k == limit:
                        own.append(o)
            assert length[at] == best and (best < limit or owner[at] == min(own))
            at += 1

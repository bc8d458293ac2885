"""The divergence audit against a plain count; the perfect hash on its own."""

import random
import re
from collections import Counter, defaultdict

from conftest import SF001

from ragloom.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string, term string, shard int, n long"


def slow(rows, p):
    docs = [("" if lang is None else lang, "" if s is None else s,
             re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in (t or "")))) for _, t, lang, s, *_ in rows]
    df = defaultdict(Counter)
    for lang, _, ts in docs:
        df[lang].update(set(ts))
    kept = {lang: {t for t, n in c.items() if n >= p.min_docs} for lang, c in df.items()}
    groups = defaultdict(Counter)
    for lang, s, ts in docs:
        groups[lang, s].update(t for t in ts if t in kept.get(lang, ()))
    out = []
    for (lang, s), mine in groups.items():
        v = len(kept.get(lang, ()))

        def share(c):
            n = sum(c.values())
            return {t: 1 + p.scale * (c[t] + p.smoothing) // (n + p.smoothing * v) for t in kept.get(lang, ())}
        own = share(mine)
        others = {s2: share(c) for (l2, s2), c in groups.items() if l2 == lang and s2 != s}
        scored = sorted(((sum(abs(own[t] - o[t]) for t in own), s2) for s2, o in others.items()), key=lambda x: (-x[0], x[1].encode()))
        out += [(lang, s, "pair", s2, f, i + 1) for i, (f, s2) in enumerate(scored)]
        whole = Counter()
        for (l2, _), c in groups.items():
            if l2 == lang:
                whole.update(c)
        all_q = share(whole)
        up = sorted(((own[t] - all_q[t], t) for t in own if mine[t] > 0 and own[t] > all_q[t]), key=lambda x: (-x[0], x[1].encode()))[:p.top_terms]
        out += [(lang, s, "term", t, f, i + 1) for i, (f, t) in enumerate(up)]
    return sorted(map(str, out))


def fast(spark, rows, p):
    return sorted(str(tuple(r)) for r in dv.audit_sources(spark.createDataFrame(rows, SCHEMA).repartition(3), p).collect())


def made(seed=1):
    rng = random.Random(seed)
    vocab = ["the", "Straße", "É", "é", "ÉCOLE", "naïve", "中文", "x", "a1b", "it's", "Ab", "aB", "Ω", "ω", "a_b", "@q", "[z]", "~y", "\x7fk"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    rows = []
    for k in range(260):
        lang = rng.choice(["en", "en", "de", None, "", "zz"])
        source = rng.choice(["s0"] * 4 + ["s1", "s2", "S2", None, ""])
        rows.append((k, " ".join(rng.choice(vocab[:40] if source == "s1" else vocab) for _ in range(rng.randint(0, 30))), lang, source, "x", 1, 1))
    rows += [(900, None, "en", "silent", "", 0, 0), (901, "", "only", "one", "", 0, 0), (902, "...", "only", "two", "", 0, 0), (None, "the the", "en", "s1", "", 0, 0),
             (903, "the " * 200000 + "Ab", "en", "s0", "", 0, 0), (904, "q" * 300000, "en", "s0", "", 0, 0), (1, "the", "en", "s0", "", 0, 0), (1, "the", "en", "s0", "", 0, 0)]
    return rows


def test_planted(spark):
    rows = made()
    for p in (dv.DivergenceParams(min_docs=3), dv.DivergenceParams(min_docs=2, shard_terms=7, broadcast_bytes=1500, task_bytes=4000, block_sources=2, top_terms=5),
              dv.DivergenceParams()):
        assert fast(spark, rows, p) == slow(rows, p)


def test_tiny_tables(spark):
    p = dv.DivergenceParams(min_docs=1)
    for few in ([], [(1, None, None, None, "", 0, 0)], [(1, "a", "l", "s", "", 0, 0), (2, "a b", "l", "t", "", 0, 0)]):
        assert fast(spark, few, p) == slow(few, p)


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], "", 0, 0) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert fast(spark, rows, dv.DivergenceParams(min_docs=8, shard_terms=64)) == slow(rows, dv.DivergenceParams(min_docs=8))


def test_counts_beyond_a_long_product(spark):
    """Shares of counts whose product with the scale leaves a long."""
    df = spark.createDataFrame([(10**14 + 7, 3 * 10**14 + 1, 12345)], "n long, t long, v long")
    p = dv.DivergenceParams()
    from pyspark.sql import functions as F
    assert df.select(dv._share(F.col("n"), F.col("t"), F.col("v"), p)).first()[0] == 1 + p.scale * (10**14 + 12) // (3 * 10**14 + 1 + 5 * 12345)


def test_perfect_hash_is_minimal_and_verified():
    for n in (1, 2, 3, 5, 17, 400, 8192):
        terms = [f"t{k}".encode() for k in range(n)]
        mph = dv.PerfectHash.build(terms)
        assert sorted(mph.slots(terms).tolist()) == list(range(n))
        assert [mph.terms[i] for i in mph.slots(terms)] == terms
        assert (mph.slots([f"u{k}".encode() for k in range(1000)]) == -1).all()
    assert dv.PerfectHash.build([b"a"]).slots([]).tolist() == []


def test_rounds_are_bounded():
    from types import SimpleNamespace as R
    parts = dv.rounds([R(lang="a", shard=k, bytes=40) for k in range(7)] + [R(lang="b", shard=0, bytes=500)], 100)
    assert [len(x) for x in parts] == [2, 2, 2, 1, 1] and dv.rounds([], 100) == []

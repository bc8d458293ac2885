"""Packing: every token once, no gaps, near the lower bound; token ids against the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from conftest import SF001
from tokenizers import Tokenizer

from ragloom.llm import packing as pk
from ragloom.llm.tokens import ByteEncoder

SCHEMA = "doc_id long, text string, length string, part string"


def test_encoder_is_the_library():
    encoder, library = ByteEncoder(memo_parts=50), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "a", "B", "é", "it's", "<|endoftext|>", "12", "\xa0", " ", "Ω", "中", "!", "\t", "ab", "'s", "\x1c", "😀",
             "é", ".", " x", "\0", "\r\n", "Straße,", "\nNext"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert list(encoder.ids(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


def holds(rows, library_ids, capacity):
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for got in by_seq.values():
        end = 0
        for offset, length in sorted(got):
            assert offset == end
            end += length
        assert end <= capacity
    for doc, texts in library_ids.items():
        want = []
        for ids in texts:
            for k, (s, n) in enumerate(pk.cut(len(ids), capacity)):
                want.append((k, s, n, zlib.crc32(np.array(ids[s:s + n], dtype="<u4").tobytes())))
        assert sorted(by_doc[doc]) == sorted(want)
    return len(by_seq)


def test_pack(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [(r["doc_id"], r["text"], "", "") for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows += [(900, None, None, None), (901, "", "", ""), (None, "no id", "", ""), (902, "twice", "", ""), (902, "twice", "", ""),
             (903, " ".join(["word"] * 5000), "", ""), (904, " ".join(["word"] * 2047), "", "")]
    ids = defaultdict(list)
    for k, t, *_ in rows:
        ids[k].append(library.encode(t or "", add_special_tokens=False).ids + [0])
    got = pk.pack(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    n = holds(got, ids, 2048)
    assert n <= 1.02 * -(-sum(len(x) for t in ids.values() for x in t) // 2048) + 1


def test_empty(spark):
    assert pk.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cut():
    assert pk.cut(1, 4) == [(0, 1)] and pk.cut(4, 4) == [(0, 4)] and pk.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_plans_use_every_piece_once():
    rng = np.random.default_rng(0)
    p = pk.PackingParams()
    for lengths in (rng.integers(1, 2049, 4000), np.full(5000, 700), np.r_[np.full(900, 1), np.full(400, 1500)],
                    np.minimum(2048, rng.lognormal(6, 1, 20000).astype(int) + 1)):
        counts = np.bincount(lengths, minlength=p.capacity + 1)
        plan = pk.plan_configurations(counts, p)
        used = np.zeros_like(counts)
        for config, n in plan:
            assert sum(i * a for i, a in config.items()) <= p.capacity
            for i, a in config.items():
                used[i] += a * n
        assert (used == counts).all()
        floor = max(-(-int(lengths.sum()) // p.capacity), (lengths > p.capacity // 2).sum(), -(-(lengths > p.capacity // 3).sum() // 2))
        assert sum(n for _, n in plan) <= 1.03 * floor + 2
        slots = pk.slot_table(plan)
        rank = np.concatenate([np.arange(c) for c in counts if c])
        length = np.repeat(np.arange(len(counts)), counts)
        sequence, offset = pk.locate(slots, length, rank)
        assert len(np.unique(sequence * 4096 + offset)) == len(lengths)
        assert (np.bincount(sequence, weights=length) <= p.capacity).all()


def test_price_is_optimal():
    rng = random.Random(3)
    for _ in range(30):
        value = np.zeros(21)
        for i in rng.sample(range(2, 21), 5):
            value[i] = rng.random()
        best = [0.0] * 21
        for c in range(1, 21):
            best[c] = max([best[c - 1], *(value[i] + best[c - i] for i in range(1, c + 1) if value[i] > 0)])
        config = pk.price(value, 20)
        assert sum(i * a for i, a in config.items()) <= 20
        assert abs(sum(value[i] * a for i, a in config.items()) - best[20]) < 1e-9


def test_never_worse_than_best_fit():
    """Histograms on which rounding alone strands pieces; halves, thirds and quarters of the capacity, one token off."""
    rng = np.random.default_rng(3)
    cases = [{683: 2000, 682: 1000, 1366: 1000, 1024: 500, 512: 777}]
    for _ in range(4):
        cases.append({int(2048 / d) + e: int(rng.integers(1, 900)) for d in (2, 3, 4, 7) for e in (-1, 0, 1)})
        cases.append({int(n): int(rng.integers(1, 40)) for n in rng.integers(1, 2049, 60)})
    for case in cases:
        counts = np.zeros(2049, dtype=np.int64)
        for n, c in case.items():
            counts[n] = c
        plan, used = pk.plan_configurations(counts, pk.PackingParams(rounds=1, steps=6)), np.zeros(2049, dtype=np.int64)
        for config, times in plan:
            assert sum(n * a for n, a in config.items()) <= 2048
            for n, a in config.items():
                used[n] += a * times
        assert (used == counts).all()
        assert sum(t for _, t in plan) <= sum(t for _, t in pk.finish(counts.copy(), 2048))
    counts = np.zeros(2049, dtype=np.int64)
    for n, c in cases[0].items():
        counts[n] = c
    assert sum(t for _, t in pk.plan_configurations(counts)) <= 2250

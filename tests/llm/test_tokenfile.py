"""Token-id files: exact round trips, random access, starts; ids against the library."""

import tempfile
import zlib

import numpy as np
import public_tokenizers as P
from conftest import SF001
from tokenizers import Tokenizer

from ragloom.llm import tokenfile as tf

SCHEMA = "doc_id long, text string, start long, part int"


def test_grammar_round_trip():
    rng = np.random.default_rng(1)
    for tokens in (np.zeros(0, np.uint16), np.array([5], np.uint16), np.full(1000, 7, np.uint16), rng.integers(0, 50257, 3000).astype(np.uint32),
                   np.tile(rng.integers(0, 40, 200), 60).astype(np.uint16), rng.zipf(1.4, 50000).clip(0, 40000).astype(np.uint16)):
        g = tf.compress(tokens, tf.TokenFileParams(least_count=2, pairs_a_round=64, frequent=256))
        assert (tf.expand(g, g.symbols) == tokens).all()
        assert g.symbol_lengths()[g.symbols].sum() == len(tokens)
        for k in range(len(g.rules)):
            assert g.lengths[k] == len(tf.expand(g, np.array([len(g.ids) + k], dtype=np.uint32)))
        for _ in range(20):
            a = int(rng.integers(0, len(tokens) + 1))
            n = int(rng.integers(0, len(tokens) - a + 1))
            assert (tf.decode_range(g, a, n) == tokens[a:a + n]).all()
    assert len(g.symbols) < len(tokens)


def test_most_frequent_pairs_become_rules():
    tokens = np.tile(np.array([3, 9, 4, 8], dtype=np.uint16), 500)
    g = tf.compress(tokens)
    assert len(g.symbols) <= 500 and {(3, 9), (4, 8)} <= {tuple(g.ids[r]) for r in g.rules[:2]}


def test_runs_and_repeats_shrink():
    for tokens, most in ((np.full(100001, 7, dtype=np.uint16), 32), (np.tile(np.array([3, 9, 4, 8], dtype=np.uint16), 500), 40),
                         (np.tile(np.array([5, 5, 5, 6], dtype=np.uint16), 500), 40)):
        g = tf.compress(tokens)
        assert (tf.expand(g, g.symbols) == tokens).all()
        assert len(g.symbols) <= most


def test_pairs_of_rare_ids_become_rules():
    """More frequent ids than the table holds, and passages of rarer ids that occur 40 times each."""
    rng = np.random.default_rng(2)
    common = rng.permutation(np.repeat(np.arange(2100), 45))
    passages = 2100 + np.arange(1000).reshape(50, 20)
    dealt = passages[rng.permutation(np.repeat(np.arange(50), 40))].reshape(-1)
    tokens = np.concatenate([common, dealt]).astype(np.uint16)
    g = tf.compress(tokens)
    assert (tf.expand(g, g.symbols) == tokens).all()
    assert len(g.symbols) < len(common) + 2 * 50 * 40


def test_first_round_counts_every_pair():
    rng = np.random.default_rng(3)
    tokens = np.repeat(rng.zipf(1.2, 30000).clip(0, 9000), rng.integers(1, 6, 30000)).astype(np.uint16)
    counts, k = {}, 0
    while k < len(tokens) - 1:  # the plain count: a run's pairs do not overlap
        pair = (int(tokens[k]), int(tokens[k + 1]))
        run = k
        while pair[0] == pair[1] and run + 1 < len(tokens) and tokens[run + 1] == tokens[k]:
            run += 1
        counts[pair] = counts.get(pair, 0) + max(1, (run - k + 1) // 2)
        k = max(k + 1, run)
    left, right, want = set(), set(), []
    g = tf.compress(tokens, tf.TokenFileParams(frequent=16))
    made = [tuple(int(x) for x in g.ids[r]) for r in g.rules[:g.rounds[0]]]
    by_count = {}
    for pair in made:
        by_count.setdefault(counts[pair], []).append(pair)
    for n in sorted(by_count, reverse=True):  # ties in the grammar's own order
        for pair in by_count[n]:
            left.add(pair[0])
            right.add(pair[1])
            want.append(pair)
    assert want == made and not (left & right) - {a for a, b in made if a == b}
    assert all(n < 16 or a in right or b in left or (a, b) in made for (a, b), n in counts.items())


def test_file(spark):
    rows = [(r["doc_id"], r["text"], 1, 2) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows += [(900, None, None, None), (901, "", 0, 0), (None, "no id", 0, 0), (902, "twice", 0, 0), (902, "twice", 0, 0),
             (903, "ab " * 9000, 0, 0)]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for p in (tf.TokenFileParams(), tf.TokenFileParams(shard_tokens=5000)):
        path = tempfile.mkdtemp(prefix="ragloom-test-") + "/ids"
        tf.write_token_file(spark.createDataFrame(rows, SCHEMA).repartition(5), path, p)
        got = tf.token_report(spark, path).collect()
        start, want = 0, []
        for k, text, *_ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
            ids = library.encode(text or "", add_special_tokens=False).ids + [0]
            want.append((k, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
            start += len(ids)
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
        back = {r["doc_id"]: r["ids"] for r in tf.read_token_file(spark, path).collect()}
        assert back[903] == library.encode("ab " * 9000, add_special_tokens=False).ids + [0]


def test_empty(spark):
    path = tempfile.mkdtemp(prefix="ragloom-test-") + "/ids"
    tf.write_token_file(spark.createDataFrame([], SCHEMA), path)
    assert tf.token_report(spark, path).count() == 0


def test_parts_of_many_texts_are_looked_up_once(monkeypatch):
    from ragloom.llm import tokens

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    words = ["the", "The.", "it's", "don't,", "éleen***", "ÉQUE!!", "a_b", "x^2", "50@mail5.example.com", "#tag", "###", "naïve's", "日本語", "😀", "1234", "<b>",
             "Straße;", "can''t", "end'", "'s", "`q`", "a~", "×", "é÷", "ªº", "é", "​", "word..."]
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(words, 40)) for _ in range(60)]
    texts += ["\n".join(" ".join(rng.choice(words, 5)) for _ in range(8)) for _ in range(60)]
    texts += [None, "", " ", "\n", " a", "a ", "a  b", "a\n\nb c", "\na b", "a b\n", "a \nb", "a\n b", "a\tb c", "a b c", "a\r\nb c", "\n\n a", "a b\nc\n\nd e"]
    texts = [texts[k] for k in rng.permutation(len(texts))]
    for size in (1, 300, 1 << 23):
        monkeypatch.setattr(tokens, "SLICE_CHARS", size)
        got = [ids.tolist() for ids in tokens.ByteEncoder(memo_parts=40).ids_of(texts)]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoder, asked = tokens.ByteEncoder(), []
    monkeypatch.setattr(tokens.ByteEncoder, "ids", lambda self, text: asked.append(text) or np.zeros(0, dtype=self.dtype))
    assert len(list(encoder.ids_of(["one two two one"] * 100))) == 100
    assert not asked and set(encoder.memo) == {"one", "two"}


def test_memo_holds_parts_without_the_signs_behind_them():
    from ragloom.llm import tokens

    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    encoder = tokens.ByteEncoder()
    texts = ["one two, one. one\ntwo... (one) one!?\"", "Straße; Straße two one\none; 50 50% 5-0, 5-0."]
    assert [ids.tolist() for ids in encoder.ids_of(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert set(encoder.memo) == {"one", "two", "(one", "Straße", "50", "5-0"}
    # signs that are, or may be, one piece with what stands before them
    ends = ["é", "ก็", "×", "÷", "。", "日", "²", "½", "ª", "µ", "'", "'s", "'ll", "_", "​", "\x00", "\x1f", "\xa0", " ", "　", "\n", "\n\n", "퟿", "😀", "A", "9", "ÿ", ""]
    tails = ["", ".", "'", "'''", "...", "_", "%)", "'.", "~`", "\x7f", "¿"]
    parts = [w + e + t for w in ("", "a", "Ü", "7", "$") for e in ends for t in tails]
    texts = [x for p in parts for x in (p, f"b {p} c", f"b\n{p} c", f"{p}\n{p}", f"b {p}\n\nc")]
    for size in (1, 1 << 23):
        tokens.SLICE_CHARS, kept = size, tokens.SLICE_CHARS
        try:
            got = [ids.tolist() for ids in tokens.ByteEncoder().ids_of(texts)]
        finally:
            tokens.SLICE_CHARS = kept
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_rules_are_expanded_once(monkeypatch):
    rng = np.random.default_rng(7)
    tokens = np.concatenate([np.full(4099, 3), np.tile(rng.integers(0, 30, 64), 300), rng.zipf(1.3, 20000).clip(0, 5000)]).astype(np.uint16)
    p = tf.TokenFileParams(pairs_a_round=64)
    g, copied, plain = tf.compress(tokens, p), [], tf._copied
    monkeypatch.setattr(tf, "_copied", lambda *a: copied.append(plain(*a)) or copied[-1])
    assert (tf.expand(g, g.symbols) == tokens).all()
    assert len(copied) == len(g.rounds) + 1 and len(copied[-1]) == len(tokens)
    assert sum(map(len, copied[:-1])) == g.lengths.sum() <= len(g.rounds) * len(tokens) / p.least_count
    assert len(tf.expand(g, g.symbols[:0])) == 0

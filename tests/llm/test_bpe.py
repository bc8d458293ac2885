"""BPE encoding and decoding against the tokenizers library."""

import hashlib
import random

import public_tokenizers as P
from conftest import SF001
from tokenizers import Tokenizer

from ragloom.llm import bpe

SCHEMA = "doc_id long, text string, ids string, n_tokens int"


def library():
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def want(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))


def test_random_texts():
    t, own, rng = library(), bpe.WordBpe(memo_parts=100), random.Random(9)
    parts = [" ", "  ", "\n", "a", "B", "é", "it's", "'S", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "12", "\xa0", " ", "Ω", "ΟΔΟΣ", "中", "!",
             "\t", "ab", "\x1c", "😀", "é", "́", ".", "İ", "ſ", "K", "\0", "\r\n", "Straße,", "hello", "THE", "ͅ", "ﬁ", "가", "​", "\x85"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        ids = t.encode(text, add_special_tokens=False).ids
        assert own.ids(text) == ids, repr(text)
        assert own.digests(text) == want(t, text), repr(text)
        assert own.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_documents(spark):
    t = library()
    rows = [(r["doc_id"], r["text"], "", 1) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows += [(900, None, None, None), (901, "", "", 0), (None, "no id", "", 0), (902, "twice", "", 0), (902, "twice", "", 0), (903, "x" * 30000, "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = bpe.bpe_report(docs).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((k, *want(t, x))) for k, x, *_ in rows)
    few = docs.limit(20)
    back = {r["doc_id"]: r["text"] for r in bpe.decode_documents(bpe.encode_documents(few)).collect()}
    assert back == {r["doc_id"]: t.decode(t.encode(r["text"] or "", add_special_tokens=False).ids, skip_special_tokens=False) for r in few.collect()}


def merged(symbols, rank):
    vocab = {s: k for k, s in enumerate(sorted({*symbols, *(x for a, b in rank for x in (a, b, a + b))}))}
    names = {k: s for s, k in vocab.items()}
    return [names[k] for k in bpe.Merges(vocab, rank).merge([vocab[s] for s in symbols])]


def test_merges_in_rank_order():
    rank = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("a", "a"): 3}
    assert merged(list("abc"), rank) == ["abc"]
    assert merged(list("aaa"), rank) == ["aa", "a"]
    assert merged(list("x"), rank) == ["x"] and merged([], rank) == []


def test_long_words_use_the_same_merges():
    own, rng = bpe.WordBpe(), random.Random(2)
    for _ in range(60):
        word = [rng.choice("aaabetinsr") for _ in range(rng.randint(2, 120))]
        assert [own.tokens[i] for i in own.merges.merge([own.vocab[c] for c in word])] == bpe.merge_long(word, own.rank)


def test_plain_parts_equal_the_library():
    """Parts that skip the library's normaliser and pre-tokeniser: every printable ASCII and Latin-1 character, in any mix."""
    t, own, rng = library(), bpe.WordBpe(), random.Random(4)
    signs = [chr(c) for c in [*range(33, 127), *range(0xA1, 0x100)]] + ["'s", "'LL", "'re", "ab", "The", "é", "ÉTÉ", "ß", "ÿ", "µ", "9"]
    for _ in range(20000):
        part = "".join(rng.choice(signs) for _ in range(rng.randint(1, 8)))
        assert own.ids(part) == t.encode(part, add_special_tokens=False).ids, repr(part)


def test_very_long_text():
    t, own = library(), bpe.WordBpe(memo_parts=1000)
    text = " ".join(f"Word{k % 7919}, isn't" for k in range(100000))  # 200,000 words
    assert own.digests(text) == want(t, text)


def test_empty(spark):
    assert bpe.bpe_report(spark.createDataFrame([], SCHEMA)).count() == 0

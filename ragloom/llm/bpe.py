"""BPE encoding and decoding with a contiguous rank array.

A word's symbols are held as one array of part boundaries with, beside each part, the rank of its merge
with the next part. The smallest rank is found by scanning the array; that boundary is deleted, and
the ranks of the two neighbours are refreshed. Words are short, so the scan beats a heap.

Texts are looked up by white-space-separated parts: white space is dropped by this vocabulary, and
no step of it reaches across. Parts are normalised and split by the tokenizers library's own normaliser
and pre-tokeniser; the merges are done here. A part that holds a special token's text is cut at it first.

Defined results: a null or empty text has no ids and decodes to the empty text; a very long text or word is
encoded whole; repeated rows are encoded one by one; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import with_package
from ragloom.llm.tokens import byte_characters, tokenizer_path

MEMO_PARTS = 1 << 19
NO_RANK = 1 << 60
SHORT = 128  # symbols; the scan is quadratic, longer words use a heap
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PLAIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")  # fixed values: the vocabulary's pattern


class Merges:
    """The merge table over integer parts: a pair's key is left * size + right."""

    def __init__(self, vocab: dict[str, int], rank: dict[tuple[str, str], int]):
        self.size = max(vocab.values(), default=0) + 1
        self.rank = {vocab[a] * self.size + vocab[b]: k for (a, b), k in rank.items()}
        self.joined = {k: vocab[a + b] for (a, b), k in rank.items()}

    def merge(self, parts: list[int]) -> list[int]:
        """Apply the merges of least rank (leftmost first) until none is left; ranks[i] stands at the boundary after part i."""
        get, size, joined = self.rank.get, self.size, self.joined
        ranks = [get(a * size + b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            del parts[i + 1], ranks[i]  # part i takes part i + 1 in
            part = parts[i] = joined[least]
            if i < len(ranks):
                ranks[i] = get(part * size + parts[i + 1], NO_RANK)
            if i:
                ranks[i - 1] = get(parts[i - 1] * size + part, NO_RANK)
        return parts


def merge_long(symbols: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    """The same merges for a word of any length: a heap of (rank, place) over linked parts."""
    part, after, before = list(symbols), [*range(1, len(symbols)), -1], list(range(-1, len(symbols) - 1))
    heap = [(rank[p], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
    heapify(heap)
    while heap:
        _, i, a, b = heappop(heap)
        j = after[i]
        if part[i] != a or j < 0 or part[j] != b:
            continue  # one of the two has been merged since
        part[i], part[j], after[i] = a + b, "", after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0 and (part[x], part[y]) in rank:
                heappush(heap, (rank[part[x], part[y]], x, part[x], part[y]))
    return [p for p in part if p]


class WordBpe:
    """Encoder and decoder for a vocabulary file whose BPE marks word ends and drops white space."""

    def __init__(self, path: str | None = None, memo_parts: int = MEMO_PARTS):
        from tokenizers import Tokenizer

        path = tokenizer_path(path, "word_bpe_49k.json")
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): k for k, m in enumerate(model["merges"])}
        self.end = model["end_of_word_suffix"] or ""
        self.merges = Merges(self.vocab, self.rank)
        self.inner = {c: self.vocab[c] for c in byte_characters().values() if c in self.vocab}
        self.last = {c: self.vocab[c + self.end] for c in self.inner if c + self.end in self.vocab}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {k: t for t, k in {**self.vocab, **self.special}.items()}
        self.decimal = {k: str(k) for k in self.tokens}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.alphabet = byte_characters()
        self.words: dict[str, tuple[int, ...]] = {}
        self.encoded: dict[bytes, str] = {}  # strings alone: nothing for the garbage collector to follow
        self.decoded: dict[bytes, str] = {}
        self.limit = memo_parts

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token; a symbol that the vocabulary lacks has none, as without an unknown token."""
        got = self.words.get(word)
        if got is None:
            if len(word) > SHORT:
                symbols = [*word[:-1], word[-1] + self.end]
                got = [self.vocab[s] for s in merge_long([s for s in symbols if s in self.vocab], self.rank)]
            else:
                parts = [*map(self.inner.get, word[:-1]), self.last.get(word[-1])]
                got = self.merges.merge([x for x in parts if x is not None] if None in parts else parts)
            got = self.words[word] = tuple(got)  # of numbers alone, so the garbage collector need not follow it
        return got

    def part_ids(self, part: str) -> Sequence[int]:
        if self.cut and "|" in part and any(t in part for t in self.special):
            out = []
            for x in self.cut.split(part):
                out += [self.special[x]] if x in self.special else self.part_ids(x) if x else []
            return out
        if _PLAIN.fullmatch(part):
            low = part.lower()
            if not part.isascii():  # letters beyond ASCII are two symbols of the byte alphabet
                return [i for word in _PLAIN_WORDS.findall(low) for i in self.word_ids(word.encode("utf-8").decode("latin-1").translate(self.alphabet))]
            if low.isalpha():
                return self.word_ids(low)
            return [i for word in _PLAIN_WORDS.findall(low) for i in self.word_ids(word)]
        return [i for word, _ in self.split(self.normalize(part)) for i in self.word_ids(word)]

    def learn(self, part: bytes) -> str:
        """Put a part into the memo: its decimal ids and its decoded text, both joined by one space."""
        ids = self.part_ids(part.decode("utf-8"))
        self.decoded[part] = self.decode(ids)
        got = self.encoded[part] = " ".join(map(self.decimal.__getitem__, ids))
        return got

    def ids(self, text: str | None) -> list[int]:
        return [i for p in (text or "").encode("utf-8").split() for i in self.part_ids(p.decode("utf-8"))]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary names no decoder: the tokens joined by one space."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def digests(self, text: str | None) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded text)."""
        if len(self.encoded) > self.limit:
            for memo in (self.encoded, self.decoded, self.words):
                memo.clear()
        parts = (text or "").encode("utf-8").split()
        encoded = list(map(self.encoded.get, parts))
        if None in encoded:
            known, learn = self.encoded.get, self.learn
            encoded = [(known(p) or learn(p)) if e is None else e for e, p in zip(encoded, parts)]
        decoded = map(self.decoded.__getitem__, parts)
        if "" in encoded:  # a part without an id leaves no space
            encoded, decoded = filter(None, encoded), filter(None, decoded)
        ids = " ".join(encoded)
        return (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(" ".join(decoded).encode("utf-8")).hexdigest())


@lru_cache(maxsize=2)
def word_bpe(path: str | None = None) -> WordBpe:
    """The coder of this worker process: its memo serves all tasks that the worker runs."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids: the ids of every whole text."""
    with_package(docs.sparkSession)

    def run(batches):
        bpe = word_bpe(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.ids(t.as_py()) for t in b.column(1)], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text: the decoded text of ``ids``."""
    with_package(encoded.sparkSession)

    def run(batches):
        bpe = word_bpe(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def bpe_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, in one pass over the texts."""
    with_package(docs.sparkSession)

    def run(batches):
        bpe = word_bpe(path)
        for b in batches:
            got = [bpe.digests(t.as_py()) for t in b.column(1)]
            cols = list(zip(*got)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

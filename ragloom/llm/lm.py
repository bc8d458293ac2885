"""Language-model scores: a word unigram base, and the marginal likelihood of the subword lattice.

Words are counted over all training documents (a held-out fold is left out). The lattice model takes
the pieces of an existing subword vocabulary with their scores; one expectation step over all distinct
training words, weighted by their counts, re-estimates the piece probabilities. A word's probability
is the sum over all its segmentations, by a forward recursion in log space; a document's is the product
over its words and its end, since no piece reaches across white space. Any character can also be spelled
by its byte pieces, so every word has a segmentation.

The recursion runs over blocks of words of nearly equal length, place by place, along a trie of the pieces;
words above 64 characters go one by one, without keeping their edges.

The most frequent words of at most ``hot_bytes`` bytes, at most ``hot_words`` of them, are broadcast (a fixed bound)
and cover most tokens in one pass; all other words are joined with the word table, so the vocabulary may grow without limit.

Defined results: a null or empty text is its end token alone; a row without a doc_id has the fold of the
empty text's CRC; a very long text or word is counted and scored whole; repeated rows are counted and scored one by one; without training tokens every count
is 0; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package
from ragloom.llm.tokens import tokenizer_path

SPACE = "▁"
LN10 = math.log(10.0)


@dataclass(frozen=True)
class LmParams:
    vocabulary: str | None = None   # path; None: the installed piece_bpe_32k.model
    folds: int = 5
    held_fold: int = 1
    hot_words: int = 1 << 19        # words of the broadcast table, and
    hot_bytes: int = 64             # the bytes of each at most: 42 MB in all
    flush_words: int = 1 << 19      # words that a task counts before it sends them on
    smoothing: float = 0.5          # added to every piece's expected count


@dataclass
class Pieces:
    """Log probabilities (natural): ``table`` of pieces, ``byte`` of the 256 byte pieces, ``end`` of a document's end."""

    table: dict[str, float]
    byte: list[float]
    end: float

    @property
    def longest(self) -> int:
        return max(map(len, self.table), default=1)


def vocabulary_scores(path: str | None = None) -> Pieces:
    """The existing vocabulary: a piece of score -r (its merge rank) weighs 1 / (r + 2); byte pieces and the end like the last rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(path, "piece_bpe_32k.model"))
    weight = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            weight[model.id_to_piece(i)] = 1.0 / (2.0 - min(0.0, model.get_score(i)))
    least = min(weight.values(), default=1.0)
    total = math.log(sum(weight.values()) + 257 * least)
    return Pieces({k: math.log(w) - total for k, w in weight.items()}, [math.log(least) - total] * 256, math.log(least) - total)


def _utf8(code: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The UTF-8 bytes of code points: (places in ``code``, their byte) for each byte position of each length."""
    out, low = [], 0
    for k, (high, lead) in enumerate(((0x80, 0), (0x800, 0xC0), (0x10000, 0xE0), (0x110000, 0xF0))):
        at = np.flatnonzero((code >= low) & (code < high))
        if len(at):
            c = code[at]
            out.append((at, lead | c >> 6 * k))
            out += [(at, 0x80 | c >> 6 * j & 0x3F) for j in range(k)]
        low = high
    return out


class Trie:
    """The pieces as a trie over character classes; node 0 is nowhere, node 1 the root.

    Edges of the commonest characters stand in a dense table, the others in a sorted list."""

    DENSE = 128

    def __init__(self, pieces: list[str]):
        often = Counter(c for p in pieces for c in p)
        chars = sorted(often, key=lambda c: (-often[c], c))
        self.kind = np.zeros(0x110000, dtype=np.int32)  # 0: in no piece
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.kinds = len(chars) + 1
        kind, child, ends = {c: k + 1 for k, c in enumerate(chars)}, {}, {}
        for index, piece in enumerate(pieces):
            node = 1
            for c in piece:
                node = child.setdefault(node * self.kinds + kind[c], len(child) + 2)
            ends[node] = index
        self.piece = np.full(len(child) + 2, -1, dtype=np.int64)
        self.piece[list(ends)] = list(ends.values())
        keys, to = np.array(list(child), dtype=np.int64), np.array(list(child.values()), dtype=np.int32)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], to[order]
        node, k = np.divmod(self.keys, self.kinds)
        self.dense = np.zeros((len(child) + 2, self.DENSE), dtype=np.int32)
        common = k < self.DENSE
        self.dense[node[common], k[common]] = self.to[common]

    def step(self, node: np.ndarray, kind: np.ndarray) -> np.ndarray:
        out = self.dense[node, np.minimum(kind, self.DENSE - 1)]
        rare = np.flatnonzero(kind >= self.DENSE)
        if len(rare):
            key = node[rare] * self.kinds + kind[rare]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[rare] = np.where(self.keys[at] == key, self.to[at], 0)
        return out


@lru_cache(maxsize=2)
def trie_of(pieces: tuple[str, ...]) -> Trie:
    """The trie of this worker process: all tasks that the worker runs share it."""
    return Trie(list(pieces))


class Lattice:
    """All segmentations: of one word at a time, or of blocks of words of nearly equal length, place by place."""

    BLOCK = 4096  # words
    SHORT = 64    # characters; longer words go one by one

    def __init__(self, pieces: Pieces):
        self.get, self.byte, self.longest = pieces.table.get, pieces.byte, pieces.longest
        self.spelled: dict[str, float] = {}
        self.names = list(pieces.table)
        self.values = np.array(list(pieces.table.values()), dtype=np.float64)
        self._trie = None

    @property
    def trie(self) -> Trie:
        if self._trie is None:
            self._trie = trie_of(tuple(self.names))
            self.spell_code = np.zeros(0x110000)
            code, byte = np.arange(0x110000), np.array(self.byte)
            for at, b in _utf8(code):
                self.spell_code[at] += byte[b]
        return self._trie

    def spell(self, char: str) -> float:
        got = self.spelled.get(char)
        if got is None:
            got = self.spelled[char] = sum(self.byte[b] for b in char.encode("utf-8"))
        return got

    def into(self, text: str, i: int) -> list[tuple[int, float, bool]]:
        """The edges (from, score, spelled) into place i."""
        out, get = [], self.get
        for j in range(max(0, i - self.longest), i):
            s = get(text[j:i])
            if s is not None:
                out.append((j, s, False))
        out.append((i - 1, self.spell(text[i - 1]), True))
        return out

    def forward(self, word: str) -> tuple[str, list[float]]:
        """Log sums over the segmentations of each prefix; the edges are not kept."""
        text = SPACE + word
        alpha, exp, log = [0.0], math.exp, math.log
        for i in range(1, len(text) + 1):
            sums = [alpha[j] + s for j, s, _ in self.into(text, i)]
            top = max(sums)
            alpha.append(top + log(sum([exp(x - top) for x in sums])) if len(sums) > 1 else top)
        return text, alpha

    def score(self, word: str) -> float:
        """Log10 of the word's marginal probability."""
        return self.forward(word)[1][-1] / LN10

    def expect(self, word: str, weight: float, pieces: dict[str, float], byte: list[float]) -> None:
        """Add the expected uses of each piece in the word, times ``weight``."""
        text, alpha = self.forward(word)
        n = len(text)
        # share[i]: posterior probability that a segmentation has a boundary at i
        share = [0.0] * n + [1.0]
        for i in range(n, 0, -1):
            if share[i] == 0.0:
                continue
            for j, s, spelled in self.into(text, i):
                p = share[i] * math.exp(alpha[j] + s - alpha[i])
                share[j] += p
                if spelled:
                    for b in text[j].encode("utf-8"):
                        byte[b] += p * weight
                else:
                    key = text[j:i]
                    pieces[key] = pieces.get(key, 0.0) + p * weight

    def _blocks(self, words: list[str]):
        """Short words by length: (their places in ``words``, lengths, code points by place and word)."""
        n = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        order = np.argsort(n, kind="stable")
        order = order[n[order] <= self.SHORT]
        for at in range(0, len(order), self.BLOCK):
            rows = order[at:at + self.BLOCK]
            size = n[rows]
            flat = np.frombuffer("".join([SPACE + words[r] for r in rows]).encode("utf-32-le"), dtype="<u4")
            codes = np.zeros((len(rows), size[-1]), dtype=np.int64)
            codes[np.arange(size[-1]) < size[:, None]] = flat
            yield rows, size, np.ascontiguousarray(codes.T)

    def _forward_block(self, size: np.ndarray, codes: np.ndarray):
        """alpha by place and word, the spelled edges' scores, and per end place the edges (from, words, pieces)."""
        trie, (places, m) = self.trie, codes.shape
        kind = trie.kind[codes]
        kind[np.arange(places)[:, None] >= size] = 0
        spelled = self.spell_code[codes]
        alpha = np.full((places + 1, m), -np.inf)
        alpha[0] = 0.0
        into = [[] for _ in range(places + 1)]
        for j in range(places):
            first = int(np.searchsorted(size, j, side="right"))  # words are in order of length
            alpha[j + 1, first:] = np.logaddexp(alpha[j + 1, first:], alpha[j, first:] + spelled[j, first:])
            word = np.arange(first, m)
            node = np.ones(len(word), dtype=np.int64)
            for i in range(j + 1, places + 1):
                node = trie.step(node, kind[i - 1, word])
                on = np.flatnonzero(node)
                if not len(on):
                    break
                node, word = node[on].astype(np.int64), word[on]
                piece = trie.piece[node]
                known = np.flatnonzero(piece >= 0)
                if len(known):
                    w, piece = word[known], piece[known]
                    alpha[i, w] = np.logaddexp(alpha[i, w], alpha[j, w] + self.values[piece])
                    into[i].append((j, w, piece))
        return alpha, spelled, into

    def scores(self, words: list[str]) -> np.ndarray:
        """``score`` of each word."""
        out = np.full(len(words), np.nan)
        for rows, size, codes in self._blocks(words):
            alpha, _, _ = self._forward_block(size, codes)
            out[rows] = alpha[size, np.arange(len(rows))] / LN10
        for k in np.flatnonzero(np.isnan(out)):
            out[k] = self.score(words[k])
        return out

    def expect_all(self, words: list[str], weights: np.ndarray, uses: np.ndarray, byte: np.ndarray) -> None:
        """``expect`` of each word: adds to ``uses`` by the pieces' order and to ``byte``."""
        long_ = np.ones(len(words), dtype=bool)
        for rows, size, codes in self._blocks(words):
            long_[rows] = False
            weight = weights[rows].astype(np.float64)
            alpha, spelled, into = self._forward_block(size, codes)
            share = np.zeros_like(alpha)
            share[size, np.arange(len(rows))] = 1.0
            letters = np.zeros(codes.shape)
            for i in range(len(codes), 0, -1):
                first = int(np.searchsorted(size, i))
                for j, w, piece in into[i]:
                    p = share[i, w] * np.exp(alpha[j, w] + self.values[piece] - alpha[i, w])
                    share[j, w] += p
                    uses += np.bincount(piece, p * weight[w], len(uses))
                p = share[i, first:] * np.exp(alpha[i - 1, first:] + spelled[i - 1, first:] - alpha[i, first:])
                share[i - 1, first:] += p
                letters[i - 1, first:] = p * weight[first:]
            flat, x = codes.ravel(), letters.ravel()
            for at, b in _utf8(flat):
                byte += np.bincount(b, x[at], 256)
        pieces, plain, place = {}, [0.0] * 256, None
        for k in np.flatnonzero(long_):
            self.expect(words[k], float(weights[k]), pieces, plain)
        if pieces:
            place = {name: k for k, name in enumerate(self.names)}
            for name, x in pieces.items():
                uses[place[name]] += x
        byte += plain


def held_out(doc_id, p: LmParams) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % p.folds == p.held_fold


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()  # bytes: ASCII lowering, ASCII white space


def count_words(docs: DataFrame, p: LmParams) -> DataFrame:
    """word (UTF-8), c (in training documents), n (in all documents); a task sends sums."""
    def run(batches):
        train, rest = Counter(), Counter()

        def flush():
            words = list(train.keys() | rest.keys())
            for at in range(0, len(words), 1 << 16):
                part = words[at:at + (1 << 16)]
                c = np.array([train[w] for w in part], dtype=np.int64)
                n = c + np.array([rest[w] for w in part], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array(c), pa.array(n)], names=["word", "c", "n"])
            train.clear()
            rest.clear()

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                (rest if held_out(doc, p) else train).update(tokens_of(text.as_py()))
                if len(train) + len(rest) > p.flush_words:
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "word binary, c long, n long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def estimate(words: DataFrame, start: Pieces, ends: int, p: LmParams) -> Pieces:
    """One expectation step over all training words; the sums of at most the vocabulary's size reach the driver."""
    def run(batches):
        lattice = Lattice(start)
        uses, byte = np.zeros(len(lattice.names)), np.zeros(256)
        for b in batches:
            lattice.expect_all([w.decode("utf-8") for w in b.column(0).to_pylist()], b.column(1).to_numpy(), uses, byte)
        at = np.flatnonzero(uses)
        names = [*(lattice.names[k] for k in at), *(f"<{k}>" for k in range(256))]
        kinds = [False] * len(at) + [True] * 256
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(kinds), pa.array(np.r_[uses[at], byte])], names=["piece", "is_byte", "x"])

    rows = words.filter("c > 0").select("word", "c").mapInArrow(run, "piece string, is_byte boolean, x double").groupBy("piece", "is_byte").agg(
        F.sum("x").alias("x")).toArrow()
    table, byte = dict.fromkeys(start.table, p.smoothing), [p.smoothing] * 256
    for name, is_byte, x in zip(*(rows.column(k).to_pylist() for k in range(3))):
        if is_byte:
            byte[int(name[1:-1])] += x
        else:
            table[name] += x
    end = ends + p.smoothing
    total = math.log(sum(table.values()) + sum(byte) + end)
    return Pieces({k: math.log(x) - total for k, x in table.items()}, [math.log(x) - total for x in byte], math.log(end) - total)


def _word_scores(words: DataFrame, pieces: Pieces) -> DataFrame:
    """The word table with s, the log10 of each word's marginal probability."""
    def run(batches):
        lattice = Lattice(pieces)
        for b in batches:
            s = lattice.scores([w.decode("utf-8") for w in b.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), pa.array(s)], names=["word", "c", "n", "s"])

    return words.select("word", "c", "n").mapInArrow(run, "word binary, c long, n long, s double")


def hot_threshold(words: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` words occur that often."""
    rows = words.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().orderBy(F.desc("k")).collect()  # at most 64 rows
    seen, least = 0, 1 << 62
    for r in rows:
        seen += r["count"]
        if seen > most:
            break
        least = 1 << r["k"]
    return least


def score_documents(docs: DataFrame, p: LmParams = LmParams()) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = with_package(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(p.folds))
    ends = own.filter(fold != p.held_fold).count()
    counted = materialize(count_words(own, p))
    n, v = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum((F.col("c") > 0).cast("long")), F.lit(0))).first()
    n, v = n + ends, v + (1 if ends else 0)
    pieces = estimate(counted, vocabulary_scores(p.vocabulary), ends, p)
    words = materialize(_word_scores(counted, pieces))
    short = F.octet_length("word") <= p.hot_bytes
    least = hot_threshold(words.filter(short), p.hot_words)
    is_hot = short & (F.col("n") >= least)
    hot_rows = words.filter(is_hot).select("word", "c", "s").toArrow()  # at most ``hot_words`` rows
    hot = spark.sparkContext.broadcast((b"\n".join(hot_rows.column(0).to_pylist()), hot_rows.column(1).to_numpy(), hot_rows.column(2).to_numpy()))
    base = n + 0.5 * (v + 1)  # above 0
    end_base, end_score, end_known = math.log10((ends + 0.5) / base), pieces.end / LN10, int(ends > 0)

    def run(batches):
        blob, c, s = hot.value
        where = {w: i for i, w in enumerate(blob.split(b"\n"))} if len(c) else {}  # no word holds a newline
        place = where.get
        logs, known = np.log10((c + 0.5) / base), (c > 0).astype(np.int64)
        key = TaskContext.get().partitionId() << 40
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                words_ = tokens_of(text.as_py())
                at = [place(w, -1) for w in words_]
                rare = Counter([w for w, i in zip(words_, at) if i < 0])
                at = np.array(at, dtype=np.int64)
                at = at[at >= 0]
                rows.append((key, doc, held_out(doc, p), len(words_) + 1, int(known[at].sum()) + end_known, float(logs[at].sum()) + end_base,
                             float(s[at].sum()) + end_score, [{"word": w, "tf": k} for w, k in rare.items()]))
                key += 1
            cols = list(zip(*rows)) or [[]] * 8
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int32())])))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, kinds)], names=names)

    names = ["key", "doc_id", "held_out", "n_tokens", "k", "b", "s", "rare"]
    scored = materialize(own.mapInArrow(run, "key long, doc_id long, held_out boolean, n_tokens long, k long, b double, s double, rare array<struct<word:binary,tf:int>>"))
    asked = scored.select("key", F.explode("rare").alias("r")).select("key", "r.word", "r.tf")
    tf = F.col("tf")
    rest = asked.join(words.filter(~is_hot).select("word", "c", F.col("s").alias("ws")), "word").groupBy("key").agg(
        F.sum(F.when(F.col("c") > 0, tf).otherwise(0)).alias("rk"), F.sum(tf * F.log10((F.col("c") + 0.5) / F.lit(base))).alias("rb"),
        F.sum(tf * F.col("ws")).alias("rs"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.drop("rare").join(rest, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("k") + zero("rk")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("b") + zero("rb")).alias("base_score"), (F.col("s") + zero("rs")).alias("score"))

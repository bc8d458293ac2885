"""Token-id files with Re-Pair grammar compression.

Documents are written in ascending doc_id order as shards of bounded size. A shard is one row of a
Parquet table (so any shared store will do, and Spark commits a task's file once):

  part, shard      place in the order: the writing task, then the shard within it
  n_tokens         ids in the shard, end ids included
  doc_ids, sizes   per document its doc_id (int64; null_ids flags rows without one) and ids (uint32)
  ids              the terminals' token ids (uint32)
  rules            two symbols (uint32) of each nonterminal, in the order in which they were made
  lengths          expansion length (uint32) of each nonterminal
  rounds           number of nonterminals (uint32) made by each round
  symbols          the compressed sequence (uint32)

Re-Pair: each round counts the adjacent pairs of the whole shard and replaces the most frequent ones by
new nonterminals, until a round gains too little. The pairs of one round never overlap: a symbol is the
left or the right part of that round's pairs, not both; a pair of one symbol with itself takes every
other place of a run, and that symbol is in no other pair of the round. A document is decoded without the others: the
expansion lengths lead from its first id to the symbols that hold it.

Defined results: a null or empty text is its end id alone; rows without a doc_id come first; rows of
one doc_id stand in the order of their texts' hashes; an empty table gives an empty result; other
columns are left alone.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ragloom.llm.common import with_package
from ragloom.llm.tokens import byte_encoder

END = 0


@dataclass(frozen=True)
class TokenFileParams:
    tokenizer: str | None = None   # path; None: the installed byte_bpe_50k.json
    shard_tokens: int = 1 << 21    # a shard ends with the document that reaches this
    pairs_a_round: int = 4096
    least_count: int = 16          # occurrences that a rule must have
    least_gain: float = 0.01       # of the sequence, for another round
    frequent: int = 1024           # symbols whose pairs are counted in one table; the others' pairs are sorted


@dataclass
class Grammar:
    ids: np.ndarray       # uint32: terminal -> token id
    rules: np.ndarray     # (n, 2) uint32
    lengths: np.ndarray   # uint32: expansion length of each nonterminal
    rounds: np.ndarray    # uint32: nonterminals a round
    symbols: np.ndarray   # uint32

    def symbol_lengths(self) -> np.ndarray:
        return np.r_[np.ones(len(self.ids), dtype=np.int64), self.lengths.astype(np.int64)]


#: Pairs of rarer symbols are sorted only where their bucket of 2 ** HASH_BITS holds least_count places.
HASH_BITS = 18


def _second_places(seq: np.ndarray) -> np.ndarray:
    """Places of pairs of one symbol with itself that overlap the pair before: every other one of a run."""
    same = np.flatnonzero(seq[1:] == seq[:-1])
    nth = np.arange(len(same))
    starts = np.r_[True, np.diff(same) > 1][:len(same)]
    return same[(nth - np.maximum.accumulate(np.where(starts, nth, 0))) % 2 == 1]


def compress(tokens: np.ndarray, p: TokenFileParams = TokenFileParams()) -> Grammar:
    """Re-Pair over one shard."""
    seen = np.bincount(tokens) if len(tokens) else np.zeros(0, dtype=np.int64)
    ids = np.flatnonzero(seen)
    number = np.zeros(len(seen), dtype=np.int64)  # of the index type: no copies below
    number[ids] = np.arange(len(ids))
    seq = number[tokens]
    total, rules, lengths, rounds = len(ids), [], [np.ones(len(ids), dtype=np.int64)], []
    seldom, rarer, width = p.frequent, p.frequent + 1, p.frequent + 2  # places of symbols below least_count, and of the others not in the table
    symbol_counts = seen[ids]
    while len(seq) > 1:
        top = np.argsort(-symbol_counts, kind="stable")[:p.frequent]
        place = np.where(symbol_counts >= p.least_count, rarer, seldom)
        place[top] = np.arange(len(top))
        at = place[seq]
        key = at[:-1] * width
        key += at[1:]
        second = _second_places(seq)
        key[second] = width * width - 1
        pair_counts = np.bincount(key, minlength=width * width).reshape(width, width)
        pair_counts[seldom:, :] = pair_counts[:, seldom:] = 0
        pair_counts = pair_counts.reshape(-1)
        most = np.flatnonzero(pair_counts >= p.least_count)
        # pairs with a rarer symbol: an upper bound by hash bucket, then exact counts
        rare_at, counted = at == rarer, at != seldom
        either = (rare_at[:-1] & counted[1:]) | (counted[:-1] & rare_at[1:])
        either[second] = False
        rare = np.flatnonzero(either)
        rare_key = seq[rare] * total + seq[rare + 1]
        bucket = ((rare_key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)).view(np.int64)
        some = (np.bincount(bucket, minlength=1 << HASH_BITS) >= p.least_count)[bucket]
        rare, (rare_pairs, rare_nth, rare_counts) = rare[some], np.unique(rare_key[some], return_inverse=True, return_counts=True)
        rare_parts = np.stack(np.divmod(rare_pairs, total), axis=1)
        parts = np.concatenate([top[np.stack(np.divmod(most, width), axis=1)], rare_parts])
        counts = np.r_[pair_counts[most], rare_counts]
        order = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts >= p.least_count)]
        chosen, left, right = [], set(), set()
        for k, (a, b) in zip(order.tolist(), parts[order].tolist()):
            if a not in right and b not in left:
                left.add(a)
                right.add(b)
                chosen.append(k)
                if len(chosen) == p.pairs_a_round:
                    break
        if not chosen or counts[chosen].sum() < p.least_gain * len(seq):
            break
        symbol = np.zeros(len(parts), dtype=np.int32)
        symbol[chosen] = np.arange(total, total + len(chosen))
        new = np.zeros(width * width, dtype=np.int32)
        new[most] = symbol[:len(most)]
        made = new[key]
        made[rare] = symbol[len(most):][rare_nth]
        hit = np.flatnonzero(made != 0)
        put = made[hit]
        seq[hit] = put
        keep = np.ones(len(seq), dtype=bool)
        keep[hit + 1] = False
        seq = seq[keep]
        parts = parts[chosen]
        rules.append(parts)
        every = np.concatenate(lengths)
        lengths.append(every[parts].sum(axis=1))
        rounds.append(len(chosen))
        symbol_counts = np.bincount(put, minlength=total + len(chosen)) + np.r_[symbol_counts, np.zeros(len(chosen), dtype=np.int64)]
        np.subtract.at(symbol_counts, parts.reshape(-1), np.repeat(symbol_counts[total:], 2))
        total += len(chosen)
    return Grammar(ids.astype(np.uint32), np.concatenate(rules).astype(np.uint32) if rules else np.zeros((0, 2), np.uint32),
                   np.concatenate(lengths[1:]).astype(np.uint32) if rules else np.zeros(0, np.uint32),
                   np.array(rounds, dtype=np.uint32), seq.astype(np.uint32))


def expand(g: Grammar, symbols: np.ndarray) -> np.ndarray:
    """Token ids of a run of symbols: each rule is expanded once, then every symbol's ids are copied.

    The rules of a round stand for places that do not overlap, so all expansions together are bounded by
    the rounds times the shard's ids over the least count of a rule."""
    size = g.symbol_lengths()
    start = np.cumsum(size) - size  # of each symbol's ids in flat
    flat = np.empty(int(size.sum()), dtype=np.uint32)
    flat[:len(g.ids)] = g.ids
    first = len(g.ids)
    for n in g.rounds.astype(int):
        made = g.rules[first - len(g.ids):first - len(g.ids) + n].reshape(-1)
        flat[start[first]:start[first] + int(size[first:first + n].sum())] = _copied(flat, start, size, made)
        first += n
    return _copied(flat, start, size, symbols)


def _copied(flat: np.ndarray, start: np.ndarray, size: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The ids of each symbol, flat[start:start + size], one after the other."""
    n = size[symbols]
    ends = np.cumsum(n)
    at = np.repeat(start[symbols] - ends + n, n)
    at += np.arange(len(at))
    return flat[at]


def decode_range(g: Grammar, start: int, n: int) -> np.ndarray:
    """Ids [start, start + n) of a shard; only the symbols that hold them are expanded."""
    ends = np.cumsum(g.symbol_lengths()[g.symbols])
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, start + n, side="left")
    skip = start - (int(ends[a - 1]) if a else 0)
    return expand(g, g.symbols[a:b + 1])[skip:skip + n]


_FIELDS = ("doc_ids", "null_ids", "sizes", "ids", "rules", "lengths", "rounds", "symbols")
SCHEMA = "part int, shard int, n_tokens long, " + ", ".join(f"{f} binary" for f in _FIELDS)


def _row(part: int, shard: int, docs: list, texts: list[np.ndarray], p: TokenFileParams):
    tokens = np.concatenate(texts)
    g = compress(tokens, p)
    values = (np.array([0 if d is None else d for d in docs], dtype="<i8"), np.array([d is None for d in docs], dtype=np.uint8),
              np.array([len(t) for t in texts], dtype="<u4"), g.ids, g.rules, g.lengths, g.rounds, g.symbols)
    cols = [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(tokens)], pa.int64())]
    return pa.RecordBatch.from_arrays([*cols, *(pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values)],
                                      names=["part", "shard", "n_tokens", *_FIELDS])


def grammar_of(row: dict) -> Grammar:
    u4 = {f: np.frombuffer(row[f], dtype="<u4") for f in ("ids", "rules", "lengths", "rounds", "symbols")}
    return Grammar(u4["ids"], u4["rules"].reshape(-1, 2), u4["lengths"], u4["rounds"], u4["symbols"])


def write_token_file(docs: DataFrame, path: str, p: TokenFileParams = TokenFileParams()) -> None:
    """Encode every whole text, append the end id, and write the shards in ascending doc_id order."""
    with_package(docs.sparkSession)

    def run(batches):
        encoder, part, shard, held, texts, size = byte_encoder(p.tokenizer), TaskContext.get().partitionId(), 0, [], [], 0
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), encoder.ids_of(b.column(1).to_pylist())):
                texts.append(np.append(ids, ids.dtype.type(END)))
                held.append(doc)
                size += len(texts[-1])
                if size >= p.shard_tokens:
                    yield _row(part, shard, held, texts, p)
                    shard, held, texts, size = shard + 1, [], [], 0
        if held:
            yield _row(part, shard, held, texts, p)

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Per document: part, shard, nth (place in the shard), at (ids before it in the shard), doc_id, ids."""
    return _decoded(spark, path, "ids array<long>", lambda ids: ids.tolist(), pa.list_(pa.int64()))


def _decoded(spark: SparkSession, path: str, column: str, value, kind) -> DataFrame:
    with_package(spark)
    name = column.split(" ")[0]

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                tokens = expand(grammar_of(row), np.frombuffer(row["symbols"], dtype="<u4"))
                sizes = np.frombuffer(row["sizes"], dtype="<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                none = np.frombuffer(row["null_ids"], dtype=np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), row["part"], dtype=np.int32)), pa.array(np.full(len(sizes), row["shard"], dtype=np.int32)),
                     pa.array(ends - sizes), pa.array(np.frombuffer(row["doc_ids"], dtype="<i8"), mask=none), pa.array(sizes),
                     pa.array([value(tokens[e - n:e]) for e, n in zip(ends, sizes)], kind)],
                    names=["part", "shard", "at", "doc_id", "n_tokens", name])

    return spark.read.schema(SCHEMA).parquet(path).mapInArrow(run, f"part int, shard int, at long, doc_id long, n_tokens long, {column}")


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written file: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Starts are prefix sums in two levels: shards within a task's part, and parts (one number a writing task)."""
    shards = spark.read.schema(SCHEMA).parquet(path).select("part", "shard", "n_tokens")
    parts, before = {}, 0
    for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        parts[r["part"]] = before
        before += r["n"]
    ahead = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0)).alias("in_part")).join(
        spark.createDataFrame(list(parts.items()), "part int, before long"), "part")
    crc = _decoded(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4", copy=False)), pa.int64())
    return crc.join(offsets, ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("in_part") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")

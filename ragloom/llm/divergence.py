"""Source divergence audit: how the term shares of each source differ from the other sources and from its language.

First pass: exact document frequencies per (language, term); terms in at least ``min_docs`` documents of a
language are kept. The kept terms of a language are dealt into shards by hash, and a task builds a minimal
perfect hash per shard (hash and displace): buckets of terms, largest first, get the first displacement that puts
all their terms on free slots, and the last single ones are sent to the slots left. The stored terms stand in
slot order, so a look-up is verified by the term itself. The second pass counts all texts again with the shards
broadcast: a token's hash gives shard and slot, and the stored term decides; each group (language, source)
has a dense array of slots per shard, which the task adds to and sends on where not zero.

Only ``broadcast_bytes`` of shards are broadcast at a time. A larger vocabulary takes several second passes,
each over all texts with the next part of the shards, so no task or driver holds more.

Shares: p = 1 + floor(1e9 (count + 5) / (N + 5 V)) in exact arithmetic. The pair distances of a language are
sums over its shards and blocks of its sources, so a task holds at most two blocks of dense slots.

Defined results: a null text, language or source is empty; a text without terms counts for its group alone;
repeated rows are separate documents; very long texts and terms are counted whole; a language without kept terms has
pairs of value 0 and no terms; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragloom.llm.common import materialize, with_package

#: Byte -> byte of a term: A-Z lower-cased; bytes that are no ASCII letter and not beyond ASCII part terms.
LETTERS = np.full(256, ord(" "), dtype=np.uint8)
LETTERS[97:123], LETTERS[65:91], LETTERS[128:] = np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)


@dataclass(frozen=True)
class DivergenceParams:
    min_docs: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    top_terms: int = 50
    shard_terms: int = 8192           # kept terms of a shard, on average
    broadcast_bytes: int = 64 << 20   # shards broadcast in one second pass
    task_bytes: int = 64 << 20        # dense slots that a task holds before it sends them on
    block_sources: int = 128          # sources of a language compared in one task


def terms_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """All terms in order: codes and the row of each, and the distinct terms that the codes number. No text is null."""
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, dtype=np.int32)
    data = LETTERS[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)]
    clean = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(data)])
    lists = pc.ascii_split_whitespace(clean)
    coded = lists.flatten().dictionary_encode()
    codes, row = coded.indices.to_numpy(), np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    blank = pc.index(coded.dictionary, "").as_py()  # before the first and after the last space
    if blank >= 0:
        codes, row = codes[codes != blank], row[codes != blank]
    return codes, row, coded.dictionary


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(lang, term, df) of all terms; a batch sends sums, which the task adds up before the shuffle."""
    def run(batches):
        for b in batches:
            langs = b.column(0).dictionary_encode()
            codes, row, terms = terms_of(b.column(2))
            k = max(1, len(terms))
            once = np.unique(row * k + codes)  # a term counts once a document
            key, df = np.unique(langs.indices.to_numpy()[once // k].astype(np.int64) * k + once % k, return_counts=True)
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(key // k)), terms.take(pa.array(key % k)), pa.array(df.astype(np.int64))],
                                             names=["lang", "term", "df"])

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, term string, df long").groupBy("lang", "term").agg(F.sum("df").alias("df"))


def hashes_of(terms: list[bytes], seed: int = 42) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in terms), dtype=np.uint64, count=len(terms))


def _mixed(h: np.ndarray, d) -> np.ndarray:
    """A second hash of 64-bit hashes and displacements (multiply and shift, modulo 2**64)."""
    x = (h ^ (np.asarray(d, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(11)


class PerfectHash:
    """A minimal perfect hash of n terms with the terms in slot order. place[b] >= 0: displacement of bucket b; below: its slot, -1 - slot."""

    def __init__(self, seed: int, place: np.ndarray, terms: np.ndarray):
        self.seed, self.place, self.terms = seed, place, terms

    @classmethod
    def build(cls, terms: list[bytes]) -> PerfectHash:
        n, seed = len(terms), 42
        while True:  # another seed where two terms share a 64-bit hash, or a bucket finds no room
            h = hashes_of(terms, seed)
            if len(np.unique(h)) == n and (got := cls._displace(h)) is not None:
                slots, place = got
                ordered = np.empty(n, dtype=object)
                ordered[slots] = np.array(terms, dtype=object)
                return cls(seed, place, ordered)
            seed += 1

    @staticmethod
    def _displace(h: np.ndarray, tries: int = 1 << 14) -> tuple[np.ndarray, np.ndarray] | None:
        n = len(h)
        of = (h >> np.uint64(40)) % np.uint64(max(1, n // 4))
        by = np.argsort(of, kind="stable")
        ends = np.r_[np.flatnonzero(np.diff(of[by])) + 1, n]
        starts = np.r_[0, ends[:-1]]
        place, used, slots = np.zeros(max(1, n // 4), dtype=np.int64), np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
        first = np.arange(64, dtype=np.uint64)[:, None]
        free = None
        for b in np.argsort(starts - ends, kind="stable"):
            mine = by[starts[b]:ends[b]]
            bucket = int(of[mine[0]])
            if len(mine) == 1:
                free = list(np.flatnonzero(~used)[::-1]) if free is None else free
                slots[mine[0]] = free.pop()
                place[bucket] = -1 - slots[mine[0]]
                continue
            for at in range(0, tries, 64):
                spots = _mixed(h[mine][None, :], first + np.uint64(at)) % np.uint64(n)
                ok = ~used[spots].any(axis=1)
                if len(mine) > 1:
                    ok &= (np.diff(np.sort(spots, axis=1), axis=1) != 0).all(axis=1)
                if ok.any():
                    d = int(ok.argmax())
                    slots[mine] = spots[d]
                    used[spots[d]] = True
                    place[bucket] = at + d
                    break
            else:
                return None
        return slots, place

    def slots(self, terms: list[bytes]) -> np.ndarray:
        """The slot of each term, -1 where the stored term is another."""
        asked = np.empty(len(terms), dtype=object)
        asked[:] = terms
        h = hashes_of(terms, self.seed)
        d = self.place[((h >> np.uint64(40)) % np.uint64(len(self.place))).astype(np.int64)]
        at = np.where(d >= 0, (_mixed(h, np.maximum(d, 0)) % np.uint64(len(self.terms))).astype(np.int64), -1 - d)
        return np.where(self.terms[at] == asked, at, -1)


SHARD_COLUMNS = "lang string, shard int, seed int, place array<int>, terms array<string>, bytes long"


def build_shards(kept: DataFrame) -> DataFrame:
    """One row per (lang, shard): the perfect hash of its terms."""
    def run(key, t):
        mph = PerfectHash.build(t.column("term").cast(pa.binary()).to_pylist())
        size = sum(map(len, mph.terms)) + 64 * len(mph.terms)  # with the objects' heads
        return pa.table([pa.array([key[0].as_py()], pa.string()), pa.array([key[1].as_py()], pa.int32()), pa.array([mph.seed], pa.int32()),
                         pa.array([mph.place], pa.list_(pa.int32())), pa.array([[x.decode() for x in mph.terms]], pa.list_(pa.string())),
                         pa.array([size], pa.int64())], names=["lang", "shard", "seed", "place", "terms", "bytes"])

    return kept.groupBy("lang", "shard").applyInArrow(run, SHARD_COLUMNS)


def shard_of(term: Column, shards: Column) -> Column:
    return F.pmod(F.xxhash64(term), shards.cast("long")).cast("int")


def _places(of: list, codes: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Slot of each code among a language's slots here, -1 for a term that is not kept (or in no shard here)."""
    shards, hashes, first, _ = of
    out = np.full(len(words), -1, dtype=np.int64)
    asked = [words[c] for c in codes]
    shard = hashes_of(asked).view(np.int64) % shards
    by = np.argsort(shard, kind="stable")
    for at in np.split(by, np.flatnonzero(np.diff(shard[by])) + 1) if len(by) else ():
        s = int(shard[at[0]])
        if s in hashes:
            got = hashes[s].slots([asked[i] for i in at])
            out[codes[at]] = np.where(got >= 0, got + first[s], -1)
    return out


def recount(docs: DataFrame, tables: list, p: DivergenceParams) -> DataFrame:
    """(lang, source, shard, slot, n) over all texts, for the given shards (rows lang, shards, shard, seed, place, terms)."""
    sent = docs.sparkSession.sparkContext.broadcast([(r.lang, r.shards, r.shard, r.seed, np.array(r.place, dtype=np.int64), [x.encode() for x in r.terms]) for r in tables])

    def run(batches):
        index = {}  # lang -> number of its shards, {shard: perfect hash}, {shard: first of its slots here}, all slots here
        for lang, shards, shard, seed, place, terms in sent.value:
            stored = np.empty(len(terms), dtype=object)
            stored[:] = terms
            of = index.setdefault(lang, [shards, {}, {}, 0])
            of[1][shard], of[2][shard] = PerfectHash(seed, place, stored), of[3]
            of[3] += len(terms)
        slots, held = {}, 0

        def flush():
            for (lang, source), dense in slots.items():
                for shard, first in index[lang][2].items():
                    own = dense[first:first + len(index[lang][1][shard].terms)]
                    at = np.flatnonzero(own)
                    zero = np.zeros(len(at), dtype=np.int32)
                    names = [pa.DictionaryArray.from_arrays(zero, pa.array([x], pa.string())).cast(pa.string()) for x in (lang, source)]
                    yield pa.RecordBatch.from_arrays([*names, pa.array(zero + np.int32(shard)), pa.array(at.astype(np.int32)), pa.array(own[at])],
                                                     names=["lang", "source", "shard", "slot", "n"])
            slots.clear()

        for b in batches:
            name = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            by = sorted(range(len(name)), key=name.__getitem__)  # a group's documents together
            name = [name[k] for k in by]
            codes, row, terms = terms_of(b.column(2).take(pa.array(by, pa.int64())))
            starts = [k for k in range(len(name)) if k == 0 or name[k] != name[k - 1]]
            ends = np.searchsorted(row, [*starts, len(name)])
            groups = [(name[s], codes[a:z]) for s, a, z in zip(starts, ends[:-1], ends[1:]) if z > a and name[s][0] in index]
            words, known = terms.cast(pa.binary()).to_pylist(), {}
            for (lang, source), mine in groups:
                if lang not in known:  # each distinct term of a language is looked up once a batch
                    known[lang] = _places(index[lang], np.unique(np.concatenate([c for (x, _), c in groups if x == lang])), words)
                if (lang, source) not in slots:
                    if slots and held + 8 * index[lang][3] > p.task_bytes:
                        yield from flush()
                        held = 0
                    slots[lang, source] = np.zeros(index[lang][3], dtype=np.int64)
                    held += 8 * index[lang][3]
                at = known[lang][mine]
                slots[lang, source] += np.bincount(at[at >= 0], minlength=index[lang][3])
        yield from flush()

    return docs.mapInArrow(run, "lang string, source string, shard int, slot int, n long").groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


def rounds(sizes: list, limit: int) -> list[list]:
    """(lang, shard) keys in consecutive rounds of at most ``limit`` bytes each (a single larger shard stands alone)."""
    out, held = [], 0
    for r in sizes:
        if not out or held + r.bytes > limit:
            out.append([])
            held = 0
        out[-1].append((r.lang, r.shard))
        held += r.bytes
    return out


def count_kept_terms(docs: DataFrame, p: DivergenceParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, vocab, shards), (lang, shard, slot, term) and (lang, source, shard, slot, n > 0)."""
    frequent = materialize(document_frequencies(docs).filter(F.col("df") >= p.min_docs).select("lang", "term"))
    sizes = materialize(frequent.groupBy("lang").agg(F.count(F.lit(1)).alias("vocab")).withColumn("shards", F.ceil(F.col("vocab") / p.shard_terms).cast("int")))
    shards = materialize(build_shards(frequent.join(sizes, "lang").select("lang", shard_of(F.col("term"), F.col("shards")).alias("shard"), "term")).join(
        sizes.select("lang", "shards"), "lang"))
    slots = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
    counts = None
    # the shards' names and sizes only: one short row per 8192 kept terms
    for k, part in enumerate(rounds(shards.select("lang", "shard", "bytes").orderBy("lang", "shard").collect(), p.broadcast_bytes)):
        low, high = part[0], part[-1]
        key = F.struct(F.col("lang"), F.col("shard"))
        of = lambda x: F.struct(F.lit(x[0]).alias("lang"), F.lit(x[1]).alias("shard"))
        tables = shards.filter((key >= of(low)) & (key <= of(high))).collect()  # at most broadcast_bytes
        one = materialize(recount(docs, tables, p))
        counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        counts = docs.sparkSession.createDataFrame([], "lang string, source string, shard int, slot int, n long")
    return sizes, slots, counts


def _pair_sums(counts: DataFrame, groups: DataFrame, p: DivergenceParams) -> DataFrame:
    """(lang, a, b, f) for a < b by number: sums over all kept terms, from dense slots of two blocks of sources at a time.

    counts: lang, shard, no, slot, share; groups: lang, shard, width (slots of the shard), no, blank (share of a count of 0), blocks."""
    key = ["lang", "shard", "x", "y"]

    def paired(df):
        block = F.floor(F.col("no") / p.block_sources).cast("int")
        both = df.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return both.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))

    def run(k, found, sources):
        width = sources.column("width")[0].as_py() if sources.num_rows else 0
        no, blank = sources.column("no").to_numpy(), sources.column("blank").to_numpy()
        by = np.argsort(no, kind="stable")
        no, blank = no[by], blank[by]
        dense = np.repeat(blank[:, None], width, axis=1)
        if found.num_rows:
            dense[np.searchsorted(no, found.column("no").to_numpy()), found.column("slot").to_numpy()] = found.column("share").to_numpy()
        x, y = k[2].as_py(), k[3].as_py()
        block = no // p.block_sources
        rows, cols = np.flatnonzero(block == x), np.flatnonzero(block == y)
        a, b, f = [], [], []
        for i in rows:
            to = cols[cols > i]
            a.append(np.full(len(to), no[i]))
            b.append(no[to])
            f.append(np.abs(dense[to] - dense[i]).sum(axis=1))
        cat = lambda c: pa.array(np.concatenate(c) if c else np.empty(0), pa.int64())
        a, b, f = cat(a), cat(b), cat(f)
        return pa.table([pa.array([k[0].as_py()] * len(a), pa.string()), a.cast(pa.int32()), b.cast(pa.int32()), f], names=["lang", "a", "b", "f"])

    left = paired(counts).select(*key, "no", "slot", "share")
    right = paired(groups).select(*key, "no", "blank", "width")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "lang string, a int, b int, f long").groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))


def _share(count: Column, total: Column, v: Column, p: DivergenceParams) -> Column:
    """1 + floor(scale (count + s) / (N + s V)), exact in decimals."""
    top = (count.cast("decimal(19,0)") + F.lit(p.smoothing).cast("decimal(3,0)")) * F.lit(p.scale).cast("decimal(11,0)")
    below = total.cast("decimal(19,0)") + F.lit(p.smoothing).cast("decimal(3,0)") * v.cast("decimal(12,0)")
    return (F.floor_div(top, below) if hasattr(F, "floor_div") else F.call_function("div", top, below)).cast("long") + 1


def audit_sources(docs: DataFrame, p: DivergenceParams = DivergenceParams()) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank; see the module's text."""
    with_package(docs.sparkSession)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    own = docs.select(blank("lang"), blank("source"), blank("text"))
    sizes, slots, counts = count_kept_terms(own, p)
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # numbers of the sources within a language: one row a source, never a document
    groups = own.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("vocab", F.lit(0)).alias("vocab"),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("no"))
    blocks = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / p.block_sources).cast("int")
    groups = materialize(groups.withColumn("blocks", blocks).withColumn("blank", F.when(F.col("vocab") > 0, _share(F.lit(0), F.col("total"), F.col("vocab"), p))))
    shares = materialize(counts.join(groups.select("lang", "source", "no", "blocks", "total", "vocab"), ["lang", "source"]).withColumn(
        "share", _share(F.col("n"), F.col("total"), F.col("vocab"), p)))

    widths = slots.groupBy("lang", "shard").agg(F.count(F.lit(1)).cast("int").alias("width"))
    pairs = _pair_sums(shares, groups.select("lang", "no", "blank", "blocks").join(widths, "lang"), p)
    name = lambda x: groups.select("lang", F.col("no").alias(x), F.col("source").alias(f"source_{x}"))
    # every pair of a language's sources is a row of the result; those of a language without terms have no sum
    listed = name("a").join(name("b"), "lang").filter("a < b").join(pairs, ["lang", "a", "b"], "left").withColumn("f", F.coalesce("f", F.lit(0)))
    both = listed.select("lang", F.col("source_a").alias("source"), F.col("source_b").alias("item"), F.col("f").alias("value")).unionByName(
        listed.select("lang", F.col("source_b").alias("source"), F.col("source_a").alias("item"), F.col("f").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pair_part = both.withColumn("rank", F.row_number().over(order))

    whole = counts.groupBy("lang", "shard", "slot").agg(F.sum("n").alias("all_n"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("all_total"))
    expected = whole.join(langs, "lang").join(sizes.select("lang", "vocab"), "lang").join(slots, ["lang", "shard", "slot"]).select(
        "lang", "shard", "slot", "term", _share(F.col("all_n"), F.col("all_total"), F.col("vocab"), p).alias("q"))
    over = shares.select("lang", "source", "shard", "slot", "share").join(expected, ["lang", "shard", "slot"]).filter("share > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("share") - F.col("q")).alias("value"))
    term_part = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.top_terms)
    return pair_part.withColumn("part", F.lit("pair")).unionByName(term_part.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
gk AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
gp AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM gk JOIN v USING (lang)),
lp AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
       FROM (SELECT lang, term, sum(n) AS n FROM gk GROUP BY ALL) JOIN v USING (lang)),
pf AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pf ON pf.lang = a.lang AND pf.source = a.source AND pf.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM gp JOIN lp USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

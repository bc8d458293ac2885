"""Similarity search (R1-R5, R8): exact top-k cosine.

Physical plan of ``search_batch`` (R2/R8)::

    chunks scan ─► mapInArrow(score vs broadcast query matrix, per-task top-k) ─►
    hash exchange on query_id (≤ tasks × queries × k rows) ─► WindowGroupLimit / row_number ≤ k

* The chunk table is never shuffled and no (query, chunk) pair is ever emitted: each
  task multiplies an Arrow batch of chunk vectors by the query matrix in NumPy and keeps,
  per query, only candidates that can still be in the global top-k under the total order
  ``score desc, <tie-break columns> asc``.
* The query matrix is broadcast only after the size of what a task holds for it is checked: the vectors in double
  precision and the candidates (``rows × query_bytes ≤ max_broadcast_bytes``). A larger query table never reaches the
  driver: it goes through ``blockjoin.block_join``, an exact join of bounded blocks of chunks and queries.
* Query ids may be of any type. A null or repeated id is an error (one aggregate checks it).
* The threshold (F3) is applied before the local top-k: for a single descending order,
  "threshold then top-k" equals "top-k then threshold", and far fewer rows leave the task.

Three vector forms are accepted: ``dense`` (``array<float>``, fixed width ``dim``),
``sparse`` (``array<int>`` of hashed-token buckets, see ``embedding.token_buckets``) and
``text`` (a string column hashed into bucket counts inside the task, the same vectors as
``sparse`` without materialising them). Hashed counts are exact integers, so those scores
equal a SQL evaluation bit for bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ragloom.functions.vectors import cosine
from ragloom.params import DEFAULT_SERVICE_K, SearchParams
from ragloom.session import ship_package


class DimensionError(ValueError):
    """A vector of another width than the index (F6/R3): the whole write or search fails."""


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- matrices


def _matrix(col: pa.Array, mode: str, dim: int) -> np.ndarray:
    """Arrow list column -> (rows × dim) float64 matrix. Null/empty vectors -> zero rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if mode == "text":
        from ragloom.operators.embedding import bucket_counts

        return bucket_counts(col, dim)
    if mode == "sparse":
        parent = pc.list_parent_indices(col).to_numpy(zero_copy_only=False).astype(np.int64)
        vals = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(vals) and (vals.min() < 0 or vals.max() >= dim):
            raise DimensionError(f"token bucket outside [0, {dim})")
        return np.bincount(parent * dim + vals, minlength=n * dim).astype(np.float64).reshape(n, dim)
    lengths = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    bad = (lengths != 0) & (lengths != dim)
    if bad.any():
        raise DimensionError(f"vector of width {int(lengths[bad][0])} where {dim} is required")
    m = np.zeros((n, dim), dtype=np.float64)
    rows = np.nonzero(lengths == dim)[0]
    if len(rows):
        m[rows] = pc.list_flatten(col).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return m


def check_query_ids(queries: DataFrame, query_id: str) -> int:
    """The number of queries; a null or repeated id is an error, as its hits could not be told apart."""
    n, ids, distinct = queries.agg(F.count(F.lit(1)), F.count(query_id), F.countDistinct(query_id)).first()
    if ids < n:
        raise ValueError(f"{n - ids} of {n} queries have no {query_id}")
    if distinct < ids:
        raise ValueError(f"{query_id} repeats: {distinct} distinct ids in {ids} queries")
    return n


def _query_matrix(queries: DataFrame, query_id: str, vec: str, mode: str, dim: int):
    tbl = queries.select(F.col(query_id).alias("qid"), F.col(vec).alias("v")).toArrow()
    ids = tbl.column("qid").combine_chunks()
    q = narrowed(_matrix(tbl.column("v"), mode, dim))
    return ids, q, row_norms(q)


def narrowed(m: np.ndarray) -> np.ndarray:
    """The matrix in the narrowest type that holds it exactly: counts up to 255, single or double precision."""
    with np.errstate(invalid="ignore", over="ignore"):
        kind = next((t for t in (np.uint8, np.float32) if (m.astype(t) == m).all()), np.float64)
    return np.ascontiguousarray(m, dtype=kind)


# --------------------------------------------------------------------------- kernel

STEP = 1024  # queries and rows of one score matrix
PANEL = 8    # steps of rows that are in single precision at a time


def _unit32(m: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Rows of length 1 in single precision, made from doubles a few thousand rows at a time."""
    out = np.empty(m.shape, dtype=np.float32)
    with np.errstate(divide="ignore", invalid="ignore"):
        for lo in range(0, len(m), STEP):
            out[lo:lo + STEP] = m[lo:lo + STEP].astype(np.float64) / norm[lo:lo + STEP, None]
    return out


def row_norms(m: np.ndarray) -> np.ndarray:
    """Lengths of the rows in double precision, whatever the type of the matrix."""
    out = np.empty(len(m))
    for lo in range(0, len(m), STEP):
        x = m[lo:lo + STEP].astype(np.float64, copy=False)
        out[lo:lo + STEP] = np.sqrt(np.einsum("ij,ij->i", x, x))
    return out


def _first_of_each(qi: np.ndarray, k: int) -> np.ndarray:
    """Mask of the first ``k`` entries of each run of equal values."""
    return (np.arange(len(qi)) - np.searchsorted(qi, qi, side="left")) < k


def _exact(q: np.ndarray, qn: np.ndarray, m: np.ndarray, cn: np.ndarray, qi: np.ndarray, ri: np.ndarray) -> np.ndarray:
    """Cosines in double precision of the pairs ``(qi, ri)``: of most pairs by one product, of few by their rows."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if len(qi) * 16 > len(q) * len(m):
            return ((q.astype(np.float64) @ m.astype(np.float64).T) / np.multiply.outer(qn, cn))[qi, ri]
        out, some = np.empty(len(qi)), max(1, (1 << 21) // max(1, q.shape[1]))
        for lo in range(0, len(qi), some):
            a, b = qi[lo:lo + some], ri[lo:lo + some]
            out[lo:lo + some] = np.einsum("ij,ij->i", q[a].astype(np.float64), m[b].astype(np.float64)) / (qn[a] * cn[b])
        return out


DIGITS = ((3, 8), (2, 12), (1, 24))  # rows in one number of single precision, bits of each: 24 bits are exact
TILE = 256        # queries of one product with a full sheet
STRETCH = 1.1     # longest row of a sheet, in lengths of the shortest
LEAST = 128       # shorter sheets are not made for its sake
MOST_K = 64       # beyond it, the state of a query is no small array


def _sheet(m: np.ndarray, rows: np.ndarray, digits: int, bits: int) -> np.ndarray:
    """Numbers that hold ``digits`` rows each, one digit a row; the rows are dealt digit by digit."""
    wide = -(-len(rows) // (8 * digits)) * 8
    packed = np.zeros((wide, m.shape[1]), dtype=np.float32)
    for d in range(digits):
        part = rows[d * wide:(d + 1) * wide]
        packed[:len(part)] += m[part].astype(np.float32) * np.float32(1 << bits * d)
    return packed


def _digit_hits(x: np.ndarray, least: np.ndarray, digits: int, bits: int) -> tuple:
    """(query, digit, column, value) of the digits of at least ``least`` (one a query) in a product of packed rows."""
    mask, wide = (1 << bits) - 1, x.shape[1]
    if digits == 1:
        at = np.flatnonzero(x.max(axis=1) >= least)
    else:
        whole = x.astype(np.int32)
        # a digit of three is a byte; the greatest of two has the greatest number, or is the greatest remainder
        most = whole.view(np.uint8).max(axis=1) if digits == 3 else np.maximum(whole.max(axis=1) >> bits, (whole & mask).max(axis=1))
        at = np.flatnonzero(most >= least)
    if not len(at):
        return ()
    if digits == 1:
        values = x[at]
    elif digits == 2:
        values = np.concatenate([whole[at] & mask, whole[at] >> bits], axis=1)
    else:
        values = whole[at].view(np.uint8)
    hit = values >= least[at].astype(values.dtype)[:, None]
    eights = np.flatnonzero(hit.view(np.uint64))  # few: ``wide`` is a multiple of eight
    e, b = np.nonzero(hit.reshape(-1, 8)[eights])
    qi, place = np.divmod(eights[e] * 8 + b, values.shape[1])
    found = values[qi, place].astype(np.int64)
    d, col = (place % 4, place // 4) if digits == 3 else np.divmod(place, wide)
    return at[qi], d, col, found


def _top_counts(q: np.ndarray, qn: np.ndarray, m: np.ndarray, cn: np.ndarray, k: int, floor: np.ndarray, min_score, round_digits):
    """``top_rows`` of count vectors. The product of two is a whole number below ``|q| |row|``, so two or three rows fit into
    the exact 24 bits of single precision as digits of one number, and one product scores them all. Rows and queries go by
    length, so that a digit of at least ``floor |q| |shortest row|`` stands for each score that may count. The first rows
    are scored one by one; queries that have no positive floor after them (few rows share a bucket with them) are, too."""
    base = floor.astype(np.float64) if min_score is None else np.maximum(floor, min_score)
    less = 1e-9 if round_digits is None else 1e-9 + 10.0 ** -round_digits
    score, row = np.full((len(q), k), -np.inf), np.full((len(q), k), len(m), dtype=np.int64)

    def put(qi, ri, sc):
        """Takes rows in that may be among the best."""
        hit = np.unique(qi)
        qi, ri, sc = np.r_[np.repeat(hit, k), qi], np.r_[row[hit].ravel(), ri], np.r_[score[hit].ravel(), sc]
        at = np.lexsort((ri, -sc, qi))
        at = at[_first_of_each(qi[at], k)]
        score[hit], row[hit] = sc[at].reshape(-1, k), ri[at].reshape(-1, k)

    def put_any(some, lo):
        found = _top_any(q[some], qn[some], m[lo:], cn[lo:], k, np.maximum(base[some], score[some, -1]), None, round_digits) if len(some) and len(m) > lo else None
        if found is not None and len(found[0]):
            put(some[found[0]], found[1] + lo, found[2])

    start = 0
    if (base[qn > 0] <= less).any():
        start = STEP
        seed = _top_any(q, qn, m[:STEP], cn[:STEP], k, base, None, round_digits)
        if len(seed[0]):
            put(*seed)
    low = np.maximum(base, score[:, -1])
    put_any(np.flatnonzero((low <= less) & (qn > 0)), start)
    asks = np.flatnonzero((low > less) & (qn > 0))
    asks = asks[np.argsort(qn[asks], kind="stable")]
    rest = np.argsort(cn[start:], kind="stable") + start  # copies stay in tie-break order
    rest = rest[cn[rest] > 0]
    top = 0
    while top < len(rest) and len(asks):
        rows, sheets = rest[top:top + 3 * STEP], {}
        rows = rows[:max(LEAST, np.searchsorted(cn[rows], STRETCH * cn[rows[0]], side="right"))]
        top += len(rows)
        tile = min(16 * TILE, TILE * 3 * STEP // len(rows))
        for a in range(0, len(asks), tile):
            some = asks[a:a + tile]
            low = np.maximum(base[some], score[some, -1])
            digits, bits = next((d for d in DIGITS if qn[some[-1]] * cn[rows[-1]] < (1 << d[1]) - 1), (0, 0))
            if not digits:  # not exact in single precision
                again = np.sort(rows)
                found = _top_any(q[some], qn[some], m[again], cn[again], k, low, None, round_digits)
                if found is not None and len(found[0]):
                    put(some[found[0]], again[found[1]], found[2])
                continue
            if digits not in sheets:
                sheets[digits] = _sheet(m, rows, digits, bits)
            packed = sheets[digits]
            least = np.maximum(np.ceil((low - less) * qn[some] * cn[rows[0]] * (1 - 1e-9)), 1).astype(np.int64)
            found = _digit_hits(q[some].astype(np.float32) @ packed.T, least, digits, bits)
            if not len(found):
                continue
            qi, d, col, product = found
            qi, ri = some[qi], rows[d * len(packed) + col]
            sc = product / (qn[qi] * cn[ri])
            if round_digits is not None:
                sc = np.round(sc, round_digits)
            ok = (sc >= base[qi]) & ((sc > score[qi, -1]) | ((sc == score[qi, -1]) & (ri < row[qi, -1])))
            if ok.any():
                put(qi[ok], ri[ok], sc[ok])
    qi, at = np.nonzero(score > -np.inf)
    return qi, row[qi, at], score[qi, at]


def top_rows(q: np.ndarray, qn: np.ndarray, m: np.ndarray, cn: np.ndarray, k: int, floor: np.ndarray, min_score=None,
             round_digits: int | None = None, allowed=None):
    """(query, row, score) of each query's ``k`` best rows by cosine, equals by row number, among the scores of at least
    ``floor`` (one a query); by query, best first. Rows stand in tie-break order. ``allowed(a, b, lo, hi)`` is the mask of
    the pairs that count. Counts up to 255 (``narrowed``) go several rows to a product."""
    if allowed is None and q.dtype == m.dtype == np.uint8 and k <= MOST_K and len(m) > STEP:
        return _top_counts(q, qn, m, cn, k, floor, min_score, round_digits) if len(q) else None
    return _top_any(q, qn, m, cn, k, floor, min_score, round_digits, allowed)


def _top_any(q: np.ndarray, qn: np.ndarray, m: np.ndarray, cn: np.ndarray, k: int, floor: np.ndarray, min_score=None,
             round_digits: int | None = None, allowed=None):
    """``top_rows`` of any numbers.

    One score matrix of ``STEP`` by ``STEP`` exists at a time, in single precision, like ``PANEL`` steps of rows: it only tells which pairs may reach
    the k-th best score so far. Those are scored in double precision, so the result is that of doubles."""
    error = 1e-6 + 1.2e-7 * m.shape[1] + (0.0 if round_digits is None else 10.0 ** -round_digits)  # of a single-precision score
    starts = range(0, len(q), STEP)
    lows = [floor[a:a + STEP].astype(np.float64) if min_score is None else np.maximum(floor[a:a + STEP], min_score) for a in starts]
    fulls = [np.zeros(len(low), dtype=bool) for low in lows]  # has k rows: a later row must beat the last of them
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for _ in starts]
    for top in range(0, len(m), PANEL * STEP):
        unit = _unit32(m[top:top + PANEL * STEP], cn[top:top + PANEL * STEP])
        for j, a in enumerate(starts):
            low, full, best, b = lows[j], fulls[j], found[j], min(len(q), a + STEP)
            rows = _unit32(q[a:b], qn[a:b])
            for lo in range(top, top + len(unit), STEP):
                hi = min(top + len(unit), lo + STEP)
                with np.errstate(invalid="ignore"):
                    s = rows @ unit[lo - top:hi - top].T
                if allowed is not None:
                    s[~allowed(a, b, lo, hi)] = np.nan
                w, hit = hi - lo, s >= (low - error)[:, None].astype(np.float32)
                hits = np.count_nonzero(hit)
                if not hits:
                    continue
                many = np.flatnonzero(np.count_nonzero(hit, axis=1) > 4 * k) if w > k and hits > 4 * k else ()
                if len(many):  # the k-th best of this step is a bound, too
                    some = np.where(np.isfinite(s[many]), s[many], -np.inf)
                    hit[many] &= s[many] >= (np.partition(some, w - k, axis=1)[:, w - k] - 2 * error)[:, None].astype(np.float32)
                qi, ri = np.divmod(np.flatnonzero(hit), w)
                sc = _exact(q[a:b], qn[a:b], m[lo:hi], cn[lo:hi], qi, ri)
                if round_digits is not None:
                    sc = np.round(sc, round_digits)
                ok = np.isfinite(sc) & np.where(full[qi], sc > low[qi], sc >= low[qi])
                if not ok.any():
                    continue
                qi, ri, sc = np.r_[best[0], qi[ok] + a], np.r_[best[1], ri[ok] + lo], np.r_[best[2], sc[ok]]
                order = np.lexsort((ri, -sc, qi))
                order = order[_first_of_each(qi[order], k)]
                best = found[j] = qi, ri, sc = qi[order], ri[order], sc[order]
                n = np.bincount(qi - a, minlength=b - a)
                full[:] = n == k
                low[full] = sc[np.cumsum(n)[full] - 1]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else None


def _reduce(cand: pa.Table, k: int, order: list[str]) -> pa.Table:
    keys = [("__q", "ascending"), ("score", "descending"), *((c, "ascending") for c in order)]
    at = pc.sort_indices(cand, sort_keys=keys, null_placement="at_end").to_numpy()
    return cand.take(pa.array(at[_first_of_each(cand.column("__q").to_numpy()[at], k)])).combine_chunks()


class CosineScorer:
    """Cosine of a batch against one block of queries."""

    def __init__(self, vec: str, mode: str, dim: int):
        self.vec, self.mode, self.dim = vec, mode, dim

    def features(self, rb: pa.RecordBatch):
        """What every block needs of the batch, built once."""
        m = _matrix(rb.column(self.vec), self.mode, self.dim)
        if self.mode != "dense":
            m = narrowed(m)
        return m, row_norms(m)

    def select(self, features, state, k: int, floor: np.ndarray, min_score, round_digits):
        (m, cn), (_, q, qn) = features, state[:3]
        return top_rows(q, qn, m, cn, k, floor, min_score, round_digits)


class DenseScores:
    """Base of scorers that give a whole ``(queries × rows)`` matrix: ``scores(features, state, lo, hi)``."""

    positive_only = True
    cells = 1 << 22

    def select(self, features, state, k: int, floor: np.ndarray, min_score, round_digits):
        n, best = self.rows(features), None
        for lo in range(0, n, max(16, self.cells // max(1, len(state[0])))):
            hi = min(n, lo + max(16, self.cells // max(1, len(state[0]))))
            s = self.scores(features, state, lo, hi)
            if round_digits is not None:
                s = np.round(s, round_digits)
            ok = np.isfinite(s) & (s >= (floor if min_score is None else np.maximum(floor, min_score))[:, None])
            if self.positive_only:
                ok &= s > 0
            w = hi - lo
            if w > k:
                sm = np.where(ok, s, -np.inf)
                ok &= sm >= np.partition(sm, w - k, axis=1)[:, w - k][:, None]
            qi, ri = np.nonzero(ok)
            new = (qi, ri + lo, s[qi, ri])
            if best is not None:
                new = tuple(np.r_[x, y] for x, y in zip(best, new))
            at = np.lexsort((new[1], -new[2], new[0]))
            at = at[_first_of_each(new[0][at], k)]
            best = tuple(x[at] for x in new)
        return best


def _in_order(rb: pa.RecordBatch, order: list[str]) -> pa.RecordBatch:
    """The batch in tie-break order (binary string order)."""
    if not order or not rb.num_rows:
        return rb
    return rb.take(pc.sort_indices(rb.select(order), sort_keys=[(c, "ascending") for c in order], null_placement="at_end"))


def topk_kernel(blocks: list, scorer, drop: list[str], k: int, min_score, order: list[str], out_schema: pa.Schema, round_digits: int | None = None):
    """``mapInArrow`` body: score each batch against every query block and keep, per query, the k best rows
    under ``score desc, order asc``. ``blocks``: broadcasts of ``(query ids, ...)``. Only ``queries × k`` rows per batch
    are materialised, as Arrow rows; they are reduced again whenever half as many more are held, after which a row must
    reach its query's k-th best score to be looked at, and emitted once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[list[pa.Table]] = [[] for _ in blocks]
        held = [0] * len(blocks)
        floors = [np.full(len(b.value[0]), -np.inf) for b in blocks]
        for rb in batches:
            if rb.num_rows == 0:
                continue
            rb = _in_order(rb, order)
            features, rest = scorer.features(rb), rb.drop_columns(drop)
            for j, block in enumerate(blocks):
                state = block.value
                nq = len(state[0])
                found = scorer.select(features, state, k, floors[j], min_score, round_digits) if nq else None
                if found is None or not len(found[0]):
                    continue
                qi, ri, sc = found
                cand = pa.Table.from_batches([rest.take(pa.array(ri))])
                pending[j].append(cand.append_column("__q", pa.array(qi)).append_column("score", pa.array(sc)))
                held[j] += len(qi)
                if held[j] > max(50_000, 3 * nq * k // 2):
                    pending[j] = [_reduce(pa.concat_tables(pending[j]), k, order)]
                    held[j] = pending[j][0].num_rows
                    q, s = (pending[j][0].column(c).to_numpy() for c in ("__q", "score"))
                    n = np.bincount(q, minlength=nq)
                    floors[j][n == k] = s[np.cumsum(n)[n == k] - 1]
        for j, block in enumerate(blocks):
            if pending[j]:
                res = _reduce(pa.concat_tables(pending[j]), k, order)
                ids = block.value[0].take(pa.array(res.column("__q").to_numpy()))
                cols = [res.column(c).cast(out_schema.field(c).type) for c in out_schema.names[1:]]
                yield from pa.table([ids.cast(out_schema.field(0).type), *cols], schema=out_schema).to_batches(max_chunksize=10_000)

    return run


def out_schema(chunks: DataFrame, drop: list[str], id_type: T.DataType = T.LongType()) -> T.StructType:
    fields = [T.StructField("query_id", id_type, True)]
    fields += [f for f in chunks.schema.fields if f.name not in drop]
    fields.append(T.StructField("score", T.DoubleType(), True))
    return T.StructType(fields)


def query_bytes(chunks: DataFrame, drop: list[str], k: int, dim: int, text: str | None = None) -> int:
    """Bytes that a task holds for a query of a broadcast: its vector in double precision, and up to ``2 k`` candidates of
    some 16 bytes a column, 512 more for the carried ``text``."""
    columns = [c for c in chunks.columns if c not in drop]
    return dim * 8 + 2 * k * (16 * (len(columns) + 2) + (512 if text in columns else 0))


def _infer_dim(queries: DataFrame, vec: str) -> int:
    row = queries.select(F.size(vec).alias("n")).where("n > 0").limit(1).collect()
    if not row:
        raise DimensionError("no query vector to infer the dimension from")
    return int(row[0]["n"])


def search_candidates(
    chunks: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    vec: str = "embedding",
    query_id: str = "query_id",
    query_vec: str | None = None,
    mode: str = "dense",
    dim: int | None = None,
    min_score: float | None = None,
    order: list[str] | None = None,
    round_digits: int | None = None,
    carry_text: bool = True,
) -> DataFrame:
    """Per-task top-k candidates ``(query_id, <chunk columns>, score)`` against a broadcast of all queries, whose
    size ``search_batch`` has checked."""
    spark = chunks.sparkSession
    ship_package(spark)
    # a text column is hashed in the task and stays in the payload (unless carry_text is
    # off); vectors are dropped
    drop = [] if (mode == "text" and carry_text) else [vec]
    schema = out_schema(chunks, drop, queries.schema[query_id].dataType)
    query_vec = query_vec or vec
    dim = dim or _infer_dim(queries, query_vec)
    block = spark.sparkContext.broadcast(_query_matrix(queries, query_id, query_vec, mode, dim))
    kern = topk_kernel([block], CosineScorer(vec, mode, dim), drop, k, min_score, list(order or []), to_arrow_schema(schema), round_digits)
    return chunks.mapInArrow(kern, schema)


RANK_GROUPS = 16


def rank_within_query(cands: DataFrame, k: int | None, order: list[str], groups: int = RANK_GROUPS) -> DataFrame:
    """Global rank per query under ``score desc, order asc``; keeps ``rank <= k``.

    Every candidate task holds at most k rows per query, so one query meets ``tasks × k`` rows. With a
    ``k`` two levels share them out: the top k of each (query, group of tasks) first, then the top k of at
    most ``groups × k`` rows. ``groups`` grows with the square root of the tasks that one plans for
    (16 for some thousands); 1 is a single level."""
    ordering = [F.col("score").desc(), *[F.col(c).asc() for c in order]]
    if k is not None and groups > 1:
        w1 = Window.partitionBy("query_id", "_grp").orderBy(*ordering)
        cands = (cands.withColumn("_grp", F.pmod(F.spark_partition_id(), F.lit(groups)))
                 .withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_grp", "_r1"))
    w = Window.partitionBy("query_id").orderBy(*ordering)
    out = cands.withColumn("rank", F.row_number().over(w))
    if k is not None:
        out = out.where(F.col("rank") <= k)
    return out


def search_batch(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = SearchParams().k,
    *,
    vec: str = "embedding",
    query_id: str = "query_id",
    query_vec: str | None = None,
    mode: str = "dense",
    dim: int | None = None,
    min_score: float | None = None,
    order: list[str] | None = None,
    max_broadcast_bytes: int = SearchParams().max_broadcast_bytes,
    round_digits: int | None = None,
    carry_text: bool = True,
) -> DataFrame:
    """R2: exact top-k cosine for every row of ``queries`` against every chunk.

    Returns ``query_id, <chunk columns except the vector>, score, rank`` with
    ``rank`` 1..k by ``score desc`` then ``order`` (a total order: pass unique keys).
    Zero vectors never score (cosine undefined). ``min_score`` (F3, inclusive) is
    applied before the ranking, which gives the same rows as after it.
    """
    order = list(order or [])
    if mode not in ("dense", "sparse", "text"):
        raise ValueError(f"mode must be 'dense', 'sparse' or 'text', got {mode!r}")
    if mode in ("sparse", "text") and dim is None:
        raise ValueError(f"{mode} search needs dim")
    query_vec = query_vec or vec
    dim = dim or _infer_dim(queries, query_vec)
    drop = [] if (mode == "text" and carry_text) else [vec]
    if check_query_ids(queries, query_id) * query_bytes(chunks, drop, k, dim, vec) > max_broadcast_bytes:
        from ragloom.operators.blockjoin import block_join

        return block_join(chunks, queries, k, vec=vec, query_id=query_id, query_vec=query_vec, mode=mode, dim=dim, min_score=min_score,
                          order=order, round_digits=round_digits, carry_text=carry_text)
    cands = search_candidates(
        chunks, queries, k, vec=vec, query_id=query_id, query_vec=query_vec, mode=mode, dim=dim,
        min_score=min_score, order=order, round_digits=round_digits, carry_text=carry_text,
    )
    return rank_within_query(cands, k, order)


def search(chunks: DataFrame, query_vector: list[float], k: int = DEFAULT_SERVICE_K, vec: str = "embedding",
           order: list[str] | None = None) -> DataFrame:
    """One query vector, all JVM: cosine by ``zip_with``/``aggregate``, then
    ``orderBy(...).limit(k)``, which plans ``TakeOrderedAndProject`` (k rows per task
    reach the final merge; nothing else is shuffled)."""
    order = list(order or [])
    qv = F.array(*[F.lit(float(x)) for x in query_vector]).cast("array<double>")
    scored = chunks.withColumn("score", cosine(F.col(vec), qv)).where(F.col("score").isNotNull())
    top = scored.orderBy(F.col("score").desc(), *[F.col(c).asc() for c in order]).limit(k)
    return top.drop(vec)


def check_dimension(df: DataFrame, dim: int, vec: str = "embedding") -> DataFrame:
    """Fail the job if any non-empty vector has another width (the reference fails
    the whole write/search). Lazy: the check runs with the next action on the result."""
    bad = (F.size(vec) > 0) & (F.size(vec) != dim)
    return df.withColumn(
        vec,
        F.when(bad, F.raise_error(F.concat(F.lit(f"vector width must be {dim}, got "), F.size(vec).cast("string"))))
        .otherwise(F.col(vec)),
    )


def split_by_dimension(df: DataFrame, dim: int, vec: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """F6, quarantine form: (rows with a usable width or no vector, rows of another width)."""
    bad = (F.size(vec) > 0) & (F.size(vec) != dim)
    return df.where(~bad | F.col(vec).isNull()), df.where(bad)

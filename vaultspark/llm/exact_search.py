"""Operator 12, exact top-k search by inner product: a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it. Sorted by that key
and cut into parts of ``PART_ROWS``, a part is an annulus (or the seam of some) around
pivots, and the directory holds its inner and outer radius and largest norm. For a
query q at distance D from the pivot p, a vector x of an annulus [r, R] has

    d(q, x) >= max(0, D - R, r - D)                  (triangle inequality)
    <q, x>  =  (|q|^2 + |x|^2 - d(q, x)^2) / 2
    <q, x> <=  |q| |x|   and   <q, x> <= <q, p> + |q| R

so every annulus has an upper bound for its scores. A query visits annuli in the order
of these bounds, in three rounds (2, then 16 more, then all that are left), and skips
those whose bound is below its current k-th score: what is skipped cannot be in the
result, so the search is exact. Bounds carry a margin for rounding.

How it runs: queries in blocks of ``QUERY_ROWS`` near one another and parts meet in
groups (part, block), so a part goes once to each block of queries that may still gain
from it; numpy multiplies the two, a slice of queries at a time. Equal vectors are one
entry with their ``k + 1`` smallest ids, equal queries are one search, so copies of one
vector cost nothing. Only pivots are fitted on a sample (``SAMPLE_ROWS`` rows by the
order of their hashes, at most ``SAMPLE_VALUES`` numbers). The driver holds the sample,
the pivots and the directory, which has at most ``MAX_PARTS`` parts: parts grow beyond
that, and with them the memory of a task (8 bytes a number).

Scores are exact integers: products are taken in doubles where no sum can pass 2^53, in
longs below 2^63, else as Python integers.

Defined cases: vectors that are null or hold null, NaN or infinite components take no
part; components and scores beyond a long are the nearest long; vectors of different
lengths are not compared, empty ones are (score 0); a null id is no query and comes
last among ties; rows of one id, also equal ones, are rows of their own, and only the
query's own row is left out; a query without candidates has no rows. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import kept, query, read_columns
from .placing import placed

K = 5
EVERY = 50
SCALE = 256
PIVOTS = 64
SAMPLE_ROWS = 8192
SAMPLE_VALUES = 1 << 20
PART_ROWS = 8192
MAX_PARTS = 1 << 16
QUERY_ROWS = 8192
ROUNDS = (0, 2, 18, MAX_PARTS + 1)
SLICE = 256
LONG = (-(1 << 63), (1 << 63) - 1)


def scaled(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null, no NaN, nothing infinite."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False))), F.lit(False))


def matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length in a list array without nulls."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = np.asarray(lists.offsets)
    values = np.asarray(lists.values)
    dims = np.diff(offsets)
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        yield rows, values[offsets[rows][:, None] + np.arange(dim)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, kept within a long."""
    peak = max((max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0), 1) * max(
        (max(abs(int(b.min())), abs(int(b.max()))) if b.size else 0), 1) * max(a.shape[1], 1)
    if peak < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if peak < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, *LONG).astype(np.int64)


def fit_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of the sample: farthest-first starts, then a few rounds of means."""
    x = sample.astype(np.float64)
    chosen, far = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    centres = x[chosen]
    for _ in range(8):
        near = ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    square = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)
    return np.sqrt(np.maximum(square, 0))


def _pivots(vectors: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Pivots for each length found in the sample."""
    longest = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(longest, 1)))
    sample = vectors.select("v").orderBy(F.xxhash64("v")).limit(rows).toArrow()["v"]
    return {m.shape[1]: fit_pivots(m, count) for _, m in matrices(sample)} if len(sample) else {}


def _keyed(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Vectors with ``dim``, nearest ``pivot``, ``dist`` to it, ``norm`` (squared), ``self`` (exact)."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            dim, pivot = np.zeros(n, np.int32), np.zeros(n, np.int32)
            dist, norm, self_score = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
            for rows, m in matrices(batch["v"]) if n else ():
                to = distances(m, pivots.get(m.shape[1], np.zeros((1, m.shape[1]))))
                dim[rows], pivot[rows] = m.shape[1], to.argmin(1)
                dist[rows] = to.min(1)
                norm[rows] = (m.astype(np.float64) ** 2).sum(1)
                top = max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0
                whole = m if top * top * max(m.shape[1], 1) < 1 << 63 else m.astype(object)
                self_score[rows] = np.clip((whole * whole).sum(1), *LONG).astype(np.int64)
            columns = {name: batch[name] for name in batch.schema.names}
            yield pa.RecordBatch.from_pydict(
                {**columns, "dim": dim, "pivot": pivot, "dist": dist, "norm": norm, "self": self_score})

    more = "dim int, pivot int, dist double, norm double, self long"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(assign, f"{schema}, {more}")


def _upper_bounds(m: np.ndarray, pivots: np.ndarray, entries: dict[str, np.ndarray], starts: np.ndarray) -> np.ndarray:
    """A bound for the scores of each query (row) in each part (column)."""
    q = m.astype(np.float64)
    square = (q * q).sum(1)[:, None]
    size = np.sqrt(square)
    mine = entries["dim"] == m.shape[1]
    p = np.where(mine, entries["pivot"], 0)
    to = distances(m, pivots)[:, p]
    gap = np.maximum(0, np.maximum(to - entries["outer"], entries["inner"] - to))
    bound = (square + entries["norm"] - gap * gap) / 2
    bound = np.minimum(bound, size * np.sqrt(entries["norm"]))
    bound = np.minimum(bound, (q @ pivots.T)[:, p] + size * entries["outer"])
    margin = 1e-9 * (square + entries["norm"] + (pivots * pivots).sum(1)[p] + 1)
    return np.maximum.reduceat(np.where(mine, bound + margin, -np.inf), starts, axis=1)


def _asks(queries: DataFrame, pivots: dict[int, np.ndarray], directory: dict[str, np.ndarray], first: int, last: int) -> DataFrame:
    """``part, block, key, tau, v``: the parts from place ``first`` to ``last`` in the order of
    a query's bounds, as far as they reach its k-th score so far."""
    parts, starts = np.unique(directory["part"], return_index=True)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tau = batch["tau"].fill_null(LONG[0]).to_numpy(zero_copy_only=False)
            for rows, m in matrices(batch["v"]):
                own = pivots.get(m.shape[1], np.zeros((1, m.shape[1])))
                # Slices bound the table of queries and parts.
                step = max(1, (1 << 22) // len(directory["part"]))
                for at in range(0, len(rows), step):
                    some = rows[at:at + step]
                    bound = _upper_bounds(m[at:at + step], own, directory, starts)
                    order = np.argsort(-bound, axis=1, kind="stable")[:, first:last]
                    reach = np.take_along_axis(bound, order, 1)
                    which, place = np.nonzero((reach >= tau[some][:, None]) & np.isfinite(reach))
                    out = batch.take(pa.array(some[which]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(parts[order[which, place]], pa.int64()), out["block"], out["key"], out["tau"], out["v"]],
                        names=["part", "block", "key", "tau", "v"])

    return queries.select("block", "key", "tau", "v").mapInArrow(ask, "part long, block long, key binary, tau long, v array<bigint>")


def _search(asks: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """``key, score, id``: for each query the ``k`` best entries of each part it asks."""
    asks = kept(asks, "asks")
    pairs = asks.select(F.col("part").alias("p"), F.col("block").alias("b")).distinct()
    offered = index.join(pairs, F.col("part") == F.col("p")).select("p", "b", "v", "ids")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, scores, ids = [], [], []
        id_lists = right["ids"].combine_chunks() if right.num_rows else None
        theirs = {m.shape[1]: (rows, m) for rows, m in matrices(right["v"])} if right.num_rows else {}
        tau_of = left["tau"].fill_null(LONG[0]).to_numpy()
        for rows, m in matrices(left["v"]) if left.num_rows else ():
            if m.shape[1] not in theirs:
                continue
            at, vectors = theirs[m.shape[1]]
            for low in range(0, len(rows), SLICE):
                some = rows[low:low + SLICE]
                table = products(m[low:low + SLICE], vectors)
                least = tau_of[some]
                if table.shape[1] > k:
                    least = np.maximum(least, np.partition(table, table.shape[1] - k, axis=1)[:, -k])
                which, place = np.nonzero(table >= least[:, None])
                # Ids of the entries, unrolled: each entry has at most k of them.
                got = id_lists.take(pa.array(at[place]))
                counts = np.diff(np.asarray(got.offsets))
                flat = got.flatten()
                q = np.repeat(which, counts)
                s = np.repeat(table[which, place], counts)
                missing = np.asarray(flat.is_null())
                i = flat.fill_null(0).to_numpy()
                order = np.lexsort((i, missing, -s.astype(object) if (s == LONG[0]).any() else -s, q))
                q, s, i, missing = q[order], s[order], i[order], missing[order]
                place_in = np.arange(len(q)) - np.searchsorted(q, q)
                keep = place_in < k
                keys.append(left["key"].take(pa.array(some[q[keep]])).combine_chunks())
                scores.append(s[keep])
                ids.append(pa.array(i[keep], pa.int64(), mask=missing[keep]))
        return pa.table({
            "key": pa.chunked_array(keys, pa.binary()),
            "score": pa.array(np.concatenate(scores) if scores else [], pa.int64()),
            "id": pa.chunked_array(ids, pa.int64())})

    return asks.groupBy("part", "block").cogroup(offered.groupBy("p", "b")).applyInArrow(best, "key binary, score long, id long")


def top_k(rows: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows ``vec_id, embedding`` of ``queries``, which must be rows of ``rows``."""
    def whole(df: DataFrame) -> DataFrame:
        return df.where(usable(F.col("embedding"))).select("vec_id", scaled(F.col("embedding"), scale).alias("v"))

    vectors = whole(rows)
    # The place is limited before the shuffle too, so a vector that very many rows share stays cheap.
    by_id = Window.partitionBy("v").orderBy(F.asc_nulls_last("vec_id"))
    few = vectors.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
    entries = kept(few.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id"))).alias("ids")).select(
        "v", F.transform("ids", lambda x: x["vec_id"]).alias("ids")), "vectors")
    fitted = _pivots(entries, pivots)
    ranked = placed(_keyed(entries, fitted).withColumn("all", F.lit(0)), ["all"], ["dim", "pivot", "dist", "v"], "annuli")
    part_rows = F.greatest(F.lit(PART_ROWS), F.ceil(F.col("n") / MAX_PARTS))
    index = kept(ranked.withColumn("part", F.floor(F.col("idx") / part_rows)), "annulus-parts")
    listed = index.groupBy("part", "dim", "pivot").agg(
        F.min("dist").alias("inner"), F.max("dist").alias("outer"), F.max("norm").alias("norm")).orderBy("part", "dim", "pivot").toArrow()
    directory = {c: listed[c].to_numpy() for c in listed.column_names}

    text = F.array_join(F.col("v").cast("array<string>"), ",")
    asked = whole(queries).withColumn("key", F.unhex(F.sha2(text, 256)))
    # A vector asked for by very many rows meets partial sums first, then one search.
    once = _keyed(asked.groupBy("v", "key").agg(F.count("*").alias("rows")), fitted)
    blocks = kept(placed(once.withColumn("all", F.lit(0)), ["all"], ["dim", "pivot", "dist", "v"], "queries").select(
        "key", "v", "self", F.floor(F.col("idx") / QUERY_ROWS).alias("block")), "query-blocks")

    found = None
    if len(directory["part"]):
        todo = blocks.select("block", "key", "v", F.lit(None).cast("long").alias("tau"))
        for first, last in zip(ROUNDS, ROUNDS[1:]):
            more = _search(_asks(todo, fitted, directory, first, last), index, k + 1)
            if found is not None:
                more = more.union(found.select("key", F.explode("best").alias("e")).select("key", "e.score", "e.id"))
            order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("id"))
            cut = more.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
            best = F.array_sort(F.collect_list(F.struct("r", "score", "id")))
            found = kept(cut.groupBy("key").agg(best.alias("best")), "best-so-far")
            least = F.when(F.size("best") > k, F.get("best", F.lit(k))["score"])
            todo = blocks.join(found, "key", "left").select("block", "key", "v", least.alias("tau"))
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # Each query's own row is one of the entries of its id and its own score, if it is listed at all.
    results = blocks.join(found, "key").select(F.col("key").alias("k"), "self", "best")
    own = F.array_min(F.transform(F.filter("best", lambda e: (e["id"] == F.col("vec_id")) & (e["score"] == F.col("self"))), lambda e: e["r"]))
    others = F.filter("best", lambda e: ~e["r"].eqNullSafe(own))
    return (
        asked.select("vec_id", "key").join(results, F.col("key") == F.col("k"))
        .select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("p", "e"))
        .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.id").alias("vec_id"), F.col("e.score").alias("score"))
    )


OP12_SQL = f"""
with r as (
  select row_number() over () as rid, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * x::double)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.rid, q.vec_id as query_id, c.vec_id,
         case when len(q.v) = 0 then 0 else list_dot_product(q.v, c.v)::bigint end as score
  from r q join r c on q.rid <> c.rid and len(q.v) = len(c.v) where q.vec_id % {EVERY} = 0),
o as (select *, row_number() over (partition by rid order by score desc, vec_id nulls last) as rank from s)
select query_id, rank, vec_id, score from o where rank <= {K}
"""


@query("op12_exact_search", OP12_SQL)
def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_columns(spark, sf_dir, "embeddings", vec_id="long", embedding="array<double>")
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))

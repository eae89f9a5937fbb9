"""Nearest neighbours by inner product with a forest of hash prefixes.

Every vector has a long hash string in each of ``TREES`` trees. A character is the largest
of 16 random directions and its sign (a cross-polytope hash), so vectors with a small angle
agree on the first characters more often. Vectors are brought to unit length by one more
coordinate, which makes nearness in angle the order of inner products.

A query descends to the longest prefix that it shares with enough vectors and ascends in
all trees at once, a character at a time, until ``want`` candidates share its prefixes and
more than ``k`` of them in one tree: the number for each prefix is counted beforehand, so the length is known for each query.
``want`` is set from a bounded sample of queries compared with all vectors, as the number
that would have found the share ``TARGET`` of their true neighbours; random vectors need
many candidates, clustered ones few. Candidates are gathered by joining on (tree, prefix):
within a group the strings are a sorted array, and a query's candidates are a range of it.
Large groups are cut into blocks of vectors and of queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayside.session import materialize

TREES = 32
LENGTH = 4
DIRECTIONS = 16
#: Characters of a string are numbers of so many bits.
CHAR_BITS = 5
TARGET = 0.96
#: Queries of the sample by which ``want`` is set.
SAMPLE = 128
#: Vectors, and queries, of a block.
BLOCK = 8192
#: Pairs scored exactly at once.
PAIRS = 1 << 15
SEED = 11


@cache
def _directions(dim: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    out = rng.standard_normal((TREES * LENGTH, dim, DIRECTIONS))
    if dim >= DIRECTIONS:
        out = np.linalg.qr(out)[0]
    return np.ascontiguousarray(out.transpose(1, 0, 2).reshape(dim, -1), np.float32)


def strings(unit: np.ndarray) -> np.ndarray:
    """Hash strings of unit vectors in all trees, first character highest; (n, TREES)."""
    out = np.empty((len(unit), TREES), np.int32)
    for a in range(0, len(unit), 1024):
        x = unit[a : a + 1024].astype(np.float32)
        p = (x @ _directions(unit.shape[1])).reshape(len(x), TREES, LENGTH, DIRECTIONS)
        axis = np.abs(p).argmax(axis=3)
        sign = np.take_along_axis(p, axis[..., None], 3)[..., 0] > 0
        chars = axis * 2 + sign
        value = np.zeros((len(x), TREES), np.int64)
        for c in range(LENGTH):
            value = value << CHAR_BITS | chars[:, :, c]
        out[a : a + 1024] = value
    return out


def _prefix(value, length: int):
    return value >> CHAR_BITS * (LENGTH - length)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """One more coordinate: what a vector lacks of the longest; nothing for a query."""
    norm = np.sqrt((x * x).sum(axis=1))
    if query:
        return np.concatenate([x / norm[:, None], np.zeros((len(x), 1))], axis=1)
    rest = np.sqrt(np.maximum(longest**2 - norm**2, 0.0))
    return np.concatenate([x, rest[:, None]], axis=1) / longest


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, each summed in one order wherever it is computed."""
    return (q * x).sum(axis=-1)


def _best(
    q: np.ndarray, x: np.ndarray, rep: np.ndarray, h: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and score of the ``k`` best of each query: by score, then by (rep, h).

    Rough products only leave out what lies below the k-th by more than rounding explains;
    the rest, with all that tie there, are scored exactly.
    """
    rough = q @ x.T
    at = max(len(x) - k, 0)
    longest = np.sqrt((x * x).sum(axis=1).max())
    margin = 4 * x.shape[1] * np.finfo(float).eps * longest * np.sqrt((q * q).sum(axis=1)) + np.finfo(float).tiny
    least = np.partition(rough, at, axis=1)[:, at] - margin
    row, col = np.nonzero(rough >= least[:, None])
    score = np.concatenate(
        [_products(q[row[i : i + PAIRS]], x[col[i : i + PAIRS]]) for i in range(0, len(row), PAIRS)]
    )
    order = np.lexsort((h[col], rep[col], -score, row))
    first = np.searchsorted(row, np.arange(len(q)))  # rows ascend before and after
    keep = order[np.arange(len(row)) - first[row] < k]
    return row[keep], col[keep], score[keep]


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    sizes = pc.list_value_length(batch.column(column))
    for n in pc.unique(sizes).to_pylist():
        yield batch.filter(pc.equal(sizes, n))


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of each query, nearest first.

    Queries are the rows whose id is divisible by ``every``; candidates all other rows.
    Nearest is the largest inner product in double precision, ties go to the smaller id.
    Rows without an id, and vectors that are null, empty, zero or hold a null or a
    non-finite component, take no part; only vectors of one length are compared. Equal
    vectors are indexed once and all found; of rows that share an id, each vector counts.
    Other columns are ignored, an empty table gives an empty result.
    """
    v = F.col("v")
    clean = (
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & v.isNotNull())
        .where(F.exists(v, lambda x: x != 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        # the squared length must be finite too
        .where(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x) < float("inf"))
        .where(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x) > 0)
    )
    rows = materialize(clean.distinct())
    # one representative of equal vectors, and their k + 1 smallest ids: no query needs more
    reps = rows.groupBy("v").agg(F.min("id").alias("rep"), F.max((F.col("id") % every == 0).cast("int")).alias("asked"))
    reps = materialize(reps.withColumn("rep", F.struct("rep", F.xxhash64("v").alias("h"))))
    named = rows.join(reps.select("v", "rep"), "v").select("id", "rep")
    named = materialize(named)
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("id"))
    members = named.withColumn("r", rank).where(F.col("r") <= k + 1).drop("r")
    asked = named.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("rep").alias("q"))

    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    longest, any_asked = reps.agg(F.max(norm), F.max("asked")).first()
    if not any_asked:
        return _empty(vectors.sparkSession, id_col)

    hashed = materialize(_hash(reps, longest))
    level = _levels(hashed, _want(hashed, reps, longest, k), k)
    found = _search(hashed, level, k)
    # a vector is always near itself: its equals are candidates
    own = reps.where("asked = 1").select(
        F.col("rep").alias("q"), F.col("rep").alias("c"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x).alias("s")
    )
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("c"))
    near = (
        found.select("q", "c", F.col("s").alias("score"))
        .where(F.col("q") != F.col("c"))
        .union(own)
        .dropDuplicates(["q", "c"])
        .withColumn("r", F.row_number().over(best))
        .where(F.col("r") <= k + 1)
        .select("q", "score", F.col("c").alias("rep"))
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return (
        asked.join(near.join(members, "rep").select("q", "score", "id"), "q")
        .where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
    )


def _empty(spark, id_col: str) -> DataFrame:
    return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")


_REP = "struct<rep:bigint,h:bigint>"


def _hash(reps: DataFrame, longest: float) -> DataFrame:
    """Representatives with their strings as vectors (``index``) and as queries (``ask``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_length(batch, "v"):
                x = _matrix(part.column("v"))
                both = []
                for query in (False, True):
                    s = strings(_unit(x, longest, query))
                    flat = pa.array(s.ravel())
                    both.append(pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * TREES, pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("asked"), part.column("v"), *both],
                    names=["rep", "asked", "v", "index", "ask"],
                )

    return reps.select("rep", "asked", "v").mapInArrow(
        run, f"rep {_REP}, asked int, v array<double>, index array<int>, ask array<int>"
    )


def _want(hashed: DataFrame, reps: DataFrame, longest: float, k: int) -> int:
    """Candidates a query needs, from at most SAMPLE queries compared with all vectors.

    For each true neighbour it is one more than the candidates at the next longer prefix,
    since only then the query ascends to the one that the neighbour shares.
    """
    sample = hashed.where("asked = 1").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("rep", "v", "ask").collect()
    if not sample:
        return 0
    queries = [(tuple(r.rep), np.array(r.v), np.array(r.ask)) for r in sample]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[list[tuple]] = [[] for _ in queries]
        counts = np.zeros((len(queries), LENGTH + 2), np.int64)
        for batch in batches:
            for part in _by_length(batch, "v"):
                x, index = _matrix(part.column("v")), _matrix(part.column("index")).astype(np.int64)
                reps = [tuple(r.values()) for r in part.column("rep").to_pylist()]
                for i, (rep, q, ask) in enumerate(queries):
                    if len(q) != x.shape[1]:
                        continue
                    length = np.zeros(len(x), np.int64)
                    for n in range(1, LENGTH + 1):
                        same = _prefix(index, n) == _prefix(ask, n)
                        counts[i, n] += same.sum()
                        length[same.any(axis=1)] = n
                    score = _products(q, x)
                    best = np.argpartition(-score, min(k + 1, len(x) - 1))[: k + 1]
                    held = [(float(score[j]), int(length[j])) for j in best if reps[j] != rep]
                    top[i] = sorted(top[i] + held, reverse=True)[:k]
        rows = [(i, s, n) for i, t in enumerate(top) for s, n in t]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows] + list(range(len(queries))), pa.int32()),
                pa.array([r[1] for r in rows] + [None] * len(queries), pa.float64()),
                pa.array([r[2] for r in rows] + [0] * len(queries), pa.int32()),
                pa.array([None] * len(rows) + counts.tolist(), pa.list_(pa.int64())),
            ],
            names=["i", "score", "length", "counts"],
        )

    rows = hashed.select("rep", "v", "index").mapInArrow(run, "i int, score double, length int, counts array<long>")
    best = Window.partitionBy("i").orderBy(F.col("score").desc(), F.col("length").desc())
    rows = materialize(rows)
    near = rows.where("score is not null").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).collect()
    total = np.zeros((len(queries), LENGTH + 2), np.int64)
    sums = rows.where("score is null").groupBy("i").agg(*[F.sum(F.col("counts")[n]).alias(f"n{n}") for n in range(LENGTH + 2)])
    for r in sums.collect():  # at most SAMPLE rows
        total[r.i] = r[1:]
    need = sorted(int(total[r.i, r.length + 1]) + 1 if r.length < LENGTH else 1 for r in near)
    if not need:
        return 1
    return need[min(len(need) - 1, int(np.ceil(TARGET * len(need))))]


def _levels(hashed: DataFrame, want: int, k: int) -> DataFrame:
    """(q, n): for each query the longest prefix at which it has ``want`` candidates, or 0.

    A vector that shares prefixes in several trees counts in each; so one tree must have
    more than ``k`` on its own, which are different vectors, at most one of them the query.
    """
    tree = lambda c: F.posexplode(c).alias("t", "s")
    dim = F.size("v").alias("dim")
    every = F.explode(F.array(*[F.lit(n) for n in range(1, LENGTH + 1)])).alias("n")
    cut = F.shiftright("s", 0)
    for n in range(1, LENGTH):
        cut = F.when(F.col("n") == n, F.shiftright("s", CHAR_BITS * (LENGTH - n))).otherwise(cut)
    held = hashed.select(dim, tree("index")).select("*", every).groupBy("dim", "t", "n", cut.alias("p")).agg(F.count("*").alias("m"))
    ask = hashed.where("asked = 1").select(F.col("rep").alias("q"), dim, tree("ask")).select("*", every).select("q", "dim", "t", "n", cut.alias("p"))
    enough = (
        ask.join(held, ["dim", "t", "n", "p"])
        .groupBy("q", "n")
        .agg(F.sum("m").alias("m"), F.max("m").alias("most"))
        .where((F.col("m") >= want) & (F.col("most") > k))
        .groupBy("q")
        .agg(F.max("n").alias("n"))
    )
    queries = hashed.where("asked = 1").select(F.col("rep").alias("q"))
    return materialize(queries.join(enough, "q", "left").select("q", F.coalesce("n", F.lit(0)).alias("n")))


def _search(hashed: DataFrame, level: DataFrame, k: int) -> DataFrame:
    """(q, c, s): each query's best candidates in every tree, at its prefix length."""
    # groups are the prefixes of the shortest length in use; 0 is one group of all vectors
    least = level.where("n > 0").agg(F.min("n")).first()[0]
    dim = F.size("v").alias("dim")
    asked = hashed.join(level, F.col("rep") == F.col("q")).select("q", "n", "v", "ask")
    parts = []
    if level.where("n = 0").limit(1).count():
        everything = hashed.select(dim, F.lit(-1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("s"), "rep", "v")
        every_query = asked.where("n = 0").select(
            dim, F.lit(-1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("s"), "n", F.col("q").alias("rep"), "v"
        )
        parts.append((everything, every_query))
    if least is not None:
        p = F.shiftright("s", CHAR_BITS * (LENGTH - least)).alias("p")
        held = hashed.select("rep", "v", dim, F.posexplode("index").alias("t", "s")).select("dim", "t", p, "s", "rep", "v")
        some = asked.where("n > 0").select(F.col("q").alias("rep"), "v", "n", dim, F.posexplode("ask").alias("t", "s"))
        parts.append((held, some.select("dim", "t", p, "s", "n", "rep", "v")))
    out = None
    for held, some in parts:
        key = ["dim", "t", "p"]
        sizes = held.groupBy(*key).agg(F.count("*").alias("m")).join(some.groupBy(*key).agg(F.count("*").alias("a")), key)
        blocks = sizes.select(
            *key, F.ceil(F.col("m") / BLOCK).cast("int").alias("mb"), F.ceil(F.col("a") / BLOCK).cast("int").alias("ab")
        )
        blocks = materialize(blocks)
        upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        own = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
        x = held.join(blocks, key).select(*key, own("mb").alias("b1"), upto("ab").alias("b2"), F.lit(None).cast("int").alias("n"), "s", "rep", "v")
        y = some.join(blocks, key).select(*key, upto("mb").alias("b1"), own("ab").alias("b2"), "n", "s", "rep", "v")
        got = (
            x.union(y)
            .groupBy(*key, "b1", "b2")
            .applyInArrow(_group(k), f"q {_REP}, c {_REP}, s double")
        )
        out = got if out is None else out.union(got)
    return out


def _group(k: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        is_query = pc.is_valid(table.column("n"))
        held = table.filter(pc.invert(is_query)).combine_chunks().sort_by("s")
        asked = table.filter(is_query).combine_chunks()
        empty = pa.table({"q": asked.column("rep").slice(0, 0), "c": asked.column("rep").slice(0, 0), "s": pa.array([], pa.float64())})
        if not len(held) or not len(asked):
            return empty
        one = lambda t, c: t.column(c).combine_chunks() if isinstance(t.column(c), pa.ChunkedArray) else t.column(c)
        x, q = _matrix(one(held, "v")), _matrix(one(asked, "v"))
        s = one(held, "s").to_numpy().astype(np.int64)
        rep, h = (one(held, "rep").field(c).to_numpy() for c in ("rep", "h"))
        at, n = one(asked, "s").to_numpy().astype(np.int64), one(asked, "n").to_numpy()
        shift = CHAR_BITS * (LENGTH - n)
        shift[n == 0] = 62
        low = np.searchsorted(s, at >> shift << shift, "left")
        high = np.searchsorted(s, ((at >> shift) + 1 << shift) - 1, "right")
        high[n == 0] = len(s)
        rows, cols, scores = [], [], []
        # queries with the same range are compared with it at once
        order = np.lexsort((high, low))
        cuts = np.flatnonzero(np.diff(low[order]) | np.diff(high[order])) + 1
        for group in np.split(order, cuts):
            a, b = low[group[0]], high[group[0]]
            if a == b:
                continue
            for part in np.array_split(group, -(-len(group) // 256)):
                row, col, score = _best(q[part], x[a:b], rep[a:b], h[a:b], k + 1)  # a query may find itself
                rows.append(part[row])
                cols.append(col + a)
                scores.append(score)
        if not rows:
            return empty
        rows, cols = np.concatenate(rows), np.concatenate(cols)
        return pa.table(
            {"q": one(asked, "rep").take(pa.array(rows)), "c": one(held, "rep").take(pa.array(cols)), "s": pa.array(np.concatenate(scores))}
        )

    return run

"""Exact top-k inner product search by a dual-tree walk over cover trees.

Vectors are searched as integers: floor(scale * x) of each component.  A node
of a cover tree has a centre, one of its own points, and a covering radius that
no point under it exceeds; its children halve the radius, their centres are
farther apart than the children's radius, and one child keeps the centre.  For
a query node (centre q, radius r) and a data node (centre p, radius s) no inner
product is above <q, p> + r|p| + s|q| + rs.  A pair of nodes below the worst
kth score of the queries under the query node is dropped.

The top level is spread over the cluster: its centres are a farthest-first net
of a bounded sample, every vector goes to its nearest centre, and the cells are
cut into blocks of bounded size, with a cover tree each; radii come from all
rows.  Distinct query vectors are grouped in the same way.  A group first walks
one block of its own cell, which gives it scores to prune with, and then meets
the blocks of all cells that the bound leaves; a task walks the trees of one
data block and a bounded number of query groups.

Equal vectors have equal scores: of each distinct vector only the k + 1 rows with
the smallest ids are candidates, and each distinct query vector is searched
once, for k + 1 rows, so that a query can leave out its own.

Defined cases: vectors that are null or hold a null or non-finite component (or
one beyond 1e100 after scaling) take no part; shorter vectors are padded
with zeros, an empty one is the zero vector; a query leaves out its own row only,
so repeated rows and ids are each other's candidates; ties go to the smaller id,
null ids last; rows with a null id are no queries; scores beyond 64 bits are held
at their ends; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column_or_null, map_batches, stage, table

TOP = 10
SCALE = 1024
EVERY = 100                    # ids divisible by this are queries
LEAF = 32                      # points that are scored without more nodes
BLOCK_CELLS = 1 << 17          # components of the vectors of a block
GROUP = 256                    # distinct queries of a group
GROUPS = 64                    # groups that one task walks over a block
CENTRES = 1024                 # of the top level, at most
SAMPLE = 1 << 14               # rows they are chosen from
EXACT = 2.0 ** 53
LARGEST = 1e100                # scaled components; their squares are finite
LOWEST = -2.0 ** 63


# ------------------------------------------------------------------ vectors

def _vector_pass(scale: float):
    def run(batches):
        for rb in batches:
            v = rb.column("vec")
            ok = ~v.is_null().to_numpy(zero_copy_only=False)
            length = np.where(ok, pc.list_value_length(v).fill_null(0).to_numpy(zero_copy_only=False), 0)
            flat = v.flatten()
            gone = flat.is_null().to_numpy(zero_copy_only=False)
            x = np.floor(flat.fill_null(0).to_numpy(zero_copy_only=False) * float(scale))
            row = np.repeat(np.arange(len(length)), length)
            ok[row[gone | ~(np.abs(x) <= LARGEST)]] = False
            at = np.concatenate([[0], np.cumsum(length)])
            keep = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [rb.column("id").take(pa.array(keep)), pa.array([x[at[i]:at[i + 1]].astype("<f8").tobytes() for i in keep], pa.binary())], ["id", "vec"])
    return run


def matrix(raw: list[bytes], size: int) -> np.ndarray:
    """Rows of vectors, padded with zeros to ``size`` components."""
    out = np.zeros((len(raw), size))
    for i, x in enumerate(raw):
        v = np.frombuffer(x, "<f8")
        out[i, :len(v)] = v
    return out + 0.0                                       # no negative zeros


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer inner products; doubles are exact while no partial sum can
    pass 2^53."""
    if np.sqrt((q * q).sum(axis=1).max(initial=0) * (p * p).sum(axis=1).max(initial=0)) < EXACT:
        return (q @ p.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip((whole(q) if q.size else q) @ (whole(p) if p.size else p).T, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


# ------------------------------------------------------------------ cover tree

class CoverTree:
    """Cover tree over the rows of a matrix.  Node i covers the points
    ``order[lo[i]:hi[i]]``, and has the children ``down[i]`` (none: a leaf)."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF) -> None:
        self.x, self.order = x, np.arange(len(x))
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.centre, self.radius, self.lo, self.hi, self.down = [], [], [], [], []
        if len(x):
            self._add(0, 0, len(x))
        i = 0
        while i < len(self.centre):
            if self.hi[i] - self.lo[i] > leaf and self.radius[i] > 0:
                self.down[i] = self._split(i)
            i += 1
        self.centre, self.radius, self.lo, self.hi = map(np.array, (self.centre, self.radius, self.lo, self.hi))

    def _far(self, points: np.ndarray, centre: int) -> np.ndarray:
        d = self.x[points] - self.x[centre]
        return np.sqrt((d * d).sum(axis=1))

    def _add(self, centre: int, lo: int, hi: int) -> int:
        self.centre.append(centre)
        self.radius.append(float(self._far(self.order[lo:hi], centre).max()))
        self.lo.append(lo)
        self.hi.append(hi)
        self.down.append(None)
        return len(self.centre) - 1

    def _split(self, i: int) -> np.ndarray:
        """Children: a net of the points at half the radius, from the centre on."""
        left, half = self.order[self.lo[i]:self.hi[i]].copy(), self.radius[i] / 2
        centre, at, children = self.centre[i], self.lo[i], []
        while len(left):
            near = self._far(left, centre) <= half
            mine, left = left[near], left[~near]
            self.order[at:at + len(mine)] = mine
            children.append((centre, at, at + len(mine)))
            at += len(mine)
            centre = left[0] if len(left) else centre
        return np.array([self._add(*c) for c in children])


class Best:
    """The k best (score, id, row) of each query; null ids sort last."""

    def __init__(self, n: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least.copy()
        self.score, self.id, self.null, self.row = ([np.zeros(0, t) for _ in range(n)] for t in (np.int64, np.int64, bool, np.int64))

    def add(self, q: int, score, ids, null, rows) -> None:
        ok = score >= self.least[q]
        if not ok.any():
            return
        s, i, z, r = (np.concatenate([a[q], b[ok]]) for a, b in ((self.score, score), (self.id, ids), (self.null, null), (self.row, rows)))
        best = np.lexsort((r, i, z, ~s))[:self.k]            # ~s falls as s rises, without overflow
        self.score[q], self.id[q], self.null[q], self.row[q] = s[best], i[best], z[best], r[best]
        if len(best) == self.k:
            self.least[q] = max(self.least[q], s[best[-1]])


def walk(queries: CoverTree, data: CoverTree, ids: np.ndarray, null: np.ndarray, rows: np.ndarray, best: Best) -> None:
    """Dual-tree walk: every pair of nodes is dropped, split or scored."""
    if not len(queries.centre) or not len(data.centre):
        return

    def score(a: int, points: np.ndarray) -> None:
        mine = queries.order[queries.lo[a]:queries.hi[a]]
        found = products(queries.x[mine], data.x[points])
        for i, q in enumerate(mine):
            best.add(q, found[i], ids[points], null[points], rows[points])

    def bounds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of all pairs of the nodes a and b, never below a product of theirs."""
        qa, pb = queries.centre[a], data.centre[b]
        ra, rb, na, nb = queries.radius[a][:, None], data.radius[b][None, :], queries.norm[qa][:, None], data.norm[pb][None, :]
        most = queries.x[qa] @ data.x[pb].T + (ra * nb + rb * na + ra * rb) + 1e-9 * (na + ra) * (nb + rb) + 1
        return np.maximum(most, LOWEST)

    stack = [(0, 0)]
    while stack:
        a, b = stack.pop()
        least = best.least[queries.order[queries.lo[a]:queries.hi[a]]].min()
        if bounds(np.array([a]), np.array([b]))[0, 0] < least:
            continue
        if data.down[b] is not None and (queries.down[a] is None or data.radius[b] >= queries.radius[a]):
            below = data.down[b]
            bound = bounds(np.array([a]), below)[0]
            below = below[(bound >= least)]
            flat = np.array([data.down[c] is None for c in below], bool)
            if flat.any():                                 # leaves together: one product
                score(a, np.concatenate([data.order[data.lo[c]:data.hi[c]] for c in below[flat]]))
            inner = below[~flat]
            stack += [(a, c) for c in inner[np.argsort(bounds(np.array([a]), inner)[0], kind="stable")]]   # best on top
        elif queries.down[a] is not None:
            stack += [(c, b) for c in queries.down[a]]
        else:
            score(a, data.order[data.lo[b]:data.hi[b]])


# ------------------------------------------------------------------ top level

def net(x: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first net: rows of at most ``most`` centres, each the point
    farthest from those before."""
    chosen = [0]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(most, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _cell_pass(shared):
    def run(batches):
        centres = shared.value
        half = (centres * centres).sum(axis=1) / 2
        for rb in batches:
            for lo in range(0, rb.num_rows, 1024):
                part = rb.slice(lo, 1024)
                x = matrix(part.column("vec").to_pylist(), centres.shape[1])
                cell = (half[None, :] - x @ centres.T).argmin(axis=1) if len(x) else np.zeros(0, int)
                far = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int64()), pa.array(far)], [*part.schema.names, "cell", "far"])
    return run


def _block_pass(batches):
    """Rows sorted by (cell, part) -> one row per block."""
    def out(key, held):
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]]), pa.array([held["id"]], pa.list_(pa.int64())), pa.array([held["row"]], pa.list_(pa.int64())),
             pa.array([held["vec"]], pa.list_(pa.binary())), pa.array([max(held["far"])])], ["cell", "part", "ids", "rows", "vecs", "radius"])
    key, held = None, None
    for rb in batches:
        d = rb.to_pydict()
        for i in range(rb.num_rows):
            now = (d["cell"][i], d["part"][i])
            if now != key:
                if key is not None:
                    yield out(key, held)
                key, held = now, {c: [] for c in ("id", "row", "vec", "far")}
            for c in held:
                held[c].append(d[c][i])
    if key is not None:
        yield out(key, held)


def _walk_pass(size: int, k: int):
    """Rows sorted by (block, chunk, kind): a data block, then query groups."""
    def run(batches):
        for rb in batches:
            for r in rb.to_pylist():
                if r["kind"] == 0:
                    data = CoverTree(matrix(r["vecs"], size))
                    ids = np.array([x or 0 for x in r["ids"]], np.int64)
                    null = np.array([x is None for x in r["ids"]], bool)
                    rows = np.array(r["rows"], np.int64)
                    continue
                best = Best(len(r["rows"]), k, np.array(r["least"], np.int64))
                walk(CoverTree(matrix(r["vecs"], size), leaf=1), data, ids, null, rows, best)
                n = [len(x) for x in best.score]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(r["rows"], np.int64), n)), pa.array(np.concatenate(best.id), mask=np.concatenate(best.null)),
                     pa.array(np.concatenate(best.row)), pa.array(np.concatenate(best.score))], ["query", "id", "row", "score"])
    return run


def _reach_pass(shared):
    """Cells that a group of queries may have results in: (block, cell)."""
    def run(batches):
        centres, radius = shared.value
        norm = np.sqrt((centres * centres).sum(axis=1))
        for rb in batches:
            for block, cell, r, least in zip(*(rb.column(c).to_pylist() for c in ("block", "cell", "radius", "least"))):
                bound = centres @ centres[cell] + r * norm + radius * norm[cell] + r * radius
                bound += 1e-9 * (norm + radius) * (norm[cell] + r) + 1
                found = np.flatnonzero((radius >= 0) & (np.maximum(bound, LOWEST) >= min(least)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), pa.array(found)], ["block", "cell"])
    return run


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Blocks of at most about ``most`` rows of a cell: (block, cell, part,
    ids, rows, vecs, radius); rows are dealt by hash, so a hot cell has many."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count("*") / most).alias("parts"))
    dealt = (rows.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts"))).drop("parts")
             .repartition("cell", "part").sortWithinPartitions("cell", "part", "row"))
    found = map_batches(dealt.select("cell", "part", "id", "row", "vec", "far"), _block_pass,
                        "cell long, part long, ids array<long>, rows array<long>, vecs array<binary>, radius double")
    return stage(found.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _best_rows(found: DataFrame, by: str, k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), "row"]
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= k)


class CoverTreeIndex:
    """Blocks of the candidates of ``vectors(id, row, vec)``."""

    def __init__(self, vectors: DataFrame, k: int) -> None:
        self.spark, self.k = vectors.sparkSession, k
        held = Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last(), "row")
        points = stage(vectors.withColumn("_n", F.row_number().over(held)).filter(F.col("_n") <= k + 1).drop("_n"), "points")
        count, size = points.agg(F.count("*"), F.max(F.octet_length("vec"))).first()
        self.size = max(1, (size or 0) // 8)
        self.block = max(16, min(2048, BLOCK_CELLS // self.size))
        sample = points.orderBy(F.xxhash64("row")).limit(max(16, min(SAMPLE, (1 << 22) // self.size))).select("vec").collect() if count else []
        most = max(1, min(CENTRES, count // self.block, (1 << 20) // self.size))
        self.centres = net(matrix([bytes(r["vec"]) for r in sample], self.size), most) if sample else np.zeros((1, self.size))
        self.shared = self.spark.sparkContext.broadcast(self.centres)           # 2^20 components at most
        self.blocks = _blocks(self.celled(points), self.block)
        self.radius = np.full(len(self.centres), -1.0)
        for r in self.blocks.groupBy("cell").agg(F.max("radius").alias("r")).collect():   # a row per centre
            self.radius[r["cell"]] = r["r"]

    def celled(self, rows: DataFrame) -> DataFrame:
        return map_batches(rows.select("id", "row", "vec"), _cell_pass(self.shared), "id long, row long, vec binary, cell long, far double")

    def _walked(self, pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """Results of the pairs (data block, group) -> (query, id, row, score)."""
        chunks = max(1, -(-groups.count() // GROUPS))
        pairs = stage(pairs.select("block", "group").withColumn("chunk", F.pmod(F.xxhash64("group"), F.lit(chunks))), "pairs")
        data = pairs.select("block", "chunk").distinct().join(self.blocks.select("block", "ids", "rows", "vecs"), "block")
        asked = pairs.join(groups.select(F.col("block").alias("group"), "ids", "rows", "vecs", "least"), "group")
        none = F.lit(None).cast("array<long>").alias("least")
        both = (data.select("block", "chunk", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("group"), "ids", "rows", "vecs", none)
                .unionByName(asked.select("block", "chunk", F.lit(1).alias("kind"), "group", "ids", "rows", "vecs", "least"))
                .repartition("block", "chunk").sortWithinPartitions("block", "chunk", "kind", "group"))
        return map_batches(both, _walk_pass(self.size, self.k + 1), "query long, id long, row long, score long")

    def search(self, queries: DataFrame) -> DataFrame:
        """(query, id, row, score) of the k + 1 best candidates of each of the
        distinct vectors ``queries(row, vec)``."""
        groups = _blocks(self.celled(queries.withColumn("id", F.col("row"))), min(GROUP, self.block))
        nothing = F.transform("rows", lambda _: F.lit(-2 ** 63).cast("long"))
        groups = groups.withColumn("least", nothing)
        parts = self.blocks.groupBy("cell").agg(F.count("*").alias("parts"))
        own = (groups.select(F.col("block").alias("group"), "cell").join(parts, "cell")
               .withColumn("part", F.pmod(F.xxhash64("group"), F.col("parts")))
               .join(self.blocks.select("block", "cell", "part"), ["cell", "part"]).select("block", "group"))
        first = stage(_best_rows(self._walked(own, groups), "query", self.k + 1), "first")
        worst = first.filter(F.col("rank") == self.k + 1).select(F.col("query").alias("row"), F.col("score").alias("kth"))
        asked = (groups.select("block", F.posexplode("rows").alias("at", "row")).join(worst, "row", "left")
                 .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("kth", F.lit(-2 ** 63).cast("long")).alias("kth")))).alias("k"))
                 .select("block", F.col("k.kth").alias("least")))
        groups = stage(groups.drop("least").join(asked, "block"), "groups")
        shared = self.spark.sparkContext.broadcast((self.centres, self.radius))
        reach = map_batches(groups.select("block", "cell", "radius", "least"), _reach_pass(shared), "block long, cell long")
        rest = (reach.withColumnRenamed("block", "group").join(self.blocks.select("block", "cell"), "cell").select("block", "group")
                .join(own, ["block", "group"], "left_anti"))
        found = self._walked(rest, groups).unionByName(first.drop("rank"))
        return stage(_best_rows(found, "query", self.k + 1), "best").drop("rank")


def top_products(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = TOP, scale: float = SCALE,
                 every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id ``every`` divides
    against all others."""
    rows = df.select(column_or_null(df, id_col, "long").alias("id"), column_or_null(df, vec_col, "array<double>").alias("vec"))
    vectors = stage(map_batches(rows, _vector_pass(scale), "id long, vec binary").withColumn("row", F.monotonically_increasing_id()), "vectors")
    index = CoverTreeIndex(vectors, k)
    asked = vectors.filter(F.col("id") % every == 0)
    distinct = stage(asked.select("vec").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    best = index.search(distinct.select(F.col("query").alias("row"), "vec"))
    named = asked.select(F.col("id").alias("query_id"), F.col("row").alias("own"), "vec").join(distinct, "vec").select("query_id", "own", "query")
    found = named.join(best, "query").filter("own <> row")
    return (_best_rows(found, "own", k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"))


def q_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


_ORACLE = """
with valid as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as c
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select q.r, q.vec_id as query_id, v.vec_id, list_inner_product(q.c, v.c)::bigint as score
  from valid q join valid v on q.r <> v.r where q.vec_id % 100 = 0),
ranked as (
  select query_id, row_number() over (partition by r order by score desc, vec_id)::int as rank, vec_id, score from scored)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

QUERIES = {"op11_vector_search": q_vector_search}
ORACLES = {"op11_vector_search": _ORACLE}

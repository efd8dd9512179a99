"""N-gram Jaccard join through a count-vector R-tree.

A document is the set of hashes of its distinct k-word shingles.  Its tokens
(shingles) are hashed into groups; the number of tokens in each group is a
coordinate, so a document is a point.  For two points the overlap of the sets
is at most the sum of the coordinate minima; for two tree nodes, at most the
sum of the minima of their coordinate maxima.  A pair whose bound misses the
required overlap is dropped, and survivors are verified on their whole sets.

The tree is distributed.  Its root splits the space into cells, by an exact
rule.  For sets of sizes a <= b with Jaccard >= t the symmetric difference is at
most d = (1-t)/(1+t) (a+b).  Each size class cuts the hash range into more than
d slabs (coarse groups), so a linked pair has the very same tokens in at least
one slab; the content of a slab names a cell.  A document enters the cells of
its d+1 slabs with the smallest names: at most d of its filled slabs differ from
a partner's, so the first slab they share is among them.  A document with too
few filled slabs for that also enters the cells of its empty ones.  A document
whose smaller partners may lie in the class below enters that class too.

Inside the cells the work is in rounds, so that a large group of copies, or of
texts that are alike but do not link, never makes all its pairs: first every
member against the smallest member of all its cells; then an R-tree join of each
cell that still holds several components, which tells only what components the
surviving pairs connect.  All surviving pairs lie inside the groups connected
that way, and a document is in one group at most: there the whole sets meet, and
each set's overlaps with all others are counted from the group's posting lists;
only links that join two components are put out.  A cell or group with many
members is joined in blocks, each pair of blocks a separate run.

Sets are compared through 64-bit hashes of shingles and 64-bit fingerprints of
whole sets; among n different sets about n^2 / 2^65 pairs share a fingerprint.

Defined cases: null or word-free text has no shingles and links with nothing
(its component is its own id); fewer than k words make one shingle; rows with a
null id get a null component and take no part in links; repeated rows and ids
belong to one document class each by their sets; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytetext as B
from .common import apart, column_or_null, discard, map_batches, safe_name, stage, table
from .links import components

GROUPS = (64, 65536)   # fewest and most coordinates of a point; about the set's size between
LEAF = 32              # points of a leaf
FANOUT = 8             # children of a node
BLOCK = 2048           # members of a cell or group that a block holds
TOKENS = 1 << 22       # tokens of a group that a block holds
SPREAD_ROWS = 256      # of them show the widest coordinates, by which a tree is sorted
MAX_CLASS = 40         # sizes up to 2^39 tokens
BUCKETS = 1 << 22      # of the bitmap of wanted ids
U64 = np.uint64


# ------------------------------------------------------------------ sets

def shingle_sets(column, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a text column."""
    for _, buf, off in B.slices(column):
        low = B.LOWER[buf]
        start, end, first = B.runs(~B.SPACE[low], off)
        h, at = B.windows(B.span_hashes(low, start, end), first, k)
        for i in range(len(off) - 1):
            yield np.unique(h[at[i]:at[i + 1]])


def fingerprint(s: np.ndarray) -> int:
    """64-bit fingerprint of a set (order-free, size included)."""
    with np.errstate(over="ignore"):
        x = B.mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64) + U64(len(s))
        return int(B.signed(B.mix(np.array([x], U64)))[0])


def point(s: np.ndarray) -> bytes:
    """Coordinates of a set: its number of tokens in each group.  The number of
    groups, a power of two, is about the set's size: fewer say little about
    large sets.  One byte a coordinate, two for sets beyond ``GROUPS[1]``."""
    groups = min(max(GROUPS[0], 1 << max(len(s) - 1, 0).bit_length()), GROUPS[1])
    counts = np.bincount((s & U64(groups - 1)).astype(np.int64), minlength=groups)
    return counts.astype("u1" if len(s) <= GROUPS[1] else "<u2").tobytes()


def coordinates(raw) -> np.ndarray:
    return np.frombuffer(raw, "u1" if len(raw) <= GROUPS[1] else "<u2")


def folded(point_: np.ndarray, groups: int) -> np.ndarray:
    """The same point with fewer groups, in the next wider type."""
    return point_ if len(point_) == groups else point_.reshape(-1, groups).sum(axis=0, dtype="<u2" if point_.itemsize == 1 and len(point_) <= 128 * groups else "<u4")


def _difference(a: int, b: int, t: int) -> int:
    """Largest symmetric difference of linked sets of sizes a and b (t percent)."""
    return (100 - t) * (a + b) // (100 + t)


def _slabs(c: int, t: int) -> tuple[int, int]:
    """(slabs, cells that linked sets share at least) of a size class."""
    most = _difference(2 ** c, 2 ** c * 100 // t, t)
    return most + most // 8 + 16, 1 + most // 16


def cells(s: np.ndarray, t: int) -> np.ndarray:
    """Names of the cells that a set enters; the low bits are the size class."""
    n = len(s)
    if not n:
        return s
    top = (n - 1).bit_length()                       # sizes (2^(top-1), 2^top]
    least = -(-n * t // 100)
    plan = [(top, _difference(n, n * 100 // t, t))]
    if (low := (least - 1).bit_length()) < top:      # smaller partners in classes below
        plan += [(c, _difference(n, 2 ** c, t)) for c in range(low, top)]
    out = []
    for c, d in plan:
        slabs, share = _slabs(c, t)
        slab = ((s >> U64(32)) * U64(slabs)) >> U64(32)
        cut = np.flatnonzero(np.concatenate([[True], slab[1:] != slab[:-1]]))
        with np.errstate(over="ignore"):
            tag = U64(c + 1) * U64(0xA24BAED4963EE407)
            names = B.mix(np.add.reduceat(B.mix(s), cut) ^ B.mix(slab[cut] + tag))
            if len(names) >= d + share:
                names = np.sort(names)[:d + share]
            else:
                empty = np.setdiff1d(np.arange(slabs, dtype=U64), slab[cut])
                names = np.concatenate([names, B.mix(~B.mix(empty + tag))])
        out.append((names & ~U64(63)) | U64(c))
    return np.concatenate(out)


def _signature_pass(k: int, t: int):
    def run(batches):
        for rb in batches:
            n, fp, vec, names, off = [], [], [], [], [0]
            for s in shingle_sets(rb.column("text"), k):
                n.append(len(s))
                fp.append(fingerprint(s))
                vec.append(point(s))
                c = cells(s, t)
                names.append(B.signed(c))
                off.append(off[-1] + len(c))
            flat = np.concatenate(names) if names else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(vec, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat))],
                ["id", "n", "fp", "vec", "cells"])
    return run


def _set_pass(k: int, shared):
    """Sets of the rows whose id bucket is marked in the bitmap."""
    def run(batches):
        marks = shared.value
        for rb in batches:
            rb = rb.filter(pa.array(marks[rb.column("bucket").to_numpy()]))
            sets = list(shingle_sets(rb.column("text"), k))
            off = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), pa.array([fingerprint(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(B.signed(flat)))], ["id", "fp", "tokens"])
    return run


# ------------------------------------------------------------------ R-tree

class CountTree:
    """Packed R-tree over count vectors; a node keeps the coordinate maxima and
    the size range of what lies below it."""

    def __init__(self, vecs: np.ndarray, sizes: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> None:
        if len(vecs) <= leaf:
            order = np.arange(len(vecs))
        else:
            spread = np.argsort(-vecs[::-(-len(vecs) // SPREAD_ROWS)].std(axis=0), kind="stable")[:2]
            order = np.lexsort((vecs[:, spread[1]], vecs[:, spread[0]], sizes))
        self.order, self.vecs, self.sizes = order, vecs[order], sizes[order]
        self.leaf, self.fanout = leaf, fanout
        at = np.arange(0, len(order), leaf)
        top = np.maximum.reduceat(self.vecs, at) if len(at) else self.vecs
        low = np.minimum.reduceat(self.sizes, at) if len(at) else self.sizes
        high = np.maximum.reduceat(self.sizes, at) if len(at) else self.sizes
        self.levels = [(top, low, high)]
        while len(top) > 1:
            at = np.arange(0, len(top), fanout)
            top, low, high = np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))

    def pairs(self, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i < j in tree order) of points that survive the bound, as
        original positions: a descent over pairs of nodes."""
        if not len(self.order):
            return
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, a, b = stack.pop()
            top, low, high = self.levels[level]
            if a != b:
                la, lb = max(int(low[a]), -(-int(low[b]) * t // 100)), max(int(low[b]), -(-int(low[a]) * t // 100))
                if la > high[a] or lb > high[b]:
                    continue
                if int(np.minimum(top[a], top[b]).sum(dtype=np.int64)) * (100 + t) < t * (la + lb):
                    continue
            if level:
                under = len(self.levels[level - 1][0])
                f = self.fanout
                for i in range(a * f, min((a + 1) * f, under)):
                    stack += [(level - 1, i, j) for j in range(max(i, b * f), min((b + 1) * f, under))]
                continue
            ia = np.arange(a * self.leaf, min((a + 1) * self.leaf, len(self.order)))
            ib = np.arange(b * self.leaf, min((b + 1) * self.leaf, len(self.order)))
            bound = np.minimum(self.vecs[ia][:, None, :], self.vecs[ib][None, :, :]).sum(axis=2, dtype=np.int64)
            need = t * (self.sizes[ia][:, None] + self.sizes[ib][None, :])
            ok = bound * (100 + t) >= need
            if a == b:
                ok &= ia[:, None] < ib[None, :]
            x, y = np.nonzero(ok)
            if len(x):
                yield self.order[ia[x]], self.order[ib[y]]


def _tree_pass(t: int):
    """Rows sorted by (cell, lo, hi) -> (u, v): what components the surviving
    pairs of a run connect, each with the smallest one."""
    def flush(keys, rows):
        if len(rows["fp"]) < 2:
            return None
        vecs = [coordinates(v) for v in rows["vec"]]
        groups = min(len(v) for v in vecs)
        vecs = np.array([folded(v, groups) for v in vecs])
        part = np.array(rows["part"], np.int64)
        comps, mine = np.unique(np.array(rows["comp"], np.int64), return_inverse=True)
        label = mine.copy()
        for x, y in CountTree(vecs, np.array(rows["n"], np.int64)).pairs(t):
            if keys[1] != keys[2]:
                ok = part[x] != part[y]
                x, y = x[ok], y[ok]
            ok = label[x] != label[y]
            while ok.any():
                x, y = x[ok], y[ok]
                label[label == label[y[0]]] = label[x[0]]
                ok = label[x] != label[y]
        own, at = np.unique(mine, return_index=True)       # comps ascend: the first of a label is its smallest
        _, first, of = np.unique(label[at], return_index=True, return_inverse=True)
        u, v = comps[own[first[of]]], comps[own]
        if not (u != v).any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], ["u", "v"])

    def run(batches):
        keys, rows = None, None
        for rb in batches:
            d = rb.to_pydict()
            for i in range(rb.num_rows):
                now = (d["cell"][i], d["lo"][i], d["hi"][i])
                if now != keys:
                    if keys is not None and (out := flush(keys, rows)) is not None:
                        yield out
                    keys, rows = now, {c: [] for c in ("fp", "comp", "n", "vec", "part")}
                for c in rows:
                    rows[c].append(d[c][i])
        if keys is not None and (out := flush(keys, rows)) is not None:
            yield out
    return run


def _links(fp: np.ndarray, label: np.ndarray, part: np.ndarray, tokens: list[np.ndarray], t: int) -> tuple[list[int], list[int]]:
    """Links that join different labels, enough to connect what all of them
    connect; between blocks, where ``part`` has two values, only across."""
    n = np.array([len(s) for s in tokens])
    off = np.concatenate([[0], np.cumsum(n)])
    word = np.unique(np.concatenate(tokens), return_inverse=True)[1]
    held = np.bincount(word)
    at = np.concatenate([[0], np.cumsum(held)[:-1]])
    posting = np.repeat(np.arange(len(n)), n)[np.argsort(word, kind="stable")]
    across = part.min() != part.max()
    us, vs = [], []
    label = np.unique(label, return_inverse=True)[1]
    # a pair of two labels has a member outside the largest one
    for x in np.flatnonzero(label != np.bincount(label).argmax()):
        mine = word[off[x]:off[x + 1]]
        count = held[mine]
        where = np.repeat(at[mine] - np.cumsum(count) + count, count) + np.arange(count.sum())
        ok = np.bincount(posting[where], minlength=len(n)) * (100 + t) >= (n[x] + n) * t
        ok &= label != label[x]
        if across:
            ok &= part != part[x]
        for y in np.flatnonzero(ok):
            if label[x] != label[y]:
                us.append(int(fp[x]))
                vs.append(int(fp[y]))
                label[label == label[y]] = label[x]
        if label.min() == label.max():
            break
    return us, vs


def _link_pass(t: int):
    """Rows sorted by (group, lo, hi) -> the links (u, v) of each run."""
    def flush(rows):
        u, v = _links(np.array(rows["fp"], np.int64), np.array(rows["comp"], np.int64), np.array(rows["part"], np.int64), rows["tokens"], t)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches):
        keys, rows = None, None
        for rb in batches:
            d = rb.drop_columns(["tokens"]).to_pydict()
            tokens = rb.column("tokens")
            for i in range(rb.num_rows):
                now = (d["group"][i], d["lo"][i], d["hi"][i])
                if now != keys:
                    if keys is not None:
                        yield flush(rows)
                    keys, rows = now, {c: [] for c in ("fp", "comp", "part", "tokens")}
                for c in ("fp", "comp", "part"):
                    rows[c].append(d[c][i])
                rows["tokens"].append(tokens[i].values.to_numpy().copy())
        if keys is not None:
            yield flush(rows)
    return run


# ------------------------------------------------------------------ join

def _bound_pass(t: int, keep: list[str]):
    def run(batches):
        for rb in batches:
            na, nb = rb.column("na").to_numpy(), rb.column("nb").to_numpy()
            ok = np.minimum(na, nb) * 100 >= np.maximum(na, nb) * t
            for i in np.flatnonzero(ok):
                a, b = (coordinates(rb.column(c)[i].as_buffer()) for c in ("va", "vb"))
                g = min(len(a), len(b))
                ok[i] = int(np.minimum(folded(a, g), folded(b, g)).sum(dtype=np.int64)) * (100 + t) >= (na[i] + nb[i]) * t
            yield rb.select(keep).filter(pa.array(ok))
    return run


def _bounded(pairs: DataFrame, points: DataFrame, t: int) -> DataFrame:
    """Pairs (u, v) whose sizes and coordinate minima allow a link."""
    a = points.select(F.col("fp").alias("u"), F.col("n").alias("na"), F.col("vec").alias("va"))
    b = points.select(F.col("fp").alias("v"), F.col("n").alias("nb"), F.col("vec").alias("vb"))
    return map_batches(pairs.join(a, "u").join(b, "v"), _bound_pass(t, pairs.columns), ", ".join(f"{c} long" for c in pairs.columns))


def _bucket(column: str):
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


def _token_sets(nodes: DataFrame, points: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The rows of ``nodes`` (fp, id, ...; a written table) with their whole sets,
    made from the texts of one document each; a bitmap of fixed size lets most
    other texts be skipped before any shuffle, and the join on (fp, id) is exact."""
    marks = np.zeros(BUCKETS, bool)
    bits = (nodes.select(_bucket("id").alias("b")).groupBy(F.expr("b div 32").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, b % 32)")).alias("bits")).toArrow())
    word, bits = bits.column("word").to_numpy(), bits.column("bits").to_numpy()     # at most BUCKETS / 32 rows
    for i in range(32):
        marks[word[(bits >> i) & 1 == 1] * 32 + i] = True
    sets = map_batches(docs.filter("id is not null").withColumn("bucket", _bucket("id")),
                       _set_pass(k, docs.sparkSession.sparkContext.broadcast(marks)), "id long, fp long, tokens array<long>")
    sets = sets.join(nodes, ["fp", "id"])
    return sets if points.filter("again").isEmpty() else sets.dropDuplicates(["fp"])    # rows or ids repeat


def _verified(pairs: DataFrame, points: DataFrame, docs: DataFrame, k: int, t: int) -> DataFrame:
    """The pairs whose whole sets link, written."""
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("fp")).distinct()
    nodes = stage(points.join(nodes, "fp").select("fp", "id", "n"), "nodes")
    sets = stage(_token_sets(nodes, points, docs, k).select("fp", "n", "tokens"), "tokens")
    a = sets.select(F.col("fp").alias("u"), F.col("n").alias("_na"), F.col("tokens").alias("_ta"))
    b = sets.select(F.col("fp").alias("v"), F.col("n").alias("_nb"), F.col("tokens").alias("_tb"))
    shared = F.size(F.array_intersect("_ta", "_tb"))
    links = stage(pairs.join(a, "u").join(b, "v")
                  .filter(shared * (100 + t) >= (F.col("_na") + F.col("_nb")) * t).select("u", "v"), "links")
    discard(nodes, sets)
    return links


def _distinct_cells(members: DataFrame) -> DataFrame:
    """One cell of each set of members: cells with the very same members hold
    the very same pairs, and alike documents share many cells."""
    sets = members.groupBy("cell").agg(F.bit_xor(F.xxhash64("fp")).alias("a"), F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("b"),
                                       F.count("*").alias("size"))
    keep = sets.groupBy("a", "b", "size").agg(F.min("cell").alias("cell")).select("cell")
    return members.join(keep, "cell")


def _mixed(members: DataFrame, by: str) -> DataFrame:
    """Members of cells that hold at least two values of ``by``."""
    from pyspark.sql import Window
    w = Window.partitionBy("cell")
    return (members.withColumns({"_lo": F.min(by).over(w), "_hi": F.max(by).over(w)})
            .filter("_lo <> _hi").drop("_lo", "_hi"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``: size of the
    shingle set, and the smallest id that links of Jaccard >= percent/100
    reach."""
    docs = docs.select(column_or_null(docs, id_col, "long").alias("id"),
                       column_or_null(docs, text_col, "string").alias("text"))
    meta = stage(map_batches(docs, _signature_pass(k, percent),
                             "id long, n long, fp long, vec binary, cells array<long>"), "sets")
    named = meta.filter("id is not null and n > 0")
    members = stage(_mixed(named.select(F.explode("cells").alias("cell"), "fp"), "fp").distinct(), "cells")
    need = F.get(F.array(*[F.lit(_slabs(c, percent)[1]) for c in range(MAX_CLASS)]), F.col("class"))
    for _ in range(2):                     # a document left out may leave others without company
        size_class = F.col("cell").bitwiseAND(63).cast("int")
        enough = (members.groupBy("fp", size_class.alias("class")).agg(F.count("*").alias("held"))
                  .filter(F.col("held") >= need).select("fp", "class"))
        members, old = stage(_mixed(members.withColumn("class", size_class).join(enough, ["fp", "class"]).select("cell", "fp"), "fp"), "cells"), members
        discard(old)
    members, old = stage(_distinct_cells(members), "cells"), members
    discard(old)

    points = (named.join(members.select("fp").distinct(), "fp", "left_semi").groupBy("fp", "n", "vec")
              .agg(F.min("id").alias("id"), F.count("*").alias("rows"), F.count_distinct("id").alias("ids")))
    points = stage(points.select("fp", "n", "vec", "id", (F.col("rows") > F.col("ids")).alias("again")), "points")
    known = stage(meta.select("id", "n", "fp"), "known")
    discard(meta)

    def blocks(rows: DataFrame, by: str, parts) -> DataFrame:
        """Rows (``by``, fp, ...) for each pair (lo, hi) of blocks of their cell or
        group that they take part in, sorted by it."""
        of = rows.groupBy(by).agg(F.ceil(parts).cast("int").alias("parts"))
        return (rows.join(of, by).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                .withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}).drop("parts", "other"))

    def runs(rows: DataFrame, by: str) -> DataFrame:
        return rows.repartition(by, "lo", "hi").sortWithinPartitions(by, "lo", "hi", "fp")

    # star: each member against the smallest of its cells' smallest members
    hub = members.groupBy("cell").agg(F.min("fp").alias("hub"))
    star = members.join(hub, "cell").groupBy("fp").agg(F.min("hub").alias("u")).filter("u <> fp").select("u", F.col("fp").alias("v"))
    checked = stage(_bounded(star, points, percent), "pairs")
    links = _verified(checked, points, docs, k, percent)
    root = components(links)

    # R-tree joins of the cells that hold several components so far (cells of two
    # members have one pair, bounded without a tree): what may still be connected
    open_ = (members.join(root.withColumnRenamed("node", "fp"), "fp", "left")
             .select("cell", "fp", F.coalesce("root", "fp").alias("comp")))
    open_ = stage(_mixed(open_, "comp"), "open")
    sizes = stage(open_.groupBy("cell").agg(F.count("*").alias("size"), F.min("fp").alias("u"), F.max("fp").alias("v"),
                                            F.min("comp").alias("cu"), F.max("comp").alias("cv")), "sizes")
    two = _bounded(sizes.filter("size = 2").select("u", "v", "cu", "cv").distinct(), points, percent)
    cells_ = open_.join(sizes.filter("size > 2").select("cell"), "cell", "left_semi")
    trees = runs(blocks(cells_, "cell", F.count("*") / BLOCK).join(points.select("fp", "n", "vec"), "fp"), "cell")
    alike = map_batches(trees, _tree_pass(percent), "u long, v long").unionByName(two.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
    alike = components(alike)
    discard(open_, sizes, members)

    # groups of components: whole sets, every link between components
    alike = alike.unionByName(alike.select(F.col("root").alias("node"), "root").distinct())
    grouped = (points.select("fp", "id", "n").join(root.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "id", "n", F.coalesce("root", "fp").alias("comp"))
               .join(alike.select(F.col("node").alias("comp"), F.col("root").alias("group")), "comp"))
    grouped = stage(grouped, "groups")
    done = (grouped.groupBy("group").agg(F.count("*").alias("size"), F.min("fp").alias("u"), F.max("fp").alias("v")).filter("size = 2")
            .join(checked, ["u", "v"], "left_semi").select("group"))        # their one pair is no link
    nodes = stage(grouped.join(done, "group", "left_anti"), "nodes")
    whole = blocks(_token_sets(nodes, points, docs, k), "group", F.greatest(F.count("*") / BLOCK, F.sum("n") / TOKENS))
    more = stage(map_batches(runs(whole.select("group", "lo", "hi", "part", "fp", "comp", "tokens"), "group"), _link_pass(percent),
                             "u long, v long"), "links")
    discard(grouped, nodes)
    root = components(links.unionByName(more))
    discard(points, checked)

    out = (known.join(root.withColumnRenamed("node", "fp"), "fp", "left")
           .withColumn("root", F.coalesce("root", "fp")))
    least = out.filter("id is not null and n > 0").groupBy("root").agg(F.min("id").alias("least"))
    return (out.join(least, "root", "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("least")))
                    .otherwise(F.col("id")).alias("component_id")))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id
    stays.  Rows without an id or without words stay; of rows that repeat a
    staying id in every column, one stays."""
    who = jaccard_components(docs)
    gone = stage(who.filter("component_id <> id").select("id").distinct(), "gone")
    again = stage(who.filter("id is not null").groupBy("id").count().filter("count > 1").select("id"), "again")
    gone_id, again_id = safe_name(docs.columns, "_gone"), safe_name(docs.columns, "_again")

    def rows(of: DataFrame, ids: DataFrame, name: str, how: str) -> DataFrame:
        return of.join(ids.select(ids["id"].alias(name)), of["doc_id"] == F.col(name), how)

    clear, others = apart(docs, docs["doc_id"].cast("long"), gone)
    kept = clear.unionByName(rows(others, gone, gone_id, "left_anti"))
    if again.isEmpty():
        return kept
    return rows(kept, again, again_id, "left_anti").unionByName(rows(kept, again, again_id, "left_semi").dropDuplicates())


def q_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {"op2_ngram_join": q_ngram_join}
ORACLES: dict = {}

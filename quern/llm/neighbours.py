"""Problem 6: the most similar vectors of every vector, through an inverted multi-index.

The two halves of the unit vectors are quantised separately by k-means codebooks, so that a cell is a pair of centroids.
Each vector is an entry of the cell of its nearest pair and asks the cells that a heap yields in order of summed distance
(the multi-sequence traversal). The cells of a first-half centroid form one group, or several groups of neighbouring cells
where they hold more than GROUP_BYTES; a vector travels once, packed as 16-bit integers, to each of the first MAX_GROUPS
groups that the traversal meets, whatever the number of groups. All cells of a group are answered there by matrix products
in blocks; only the best of a block are kept, so that memory does not depend on how many pairs are similar. Found pairs
count for both ends, so that a pair is lost only if the traversals of both miss it.

Costs grow with rows * cells * cell size; the number of centroids grows with the root of the rows, which keeps the mean
cell size. A single cell beyond GROUP_BYTES is split by key, and those who ask it go to each of its slices. Of equal vectors
only the first top + 1 by key are indexed: they are nearest to all further copies, which are given them without a search.

Documented sample: codebooks and group sizes are fitted on at most SAMPLE_ROWS vectors (and SAMPLE_BYTES) a model, chosen by
hash of the key; every row is indexed and every row asks. Defined results: a vector that is null, zero, not finite, with
null elements or of another length than stated takes no part, nor does one without key or model; equal similarity ranks by
key; repeated rows are one; other columns are ignored; empty input gives no pairs; more than MAX_MODELS models are refused.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quern.runtime import BROADCAST_BYTES, broadcast_bytes, cut

SAMPLE_ROWS, SAMPLE_BYTES, MAX_MODELS = 16_384, 32 << 20, 256
#: Rows for each centroid of a half: centroids = sqrt(rows) / CENTROID_ROOT, at least SAMPLED sample rows for each.
CENTROID_ROOT, SAMPLED = 8, 4
#: Cells that a vector asks, and groups to which it travels.
PROBES = 24
MAX_GROUPS = 4
#: Bytes of the entries of a group as floats.
GROUP_BYTES = 10 << 20
#: Values of one block of the similarity matrix, and pairs that are kept before they are cut to the best.
BLOCK, PAIRS = 2_000_000, 2_000_000
#: Vectors with surplus copies up to which their hashes are broadcast.
COPIED = 100_000

ROUTED = "model int, c1 int, part bigint, key string, is_entry boolean, c2 smallint, cells array<smallint>, packed binary"


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids by Lloyd's rounds from a fixed, spread start."""
    if k >= len(x) or x.shape[1] == 0:
        return x[:1].copy() if x.shape[1] == 0 else x[:k].copy()
    rng = np.random.default_rng(7)
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = (x @ centroids.T - 0.5 * (centroids * centroids).sum(1)).argmax(1)
        sums = np.zeros_like(centroids, dtype=np.float64)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids).astype(np.float32)
    return centroids


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (centroids * centroids).sum(1) - 2.0 * (x @ centroids.T)


def usable_vectors(vectors: pa.Array, dimensions: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of the usable vectors and their unit vectors (float32), grouped as (positions, matrix) by length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    stated = dimensions.to_numpy(zero_copy_only=False)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = np.nan_to_num(lengths.astype(np.float64), nan=-1).astype(np.int64)
    stated = np.nan_to_num(stated.astype(np.float64), nan=-2).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))[:-1]]) if len(lengths) else np.zeros(0, np.int64)
    out = []
    for d in np.unique(lengths[(lengths == stated) & (lengths > 0)]):
        rows = np.flatnonzero((lengths == d) & (stated == d))
        x = flat[starts[rows][:, None] + np.arange(d)]
        top = np.abs(x).max(1)
        good = np.isfinite(x).all(1) & (top > 0)
        rows, x = rows[good], x[good] / top[good][:, None]
        if len(rows):
            out.append((rows, (x / np.sqrt((x * x).sum(1))[:, None]).astype(np.float32)))
    return out


def traverse(d1: np.ndarray, d2: np.ndarray, part_of: np.ndarray | None = None, probes: int = PROBES, groups: int = MAX_GROUPS) -> list[tuple[int, int, list[int]]]:
    """Centroid pairs in order of summed distance, by a heap: [(first-half centroid, part, its second-half centroids)] of the
    first groups; part_of[c1, c2] is the part of a cell."""
    o1, o2 = np.argsort(d1, kind="stable")[:groups].tolist(), np.argsort(d2, kind="stable")[:probes].tolist()
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    heap, found = [(s1[0] + s2[0], 0, 0)], {}
    for _ in range(probes):
        if not heap:
            break
        _, i, j = heapq.heappop(heap)
        group = (o1[i], 0 if part_of is None else int(part_of[o1[i], o2[j]]))
        if group in found or len(found) < groups:
            found.setdefault(group, []).append(o2[j])
        if j + 1 < len(o2):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(o1):
            heapq.heappush(heap, (s1[i + 1] + s2[0], i + 1, 0))
    return [(c1, part, cells) for (c1, part), cells in found.items()]


def group_parts(near1: np.ndarray, near2: np.ndarray, second: np.ndarray, k1: int, n: int, entries: int) -> tuple[np.ndarray | None, dict[tuple[int, int], int]]:
    """(part of each cell, slices of cells that alone exceed entries), from the cells of the sample; None: all groups are whole.

    The second-half centroids are cut in the order of their main direction, so that cells asked together share a part.
    """
    k2 = len(second)
    scale = n / max(1, len(near1))
    sizes = np.bincount(near1 * k2 + near2, minlength=k1 * k2).reshape(k1, k2) * scale
    slices = {(int(i), int(j)): math.ceil(sizes[i, j] / entries) for i, j in np.argwhere((sizes > entries) & (sizes > 8 * scale))}
    totals = sizes.sum(1)
    if not slices and totals.max(initial=0) <= entries:
        return None, {}
    centred = second - second.mean(0)
    direction = np.linalg.svd(centred, full_matrices=False)[2][0] if second.shape[1] and k2 > 1 else np.zeros(second.shape[1])
    order = np.argsort(centred @ direction, kind="stable")
    part_of = np.zeros((k1, k2), np.int32)
    share = (sizes.sum(0) + 1.0)[order] / (sizes.sum() + k2)
    for c1 in range(k1):
        parts = math.ceil(totals[c1] / entries)
        if parts > 1:
            # few sample rows stand for a cell: its share among all first-half centroids steadies the cut
            own = sizes[c1][order] / totals[c1] + share
            part_of[c1, order] = np.minimum((np.cumsum(own) - own / 2) / own.sum() * parts, parts - 1).astype(np.int32)
    for number, (c1, c2) in enumerate(sorted(slices)):
        part_of[c1, c2] = (1 << 20) + number  # a group of its own
    return part_of, slices


def fit_codebooks(vectors: DataFrame, sample_rows: int = SAMPLE_ROWS, group_bytes: int = GROUP_BYTES) -> dict:
    """{(model, dimensions): {id, first, second, part_of, slices}} from the bounded sample; rows: (key, model, dimensions, vector)."""
    counts = {(r["model"], r["dimensions"]): r["count"] for r in vectors.groupBy("model", "dimensions").count().limit(MAX_MODELS + 1).collect()}
    if len(counts) > MAX_MODELS:
        raise ValueError(f"more than {MAX_MODELS} models and dimensions")
    spread = F.pmod(F.xxhash64("key"), F.lit(1 << 20))
    books: dict = {}
    for some in _sampled_together(counts, sample_rows):
        keep = F.lit(False)
        for model, dims in some:
            share = min(1 << 20, math.ceil((1 << 20) * _sample_of(dims, sample_rows) / counts[(model, dims)]))
            keep = keep | ((F.col("model") == model) & (F.col("dimensions") == dims) & (spread < share))
        sample = vectors.where(keep).select("key", "model", "dimensions", "vector").toArrow()
        models, keys = sample.column("model").to_pylist(), sample.column("key").to_pylist()
        for rows, x in usable_vectors(sample.column("vector"), sample.column("dimensions")):
            by: dict = {}
            for at, row in enumerate(rows.tolist()):
                by.setdefault(models[row], []).append((keys[row], at))
            for model, own in by.items():
                own.sort()
                y, dims = x[[at for _, at in own]], x.shape[1]
                n, h = counts[(model, dims)], (dims + 1) // 2
                fits = BROADCAST_BYTES // 2 // len(counts) // (4 * dims)
                k = max(1, min(len(y) // SAMPLED, fits, round(math.sqrt(n) / CENTROID_ROOT)))
                first, second = _kmeans(y[:, :h], k), _kmeans(y[:, h:], k)
                near1, near2 = _distances(y[:, :h], first).argmin(1), _distances(y[:, h:], second).argmin(1)
                part_of, slices = group_parts(near1, near2, second, len(first), n, max(1, group_bytes // (4 * dims)))
                books[(model, dims)] = {"first": first, "second": second, "part_of": part_of, "slices": slices}
    for i, key in enumerate(sorted(books)):
        books[key]["id"] = i
    return books


def _sample_of(dims: int, sample_rows: int) -> int:
    return max(SAMPLED, min(sample_rows, SAMPLE_BYTES // (4 * max(1, dims))))


def _sampled_together(counts: dict, sample_rows: int) -> Iterator[list]:
    """The models in lots whose samples are at most SAMPLE_BYTES."""
    lot: list = []
    size = 0
    for model, dims in sorted(counts):
        own = min(counts[(model, dims)], _sample_of(dims, sample_rows)) * 4 * dims
        if lot and size + own > SAMPLE_BYTES:
            yield lot
            lot, size = [], 0
        lot.append((model, dims))
        size += own
    if lot:
        yield lot


def route(batch: pa.RecordBatch, books: dict, probes: int = PROBES, groups: int = MAX_GROUPS) -> pa.RecordBatch:
    """The copies of each vector of a batch (key, model, dimensions, vector): one for each group that it asks, and for each
    slice of a cell that is split."""
    keys, models = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    cols: list[list] = [[] for _ in range(8)]
    for rows, x in usable_vectors(batch.column(3), batch.column(2)):
        h, by = (x.shape[1] + 1) // 2, {}
        for at, row in enumerate(rows.tolist()):
            by.setdefault(models[row], []).append(at)
        packed = np.round(x / np.abs(x).max(1)[:, None] * 32767).astype("<i2")
        for model, own in by.items():
            book = books.get((model, x.shape[1]))
            if book is None:
                continue
            d1, d2 = _distances(x[own][:, :h], book["first"]), _distances(x[own][:, h:], book["second"])
            for at, a, b in zip(own, d1, d2):
                key, data = keys[rows[at]], packed[at].tobytes()
                for rank, (c1, part, cells) in enumerate(traverse(a, b, book["part_of"], probes, groups)):
                    slices = book["slices"].get((c1, cells[0]), 1) if part >= 1 << 20 else 1
                    home = sum(key.encode()) % slices if rank == 0 else -1
                    for s in range(slices):
                        for col, v in zip(cols, (book["id"], c1, part << 24 | s, key, s == home, cells[0] if s == home else -1, cells, data)):
                            col.append(v)
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.int16(), pa.list_(pa.field("element", pa.int16())), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in ROUTED.split(", ")])


def _best(f: np.ndarray, t: np.ndarray, g: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The top pairs of each f by (g, t), each pair once."""
    order = np.lexsort((t, g, f))
    f, t, g = f[order], t[order], g[order]
    if len(f):
        # the same pair from two cells may differ in the last digit: the smaller gap counts
        again = np.lexsort((g, t, f))
        first = np.ones(len(f), bool)
        first[1:] = (f[again][1:] != f[again][:-1]) | (t[again][1:] != t[again][:-1])
        keep = np.zeros(len(f), bool)
        keep[again[first]] = True
        f, t, g = f[keep], t[keep], g[keep]
        begin = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
        place = np.arange(len(f)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(f)]])))
        f, t, g = f[place < top], t[place < top], g[place < top]
    return f, t, g


def _block_pairs(q: np.ndarray, e: np.ndarray, gap: np.ndarray, top: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, id, gap) for both ends of the pairs of a block that can be among the top of one of its rows or columns."""
    out = []
    for ids, others, g in ((q, e, gap), (e, q, gap.T)):
        if g.shape[1] > top:
            # (gap, id) as one number: its smallest of each row, ties by id
            rank = g.astype(np.int64) << 32 | others[None, :]
            at = np.argpartition(rank, top - 1, axis=1)[:, :top]
            i, j = np.repeat(np.arange(len(ids)), top), at.ravel()
        else:
            i, j = (a.ravel() for a in np.indices(g.shape))
        keep = g[i, j] <= most
        out.append((ids[i[keep]], others[j[keep]], g[i[keep], j[keep]]))
    return tuple(np.concatenate(c) for c in zip(*out))


def answer(group: pa.Table, top: int, least: float) -> pa.Table:
    """(key, neighbour, gap): for both ends, the best pairs of one group; gap is 1 - cosine in millionths."""
    schema = pa.schema([("key", pa.string()), ("neighbour", pa.string()), ("gap", pa.int32())])
    keys = np.array(group.column("key").to_pylist(), dtype=object)
    names, ids = np.unique(keys.astype(str), return_inverse=True)  # repeated rows are one; ids are in order of the keys
    packed = group.column("packed").combine_chunks()
    x = np.frombuffer(b"".join(packed.to_pylist()), "<i2").reshape(len(keys), -1).astype(np.float32)
    x /= np.sqrt((x * x).sum(1))[:, None]
    is_entry = group.column("is_entry").to_numpy(zero_copy_only=False).astype(bool)
    c2 = group.column("c2").to_numpy(zero_copy_only=False)
    cells = group.column("cells").combine_chunks()
    asked = cells.flatten().to_numpy(zero_copy_only=False)
    asker = np.repeat(np.arange(len(keys)), cells.value_lengths().to_numpy(zero_copy_only=False))
    order = np.argsort(asked, kind="stable")
    asked, asker = asked[order], asker[order]
    entries = np.flatnonzero(is_entry)
    entries = entries[np.argsort(c2[entries], kind="stable")]
    most = round((1 - least) * 1e6)
    found: list = []
    kept = 0
    bound = np.full(len(names), least - 1e-5, np.float32)  # what a pair must reach to be among the best of an id

    def keep_best() -> None:
        f, t, g = _best(*(np.concatenate(c) for c in zip(*found)), top)
        found[:] = [(f, t, g)]
        last = np.flatnonzero(np.bincount(f, minlength=len(names)) == top)
        bound[last] = 1.0 - (g[np.searchsorted(f, last, side="right") - 1] + 2) / 1e6

    for cell in np.unique(c2[entries]):
        whole = entries[slice(*np.searchsorted(c2[entries], [cell, cell + 1]))]
        q = asker[slice(*np.searchsorted(asked, [cell, cell + 1]))]
        width = max(1, min(len(whole), int(math.sqrt(BLOCK))))
        step = max(1, BLOCK // width)
        for begin in range(0, len(whole), width):
            e = whole[begin : begin + width]
            for at in range(0, len(q), step):
                part = q[at : at + step]
                s = x[part] @ x[e].T
                i, j = np.nonzero(s >= np.minimum(bound[ids[part]][:, None], bound[ids[e]][None, :]))
                if len(i) > 2 * top * (len(part) + len(e)):
                    gap = np.round((1.0 - np.minimum(s.astype(np.float64), 1.0)) * 1e6).astype(np.int32)
                    gap[ids[part][:, None] == ids[e][None, :]] = 1 << 30
                    pairs = _block_pairs(ids[part], ids[e], gap, top, most)
                    kept = PAIRS  # the bounds are raised at once
                else:
                    a, b = ids[part[i]], ids[e[j]]
                    g = np.round((1.0 - np.minimum(s[i, j].astype(np.float64), 1.0)) * 1e6).astype(np.int32)
                    keep = (a != b) & (g <= most)
                    a, b, g = a[keep], b[keep], g[keep]
                    pairs = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([g, g])
                found.append(pairs)
                kept += len(pairs[0])
                if kept > PAIRS:
                    keep_best()
                    kept = len(found[0][0])
    if not found:
        return schema.empty_table()
    keep_best()
    f, t, g = found[0]
    return pa.Table.from_arrays([pa.array(names[f].tolist(), pa.string()), pa.array(names[t].tolist(), pa.string()), pa.array(g)], schema=schema)


def nearest(cache: DataFrame, top: int = 5, least: float = 0.82, key: str = "cache_key", model: str = "model", dimensions: str = "dimensions", vector: str = "vector", probes: int = PROBES, groups: int = MAX_GROUPS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(key, neighbour, similarity): at most top rows a key, of similarity least or more."""
    spark = cache.sparkSession
    vectors = cache.select(F.col(key).cast("string").alias("key"), F.col(model).cast("string").alias("model"), F.col(dimensions).cast("int").alias("dimensions"), F.col(vector).cast("array<float>").alias("vector"))
    vectors = vectors.where("key IS NOT NULL AND model IS NOT NULL AND size(vector) = dimensions")
    vectors, surplus = without_surplus_copies(vectors, top)
    books = broadcast_bytes(spark, pickle.dumps(fit_codebooks(vectors, group_bytes=group_bytes)))

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = pickle.loads(books.value)
        for batch in batches:
            yield route(batch, fitted, probes, groups)

    def answers(group: pa.Table) -> pa.Table:
        return answer(group, top, least)

    routed = vectors.mapInArrow(copies, ROUTED)
    found = routed.groupBy("model", "c1", "part").applyInArrow(answers, "key string, neighbour string, gap int")
    # a key meets at most top rows from each group that it visits
    met = found.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("neighbour", "gap"))).alias("met"))
    # the same pair from two groups may differ in the last digit: the smaller gap counts
    once = F.filter("met", lambda m, i: (i == 0) | (F.try_element_at("met", i)["neighbour"] != m["neighbour"]))
    order = F.array_sort(F.transform(once, lambda m: F.struct(m["gap"].alias("gap"), m["neighbour"].alias("neighbour"))))
    best = met.select("key", F.slice(order, 1, top).alias("best"))
    rows = best.select("key", F.explode("best").alias("b")).select("key", F.col("b.neighbour").alias("neighbour"), (1 - F.col("b.gap") / 1e6).alias("similarity"))
    return rows if surplus is None else rows.unionByName(surplus)


def without_surplus_copies(vectors: DataFrame, top: int) -> tuple[DataFrame, DataFrame | None]:
    """The vectors without the copies beyond the first top + 1 keys of equal ones, and those copies' (key, neighbour, similarity).

    Only hashes are counted; where no vector has so many copies (the count is run when this is called), nothing else happens.
    """
    zero = F.forall("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")) | (v == 0))
    keyed = vectors.withColumn("_copy", F.struct("model", F.xxhash64("vector").alias("a"), F.hash("vector").alias("b")))
    often = keyed.where(~zero).groupBy("_copy").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > top + 1).select("_copy")
    classes = often.count()
    if not classes:
        return vectors, None
    often = F.broadcast(often) if classes <= COPIED else often
    single = keyed.join(often, "_copy", "left_anti").drop("_copy")
    # a repeated row is one copy
    copies = keyed.join(often, "_copy").groupBy("_copy", "key").agg(F.any_value("dimensions").alias("dimensions"), F.any_value("vector").alias("vector"))
    place = F.row_number().over(Window.partitionBy("_copy").orderBy("key"))
    first = cut(copies.withColumn("place", place).where(F.col("place") <= top + 1))
    whole = first.groupBy("_copy").agg(F.max("key").alias("last"), F.max("place").alias("n")).where(F.col("n") == top + 1)
    heads = first.where(F.col("place") <= top).select("_copy", F.col("key").alias("neighbour"))
    more = copies.join(whole, "_copy").where(F.col("key") > F.col("last")).select("_copy", "key")
    surplus = more.join(heads, "_copy").select("key", "neighbour", F.lit(1.0).alias("similarity"))
    return single.unionByName(first.select("key", F.col("_copy.model").alias("model"), "dimensions", "vector")), surplus


def neighbour_pairs(cache: DataFrame, top: int = 5, least: float = 0.82, **names) -> DataFrame:
    """(key_1, key_2), key_1 < key_2: pairs of which at least one is among the top most similar to the other."""
    near = nearest(cache, top, least, **names)
    return near.select(F.least("key", "neighbour").alias("key_1"), F.greatest("key", "neighbour").alias("key_2")).distinct()

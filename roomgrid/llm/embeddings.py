"""Embedding near-dedup by sorted projection passes.

1. Equal vectors are one node. A pass hashes each node to the signs of its products with
   random directions, put together to one number, most significant direction first, and
   sorts all nodes by it. Near vectors agree in most signs, so in some passes they agree in
   the leading ones and lie near each other. A common direction would make all signs alike,
   so a mean is taken off first: in even passes that of all vectors, in odd ones that of the
   node's cell, which is the nearest of some nodes picked by hash; a cell sorts by itself.
2. A node is compared with the next ``window`` nodes in the order, in blocks of the sorted
   order of bounded size; each block also gets the head of the next one. Of the pairs with a
   cosine of ``threshold`` or more (double precision) a block gives out those that join what
   was apart. Rounds of passes, each with its own directions and cells, are added until a
   whole round joins nothing any more.
3. A window is bounded, so a dense group has more pairs than its windows show. What the
   windows leave out is filled in exactly inside each component: members within half the
   threshold angle of the component's mean are all linked with each other, by the triangle
   inequality for angles, so they are counted, not compared; the others are compared with
   all members in blocks. Nothing is capped, and no pair is given out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import components, stored, table

PASSES = 12
BITS = 48
WINDOW = 512
_CELLS = 64  # of a round, about
THRESHOLD = 0.95
_BLOCK = 2048
_SEED = 20240229


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors with their length 1; ``usable`` rows only."""
    for batch in batches:
        m = batch.column("v").to_pylist()
        out = []
        for v in m:
            x = np.array(v, dtype=np.float64)
            x = x / np.abs(x).max()  # so that no square overflows or vanishes
            out.append((x / np.linalg.norm(x)).tolist())
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.list_(pa.float64()))], ["node", "u"])


def _cells(u: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return (u @ pivots.T).argmax(axis=1)


def _sums(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The number and the sum of a task's vectors in each cell."""
    total: dict[tuple[int, int], list] = {}
    for batch in batches:
        dims = np.array(batch.column("dim").to_pylist())
        for dim in set(dims.tolist()):
            m = _matrix(batch.column("u").take(pa.array(np.flatnonzero(dims == dim))))
            cell = _cells(m, pivots[dim])
            for c in set(cell.tolist()):
                n, x = total.get((dim, c), (0, 0.0))
                total[dim, c] = (n + int((cell == c).sum()), x + m[cell == c].sum(axis=0))
    columns = [[k[0] for k in total], [k[1] for k in total], [n for n, _ in total.values()], [x.tolist() for _, x in total.values()]]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["dim", "cell", "n", "x"])


def _centres(nodes: DataFrame, seed: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length of vectors: the nodes its cells are nearest to, and the cells' means, that of all vectors last."""
    counts = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}  # a row per length
    share = F.lit(1.0)
    for dim, n in counts.items():
        share = F.when(F.col("dim") == dim, _CELLS / n).otherwise(share)
    number = F.xxhash64("node", F.lit(seed)).bitwiseAND((1 << 52) - 1).cast("double") / float(1 << 52)
    pivots: dict[int, list] = {}
    for r in nodes.where(number < share).select("dim", "u").collect():
        pivots.setdefault(r["dim"], []).append(r["u"])
    fixed = {dim: np.array(pivots.get(dim, [[0.0] * dim])) for dim in counts}
    sums: dict[tuple[int, int], list] = {}
    for r in nodes.select("dim", "u").mapInArrow(lambda batches: _sums(batches, fixed), "dim int, cell int, n long, x array<double>").collect():
        n, x = sums.get((r["dim"], r["cell"]), (0, 0.0))
        sums[r["dim"], r["cell"]] = (n + r["n"], x + np.array(r["x"]))
    found = {}
    for dim, n in counts.items():
        means = np.zeros((len(fixed[dim]) + 1, dim))
        for (d, c), (k, x) in sums.items():
            if d == dim:
                # a cell of a few vectors has no common direction but its own
                means[c] = x / k if k >= _CELLS else 0.0
                means[-1] += x / n
        found[dim] = (fixed[dim], means)
    return found


def _keyed(batches: Iterator[pa.RecordBatch], passes: int, bits: int, seed: int, centres: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """A row per node and pass with the node's cell and number in the pass's order."""
    directions: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    odd = np.arange(passes) % 2 == 1
    for batch in batches:
        dims = np.array(batch.column("dim").to_pylist())
        keys = np.zeros((batch.num_rows, passes), dtype=np.int64)
        cells = np.full((batch.num_rows, passes), -1, dtype=np.int32)
        for dim in set(dims.tolist()):
            pivots, means = centres[dim]
            if dim not in directions:
                directions[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, passes * bits))
            at = np.flatnonzero(dims == dim)
            m = _matrix(batch.column("u").take(pa.array(at)))
            cell = _cells(m, pivots)
            product = (m @ directions[dim]).reshape(len(at), passes, bits)
            off = (means @ directions[dim]).reshape(len(means), passes, bits)
            signs = product > np.where(odd[None, :, None], off[cell], off[-1][None])
            keys[at] = (signs * weights).sum(axis=2)
            cells[at] = np.where(odd[None], cell[:, None], -1)
        node = pa.array(np.repeat(np.arange(batch.num_rows), passes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(node), batch.column("dim").take(node), pa.array(np.tile(np.arange(passes, dtype=np.int32), batch.num_rows)), pa.array(cells.ravel()), pa.array(keys.ravel())],
            ["node", "dim", "pass", "cell", "key"],
        )


def _near_in_block(rows: pa.Table, window: int, threshold: float) -> pa.Table:
    """Pairs of a block that join components: each own row with the next ``window`` ones."""
    rows = rows.sort_by("place")
    node, own, u = rows.column("node").to_numpy(), rows.column("own").to_numpy(), _matrix(rows.column("u").combine_chunks())
    label = np.unique(rows.column("component").to_numpy(), return_inverse=True)[1]
    a, b = [], []
    for at in range(0, len(node), 256):
        to = min(at + 256 + window, len(node))
        near = u[at : at + 256] @ u[at:to].T >= threshold
        ahead = np.arange(to - at)[None] - np.arange(len(near))[:, None]
        near &= (ahead > 0) & (ahead <= window) & own[at : at + 256, None] & (label[at : at + 256, None] != label[None, at:to])
        for k in np.flatnonzero(near.any(axis=1)):
            with_ = at + np.flatnonzero(near[k])
            others, first = np.unique(label[with_], return_index=True)
            first = first[others != label[at + k]]
            if len(first):
                a.append(np.full(len(first), node[at + k]))
                b.append(node[with_[first]])
                label[np.isin(label, others)] = label[at + k]
    a, b = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (a, b))
    return pa.table({"a": pa.array(np.maximum(a, b), pa.int64()), "b": pa.array(np.minimum(a, b), pa.int64())})


def _joining(nodes: DataFrame, found: DataFrame | None, threshold: float, passes: int, bits: int, window: int, seed: int) -> DataFrame:
    """Links (a, b) of one round of passes between nodes that are not in one component of ``found`` yet."""
    centres = _centres(nodes, seed)
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = nodes.sparkSession.sparkContext.broadcast(centres)
    keyed = nodes.select("node", "dim", "u").mapInArrow(lambda batches: _keyed(batches, passes, bits, seed, shared.value), "node long, dim int, pass int, cell int, key long")
    # the order of each pass as places: sorted ranges are written, so a place stays what it is
    order = ["dim", "pass", "cell", "key", "node"]
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = stored(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), "order", 1 << 14)
    upto = {r["part"]: r["n"] for r in ordered.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a row per task of the sort
    starts, total = [], 0
    for k in range(max(upto, default=-1) + 1):
        starts.append(total)
        total += upto.get(k, 0)
    begin = F.array(*[F.lit(x).cast("long") for x in starts or [0]])
    of = nodes.select("node", "u", F.col("node").alias("component")) if found is None else nodes.join(found, "node", "left").select("node", "u", F.coalesce("component", "node").alias("component"))
    placed = ordered.select("node", "dim", "pass", (begin[F.col("part")] + F.col("at")).alias("place")).join(of, "node")
    block = F.floor(F.col("place") / _BLOCK)
    window = min(window, _BLOCK)
    halo = (F.col("place") % _BLOCK < window) & (F.col("place") >= _BLOCK)
    shares = F.explode(F.when(halo, F.array(F.struct(block.alias("block"), F.lit(True).alias("own")), F.struct((block - 1).alias("block"), F.lit(False).alias("own")))).otherwise(F.array(F.struct(block.alias("block"), F.lit(True).alias("own")))))
    blocks = placed.select("node", "component", "dim", "pass", "place", "u", shares.alias("s")).select("node", "component", "dim", "pass", "place", "u", "s.block", "s.own")
    return blocks.groupBy("block", "dim", "pass").applyInArrow(lambda t: _near_in_block(t, window, threshold), "a long, b long")


def _counts_in_blocks(rows: pa.Table, threshold: float) -> pa.Table:
    """For the rows of ``left`` (not central): how many copies of the ``right`` rows are linked with each, and back."""
    left, right = (rows.filter(rows.column("left") if side else pa.compute.invert(rows.column("left"))) for side in (True, False))
    nodes, counts = [], []
    u, v = _matrix(left.column("u").combine_chunks()), _matrix(right.column("u").combine_chunks())
    ln, rn = left.column("node").to_numpy(), right.column("node").to_numpy()
    lk, rk = left.column("copies").to_numpy(), right.column("copies").to_numpy()
    central = right.column("central").to_numpy()
    back = np.zeros(len(rn), dtype=np.int64)
    for at in range(0, len(ln), 256):
        linked = (u[at : at + 256] @ v.T >= threshold) & (ln[at : at + 256, None] != rn[None])
        nodes.append(ln[at : at + 256])
        counts.append(linked @ rk)
        back += (linked * lk[at : at + 256, None]).sum(axis=0) * central
    nodes.append(rn[back > 0])
    counts.append(back[back > 0])
    return pa.table({"node": pa.array(np.concatenate(nodes), pa.int64()), "n": pa.array(np.concatenate(counts), pa.int64())})


def near_duplicates(
    df: DataFrame,
    vec: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    passes: int = PASSES,
    bits: int = BITS,
    window: int = WINDOW,
    seed: int = _SEED,
) -> DataFrame:
    """Per row of ``df``: its id, ``n_links``, ``component_id`` and ``kept``.

    ``n_links`` counts the other rows linked directly, copies each by itself; ``component_id``
    is the smallest id that links reach, and the row with that id is ``kept``. A vector that is
    null, empty, all zero, or holds a null, an infinity or no number links with nothing.
    Vectors of different lengths never link. Rows that share an id are vectors of their own.
    A row without an id counts as a link of others; it gets the smallest id it reaches, or
    null, and is kept in the latter case. Other columns are ignored; an empty table gives no
    rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(vec).cast("long").alias("vec"), F.col(embedding).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = stored(rows.withColumn("v", F.when(F.coalesce(good, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0)))).withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "vectors", 4096)
    usable = rows.where("node is not null")
    copies = usable.groupBy("node").agg(F.count("*").alias("copies"), F.min("vec").alias("least"), F.any_value("v").alias("v"))
    units = copies.select("node", "v").mapInArrow(_units, "node long, u array<double>")
    nodes = stored(units.join(copies.select("node", "copies", "least"), "node").withColumn("dim", F.size("u")), "nodes", 1024)

    # a round whose links join nothing ends it; every other one leaves fewer components
    links = stored(_joining(nodes, None, threshold, passes, bits, window, seed), "pairs")
    found, number = stored(components(links), "found"), 0
    while True:
        number += 1
        more = stored(_joining(nodes, found, threshold, passes, bits, window, seed + number), "pairs")
        if more.isEmpty():
            break
        links = links.union(more)
        found = stored(components(links), "found")

    members = stored(nodes.join(found, "node"), "members", 1024)  # those that have a link
    sums = members.select("component", F.posexplode("u").alias("k", "x")).groupBy("component", "k").agg(F.sum("x").alias("x"))
    middle = sums.groupBy("component").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("m"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    half = math.cos(math.acos(threshold) / 2) + 1e-9
    product = F.aggregate(F.zip_with("u", "m", lambda x, m: x * m["x"]), F.lit(0.0), lambda a, x: a + x) / F.col("norm")
    central = stored(members.join(middle, "component").select("node", "component", "copies", "u", (product >= half).alias("central")), "central", 1024)
    per = central.groupBy("component").agg(F.count("*").alias("size"), F.sum(F.when(F.col("central"), F.col("copies")).otherwise(0)).alias("inner"), F.sum(F.when(~F.col("central"), 1).otherwise(0)).alias("outer"))
    counted = central.where("central").join(per, "component").select("node", (F.col("inner") - F.col("copies")).alias("n"))
    # the rest of a component against all of it, a block of each at a time
    rest = central.join(per.where("outer > 0"), "component")
    lefts, rights = F.ceil(F.col("outer") / _BLOCK), F.ceil(F.col("size") / _BLOCK)
    row = rest.withColumn("i", F.pmod(F.hash("node"), lefts)).withColumn("j", F.pmod(F.hash("node"), rights))
    some = row.where("not central").select("component", F.col("i"), F.explode(F.sequence(F.lit(0).cast("long"), rights - 1)).alias("j"), "node", "copies", "u", "central", F.lit(True).alias("left"))
    every = row.select("component", F.explode(F.sequence(F.lit(0).cast("long"), lefts - 1)).alias("i"), F.col("j"), "node", "copies", "u", "central", F.lit(False).alias("left"))
    met = some.unionByName(every).groupBy("component", "i", "j").applyInArrow(lambda t: _counts_in_blocks(t, threshold), "node long, n long")
    linked_with = counted.unionByName(met).groupBy("node").agg(F.sum("n").alias("n"))

    named = nodes.select("node", "copies", "least").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(linked_with, "node", "left")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = named.join(ids, "component").select("node", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"))
    linked = usable.select("vec", "node").join(answer, "node").select("vec", "n_links", "component_id")
    alone = rows.where("node is null").select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"))
    return linked.union(alone).select(F.col("vec").alias(vec), "n_links", "component_id", F.col("vec").eqNullSafe(F.col("component_id")).alias("kept"))


def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))

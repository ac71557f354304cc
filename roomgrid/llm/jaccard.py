"""N-gram Jaccard join: documents whose shingle sets are nearly equal, found exactly.

Two sets of s and l shingles with a Jaccard similarity of T percent or more differ in at most
``(s + l)(100 - T) / (100 + T)`` elements. Sets are put into bands of sizes, each wide enough
that partners lie in the same or in adjacent bands; a *class* is a band with the one below,
and H is the largest possible difference in it.

*Universe partition.* In a class, hashes deal the elements to segments; each segment has a
tolerance, and the segments' tolerances, one more each, sum to more than H. So two similar sets
have a segment in which they differ in no more elements than it tolerates. A segment of
tolerance d is cut into parts, and every subset of all but d parts is a key: one subset holds
none of the differences. Or, for a tolerance of one, the segment and what is left of it
without any one of its elements are keys (one-deletion neighbours). ``allocation`` chooses by
cost: more tolerance means fewer, larger segments and keys that hold more elements, so that
unrelated sets share them less (mostly keys without any element are shared), but more keys for
a set. What pairs cost grows with the square of the number of sets, so large tables get more
tolerance.

*Candidates.* The sets that share a key are a list. All of them are compared with its first;
then only those of a list that are still in different components are compared with each
other, so a list of copies costs a row each. That second comparison takes a list in blocks of
bounded size and gives out only pairs that a sketch allows: the parities of the elements in
2048 buckets, or in as many as a larger set has elements. Two sets whose parities differ in k
buckets differ in k elements at least, so the sketch refuses no pair that is similar.

*Verification* compares the sets themselves. Equal sets are one node, known by a 64-bit sum
of their mixed shingle hashes; elements are 64-bit hashes too, which is the only way in which
the result is not exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import components, stored, table
from roomgrid.llm.shingles import chunks, mixed, shingle_sets, text_bytes
from roomgrid.session import release_shuffles

_U = np.uint64
_BUCKETS = 2048  # of a sketch, or as many as the set has elements
_BLOCK = 2048  # sets of a list that meet others of the list in one step
# Only costs depend on these: the share of elements that unrelated sets have in common, and
# how many keys a pair to be compared costs.
SHARED_ELEMENTS, PAIR_COST = 0.1, 16
_MOST_PARTS, _MOST_SUBSETS = 9, 126
_KEY_BYTES, _WORD_BYTES = 12, 6  # of a shuffled key and of a word of text, about


def size_bands(percent: int, largest: int) -> np.ndarray:
    """Upper bounds of the bands 0, 1, ...; the last is at least ``largest``."""
    bounds = [0]
    while bounds[-1] < largest:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 100 // percent))
    return np.array(bounds)


def most_different(percent: int, bound: int) -> int:
    """H of the class whose largest sets have ``bound`` elements."""
    return 2 * bound * (100 - percent) // (100 + percent)


class Scheme(NamedTuple):
    """``segments`` of ``parts`` parts, of which ``drop`` may differ; the last ``deletions`` segments tolerate a deletion instead."""

    segments: int = 0
    parts: int = 1
    drop: int = 0
    deletions: int = 0

    def tolerated(self) -> int:
        """Sets that differ in no more elements share a key."""
        return (self.segments - self.deletions) * (self.drop + 1) + 2 * self.deletions - 1

    def keys(self, elements: float) -> float:
        """Keys of a set, about."""
        each = elements / self.segments
        return (self.segments - self.deletions) * math.comb(self.parts, self.drop) + self.deletions * (1 + each)

    def shared(self, elements: float) -> float:
        """Keys that two unrelated sets share, about: those for which either set has only common elements."""
        each = 2 * (1 - SHARED_ELEMENTS) * elements / self.segments  # elements of a segment that are in one set only; Poisson
        whole = (self.segments - self.deletions) * math.comb(self.parts, self.drop) * math.exp(-each * (self.parts - self.drop) / self.parts)
        return whole + self.deletions * math.exp(-each) * (1 + each / 2) ** 2


def schemes(different: int) -> list[Scheme]:
    """All ways looked at to find sets that differ in ``different`` elements."""
    found = [Scheme(different + 1 - (different + 1) // 2, deletions=(different + 1) // 2)]
    for drop in range(0, min(different, _MOST_PARTS - 2) + 1):
        for parts in range(drop + 1, _MOST_PARTS + 1) if drop else [1]:
            if math.comb(parts, drop) <= _MOST_SUBSETS:
                found.append(Scheme(-(-(different + 1) // (drop + 1)), parts, drop))
    return found


@lru_cache(4096)
def allocation(percent: int, bound: int, sets: int) -> Scheme:
    """The scheme of a class of least cost if ``sets`` sets of ``bound`` elements are in it.

    The cost is the keys of all sets, plus the pairs of unrelated sets that share one.
    """

    def cost(scheme: Scheme) -> float:
        return sets * scheme.keys(bound) + PAIR_COST * 0.5 * sets * sets * scheme.shared(bound)

    return min(schemes(most_different(percent, bound)), key=cost)


def _sums(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit numbers by group, wrapping around; exact, as each half is summed below 2^53."""
    low = np.bincount(group, weights=(values & _U(0xFFFFFFFF)).astype(np.float64), minlength=n).astype(np.uint64)
    high = np.bincount(group, weights=(values >> _U(32)).astype(np.float64), minlength=n).astype(np.uint64)
    return low + (high << _U(32))


def set_keys(sets: np.ndarray, first: np.ndarray, bounds: np.ndarray, plan: list[Scheme], turn: int = 0, rounds: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets and the set of each key. ``plan[c]``: scheme of class c; no segments: no keys.

    Of several ``rounds`` each has the keys of its own segments.
    """
    n = len(first) - 1
    size = np.diff(first)
    owner = np.repeat(np.arange(n), size)
    band = np.searchsorted(bounds, size)
    value, place = mixed(sets + _U(0xA0761D6478BD642F)), mixed(sets + _U(0xE7037ED1A0B428DB))
    kinds = sorted({scheme[1:3] for scheme in plan})
    kind_of = np.array([kinds.index(scheme[1:3]) for scheme in plan])
    segments_of, deletions_of = (np.array([scheme[k] for scheme in plan], dtype=np.int64) for k in (0, 3))
    keys, owners = [], []
    for up in (0, 1):
        cls = band + up
        for kind in np.unique(kind_of[cls]).tolist():
            parts, drop = kinds[kind]
            many = segments_of[cls] * ((size > 0) & (kind_of[cls] == kind))
            base = np.concatenate([[0], np.cumsum(many)])
            if not base[-1]:
                continue
            used = many[owner] > 0
            element, mine = np.flatnonzero(used), owner[used]
            segment = ((place[element] >> _U(24)) % many[mine].astype(np.uint64)).astype(np.int64)
            at = base[mine] + segment
            part = ((place[element] & _U(0xFFFFFF)) % _U(parts)).astype(np.int64)
            total = _sums(value[element], at * parts + part, int(base[-1]) * parts).reshape(-1, parts)
            of = np.repeat(np.arange(n), many)
            number = np.arange(int(base[-1])) - base[of]
            salt = mixed((cls[of].astype(np.uint64) << _U(32)) + number.astype(np.uint64))
            now = number % rounds == turn
            deletes = now & (number >= segments_of[cls[of]] - deletions_of[cls[of]])
            for k, subset in enumerate(combinations(range(parts), parts - drop)):
                keys.append(mixed(total[now][:, subset].sum(axis=1, dtype=np.uint64) + salt[now] + _U(k)))
                owners.append(of[now])
            deleted = deletes[at]
            if deleted.any():
                keys.append(mixed(total[at[deleted], 0] - value[element[deleted]] + salt[at[deleted]]))
                owners.append(mine[deleted])
    if not keys:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return keys[order], owners[order]


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _longs(values))


def _blocks(batches: Iterator[pa.RecordBatch], size: int):
    """(batch rows, sets, offsets) of a stream of (doc, text), a few hundred kilobytes of text at a time."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in chunks(offsets):
            sets, first = shingle_sets(data, offsets[a : b + 1], size)
            yield batch.slice(a, b - a), sets, first


def _node(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return mixed(_sums(mixed(sets), owner, len(first) - 1) + np.diff(first).astype(np.uint64))


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, node) in order, the rows of keys with two nodes or more, each with the key's first node."""
    held: tuple[int, int] | None = None  # a key and its first node, not given out as yet
    open_key, open_first = None, None  # the last key, if it was found to be shared
    last = None
    for batch in batches:
        key, node = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        if held is not None:
            key, node = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], node])
        if not len(key):
            continue
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        if held is None and last is not None:
            new[0] = (key[0], node[0]) != last
        last = (key[-1], node[-1])
        key, node = key[new], node[new]
        if not len(key):
            continue
        begin = np.ones(len(key), dtype=bool)
        begin[1:] = key[1:] != key[:-1]
        group = np.cumsum(begin) - 1
        first = node[begin][group]
        size = np.bincount(group)
        shared = size[group] > 1
        if open_key is not None and key[0] == open_key:
            shared |= group == 0
            first = np.where(group == 0, open_first, first)
        held = None
        if shared[-1]:
            open_key, open_first = key[-1], first[-1]
        else:
            open_key, held = None, (key[-1], node[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[shared]) for x in (key, node, first)], ["key", "node", "first"])


def _folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches with ``size`` bytes each: the halves of a larger one are put together."""
    out = np.empty((len(sketches), size // 8), dtype=np.uint64)
    lengths = np.array([len(x) for x in sketches])
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        some = np.frombuffer(b"".join(sketches[k] for k in at.tolist()), dtype=np.uint64).reshape(len(at), -1, size // 8)
        out[at] = np.bitwise_xor.reduce(some, axis=1)
    return out


def _near_enough(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (x, y, nx, ny, bx, by) whose sketches allow the similarity."""
    for batch in batches:
        bx, by = batch.column("bx").to_pylist(), batch.column("by").to_pylist()
        size = np.array([min(len(x), len(y)) for x, y in zip(bx, by)])
        least = np.zeros(len(size), dtype=np.int64)
        for some in np.unique(size).tolist():
            at = np.flatnonzero(size == some)
            left, right = (_folded([side[k] for k in at.tolist()], some) for side in (bx, by))
            least[at] = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
        both = batch.column("nx").to_numpy() + batch.column("ny").to_numpy()
        fits = pa.array(least * (100 + percent) <= both * (100 - percent))
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(fits) for k in ("x", "y")], ["x", "y"])


def _pairs_in_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components from rows in order of (key, i, j), as the sketches allow.

    Rows of a (key, i, j) are the sets of blocks i and j of a list; only pairs between the
    two blocks are meant, and within the block if i = j.
    """
    names = ["key", "i", "j", "node", "block", "component", "n"]
    held: list[np.ndarray] | None = None
    bits: list[bytes] = []

    def compare(rows: list[np.ndarray], sketches: list[bytes]) -> pa.RecordBatch:
        sketch = _folded(sketches, min(map(len, sketches)))
        i, j, node, block, component, n = rows[1][0], rows[2][0], *rows[3:]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        x, y = [], []
        for at in range(0, len(left), 64):  # so many rows of one block against the whole other
            some = left[at : at + 64]
            apart = component[some][:, None] != component[right][None]
            if i == j:
                apart &= node[some][:, None] < node[right][None]
            small, large = np.minimum(n[some][:, None], n[right][None]), np.maximum(n[some][:, None], n[right][None])
            a, b = np.nonzero(apart & (100 * small >= percent * large))
            for k in range(0, len(a), 1 << 15):
                p, q = some[a[k : k + (1 << 15)]], right[b[k : k + (1 << 15)]]
                least = np.bitwise_count(sketch[p] ^ sketch[q]).sum(axis=1, dtype=np.int64)
                fits = least * (100 + percent) <= (n[p] + n[q]) * (100 - percent)
                x.append(node[p[fits]])
                y.append(node[q[fits]])
        x, y = (np.concatenate(v) if v else np.empty(0, dtype=np.int64) for v in (x, y))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["x", "y"])

    for batch in batches:
        rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in names]
        sketch = batch.column("bits").to_pylist()
        if held is not None:
            rows, sketch = [np.concatenate(v) for v in zip(held, rows)], bits + sketch
        if not len(rows[0]):
            continue
        change = np.flatnonzero(np.any([r[1:] != r[:-1] for r in rows[:3]], axis=0)) + 1
        edges = [0, *change.tolist()]
        for a, b in zip(edges, edges[1:]):
            yield compare([r[a:b] for r in rows], sketch[a:b])
        held, bits = [r[edges[-1] :] for r in rows], sketch[edges[-1] :]
    if held is not None and len(held[0]):
        yield compare(held, bits)


def _similar(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (x, y, sx, sy) of sorted sets that are as similar as asked."""
    for batch in batches:
        columns = [batch.column(k) for k in ("sx", "sy")]
        values = [c.flatten().to_numpy() for c in columns]
        offsets = [np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy())]) for c in columns]
        fits = np.zeros(batch.num_rows, dtype=bool)
        for k in range(batch.num_rows):
            a, b = (v[o[k] : o[k + 1]] for v, o in zip(values, offsets))
            place = np.minimum(np.searchsorted(a, b), len(a) - 1)
            common = int((a[place] == b).sum())
            fits[k] = 100 * common >= percent * (len(a) + len(b) - common)
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(fits)) for k in ("x", "y")], ["a", "b"])


def _parities(sets: np.ndarray, first: np.ndarray) -> pa.Array:
    """Sketches: the parities of the elements in the buckets, a power of two of them."""
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    many = np.maximum(_BUCKETS, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(many // 64)])
    bucket = mixed(sets + _U(0x589965CC75374CC3)) & (many[owner] - 1).astype(np.uint64)
    bits = np.zeros(int(begin[-1]), dtype=np.uint64)
    np.bitwise_xor.at(bits, begin[owner] + (bucket >> _U(6)).astype(np.int64), _U(1) << (bucket & _U(63)))
    raw = bits.tobytes()
    return pa.array([raw[8 * a : 8 * b] for a, b in zip(begin, begin[1:])], pa.binary())


class _Join:
    """The stored tables of one join."""

    def __init__(self, docs: DataFrame, size: int, percent: int) -> None:
        """``docs``: (doc, h, text); ``h`` tells texts of one id apart."""
        self.docs, self.size, self.percent = docs, size, percent
        self.sizes = stored(docs.mapInArrow(self._sizes(), "doc long, h long, n long, node long, bits binary"), "sets")

    def _sizes(self):
        size = self.size

        def run(batches):
            for rows, sets, first in _blocks(batches, size):
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc"), rows.column("h"), pa.array(np.diff(first)), _longs(_node(sets, first)), _parities(sets, first)], ["doc", "h", "n", "node", "bits"]
                )

        return run

    def lists(self) -> DataFrame:
        """(key, node, first) of all keys that two or more different sets have."""
        percent = self.percent
        largest = self.sizes.agg(F.max("n")).first()[0] or 0
        bounds = size_bands(percent, largest)
        # one row per size band: about fifty for any table
        upper = F.array(*[F.lit(int(b)) for b in bounds])
        band = F.size(F.filter(upper, lambda b: b < F.col("n"))).alias("band")
        bands = self.sizes.where("n > 0").select("node", "n").distinct().groupBy(band).agg(F.count("*").alias("sets"), F.sum("n").alias("elements")).collect()
        counts = {r["band"]: r["sets"] for r in bands}
        plan, keys = [], 0.0
        for c, bound in enumerate([*bounds.tolist(), bounds.tolist()[-1] * 100 // percent + 1]):
            some = counts.get(c, 0) + counts.get(c - 1, 0)
            plan.append(allocation(percent, bound, some) if some > 1 and most_different(percent, bound) else Scheme())
            keys += some * plan[-1].keys(bound) if plan[-1].segments else 0
        # so many rounds that the keys of one take about the room of the texts
        rounds = max(1, math.ceil(keys * _KEY_BYTES / max(1, sum(r["elements"] for r in bands) * _WORD_BYTES)))

        copies = stored(self.rows_of(None), "copies")  # stored, so that its size is known before texts are moved
        docs = self.docs.join(copies, F.col("doc").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k")), "left_anti").select("doc", "text")
        parts = int(self.docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = []
        for turn in range(rounds):
            keyed = docs.mapInArrow(self._keys(bounds, plan, turn, rounds), "key long, node long")
            shared = keyed.repartition(parts, "key").sortWithinPartitions("key", "node").mapInArrow(_shared_keys, "key long, node long, first long")
            found.append(stored(shared, "lists", batch_rows=1 << 16))
            release_shuffles(self.docs.sparkSession)  # the keys are many, those that are shared few
        return reduce(DataFrame.union, found)

    def _keys(self, bounds: np.ndarray, plan: list[Scheme], turn: int, rounds: int):
        size = self.size

        def run(batches):
            for _, sets, first in _blocks(batches, size):
                node = _node(sets, first)
                keys, owner = set_keys(sets, first, bounds, plan, turn, rounds)
                yield pa.RecordBatch.from_arrays([_longs(keys), _longs(node[owner])], ["key", "node"])

        return run

    def rows_of(self, nodes: DataFrame | None) -> DataFrame:
        """(d, k): id and text hash of the first row of each node; without ``nodes`` those of all other rows of nodes."""
        name = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "h")
        rows = self.sizes.where("n > 0")
        first = F.min(name).alias("first")
        if nodes is not None:
            found = rows.join(nodes, "node", "left_semi").groupBy("node").agg(first)
            return found.select(F.col("first.doc").alias("d"), F.col("first.h").alias("k"))
        again = rows.groupBy("node").agg(first, F.count("*").alias("times")).where("times > 1")
        return rows.join(again, "node").where(name != F.col("first")).select(F.col("doc").alias("d"), F.col("h").alias("k")).distinct()

    def sketches(self, lists: DataFrame) -> DataFrame:
        """(node, n, bits) of the nodes of lists."""
        listed = self.sizes.where("n > 0").join(lists.select("node").distinct(), "node", "left_semi")
        return stored(listed.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("bits").alias("bits")), "sketches")

    def elements(self, pairs: DataFrame) -> DataFrame:
        """(node, elements) of the nodes of pairs (x, y), from one text each."""
        size = self.size
        nodes = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
        one = stored(self.rows_of(nodes), "wanted")  # stored, so that its size is known before texts are moved

        def run(batches):
            for rows, sets, first in _blocks(batches, size):
                order = np.lexsort((sets.view(np.int64), np.repeat(np.arange(len(first) - 1), np.diff(first))))
                yield pa.RecordBatch.from_arrays([_longs(_node(sets, first)), _lists(sets[order], first)], ["node", "elements"])

        wanted = self.docs.join(one, F.col("doc").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k")), "left_semi").select("doc", "text")
        return stored(wanted.mapInArrow(run, "node long, elements array<long>").dropDuplicates(["node"]), "elements")

    def linked(self, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
        """The pairs (x, y) that are similar, as (a, b)."""
        percent = self.percent
        side = lambda k: sketches.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"b{k}"))
        sized = pairs.join(side("x"), "x").join(side("y"), "y")
        sized = sized.where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")).select("x", "y", "nx", "ny", "bx", "by")
        near = stored(sized.mapInArrow(lambda batches: _near_enough(batches, percent), "x long, y long"), "near")
        sets = self.elements(near)
        whole = lambda k: sets.select(F.col("node").alias(k), F.col("elements").alias(f"s{k}"))
        both = near.join(whole("x"), "x").join(whole("y"), "y").select("x", "y", "sx", "sy")
        return stored(both.mapInArrow(lambda batches: _similar(batches, percent), "a long, b long"), "links", batch_rows=64)


def _components(df: DataFrame, doc: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per row (doc, h, n, node), h a hash of its text, and (node, root) of the nodes that have links."""
    source = df.select(F.col(doc).cast("long").alias("doc"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    join = _Join(source, size, percent)
    lists = join.lists()
    sketches = join.sketches(lists)
    star = lists.where("node <> first").select(F.col("first").alias("x"), F.col("node").alias("y")).distinct()
    edges = join.linked(star, sketches)
    # lists that one component does not hold: compare their sets with each other
    found = components(edges)
    placed = stored(
        lists.join(found, "node", "left").select("key", "node", "first", F.coalesce("component", "node").alias("component")), "placed"
    )
    sizes = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("k")).where("a <> b and k > 2")
    blocks = F.ceil(F.col("k") / _BLOCK).cast("int")
    rest = placed.where("node <> first").join(sizes.select("key", blocks.alias("blocks")), "key")
    rest = rest.withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j"))
    )
    spread = rest.select("key", "node", "component", "block", F.explode(meets).alias("m")).select("key", "m.i", "m.j", "node", "block", "component")
    sketched = spread.join(sketches, "node").select("key", "i", "j", "node", "block", "component", "n", "bits")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = sketched.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    pairs = stored(ordered.mapInArrow(lambda batches: _pairs_in_blocks(batches, percent), "x long, y long"), "pairs", batch_rows=2048).distinct()
    final = components(edges.union(join.linked(pairs, sketches)))
    return join.sizes.select("doc", "h", "n", "node"), final.select("node", F.col("component").alias("root"))


def jaccard_components(df: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``df``: its id, ``n_shingles`` and ``component_id``.

    A-Z are lower-cased; words are what white space (9 to 13 and 32) parts; the set of a text
    is its different shingles of ``size`` words, with fewer words the whole sequence. Rows
    link if their sets have a similarity of ``percent`` percent or more; ``component_id`` is
    the smallest id that links reach, the row's own included.

    A null or empty text, or one without words, has an empty set and links with nothing.
    Repeated rows and copies are one node of the join. A row without an id gets the smallest
    id it reaches, or null. Other columns are ignored; an empty table gives no rows.
    """
    rows, final = _components(df, doc, text, size, percent)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc").alias("least")).join(final, "node", "left")
    named = nodes.select("node", F.coalesce("root", "node").alias("root"), "least")
    ids = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    with_words = rows.where("n > 0").join(ids, "node").select("doc", "n", "component_id")
    without = rows.where("n = 0").select("doc", "n", F.col("doc").alias("component_id"))
    return with_words.union(without).select(F.col("doc").alias(doc), F.col("n").alias("n_shingles"), "component_id")


def without_near_copies(df: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` but for near copies of others: one of each group stays.

    Groups are those of ``jaccard_components``. The row with the smallest id stays; rows
    without an id come last; of several texts with that id the one with the smallest hash
    stays, and repeated rows of one id and text stay once. Rows without words are no copies.
    Columns of any name pass through unchanged; an empty table stays empty.
    """
    rows, final = _components(df, doc, text, size, percent)
    name = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "h")
    grouped = rows.where("n > 0").join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = grouped.groupBy("root").agg(F.min(name).alias("first")).select("first.doc", "first.h")
    chosen = firsts.union(rows.where("n = 0").select("doc", "h")).distinct()
    # rows that are there once need no search for repeats
    repeats = rows.groupBy("doc", "h").agg(F.count("*").alias("times"))
    wanted = chosen.alias("c").join(repeats.alias("r"), F.expr("c.doc <=> r.doc and c.h = r.h")).select("c.doc", "c.h", "times")
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(doc).cast("long").alias("own"), F.xxhash64(text).alias("hash"))
    kept = packed.join(wanted, F.col("own").eqNullSafe(F.col("doc")) & (F.col("hash") == F.col("h")))
    once = kept.where("times = 1").select("row")
    return once.union(kept.where("times > 1").dropDuplicates(["own", "hash"]).select("row")).select("row.*")


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


#: (doc_id, n_shingles, component_id) in ``answer``, by sets of three words and a similarity of 0.9; {documents} names the table.
COMPONENTS_SQL = r"""
worded as (
  select distinct doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from {documents}
), shingles as (
  select doc_id, s from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from worded)
  group by doc_id, s
), sizes as (select doc_id, count(*) as n from shingles group by doc_id
), common as (
  select a.doc_id as x, b.doc_id as y, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * common.n >= 90 * (p.n + q.n - common.n)
), reach as (
  with recursive r(a, b) as (
    select x, y from links union select y, x from links
    union
    select r.a, l.b from r join (select x as a, y as b from links union select y, x from links) l on r.b = l.a
  ) select a, min(b) as b from r group by a
), answer as (
  select w.doc_id, coalesce(n, 0) as n_shingles, least(w.doc_id, coalesce(b, w.doc_id)) as component_id
  from worded w left join sizes s on s.doc_id = w.doc_id left join reach on reach.a = w.doc_id
)"""
OP3_SQL = f"with recursive {COMPONENTS_SQL.replace('{documents}', 'documents')} select * from answer"

"""Periodic runs of words, found in a grammar of each text.

A *run* is a stretch of consecutive words with smallest period q that is long enough and that
no neighbouring word extends with that period.

1. *Re-Pair.* Pairs of neighbouring symbols that stand twice or more in a text become
   nonterminals, the more frequent pair first. A round replaces every pair that is more
   frequent than the two pairs it overlaps; of ``a a a a`` every second pair is taken. Rounds
   go on until no pair repeats. What is left of a text is joined by a balanced tree, each
   node of which stands once.
2. *Runs across a boundary.* A run is crossed by the boundary between the two parts of
   exactly one lowest node that holds it whole. With a length of four periods one side of
   the boundary holds two of them: a square that starts or ends at the boundary. These are
   looked for once per nonterminal, at one of its places, by prefix hashes, and extended
   both ways inside the node.
3. *All places.* Runs found in a nonterminal stand at each of its places. A run cut by the
   end of a node is part of one that a node above holds whole: of the stretches with the same
   period in a text only those that no other holds stay. A stretch that several periods
   describe has the least of them.

Every run that comes out is compared word by word; if a hash misled, the search is repeated
with others. So the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import let, table, words
from roomgrid.llm.shingles import chunks

LEAST_WORDS = 6
LEAST_PERIODS = 4  # two on one side of a boundary: the search relies on it
_PIECE = 1 << 20  # bytes of text whose grammars are made together
_SLAB = 1 << 21  # candidates looked at together
_PRIMES = ((1 << 31) - 1, (1 << 31) - 19)


class _Hashes:
    """Equality of stretches of one array by sums of powers modulo two primes."""

    def __init__(self, ids: np.ndarray, seed: int) -> None:
        rng = np.random.default_rng([20240229, seed])
        self.sums, self.powers = [], []
        for prime in _PRIMES:
            base = int(rng.integers(1 << 20, prime - 1))
            power = np.ones(len(ids) + 1, dtype=np.int64)
            done = 1
            while done < len(power):  # powers by doubling
                step = min(done, len(power) - done)
                power[done : done + step] = power[:step] * pow(base, done, prime) % prime
                done += step
            value = rng.integers(1, prime, int(ids.max(initial=0)) + 1)[ids]
            total = np.zeros(len(ids) + 1, dtype=np.int64)
            np.cumsum(value * power[:-1] % prime, out=total[1:])
            self.sums.append(total % prime)
            self.powers.append(power)

    def same(self, at: np.ndarray, period: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from ``at`` are those from ``at + period``."""
        out = np.ones(len(at), dtype=bool)
        for prime, total, power in zip(_PRIMES, self.sums, self.powers):
            here = (total[at + length] - total[at]) % prime * power[period] % prime
            out &= here == (total[at + period + length] - total[at + period]) % prime
        return out


def _most(fits, upto: np.ndarray) -> np.ndarray:
    """The largest n from 0 to ``upto`` for which ``fits(n)``; it holds for all smaller ones."""
    low, high = np.zeros_like(upto), upto.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        good = fits(middle)
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return low


def _rounds(symbols: np.ndarray) -> tuple[np.ndarray, ...]:
    """Re-Pair of all texts: (nonterminal, start, boundary, end) of every place, and what is left.

    Symbols of different texts differ, so no pair repeats across texts. What is left: starts
    and ends of the symbols.
    """
    start = np.arange(len(symbols), dtype=np.int64)
    end = start + 1
    live = np.ones(max(len(symbols) - 1, 0), dtype=bool)  # boundaries whose pair may repeat
    places: list[tuple[np.ndarray, ...]] = []
    free = int(symbols.max(initial=0)) + 1
    while True:
        at = np.flatnonzero(live)
        if not len(at):
            break
        key = symbols[at] * np.int64(free) + symbols[at + 1]
        _, kind = np.unique(key, return_inverse=True)
        # neighbouring places of one pair overlap, so every second one counts
        head = np.ones(len(at), dtype=bool)
        head[1:] = (kind[1:] != kind[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(head)
        stretch = np.cumsum(head) - 1
        length = np.diff(np.append(begin, len(at)))
        count = np.bincount(kind[begin], weights=(length + 1) // 2).astype(np.int64)
        again = count[kind] >= 2
        live[at[~again]] = False
        if not again.any():
            break
        rank = np.empty(len(count), dtype=np.int64)
        rank[np.argsort(count, kind="stable")] = np.arange(1, len(count) + 1)
        weight = np.zeros(len(live) + 2, dtype=np.int64)  # of boundary i at i + 1
        weight[at[again] + 1] = rank[kind[again]]
        own = rank[kind[begin]] * again[begin]
        before, after = weight[at[begin]], weight[at[begin] + length + 1]
        best = (own > 0) & (own > before) & (own > after)
        taken = best[stretch] & ((np.arange(len(at)) - begin[stretch]) % 2 == 0)
        used = np.bincount(kind[taken], minlength=len(count))
        taken &= used[kind] >= 2
        chosen, of = at[taken], kind[taken]
        name = np.cumsum(used >= 2) - 1 + free
        places.append((name[of], start[chosen], start[chosen + 1], end[chosen + 1]))
        symbols[chosen] = name[of]
        end[chosen] = end[chosen + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[chosen + 1] = False
        fresh = np.zeros(len(symbols), dtype=bool)
        fresh[chosen] = True
        live = np.append(live, False)
        live[chosen] = live[chosen + 1]  # the boundary behind the pair
        symbols, start, end, fresh, live = symbols[keep], start[keep], end[keep], fresh[keep], live[keep][:-1]
        live |= fresh[:-1] | fresh[1:]
        free += int((used >= 2).sum())
    found = [np.concatenate(x) for x in zip(*places)] if places else [np.empty(0, dtype=np.int64)] * 4
    return (*found, start, end)


def _nodes(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, boundary, end) of every node once, and per node the starts of its places as (places, offsets)."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # words of different texts are different symbols; few of them, as two make one number
    symbols = np.unique(text * (int(ids.max(initial=0)) + 1) + ids, return_inverse=True)[1]
    name, s, b, e, start, end = _rounds(symbols)
    order = np.lexsort((s, name))
    name, s, b, e = name[order], s[order], b[order], e[order]
    head = np.flatnonzero(np.append(True, name[1:] != name[:-1])) if len(name) else np.empty(0, dtype=np.int64)
    # the balanced tree over the symbols j of a text: boundary j joins 2^z symbols on either side
    of = text[start] if len(start) else np.empty(0, dtype=np.int64)
    begin = np.searchsorted(of, np.arange(len(first) - 1))
    j = np.arange(len(start)) - begin[of]
    inner = np.flatnonzero(j > 0)
    width = j[inner] & -j[inner]
    last = np.append(begin, len(start))[of[inner] + 1]
    s2, b2, e2 = start[inner - width], start[inner], end[np.minimum(inner + width, last) - 1]
    offsets = np.concatenate([head, len(name) + np.arange(len(inner) + 1)])
    return np.append(s[head], s2), np.append(b[head], b2), np.append(e[head], e2), np.append(s, s2), offsets


def _squares(ids: np.ndarray, hashes: _Hashes, s: np.ndarray, b: np.ndarray, e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(node, begin, period) of the squares that start or end at a node's boundary."""
    for right in (True, False):
        most = np.minimum((e - b if right else b - s) // 2, (e - s) // LEAST_PERIODS)
        most[e - s < LEAST_WORDS] = 0
        some = np.flatnonzero(most > 0)
        total = np.cumsum(most[some])
        done = at = 0
        while at < len(some):
            to = max(at + 1, int(np.searchsorted(total, done + _SLAB, side="right")))
            count = most[some[at:to]]
            done = int(total[to - 1])
            for low in range(0, int(count.max()), _SLAB):  # one slab, but for a node with more periods than that
                part = np.clip(count - low, 0, _SLAB)
                node = np.repeat(some[at:to], part)
                q = np.arange(len(node)) - np.repeat(np.cumsum(part) - part, part) + 1 + low
                begin = b[node] if right else b[node] - 2 * q
                fits = (ids[begin] == ids[begin + q]) & (ids[begin + q - 1] == ids[begin + 2 * q - 1])
                node, begin, q = node[fits], begin[fits], q[fits]
                fits = hashes.same(begin, q, q)
                yield node[fits], begin[fits], q[fits]
            at = to


def _alike(rows: list[np.ndarray], keys: int) -> np.ndarray:
    """For rows in order of their first ``keys`` columns: which start a new group."""
    new = np.ones(len(rows[0]), dtype=bool)
    if len(new):
        new[1:] = np.any([r[1:] != r[:-1] for r in rows[:keys]], axis=0)
    return new


def _search(ids: np.ndarray, first: np.ndarray, nodes: tuple[np.ndarray, ...], seed: int) -> tuple[np.ndarray, ...]:
    s, b, e, places, offsets = nodes
    hashes = _Hashes(ids, seed)
    found = []
    for node, begin, q in _squares(ids, hashes, s, b, e):
        ahead = _most(lambda n: hashes.same(begin, q, n), e[node] - begin - q)
        back = _most(lambda n: hashes.same(begin - n, q, n), begin - s[node])
        x, y = begin - back, begin + q + ahead
        good = (y - x >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)) & (x < b[node]) & (y > b[node])
        found.append((node[good], x[good] - s[node[good]], y[good] - x[good], q[good]))
    node, x, n, q = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, dtype=np.int64),) * 4
    # to all places of the node
    times = offsets[node + 1] - offsets[node]
    row = np.repeat(np.arange(len(node)), times)
    place = offsets[node][row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    x, n, q = places[place] + x[row], n[row], q[row]
    text = np.searchsorted(first, x, side="right") - 1
    # of one period: stretches that no other holds
    order = np.lexsort((-n, x, q, text))
    text, x, n, q = text[order], x[order], n[order], q[order]
    group = np.cumsum(_alike([text, q], 2)) - 1
    reach = np.maximum.accumulate(x + n + group * (len(ids) + 1)) if len(x) else x
    largest = np.ones(len(x), dtype=bool)
    largest[1:] = reach[1:] > np.where(group[1:] == group[:-1], reach[:-1], -1)
    text, x, n, q = text[largest], x[largest], n[largest], q[largest]
    # of one stretch: the least period
    order = np.lexsort((q, n, x))
    text, x, n, q = text[order], x[order], n[order], q[order]
    least = _alike([x, n], 2)
    text, x, n, q = text[least], x[least], n[least], q[least]
    order = np.lexsort((q, x))
    return text[order], x[order], n[order], q[order]


def _holds(ids: np.ndarray, first: np.ndarray, text: np.ndarray, x: np.ndarray, n: np.ndarray, q: np.ndarray) -> bool:
    """Whether the runs are periodic and not to be extended, word by word."""
    for at in range(0, len(x), 4096):
        part = slice(at, at + 4096)
        count = n[part] - q[part]
        i = np.repeat(x[part] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        if (ids[i] != ids[i + np.repeat(q[part], count)]).any():
            return False
    before, after = x > first[text], x + n < first[text + 1]
    return not ((ids[x - 1] == ids[x - 1 + q]) & before).any() and not ((ids[np.minimum(x + n, len(ids) - 1)] == ids[x + n - q]) & after).any()


def find_runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of the runs of all texts, in order; starts count over all texts.

    ``ids``: word numbers of the texts, one after another; ``first``: their offsets.
    """
    nodes = _nodes(ids, first)
    seed = 0
    while True:
        runs = _search(ids, first, nodes, seed)
        if _holds(ids, first, *runs):
            return runs
        seed += 1


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _texts(texts: list[str | None]) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Runs, collapsed texts and numbers of words."""
    split = [(t or "").encode().split() for t in texts]  # of bytes: by white space 9 to 13 and 32
    counts = np.array([len(w) for w in split], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    number: dict[bytes, int] = {}
    for w in split:
        for word in w:
            if word not in number:
                number[word] = len(number)
    ids = np.fromiter((number[word] for w in split for word in w), dtype=np.int64, count=int(first[-1]))
    text, x, n, q = find_runs(ids, first) if len(ids) else (np.empty(0, dtype=np.int64),) * 4
    change = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(change, x + q, 1)
    np.add.at(change, x + n, -1)
    kept = np.cumsum(change[:-1]) == 0
    has_runs = np.bincount(text, minlength=len(texts)) > 0
    collapsed = []
    for k, w in enumerate(split):
        left = [w[i] for i in np.flatnonzero(kept[first[k] : first[k + 1]])] if has_runs[k] else w
        collapsed.append(b" ".join(left))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (x - first[text], n, q)], fields=list(_RUNS.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(collapsed, pa.binary()).cast(pa.string()), counts


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        size = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
        for a, b in chunks(np.concatenate([[0], np.cumsum(size)]), _PIECE):
            runs, collapsed, counts = _texts(texts.slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), pa.array(counts), runs.cast(_RUNS), collapsed], ["id", "n_words", "runs", "collapsed"])


def periodic_runs(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: its id, ``n_words``, ``runs`` and ``collapsed``.

    Words are what white space (9 to 13 and 32) parts. ``runs`` lists (start, length, period),
    by start, then period, of the runs of 6 words and 4 periods or more; starts are word
    numbers from 0. ``collapsed`` is the text without the words that any run holds after its
    first period, joined by one blank.

    A null or empty text, or one without words, has no runs and an empty collapsed text. Each
    row counts by itself, so repeated rows and rows without an id stay as they are. Two runs
    may overlap or start at one word. Other columns are ignored; an empty table gives no rows.
    A task holds about a megabyte of texts at a time, or one text if it is longer.
    """
    rows = df.select(F.col(doc).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(_batches, "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", doc)


def with_repeats(doc: Column, text: Column) -> Column:
    """The text; in a tenth of the documents its end goes round in a circle of words.

    With h the CRC of the id, n words, a = n's remainder of h / 10 and p = 1 + (n - a) / (3 + a
    number below 8) every word from a on becomes the one at a + (i - a) % p.
    """
    h = F.crc32(doc.cast("string"))
    part = F.floor(h / 10).cast("long")

    def turned(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = part % n
        return let(
            F.struct(w.alias("w"), a.alias("a"), (1 + F.floor((n - a) / (3 + part % 8))).cast("long").alias("p")),
            lambda s: F.array_join(
                F.transform(
                    F.sequence(F.lit(0).cast("long"), F.size(s["w"]).cast("long") - 1),
                    lambda i: F.element_at(s["w"], (F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]) + 1).cast("int")),
                ),
                " ",
            ),
        )

    some = (h % 10 == 0) & F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return F.when(some, let(words(text), turned)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", with_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    longer = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    kind = "struct<start:long,length:long,period:long>"
    best = F.aggregate("runs", F.lit(None).cast(kind), lambda best, r: F.when(longer(best, r), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        best.alias("best"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )

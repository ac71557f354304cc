"""Packing: documents as sequences of at most ``window`` tokens with almost no padding.

1. Every document is tokenized and cut into pieces of a whole window and one tail.
2. *Non-negative least squares.* The histogram of tail lengths, at most a window's entries
   for any table, goes to the driver. Shallow combinations, of one to three lengths that fill
   a window exactly, are the columns of a system whose right side is the histogram; its
   non-negative least-squares solution says how often to use each. The counts are rounded,
   largest first, to what the histogram still holds.
3. *Residuals are packed greedily*: the tails that no combination took form one stream, each
   length after the other, that fills window after window; a tail that reaches over the end
   of one is cut there. The last, partly filled window is split into sequences whose lengths
   are powers of two, which need no padding.
4. Within a length every tail gets a number. The plan gives ranges of numbers to sequences,
   so a piece finds its place by itself: no piece, length or sequence is gathered anywhere.
   A length that many tails share is numbered in buckets of bounded size.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomgrid.llm.common import stored, table

WINDOW = 2048
END_ID = 1
ROWS_PER_BUCKET = 200_000
_CACHE = 400_000  # words whose ids a worker keeps
# by lines: punctuation, letters of Latin-1, punctuation, or something else; no word that may hold a special token
_MARKS = r"[.,!?;:|\"()\[\]{}/*#%&>=+_~@$-]*"
_PARTS = re.compile(rf"^(?:({_MARKS})([a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]{{1,63}})({_MARKS})|.*)$", re.MULTILINE).findall
_PROBES = ["a b", "One two,  three.", "(x) y-z 12 3,4", "Straße à la carte", "tab\there \u00a0 end\n\nnew", "<| a |> b", "word" * 30 + " b", "\u4e00\u4e8c \u4e09"]
_PROBED_TEXTS = 32


class WordIds:
    """Ids of texts by a tokenizer that never looks across a blank, kept word by word.

    Only a word's own characters decide its ids, so a text's ids are those of its words. A word
    of Latin-1 letters between punctuation is looked up in lower case without it; those not yet
    known are tokenized together. Any other word goes to the tokenizer as it stands, as do
    words that may hold one of its special tokens. Whether the tokenizer is of that kind is
    tried on probes and on the first texts; if it is not, texts go to it whole.

    Words are kept in two generations: when the younger is full it becomes the elder, and
    words met again move back.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks use the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.cache = _CACHE
        self.words: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {"": b""}
        self.probed = 0
        self.by_words = all(self._fits(text) for text in _PROBES)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _fits(self, text: str) -> bool:
        """Whether the text's ids are those of its words."""
        return self._by_words([text]) == self._whole([text])

    def _learn_cores(self, new: list[str]) -> None:
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            raw = self._whole([" ".join(some)])[0]
            ends = np.flatnonzero(self.last[np.frombuffer(raw, dtype="<u4")]) + 1
            if len(ends) == len(some):
                place = [0, *(4 * ends).tolist()]
                self.cores.update(zip(some, (raw[a:b] for a, b in zip(place, place[1:]))))
            else:
                self.cores.update(zip(some, self._whole(some)))

    def _learn(self, words: list[str]) -> None:
        if len(self.cores) > self.cache:
            self.cores = {"": b""}
        cores = self.cores
        parts = _PARTS("\n".join(words).lower())  # of each word, empty where it is not of that form
        self._learn_cores(list({p[1] for p in parts}.difference(cores)))
        marks = list({p[0] for p in parts}.union(p[2] for p in parts).difference(cores))
        cores.update(zip(marks, self._whole(marks)))
        self.words.update(zip(words, [cores[core] if not left and not right else cores[left] + cores[core] + cores[right] for left, core, right in parts]))
        odd = [word for word, p in zip(words, parts) if not p[1] and word]
        for at in range(0, len(odd), 4096):
            self.words.update(zip(odd[at : at + 4096], self._whole(odd[at : at + 4096])))

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        out: list[bytes] = []
        at = 0
        while at < len(split):  # so many texts at a time that their words fit a generation
            end, total = at, 0
            while end < len(split) and (end == at or total + len(split[end]) < self.cache // 4):
                total += len(split[end])
                end += 1
            some = set().union(*split[at:end])
            new = some.difference(self.words)
            if len(self.words) + len(new) > self.cache:
                self.words, self.elder, new = {}, self.words, some
            known = [word for word in new if word in self.elder] if self.elder else []
            self.words.update((word, self.elder[word]) for word in known)
            self._learn(list(new.difference(known)))
            of = self.words.__getitem__
            out += [b"".join(map(of, words)) for words in split[at:end]]
            at = end
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; a null counts as empty."""
        plain = [text or "" for text in texts]
        while self.by_words and self.probed < _PROBED_TEXTS and self.probed < len(plain):
            self.by_words = self._fits(plain[self.probed][:4000])
            self.probed += 1
        if self.by_words:
            return self._by_words(plain)
        return [ids for at in range(0, len(plain), 64) for ids in self._whole(plain[at : at + 64])]


def worker_ids(path: str) -> WordIds:
    """The worker process's own table of words, kept from task to task."""
    kept = sys.modules.setdefault("_word_ids", types.ModuleType("_word_ids")).__dict__
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def cut_documents(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Pieces of (doc, text): whole windows, then a tail, which alone carries its ids."""
    words, end = worker_ids(path), struct.pack("<I", end_id)
    width = 4 * window
    for batch in batches:
        rows: list[tuple] = []
        for doc, ids in zip(batch.column("doc").to_pylist(), words.encode(batch.column("text").to_pylist())):
            ids += end
            total = len(ids) // 4
            for start in range(0, total, window):
                piece = ids[4 * start : 4 * start + width]
                n = len(piece) // 4
                rows.append((doc, start, n, zlib.crc32(piece), total, piece if n < window else None))
        kinds = [pa.int64()] * 5 + [pa.binary()]
        columns = zip(*rows) if rows else [[]] * 6
        names = ["doc", "start", "length", "ids_crc32", "doc_tokens", "ids"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths, a <= b <= c, that sum to the window; 0 stands for none."""
    there = np.zeros(window + 1, dtype=bool)
    there[lengths] = True
    lengths = np.flatnonzero(there)
    rows = [np.array([[0, 0, window]])] if there[window] else []
    first = lengths[2 * lengths <= window]
    pairs = first[there[window - first]]
    rows.append(np.stack([0 * pairs, pairs, window - pairs], axis=1))
    for a in lengths[3 * lengths <= window].tolist():
        b = lengths[(lengths >= a) & (2 * lengths <= window - a)]
        b = b[there[window - a - b]]
        rows.append(np.stack([0 * b + a, b, window - a - b], axis=1))
    return np.concatenate(rows)


def least_squares(combos: np.ndarray, histogram: np.ndarray, rounds: int = 120) -> np.ndarray:
    """Non-negative counts of the combinations whose lengths come close to the histogram.

    Accelerated projected gradient; columns and right side are scaled by the histogram's root,
    so that rare lengths are met as well as common ones.
    """
    weight = np.where(histogram > 0, 1 / np.sqrt(np.maximum(histogram, 1)), 0.0)
    weight[0] = 0.0
    flat, n = combos.T.ravel(), len(histogram)

    def times(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, weights=np.tile(x, 3), minlength=n) * weight

    def back(r: np.ndarray) -> np.ndarray:
        return (r * weight)[combos].sum(axis=1)

    target = histogram * weight
    norm = np.ones(len(combos))
    for _ in range(12):  # the largest eigenvalue, for the step
        image = back(times(norm))
        size = np.linalg.norm(image)
        if size == 0:
            return np.zeros(len(combos))
        norm = image / size
    step = 0.9 / size
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(times(y) - target), 0.0)
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = new + (before - 1) / t * (new - x)
        x = new
    return x


@dataclass
class Plan:
    """Places of the pieces of every length, by their numbers within the length."""

    window: int
    #: by length: first numbers, sequences and offsets of the ranges that combinations took
    ranges: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    taken: dict[int, int] = field(default_factory=dict)
    stream: dict[int, int] = field(default_factory=dict)  # by length: place of its first residual
    sequences: int = 0
    edges: list[int] = field(default_factory=list)  # ends of the sequences after the last whole window
    whole: int = 0  # whole windows of residuals

    def place(self, length: int, number: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of the parts of a piece."""
        if number < self.taken.get(length, 0):
            first, sequence, offset = self.ranges[length]
            k = int(np.searchsorted(first, number, side="right")) - 1
            return [(0, length, int(sequence[k]) + number - int(first[k]), int(offset[k]))]
        at = self.stream[length] + (number - self.taken.get(length, 0)) * length
        parts, done = [], 0
        while done < length:
            p = at + done
            if p < self.whole * self.window:
                k, begin = p // self.window, p // self.window * self.window
                end = begin + self.window
            else:
                i = int(np.searchsorted(self.edges, p, side="right"))
                k, end = self.whole + i, self.edges[i]
                begin = self.edges[i - 1] if i else self.whole * self.window
            n = min(length - done, end - p)
            parts.append((done, n, self.sequences + k, p - begin))
            done += n
        return parts


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    """``histogram[n]``: number of pieces of n tokens, n from 1 to ``window``."""
    plan = Plan(window)
    rest = histogram.astype(np.int64).copy()
    combos = combinations(np.flatnonzero(rest), window)
    wish = least_squares(combos, histogram.astype(np.float64)) if len(combos) else np.zeros(0)
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    used = np.zeros(window + 1, dtype=np.int64)
    for k in np.argsort(-wish, kind="stable").tolist():
        if wish[k] < 0.02:
            break
        parts = [n for n in combos[k].tolist() if n]
        count = min(int(np.ceil(wish[k])), *(int(rest[n]) // parts.count(n) for n in parts))
        if count <= 0:
            continue
        offset = 0
        for n in parts:
            ranges.setdefault(n, []).append((int(used[n]), plan.sequences, offset))
            used[n] += count
            rest[n] -= count
            offset += n
        plan.sequences += count
    plan.ranges = {n: tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) for n, rows in ranges.items()}
    plan.taken = {n: int(used[n]) for n in ranges}
    at = 0
    for n in range(window, 0, -1):
        if rest[n]:
            plan.stream[n] = at
            at += int(rest[n]) * n
    plan.whole = at // window
    place = plan.whole * window
    for bit in range(window.bit_length(), -1, -1):
        if (at - place) >> bit & 1 and (1 << bit) <= at - place:
            plan.edges.append((plan.edges[-1] if plan.edges else place) + (1 << bit))
    return plan


def _place_pieces(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    names = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in batches:
        out: list[tuple] = []
        for doc, start, length, crc, total, ids, number in zip(*(batch.column(k).to_pylist() for k in ("doc", "start", "length", "ids_crc32", "doc_tokens", "ids", "number"))):
            parts = plan.place(length, number)
            if len(parts) == 1:
                out.append((doc, start, length, crc, total, *parts[0][2:]))
            else:
                out += [(doc, start + a, n, zlib.crc32(ids[4 * a : 4 * (a + n)]), total, s, o) for a, n, s, o in parts]
        columns = zip(*out) if out else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)


def pack(
    df: DataFrame, path: str, doc: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Pieces of all rows: (doc, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A row's tokens are the ids of its text by the tokenizer file ``path``, then ``end_id``; a
    null or empty text is that id alone. Ids may be null and rows may repeat: each row is
    packed as a document of its own. Other columns are ignored; an empty table gives no rows.
    """
    source = df.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    cut = lambda batches: cut_documents(batches, path, window, end_id)
    pieces = stored(source.mapInArrow(cut, "doc long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"), "pieces")
    # at most one row per length
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        histogram[length] = n
    plan = make_plan(histogram, window)
    shared = pieces.sparkSession.sparkContext.broadcast(plan)  # at most three entries per combination of lengths
    by_length = lambda values: F.array(*[F.lit(int(v)) for v in values])[F.col("length").cast("int")]
    buckets = by_length(-(-histogram // rows_per_bucket))
    all_taken = by_length(plan.taken.get(n, 0) == histogram[n] for n in range(window + 1)) == 1
    kept = pieces.withColumn("ids", F.when(~all_taken, F.col("ids")))  # only a residual may be cut
    keyed = kept.withColumn("bucket", F.pmod(F.xxhash64("doc", "start", "ids_crc32"), buckets))
    sizes = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc", "start", "ids_crc32", "doc_tokens"))
    numbered = keyed.withColumn("within", within).join(offsets, ["length", "bucket"])
    numbered = numbered.select("doc", "start", "length", "ids_crc32", "doc_tokens", "ids", (F.col("before") + F.col("within") - 1).alias("number"))
    columns = "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return numbered.mapInArrow(lambda batches: _place_pieces(batches, shared.value), columns).withColumnRenamed("doc", doc)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))

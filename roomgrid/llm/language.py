"""Language ID by a linear-chain conditional random field over the words of a text.

A word's score for each language is the sum of the weights of its features: all pairs and
triples of characters with the word's ends marked (so its affixes too), its first and last
three characters with their end, and the word itself (a lexicon). Learned transition scores
join neighbouring words. Forward-backward gives every word a distribution over the languages,
in the light of the whole text, so a word in a passage of another language is labelled by its
surroundings; a text's language has the largest share of them. A word of more than 80
letters, as in scripts without blanks, counts as consecutive pieces of 8 letters.

Learning takes a bounded sample (``per_language`` texts, ``words_per_text`` words each, both
parameters), on the driver. Its sequences are spans of texts of different languages, so that
the transitions learn how often a text changes its language. Prediction reads whole texts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomgrid.llm.common import stored, table

PER_LANGUAGE = 300
WORDS_PER_TEXT = 150
BUCKETS = 1 << 17
UNDETERMINED = "und"
_BLOCK = 64  # words that are scanned one after another; blocks run side by side
_WORDS = 100_000  # words that are labelled together
_LONGEST = 1_000_000  # a longer text is read as several sequences
_LONG_WORD = 80  # letters; a longer word is text without blanks
_PIECE = 8  # letters of its pieces
_CACHE = 300_000  # words whose scores a task keeps


def core(word: str) -> str:
    """The word in lower case without what is no letter at its ends; empty if it has no letter."""
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b].lower()


def pieces(words: list[str]) -> list[str]:
    """The words, those of more than ``_LONG_WORD`` letters in consecutive pieces of ``_PIECE``."""
    if max(map(len, words), default=0) <= _LONG_WORD:
        return words
    out: list[str] = []
    for word in words:
        inner = core(word) if len(word) > _LONG_WORD else word
        if len(inner) > _LONG_WORD:
            out += [inner[k : k + _PIECE] for k in range(0, len(inner), _PIECE)]
        else:
            out.append(inner)
    return out


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the words, one word after another, and n + 1 offsets."""
    marked = "".join(f"\x02{w}\x03" for w in words)
    c = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    length = np.array([len(w) + 2 for w in words])
    end = np.cumsum(length)
    begin = end - length
    word = np.repeat(np.arange(len(words)), length)
    left = end[word] - np.arange(len(c))  # characters up to the word's end
    found, owner = [], []
    code = c.copy()
    for n in (2, 3, 4):
        code = code[:-1] * np.uint64(0x100000001B3) + c[n - 1 :]
        inside = left[: len(code)] >= n
        if n == 4:  # affixes of three only
            at = np.arange(len(code))
            inside &= (at == begin[word[: len(code)]]) | (left[: len(code)] == 4)
        found.append(code[inside] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n))
        owner.append(word[: len(code)][inside])
    power = np.full(int(length.max(initial=1)), 0x100000001B3, dtype=np.uint64)
    whole = np.add.reduceat(c * np.multiply.accumulate(power)[np.arange(len(c)) - begin[word]], begin) if len(words) else c
    found.append(whole * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(99))
    owner.append(np.arange(len(words)))
    hashed, owner = np.concatenate(found), np.concatenate(owner)
    hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(owner, kind="stable")
    numbers = ((hashed >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)
    return numbers[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])


@dataclass
class Field:
    """A trained field: languages in order, weights by feature, transitions, start."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.languages)))
        numbers, first = features(words)
        return np.add.reduceat(self.weights[numbers], first[:-1], axis=0)

    def posteriors(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each word's distribution; the words of ``lengths[k]`` belong to sequence k."""
        size = len(self.languages)
        blocks = -(-lengths // _BLOCK)
        first_block = np.concatenate([[0], np.cumsum(blocks)])
        n = int(first_block[-1])
        word = np.arange(len(scores)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at_block = np.repeat(first_block[:-1], lengths) + word // _BLOCK
        at_step = word % _BLOCK
        p = np.ones((_BLOCK, n, size))
        there = np.zeros((_BLOCK, n, 1), dtype=bool)
        p[at_step, at_block] = np.exp(scores - scores.max(axis=1, keepdims=True))
        there[at_step, at_block] = True
        a = np.exp(self.transitions - self.transitions.max())
        # what a block does to any vector from its left
        m = np.tile(np.eye(size), (n, 1, 1))
        for t in range(_BLOCK):
            new = (m @ a) * p[t][:, None, :]
            m = np.where(there[t][:, :, None], new, m)
            if t % 8 == 7:
                m /= m.sum(axis=(1, 2), keepdims=True)
        # vectors at the ends of the blocks, over all sequences block by block
        alpha, beta = np.empty((n, size)), np.empty((n, size))
        alpha[first_block[:-1]] = np.exp(self.start - self.start.max())
        beta[first_block[1:] - 1] = 1.0
        for r in range(1, int(blocks.max(initial=0))):
            here = first_block[:-1][blocks > r] + r
            v = np.einsum("ki,kij->kj", alpha[here - 1], m[here - 1])
            alpha[here] = v / v.sum(axis=1, keepdims=True)
            back = first_block[1:][blocks > r] - 1 - r
            v = np.einsum("kij,kj->ki", m[back + 1], beta[back + 1])
            beta[back] = v / v.sum(axis=1, keepdims=True)
        gamma = np.empty((_BLOCK, n, size))
        for t in range(_BLOCK):
            new = (alpha @ a) * p[t]
            alpha = np.where(there[t], new / new.sum(axis=1, keepdims=True), alpha)
            gamma[t] = alpha
        for t in reversed(range(_BLOCK)):
            gamma[t] *= beta
            new = (p[t] * beta) @ a.T
            beta = np.where(there[t], new / new.sum(axis=1, keepdims=True), beta)
        out = gamma[at_step, at_block]
        return out / out.sum(axis=1, keepdims=True)


def train(texts: list[tuple[str, str]], words_per_text: int, epochs: int = 5, seed: int = 7) -> Field:
    """A field learned from (text, language) rows."""
    rng = np.random.default_rng(seed)
    languages = sorted({lang for _, lang in texts})
    known: dict[str, int] = {}
    spans: list[tuple[int, list[int]]] = []
    for text, lang in sorted(texts):
        words = [w for w in map(core, pieces((text or "").split())) if w]
        skip = int(rng.integers(0, max(1, len(words) - words_per_text + 1)))
        ids = [known.setdefault(w, len(known)) for w in words[skip : skip + words_per_text]]
        at = 0
        while at < len(ids):  # spans of uneven length
            n = int(rng.integers(3, 60))
            spans.append((languages.index(lang), ids[at : at + n]))
            at += n
    size = len(languages)
    field = Field(languages, np.zeros((BUCKETS, size)), np.zeros((size, size)), np.zeros(size))
    if not spans:
        return field
    numbers, first = features(list(known))
    grad2 = [np.full_like(x, 1e-2) for x in (field.weights, field.transitions, field.start)]
    for _ in range(epochs):
        order = rng.permutation(len(spans))
        sequences, at = [], 0
        while at < len(order):  # one to three spans make a sequence
            n = int(rng.integers(1, 4))
            sequences.append([spans[k] for k in order[at : at + n]])
            at += n
        for at in range(0, len(sequences), 48):
            _step(field, sequences[at : at + 48], numbers, first, grad2)
    return field


def _step(field: Field, sequences: list, numbers: np.ndarray, first: np.ndarray, grad2: list[np.ndarray]) -> None:
    """One step up the log-likelihood of some sequences, with a step size per parameter."""
    size = len(field.languages)
    words = [np.array([w for _, ids in s for w in ids]) for s in sequences]
    labels = [np.array([lang for lang, ids in s for _ in ids]) for s in sequences]
    n, longest = len(sequences), max(map(len, words))
    used, place = np.unique(np.concatenate(words), return_inverse=True)
    count = first[used + 1] - first[used]
    flat = numbers[np.repeat(first[used] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))]
    begin = np.concatenate([[0], np.cumsum(count)[:-1]])
    scores = np.add.reduceat(field.weights[flat], begin, axis=0)
    e = np.zeros((longest, n, size))
    there = np.zeros((longest, n, 1), dtype=bool)
    gold = np.zeros((longest, n), dtype=np.int64)
    rows = np.concatenate([np.full(len(w), k) for k, w in enumerate(words)])
    steps = np.concatenate([np.arange(len(w)) for w in words])
    e[steps, rows] = scores[place]
    there[steps, rows] = True
    gold[steps, rows] = np.concatenate(labels)
    p = np.exp(e - e.max(axis=2, keepdims=True))
    a, s = np.exp(field.transitions), np.exp(field.start)
    alpha = np.empty((longest + 1, n, size))
    alpha[0] = s / s.sum()
    for t in range(longest):
        new = (alpha[t] @ a) * p[t]
        alpha[t + 1] = np.where(there[t], new / new.sum(axis=1, keepdims=True), alpha[t])
    beta = np.ones((n, size))
    pair_grad = np.zeros((size, size))
    gamma = np.zeros((longest, n, size))
    eye = np.eye(size)
    for t in reversed(range(longest)):
        g = alpha[t + 1] * beta
        gamma[t] = g / g.sum(axis=1, keepdims=True)
        right = p[t] * beta
        pair = alpha[t][:, :, None] * a[None] * right[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        pair_grad -= (pair * there[t][:, :, None]).sum(axis=0)
        if t:
            both = there[t][:, 0]
            np.add.at(pair_grad, (gold[t - 1][both], gold[t][both]), 1.0)
        else:
            start_grad = -pair.sum(axis=(0, 2))
            # the state before the first word is free: what it is, given the first word
            free = s[:, None] * a
            free /= free.sum(axis=0)
            np.add.at(pair_grad.T, gold[0], free.T[gold[0]])
            start_grad += free.T[gold[0]].sum(axis=0)
        new = right @ a.T
        beta = np.where(there[t], new / new.sum(axis=1, keepdims=True), beta)
    word_grad = np.zeros((len(used), size))
    np.add.at(word_grad, place, eye[gold[steps, rows]] - gamma[steps, rows])
    touched, where = np.unique(flat, return_inverse=True)
    grad = np.zeros((len(touched), size))
    np.add.at(grad, where, np.repeat(word_grad, count, axis=0))
    grad -= 0.01 * field.weights[touched]
    grad2[0][touched] += grad**2
    field.weights[touched] += 0.15 * grad / np.sqrt(grad2[0][touched])
    pair_grad -= 0.01 * field.transitions
    for x, g, g2 in ((field.transitions, pair_grad, grad2[1]), (field.start, start_grad, grad2[2])):
        g2 += g**2
        x += 0.15 * g / np.sqrt(g2)


class Labeller:
    """Labels texts with a field; keeps the scores of words it has met."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self._reset()

    def _reset(self) -> None:
        self.seen: dict[str, int] = {}
        self.cores: dict[str, int] = {}
        self.table = np.zeros((0, len(self.field.languages)))

    def _learn(self, missing: set[str]) -> None:
        of = {w: core(w) for w in missing}
        new = [w for w in dict.fromkeys(sorted(of.values())) if w and w not in self.cores]
        base = len(self.table)
        self.cores.update((w, base + k) for k, w in enumerate(new))
        self.table = np.concatenate([self.table, self.field.scores(new)])
        self.seen.update((w, self.cores[c] if c else -1) for w, c in of.items())

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, share of the words) of each text."""
        if not self.field.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        split = [pieces((text or "").split()) for text in texts]
        out: list[tuple[str, float]] = []
        at = 0
        while at < len(split):
            end, total = at, 0
            while end < len(split) and (end == at or total + len(split[end]) < _WORDS):
                total += len(split[end])
                end += 1
            out += self._some(split[at:end])
            at = end
        return out

    def _some(self, texts: list[list[str]]) -> list[tuple[str, float]]:
        if len(self.seen) > _CACHE:
            self._reset()
        missing = set(itertools.chain.from_iterable(texts)) - self.seen.keys()
        if missing:
            self._learn(missing)
        get = self.seen.__getitem__
        total = np.zeros((len(texts), len(self.field.languages)))
        places, lengths, owners = [], [], []

        def run() -> None:
            if lengths:
                g = self.field.posteriors(self.table[np.concatenate(places)], np.array(lengths))
                begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                np.add.at(total, owners, np.add.reduceat(g, begin, axis=0))

        for k, words in enumerate(texts):
            ids = np.fromiter(map(get, words), dtype=np.int64, count=len(words))
            ids = ids[ids >= 0]
            for a in range(0, len(ids), _LONGEST):
                if sum(lengths) + len(ids[a : a + _LONGEST]) > 2 * _WORDS:
                    run()
                    places, lengths, owners = [], [], []
                places.append(ids[a : a + _LONGEST])
                lengths.append(len(places[-1]))
                owners.append(k)
        run()
        sums = total.sum(axis=1)
        best = total.argmax(axis=1)
        return [(self.field.languages[b], min(1.0, float(t[b] / s))) if s > 0 else (UNDETERMINED, 0.0) for t, s, b in zip(total, sums, best)]


def held_out(doc: Column) -> Column:
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(df: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, words_per_text: int = WORDS_PER_TEXT) -> Field:
    """A field from at most ``per_language`` labelled texts of each language, picked by a hash.

    Rows without a text or a language teach nothing.
    """
    some = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in some.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not counts:
        return train([], words_per_text)
    chance = F.lit(1.0)
    for name, n in counts.items():
        chance = F.when(F.col("lang") == name, 2.0 * per_language / n).otherwise(chance)
    number = (F.xxhash64("text").bitwiseAND((1 << 52) - 1)).cast("double") / float(1 << 52)
    picked = some.where(number < chance).withColumn("number", number)
    near = picked.withColumn("text", F.when(F.length("text") > 40 * words_per_text, F.substring("text", 1, 40 * words_per_text)).otherwise(F.col("text")))
    rows = near.orderBy("number").limit(4 * per_language * len(counts)).collect()
    taken: dict[str, int] = {}
    texts = []
    for r in rows:
        if taken.get(r["lang"], 0) < per_language:
            taken[r["lang"]] = taken.get(r["lang"], 0) + 1
            texts.append((r["text"], r["lang"]))
    return train(texts, words_per_text)


def predict(df: DataFrame, field: Field, text: str = "text", prefix: str = "") -> DataFrame:
    """All columns of ``df`` but a text is read once: plus ``lang_pred`` and ``score``.

    ``und`` with a score of 0 for a null text or one without a letter, and if nothing was
    learned. ``score`` is the predicted language's share of the words. Texts of any length
    are read whole; one above a million words counts as sequences of a million words.
    """
    shared = df.sparkSession.sparkContext.broadcast(field)  # its size depends on parameters and languages only
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in batches:
            found = labeller.label(batch.column(place).to_pylist())
            more = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [f"c{k}" for k in range(len(batch.columns))] + ["lang_pred", "score"])

    numbered = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    schema = ", ".join([*(f"c{k} {kind}" for k, (_, kind) in enumerate(df.dtypes)), "lang_pred string", "score double"])
    return numbered.mapInArrow(run, schema).toDF(*[f"{prefix}{c}" if prefix else c for c in df.columns], "lang_pred", "score")


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    field = fit(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    found = stored(predict(docs.select("doc_id", "text"), field).drop("text"), "languages")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

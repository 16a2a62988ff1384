"""Part-of-speech tags by a hidden Markov model learned from untagged sentences and a lexicon.

Words are taken by ambiguity class: the set of tags the lexicon gives a word, or the shape of
a word it does not know. A class is a small alphabet whatever the lexicon's size, so the model is a
few tables of numbers. Training is expectation maximisation: each task passes forward and
backward over its sentences and adds up expected counts, an aggregation over the
tasks gives the next model. Decoding is a column. Both take the sentences of a block word by
word, so a long sentence costs no more a word than a short one.

A class of a single tag tells the state of its word, and what stands before it tells nothing about what
follows. So sentences are cut at such words, which belong to both stretches, and equal stretches are one with
its count: training counts them once, and decoding meets each once a batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswire.functions.lexicon import InlineLexicon
from presswire.operators.blocks import stored
# Shapes of unknown words, the first that fits, and the tags they may have.
SHAPES = (
    (r"^\p{N}", "#number", ("CD",)),
    (r"^[.!?]$", "#stop", (".",)),
    (r"^[^\p{L}\p{N}]$", "#sign", ("SYM",)),
    (r"^\p{Lu}", "#upper", ("NNP", "NNPS")),
    (r"ing$", "#ing", ("VBG", "NN", "JJ")),
    (r"ed$", "#ed", ("VBD", "VBN", "JJ")),
    (r"ly$", "#ly", ("RB", "JJ")),
    (r"s$", "#s", ("NNS", "VBZ")),
    (r"", "#other", ("NN", "JJ", "VB", "VBP")),
)
ROUNDS = 5
TINY = 1e-12
BLOCK_WORDS = 100_000  # of a block in memory; a longer sentence is a block of its own
BLOCK_SENTENCES = 4_096
WIDTH = np.dtype("<u4")  # of a class's number within a stretch


def ambiguity(entries: Iterable[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    """``(language, word, class)`` from ``(language, word, tag)``: tags of a word sorted and joined by ``|``."""
    tags: dict[tuple[str, str], set[str]] = {}
    for language, word, tag in entries:
        tags.setdefault((language, word.lower()), set()).add(tag)
    return [(language, word, "|".join(sorted(found))) for (language, word), found in tags.items()]


def word_classes(tokens: Column, lexicon: InlineLexicon, language: Column) -> Column:
    """The ambiguity class of each token; a shape for words the lexicon does not hold."""

    def shape(t: Column) -> Column:
        out, ending = F, F
        for pattern, name, _ in SHAPES[:-1]:
            out = out.when(t.rlike(pattern), F.lit(name))
            if pattern[:-1].isalpha():
                ending = ending.when(t.endswith(pattern[:-1]), F.lit(name))
        # Words starting with a plain letter, by far the most, take no pattern test.
        return (
            F.when((t >= "a") & (t < "{"), ending.otherwise(F.lit(SHAPES[-1][1])))
            .when((t >= "A") & (t < "["), F.lit("#upper"))
            .otherwise(out.otherwise(F.lit(SHAPES[-1][1])))
        )

    return F.zip_with(tokens, lexicon.lookup(tokens, language), lambda t, c: F.coalesce(c, shape(t)))


def tags_of(name: str) -> tuple[str, ...]:
    """The tags a class allows."""
    return next((tags for _, shape, tags in SHAPES if shape == name), tuple(name.split("|")))


@dataclass(frozen=True)
class Model:
    """Log probabilities; a class that a tag does not allow has none from it."""

    tags: tuple[str, ...]
    classes: tuple[str, ...]
    start: np.ndarray  # (tags,)
    moves: np.ndarray  # (tags, tags)
    emit: np.ndarray  # (classes, tags)

    @property
    def allowed(self) -> np.ndarray:
        return np.array([[t in tags_of(c) for t in self.tags] for c in self.classes], dtype=bool).reshape(len(self.classes), len(self.tags))

    @classmethod
    def first(cls, counts: dict[str, int]) -> Model:
        """From how often each class occurs: a class gives its tags equal shares, all moves are alike."""
        classes = tuple(sorted(counts))
        tags = tuple(sorted({t for c in classes for t in tags_of(c)}))
        k = len(tags)
        flat = cls(tags, classes, np.full(k, -np.log(max(k, 1))), np.full((k, k), -np.log(max(k, 1))), np.empty((0, k)))
        share = flat.allowed * (np.array([[counts[c]] for c in classes], dtype=float) / np.maximum(flat.allowed.sum(axis=1, keepdims=True), 1))
        return replace(flat, emit=flat._logs(share / np.maximum(share.sum(axis=0, keepdims=True), TINY)))

    def _logs(self, share: np.ndarray) -> np.ndarray:
        return np.where(self.allowed, np.log(np.maximum(share, TINY)), -np.inf)

    def next(self, start: np.ndarray, moves: np.ndarray, emit: np.ndarray) -> Model:
        """The model of expected counts; what never occurs keeps a tiny share. Numbers are
        rounded, so that the order of sums over tasks makes no difference."""

        def shares(counts: np.ndarray, axis: int) -> np.ndarray:
            return (counts + TINY) / (counts + TINY).sum(axis=axis, keepdims=True)

        logs = (np.log(shares(start, 0)), np.log(shares(moves, 1)), self._logs(shares(emit * self.allowed, 0)))
        return replace(self, **dict(zip(("start", "moves", "emit"), (np.round(x, 8) for x in logs), strict=True)))

    def decode(self, classes: Column) -> Column:
        """The most probable tags of a class array; of equal paths the one of earlier tags, from the end.
        A class not met in training may have the tags it names."""
        if not self.tags:
            return F.transform(classes, lambda _: F.lit(None).cast("string"))
        model = self

        @F.arrow_udf("array<string>")
        def best(found: pa.Array) -> pa.Array:
            return _tagged(model, found)

        return best(classes)


def _numbers(found: pa.ListArray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all arrays as one run of numbers, strange ones as the last number, and the length of each array."""
    place = pc.index_in(found.flatten(), value_set=pa.array(model.classes, pa.string()))
    sizes = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
    return pc.fill_null(place, len(model.classes)).to_numpy(zero_copy_only=False).astype(np.intp), sizes.astype(np.int64)


def _steps(ids: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, list[int], np.ndarray]]:
    """Blocks of sentences, laid out word by word: all first words, then all second ones, and so on.

    The longest sentences come first, so those that have a next word are a head of those that have this one. Gives the place in ``ids``
    of each row, the border of every word's rows, and the number of words of each sentence that has any.
    """
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    begins = np.cumsum(sizes) - sizes
    words = np.cumsum(sizes[order])
    at = 0
    while at < len(order):
        before = words[at - 1] if at else 0
        to = max(at + 1, min(at + BLOCK_SENTENCES, int(np.searchsorted(words, before + BLOCK_WORDS, side="right"))))
        some = order[at:to]
        size = sizes[some]
        rank = np.repeat(np.arange(len(some)), size)
        word = np.arange(len(rank)) - np.repeat(np.cumsum(size) - size, size)
        borders = np.concatenate([[0], np.cumsum(np.bincount(word))])
        place = np.empty(len(rank), dtype=np.int64)
        place[borders[word] + rank] = begins[some][rank] + word
        yield place, borders.tolist(), size
        at = to


@dataclass
class _Stretches:
    """Sentences cut behind every word of a single tag: the places of each stretch's words, and whether it goes on from such a word, its first."""

    places: np.ndarray
    sizes: np.ndarray
    begun: np.ndarray

    @classmethod
    def of(cls, model: Model, ids: np.ndarray, sizes: np.ndarray) -> _Stretches:
        alone = np.append(model.allowed.sum(axis=1) == 1, len(model.tags) == 1)[ids]
        cut = alone.copy()
        cut[np.cumsum(sizes[sizes > 0]) - 1] = True
        ends = np.flatnonzero(cut)
        sentence = np.repeat(np.arange(len(sizes)), sizes)[ends]
        begun = np.append(False, sentence[1:] == sentence[:-1])[: len(ends)]
        starts = np.where(begun, np.append(0, ends[:-1])[: len(ends)], (np.cumsum(sizes) - sizes)[sentence])
        size = ends - starts + 1
        return cls(np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum()), size, begun)

    def keys(self, ids: np.ndarray) -> pa.Array:
        """Each stretch as bytes: whether it goes on, and the classes of its words."""
        whole = np.empty(len(self.places) + len(self.sizes), dtype=WIDTH)
        ends = np.cumsum(self.sizes + 1)
        heads = ends - self.sizes - 1
        rest = np.ones(len(whole), dtype=bool)
        rest[heads] = False
        whole[heads], whole[rest] = self.begun, ids[self.places]
        borders = np.concatenate([[0], ends]).astype(np.int64) * WIDTH.itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(borders), pa.py_buffer(whole)])


def _read(keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classes of stretches as one run, the length of each, and whether it goes on."""
    sizes = (pc.binary_length(keys).to_numpy(zero_copy_only=False) // WIDTH.itemsize).astype(np.int64)
    whole = np.frombuffer(b"".join(keys.to_pylist()), dtype=WIDTH)
    heads = np.cumsum(sizes) - sizes
    return np.delete(whole, heads).astype(np.intp), sizes - 1, whole[heads] == 1


def _tagged(model: Model, found: pa.Array) -> pa.Array:
    """The best paths of class arrays, of equal ones the one of earlier tags, from the end."""
    ids, sizes = _numbers(found, model)
    cut = _Stretches.of(model, ids, sizes)
    coded = cut.keys(ids).dictionary_encode()
    best, lengths = _best(model, *_read(coded.dictionary))
    which = coded.indices.to_numpy(zero_copy_only=False)
    first = np.cumsum(cut.sizes) - cut.sizes
    tags = np.empty(len(ids), dtype=np.int32)
    tags[cut.places] = best[np.repeat((np.cumsum(lengths) - lengths)[which] - first, cut.sizes) + np.arange(len(cut.places))]
    borders = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    names = pa.array(model.tags, pa.string()).take(pa.array(tags))
    return pa.ListArray.from_arrays(borders, names, mask=pc.is_null(found))


def _best(model: Model, ids: np.ndarray, sizes: np.ndarray, begun: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best tags of stretches, and the length of each."""
    k = len(model.tags)
    nothing = -1e300
    given = np.vstack([np.maximum(model.emit, nothing), np.zeros((1, k))])
    first, into = np.maximum(model.start, nothing), np.maximum(model.moves, nothing).T.copy()
    tags = np.empty(len(ids), dtype=np.int32)
    goes_on = np.repeat(begun, sizes)
    for place, borders, size in _steps(ids, sizes):
        emit = given[ids[place]]
        back = np.zeros((len(place), k), dtype=np.int16)
        score = np.where(goes_on[place[: borders[1]], None], 0.0, first) + emit[: borders[1]]
        last = np.empty(len(size), dtype=np.int16)
        for t in range(1, len(borders) - 1):
            at, to = borders[t], borders[t + 1]
            last[to - at : len(score)] = score[to - at :].argmax(axis=1)
            reached = score[: to - at, None, :] + into
            back[at:to] = reached.argmax(axis=2)
            score = reached.max(axis=2) + emit[at:to]
        last[: len(score)] = score.argmax(axis=1)
        for t in range(len(borders) - 2, -1, -1):
            at, to = borders[t], borders[t + 1]
            tags[place[at:to]] = last[: to - at]
            if t:
                last[: to - at] = back[np.arange(at, to), last[: to - at]]
    return tags, sizes


def expected(model: Model, sentences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts of first tags, moves and emissions, and the log likelihood, of sentences as class numbers."""
    ids = np.concatenate([np.zeros(0, dtype=np.intp), *sentences])
    return _expected(model, ids, np.array([len(s) for s in sentences], dtype=np.int64))


def _expected(
    model: Model, ids: np.ndarray, sizes: np.ndarray, begun: np.ndarray | None = None, times: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The same of sentences in one run; the sums of a block are made at once.

    Of a stretch that goes on from a word (``begun``) that word counts for nothing by itself. ``times`` is how often each occurs.
    """
    k = len(model.tags)
    begun = np.zeros(len(sizes), dtype=bool) if begun is None else begun
    times = np.ones(len(sizes)) if times is None else times.astype(float)
    goes_on, often = np.repeat(begun, sizes), np.repeat(times, sizes)
    start, moves, emit, total = np.zeros(k), np.zeros((k, k)), np.zeros((len(model.classes), k)), 0.0
    step, first, given = np.exp(model.moves), np.exp(model.start), np.exp(model.emit)
    for place, borders, size in _steps(ids, sizes):
        own, n = ids[place], often[place][:, None]
        known = goes_on[place[: borders[1]], None]
        e = given[own]
        forward, scale, both = np.empty_like(e), np.empty((len(own), 1)), np.empty_like(e)
        for t in range(len(borders) - 1):
            at, to = borders[t], borders[t + 1]
            a = e[at:to] * (np.where(known, 1.0, first) if t == 0 else forward[borders[t - 1] : borders[t - 1] + to - at] @ step)
            scale[at:to] = a.sum(axis=1, keepdims=True)
            forward[at:to] = a / scale[at:to]
        back = np.ones((len(size), k))
        for t in range(len(borders) - 2, -1, -1):
            at, to = borders[t], borders[t + 1]
            both[at:to] = forward[at:to] * back[: to - at]
            if t:
                into = e[at:to] * back[: to - at] / scale[at:to]
                moves += step * (forward[borders[t - 1] : borders[t - 1] + to - at].T @ (into * n[at:to]))
                back[: to - at] = into @ step.T
        counted = n.copy()
        counted[: borders[1]][known] = 0
        total += float((np.log(scale) * counted).sum())
        both *= counted / both.sum(axis=1, keepdims=True)
        start += both[: borders[1]].sum(axis=0)
        order = np.argsort(own, kind="stable")
        met, begins = np.unique(own[order], return_index=True)
        emit[met] += np.add.reduceat(both[order], begins, axis=0)
    return start, moves, emit, total


def train(sentences: DataFrame, classes: str, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """The model of a column of class arrays, and the log likelihood before each round.

    ``sentences`` is read twice, for its classes and for its stretches; hand in a stored table. The distinct
    stretches are stored with their counts, and read once a round. Only the model's own
    numbers reach the driver: as many as classes times tags. Null and empty sentences count
    for nothing.
    """
    rows = sentences.select(F.col(classes).alias("c"))
    met = rows.select(F.explode("c").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a class
    model = Model.first({r["c"]: r["n"] for r in met})
    k, seen = len(model.tags), []
    if not k:
        return model, seen
    begun = model

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = _numbers(batch.column("c"), begun)
            counts = _Stretches.of(begun, ids, sizes).keys(ids).value_counts()
            yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.binary()), counts.field("counts")], ["stretch", "n"])

    stretches = stored(rows.mapInArrow(cut, "stretch binary, n bigint").groupBy("stretch").agg(F.sum("n").alias("n")), "stretches")
    for _ in range(rounds):
        now = model

        def count(batches: Iterator[pa.RecordBatch], now: Model = now) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(k), np.zeros((k, k)), np.zeros((len(now.classes), k)), 0.0]
            for batch in batches:
                times = batch.column("n").to_numpy(zero_copy_only=False)
                sums = [a + b for a, b in zip(sums, _expected(now, *_read(batch.column("stretch")), times), strict=True)]
            flat = np.concatenate([np.ravel(x) for x in sums])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "n"])

        added = stretches.mapInArrow(count, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()
        flat = np.zeros(k + k * k + len(model.classes) * k + 1)
        for r in added:
            flat[r["at"]] = r["n"]
        seen.append(float(flat[-1]))
        model = model.next(flat[:k], flat[k : k + k * k].reshape(k, k), flat[k + k * k : -1].reshape(-1, k))
    return model, seen

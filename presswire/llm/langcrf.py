"""Language of code-switched text: a linear-chain conditional random field over words.

A word's features are its byte n-grams of two to four with the word's borders (so
affixes are among them) and, if the training sample knows the word, the word
itself. Learned transitions join neighbouring words. Forward and backward passes
give each word's label probabilities; a document's language has the largest sum.

The model is fitted in numpy on the driver, on at most ``SAMPLE`` labelled documents
a language, none above ``LONGEST`` bytes: that is its documented bound. Labelling
covers every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswire.llm.common import fold, table, text_slices, texts_of

SAMPLE = 400  # labelled documents a language at most
LONGEST = 32 << 10  # bytes of a sampled document at most
BITS = 15  # slots of each feature kind, as a power of two
EPOCHS = 3
SPAN = 48  # words of a training sequence
STRETCH = 12  # mean words of one language within it
GROUP = 2 << 20  # bytes of text labelled together
CHUNK = 1 << 19  # bytes whose features are held at once
LEXICON = 3  # occurrences after which a word is in the lexicon

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("a") : ord("z") + 1] = True
_LETTER[128:] = True
_ANY = re.compile(r"[^\W\d_]")
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
_NONE = np.uint32(1 << BITS)  # the row of zeros behind each table


def _features(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of lower-case bytes: slots (3, positions), slots of whole words, first position and first byte of each word.

    ``raw`` begins and ends with bytes that are no letters. A word's positions are
    its letters and the border behind it.
    """
    letter = _LETTER[raw]
    c = np.where(letter, raw, 32).astype(np.uint32)
    at = np.flatnonzero(letter[1:] | letter[:-1]) + 1
    before = letter[at - 1]
    two = c[at] | c[at - 1] << np.uint32(8)
    third = np.maximum(at - 2, 0)
    three = two | c[third] << np.uint32(16)
    inside = before & letter[third]
    four = three | c[np.maximum(at - 3, 0)] << np.uint32(24)
    shift = np.uint32(32 - BITS)
    slots = np.empty((3, len(at)), dtype=np.int32)
    slots[0] = (two * _ODD[0]) >> shift
    slots[1] = np.where(before, (three * _ODD[1]) >> shift, _NONE)
    slots[2] = np.where(inside, (four * _ODD[2]) >> shift, _NONE)
    first = np.flatnonzero(~before)
    # The whole word: its two- and three-gram codes summed with a factor by place.
    place = np.arange(len(at), dtype=np.uint32) - np.repeat(first, np.diff(first, append=len(at))).astype(np.uint32)
    mixed = (three * _ODD[3] ^ three >> np.uint32(7)) * (place * np.uint32(2) + np.uint32(1))
    word = np.add.reduceat(mixed, first).astype(np.uint32) if len(first) else np.empty(0, np.uint32)
    word = ((word ^ word >> np.uint32(15)) * _ODD[0]) >> shift
    return slots, word.astype(np.int32), first, at[first]


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray  # (3, slots + 1, labels)
    whole: np.ndarray  # (slots + 1, labels)
    moves: np.ndarray  # (labels, labels), log
    start: np.ndarray

    def scores(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores of each word and the byte it begins at."""
        slots, word, first, byte = _features(raw)
        if not len(first):
            return np.empty((0, len(self.labels)), np.float32), byte
        at = self.grams[0].take(slots[0], axis=0, mode="clip")
        at += self.grams[1].take(slots[1], axis=0, mode="clip")
        at += self.grams[2].take(slots[2], axis=0, mode="clip")
        return np.add.reduceat(at, first, axis=0) + self.whole.take(word, axis=0, mode="clip"), byte


def marginals(emit: np.ndarray, begins: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Label probabilities of every word; sequences begin at ``begins`` and follow each other.

    All sequences advance together, longest first, so that those still running are
    a prefix; the words are laid out step by step for that.
    """
    n = np.diff(begins, append=len(emit))
    order = np.argsort(-n, kind="stable")
    first, size = begins[order], n[order]
    running = len(size) - np.searchsorted(size[::-1], np.arange(1, (size[0] if len(size) else 0) + 1), side="left")
    rank = np.empty(len(size), dtype=np.intp)
    rank[order] = np.arange(len(size))
    offset = np.concatenate([[0], np.cumsum(running)])
    place = offset[np.arange(len(emit)) - np.repeat(begins, n)] + np.repeat(rank, n)
    k = emit.shape[1]
    e = np.empty((len(emit), k), dtype=np.float32)
    e[place] = np.exp(np.maximum(emit - emit.max(axis=1, keepdims=True), -30.0))
    step, init, ones = np.exp(moves).astype(np.float32), np.exp(start).astype(np.float32), np.ones((k, k), np.float32)
    forward = np.empty_like(e)
    a = np.empty((0, k), np.float32)
    for t, (o, m) in enumerate(zip(offset.tolist(), running.tolist(), strict=False)):
        a = np.multiply(e[o : o + m], init if t == 0 else a[:m] @ step, out=forward[o : o + m])
        a /= a @ ones
    behind = np.ones((len(size), k), dtype=np.float32)
    for t in range(len(running) - 1, 0, -1):
        o, m = int(offset[t]), int(running[t])
        b = behind[:m]
        forward[o : o + m] *= b
        b *= e[o : o + m]
        np.matmul(b.copy(), step.T, out=b)
        b /= b @ ones
    forward[: len(size)] *= behind
    forward /= forward @ ones
    return forward[place]


def forgetting(moves: np.ndarray, rest: float = 1e-7) -> int:
    """Words after which a message depends on what lay before by less than ``rest``.

    The bound is Birkhoff's contraction of a positive matrix; it holds for any
    emission scores.
    """
    gain = moves[:, None, :, None] + moves[None, :, None, :]  # i, k, j, l: ij + kl
    spread = float((gain - gain.transpose(0, 1, 3, 2)).max())  # minus il + kj
    tau = np.tanh(spread / 4)
    return 1 if tau < rest else int(np.ceil(np.log(rest) / np.log(tau))) if tau < 1 else 1 << 30


def long_marginals(emit: np.ndarray, begins: np.ndarray, moves: np.ndarray, start: np.ndarray, piece: int = 1024) -> np.ndarray:
    """``marginals`` with long sequences passed in overlapping pieces, so that few steps are needed.

    The overlap is long enough for the difference to vanish in single precision.
    """
    lap = forgetting(moves)
    n = np.diff(begins, append=len(emit))
    if lap > piece or not len(n) or n.max() <= piece + 2 * lap:
        return marginals(emit, begins, moves, start)
    pieces = np.maximum(-(-n // piece), 1)
    of = np.repeat(np.arange(len(n)), pieces)
    number = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    core = begins[of] + number * piece
    core_end = np.minimum(core + piece, (begins + n)[of])
    low, high = np.maximum(core - lap, begins[of]), np.minimum(core_end + lap, (begins + n)[of])
    size = high - low
    offset = np.cumsum(size) - size
    rows = np.arange(int(size.sum())) + np.repeat(low - offset, size)
    p = marginals(emit[rows], offset, moves, start)
    kept = (rows >= np.repeat(core, size)) & (rows < np.repeat(core_end, size))
    return p[kept]


def _pairs(emit: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected labels (T, S, K) and summed expected transitions of equally long sequences."""
    t_all, s_all, k_all = emit.shape
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    step = np.exp(moves)
    fwd, bwd = np.empty_like(e), np.ones_like(e)
    for t in range(t_all):
        a = e[t] * (np.exp(start) if t == 0 else fwd[t - 1] @ step)
        fwd[t] = a / a.sum(axis=1, keepdims=True)
    for t in range(t_all - 2, -1, -1):
        b = (e[t + 1] * bwd[t + 1]) @ step.T
        bwd[t] = b / b.sum(axis=1, keepdims=True)
    one = fwd * bwd
    one /= one.sum(axis=2, keepdims=True)
    two = np.einsum("tsi,ij,tsj->tsij", fwd[:-1], step, e[1:] * bwd[1:])
    two /= two.sum(axis=(2, 3), keepdims=True)
    return one, two.sum(axis=(0, 1))


def fit(rows: list[tuple[str, str]], seed: int = 7) -> Model:
    """The model of ``(text, label)`` rows; sequences mix stretches of several documents."""
    labels = sorted({label for _, label in rows})
    k = len(labels)
    model = Model(labels, np.zeros((3, (1 << BITS) + 1, k), np.float32), np.zeros(((1 << BITS) + 1, k), np.float32), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return model
    rng = np.random.default_rng(seed)
    # Stretches of each label's words, then drawn label by label into sequences.
    parts = [np.frombuffer((" " + " \n ".join(t.lower() for t, x in rows if x == label) + " ").encode("utf-8", "replace"), np.uint8) for label in labels]
    offset, lab, slots, word, lens = 0, [], [], [], []
    pools: list[np.ndarray] = []
    for number, raw in enumerate(parts):
        s, w, first, _ = _features(raw)
        slots.append(s)
        word.append(w)
        lens.append(np.diff(first, append=s.shape[1]))
        lab.append(np.full(len(w), number))
        pools.append(np.arange(offset, offset + len(w)))
        offset += len(w)
    slots_, word_, lens_, lab_ = np.concatenate(slots, axis=1), np.concatenate(word), np.concatenate(lens), np.concatenate(lab)
    at = np.cumsum(lens_) - lens_
    common = np.bincount(word_, minlength=1 << BITS) >= LEXICON
    word_ = np.where(common[word_], word_, int(_NONE))
    squares = [np.full_like(model.grams, 1e-6), np.full_like(model.whole, 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)]
    cursor = [0] * k
    total = max(len(p) for p in pools) * k
    each = 128
    for _ in range(max(1, EPOCHS * total // (SPAN * each))):
        seq = np.empty((SPAN, each), dtype=np.int64)
        for s in range(each):
            t = 0
            while t < SPAN:
                y = int(rng.integers(k))
                m = min(SPAN - t, int(rng.geometric(1 / STRETCH)))
                pool = pools[y]
                seq[t : t + m, s] = pool[(cursor[y] + np.arange(m)) % len(pool)]
                cursor[y] += m
                t += m
        flat = seq.ravel()
        n = lens_[flat]
        ends = np.cumsum(n)
        where = np.repeat(at[flat] - (ends - n), n) + np.arange(ends[-1])
        f = slots_[:, where]
        emit = np.add.reduceat(model.grams[0][f[0]] + model.grams[1][f[1]] + model.grams[2][f[2]], ends - n, axis=0) + model.whole[word_[flat]]
        gold = np.eye(k)[lab_[seq]]
        one, two = _pairs(emit.reshape(SPAN, each, k).astype(np.float64), model.moves, model.start)
        slope = ((gold - one) / each).reshape(-1, k)
        spread = np.repeat(slope, n, axis=0)
        for j in range(3):
            step = np.stack([np.bincount(f[j], spread[:, y], minlength=(1 << BITS) + 1) for y in range(k)], axis=1)
            squares[0][j] += step**2
            model.grams[j] += 0.2 * step / np.sqrt(squares[0][j])
        step = np.stack([np.bincount(word_[flat], slope[:, y], minlength=(1 << BITS) + 1) for y in range(k)], axis=1)
        squares[1] += step**2
        model.whole += 0.2 * step / np.sqrt(squares[1])
        model.grams[:, -1] = 0
        model.whole[-1] = 0
        step = (np.einsum("tsi,tsj->ij", gold[:-1], gold[1:]) - two) / each
        squares[2] += step**2
        model.moves += 0.1 * step / np.sqrt(squares[2])
        step = (gold[0] - one[0]).mean(axis=0)
        squares[3] += step**2
        model.start += 0.1 * step / np.sqrt(squares[3])
    return model


def sample(docs: DataFrame, each: int = SAMPLE, longest: int = LONGEST) -> list[tuple[str, str]]:
    """At most about ``each`` rows a language, chosen by a hash of the id, none above ``longest`` bytes."""
    fit_for = docs.filter(F.col("lang").isNotNull() & (F.octet_length("text") <= longest) & (fold(F.col("doc_id"), 5) != 0))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("crf")), F.lit(1 << 30)) / float(1 << 30)
    sizes = fit_for.groupBy("lang").count().collect()  # a row a language
    if not sizes:
        return []
    rates = F.create_map(*[F.lit(v) for r in sizes for v in (r["lang"], float(each) / r["count"])])
    rows = fit_for.filter(draw < F.try_element_at(rates, F.col("lang"))).select("text", "lang", "doc_id").collect()
    return [(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["lang"], str(r["doc_id"]), r["text"])) if _ANY.search(r["text"])]


def label_texts(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and share of words in another language, for each text."""
    lower = [t.lower().encode("utf-8", "replace") for t in texts]
    blob = np.frombuffer(b" " + b" ".join(lower) + b" ", dtype=np.uint8)
    edges = np.cumsum([1, *(len(b) + 1 for b in lower)])
    emit, places = [], []
    a = 0
    while a < len(blob) - 1:
        b = min(len(blob), a + CHUNK)
        if b < len(blob):  # cut where no word is torn
            stops = np.flatnonzero(~_LETTER[blob[a + 1 : b]])
            while not len(stops):
                b = min(len(blob), b + CHUNK)
                stops = np.flatnonzero(~_LETTER[blob[a + 1 : b]])
            b = a + int(stops[-1]) + 2
        e, at = model.scores(blob[a:b])
        emit.append(e)
        places.append(at + a)
        a = b - 1
    e, at = np.concatenate(emit), np.concatenate(places)
    del emit, places
    begins = np.searchsorted(at, edges)
    n = np.diff(begins)
    full = np.flatnonzero(n)
    if not len(full):
        return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    p = long_marginals(e, begins[:-1][full], model.moves, model.start)
    del e
    sums = np.add.reduceat(p, begins[:-1][full], axis=0, dtype=np.float64)
    best = sums.argmax(axis=1)
    score, other = np.zeros(len(texts)), np.zeros(len(texts))
    score[full] = np.clip(sums[np.arange(len(full)), best] / n[full], 0, 1)
    own = np.repeat(best, n[full])
    other[full] = np.add.reduceat((p.argmax(axis=1) != own).astype(np.float64), begins[:-1][full]) / n[full]
    names = ["und"] * len(texts)
    for k, y in zip(full.tolist(), best.tolist(), strict=True):
        if _ANY.search(texts[k]):
            names[k] = model.labels[y]
        else:
            score[k] = other[k] = 0.0
    return names, score, other


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` plus lang_pred, score and mixed (share of words labelled otherwise).

    ``und`` with score 0 for texts that are null or hold no letter, and for all when
    no labelled row was found. Equal texts get equal answers. Columns of these names
    are replaced; all others pass through; only ``text`` is an input of a prediction.
    """
    new = ["lang_pred", "score", "mixed"]
    docs = docs.drop(*new)
    model = model or fit(sample(docs))
    raw = docs.sparkSession.sparkContext.broadcast(model)  # slots times languages, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = raw.value
        for part in text_slices(batches, GROUP):
            held = texts_of(part)
            if known.labels:
                names, score, other = label_texts(known, held)
            else:
                names, score, other = ["und"] * len(held), np.zeros(len(held)), np.zeros(len(held))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(score), pa.array(other)], [*part.schema.names, *new])

    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(new, kinds, strict=True))]))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``, learned from four folds of five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(sample(docs))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "mixed")

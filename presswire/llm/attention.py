"""A small causal self-attention model over subword ids, in numpy.

One head looks back over the ids of the same and the previous stretch; a bilinear
read-out of the id and of what it attended to gives one of ``CLASSES`` classes of
the next id, and the corpus frequency of the id within its class does the rest, so
that the probabilities of all ids sum to one.

An id enters by its type: its own if it is frequent, else its class. What a type
gives to queries, keys, values and the read-out is one row of a table, and texts are
worked on in runs of neighbouring stretches. ``Trainer`` takes Adam steps over such
runs; several of them may train on parts of a corpus and be averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CLASSES = 32
WIDTH = 16  # of an id's vector
KEY = 8  # of queries and keys
STRETCH = 16  # ids scored together; each also sees the stretch before
SLOTS = 2048  # frequent ids with a vector of their own
SKETCH = 24  # columns that hold an id's neighbours of one side
TURN = 128  # stretches scored at once
EACH = 512  # stretches of a training step
_SEEN = np.arange(2 * STRETCH)[None, :] <= np.arange(STRETCH)[:, None] + STRETCH
_BACK = np.clip(np.arange(STRETCH)[:, None] + STRETCH - np.arange(2 * STRETCH)[None, :], 0, 2 * STRETCH - 1)
_SHAPES = {"cls": (CLASSES, WIDTH), "own": (SLOTS, WIDTH), "q": (WIDTH, KEY), "k": (WIDTH, KEY), "v": (WIDTH, WIDTH), "back": (2 * STRETCH,), "x_out": (WIDTH, CLASSES), "a_out": (WIDTH, CLASSES), "bias": (CLASSES,)}


@dataclass
class Tables:
    """What each type gives: vector, then query, key, value and 1, and class scores; and the weights of distances."""

    x: np.ndarray
    near: np.ndarray
    out: np.ndarray
    far: np.ndarray
    wide_near: bool = True  # whether scores of attention may have to be clipped
    wide_out: bool = True  # and those of classes


@dataclass
class Attention:
    end: int
    classes: np.ndarray  # of every id
    slots: np.ndarray  # of every id
    weights: dict[str, np.ndarray]
    within: np.ndarray  # log10 of an id's share of its class

    def __post_init__(self) -> None:
        frequent = self.slots < SLOTS - 1
        self.types = np.where(frequent, self.slots, SLOTS - 1 + self.classes).astype(np.intp)
        self.type_class = np.concatenate([np.zeros(SLOTS - 1, dtype=np.int64), np.arange(CLASSES)])
        self.type_class[self.slots[frequent]] = self.classes[frequent]
        self.type_slot = np.minimum(np.arange(SLOTS - 1 + CLASSES), SLOTS - 1)
        self.of_class = (self.type_class == np.arange(CLASSES)[:, None]).astype(np.float32)

    def stretches(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Inputs and targets cut into stretches, whether one begins a text, and where the targets lie."""
        n = -(-sizes // STRETCH)
        begins = np.cumsum(sizes) - sizes
        row = np.cumsum(n) - n
        place = np.arange(len(ids)) + np.repeat(row * STRETCH - begins, sizes)
        target = np.full(int(n.sum()) * STRETCH, self.end, dtype=np.int32)
        target[place] = ids
        entry = np.empty_like(target)
        entry[1:] = target[:-1]
        entry[row[sizes > 0] * STRETCH] = self.end
        first = np.zeros(int(n.sum()), dtype=bool)
        first[row[sizes > 0]] = True
        return entry.reshape(-1, STRETCH), target.reshape(-1, STRETCH), first, place

    def tables(self) -> Tables:
        w = self.weights
        x = w["cls"].take(self.type_class, axis=0)
        x += w["own"].take(self.type_slot, axis=0)
        q, k, v, out = x @ w["q"], x @ w["k"], x @ w["v"], x @ w["x_out"] + w["bias"]
        far = np.where(_SEEN, np.exp(np.clip(w["back"], -20, 20))[_BACK], np.float32(0))
        return Tables(x, np.concatenate([q, k, v, np.ones((len(x), 1), dtype=np.float32)], axis=1), out, far)

    def bounded(self) -> Tables:
        """The tables, and whether any score may lie beyond what is clipped, by the longest rows."""
        t = self.tables()
        q, k, v = t.near[:, :KEY], t.near[:, KEY : 2 * KEY], t.near[:, 2 * KEY : -1]
        longest = [float(np.sqrt(np.einsum("ij,ij->i", x, x).max())) for x in (q, k, v, self.weights["a_out"].T)]
        t.wide_near = not longest[0] * longest[1] <= 15
        t.wide_out = not float(np.abs(t.out).max()) + longest[2] * longest[3] <= 25
        return t

    def forward(self, types: np.ndarray, first: np.ndarray, tables: Tables) -> tuple[np.ndarray, ...]:
        """Class scores of each position of a run of stretches, behind the one that ``types`` begins with;
        what stands before a stretch is unseen where it is ``first``. Attention is left unnormalised: the last
        column of values is 1, so that what it comes to is what to divide by."""
        near = tables.near.take(types, axis=0)
        q = near[1:, :, :KEY]
        # A stretch and the next, as they lie.
        step, row, item = near.strides
        both = np.ndarray((len(types) - 1, 2 * STRETCH, near.shape[2]), near.dtype, near, 0, (step, row, item))
        k, v = both[:, :, KEY : 2 * KEY], both[:, :, 2 * KEY :]
        a = q @ k.transpose(0, 2, 1)
        if tables.wide_near:
            np.clip(a, -15, 15, out=a)
        np.exp(a, out=a)
        a *= tables.far
        a[first, :, :STRETCH] = 0
        got = a @ v
        share = 1 / got[:, :, WIDTH:]
        got = got[:, :, :WIDTH] * share
        scores = tables.out.take(types[1:].ravel(), axis=0)
        scores += got.reshape(-1, WIDTH) @ self.weights["a_out"]
        if tables.wide_out:
            np.clip(scores, -25, 25, out=scores)
        return scores, q, k, v, a, got, share

    def log10(self, ids: np.ndarray, sizes: np.ndarray, turn: int = TURN) -> np.ndarray:
        """Sum of log10 probabilities of each text's ids; each id is scored once."""
        entry, target, first, place = self.stretches(ids, sizes)
        score = np.empty(target.shape, dtype=np.float32)
        types, wanted = self.types[np.concatenate([entry[:1], entry])], self.classes[target]
        tables, one, at = self.bounded(), np.ones(CLASSES, dtype=np.float32), np.arange(turn * STRETCH)
        for k in range(0, len(entry), turn):
            out = self.forward(types[k : k + turn + 1], first[k : k + turn], tables)[0]
            chosen = out[at[: len(out)], wanted[k : k + turn].ravel()]
            total = np.exp(out, out=out) @ one
            score[k : k + turn] = ((chosen - np.log(total)) * np.float32(np.log10(np.e))).reshape(-1, STRETCH)
        each = score.ravel()[place].astype(np.float64) + self.within[ids]
        begins = np.cumsum(sizes) - sizes
        sums = np.zeros(len(sizes))
        if len(ids):
            full = sizes > 0
            sums[full] = np.add.reduceat(each, begins[full])
        return sums

    def gradient(self, types: np.ndarray, first: np.ndarray, wanted: np.ndarray, real: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over the ``real`` positions of a run."""
        w, tables = self.weights, self.tables()
        g = {n: np.zeros(s, dtype=np.float32) for n, s in _SHAPES.items()}
        back = np.concatenate([w["q"], w["k"], w["v"], w["x_out"]], axis=1)
        near = back.shape[1] - CLASSES
        part, cell = (real / max(real.sum(), 1)).ravel(), np.arange(wanted.size) * CLASSES + wanted.ravel()
        far, one = np.zeros((STRETCH, 2 * STRETCH)), np.ones(CLASSES, dtype=np.float32)
        into = np.zeros((WIDTH, back.shape[1]), dtype=np.float32)
        turns = range(0, len(first), TURN)
        met = np.concatenate([types[k : k + TURN + 1].ravel() for k in turns])
        dx, at = np.empty((len(met), WIDTH), dtype=np.float32), 0
        for k in turns:
            run, here = types[k : k + TURN + 1], slice(k * STRETCH, (k + TURN) * STRETCH)
            d, q, key, v, a, got, per = self.forward(run, first[k : k + TURN], tables)
            share = part[here]
            np.exp(d, out=d)
            d *= (share / (d @ one))[:, None]
            d.ravel()[cell[here] - here.start * CLASSES] -= share
            g["a_out"] += got.reshape(-1, WIDTH).T @ d
            g["bias"] += _summed(d)
            # What the normalisation takes off stands in the last column, as it does in the values.
            dgot = np.empty((*got.shape[:2], WIDTH + 1), dtype=np.float32)
            each = (d @ w["a_out"].T).reshape(got.shape)
            np.multiply(each, per, out=dgot[:, :, :WIDTH])
            np.multiply(np.einsum("sij,sij->si", each, got), -per[:, :, 0], out=dgot[:, :, WIDTH])
            ds = dgot @ v.transpose(0, 2, 1)
            ds *= a
            far += _summed(ds.reshape(len(ds), -1)).reshape(far.shape)
            seen = a.transpose(0, 2, 1) @ dgot[:, :, :WIDTH]
            # A stretch is seen by itself and by the next.
            own = np.empty((*run.shape, back.shape[1]), dtype=np.float32)
            np.matmul(ds, key, out=own[1:, :, :KEY])
            # Keys learn from their own stretch; behind a run's begin, from the next one.
            np.matmul(ds[:, :, STRETCH:].transpose(0, 2, 1), q, out=own[1:, :, KEY : 2 * KEY])
            own[1:, :, 2 * KEY : near] = seen[:, STRETCH:]
            own[1:, :, near:] = d.reshape(-1, STRETCH, CLASSES)
            own[0] = 0
            if not k:
                own[0, :, KEY : 2 * KEY] = ds[0, :, :STRETCH].T @ q[0]
            own[:-1, :, 2 * KEY : near] += seen[:, :STRETCH]
            flat = own.reshape(-1, back.shape[1])
            into += tables.x.take(run.ravel(), axis=0).T @ flat
            np.matmul(flat, back.T, out=dx[at : at + len(flat)])
            at += len(flat)
        for n, begin, end in (("q", 0, KEY), ("k", KEY, 2 * KEY), ("v", 2 * KEY, near), ("x_out", near, near + CLASSES)):
            g[n] = into[:, begin:end]
        g["back"] = np.bincount(_BACK[_SEEN], far[_SEEN], minlength=2 * STRETCH).astype(np.float32)
        # The gradients of positions are summed by type.
        by_type = np.bincount((met[:, None] * WIDTH + np.arange(WIDTH)).ravel(), dx.ravel(), minlength=len(tables.x) * WIDTH)
        by_type = by_type.reshape(-1, WIDTH).astype(np.float32)
        g["cls"] = self.of_class @ by_type
        g["own"] = np.concatenate([by_type[: SLOTS - 1], by_type[SLOTS - 1 :].sum(axis=0, keepdims=True)])
        return g


def _summed(rows: np.ndarray) -> np.ndarray:
    """The sum of rows."""
    return np.ones(len(rows), dtype=rows.dtype) @ rows


class Trainer:
    """Adam over runs of stretches; changes the model's weights."""

    def __init__(self, model: Attention) -> None:
        self.model, self.t = model, 0
        self.flat = packed(model.weights)
        model.weights = unpacked(self.flat)  # views of the row
        self.m1, self.m2 = np.zeros_like(self.flat), np.zeros_like(self.flat)

    def step(self, types: np.ndarray, first: np.ndarray, wanted: np.ndarray, real: np.ndarray, rate: float) -> None:
        self.t += 1
        d = packed(self.model.gradient(types, first, wanted, real)).astype(np.float32, copy=False)
        rate *= min(1, self.t / 50)
        self.m1 += 0.1 * (d - self.m1)
        self.m2 += 0.01 * (d * d - self.m2)
        self.flat -= rate / (1 - 0.9**self.t) * self.m1 / (np.sqrt(self.m2 / (1 - 0.99**self.t)) + 1e-8)

    def runs(self, ids: np.ndarray, sizes: np.ndarray, rng: np.random.Generator, each: int = EACH) -> Iterator[tuple[np.ndarray, ...]]:
        """All stretches of the texts once, cut into runs, in random order."""
        model = self.model
        entry, target, first, place = model.stretches(ids, sizes)
        real = np.zeros(target.size, dtype=np.float32)
        real[place] = 1
        real = real.reshape(target.shape)
        types, wanted = model.types[np.concatenate([entry[:1], entry])], model.classes[target]
        for k in rng.permutation(-(-len(entry) // each)).tolist():
            at = slice(k * each, (k + 1) * each)
            yield types[at.start : at.stop + 1], first[at], wanted[at], real[at]


def sketch(ids: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """What stands before and behind each id, in ``2 * SKETCH`` columns: neighbours are dealt
    to columns with a sign, frequent ones weigh less. The sketches of parts are added."""
    size = len(seen)
    rng = np.random.default_rng(5)
    column, sign = rng.integers(0, SKETCH, size), rng.choice([-1.0, 1.0], size)
    weight = sign / np.sqrt(np.maximum(seen, 1))
    row, own, heavy = ids.astype(np.int64) * SKETCH, column[ids], weight[ids]
    sides = [np.bincount(row[a] + own[b], heavy[b], minlength=size * SKETCH).reshape(size, SKETCH) for a, b in ((slice(1, None), slice(None, -1)), (slice(None, -1), slice(1, None)))]
    return np.concatenate(sides, axis=1)


def _classes(near: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Classes of ids by their neighbours: k-means of the sketch, weighed by how often an id occurs."""
    near = near / np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1e-12)
    known = np.argsort(-seen, kind="stable")[: max(CLASSES, int((seen > 0).sum()))]
    rows = near[known]
    heavy = rows * np.sqrt(seen[known].astype(float))[:, None]
    middle = rows[:CLASSES].copy()
    for _ in range(8):
        own = (rows @ middle.T).argmax(axis=1)
        sums = np.stack([np.bincount(own, column, minlength=len(middle)) for column in heavy.T], axis=1)
        met = np.bincount(own, minlength=len(middle)) > 0
        middle[met] = sums[met] / np.maximum(np.linalg.norm(sums[met], axis=1, keepdims=True), 1e-12)
    out = (near @ middle.T).argmax(axis=1)
    rare = seen == 0
    out[rare] = np.flatnonzero(rare) % CLASSES
    return out.astype(np.int32)


def start(near: np.ndarray, seen: np.ndarray, end: int, seed: int = 11) -> Attention:
    """An untrained model whose classes, slots and shares follow the ids' counts and sketch."""
    rng = np.random.default_rng(seed)
    size = len(seen)
    order = np.argsort(-seen, kind="stable")
    slots = np.full(size, SLOTS - 1, dtype=np.int32)
    slots[order[: SLOTS - 1]] = np.arange(min(size, SLOTS - 1))
    w = {n: (rng.normal(size=s) * (0 if n in ("back", "bias") else 0.25)).astype(np.float32) for n, s in _SHAPES.items()}
    classes = _classes(near, seen)
    mass = np.bincount(classes, seen + 0.1, minlength=CLASSES) + 0.1
    w["bias"] = np.log(mass / mass.sum()).astype(np.float32)
    return Attention(end, classes, slots, w, shares(classes, seen))


def fit(texts: list[np.ndarray], size: int, end: int, steps: int = 700, each: int = 128, seed: int = 11) -> Attention:
    """Train here on id sequences that close with ``end``."""
    rng = np.random.default_rng(seed)
    texts = texts or [np.array([end])]
    ids, sizes = np.concatenate(texts).astype(np.int32), np.array([len(t) for t in texts])
    seen = np.bincount(ids, minlength=size)
    model = start(sketch(ids, seen), seen, end, seed)
    trainer = Trainer(model)
    while trainer.t < steps:
        for run in trainer.runs(ids, sizes, rng, each):
            trainer.step(*run, 0.01 * (1 - 0.9 * min(1, trainer.t / steps)))
    return model


def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All weights in a row."""
    return np.concatenate([weights[n].ravel() for n in _SHAPES])


def unpacked(row: np.ndarray) -> dict[str, np.ndarray]:
    """The weights of ``packed``."""
    edges = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()])
    return {n: part.reshape(s).astype(np.float32, copy=False) for (n, s), part in zip(_SHAPES.items(), np.split(row, edges[:-1]), strict=True)}


def shares(classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of each id's share of its class, smoothed so that every id has one."""
    mass = counts + 0.1
    return np.log10(mass / np.bincount(classes, mass, minlength=CLASSES)[classes])

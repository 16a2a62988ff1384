"""Byte-level BPE of whole texts by the tokenizers library, many new pieces to a call.

A text is cut where the tokenizer's own pre-split always cuts: before a single space
or newline between two characters that are no white space, and behind such a
newline. Tokens never cross such a place, so the ids of a text are those of its
pieces in a row. Most pieces repeat: those of a block of texts are told apart by
64-bit hashes, each distinct one is looked up once, and the block's ids are one gather from
their table. Texts with other white space are cut one by one. Each worker keeps the ids
of the pieces it has met, up to a bound. New ones that begin and end with no white space go to the library joined by
newlines, whose own id parts them again; others go alone. Marks that end a piece behind a letter or digit are tokens apart:
they are asked for once, and the word before them for itself.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from presswire.llm.wordhash import distinct, words

KEPT = 600_000  # pieces a worker remembers by their text; the memory of a cache, it changes no result
HASHED = 3_000_000  # pieces it remembers by their hash
RECENT = 100_000  # of these, met since they were last merged
CALL = 256  # new pieces in one call
_MARKS = (",", ".", ";", ":", "!", "?")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
# White space other than single spaces and newlines between words.
_OTHER = re.compile(r"[^\S \n]|[ \n][ \n]|^[ \n]|[ \n]$")
_KIND = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)  # behind a space; first of a text; first of a later line
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x0A]] = True
_ODD = np.zeros(256, dtype=bool)  # other white space, and the first bytes of wider characters that may be some
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0xE1, 0xE3]] = True
_LETTER = np.zeros(256, dtype=bool)  # and digits
_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, dtype=bool)  # none that a special token or a contraction holds
_MARK[[*b"!#$%&*,.:;?@"]] = True
_WIDE_LEAD = np.zeros(256, dtype=bool)
_WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_NEXT = {0xC2: (0x85, 0xA0), 0xE2: (0x80, 0x81)}


def _plain(texts: list[str], raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Which texts have no white space but single spaces and newlines between words; ``raw`` parts them by newlines."""
    gap = _GAP[raw]
    odd = _ODD[raw]
    odd[:-1] |= gap[:-1] & gap[1:]
    for lead, follow in _NEXT.items():
        at = np.flatnonzero(raw[:-1] == lead)
        odd[at[np.isin(raw[at + 1], follow)]] = True
    plain = np.array([bool(t) for t in texts], dtype=bool)
    # The byte before a text counts for it, so that a gap at its begin does too.
    for k in np.unique(np.searchsorted(begins, np.flatnonzero(odd) + 1, side="right") - 1).tolist():
        for j in (k - 1, k):
            if 0 <= j < len(texts) and plain[j] and _OTHER.search(texts[j]):
                plain[j] = False
    return plain


def _parted(raw: np.ndarray, first: np.ndarray, end: np.ndarray, sep: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``raw`` in a row, ``sep`` before each; and where each begins, ``sep`` included."""
    n = end - first + len(sep)
    stop = np.cumsum(n)
    begins = stop - n
    flat = raw[np.repeat(first - len(sep) - begins, n) + np.arange(stop[-1] if len(stop) else 0)]
    for k, c in enumerate(sep):
        flat[begins + k] = c
    return flat, begins


def _tails(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many marks, at most 8, each run has behind its last letter or digit, and their bytes as a number; 0 if something else stands before them."""
    tail, code = np.zeros(len(first), np.int64), np.zeros(len(first), np.uint64)
    left = np.arange(len(first))
    for _ in range(8):
        last = end[left] - tail[left] - 1
        more = _MARK[raw[last]] & (last > first[left])
        left, last = left[more], last[more]
        code[left] = code[left] << np.uint64(8) | raw[last].astype(np.uint64)
        tail[left] += 1
    last = end - tail - 1
    # Of wider characters, those from U+00C0 to U+00FF are told apart.
    letter = _LETTER[raw[last]] | (last > first) & (raw[last - 1] == 0xC3) & (raw[last] != 0x97) & (raw[last] != 0xB7)
    return np.where(letter, tail, 0), np.where(letter, code, np.uint64(0))


def _spaces(raw: np.ndarray) -> np.ndarray:
    """Where white space stands that is neither a space nor one of ``\\t\\n\\v\\f\\r``."""
    low = np.flatnonzero((raw >= 0x1C) & (raw <= 0x1F))
    lead = np.flatnonzero(_WIDE_LEAD[raw])
    lead = lead[lead < len(raw) - 1]
    a, b = raw[lead], raw[lead + 1]
    c = raw[np.minimum(lead + 2, len(raw) - 1)]
    wide = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    wide |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
    return np.concatenate([low, lead[wide]])


def _merged(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
    return tuple(np.concatenate([x, y])[order] for x, y in zip(a, b, strict=True))


class PieceEncoder:
    """Ids of texts as little-endian bytes of ``kind``."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.first: dict[str, bytes] = {}  # pieces at the start of a line
        self.later: dict[str, bytes] = {}  # pieces after a space, kept without it
        newline = self.ids("\n")
        # Joining by newlines needs a newline of one id, as byte-level vocabularies have.
        self.newline = int(newline[0]) if len(newline) == 1 else None
        self.marks = {m: self.ids(m).astype(self.kind).tobytes() for m in _MARKS}
        self.runs: dict[bytes, np.ndarray] = {}  # ids of marks that end words
        self.between = newline.astype(self.kind).tobytes()
        self._forget()

    def _forget(self) -> None:
        """Hashed pieces in two levels, most and the recent ones: ascending keys, and where each one's ids stand in the table."""
        none = (np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32))
        self.levels = [none, none]
        self.table = np.empty(0, self.kind)

    def _held(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which pieces the table holds, where their ids begin, and how many there are."""
        found, starts, sizes = np.zeros(len(key), bool), np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        for keys, begins, n in self.levels:
            if len(keys):
                place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = np.flatnonzero(keys[place] == key)
                found[hit], starts[hit], sizes[hit] = True, begins[place[hit]], n[place[hit]]
        return found, starts, sizes

    def _keep(self, key: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Adds pieces, whose keys ascend."""
        starts = len(self.table) + np.cumsum(sizes) - sizes
        self.table = np.concatenate([self.table, ids])
        self.levels[1] = _merged(self.levels[1], (key, starts.astype(np.int32), sizes.astype(np.int32)))
        if len(self.levels[1][0]) > RECENT:
            self.levels = [_merged(*self.levels), tuple(x[:0] for x in self.levels[1])]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int64)

    def _learn(self, memo: dict[str, bytes], pieces: list[str], lead: str) -> None:
        new = set(pieces).difference(memo)
        if len(memo) + len(new) > KEPT:
            memo.clear()
            new = set(pieces)
        # A mark behind a letter is a token of its own: only the word before it is asked for.
        marked = [p for p in new if p[-1:] in _MARKS and p[-2:-1].isalpha()]
        new.difference_update(marked)
        new.update(p[:-1] for p in marked if p[:-1] not in memo)
        # Only pieces that begin and end with no white space keep apart from a newline beside them.
        plain = [] if self.newline is None else [p for p in new if "\n" not in p and p and not p[0].isspace() and not p[-1].isspace()]
        for k in range(0, len(plain), CALL):
            part = plain[k : k + CALL]
            got = self.ids("\n".join([lead + p for p in part]))
            cuts = np.flatnonzero(got == self.newline)
            if len(cuts) != len(part) - 1:
                raise ValueError("the vocabulary joins newlines with their neighbours")
            flat, wide = got.astype(self.kind).tobytes(), self.kind.itemsize
            edges = [-1, *cuts.tolist(), len(got)]
            memo.update((p, flat[(a + 1) * wide : b * wide]) for p, a, b in zip(part, edges, edges[1:], strict=False))
        for p in new.difference(plain):
            memo[p] = self.ids(lead + p).astype(self.kind).tobytes()
        for p in marked:
            memo[p] = memo[p[:-1]] + self.marks[p[-1]]

    def _known(self, memo: dict[str, bytes], pieces: list[str], lead: str) -> list[bytes]:
        try:
            return list(map(memo.__getitem__, pieces))
        except KeyError:
            self._learn(memo, pieces, lead)
            return list(map(memo.__getitem__, pieces))

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as it stands behind a space; words hold no white space."""
        return self._known(self.later, words, " ")

    def distinct_words(self, key: np.ndarray, at: np.ndarray, raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids in a row of distinct words, as they stand behind a space; ``key`` are their
        ascending hashes, ``at`` a place of each among all words of ``raw``."""
        starts, sizes = self._hashed(key, at, raw, first, end, np.zeros(len(first), np.int8))
        stop = np.cumsum(sizes)
        return sizes, self.table[np.repeat(starts - (stop - sizes), sizes) + np.arange(stop[-1] if len(stop) else 0)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        if not texts or self.newline is None:
            return self._one_by_one(texts)
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        begins = np.cumsum([1, *(len(p) + 1 for p in parts)])
        plain = _plain(texts, np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8), begins)
        together = iter(self._together([t for t, p in zip(parts, plain.tolist(), strict=True) if p]))
        alone = iter(self._one_by_one([t for t, p in zip(texts, plain.tolist(), strict=True) if not p]))
        return [next(together) if p else next(alone) for p in plain.tolist()]

    def _hashed(self, key: np.ndarray, at: np.ndarray, raw: np.ndarray, first: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of distinct pieces stand in the table, and how many there are; new pieces are learned.

        ``key`` ascends; ``at`` is a place of each piece.
        """
        if sum(len(x[0]) for x in self.levels) + len(key) > HASHED:
            self._forget()
        found, starts, sizes = self._held(key)
        new = np.flatnonzero(~found)
        if len(new):
            place = at[new]
            self._take(key[new], raw, first[place], end[place], kind[place])
            _, starts[new], sizes[new] = self._held(key[new])
        return starts, sizes

    def _take(self, key: np.ndarray, raw: np.ndarray, first: np.ndarray, end: np.ndarray, kind: np.ndarray) -> None:
        """Learns new pieces, whose keys ascend. Marks behind a letter or digit are cut off by the tokenizer too: only the word before them is asked for."""
        tail, code = _tails(raw, first, end)
        some = np.flatnonzero(tail)
        stem, unmet = np.empty(0, np.uint64), np.empty(0, bool)
        if len(some):
            stem = words(np.append(_parted(raw, first[some], (end - tail)[some], b"\n")[0], np.uint8(10)))[2] ^ _KIND[kind[some]]
            unmet = ~self._held(stem)[0]
        # Asked for: the pieces without marks, and the words before marks that are not held.
        lone = np.flatnonzero(tail == 0)
        asked, at, _ = distinct(np.concatenate([key[lone], stem[unmet]]))
        place = np.concatenate([lone, some[unmet]])[at]
        self._ask(asked, raw, first[place], (end - tail)[place], kind[place])
        if len(some):
            _, starts, sizes = self._held(stem)
            met, which = np.unique(code[some], return_inverse=True)
            marks = [self._marks(int(c).to_bytes(8, "little").rstrip(b"\0")) for c in met.tolist()]
            more = np.array([len(m) for m in marks])
            begin = len(self.table) + np.cumsum(more) - more  # the marks stand behind the table
            source = np.concatenate([self.table, *marks])
            n = np.stack([sizes, more[which]], axis=1).ravel()
            stop = np.cumsum(n)
            ids = source[np.repeat(np.stack([starts, begin[which]], axis=1).ravel() - (stop - n), n) + np.arange(stop[-1])]
            self._keep(key[some], ids, sizes + more[which])

    def _marks(self, marks: bytes) -> np.ndarray:
        if marks not in self.runs:
            self.runs[marks] = self.ids(marks.decode()).astype(self.kind)
        return self.runs[marks]

    def _ask(self, key: np.ndarray, raw: np.ndarray, first: np.ndarray, end: np.ndarray, kind: np.ndarray) -> None:
        """Learns pieces from the library, many to a call; those with white space of other kinds go by their text."""
        sizes, parts, place = np.zeros(len(key), np.int64), [], []
        for lead in (" ", ""):
            mine = np.flatnonzero((kind == 0) == (lead == " "))
            if not len(mine):
                continue
            sep = b"\n" + lead.encode()
            flat, begins = _parted(raw, first[mine], end[mine], sep)
            other = np.full(len(mine), self.newline is None)
            other[np.searchsorted(begins, _spaces(flat), side="right") - 1] = True
            if other.any():
                odd = mine[other]
                texts = [str(memoryview(raw)[a:b], "utf-8", "surrogatepass") for a, b in zip(first[odd].tolist(), end[odd].tolist(), strict=True)]
                got = [self.between * (k == 2) + c for k, c in zip(kind[odd].tolist(), self._known({}, texts, lead), strict=True)]
                sizes[odd] = [len(c) // self.kind.itemsize for c in got]
                parts.append(np.frombuffer(b"".join(got), dtype=self.kind))
                place.append(odd)
                mine = mine[~other]
                flat, begins = _parted(raw, first[mine], end[mine], sep)
            edges = np.append(begins, len(flat)).tolist()
            line = kind[mine] == 2  # the newline before the first word of a later line is its own
            for k in range(0, len(mine), CALL):
                part = mine[k : k + CALL]
                got = self.ids(str(memoryview(flat)[edges[k] : edges[k + len(part)]], "utf-8", "surrogatepass"))
                cuts = np.flatnonzero(got == self.newline)
                if len(cuts) != len(part):
                    raise ValueError("the vocabulary joins newlines with their neighbours")
                own = line[k : k + CALL]
                keep = np.ones(len(got), bool)
                keep[cuts[~own]] = False
                sizes[part] = np.diff(cuts, append=len(got)) - ~own
                parts.append(got[keep].astype(self.kind))
                place.append(part)
        if len(key):
            # The parts came in another order than the keys.
            came = np.concatenate(place)
            n = sizes[came]
            starts = np.empty(len(key), np.int64)
            starts[came] = np.cumsum(n) - n
            stop = np.cumsum(sizes)
            self._keep(key, np.concatenate(parts)[np.repeat(starts - (stop - sizes), sizes) + np.arange(stop[-1])], sizes)

    def _together(self, parts: list[bytes]) -> list[bytes]:
        """Ids of texts whose words are parted by single spaces and newlines."""
        if not parts:
            return []
        raw = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", dtype=np.uint8)
        first, end, key = words(raw)
        begins = np.cumsum([1, *(len(p) + 1 for p in parts)])
        head = np.searchsorted(first, begins[:-1])  # a text begins with a word
        kind = (raw[first - 1] == 10).astype(np.int8) * 2
        kind[head] = 1
        key ^= _KIND[kind]
        known, at, which = distinct(key)
        starts, sizes = self._hashed(known, at, raw, first, end, kind)
        n = sizes[which]
        stop = np.cumsum(n)
        place = np.repeat(starts[which] - (stop - n), n)
        place += np.arange(len(place))
        flat = self.table[place]
        edges = np.append(np.append(0, stop)[head], len(flat)).tolist()
        return [flat[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        lines = [_SAFE.split(t) for t in texts]
        heads = self._known(self.first, [x[0] for x in lines], "")
        tails = iter(self._known(self.later, [p for x in lines for p in x[1:]], " "))
        return [b"".join([head, *(next(tails) for _ in x[1:])]) for head, x in zip(heads, lines, strict=True)]


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a vocabulary file."""
    return PieceEncoder(path)

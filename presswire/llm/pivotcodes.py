"""Vector codes by product codebooks, assignments pruned by distances to fixed pivots.

Every vector is cut into equal parts, and each part position has a codebook of few
entries, refined by rounds of assigning and averaging. The distances of every part to
a few pivots are computed once and stored beside it. In a round the distances of
the entries to the pivots are new; by the triangle inequality the difference of the two
distances is at least as small as the true one. Entries are tried in the order of that
bound, and those whose bound exceeds the best distance so far are never evaluated.
What is evaluated is whole numbers, so pruning changes no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswire.llm.common import saved, table
from presswire.operators.lookup import keyed_join

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
PIVOTS = 4
_LIMIT = 1 << 26  # scaled components reach less than this
_SLACK = 1e-6  # pivot distances are kept in single precision


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, v)`` of vectors without null or non-finite components; v is scaled and floored."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("embedding").isNotNull()).filter(sound)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return rows.select("vec_id", "label", scaled.alias("v"))


def flat_matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Whole-number vectors as rows of ``width``; shorter ones are filled up with zeros."""
    at = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()[at[0] : at[-1]]
    if len(flat) and max(int(flat.max()), -int(flat.min())) >= _LIMIT:
        raise ValueError(f"a scaled component reaches {_LIMIT}; use a smaller scale")
    out = np.zeros((len(at) - 1, width), dtype=np.int64)
    out[np.arange(width) < np.diff(at)[:, None]] = flat
    return out


def spread_pivots(book: np.ndarray, n: int) -> np.ndarray:
    """Entries far from each other: each next one is the farthest from those taken."""
    wide = book.astype(np.float64)
    taken = [0]
    near = ((wide - wide[0]) ** 2).sum(axis=1)
    while len(taken) < min(n, len(book)):
        taken.append(int(near.argmax()))
        near = np.minimum(near, ((wide - wide[taken[-1]]) ** 2).sum(axis=1))
    return book[taken]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of ``a`` to rows of ``b``."""
    return np.sqrt(((a[:, None, :] - b[None, :, :]).astype(np.float64) ** 2).sum(axis=2))


def nearest(x: np.ndarray, far: np.ndarray, book: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each row of ``x``, its squared distance, and the number of distances evaluated.

    ``far`` holds the rows' distances to the pivots, ``gaps`` those of the pivots to the
    entries. Of equally near entries the first wins.
    """
    low = np.abs(far[:, :, None] - gaps[None]).max(axis=1)
    low = np.maximum(low - _SLACK * (1 + far.max(axis=1, initial=0.0)[:, None] + gaps.max(initial=0.0)), 0.0)
    order = np.argsort(low, axis=1, kind="stable")
    rows = np.arange(len(x))
    best = np.full(len(x), np.iinfo(np.int64).max)
    code = np.full(len(x), len(book))
    evaluated = 0
    for turn in range(len(book)):
        entry = order[rows, turn]
        open_ = low[rows, entry] ** 2 <= best[rows].astype(np.float64)
        rows, entry = rows[open_], entry[open_]  # later entries of the others have greater bounds
        if not len(rows):
            break
        away = x[rows] - book[entry]
        found = np.einsum("nw,nw->n", away, away)
        evaluated += len(rows)
        better = (found < best[rows]) | ((found == best[rows]) & (entry < code[rows]))
        best[rows[better]], code[rows[better]] = found[better], entry[better]
    return code, best, evaluated


class Books:
    """The codebooks of all parts, with the fixed pivots."""

    def __init__(self, entries: np.ndarray, pivots: list[np.ndarray]) -> None:
        self.entries = entries  # (parts, entries, width)
        self.pivots = pivots
        self.gaps = [distances(p, e) for p, e in zip(pivots, entries, strict=True)]

    @classmethod
    def of_vectors(cls, vectors: np.ndarray, parts: int, n_pivots: int) -> Books:
        entries = vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2)
        return cls(entries, [spread_pivots(e, n_pivots) for e in entries])

    def moved(self, entries: np.ndarray) -> Books:
        return Books(entries, self.pivots)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def with_pivots(rows: DataFrame, books: Books, width: int) -> DataFrame:
    """``rows`` with their vectors packed and the distances of each part to its pivots, computed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = flat_matrix(batch.column("v"), width)
            parts = x.reshape(len(x), len(books.pivots), -1)
            far = [distances(parts[:, j], p).astype("<f4") for j, p in enumerate(books.pivots)]
            packed = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (x.astype("<i4"), np.concatenate(far, axis=1))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *packed], ["vec_id", "label", "x", "far"])

    return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, x binary, far binary")


def _assigned(batch: pa.RecordBatch, books: Books) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts (rows, parts, width), codes and squared distances (rows, parts) of a batch."""
    parts = len(books.pivots)
    x = np.frombuffer(b"".join(batch.column("x").to_pylist()), "<i4").astype(np.int64).reshape(len(batch), parts, books.entries.shape[2])
    far = np.frombuffer(b"".join(batch.column("far").to_pylist()), "<f4").astype(np.float64).reshape(len(batch), -1)
    codes, errors, at = np.empty((len(batch), parts), np.int64), np.empty((len(batch), parts), np.int64), 0
    for j, p in enumerate(books.pivots):
        codes[:, j], errors[:, j], _ = nearest(x[:, j], far[:, at : at + len(p)], books.entries[j], books.gaps[j])
        at += len(p)
    return x, codes, errors


def _averaged(stored: DataFrame, books: Books) -> Books:
    """Every entry moved to the floored mean of its parts; unused entries stay."""
    parts, k, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(parts * k, np.int64), np.zeros((parts * k, width), np.int64)
        for batch in batches:
            if len(batch):
                x, codes, _ = _assigned(batch, books)
                slot = (codes + np.arange(parts) * k).ravel()
                n += np.bincount(slot, minlength=parts * k)
                for i in range(width):  # exact: a batch's sums are far below 2**53
                    sums[:, i] += np.bincount(slot, x[:, :, i].ravel(), parts * k).astype(np.int64)
        used = np.flatnonzero(n)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(sums[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), lists], ["slot", "n", "sums"])

    partial = stored.select("x", "far").mapInArrow(run, "slot int, n long, sums array<long>")
    wide = partial.select("slot", "n", F.posexplode_outer("sums").alias("place", "sum"))
    totals = wide.groupBy("slot", "place").agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    entries = books.entries.reshape(parts * k, width).copy()
    for slot, place, n, total in totals.collect():  # as many rows as the codebooks have components
        if place is not None:
            entries[slot, place] = int(total) // n
    return books.moved(entries.reshape(parts, k, width))


def vector_codes(
    vectors: DataFrame,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, Books | None]:
    """``(vec_id, label, code, error)`` of all usable vectors, and the codebooks.

    Vectors that are null or hold null or non-finite components are left out. The
    first codebooks are the parts of the vectors with the ``entries`` smallest
    vec_ids, null ids last, equal ids by their components. Rows that share a vec_id are
    rows of their own; null labels and ids pass through. Vectors shorter than the longest
    are filled up with zeros, as is the longest to a multiple of ``parts``. No
    usable vector gives no rows and no codebooks. Other columns are ignored. Scaled
    components of 2**26 or more are refused.
    """
    rows = usable(vectors, scale)
    n, longest = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    ids = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}"
    if not n:
        return vectors.sparkSession.createDataFrame([], f"{ids}, code string, error long"), None
    width = max(-(-longest // parts), 1) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()  # one codebook's size
    start = np.zeros((len(first), width), dtype=np.int64)
    for k, r in enumerate(first):
        start[k, : len(r["v"])] = r["v"]
    books = Books.of_vectors(start, parts, pivots)
    stored = saved(with_pivots(rows, books, width), "parts")
    for _ in range(rounds):
        books = _averaged(stored, books)
    final = books

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                _, codes, errors = _assigned(batch, final)
                names = pa.array([bytes(c).hex() for c in codes.astype(np.uint8)] if entries <= 256 else ["".join(f"{v:04x}" for v in c) for c in codes.tolist()])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), names, pa.array(errors.sum(axis=1))], ["vec_id", "label", "code", "error"])

    return saved(stored.mapInArrow(run, f"{ids}, code string, error long"), "codes"), books


def op12_pivotcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all ``embeddings``, with the errors summed by label and the digest of the codebooks."""
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    # A label of its own stands for null, so that null labels meet.
    keyed = codes.withColumn("named", F.col("label").isNotNull()).withColumn("label", F.coalesce("label", F.lit(0)))
    totals = keyed.groupBy("named", "label").agg(F.sum("error").alias("label_error"))
    out = keyed_join(keyed, totals, ["named", "label"], "left")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))


def _oracle() -> str:
    """The rounds one after the other, each a common table."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, e) AS r, vec_id, label, e FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
)""",
        f"""x AS MATERIALIZED (
  SELECT r, p, list_slice(e, p * w + 1, p * w + w) AS x
  FROM (SELECT r, e, len(e) // {PARTS} AS w, unnest(range({PARTS})) AS p FROM v)
)""",
        f"b0 AS MATERIALIZED (SELECT p, r - 1 AS k, x AS b FROM x WHERE r <= {ENTRIES})",
    ]

    def assign(n: int) -> str:
        away = "list_sum(list_transform(list_zip(x, b), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        return f"""a{n} AS MATERIALIZED (
  SELECT r, p, x, (min({{'d': d, 'k': k}})).k AS k, min(d) AS d
  FROM (SELECT r, x.p, x, k, {away} AS d FROM x JOIN b{n} USING (p)) GROUP BY r, p, x
)"""

    for n in range(ROUNDS):
        steps.append(assign(n))
        steps.append(f"""b{n + 1} AS MATERIALIZED (
  SELECT p, k, coalesce(m.b, o.b) AS b FROM b{n} o LEFT JOIN (
    SELECT p, k, list(m ORDER BY i) AS b FROM (
      SELECT p, k, i, floor(sum(y)::DOUBLE / count(*))::BIGINT AS m
      FROM (SELECT p, k, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{n}) GROUP BY p, k, i
    ) GROUP BY p, k
  ) m USING (p, k)
)""")
    steps.append(assign(ROUNDS))
    steps.append(f"""c AS (
  SELECT vec_id, label, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a{ROUNDS} JOIN v USING (r) GROUP BY r, vec_id, label
)""")
    steps.append(f"s AS (SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{ROUNDS})")
    return "WITH " + ", ".join(steps) + " SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM c, s"


ORACLE = _oracle()

"""Vector code compression: product codes from exact integer k-means over Hilbert-sorted blocks.

Every vector is cut into equal parts, each coded by the nearest entry of its position's codebook.
A task gathers vectors into chunks, orders each position's parts along a Hilbert curve and cuts
them into flat blocks that carry a min/max box and sums. In a round, the distances from a box to
the entries leave a shortlist a block: an entry farther from all of the box than another is from
any of it can be nearest to no part inside. A block with one entry left adds its sums without
looking at a part; the others are settled by an integer kernel over their parts and shortlist.

Chunks hold any vectors, so nothing is dealt by key and copies of one vector are spread like all
rows. A round sends a count and sums for each entry and task; no vector is moved after the chunks
are written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import table, written
from starmart.operators.joins import fits_broadcast

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
CHUNK = 32_768
BLOCK = 64
# Components below this keep every squared distance of a vector of 64 within 64 bits.
LARGEST = 1 << 27

CHUNK_SCHEMA = "n int, width int, label array<int>, vec_id array<long>, order binary, x binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each cell (n, d) of unsigned ``bits``-bit coordinates.

    The well-known transform of axes to the transposed index, for all cells at once; ``d * bits``
    is 64 at most.
    """
    x = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    d = len(x)
    for b in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(d):
            inverted = (x[i] & q) != 0
            swap = np.where(inverted, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1), np.uint64((1 << b) - 1), np.uint64(0))
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << np.uint64(1)) | (((x[i] ^ turn) >> np.uint64(b)) & np.uint64(1))
    return key


def curve_order(points: np.ndarray) -> np.ndarray:
    """The order of integer points (n, d) along the curve; longer points go by 64 components."""
    points = points[:, :64]
    bits = max(1, min(16, 64 // points.shape[1]))
    low = points.min(axis=0)
    span = np.maximum(points.max(axis=0) - low, 1)
    cells = (points - low) * ((1 << bits) - 1) // span
    return np.argsort(hilbert_keys(cells, bits), kind="stable")


class Blocks:
    """One position's parts of a chunk in curve order, cut into blocks with box, sums, count."""

    def __init__(self, points: np.ndarray, block: int = BLOCK) -> None:
        self.points = points
        starts = np.arange(0, len(points), block)
        self.of = np.arange(len(points)) // block
        self.low = np.minimum.reduceat(points, starts)
        self.high = np.maximum.reduceat(points, starts)
        self.sums = np.add.reduceat(points, starts)
        self.counts = np.diff(np.append(starts, len(points)))

    def shortlists(self, book: np.ndarray) -> np.ndarray:
        """(blocks, entries): whether an entry can be the nearest of any part in the block's box."""
        below = self.low[:, None, :] - book[None]
        above = book[None] - self.high[:, None, :]
        nearest = np.square(np.maximum(np.maximum(below, above), 0)).sum(axis=2)
        farthest = np.square(np.maximum(np.abs(below), np.abs(above))).sum(axis=2)
        return nearest <= farthest.min(axis=1)[:, None]

    def assigned(self, book: np.ndarray, open_only: bool = False) -> tuple[np.ndarray, ...]:
        """(place, entry, distance) of the parts: nearest entry, the lower one of a tie.

        ``open_only`` leaves out the parts of blocks with a single entry, whose sums suffice.
        """
        lists = self.shortlists(book)
        settled = lists.sum(axis=1) == 1
        at = np.flatnonzero(~settled[self.of]) if open_only else np.arange(len(self.points))
        best = np.full(len(at), np.iinfo(np.int64).max)
        entry = np.zeros(len(at), np.int64)
        for e in range(len(book)):
            tried = np.flatnonzero(lists[self.of[at], e])
            distance = np.square(self.points[at[tried]] - book[e]).sum(axis=1)
            nearer = distance < best[tried]
            best[tried[nearer]] = distance[nearer]
            entry[tried[nearer]] = e
        return at, entry, best

    def moments(self, book: np.ndarray) -> np.ndarray:
        """(entries, 1 + width): count and componentwise sum of each entry's parts."""
        out = np.zeros((len(book), 1 + self.points.shape[1]), np.int64)
        lists = self.shortlists(book)
        single = lists.sum(axis=1) == 1
        only = lists.argmax(axis=1)[single]
        np.add.at(out, only, np.column_stack([self.counts, self.sums])[single])
        at, entry, _ = self.assigned(book, open_only=True)
        order = np.argsort(entry, kind="stable")
        used, starts = np.unique(entry[order], return_index=True)
        if len(used):
            parts = self.points[at[order]]
            out[used, 0] += np.diff(np.append(starts, len(order)))
            out[used, 1:] += np.add.reduceat(parts, starts)
        return out


def integers(vectors: np.ndarray) -> np.ndarray:
    x = np.floor(SCALE * vectors.astype(np.float64))
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ValueError(f"components of {LARGEST / SCALE:g} and more are beyond exact 64-bit distances")
    return x.astype(np.int64)


def _chunk(ids: list, labels: list, vectors: np.ndarray, parts: int) -> pa.RecordBatch:
    n, d = vectors.shape
    cut = integers(vectors).reshape(n, parts, d // parts).transpose(1, 0, 2)
    order = np.array([curve_order(points) for points in cut])
    points = np.array([points[o] for points, o in zip(cut, order, strict=True)])
    fits = np.abs(points).max() < (1 << 15)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([n], pa.int32()),
            pa.array([d // parts], pa.int32()),
            pa.array([labels], pa.list_(pa.int32())),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([order.astype("<i4").tobytes()], pa.binary()),
            pa.array([points.astype("<i2" if fits else "<i4").tobytes()], pa.binary()),
        ],
        ["n", "width", "label", "vec_id", "order", "x"],
    )


def chunks(kept: DataFrame, dim: int, parts: int = PARTS, size: int = CHUNK) -> DataFrame:
    """The kept vectors as a table of chunks: ids, labels, curve orders and sorted parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        labels: list = []
        vectors = np.empty((0, dim))
        for batch in batches:
            ids += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            vectors = np.vstack([vectors, values.reshape(-1, dim)])
            while len(ids) >= size:
                yield _chunk(ids[:size], labels[:size], vectors[:size], parts)
                ids, labels, vectors = ids[size:], labels[size:], vectors[size:]
        if ids:
            yield _chunk(ids, labels, vectors, parts)

    rows = kept.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "vector")
    return rows.mapInArrow(run, CHUNK_SCHEMA)


def _blocks(batch: pa.RecordBatch, row: int, parts: int) -> list[Blocks]:
    n, width = batch.column("n")[row].as_py(), batch.column("width")[row].as_py()
    raw = batch.column("x")[row].as_py()
    kind = "<i2" if len(raw) == 2 * n * width * parts else "<i4"
    points = np.frombuffer(raw, kind).reshape(parts, n, width).astype(np.int64)
    return [Blocks(p) for p in points]


def moments(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """(parts, entries, 1 + width) over all vectors: how many parts go to an entry, and their sum."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, 1 + width), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, blocks in enumerate(_blocks(batch, row, parts)):
                    total[p] += blocks.moments(books[p])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["at", "value"])

    sums = stored.select("n", "width", "x").mapInArrow(run, "at int, value long")
    out = np.zeros(books[:, :, 0].size * (1 + width), np.int64)
    # One row for each number of the codebooks' moments.
    for r in sums.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return out.reshape(parts, entries, 1 + width)


def trained(stored: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after the rounds; an entry without parts stays as it is."""
    for _ in range(rounds):
        m = moments(stored, books)
        used = m[:, :, 0] > 0
        means = m[:, :, 1:] // np.maximum(m[:, :, :1], 1)
        books = np.where(used[:, :, None], means, books)
    return books


def coded(stored: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every vector, in one pass over the chunks."""
    parts = len(books)
    digits = np.array([f"{e:02x}" for e in range(books.shape[1])], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n = batch.column("n")[row].as_py()
                order = np.frombuffer(batch.column("order")[row].as_py(), "<i4").reshape(parts, n)
                code = np.full(n, "", dtype=object)
                error = np.zeros(n, np.int64)
                for p, blocks in enumerate(_blocks(batch, row, parts)):
                    at, entry, distance = blocks.assigned(books[p])
                    own = np.empty(n, np.int64)
                    own[order[p][at]] = entry
                    code = code + digits[own]
                    error[order[p][at]] += distance
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id")[row].values,
                        batch.column("label")[row].values,
                        pa.array(code, pa.string()),
                        pa.array(error),
                    ],
                    ["vec_id", "label", "code", "error"],
                )

    return stored.mapInArrow(run, "vec_id long, label int, code string, error long")


def kept_vectors(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """vec_id, label, vector of the rows that can be coded, copies included.

    Out go null vectors, those with null or non-finite components, and those that cannot be cut
    into ``parts`` equal parts, empty ones among them.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0) & ~bad
    return vectors.where(F.coalesce(good, F.lit(False))).select("vec_id", "label", x.alias("vector"))


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all vectors that can be coded, and the codebooks (parts, entries, width).

    ``vectors`` has vec_id, embedding, label; other columns are not read. The codebooks start from
    the smallest vec_ids, nulls last, and of equal ids the least vectors. Vectors of another length
    than the first one's are left out. With fewer vectors than entries there are as many entries
    as vectors. Repeated rows are coded each. Without any vector the result is empty and there are
    no codebooks. Components of 2**15 and more stop the job: their distances exceed 64 bits.
    """
    kept = kept_vectors(vectors, parts)
    by = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    first = kept.orderBy(*by).limit(1).collect()
    dim = len(first[0]["vector"]) if first else parts
    kept = kept.where(F.size("vector") == dim)
    # As many rows as a codebook has entries.
    start = kept.orderBy(*by).limit(entries).collect()
    if not start:
        empty = "vec_id long, label int, code string, error long"
        return vectors.sparkSession.createDataFrame([], empty), None
    books = integers(np.array([r["vector"] for r in start])).reshape(len(start), parts, dim // parts)
    stored = written(chunks(kept, dim, parts), "chunks")
    books = trained(stored, books.transpose(1, 0, 2).copy(), rounds)
    return coded(stored, books), books


def books_digest(books: np.ndarray | None) -> str:
    """SHA-256 of the entries' components by part, entry and position, as decimal text."""
    numbers = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds the errors' sum over each label; vectors without a label are one group."""
    totals = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    totals = written(totals, "label_errors")
    if fits_broadcast(totals):
        totals = F.broadcast(totals)
    return codes.join(totals, F.col("label").eqNullSafe(F.col("__label")), "left")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(written(codes, "codes")).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    rounds = []
    for k in range(ROUNDS + 1):
        rounds.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT x.r, x.p, b.e, sum((x.v - b.c) * (x.v - b.c)) AS d
    FROM x JOIN b{k} b ON b.p = x.p AND b.j = x.j GROUP BY x.r, x.p, b.e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if k < ROUNDS:
            rounds.append(f"""
b{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, b.j, coalesce(m.c, b.c) AS c
  FROM b{k} b LEFT JOIN (
    SELECT a.p, a.e, x.j, CAST((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS c
    FROM a{k} a JOIN x ON x.r = a.r AND x.p = a.p GROUP BY a.p, a.e, x.j) m
  ON m.p = b.p AND m.e = b.e AND m.j = b.j)""")
    return f"""
WITH good AS (
  SELECT vec_id, label, embedding, len(embedding) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {PARTS} = 0
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
kept AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r FROM good
  WHERE n = (SELECT n FROM good ORDER BY vec_id NULLS LAST, embedding LIMIT 1)),
x AS MATERIALIZED (
  SELECT r, i // (n // {PARTS}) AS p, i % (n // {PARTS}) AS j,
    CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT r, n, embedding, unnest(range(n)) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, v AS c FROM x WHERE r <= {ENTRIES}),{",".join(rounds)},
coded AS (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY r)
SELECT k.vec_id, c.code, c.error,
  CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded c JOIN kept k ON k.r = c.r
"""


ORACLE = _oracle()

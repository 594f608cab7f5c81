"""Ranked lexical search: best-first document intervals under sparse-table bounds.

Documents are indexed in segments of whole documents. A segment holds, for each term of the query
set, a posting list by document; a list's impacts get a sparse table that gives the place of the
largest impact between any two postings in constant time. A query starts from the interval of the
whole segment. The sum of its terms' range maxima bounds every score inside an interval; the
intervals of the highest bounds are split at the document that holds the largest impact, which is
scored, and intervals bounded below the tenth best score are dropped unread. Short intervals are
scored in full. What a task has found in one segment bounds the next.

Scores are exact integers. Queries are taken in blocks of bounded size, each against all rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.llm.store import table, written

TOP = 10
# A block of queries: what goes to every task.
BLOCK_ITEMS = 2_000
BLOCK_BYTES = 4_000_000
# A segment ends with the document that fills either.
SEGMENT_DOCS = 8_192
SEGMENT_BYTES = 32_000_000
# Intervals taken from the queue together, and the length from which one is scored in full.
BATCH = 256
LEAF = 32
SALTS = 64

_NO_ID = np.iinfo(np.int64).max

# A term byte is an ASCII letter or digit or part of a longer character; A-Z are lower-cased.
_TERM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM).split()


@dataclass(frozen=True)
class Queries:
    """A block of queries over numbered terms."""

    items: list[tuple[int | None, dict[int, int]]]  # id, and times by term
    terms: dict[bytes, int]

    @staticmethod
    def of(rows: list[tuple[int | None, str | None]]) -> Queries:
        terms: dict[bytes, int] = {}
        items = []
        for item_id, text in rows:
            times = Counter(terms.setdefault(w, len(terms)) for w in terms_of(text))
            items.append((item_id, dict(times)))
        return Queries(items, terms)


INDEX_SCHEMA = "doc_id binary, has_id binary, n binary, term binary, df binary, slot binary, tf binary"


class _Segment:
    """Documents gathered for a segment of the index."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.found: list[dict[int, int]] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: str | None, known: dict[bytes, int]) -> None:
        words = terms_of(text)
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.found.append(Counter([known[w] for w in words if w in known]))
        self.bytes += len(text or "")

    def full(self) -> bool:
        return len(self.ids) >= SEGMENT_DOCS or self.bytes >= SEGMENT_BYTES

    def record(self) -> pa.RecordBatch:
        """The segment, documents by id (nulls last), postings by term and document."""
        ids = np.array([_NO_ID if i is None else i for i in self.ids], np.int64)
        has = np.array([i is not None for i in self.ids])
        order = np.lexsort((ids, ~has))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        held = np.array([len(f) for f in self.found])
        term = np.fromiter((t for f in self.found for t in f), np.int64, held.sum())
        tf = np.fromiter((c for f in self.found for c in f.values()), np.int64, held.sum())
        slot = np.repeat(place, held)
        by = np.lexsort((slot, term))
        used, starts = np.unique(term[by], return_index=True)
        df = np.diff(np.append(starts, len(by)))
        columns = [
            ids[order].astype("<i8"), has[order].astype("u1"), np.array(self.sizes, "<i8")[order],
            used.astype("<i4"), df.astype("<i4"), slot[by].astype("<i4"), tf[by].astype("<i4"),
        ]
        names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names)


def index(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """Segments over every row of ``docs``: the posting lists of the numbered terms.

    A null text has no terms; a repeated doc_id is a document for each of its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = _Segment()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                segment.add(doc_id.as_py(), text.as_py(), known)
                if segment.full():
                    yield segment.record()
                    segment = _Segment()
        if segment.ids:
            yield segment.record()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, INDEX_SCHEMA)


def _read(batch: pa.RecordBatch, row: int, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_py(), kind)


@dataclass(frozen=True)
class Totals:
    """Of the whole collection: documents with a term, all terms, documents by term."""

    docs: int
    length: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array(
            [math.floor(1000 * math.log((2 * self.docs + 2) / (2 * int(df) + 1))) for df in self.df], np.int64)

    def lengths(self, sizes: np.ndarray) -> np.ndarray:
        return 25 + (75 * sizes * self.docs) // max(self.length, 1)


def totals(segments: DataFrame, terms: int) -> Totals:
    """Summed over all segments; two numbers and one for each term come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(terms + 2, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = _read(batch, row, "n", "<i8")
                sums[terms:] += np.count_nonzero(sizes), sizes.sum()
                sums[_read(batch, row, "term", "<i4")] += _read(batch, row, "df", "<i4")
        at = np.flatnonzero(sums).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["at", "value"])

    rows = segments.select("n", "term", "df").mapInArrow(run, "at int, value long")
    out = np.zeros(terms + 2, np.int64)
    for r in rows.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"]] = r["value"]
    return Totals(int(out[terms]), int(out[terms + 1]), out[:terms])


class Postings:
    """One term's postings in a segment: documents, impacts, and a sparse table of range maxima."""

    def __init__(self, slots: np.ndarray, impacts: np.ndarray) -> None:
        self.slots, self.impacts = slots, impacts
        # Level k has at i the place of the largest of the 2**k impacts from i on; the levels stand
        # one after the other.
        level = np.arange(len(slots), dtype=np.int32)
        levels = [level]
        step = 1
        while 2 * step <= len(slots):
            left, right = level[:-step], level[step:]
            level = np.where(impacts[right] > impacts[left], right, left)
            levels.append(level)
            step *= 2
        self.levels = np.concatenate(levels)
        self.starts = np.cumsum([0, *[len(x) for x in levels[:-1]]])

    def largest(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(impact, document) of the largest impact between document slots ``first`` and ``last``
        (exclusive), for many intervals at once; 0 and -1 where there is no posting."""
        a, b = np.searchsorted(self.slots, first), np.searchsorted(self.slots, last)
        impact = np.zeros(len(a), np.int64)
        doc = np.full(len(a), -1, np.int64)
        some = np.flatnonzero(a < b)
        if len(some):
            a, b = a[some], b[some]
            level = np.frexp(b - a)[1] - 1
            start = self.starts[level]
            x, y = self.levels[start + a], self.levels[start + b - (1 << level)]
            best = np.where(self.impacts[y] > self.impacts[x], y, x)
            impact[some], doc[some] = self.impacts[best], self.slots[best]
        return impact, doc

    def at(self, docs: np.ndarray) -> np.ndarray:
        """The impact in each document, 0 where the term is not."""
        place = np.minimum(np.searchsorted(self.slots, docs), len(self.slots) - 1)
        return np.where(self.slots[place] == docs, self.impacts[place], 0)


class Best:
    """The highest scores of a query so far: score descending, then doc_id ascending."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.found: list[tuple[int, bool, int]] = []  # -score, without id, id

    def add(self, scores: np.ndarray, ids: np.ndarray, has: np.ndarray) -> None:
        ahead = (scores >= max(1, self.bar())).nonzero()[0]
        if len(ahead):
            self.found += zip((-scores[ahead]).tolist(), (~has[ahead]).tolist(), ids[ahead].tolist(), strict=True)
            self.found = heapq.nsmallest(self.top, self.found)

    def bar(self) -> int:
        """The score of the last place, 0 while places are free."""
        return -self.found[-1][0] if len(self.found) == self.top else 0

    def open(self, bound: int, first_id: int, has_id: bool) -> bool:
        """Whether an interval under this bound, ``first_id`` its least id, may hold a better one."""
        if bound <= 0:
            return False
        return len(self.found) < self.top or (-bound, not has_id, first_id) < self.found[-1]


class Segment:
    """A segment read back, with impacts under the collection's totals."""

    def __init__(self, batch: pa.RecordBatch, row: int, sums: Totals, weights: np.ndarray) -> None:
        self.ids, self.has = _read(batch, row, "doc_id", "<i8"), _read(batch, row, "has_id", "u1") > 0
        term, df = _read(batch, row, "term", "<i4"), _read(batch, row, "df", "<i4")
        self.slots = _read(batch, row, "slot", "<i4").astype(np.int64)
        tf = _read(batch, row, "tf", "<i4").astype(np.int64)
        m = sums.lengths(_read(batch, row, "n", "<i8"))
        saturated = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.slots])
        self.impacts = saturated * np.repeat(weights[term], df)
        ends = np.cumsum(df)
        self.range = dict(zip(term.tolist(), zip((ends - df).tolist(), ends.tolist(), strict=True), strict=True))
        self.lists: dict[int, Postings] = {}

    def postings(self, term: int) -> Postings | None:
        if term not in self.lists and term in self.range:
            a, b = self.range[term]
            self.lists[term] = Postings(self.slots[a:b], self.impacts[a:b])
        return self.lists.get(term)

    def search(self, query: dict[int, int], best: Best) -> int:
        """Adds the segment's best documents; returns how many were scored."""
        lists = [(p, times) for t, times in query.items() if (p := self.postings(t)) is not None]
        if not lists:
            return 0
        scored = 0

        def score(docs: np.ndarray) -> None:
            nonlocal scored
            scored += len(docs)
            total = sum(times * p.at(docs) for p, times in lists)
            best.add(total, self.ids[docs], self.has[docs])

        def bounded(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int, int, int]]:
            """(-bound, first, last, split) of the intervals that may still hold a better document."""
            bound = np.zeros(len(first), np.int64)
            most, split = np.full(len(first), -1, np.int64), np.full(len(first), -1, np.int64)
            for p, times in lists:
                impact, doc = p.largest(first, last)
                impact = impact * times
                bound += impact
                ahead = impact > most
                most[ahead], split[ahead] = impact[ahead], doc[ahead]
            rows = zip((-bound).tolist(), first.tolist(), last.tolist(), split.tolist(), strict=True)
            return [r for r in rows if best.open(-r[0], int(self.ids[r[1]]), bool(self.has[r[1]]))]

        queue = bounded(np.array([0]), np.array([len(self.ids)]))
        while queue:
            taken = []
            while queue and len(taken) < BATCH:
                bound, first, last, split = heapq.heappop(queue)
                if best.open(-bound, int(self.ids[first]), bool(self.has[first])):
                    taken.append((first, last, split))
                elif -bound < best.bar():
                    queue.clear()  # all others are bounded no higher
            leaves = [np.arange(a, b) for a, b, _ in taken if b - a <= LEAF]
            cut = [(a, b, d) for a, b, d in taken if b - a > LEAF]
            leaves.append(np.array([d for _, _, d in cut], np.int64))
            score(np.concatenate(leaves))
            halves = [h for a, b, d in cut for h in ((a, d), (d + 1, b)) if h[0] < h[1]]
            if halves:
                ends = np.array(halves)
                for row in bounded(ends[:, 0], ends[:, 1]):
                    heapq.heappush(queue, row)
        return scored


HIT_SCHEMA = "item int, doc_id long, score long, salt int"


def hits(segments: DataFrame, queries: Queries, sums: Totals, top: int) -> DataFrame:
    """The best documents of each query in each task's segments."""
    weights = sums.weights()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in queries.items]
        salt = 0
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment(batch, row, sums, weights)
                salt ^= int(segment.ids[0]) if len(segment.ids) else 0
                for (_, query), found in zip(queries.items, best, strict=True):
                    segment.search(query, found)
        rows = [(i, None if no_id else d, -s, salt % SALTS) for i, b in enumerate(best) for s, no_id, d in b.found]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item", "doc_id", "score", "salt"])

    return segments.mapInArrow(run, HIT_SCHEMA)


def _ranked(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The distinct queries, in blocks by hash."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-size[1] // BLOCK_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for b in range(blocks):
        yield [(r["item_id"], r["text"]) for r in rows.where(F.col("block") == b).collect()]


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents of each query, scores above 0.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. Equal
    scores rank by doc_id, nulls last. Every row of ``docs`` is a document of its own, a null or
    empty text one without terms. Equal rows of ``items`` count once; two texts under one item_id
    are two queries. A query without terms, and any query on an empty table, has no rows.
    """
    spark = docs.sparkSession
    out = None
    for rows in _blocks(items):
        queries = Queries.of(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))
        segments = written(index(docs, queries.terms), "segments")
        sums = totals(segments, len(queries.terms))
        found = _ranked(hits(segments, queries, sums, top), ["item", "salt"], top).drop("rank")
        ranked = _ranked(found, ["item"], top)
        ids = [(i, item_id) for i, (item_id, _) in enumerate(queries.items)]
        # As many rows as a block has queries.
        names = F.broadcast(spark.createDataFrame(ids, "item int, item_id long"))
        ranked = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        part = written(ranked, "ranked")
        out = part if out is None else out.unionByName(part)
    return out


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
post AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY r, doc_id, term),
len AS MATERIALIZED (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM post GROUP BY r),
tot AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM len),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM post, tot GROUP BY term, docs),
asked AS (
  SELECT q, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))),
query AS (SELECT q, item_id, term, count(*) AS times FROM asked GROUP BY q, item_id, term),
scored AS (
  SELECT q.q, q.item_id, p.r, p.doc_id,
    CAST(sum(q.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * l.n * t.docs) // t.length)))) AS BIGINT) AS score
  FROM query q JOIN post p ON p.term = q.term JOIN weight w ON w.term = q.term JOIN len l ON l.r = p.r, tot t
  GROUP BY q.q, q.item_id, p.r, p.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
  doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

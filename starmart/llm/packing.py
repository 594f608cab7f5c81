"""Best-fit packing: token sequences of a fixed size, filled by best-two-fit.

A sequence is filled greedily, each time with the longest piece that fits. Then its smallest
piece gives way to two waiting pieces if these fill the gap it leaves more tightly. How a
sequence is filled depends on lengths alone, so it is planned on the counts of pieces by length:
at most as many numbers as a sequence has tokens, however large the corpus. One step of the plan
fills as many sequences alike as the counts allow. Pieces then find their place by rank among
the pieces of their length, and ranks are counted by bucket, so that no length, however common,
meets in one task.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import shuffle_count, table, text_of, written

SIZE = 2048
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 300_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Fixed values of this kind of tokenizer file: how it normalizes and what it takes for a unit.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
UNIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Words of these characters alone are normalized by lower() and hold no white space.
PLAIN = re.compile("[!-~\u00a1-\u00ff]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """Token ids of a text as little-endian bytes, word by word.

    This tokenizer drops white space and joins nothing across it, so a text's ids are those of
    its words in turn, and a plain word's those of its units; ids of words and units already met
    are kept, up to a bound.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.unit = regex.compile(UNIT)
        self.letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        kinds = [n["type"] for n in config["normalizer"].get("normalizers", [])]
        split = config["pre_tokenizer"].get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        self.by_unit = kinds == NORMALIZERS and split == UNIT

    def _unit(self, unit: str) -> bytes:
        if unit not in self.units:
            if len(self.units) > CACHED_WORDS:
                self.units.clear()
            spelt = unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.letters)
            self.units[unit] = np.array([t.id for t in self.model.tokenize(spelt)], "<u4").tobytes()
        return self.units[unit]

    def _word(self, word: str) -> bytes:
        if self.by_unit and PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join([self._unit(u) for u in self.unit.findall(word.lower())])
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        words = text.encode().split()
        known = self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        new = [w for w in set(words) if w not in known]
        if len(known) > CACHED_WORDS:
            known.clear()
            new = list(set(words))
        for word in new:
            known[word] = self._word(word.decode())
        return b"".join([known[w] for w in words])


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs, so that known words stay known."""
    return WordEncoder(path)


def _pieces(path: str, size: int):
    step = 4 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py()) + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for out, value in zip(
                        rows, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True
                    ):
                        out.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(rows, types, strict=True)], names)

    return run


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """Every document's ids and a final 0, cut into pieces of at most ``size`` tokens.

    A null text counts as empty: one piece that holds the final 0.
    """
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return texts.mapInArrow(_pieces(path or tokenizer_path(), size), PIECES)


def _fill(lengths: list[int], left: dict[int, int], size: int) -> list[int]:
    """The lengths of one sequence; ``lengths`` are those left, in order."""
    taken: Counter = Counter()
    chosen: list[int] = []
    gap = size
    while True:
        at = bisect_right(lengths, gap) - 1
        while at >= 0 and taken[lengths[at]] >= left[lengths[at]]:
            at -= 1
        if at < 0:
            break
        chosen.append(lengths[at])
        taken[lengths[at]] += 1
        gap -= lengths[at]
    if gap and len(chosen) > 1:
        small = chosen[-1]
        room, best = gap + small, (small, None)
        waiting = lengths[: bisect_right(lengths, room)]
        other = len(waiting) - 1
        for a in waiting:  # the longest partner shrinks as the first grows
            while other >= 0 and a + waiting[other] > room:
                other -= 1
            if other < 0 or waiting[other] < a:
                break
            b = waiting[other]
            spare = lambda x: left[x] - taken[x] + (x == small)
            if a + b > best[0] and spare(a) >= 1 and spare(b) >= 1 + (a == b):
                best = (a + b, (a, b))
        if best[1]:
            chosen = [*chosen[:-1], *sorted(best[1], reverse=True)]
    return chosen


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, Counter]]:
    """How many sequences to fill alike, and with which lengths how often each."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    steps = []
    while lengths:
        chosen = Counter(_fill(lengths, left, size))
        times = min(left[n] // k for n, k in chosen.items())
        steps.append((times, chosen))
        for n, k in chosen.items():
            left[n] -= times * k
            if not left[n]:
                del lengths[bisect_right(lengths, n) - 1]
    return steps


def slots(steps: list[tuple[int, Counter]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, sequences filled alike, offset), in order.

    The ranks of a length are dealt out to the steps in turn. Within a step, rank r from its
    first rank on goes to sequence r mod the number of sequences, copy r div that number.
    """
    rows, used, first = [], Counter(), 0
    for times, chosen in steps:
        offset = 0
        for length in sorted(chosen, reverse=True):
            rows.append((length, used[length], first, times, offset))
            used[length] += times * chosen[length]
            offset += length * chosen[length]
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


RANK_BITS = 48


def _place(table: np.ndarray):
    keys = (table[:, 0] << RANK_BITS) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            found = table[np.searchsorted(keys, (length << RANK_BITS) + rank, side="right") - 1]
            copy, within = np.divmod(rank - found[:, 1], found[:, 3])
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept],
                 pa.array(found[:, 2] + within), pa.array(found[:, 4] + copy * length)],
                [*kept, "sequence_id", "offset"])

    return run


def ranked(cut: DataFrame, bucket_rows: int = 100_000) -> DataFrame:
    """Each piece's rank, from 0, among the pieces of its length.

    ``cut`` is a written table. Its rows fall into buckets of bounded size by the place where
    they stand; ranks are counted within a bucket and length, after those of earlier buckets.
    """
    numbered = written(cut.withColumn("row", F.monotonically_increasing_id()), "numbered")
    n = numbered.count()
    buckets = max(shuffle_count(cut.sparkSession), -(-n // bucket_rows))
    placed = numbered.withColumn("bucket", F.expr(f"pmod(xxhash64(row), {buckets})"))
    before = placed.groupBy("length", "bucket").agg(F.count("*").alias("n")).selectExpr(
        "length", "bucket",
        "coalesce(sum(n) OVER (PARTITION BY length ORDER BY bucket"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    within = placed.selectExpr(
        "*", "row_number() OVER (PARTITION BY length, bucket ORDER BY row) - 1 AS within")
    return within.join(before, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("within")).drop("before", "within", "bucket", "row")


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """Every piece with its sequence and its offset there.

    Sequences are numbered from 0 and gapless. Repeated rows are packed each for itself; an
    empty table gives no sequences.
    """
    cut = written(pieces(docs, path, size), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most size rows
    table = slots(plan(counts, size))
    out = f"{PIECES}, sequence_id long, offset long"
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return ranked(cut).select(*order).mapInArrow(_place(table), out)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


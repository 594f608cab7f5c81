"""SentencePiece encoding and decoding over a relational lattice.

A text is cut into units that no piece reaches across: blanks with the letters and digits, or
with the other characters, that follow. The lattice of the corpus's frequent units is a table:
their substrings, up to the longest piece, equi-joined to the piece table and grouped by unit.
Spark's ``aggregate`` folds each unit's edges into its best path. What the fold keeps is a
bounded dictionary that goes to the tasks; a unit outside it is folded there, over the same edges.

The vocabulary here is a BPE one, whose result is no path of the best sum of scores: the best
edge over two neighbouring symbols is taken, again and again, the leftmost among equals. So the
fold carries the cuts that are left, and each step takes the best edge that spans exactly two
symbols. It ends where no edge does.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import table, text_of, written

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
UNIT = rf"{BLANK}*[\p{{L}}\p{{N}}]+|{BLANK}*[^\p{{L}}\p{{N}}{BLANK}]+|{BLANK}+"
LONGEST_UNIT = 32  # characters of a unit that may enter the dictionary
SHARES = 1 << 30  # parts of a level of counts
DICTIONARY = 200_000  # units at most
CACHED_UNITS = 400_000


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary of a model file: ids of pieces by text, bytes by id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.rank: dict[str, tuple[float, int]] = {}
        self.of_byte = [0] * 256
        self.bytes: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.of_byte[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.bytes.append(b"")
            elif model.is_unknown(i):
                self.bytes.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.rank[piece] = (-model.get_score(i), i)
                self.bytes.append(piece.replace(BLANK, " ").encode())
        self.longest = max(map(len, self.ids), default=1)

    def table(self, spark: SparkSession) -> DataFrame:
        """(piece, rank): the smaller the rank, the sooner a piece is formed."""
        ordered = sorted(self.ids, key=self.rank.__getitem__)
        return spark.createDataFrame(pa.table({"piece": ordered, "rank": pa.array(range(len(ordered)), pa.int32())}))

    def ids_of(self, symbols: list[str]) -> bytes:
        """Little-endian ids; a symbol that is no piece is spelt in bytes."""
        out: list[int] = []
        for s in symbols:
            if s in self.ids:
                out.append(self.ids[s])
            else:
                out.extend(self.of_byte[b] for b in s.encode())
        return np.array(out, "<u4").tobytes()

    def fold(self, unit: str) -> list[str]:
        """The symbols of one unit: as the fold in the lattice, with a queue of spans."""
        starts = list(range(len(unit)))
        before = [i - 1 for i in starts]
        after = [i + 1 for i in starts]
        end = len(unit)
        queue: list[tuple[tuple[float, int], int, int, int]] = []
        rank = self.rank

        def offer(i: int) -> None:
            middle = after[i]
            if middle < end:
                j = after[middle]
                if j - i <= self.longest and (r := rank.get(unit[i:j])):
                    heapq.heappush(queue, (r, i, middle, j))

        for i in starts:
            offer(i)
        alive = [True] * end
        while queue:
            _, i, middle, j = heapq.heappop(queue)
            if not (alive[i] and after[i] == middle and middle < end and alive[middle] and after[middle] == j):
                continue
            alive[middle] = False
            after[i] = j
            if j < end:
                before[j] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [unit[i : after[i]] for i in starts if alive[i]]


def spelt(text) -> F.Column:
    """The text with a blank before it and blanks for spaces."""
    return F.when(text != "", F.concat(F.lit(BLANK), F.translate(text, " ", BLANK))).otherwise("")


def unit_counts(docs: DataFrame) -> DataFrame:
    """(unit, n): how often the corpus has each unit."""
    units = docs.select(F.explode(F.regexp_extract_all(spelt(text_of()), F.lit(UNIT), F.lit(0))).alias("unit"))
    return units.groupBy("unit").agg(F.count("*").alias("n"))


def frequent(counts: DataFrame, most: int = DICTIONARY, longest: int = LONGEST_UNIT) -> DataFrame:
    """About the ``most`` most frequent units, never more; a bound for a cache, no more.

    Counts are levelled by their logarithm. Of the level that does not fit whole, a share by hash
    of the units fills what is left.
    """
    short = counts.where(F.length("unit") <= longest)
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = short.groupBy(level.alias("level")).agg(F.count("*").alias("units")).collect()  # a few hundred rows
    room, cut, share = most, -1, 0
    for r in sorted(sizes, key=lambda r: -r["level"]):
        if r["units"] > room:
            # Hashes fall unevenly: five times the spread of the number below the room.
            cut, share = r["level"], int(SHARES * max(room - 5 * room**0.5, 0) / r["units"])
            break
        room -= r["units"]
    part = (level == cut) & (F.pmod(F.xxhash64("unit"), F.lit(SHARES)) < share)
    return short.where((level > cut) | part).select("unit")


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, edges): the substrings of each unit that are pieces, as (rank, start, end).

    The piece table is as long as the vocabulary and no longer, so it may be broadcast.
    """
    ends = f"sequence(i + 2, least(i + {pieces.longest}, length(unit)))"
    spans = (
        f"flatten(transform(sequence(0, length(unit) - 1), i -> if(i + 2 > length(unit),"
        f" cast(array() as array<struct<i:int,j:int>>), transform({ends}, j -> named_struct('i', i, 'j', j)))))"
    )
    each = units.select("unit", F.explode_outer(F.expr(spans)).alias("s")).selectExpr(
        "unit", "s.i", "s.j", "substring(unit, s.i + 1, s.j - s.i) AS piece")
    found = each.join(F.broadcast(pieces.table(units.sparkSession)), "piece", "left")
    return found.groupBy("unit").agg(F.collect_list(F.expr("if(rank is null, null, struct(rank, i, j))")).alias("edges"))


def folded_paths(lattices: DataFrame) -> DataFrame:
    """(unit, symbols): each step of the fold joins the two symbols that the best edge spans."""
    best = (
        "array_min(filter(edges, e -> array_contains(cuts, e.i)"
        " AND get(cuts, cast(array_position(cuts, e.i) as int) + 1) = e.j))"
    )
    step = (
        f"(cuts, k) -> aggregate(array({best}), cuts, (c, e) ->"
        " if(e is null, c, filter(c, s -> s <= e.i OR s >= e.j)))"
    )
    cuts = f"aggregate(sequence(1, greatest(length(unit) - 1, 1)), sequence(0, length(unit)), {step})"
    folded = lattices.select("unit", F.expr(cuts).alias("cuts"))
    return folded.select("unit", F.expr(
        "transform(slice(cuts, 1, size(cuts) - 1), (s, k) -> substring(unit, s + 1, get(cuts, k + 1) - s))"
    ).alias("symbols"))


def decode(ids: list[int], pieces: Pieces) -> str:
    """The text of ids; the blank put before every text goes."""
    raw = b"".join([pieces.bytes[i] for i in ids]).decode(errors="replace")
    return raw.removeprefix(" ")


class Encoder:
    def __init__(self, pieces: Pieces, known: dict[str, bytes]):
        self.pieces, self.known, self.met = pieces, known, {}
        self.unit = regex.compile(UNIT)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        out = []
        known, met = self.known, self.met
        for unit in self.unit.findall(BLANK + text.replace(" ", BLANK)):
            ids = known.get(unit) or met.get(unit)
            if ids is None:
                if len(met) > CACHED_UNITS:
                    met.clear()
                ids = met[unit] = self.pieces.ids_of(self.pieces.fold(unit))
            out.append(ids)
        return b"".join(out)


def dictionary(docs: DataFrame, pieces: Pieces) -> dict[str, bytes]:
    """The frequent units with their ids, from the lattice; at most ``DICTIONARY`` entries."""
    units = frequent(written(unit_counts(docs), "units"))
    rows = folded_paths(lattice(units, pieces)).toArrow()
    return {u: pieces.ids_of(s) for u, s in zip(rows["unit"].to_pylist(), rows["symbols"].to_pylist(), strict=True)}


OUT = "doc_id long, ids array<int>, decoded string"


def encoded(docs: DataFrame, path: str | None = None, digest: bool = False) -> DataFrame:
    """doc_id, ids and decoded text of every row, or with ``digest`` figures on them.

    A null text counts as empty and has no ids. Decoding gives the text back, but for a literal
    ``▁``, which this kind of vocabulary takes for a space.
    """
    spark = docs.sparkSession
    where = path or model_path()
    pieces = Pieces(where)
    known = spark.sparkContext.broadcast(dictionary(docs, pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pieces(where)
        encoder = Encoder(own, known.value)
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            found = [np.frombuffer(encoder.encode(t), "<u4") for t in texts]
            back = [decode(ids.tolist(), own) for ids in found]
            if digest:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(i) for i in found], pa.int64()),
                     pa.array([zlib.crc32(i.tobytes()) for i in found], pa.int64()),
                     pa.array([b == t for b, t in zip(back, texts, strict=True)])],
                    ["doc_id", "n_tokens", "ids_crc32", "round_trip"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([i.astype(np.int32) for i in found], pa.list_(pa.int32())), pa.array(back, pa.string())],
                    ["doc_id", "ids", "decoded"])

    schema = "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean" if digest else OUT
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, schema)


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), digest=True)

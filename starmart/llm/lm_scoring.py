"""LM scoring: a log-bilinear model over word classes, trained with noise-contrastive estimation.

Word counts cover every document to learn from. The most frequent words are classes of their own;
every other word belongs to the class of its last two bytes or, where that ending is rare, to one
of the rest. The model predicts a token's class from the two tokens before it: the context's
vectors, each turned by the matrix of its place, add up to a predicted vector, whose product with
a class's vector plus a bias is the class's score. Inside a class a word has its share of the
smoothed counts, so the probabilities of all words and one unseen word a class sum to 1.

Training is noise-contrastive: in numpy, in the tasks, on all documents to learn from, which are
dealt into rounds by hash; after a round the tasks' parameters are averaged by tokens. Scoring
normalises exactly: the scores are sums of one term a place, so the normalisers of all contexts
are one matrix product of the exponentials.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import table, text_of, written

FOLDS, HELD = 5, 1
# Classes of single words and of endings; classes go to the tasks as 16-bit numbers.
SINGLE, ENDINGS = 1_536, 254
# Words whose counts go to every task; the others' counts are joined.
DICTIONARY = 100_000
LONGEST = 64  # bytes of a word in it
WIDTH = 16
ROUNDS = 6
NOISE = 96
MINIBATCH = 1_024
# Of the first round; the k-th has one k-th of it.
RATE = 0.03
SEED = 20_240_601
# Parameters that are added up together.
SHARE = 512
# A task sends its counts on when it holds this many different words.
HELD_WORDS = 400_000
# Tokens scored or encoded together.
PIECE = 1_000_000


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out from learning; a null doc_id never is."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == HELD, F.lit(False))


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts, added up in the tasks before anything is dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "c"])

        for batch in batches:
            for text in batch.column(0):
                for w in words_of(text.as_py()):
                    found[w] = found.get(w, 0) + 1
                if len(found) > HELD_WORDS:
                    yield sent()
                    found = {}
        yield sent()

    parts = docs.select(text_of().alias("text")).mapInArrow(run, "word binary, c long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """What the tasks know of the counts: bounded, whatever the corpus."""

    tokens: int  # N, ends included
    distinct: int  # V, the end included
    ends: int
    single: list[bytes]  # words with a class of their own
    endings: list[bytes]  # endings with a class of their own
    counts: dict[bytes, int]  # of the most frequent words
    class_tokens: np.ndarray  # by class
    class_words: np.ndarray  # by class: different words

    # Classes: the end, single words, endings, the rest. The end also stands before the text.
    @property
    def classes(self) -> int:
        return 2 + len(self.single) + len(self.endings)

    def numbers(self) -> tuple[dict[bytes, int], dict[bytes, int]]:
        """The classes of single words and of endings."""
        own = {w: 1 + i for i, w in enumerate(self.single)}
        return own, {e: 1 + len(own) + i for i, e in enumerate(self.endings)}

    def base(self, count: float) -> float:
        return math.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def unigram(self) -> np.ndarray:
        """The classes' smoothed shares of all tokens."""
        n = self.class_tokens + 0.5
        return n / n.sum()

    def log_shares(self) -> np.ndarray:
        """Less this, log10(c + 0.5) is the log10 share of a word within its class: 0 for the classes
        of one word, else over the class's words and one unseen."""
        out = np.log10(self.class_tokens + 0.5 * (self.class_words + 1))
        out[: 1 + len(self.single)] = np.nan
        return out


def _level() -> Column:
    return F.floor(F.log2("c") * 64).cast("int")


def _frequent(counts: DataFrame, bound: int) -> tuple[list[tuple[bytes, int]], int]:
    """About the ``bound`` most frequent words, by falling count, and how many of them are whole
    levels of counts. Of the level that does not fit, a share by hash fills the rest.

    Counts are levelled by their logarithm, so the driver gets at most a few thousand levels and
    then the words themselves.
    """
    short = counts.where(F.octet_length("word") <= LONGEST)
    levels = short.groupBy(_level().alias("level")).agg(F.count("*").alias("words")).collect()
    fit, cut, share = 0, -1, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        if fit + r["words"] > bound:
            cut, share = r["level"], int(1_000_000 * 0.98 * (bound - fit) / r["words"])
            break
        fit += r["words"]
    part = (_level() == cut) & (F.pmod(F.xxhash64("word"), F.lit(1_000_000)) < share)
    rows = [(bytes(r["word"]), r["c"]) for r in short.where((_level() > cut) | part).select("word", "c").collect()]
    return sorted(rows, key=lambda r: (-r[1], r[0])), fit


def vocabulary(
    counts: DataFrame, ends: int, single: int = SINGLE, endings: int = ENDINGS, dictionary: int = DICTIONARY
) -> Vocabulary:
    """From the written counts; the driver gets the most frequent words and one row a class."""
    frequent, whole = _frequent(counts, dictionary)
    held = dict(frequent)
    own = [w for w, _ in frequent[: min(single, whole)]]
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    is_single = F.lit(False)
    if own:
        # The least count among the single words tells all others apart but those of that count.
        least = held[own[-1]]
        tied = [bytearray(w) for w in own if held[w] == least]
        is_single = (F.col("c") > least) | ((F.col("c") == least) & F.col("word").isin(tied))
        is_single &= F.octet_length("word") <= LONGEST
    last_two = "substring(word, greatest(octet_length(word) - 1, 1), 2)"
    by_end = (
        counts.where(~is_single)
        .groupBy(F.expr(last_two).alias("ending"))
        .agg(F.sum("c").alias("c"), F.count("*").alias("words"))
    )
    top = by_end.orderBy(F.col("c").desc(), "ending").limit(endings).collect()
    rest = by_end.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    ending_tokens, ending_words = [r["c"] for r in top], [r["words"] for r in top]
    tokens = [ends, *[held[w] for w in own], *ending_tokens, rest[0] - sum(ending_tokens)]
    words = [1, *[1] * len(own), *ending_words, rest[1] - sum(ending_words)]
    return Vocabulary(
        totals[0] + ends, totals[1] + (ends > 0), ends, own, [bytes(r["ending"]) for r in top],
        held, np.array(tokens, float), np.array(words, float))


ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, "
    "ids binary, rare array<binary>, times array<int>"
)


def encoded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Every document's classes, what the dictionary settles, and the other words with their times."""
    end_known = int(known.ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ending = known.numbers()
        rest = known.classes - 1
        shares = known.log_shares()
        base0 = known.base(known.ends)
        scale = known.base(0.5)  # log10 of 1 over the denominator
        entry: dict[bytes, tuple[int, float]] = {}
        for w, c in known.counts.items():
            entry[w] = (own[w] if w in own else ending.get(w[-2:], rest), math.log10(c + 0.5))
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for text in batch.column(3):
                words = words_of(text.as_py())
                ids = np.zeros(len(words) + 1, "<u2")
                logs = np.zeros(len(words))
                others: dict[bytes, int] = {}
                for i, w in enumerate(words):
                    found = entry.get(w)
                    if found is not None:
                        ids[i], logs[i] = found
                    else:
                        ids[i] = ending.get(w[-2:], rest)
                        others[w] = others.get(w, 0) + 1
                rare = sum(others.values())
                # What words of a class hold inside it; words that are joined add their part later.
                inside = shares[ids[:-1]]
                inner = float(np.where(np.isnan(inside), 0.0, logs - np.nan_to_num(inside)).sum())
                columns[0].append(len(words) + 1)
                columns[1].append(len(words) - rare + end_known)
                columns[2].append(base0 + float(logs.sum()) + len(words) * scale)
                columns[3].append(inner)
                columns[4].append(ids.tobytes())
                columns[5].append(list(others))
                columns[6].append(list(others.values()))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                [c.split()[0] for c in ENCODED.split(", ")])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        text_of().alias("text"),
    )
    return rows.mapInArrow(run, ENCODED)


@dataclass(frozen=True)
class LogBilinear:
    """Vectors of the classes as context and as target, a matrix for each of two places, biases."""

    context: np.ndarray  # classes x width
    place: np.ndarray  # 2 x width x width; the nearer token first
    target: np.ndarray  # classes x width
    bias: np.ndarray  # classes

    @staticmethod
    def start(unigram: np.ndarray, width: int = WIDTH, seed: int = SEED) -> LogBilinear:
        """Nearly the unigram model: small random vectors, biases at the log shares."""
        rng = np.random.default_rng(seed)
        n = len(unigram)
        return LogBilinear(
            rng.normal(0, 0.1, (n, width)),
            np.stack([np.eye(width), 0.5 * np.eye(width)]),
            rng.normal(0, 0.1, (n, width)),
            np.log(unigram),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (self.context, self.place, self.target, self.bias)])

    def filled(self, flat: np.ndarray) -> LogBilinear:
        parts, at = [], 0
        for a in (self.context, self.place, self.target, self.bias):
            parts.append(flat[at : at + a.size].reshape(a.shape))
            at += a.size
        return LogBilinear(*parts)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Natural logs: a place's scores of context by class, twice (the bias in the first), and the
        normaliser by nearer and farther token."""
        near = self.context @ self.place[0] @ self.target.T + self.bias
        far = self.context @ self.place[1] @ self.target.T
        shift = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        z = np.exp(near - shift[0]) @ np.exp(far - shift[1]).T
        z = np.log(np.maximum(z, 1e-300)) + shift[0] + shift[1].T
        return near.astype(np.float32), far.astype(np.float32), z.astype(np.float32)


def _contexts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens one and two before each of a text; the end's class stands before the first."""
    padded = np.concatenate([np.zeros(2, ids.dtype), ids])
    return padded[1:-1], padded[:-2]


class Trainer:
    """Noise-contrastive steps over minibatches of tokens, from given parameters.

    AdaGrad with one rate a vector. Every minibatch shares its noise, drawn by the classes' shares;
    drawn anew it is unbiased, and one product scores it for all tokens.
    """

    def __init__(self, model: LogBilinear, noise: np.ndarray, seed: int, rate: float) -> None:
        n = len(noise)
        self.rate = rate
        # Context vectors, then target vectors; the last column is the target's bias.
        self.rows = np.zeros((2 * n, model.context.shape[1] + 1), np.float32)
        self.rows[:n, :-1], self.rows[n:, :-1], self.rows[n:, -1] = model.context, model.target, model.bias
        self.place = model.place.astype(np.float32)
        self.classes = n
        self.noise = np.log(noise * NOISE).astype(np.float32)
        self.ends = np.cumsum(noise)
        self.rng = np.random.default_rng(seed)
        self.squares = np.full((2 * n, 2), 1e-2, np.float32)  # of a row's vector, of its bias
        self.place_squares = np.full(2, 1e-2)
        self.tokens = 0

    def trained(self) -> LogBilinear:
        rows, n = self.rows.astype(float), self.classes
        return LogBilinear(rows[:n, :-1], self.place.astype(float), rows[n:, :-1], rows[n:, -1])

    def step(self, near: np.ndarray, far: np.ndarray, true: np.ndarray) -> None:
        n, b = self.classes, len(true)
        self.tokens += b
        draws = np.searchsorted(self.ends, self.rng.random(NOISE) * self.ends[-1])
        draws = np.minimum(draws, n - 1).astype(np.uint16)
        a, c = self.rows[near, :-1], self.rows[far, :-1]
        predicted = a @ self.place[0] + c @ self.place[1]
        goal, drawn = self.rows[n + true.astype(np.int64)], self.rows[n + draws.astype(np.int64)]
        own = np.einsum("ij,ij->i", predicted, goal[:, :-1]) + goal[:, -1] - self.noise[true]
        other = predicted @ drawn[:, :-1].T + (drawn[:, -1] - self.noise[draws])
        # Ascent of log sigmoid(own) + the sum of log(1 - sigmoid(other)).
        up = 1 / (1 + np.exp(np.clip(own, -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(other, -30, 30)))
        to_predicted = up[:, None] * goal[:, :-1] + down @ drawn[:, :-1]
        steps = np.zeros((3 * b + NOISE, self.rows.shape[1]), np.float32)
        steps[:b, :-1], steps[b : 2 * b, :-1] = to_predicted @ self.place[0].T, to_predicted @ self.place[1].T
        steps[2 * b : 3 * b, :-1], steps[2 * b : 3 * b, -1] = up[:, None] * predicted, up
        steps[3 * b :, :-1], steps[3 * b :, -1] = down.T @ predicted, down.sum(axis=0)
        keys = np.concatenate([near, far, true + np.uint16(n), draws + np.uint16(n)])
        order = np.argsort(keys, kind="stable")
        sorted_keys = keys[order]
        starts = np.flatnonzero(np.diff(sorted_keys, prepend=np.uint16(65_535)))
        total, used = np.add.reduceat(steps[order], starts), sorted_keys[starts]
        self.squares[used, 0] += np.square(total[:, :-1]).mean(axis=1)
        self.squares[used, 1] += np.square(total[:, -1])
        pace = self.rate / np.sqrt(self.squares[used])
        self.rows[used, :-1] += pace[:, :1] * total[:, :-1]
        self.rows[used, -1] += pace[:, 1] * total[:, -1]
        to_place = np.stack([a.T @ to_predicted, c.T @ to_predicted])
        self.place_squares += np.square(to_place).mean(axis=(1, 2))
        self.place += (self.rate / np.sqrt(self.place_squares)).astype(np.float32)[:, None, None] * to_place

    def learn(self, near: np.ndarray, far: np.ndarray, true: np.ndarray) -> None:
        """One pass over some tokens in shuffled minibatches."""
        order = self.rng.permutation(len(true))
        for at in range(0, len(order), MINIBATCH):
            o = order[at : at + MINIBATCH]
            self.step(near[o], far[o], true[o])


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """(nearer, farther, token, text) by token, the text as its place in the column: ``PIECE`` of
    them at a time, so that a long text never makes long arrays."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def joined() -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))

    for text, ids in enumerate(column):
        true = np.frombuffer(ids.as_py(), "<u2")
        near, far = _contexts(true)
        for at in range(0, len(true), PIECE):
            cut = slice(at, at + PIECE)
            held.append((near[cut], far[cut], true[cut], np.full(len(true[cut]), text)))
            size += len(true[cut])
            if size >= PIECE:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the arrays of each place, one at a time."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[at] = total.get(at, 0) + np.frombuffer(value.as_py())
    yield pa.RecordBatch.from_arrays(
        [pa.array(total.keys(), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
        ["at", "value"])


def round_of(row: Column, rounds: int = ROUNDS) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(rounds)).cast("int")


def trained(stored: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """The model after one pass over all documents that aren't held out, a share of them a round.

    ``stored`` has round, fold, row, ids. In a round each task steps through its documents from
    the same parameters; their average, weighed by tokens, starts the next.
    """
    noise = known.unigram()
    model = LogBilinear.start(noise)
    for k in range(rounds):
        start = model

        def run(batches: Iterator[pa.RecordBatch], start=start, k=k) -> Iterator[pa.RecordBatch]:
            trainer = None
            for batch in batches:
                if batch.num_rows and trainer is None:
                    trainer = Trainer(start, noise, SEED + k + batch.column(0)[0].as_py() % 1_000_003, RATE / (k + 1))
                for near, far, true, _ in _pieces(batch.column(1)):
                    trainer.learn(near, far, true)
            if trainer is not None:
                flat = np.append(trainer.trained().flat() * trainer.tokens, trainer.tokens)
                cut = [flat[at : at + SHARE].tobytes() for at in range(0, len(flat), SHARE)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], ["at", "value"])

        share = stored.where((F.col("round") == k) & (F.col("fold") == 0)).select("row", "ids")
        sums = share.mapInArrow(run, "at int, value binary").repartition("at").mapInArrow(_summed, "at int, value binary")
        # All parameters once, a number that the classes and the width bound.
        got = {r["at"]: np.frombuffer(r["value"]) for r in sums.collect()}
        if got:
            flat = np.concatenate([got[i] for i in range(len(got))])
            model = model.filled(flat[:-1] / flat[-1])
    return model


_KEPT: dict[int, tuple] = {}  # a worker's tables of the last model


def _tables(key: int, model: LogBilinear) -> tuple[np.ndarray, ...]:
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = model.tables()
    return _KEPT[key]


def with_class_scores(stored: DataFrame, model: LogBilinear) -> DataFrame:
    """The columns of ``stored`` but for the tokens, and the log10 probability of their classes."""
    key = hash(model.flat().tobytes())
    kept = [c for c in stored.columns if c not in ("ids", "rare", "times", "round", "fold")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near_, far_, z = _tables(key, model)
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for near, far, true, text in _pieces(batch.column(0)):
                log = near_[near, true].astype(float) + far_[far, true] - z[near, far]
                scores += np.bincount(text, log, batch.num_rows) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores)], [*kept, "classes"])

    rows = stored.select("ids", *kept)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{schema}, classes double")


def score(docs: DataFrame, single: int = SINGLE, endings: int = ENDINGS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    Null texts count as empty: their one token is the end. A repeated doc_id or row is a document
    each time. A null doc_id is never held out. Where nothing can be learnt from, counts are 0 and
    the model is the smoothed unigram one. An empty table gives an empty result; columns other than
    doc_id and text are not read.
    """
    learn = docs.where(~held_out(F.col("doc_id")))
    counts = written(word_counts(learn), "counts")
    known = vocabulary(counts, learn.count(), single, endings)
    # By round and fold in folders of their own, so that a round reads its share alone.
    dealt = {"round": round_of(F.col("row"), rounds), "fold": F.col("held_out").cast("int")}
    stored = written(encoded(docs, known).withColumns(dealt), "encoded", list(dealt))
    model = trained(stored, known, rounds)
    rare = stored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    extra = (
        rare.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
            F.sum(F.col("times") * F.log10(c + 0.5)).alias("logs"),
        )
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return (
        with_class_scores(stored, model)
        .join(extra, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
            F.lit(known.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + logs).alias("base_score"),
            (F.col("classes") + F.col("inner") + logs).alias("score"),
        )
    )


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))

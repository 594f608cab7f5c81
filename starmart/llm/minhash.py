"""MinHash near-dedup by tensored banding.

Two collections of ``HALVES`` half keys are computed for each set of shingles, each half key from
``ROWS`` min-hashes. A table key joins two half keys, of different collections or of one, so the
20 half keys here make 190 tables of 6 hashes each at the cost of 60 min-hashes. Half keys that
nothing else has are dropped before any pair is formed, which leaves most documents without a
table key.

Candidates are confirmed on full sets. Within a table key all are first compared with its most
typical node. Once those links are joined to components, only pairs of different components
are left. These are found by an exact prefix filter: similar sets share one of their rarest
shingles, and what is outside a shingle's largest component is compared with all that have it.

A linked pair is missed if less than two of its half keys agree. With p the cube of its
similarity the chance of that is (1 - p)**20 + 20 * p * (1 - p)**19: 2e-7 at 0.85, 1e-5 at 0.8, and
far less for closer pairs. Every other step is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.shingles import Words, components, folded, shingled
from starmart.llm.store import passing, removed, table, text_of, written

ROWS, HALVES = 3, 10
PARITY = 8  # 64-bit words of a set's parities

_SEEDS = np.random.default_rng(20240229).integers(0, 2**64, size=2 * HALVES * ROWS, dtype=np.uint64)
_TURN = np.uint64(0xBF58476D1CE4E5B9)


def half_keys(shingles: np.ndarray) -> np.ndarray:
    """The half keys of both collections, from the set's 64-bit hashes."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = (shingles[None, at : at + 4096] ^ _SEEDS[:, None]) * _TURN
        part ^= part >> np.uint64(31)
        np.minimum(least, (part * _TURN).min(axis=1), out=least)
    return folded(list(least.reshape(-1, ROWS).T.copy()))


def parities(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of the set's hashes falls into each of 64 * ``PARITY`` places, as bits.

    Two sets' bits differ in no more places than there are shingles in one of them alone.
    """
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            digests, counts, halves = [], [], []
            for text in batch.column(1):
                found = np.unique(shingled(words.hashes(text.as_py()), size))
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                halves.append(half_keys(found).view(np.int64) if len(found) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(halves, pa.list_(pa.int64()))],
                ["doc_id", "node", "n", "halves"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            found = [np.unique(shingled(words.hashes(t.as_py()), size)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary()),
                 pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64())),
                 pa.array([parities(x) for x in found], pa.list_(pa.int64()))],
                ["node", "set", "parity"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, node (a digest of the set), n and half keys; of an empty set only doc_id and n."""
    return _texts(docs).mapInArrow(_sketch(size), "doc_id long, node binary, n long, halves array<long>")


def table_keys(nodes: DataFrame) -> DataFrame:
    """(key, node, id, n): the table keys made of half keys that at least two nodes have."""
    halves = nodes.select("node", "id", "n", F.posexplode("halves").alias("at", "half"))
    shared = halves.groupBy("at", "half").agg(F.count("*").alias("c")).where("c > 1")
    alive = halves.join(shared.select("at", "half"), ["at", "half"])
    pair = alive.groupBy("node", "id", "n").agg(F.collect_list(F.struct("at", "half")).alias("alive"))
    return pair.select("node", "id", "n", F.explode(F.expr(
        "flatten(transform(alive, a -> transform(filter(alive, b -> b.at > a.at),"
        " b -> xxhash64(a.at, a.half, b.at, b.half))))"
    )).alias("key"))


def near_enough(percent: int) -> str:
    """Sizes of sets that can reach the similarity at all."""
    return f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)"


def shared_keys(keyed: DataFrame) -> DataFrame:
    """The keys of at least two nodes, each row with its node's weight: the rows it meets."""
    counts = keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    met = written(keyed.join(counts, "key"), "met")
    weights = met.groupBy("node").agg(F.sum("c").alias("weight"))
    return met.join(weights, "node")


def star_pairs(keyed: DataFrame, percent: int) -> DataFrame:
    """Each key's nodes paired with its most typical one, which meets the most others."""
    heads = keyed.groupBy("key").agg(F.max(F.struct("weight", "node", "n")).alias("h"))
    return (
        keyed.join(heads, "key")
        .selectExpr("least(h.node, node) AS a", "greatest(h.node, node) AS b", "h.n AS a_n", "n AS b_n")
        .where("a <> b").where(near_enough(percent)).select("a", "b").distinct()
    )


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(key, node, short): a set's rarest shingles, so many that similar sets must share one.

    Of two similar sets the smaller one shares at least 2t / (1 + t) of its shingles, so its
    shorter prefix already meets the longer prefix of the other.
    """
    each = sets.select("node", F.size("set").alias("size"), F.explode("set").alias("key"))
    often = each.groupBy("key").agg(F.count("*").alias("often"))
    placed = each.join(often, "key").selectExpr(
        "key", "node", "size", "row_number() OVER (PARTITION BY node ORDER BY often, key) AS place")
    return placed.where(f"place <= size - ceil(size * {percent} / 100) + 1").selectExpr(
        "key", "node", f"place <= size - ceil(size * {2 * percent} / {100 + percent}) + 1 AS short")


def may_reach(percent: int) -> str:
    """Whether sets whose bits ``x_p`` and ``y_p`` are parities can reach the similarity.

    Bits that differ are shingles that only one set has, so they bound what is common. Exact: no
    pair that reaches it is left out.
    """
    differ = " + ".join(f"bit_count(x_p[{i}] ^ y_p[{i}])" for i in range(PARITY))
    return f"{100 + percent} * (a_n + b_n - ({differ})) >= {2 * percent} * (a_n + b_n)"


def rest_pairs(keyed: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components: what is outside a key's largest one, with all of the key."""
    return rest_meetings(keyed, percent).select("a", "b").distinct()


def rest_meetings(keyed: DataFrame, percent: int) -> DataFrame:
    """(key, a, b): the pairs of ``rest_pairs``, once for each key that they meet in.

    Where rows have the parities of their sets, pairs that differ in too many do not leave the join.
    """
    sketched = "parity" in keyed.columns
    parts = keyed.groupBy("key", "root").agg(F.count("*").alias("c"))
    largest = parts.groupBy("key").agg(
        F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("parts")).where("parts > 1")
    open_ = keyed.join(largest.selectExpr("key", "m.root AS major"), "key")
    minor = open_.where("root <> major").selectExpr(
        "key", "node AS x", "root AS x_root", "n AS a_n", "short AS x_short", *(["parity AS x_p"] if sketched else []))
    every = open_.selectExpr(
        "key", "node AS y", "root AS y_root", "n AS b_n", "short AS y_short", "major",
        *(["parity AS y_p"] if sketched else []))
    return (
        minor.join(every, "key")
        .where("x_root <> y_root AND (y_root = major OR x < y)")
        .where("if(a_n < b_n, x_short, if(a_n > b_n, y_short, x_short OR y_short))")
        .where(near_enough(percent))
        .where(may_reach(percent) if sketched else "true")
        .selectExpr("key", "least(x, y) AS a", "greatest(x, y) AS b")
    )


def sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, set, parity) of the given nodes (node, id), made anew from the texts they stand for."""
    ids = nodes.select(F.col("id").alias("doc_id")).distinct()
    texts = _texts(docs).join(ids, "doc_id", "left_semi")
    made = texts.select("text").mapInArrow(_sets(size), "node binary, set array<long>, parity array<long>")
    # Rows of one doc_id can hold several texts: only those of the nodes count, each once.
    return made.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left, right = sets.selectExpr("node AS a", "set AS x"), sets.selectExpr("node AS b", "set AS y")
    both = pairs.join(left, "a").join(right, "b")
    sized = both.selectExpr("a", "b", "size(x) + size(y) AS total", "size(array_intersect(x, y)) AS common")
    return sized.where(f"100 * common >= {percent} * (total - common)").select("a", "b")


def decided(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row, its node and its component's root.

    Null and empty texts have no shingles and are linked with nothing, nor is a row whose doc_id
    is null (its component_id is null, and it is kept). Copies are one node, so repeated rows
    share a component. Of several texts under one doc_id each has its own links.
    """
    sketch = written(sketches(docs, size), "sketches")
    nodes = written(
        sketch.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("halves").alias("halves")),
        "nodes")
    with passing(docs.sparkSession) as kept:
        keyed = written(shared_keys(table_keys(nodes)), "keys")
        kept.append(keyed)
    sets = written(sets_of(docs, keyed.select("node", "id").distinct(), size), "sets")
    pairs = written(star_pairs(keyed, percent), "pairs")
    links = written(confirmed(pairs, sets, percent), "confirmed")
    roots = components(links)

    rooted = keyed.join(roots, "node", "left").selectExpr("key", "node", "n", "c", "coalesce(root, node) AS root")
    open_keys = rooted.where("c > 2").groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    open_nodes = written(rooted.join(open_keys, "key").select("node", "n", "root").distinct(), "open")
    drawn = open_nodes.join(sets.select("node", "parity"), "node")
    fine = written(prefixes(sets.join(open_nodes.select("node"), "node"), percent).join(drawn, "node"), "prefixes")
    rest = written(rest_pairs(fine, percent).join(pairs, ["a", "b"], "left_anti"), "rest")
    removed(keyed, open_nodes, fine, pairs)
    if not rest.isEmpty():
        roots = components(links.union(confirmed(rest, sets, percent)))
    removed(sets, rest, links)

    named = roots.join(nodes.select("node", "id"), "node")
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = nodes.select("node", "id").join(
        named.select("node", "root").join(least, "root").select("node", "root", "component_id"), "node", "left")
    of_node = classes.selectExpr("node", "coalesce(component_id, id) AS component_id", "coalesce(root, node) AS root")
    known = sketch.selectExpr("doc_id", "n AS n_shingles", "if(doc_id IS NULL, NULL, node) AS node")
    return known.join(of_node, "node", "left").selectExpr(
        "doc_id", "n_shingles",
        "coalesce(component_id, doc_id) AS component_id",
        "doc_id <=> coalesce(component_id, doc_id) AS kept", "node", "root")


def groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; see op2_minhash_dedup."""
    return decided(docs, size, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _noded(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            found = [np.unique(shingled(words.hashes(t or ""), size)) for t in batch.column("text").to_pylist()]
            nodes = pa.array([xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], [*batch.schema.names, "node"])

    return run


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, at five words and a similarity of 0.8.

    Of several texts under one doc_id each is judged by itself: those that are not near an earlier
    document stay, one row of each component, with the smallest text.
    """
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    with passing(spark) as kept:
        found = written(decided(docs, 5, 80), "groups")
        kept.append(found)
    docs = docs.select(*columns)
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    gone = found.where("NOT kept").select("doc_id").distinct()
    if repeated.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*columns)
    repeated = written(repeated, "repeated")
    single = docs.join(gone.union(repeated), "doc_id", "left_anti").select(*columns)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    several = docs.join(repeated, "doc_id", "left_semi").select(*columns).mapInArrow(_noded(5), f"{types}, node binary")
    stay = found.where("kept").join(repeated, "doc_id", "left_semi").selectExpr(
        "doc_id AS id", "node AS own", "root").distinct()
    met = several.join(stay, F.expr("doc_id = id AND node <=> own"))
    named = met.groupBy("doc_id", "root").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("d"))
    return single.union(named.select("doc_id", "d.*"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"), 3, 85)

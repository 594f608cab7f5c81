"""Word shingles as 64-bit hashes, and the connected components of links.

Two different shingles of one pair of documents share a hash with a chance of about one in 2**64
for each two of them, which is taken as never.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.store import removed, written

CACHED_WORDS = 200_000  # about 40 MB
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Words:
    """The hashes of a text's words, A-Z lower-cased; hashes of words already met are kept."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        known = self.known
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            pass
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([known[w] for w in words], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _FOLD
    return h ^ (h >> np.uint64(32))


def folded(rows: list[np.ndarray] | np.ndarray) -> np.ndarray:
    """One hash of several in order."""
    h = np.zeros_like(rows[0])
    for row in rows:
        h = (h + row) * _FOLD
    return mixed(h)


def shingled(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words in order; of a shorter text, that of all its words."""
    n = len(words)
    if n == 0:
        return words
    if n < size:
        return folded([words[i : i + 1] for i in range(n)] + [np.array([n], np.uint64)])
    return folded([words[i : n - size + 1 + i] for i in range(size)])


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node in ``links`` (a, b), the root being the component's least node.

    Alternates the two star operations: every node hands its larger neighbours, then its smaller
    ones, to the least node among them. Rounds grow with the logarithm of the longest chain, and
    each round's links are written, so no lineage builds up.
    """
    edges = links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct()
    edges = written(edges, "links")
    before = None
    while True:
        both = edges.union(edges.selectExpr("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("v AS u", "m AS v").where("u <> v").union(least.selectExpr("u", "m AS v"))
        last, edges = edges, written(small.distinct(), "links")
        removed(last)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return edges.selectExpr("u AS node", "v AS root").union(
                edges.selectExpr("v AS node", "v AS root")).distinct()
        before = state

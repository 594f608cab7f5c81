"""Secret scans: spans of known secrets, and weak ones that only count in company.

A weak secret (a short password, a value behind a loose keyword) is reported only when an
identifier and an endpoint stand within the same scope, a distance in code points. The parts are
linked by an interval join: each part falls into a cell of the scope's width, and parts within
the scope lie in the same cell or in the one beside it. A cell keeps the first and last start of
each kind, which decides for a whole cell at once whether one lies near enough, so that a text
with many parts makes no pairs of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import table, text_of, written

# Fixed patterns of the base kinds, in the order in which they are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "linked")
LEAST_VALUE = 8

# Parts that mean little alone.
WEAK = r"""(?i)\b(pass(?:word|wd|phrase)?|pwd|secret|token|auth|credential|(?:api_?|access_?|private_?)?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{4,})"""
IDENTIFIER = r"""(?i)\b(?:user(?:name|_?id)?|login|account|client_?id|access_?(?:key_?)?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{2,}|AKIA[A-Z0-9]+"""
ENDPOINT = r"""(?i)\b[a-z][a-z0-9+.-]*://[^\s"'<>]+|\b(?:host|server|endpoint)["']?\x20*[:=]\x20*["']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"""
SCOPE = 256

SPANS = "array<struct<s:int,e:int>>"
TOGETHER = 200  # matches added up at a time


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_of(text: str, pattern: str) -> Column:
    """Start and end, in code points, of a pattern's matches, leftmost and not overlapping.

    Matches and the gaps between them come from one pattern, so their lengths add up to
    positions. They are added up in blocks, then the blocks, so that no long array is built by
    appending. Most texts match nothing and stop at the first test.
    """
    p = _literal(pattern)
    none = f"cast(array() as {SPANS})"
    return F.expr(f"""
        if({text} rlike {p},
          get(transform(array(
            zip_with(regexp_extract_all({text}, {p}, 0), split({text}, {p}, -1), (m, g) ->
              named_struct('g', length(g), 'm', length(m)))), pairs ->
            get(transform(array(
              transform(sequence(0, cast((size(pairs) - 1) div {TOGETHER} as int)), i ->
                aggregate(slice(pairs, i * {TOGETHER} + 1, {TOGETHER}), named_struct('at', 0, 'out', {none}),
                  (a, x) -> if(x.m is null, a, named_struct(
                    'at', a.at + x.g + x.m,
                    'out', array_append(a.out, named_struct('s', a.at + x.g, 'e', a.at + x.g + x.m))))))), blocks ->
              flatten(zip_with(
                blocks,
                aggregate(blocks, named_struct('at', 0, 'out', cast(array() as array<int>)),
                  (a, x) -> named_struct('at', a.at + x.at, 'out', array_append(a.out, a.at)), a -> a.out),
                (x, from) -> transform(x.out, y -> named_struct('s', y.s + from, 'e', y.e + from))))), 0)), 0),
          {none})""")


def _valued(text: str, pattern: str, spans: str, least: int) -> Column:
    """The spans whose second group has at least so many characters."""
    return F.expr(f"""
        if(size({spans}) = 0, {spans},
          transform(filter(
            zip_with({spans}, regexp_extract_all({text}, {_literal(pattern)}, 2), (x, v) -> struct(x, v)),
            y -> length(y.v) >= {least}), y -> y.x))""")


def _kind(column: str, k: int) -> str:
    return f"transform({column}, x -> named_struct('s', x.s, 'k', {k}, 'e', x.e))"


def scan(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Spans of the base kinds and of the weak parts, beside ``doc``, the carried columns."""
    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("doc"), text_of().alias("body"))
    raw = texts.select(
        "doc", "body",
        spans_of("body", ASSIGN).alias("assigned"),
        spans_of("body", ACCESS).alias("access"),
        spans_of("body", HEX).alias("hex"),
        spans_of("body", WEAK).alias("weak"),
    )
    return raw.select(
        "doc",
        F.md5("body").alias("digest"),
        _valued("body", ASSIGN, "assigned", LEAST_VALUE).alias("assign"),
        "access", "hex", "weak",
        F.when(F.size("weak") > 0, spans_of("body", IDENTIFIER)).alias("ids"),
        F.when(F.size("weak") > 0, spans_of("body", ENDPOINT)).alias("ends"),
    )


def link(scanned: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans with an identifier and an endpoint within ``scope``, per distinct text."""
    whole = scanned.where("size(weak) > 0 AND size(ids) > 0 AND size(ends) > 0")
    one = whole.groupBy("digest").agg(
        *[F.first(c).alias(c) for c in ("assign", "access", "hex", "weak", "ids", "ends")])
    base = "concat(assign, access, hex)"
    weak = one.select(
        "digest",
        F.explode(F.expr(f"filter(weak, w -> not exists({base}, b -> b.s < w.e AND w.s < b.e))")).alias("w"),
    ).select("digest", "w.s", "w.e", F.expr(f"w.s div {scope}").alias("cell"))
    near = weak
    for part in ("ids", "ends"):
        placed = one.select("digest", F.explode(part).alias("p")).select(
            "digest", F.col("p.s").alias("at"), F.expr(f"p.s div {scope}").alias("home"))
        cells = placed.groupBy("digest", "home").agg(F.min("at").alias("low"), F.max("at").alias("high"))
        reach = cells.select("digest", "low", "high", F.explode(F.expr("array(home - 1, home, home + 1)")).alias("cell"))
        # From the cell before only its last start can be near, from the one after its first.
        close = F.expr(f"least(abs(s - low), abs(s - high)) <= {scope} OR (low <= s AND s <= high)")
        near = near.join(reach, ["digest", "cell"]).where(close).select("digest", "s", "e", "cell").distinct()
    return near.groupBy("digest").agg(F.collect_set(F.struct("s", "e")).alias("linked"))


def find(docs: DataFrame, carry: Sequence[str] = ("doc_id",), scope: int = SCOPE) -> DataFrame:
    """Every document with its spans by start: ``doc``, ``base`` and ``spans``.

    A span is (s, k, e): its start, the place of its kind in ``KINDS``, its end. A null text
    counts as empty and has none. Copies of a text are linked once and share the result.
    """
    scanned = written(scan(docs, carry), "secrets")
    linked = link(scanned, scope)
    base = "sort_array(concat(" + ", ".join(_kind(k, i) for i, k in enumerate(KINDS[:3])) + "))"
    found = scanned.join(linked, "digest", "left").select("doc", F.expr(base).alias("base"), "linked")
    return found.select(
        "doc",
        "base",
        F.expr(f"if(linked is null, base, sort_array(concat(base, {_kind('linked', 3)})))").alias("spans"),
    )


def spans_text(column: str) -> Column:
    """kind:start:end, joined by commas."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({column}, x -> concat_ws(':', get(array({names}), x.k), x.s, x.e)), ',')")


def masked(text: str, spans: str, mask: str = "[SECRET]") -> Column:
    """The text with each span replaced; overlapping spans are replaced as one."""
    return F.expr(f"""
        if(size({spans}) = 0, {text},
          aggregate({spans}, named_struct('at', 0, 'out', cast(array() as array<string>)),
            (a, x) -> if(x.e <= a.at, a, named_struct('at', x.e, 'out',
              if(x.s < a.at, a.out,
                concat(a.out, array(substring({text}, a.at + 1, x.s - a.at), '{mask}'))))),
            a -> array_join(a.out, '') || substring({text}, a.at + 1)))""")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked, with the columns of documents."""
    found = find(docs, ["doc_id", "text", "lang", "source", "n_chars"])
    clean = found.withColumn("text", F.when(F.size("spans") == 0, F.col("doc.text")).otherwise(masked("doc.text", "spans")))
    n_chars = F.when(F.size("spans") == 0, F.col("doc.n_chars")).otherwise(F.length("text").cast("long"))
    return clean.select("doc.doc_id", "text", "doc.lang", "doc.source", n_chars.alias("n_chars"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    of_kind = lambda k: F.expr(f"size(filter(base, x -> x.k = {k}))").cast("long")
    return find(table(spark, sf_dir, "documents")).select(
        "doc.doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(spans_text("base"), 256).alias("base_sha256"),
        spans_text("spans").alias("spans"),
    )

"""Document fingerprints: a Merkle tree over sections and paragraphs.

Sections are parted by blank lines, paragraphs by line breaks. A paragraph's digest is that of
its text, a section's that of its paragraphs' digests and of the line that parts it from the next,
and the root's that of the sections'. Nothing of the text is left out, so equal roots mean equal
texts; where roots differ, differing branches name the sections and paragraphs that were
edited. Under the paragraphs lie marks of short phrases, up to eight words within a sentence, by
which two fingerprints are likened.

A fingerprint is written ``root|sections|phrases``: sections parted by ``;``, the paragraphs
within by ``,``, digests in hex. ``~`` and a digest follow a section that ends in anything but one
empty line. Branches are cut to ``BRANCH`` digits: two different ones are taken for equal with a
chance of 2**-48 each, the roots being whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import shuffle_count, table, text_of, written

PHRASE = r"(?:\S*[^\s.!?][ \t]+){0,7}\S+"
SECTION = r"\n[ \t]*\n"
BRANCH = 12  # hex digits of a paragraph's digest in the fingerprint


def phrases(text: str) -> Column:
    """Distinct marks of a text's phrases, 32 bits each."""
    pattern = PHRASE.replace("\\", "\\\\")
    return F.expr(
        f"array_distinct(transform(regexp_extract_all({text}, '{pattern}', 0),"
        f" x -> cast(shiftright(xxhash64(x), 32) as int)))")


def fingerprint(text: str, marks: str) -> Column:
    section = SECTION.replace("\\", "\\\\")
    # The lines of each section and, but for the last, what parts it from the next.
    tree = (
        f"zip_with(split({text}, '{section}', -1), regexp_extract_all({text}, '{section}', 0), (s, g) ->"
        f" named_struct('p', transform(split(s, '\\n', -1), p -> sha2(p, 256)),"
        f" 'g', if(g is null or g = '\\n\\n', '', sha2(g, 256))))")
    return F.expr(f"""
        concat_ws('|',
          sha2(array_join(transform({tree}, s -> sha2(concat(array_join(s.p, ','), ':', s.g), 256)), ';'), 256),
          array_join(transform({tree}, s -> concat(
            array_join(transform(s.p, p -> left(p, {BRANCH})), ','),
            if(s.g = '', '', concat('~', left(s.g, {BRANCH}))))), ';'),
          array_join(transform({marks}, m -> right(concat('0000000', hex(m)), 8)), ''))""")


def likeness(a: str, b: str) -> Column:
    """Twice the shared phrases by all phrases of both; 1 where neither has any."""
    return F.expr(f"""
        if(size({a}) + size({b}) = 0, 1.0D,
          2.0D * size(array_intersect({a}, {b})) / (size({a}) + size({b})))""")


def fingerprint_marks(fingerprint: str) -> Column:
    """The phrase marks that a fingerprint holds."""
    return F.expr(
        f"filter(transform(sequence(0, length(split({fingerprint}, '[|]')[2]) div 8),"
        f" i -> substring(split({fingerprint}, '[|]')[2], i * 8 + 1, 8)), x -> x != '')")


def edits(a: str, b: str) -> Column:
    """Where two fingerprints differ: (section, paragraph) places, from 0, where the branches do.

    Empty when the roots are equal. What parts a section from the next counts as the place after
    its last paragraph where it is more than an empty line.
    """
    side = lambda f: f"transform(split(split({f}, '[|]')[1], ';', -1), s -> split(s, '[,~]', -1))"
    return F.expr(f"""
        if(split({a}, '[|]')[0] = split({b}, '[|]')[0], cast(array() as array<struct<section:int,paragraph:int>>),
          flatten(transform(
            zip_with({side(a)}, {side(b)}, (x, y) ->
              zip_with(coalesce(x, array()), coalesce(y, array()), (p, q) -> not (p <=> q))),
            (differ, i) -> transform(
              filter(transform(differ, (d, j) -> if(d, j, -1)), j -> j >= 0),
              j -> named_struct('section', i, 'paragraph', j)))))""")


FIRST = "-9223372036854775808L"


def successors(ids: DataFrame) -> DataFrame:
    """Each distinct ``k`` with the next larger one, the smallest after the largest.

    The keys are dealt by range and the deal is kept, so that each range finds its own
    successors; only the ranges' first keys are ordered in one place.
    """
    spark = ids.sparkSession
    dealt = ids.repartitionByRange(shuffle_count(spark), "k").withColumn("range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    heads = dealt.groupBy("range").agg(F.min("k").alias("head"))
    # As many rows as there are shuffle partitions.
    ahead = heads.selectExpr(
        "range", "coalesce(lead(head) OVER (ORDER BY range), min(head) OVER ()) AS ahead")
    return dealt.selectExpr("*", "lead(k) OVER (PARTITION BY range ORDER BY k) AS within").join(
        ahead, "range").selectExpr("k", "half", "coalesce(within, ahead) AS next")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and of the document that follows.

    A null text counts as empty. The edited text has its last half replaced by the start of the
    next document by doc_id. Rows of one doc_id share their successor; where a successor has
    several rows, the smallest text stands for it. A null doc_id counts as the smallest. With a
    single doc_id a document follows itself. ``edited_places`` are the differing branches of the
    text's tree and the edited text's.
    """
    texts = docs.select(
        F.expr(f"coalesce(cast(doc_id as long), {FIRST})").alias("k"), text_of().alias("text"))
    ids = texts.groupBy("k").agg(F.expr("cast(max(length(text)) div 2 as int)").alias("half"))
    marked = texts.select("k", "text", phrases("text").alias("marks"))
    following = successors(ids).selectExpr("k AS before", "half", "next")
    heads = (
        marked.join(following, marked["k"] == following["next"])
        .select("before", F.expr("substring(text, 1, half)").alias("head"), "text", "marks")
        .groupBy("before")
        .agg(F.min(F.struct(F.sha2("text", 256).alias("of"), "head", "marks")).alias("n"))
        .select("before", "n.head", F.col("n.marks").alias("next_marks"))
    )
    pairs = marked.join(heads, marked["k"] == heads["before"]).select(
        "k", "text", "marks", "next_marks", F.length("text").alias("n"), "head")
    edited = pairs.select(
        "*",
        F.expr("concat(substring(text, 1, n - n div 2), substring(head, 1, n div 2))").alias("edited"))
    edited = edited.select("*", phrases("edited").alias("edited_marks"))
    compared = edited.select(
        F.expr(f"nullif(k, {FIRST})").alias("doc_id"),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("text", "marks").alias("fingerprint"),
        fingerprint("edited", "edited_marks").alias("edited_fingerprint"),
        likeness("marks", "edited_marks").alias("near_edited"),
        likeness("marks", "next_marks").alias("near_next"),
    )
    return compared.select("*", edits("fingerprint", "edited_fingerprint").alias("edited_places"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))

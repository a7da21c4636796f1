"""Line deduplication with a log-template tree, in DataFrame operations only.

Every line is parsed to a fixed depth: its number of tokens and its first tokens, fields with digits masked,
name a leaf. In a leaf that several documents reach, a token stays where at least ``min_docs`` documents have it at
its position; all others become a variable field, and a position with more than ``choices`` such tokens is a field as
a whole. What results, if ``constant`` of its positions stay, is the line's template; any number of templates
share a leaf. A line that stays with too little is its own template, with digit fields masked.

A template recurs by the documents that hold it. Copies hold all their lines together, which makes no line boilerplate:
a document is a copy if sentences that ``min_docs`` documents hold make up half of its text. At least ``min_docs``
documents with texts of their own must hold a template, and at least one of ``one_in`` of all that hold it. All lines of
recurring templates are dropped, from copies too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.sizes import FEW, few
from pulsemark.session import cut

DEPTH, MIN_DOCS, CONSTANT, CHOICES, ONE_IN = 4, 3, 0.6, 8, 10
MASK = "<*>"


def _masked(text):
    """The lines, trimmed, with single blanks between tokens and a mask for fields with digits.

    The whole text is changed at once, and only where it has such characters.
    """
    def changed(found, new):
        return F.when(found, new).otherwise(F.col("x"))

    x = F.col("x")
    steps = [
        changed(x.contains("\t") | x.contains("\r"), F.translate(x, "\t\r", "  ")),
        changed(x.contains("  "), F.regexp_replace(x, " +", " ")),
        changed(x.rlike("[0-9]"), F.regexp_replace(x, r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", MASK)),
    ]
    docs = text.select("k", "x", F.col("x").alias("raw"))
    for step in steps:
        docs = docs.select("k", step.alias("x"), "raw")
    return docs.select("k", F.transform(F.split("x", "\n", -1), lambda y: F.trim(y)).alias("line"), "raw")


def _leaf(line, depth: int):
    """The hash of the number of tokens and the first ones; null if there are no more than these."""
    size = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    return F.when(size > depth, F.xxhash64(size, F.substring_index(line, " ", depth)))


def _parsed(texts: DataFrame, depth: int) -> DataFrame:
    """One row per document (k, x): the hashes of its lines in their places, its different lines with hashes and leaves,
    and the hashes and sizes of its different sentences with the size of them all.
    """
    ends = F.replace(F.replace("raw", F.lit("\n"), F.lit(".")), F.lit(". "), F.lit("."))
    sentences = F.array_distinct(F.array_remove(F.split(ends, r"\.", -1), ""))
    docs = _masked(texts).select(
        "k", F.transform("line", lambda y: F.xxhash64(y)).alias("places"), F.array_distinct("line").alias("line"),
        sentences.alias("s"))
    return docs.select(
        "k", "places", "line", F.transform("line", lambda y: F.xxhash64(y)).alias("hash"),
        F.transform("line", lambda y: _leaf(y, depth)).alias("leaf"),
        F.transform("s", lambda y: F.xxhash64(y)).alias("s"), F.transform("s", lambda y: F.length(y)).alias("n"),
        F.length(F.array_join("s", "")).cast("long").alias("total"))


def _copies(parsed: DataFrame, min_docs: int) -> DataFrame:
    """(k) of the documents of which sentences in ``min_docs`` documents make up half or more."""
    often = cut(parsed.select(F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("docs")).where(
        F.col("docs") >= min_docs).select("s"))
    sizes = parsed.select("k", "n", "total", F.posexplode("s").alias("at", "s")).select("k", "s", F.get("n", "at").alias("n"), "total")
    held = sizes.join(few(often), "s").groupBy("k").agg(F.sum("n").alias("n"), F.max("total").alias("total"))
    return held.where("n * 2 >= total").select("k")


def _templates(parsed: DataFrame, held: DataFrame, depth: int, min_docs: int, constant: float, choices: int) -> DataFrame:
    """Rows (hash, template) of the masked lines that keep enough of their tokens in their leaf.

    Only leaves that enough documents with texts of their own reach can hold a template that recurs.
    """
    leaves = held.where("leaf is not null").groupBy("leaf").agg(
        F.count_if(F.col("copy").isNull()).alias("own"), F.min("hash").alias("h0"), F.max("hash").alias("h1"))
    wanted = few(cut(leaves.where(f"own >= {min_docs} and h0 <> h1").select("leaf")))
    lines = parsed.select("line", "hash", F.posexplode("leaf").alias("at", "leaf")).where("leaf is not null").select(
        F.get("line", "at").alias("line"), F.get("hash", "at").alias("hash"), "leaf")
    distinct = lines.join(wanted, "leaf", "left_semi").groupBy("hash", "leaf").agg(
        F.min("line").alias("line"), F.count("*").alias("docs"))
    tokens = F.transform(F.split("line", " "), lambda t: F.xxhash64(t))
    fields = cut(distinct.select("hash", "leaf", "docs", tokens.alias("t")).select(
        "hash", "leaf", "docs", F.size("t").alias("size"), F.posexplode("t").alias("at", "token")).where(F.col("at") >= depth))
    votes = cut(fields.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("docs")).where(
        F.col("docs") >= min_docs).select("leaf", "at", "token"))
    kinds = votes.groupBy("leaf", "at").agg(F.count("*").alias("n")).where(F.col("n") > choices).select("leaf", "at")
    stay = cut(votes.join(few(cut(kinds)), ["leaf", "at"], "left_anti").withColumn("name", F.xxhash64("at", "token")))
    named = fields.join(few(stay), ["leaf", "at", "token"], "left").groupBy("hash", "leaf", "size").agg(
        F.count("name").alias("n"), F.bit_xor("name").alias("names"))
    return named.where(F.col("n") + depth >= constant * F.col("size")).select(  # a leaf has its first tokens in common
        "hash", F.xxhash64(F.lit("template"), "leaf", "names").alias("template"))


def drop_recurring(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH,
                   min_docs: int = MIN_DOCS, constant: float = CONSTANT, choices: int = CHOICES,
                   one_in: int = ONE_IN) -> DataFrame:
    """The rows with recurring lines taken out of the text, and ``n_lines`` and ``n_dropped`` added.

    Lines end at \\n; a line's tokens are split at spaces, tabs and \\r; lines without a token are never
    dropped and count for nothing. Sentences end at \\n and at full stops, and a document's different ones count, in
    characters. A null text stays null with 0 lines; an empty text is one empty line. Rows with the same id and text
    are copies of each other that hold a template once, and each is returned; a null id is an id like another. An empty
    table gives an empty result. Any columns besides are kept as they are, but columns called n_lines or
    n_dropped are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # The caller's columns travel in one struct, so that none has a name of this function's.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.xxhash64(
        F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).alias("k"), F.col(f"`{text_column}`").alias("x"))
    parsed = cut(_parsed(rows.where("x is not null").select("k", "x"), depth))
    copies = few(cut(_copies(parsed, min_docs).withColumn("copy", F.lit(1))))
    held = parsed.select("k", "leaf", F.posexplode("hash").alias("at", "hash")).where(
        F.col("hash") != F.xxhash64(F.lit(""))).select("k", "hash", F.get("leaf", "at").alias("leaf")).join(copies, "k", "left")
    general = cut(_templates(parsed, held, depth, min_docs, constant, choices))

    alone = held.groupBy("hash").agg(F.count_if(F.col("copy").isNull()).alias("own")).where(F.col("own") >= min_docs)
    named = alone.select("hash").join(general, "hash", "full")
    often = few(cut(named.select("hash", F.coalesce("template", "hash").alias("template"))))
    found = held.join(often, "hash").select("template", "k", "copy").distinct().groupBy("template").agg(
        F.count("*").alias("docs"), F.count_if(F.col("copy").isNull()).alias("own"))
    recurring = found.where((F.col("own") >= min_docs) & (F.col("own") * one_in >= F.col("docs")))
    bad = few(cut(often.join(recurring.select("template"), "template", "left_semi").select("hash")))
    places = parsed.select("k", F.posexplode("places").alias("at", "hash")).join(bad, "hash", "left_semi")
    places = cut(places.select("k", "at").distinct())
    dropped = places.groupBy("k").agg(F.collect_list("at").alias("drop"))
    if places.count() <= FEW:
        dropped = F.broadcast(dropped)

    # The lines are a column, as an expression inside the function would be computed again for each line.
    split = rows.join(dropped, "k", "left").withColumn(
        "lines", F.when(F.col("drop").isNotNull(), F.split("x", "\n", -1)))
    rest = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop"), lambda i: F.get("lines", i))
    text = F.when(F.col("drop").isNull(), F.col("x")).otherwise(F.array_join(rest, "\n"))
    ends = F.octet_length("x") - F.octet_length(F.replace(F.col("x"), F.lit("\n"), F.lit("")))
    return split.select(
        *[text.alias(c) if c == text_column else F.col("row").getField(c).alias(c) for c in kept],
        F.coalesce(ends + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))

"""Lines that repeat across documents, as keep bitmaps. Built-in functions only.

Every line becomes two 64-bit hashes of its key. The narrow table of hashes is dealt by ranges of
hash and document, sorted by hash, document and position, and written with the number of its range,
so a line that stands in a third of all documents is spread over many ranges, and the first occurrence
in each document is a streamed ``row_number() = 1``. Documents are counted with map-side sums. A key's
ranges are consecutive: a common key is copied to each of them, and its lines are found range by
range, so no task joins all lines of a key. The lines that go are gathered in one long for each 64
lines of a document: ``keep`` has the bit of every line that stays, up to the last word in which one
goes; documents that lose nothing have no row. Text isn't part of it.

With ``by_text`` the documents of one text are one document: a key is counted by different texts, and
copies of a text lose the same lines. With ``keep_first`` the first occurrence of a key stays, by
document and position; with both, it stays in all copies of the first text.

Defined results: NULL or empty text is one empty line, which has no key and stays. All rows without
id count as one document. Rows with the same id are one document for the count and keep a bitmap
each if their texts differ. No rows give no rows; further columns stay in :func:`kept_lines`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, materialise

#: What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
WORD = 64


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z in lower case. Only a line of ASCII goes
    through lower(), which knows other capitals too."""
    bare = F.btrim(line, F.lit(BLANKS))
    small = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(small)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def hashed_lines(docs: DataFrame, least_chars: int = 1) -> DataFrame:
    """``doc_id``, ``of_text``, ``pos``, ``h1``, ``h2`` of every line that has a key."""
    found = documents(docs).select("doc_id", _text_hash().alias("of_text"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = found.select("doc_id", "of_text", "pos", line_key(F.col("line")).alias("key"))
    keyed = keyed.filter(F.length("key") >= least_chars)
    return keyed.select("doc_id", "of_text", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"))


def keep_bitmaps(
    docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False, by_text: bool = False
) -> DataFrame:
    """``doc_id``, ``of_text``, ``n_dropped`` and ``keep`` of each document that loses lines.

    Keys of at least ``least_chars`` code points in at least ``least_docs`` documents (different texts
    with ``by_text``) lose all their lines, or with ``keep_first`` all but the first one.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unit, rest = ("of_text", ["doc_id", "pos"]) if by_text else ("doc_id", ["of_text", "pos"])
    ranged = hashed_lines(docs, least_chars).repartitionByRange(parts, "h1", "h2", unit).sortWithinPartitions("h1", "h2", unit, *rest)
    nth = F.row_number().over(Window.partitionBy("h1", "h2", unit).orderBy(*rest))
    lines = materialise(ranged.select("*", (nth == 1).alias("is_first"), F.spark_partition_id().alias("part")), "lines")
    place = F.struct("doc_id", "of_text", "pos")
    figures = [F.count(F.lit(1)).alias("n_docs"), F.min("part").alias("low"), F.max("part").alias("high")]
    if keep_first:
        figures.append(F.min(place).alias("first"))
    common = lines.filter("is_first").groupBy("h1", "h2").agg(*figures).filter(F.col("n_docs") >= least_docs)
    copies = common.withColumn("part", F.explode(F.sequence("low", "high")))
    gone = lines.join(copies, ["part", "h1", "h2"])
    if keep_first:
        here = F.struct("of_text", "pos") if by_text else place
        gone = gone.filter(~here.eqNullSafe(F.struct("first.of_text", "first.pos") if by_text else F.col("first")))
    bit = F.expr(f"shiftleft(1L, pos % {WORD})")
    words = gone.groupBy("doc_id", "of_text", F.expr(f"pos div {WORD}").alias("word")).agg(F.bit_or(bit).alias("bits"))
    gathered = words.groupBy("doc_id", "of_text").agg(
        F.sum(F.bit_count("bits")).alias("n_dropped"), F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")
    )
    dense = F.expr("""
        flatten(transform(words, (w, i) -> concat(
            array_repeat(-1L, int(w.word - if(i = 0, -1, words[i - 1].word) - 1)), array(~w.bits))))
    """)
    return gathered.select("doc_id", "of_text", F.col("n_dropped").cast("long").alias("n_dropped"), dense.alias("keep"))


def kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """For each document ``row``, a struct of all its columns, with ``n_lines``, ``n_dropped`` and
    ``kept``, the array of lines that stay."""
    own = bitmaps.select(F.col("doc_id").alias("of_id"), "of_text", F.col("n_dropped").alias("gone"), "keep")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.col("text").cast("string").alias("text"), _text_hash().alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("hash") == F.col("of_text"))
    lines = lines_of(F.col("text"))
    word = lambda i: F.get("keep", F.floor(i / WORD).cast("int"))
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i % WORD)
    stays = F.filter(lines, lambda _, i: F.coalesce(word(i).bitwiseAND(bit(i)) != 0, F.lit(True)))
    return rows.join(own, same, "left").select(
        "row",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("gone", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("keep").isNull(), lines).otherwise(stays).alias("kept"),
    )


def drop_common_lines(
    docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep_first: bool = False, by_text: bool = False
) -> DataFrame:
    """The documents with the text of the lines that stay, joined by a line break. With ``keep_first``,
    documents that have lost lines and have only blank ones left are dropped: all that they said
    stands in others."""
    kept = kept_lines(docs, keep_bitmaps(docs, least_docs, least_chars, keep_first, by_text))
    if keep_first:
        says = F.exists("kept", lambda line: F.length(line_key(line)) > 0)
        kept = kept.filter((F.col("n_dropped") == 0) | says)
    text = F.when(F.col("row.text").isNotNull(), F.array_join("kept", "\n")).alias("text")
    return kept.select(*(text if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))

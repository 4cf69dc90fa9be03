"""Lines repeated across documents, as per-document keep bitmaps.

A line's key is the line without white space at its ends, A-Z in lower case.
Keys travel as 128-bit hashes with document and position, never as text: the
hashes are range-partitioned with a secondary sort by document and position, and
one streaming pass over the sorted rows marks the first line of each document
and the first of all. A hash that many documents share is cut into ranges of
document ids, whose counts are then added up, so that no task holds it whole.
What comes back per document is a bitmap: bits of kept lines, of those words of
64 lines only that lose a line. Built-in expressions only.

A null or empty text is one empty line. Null ids count as one document that
comes before all others. Rows that share an id count as one document; each row
has its own bitmap, found by its id and the hash of its text, so that equal rows
share one. Keys that are too short or in too few documents lose nothing. An
empty table gives empty results. Only the two named columns are read; others
pass through :func:`without_dropped` unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twintext.llm.common import Scratch, fresh, let

_SPACE = " \t\n\v\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLOCK = 1024  # document ids to a range of a shared hash
_WORD = 64

#: Which lines of a repeated key stay.
FIRST, LARGEST_DOCUMENT = "first", "largest_document"


def line_key(line: Column) -> Column:
    """Stripped, A-Z in lower case; other letters stay as they are."""
    stripped = F.btrim(line, F.lit(_SPACE))
    # For text of one byte per character the faster built-in says the same.
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(
        F.translate(stripped, _UPPER, _UPPER.lower())
    )


def _lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """``(doc, row, pos, h1, h2)`` of all lines whose key is long enough."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(content).alias("row"),
        F.posexplode(F.split(content, "\n")).alias("pos", "line"),
    )
    keys = lines.where(F.char_length("line") >= min_chars).select(
        "doc", "row", "pos", line_key(F.col("line")).alias("key")
    )
    return keys.where(F.char_length("key") >= min_chars).select(
        "doc", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def _repeated(lines: DataFrame, min_docs: int) -> DataFrame:
    """``(h1, h2, first, largest)`` of the keys found in ``min_docs`` documents or more."""
    ranges = ["h1", "h2", "block"]
    streamed = Window.partitionBy(*ranges).orderBy("doc", "row", "pos")
    seen = F.lag(F.struct("doc")).over(streamed)
    marked = (
        lines.withColumn("block", F.floor(F.col("doc") / _BLOCK))
        .repartitionByRange(*ranges)
        .withColumn("new_doc", ~seen.eqNullSafe(F.struct("doc")))
        .where("new_doc")
    )
    return (
        marked.groupBy("h1", "h2")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.min(F.struct("doc", "row", "pos")).alias("first"),
            F.max("doc").alias("largest"),
        )
        .where(F.col("n_docs") >= min_docs)
        .drop("n_docs")
    )


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    keep: str = LARGEST_DOCUMENT,
) -> DataFrame:
    """``(doc, row, keep)`` for every document that loses a line.

    ``row`` is ``xxhash64(text)``; ``keep`` holds ``(word, bits)`` in order of
    ``word``: bit *i* of word *w* is 1 if line ``64 w + i`` stays. Words that
    are left out are all ones. ``keep=FIRST`` leaves only the first line of a
    repeated key, ``LARGEST_DOCUMENT`` all its lines in the largest id.
    """
    if keep not in (FIRST, LARGEST_DOCUMENT):
        raise ValueError(f"unknown rule {keep!r}")
    scratch = Scratch(docs.sparkSession, "line-dedup")
    # Written, as finding the ranges, dealing out the hashes and the join all read them.
    lines = scratch.write(_lines(docs, doc_id, text, min_chars), "lines")
    # Written, so that the join can split the lines of a hash that many documents share.
    repeated = scratch.write(_repeated(lines, min_docs), "repeated")
    if keep == FIRST:
        stays = F.struct("doc", "row", "pos").eqNullSafe(F.col("first"))
    else:
        stays = F.col("doc").eqNullSafe(F.col("largest"))
    one = F.lit(1).cast("long")
    bit = F.call_function("shiftleft", one, F.col("pos") % _WORD)
    words = (
        lines.join(repeated, ["h1", "h2"])
        .where(~stays)
        .groupBy("doc", "row", F.floor(F.col("pos") / _WORD).cast("int").alias("word"))
        .agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
    )
    return words.groupBy("doc", "row").agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep")
    )


def _dense(keep: Column) -> Column:
    """One word after the other, with all ones for those left out."""

    def filled(entries: Column) -> Column:
        def upto(e: Column, k: Column) -> Column:
            before = F.coalesce(F.get(entries, k - 1)["word"], F.lit(-1))
            return F.concat(
                F.array_repeat(F.lit(-1).cast("long"), e["word"] - before - 1), F.array(e["bits"])
            )

        return F.flatten(F.transform(entries, upto))

    return let(keep, filled)


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines whose bit is 1."""

    def chosen(words: Column) -> Column:
        def stays(_: Column, i: Column) -> Column:
            word = F.coalesce(F.get(words, (i / _WORD).cast("int")), F.lit(-1).cast("long"))
            return F.call_function("shiftright", word, i % _WORD).bitwiseAND(F.lit(1)) == 1

        return F.filter(lines, stays)

    return let(_dense(keep), chosen)


def with_kept_text(
    docs: DataFrame, bitmaps: DataFrame, names: tuple[str, str, str], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Add the kept text, the number of lines and the number of dropped ones under ``names``."""
    kept_text, n_lines, n_dropped = names
    row, doc, keep, kept = fresh(docs, "row", "doc", "keep", "kept")
    content = F.coalesce(F.col(text), F.lit(""))
    # The bitmaps are the smaller side by far: hashing them spares sorting the texts.
    marks = bitmaps.select(
        F.col("doc").alias(doc), F.col("row").alias(row), F.col("keep").alias(keep)
    ).hint("shuffle_hash")
    joined = docs.join(
        marks, F.col(doc).eqNullSafe(docs[doc_id]) & (F.col(row) == F.xxhash64(content)), "left"
    )
    lines = F.when(F.col(keep).isNotNull(), kept_lines(F.split(content, "\n"), F.col(keep)))
    breaks = F.char_length(content) - F.char_length(F.replace(content, F.lit("\n"), F.lit("")))
    columns = [F.col(c) for c in docs.columns]
    n = breaks.cast("long") + 1
    return joined.select(*columns, lines.alias(kept)).select(
        *columns,
        F.coalesce(F.array_join(kept, "\n"), content).alias(kept_text),
        n.alias(n_lines),
        (n - F.coalesce(F.size(F.when(F.col(kept).isNotNull(), F.col(kept))), n)).alias(n_dropped),
    )


def without_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **rule) -> DataFrame:
    """The documents with their dropped lines gone; all rows and columns stay."""
    names = fresh(docs, "kept_text", "n_lines", "n_dropped")
    kept = with_kept_text(docs, keep_bitmaps(docs, doc_id, text, **rule), tuple(names), doc_id, text)
    new = F.when(F.col(names[2]) > 0, F.col(names[0])).otherwise(F.col(text))
    return kept.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    """Per document: ``(doc_id, n_lines, n_dropped, kept_sha256)``."""
    docs = docs.select("doc_id", "text")
    kept = with_kept_text(docs, keep_bitmaps(docs), ("kept_text", "n_lines", "n_dropped"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))

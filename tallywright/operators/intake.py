"""File triage: which documents may go on, and the first reason why not."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed
from ..functions.text import fill, has_text
from .numbering import SLICE_ROWS, running_within

# How a document of the right kind starts, and how far in the mark may stand.
SIGNATURE = "%PDF-"
SIGNATURE_WINDOW = 1024
# An entry of that name with a reference or a dictionary; the bare word may stand in any text.
ENCRYPTION_MARK = "/Encrypt"
ENCRYPTION_ENTRY = ENCRYPTION_MARK + r"\s*(\d+\s+\d+\s+R\b|<<)"

EMPTY_FILE = "empty file"

# Characters of a segment of a file's text.
SEGMENT_CHARS = 1 << 20

# Bytes of the end of a file, and from where its last cross-reference starts, that are looked at (T5).
TAIL, REFERENCE = 16_384, 65_536


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(name: Column) -> Column:
    """From the last dot on, as written; a leading or trailing dot starts no suffix."""
    return F.regexp_extract(name, r"[^.].*?(\.[^./]+)$", 1)


def unopenable_detail(length: Column, head: Column) -> Column:
    """Why a file cannot be opened, or null. `head` is its first bytes."""
    text = F.decode(F.substring(head, 1, SIGNATURE_WINDOW), "ISO-8859-1")
    return F.when(length == 0, EMPTY_FILE).when(
        F.instr(text, SIGNATURE) == 0, f"no {SIGNATURE} signature"
    )


def _text(content: Column, first: Column, length: int) -> Column:
    """Bytes as text, one character each; only this stretch is looked at."""
    return F.decode(F.substr(content, first, F.lit(length)), "ISO-8859-1")


def trailer(content: Column) -> Column:
    """The dictionary a reader of the file starts from, as text; empty where there is none (T5).

    The last `startxref` names the place of the last cross-reference. That is a table, with the
    trailer behind it, or a stream, whose own dictionary is the trailer. Where a long table does not
    end in the stretch read, the trailer is the last one of the file's end, which also stands in for a
    place that cannot be found. Strings are blanked: an entry's name in a string is no entry.
    """
    tail = F.decode(F.substr(content, F.greatest(F.length(content) - TAIL + 1, F.lit(1))), "ISO-8859-1")
    place = F.regexp_extract(tail, r"(?s).*startxref\s+(\d{1,18})", 1).try_cast("bigint")
    place = F.when(place < F.length(content), place).cast("int")
    at = F.coalesce(_text(content, place + 1, REFERENCE), F.lit(""))
    behind = F.regexp_extract(at, r"(?s)^\s*xref\b.*?\btrailer\b(.*?)(?:startxref|$)", 1)
    stream = F.regexp_extract(at, r"(?s)^\s*\d+\s+\d+\s+obj\b(.*?)(?:\bstream\b|\bendobj\b|$)", 1)
    last = F.regexp_extract(tail, r"(?s).*\btrailer\b(.*)", 1)
    found = F.coalesce(*(F.nullif(x, F.lit("")) for x in (behind, stream, last)), F.lit(""))
    return F.regexp_replace(found, r"(?s)\((?:[^()\\]++|\\.)*+\)", "()")


def byte_facts(files: DataFrame, *more: str) -> DataFrame:
    """From `binaryFile` rows: `open_error` (T3) and `is_encrypted` (T5), and the columns `more`."""
    return files.select(
        "path",
        "length",
        *more,
        unopenable_detail(F.col("length"), F.col("content")).alias("open_error"),
        trailer(F.col("content")).rlike(ENCRYPTION_ENTRY).alias("is_encrypted"),
    )


def oversized_facts(files: DataFrame, limit: int) -> DataFrame:
    """The facts of files too long to read, from their listing alone."""
    return files.select(
        "path",
        "length",
        F.lit(f"longer than {limit} bytes").alias("open_error"),
        F.lit(False).alias("is_encrypted"),
    )


def page_facts(pages: DataFrame) -> DataFrame:
    """Per file: `page_count`, `is_encrypted`, `has_text_layer`.

    Counters only, so pages are reduced before the shuffle however many one file has.
    """
    return pages.groupBy("source_file").agg(
        F.count("*").alias("page_count"),
        F.bool_or(F.coalesce("is_encrypted", F.lit(False))).alias("is_encrypted"),
        F.bool_or(has_text(F.col("text"))).alias("has_text_layer"),
    )


def text_layer(
    pages: DataFrame, segment_chars: int = SEGMENT_CHARS, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Page texts of each file in page order, no separator (T6), in segments of bounded length.

    A page belongs to the segment in which it starts, `segment_chars` characters each, by the running
    offset of the pages before it; so a segment is at most that long and one page more, however long
    its file is, and the segments of a file spread over tasks. `start` is where a segment begins in
    the whole text, which is the segments in order. Pages with one number follow in order of their text.
    """
    texts = pages.select("source_file", "page_no", F.coalesce("text", F.lit("")).alias("text"))
    length = F.length("text").cast("bigint")
    placed = running_within(texts, "source_file", ["page_no", "text"], {"start": length}, slice_rows=slice_rows)
    segment = F.floor(F.col("start") / segment_chars).cast("int").alias("segment")
    ordered = F.array_sort(F.collect_list(F.struct("position", "text")))
    return (
        placed.groupBy("source_file", segment)
        .agg(
            F.min("start").alias("start"),
            F.count("*").alias("n_pages"),
            F.array_join(F.transform(ordered, lambda page: page["text"]), "").alias("text"),
            F.bool_or(has_text(F.col("text"))).alias("segment_has_text"),
        )
    )


def triage(files: DataFrame) -> DataFrame:
    """Add `is_valid` and `reason`; the first check that hits names the reason.

    Expects `source_file, on_disk, open_error, page_count, is_encrypted, has_text_layer`. Facts a
    file fails to reach are reset as if never read: no pages unless it opened, no text unless valid.
    """
    ending = suffix(F.col("source_file"))
    reason = (
        F.when(~F.col("on_disk"), fixed.MISSING_FILE)
        .when(F.lower(ending) != ".pdf", fill(fixed.WRONG_EXTENSION, suffix=ending))
        .when(F.col("open_error").isNotNull(), fill(fixed.UNOPENABLE, detail=F.col("open_error")))
        .when(F.coalesce("page_count", F.lit(0)) == 0, fixed.NO_PAGES)
        .when(F.coalesce("is_encrypted", F.lit(False)), fixed.ENCRYPTED)
        .otherwise(fixed.INTAKE_OK)
    )
    valid = F.col("reason") == fixed.INTAKE_OK
    counted = valid | (F.col("reason") == fixed.ENCRYPTED)
    return (
        files.withColumn("reason", reason)
        .withColumn("is_valid", valid)
        .withColumn("page_count", F.when(counted, F.col("page_count")).otherwise(0).cast("bigint"))
        .withColumn("has_text_layer", valid & F.coalesce("has_text_layer", F.lit(False)))
    )


def triage_counts(triaged: DataFrame) -> DataFrame:
    """One row: files seen, valid, invalid (T9); zeros for an empty folder."""
    return triaged.agg(
        F.count("*").alias("n_files"),
        F.count_if("is_valid").alias("n_valid"),
        F.count_if(~F.col("is_valid")).alias("n_invalid"),
    )

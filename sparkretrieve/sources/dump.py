"""Page-dump ingest.

A MediaWiki dump is read with the *text* source split on ``</page>``: the
record delimiter works on bz2 input, which Hadoop splits at compression block
boundaries, so a 26 GB dump becomes many tasks (the XML source would read it
as one). Each record is cut from ``<page>`` and parsed by ``from_xml`` with a
fixed schema; records without ``<page>`` (the ``</mediawiki>`` tail) fall away.

Deviation: only a literal ``<page>`` start tag is recognised (MediaWiki never
writes attributes or prefixes on it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.session import file_system

PAGE_XML_SCHEMA = "title string, id string, revision struct<id: string, timestamp: string, text: string>"
# A malformed page is an error, as for any XML parser; it never just disappears.
XML_OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}


# The largest limit whose pages pass through the driver, and how many bytes of
# small files are read at once for it.
MAX_TAKEN = 10_000
SMALL_FILES = 64 << 20


def page_records(lines: DataFrame) -> DataFrame:
    """(pos, xml) for every record holding a page start tag. ``pos`` is its place
    in the dump: the file's path, where its split begins in the file, and its
    number among the records of its task. A task reads each split in order and
    the parts of its number that count splits are those of one file, so the
    order does not depend on how large the files are or how they are packed."""
    start = F.instr(F.col("value"), "<page>")
    return lines.select(
        F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
                 F.monotonically_increasing_id().alias("number")).alias("pos"),
        F.when(start > 0, F.concat(F.expr("substring(value, instr(value, '<page>'))"), F.lit("</page>"))).alias("xml"),
    ).filter(F.col("xml").isNotNull())


def parse_pages(records: DataFrame) -> DataFrame:
    """A2 + D1: page fields; pages without a revision, or with an empty title,
    page id or revision id are dropped. Missing timestamp / text become ""."""
    p = F.from_xml(F.col("xml"), PAGE_XML_SCHEMA, XML_OPTIONS)
    # Behind an outer generator each page is parsed once; a plain projection
    # would be repeated in the filter that is pushed below it.
    parsed = records.select("pos", F.inline_outer(F.array(p)))
    valid = (
        F.col("revision").isNotNull()
        & (F.coalesce(F.col("title"), F.lit("")) != "")
        & (F.coalesce(F.col("id"), F.lit("")) != "")
        & (F.coalesce(F.col("revision.id"), F.lit("")) != "")
    )
    return parsed.filter(valid).select(
        "pos",
        "title",
        F.col("id").alias("page_id"),
        F.col("revision.id").alias("revision_id"),
        F.coalesce(F.col("revision.timestamp"), F.lit("")).alias("timestamp"),
        F.coalesce(F.col("revision.text"), F.lit("")).alias("text"),
    )


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, length) of a dump's files, in path order."""
    fs, target = file_system(spark, path)
    status = fs.getFileStatus(target)
    found = [s for s in fs.listStatus(target) if s.isFile()] if status.isDirectory() else [status]
    named = sorted((s.getPath().toString(), int(s.getLen())) for s in found)
    return [(p, n) for p, n in named if not p.rsplit("/", 1)[-1].startswith(("_", "."))]


def _in_order(spark: SparkSession, paths: list[str]) -> DataFrame:
    return parse_pages(page_records(spark.read.option("lineSep", "</page>").text(paths)))


def _first_pages(spark: SparkSession, path: str, limit: int) -> list:
    """The first ``limit`` valid pages in dump order, as rows. Files are read in
    path order until there are enough. Of a large file ``take`` runs its first
    split and then a few more at a time (Spark keeps the order of the equally
    long splits of one file); small files are read several at a time."""
    rows: list = []
    files = _files(spark, path)
    at = 0
    while at < len(files) and len(rows) < limit:
        part, size = [files[at][0]], files[at][1]
        while size < SMALL_FILES and at + len(part) < len(files):
            size += files[at + len(part)][1]
            part.append(files[at + len(part)][0])
        missing = limit - len(rows)
        if len(part) == 1:
            pages = _in_order(spark, part)
            found = pages.take(missing)
            if [r["pos"] for r in found] != sorted(r["pos"] for r in found):
                found = pages.orderBy("pos").limit(missing).collect()
        else:
            found = _in_order(spark, part).orderBy("pos").limit(missing).collect()
        rows += found
        at += len(part)
    return rows


def read_pages(spark: SparkSession, path: str, limit: int | None = None, *, with_position: bool = False) -> DataFrame:
    """A1: pages of a dump file or folder (.xml or .xml.bz2), with their place
    in the dump (``pos``) on request.

    ``limit`` keeps the first N *valid* pages in dump order: path, then place
    in the file. Up to ``MAX_TAKEN`` of them are fetched by reading files in
    that order and stopping early; more are a top-N over the whole dump."""
    pages = _in_order(spark, [path])
    if limit is not None and limit <= MAX_TAKEN:
        pages = spark.createDataFrame(_first_pages(spark, path, limit), pages.schema)
    elif limit is not None:
        pages = pages.orderBy("pos").limit(limit)
    return pages if with_position else pages.drop("pos")


def pages_to_documents(pages: DataFrame, *keep: str) -> DataFrame:
    """Fixed page -> canonical document mapping (and columns to ``keep``)."""
    return pages.select(
        F.concat(F.lit("wikipedia_"), F.col("page_id")).alias("document_id"),
        F.lit("wikipedia").alias("source"),
        F.col("page_id").alias("source_id"),
        "title",
        F.col("revision_id").alias("version"),
        F.col("timestamp").alias("updated_at"),
        "text",
        F.create_map(F.lit("page_id"), F.col("page_id"), F.lit("revision_id"), F.col("revision_id")).alias("metadata"),
        *keep,
    )


def ingest_manifest(documents: DataFrame, output_dir: str) -> DataFrame:
    """One row per saved document; ``output_path`` is the logical record path."""
    return documents.select(
        "document_id", "source", "source_id", "title", "version", "updated_at",
        F.concat(F.lit(output_dir.rstrip("/") + "/"), F.col("document_id"), F.lit(".json")).alias("output_path"),
        F.lit("saved").alias("status"),
    )


def xml_escape(c):
    """Text -> XML character data (``&``, ``<``, ``>``)."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def page_xml(title, page_id, revision_id, timestamp, text):
    """A ``<page>`` element in the dump layout (used to write dumps)."""
    return F.concat(
        F.lit("  <page>\n    <title>"), xml_escape(title), F.lit("</title>\n    <ns>0</ns>\n    <id>"),
        page_id, F.lit("</id>\n    <revision>\n      <id>"), revision_id,
        F.lit("</id>\n      <timestamp>"), timestamp,
        F.lit("</timestamp>\n      <contributor><username>x</username><id>0</id></contributor>\n"
              "      <text bytes=\"0\" xml:space=\"preserve\">"),
        xml_escape(text), F.lit("</text>\n    </revision>\n  </page>"),
    )

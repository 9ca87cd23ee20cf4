"""Web archives (WARC 1.1): writing, reading, and resolution of revisits.

An archive is a folder of gzip files, each a sequence of records. A record's
header ends with two line breaks, its block has the length that the header
states, and two line breaks follow. Spark's text writer and reader do the
storage with those two line breaks as line separator: the writer puts them
behind each record, the reader cuts the file at each of them, wherever they
are, and a task puts the pieces together again and takes records off by their
stated length. So archives are read and written as a stream, one record in
memory at a time, in every store that Spark reaches; gzip files are never
split, so a task sees whole files, in order. Archives written elsewhere can be
read, too, if they are compressed.

``dedupe_archives`` needs no payload to decide: headers are shuffled by payload
digest, each digest's first response is the original, and the records that
repeat it are joined to it and written as revisits, with fresh headers that
name it. Only the counts of a digest decide whether it is *hot*; hot digests
are salted in the join, so no task gets all copies of a payload.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkretrieve.llm.common import free_name, map_batches, materialise
from sparkretrieve.operators.sizing import broadcast_if_bounded

MIN_BYTES = 100
# Payload bytes that a task hands on at once, and the share of an even
# partition from which on a key is hot.
HAND_ON = 16 << 20
HOT_SHARE = 0.25

# Fixed values of the format.
BREAK = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
# The row a record was made of; headers of other names are allowed.
ROW_HEADER = "X-Row-Id"

_HEADERS = {"record_id": "string", "record_type": "string", "row_id": "long", "uri": "string", "date": "string",
            "payload_digest": "string", "payload_bytes": "long", "refers_to_id": "string",
            "refers_to_uri": "string", "refers_to_date": "string"}


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _uri(c: Column) -> Column:
    """A URI without white space and control characters, which would break the
    header; they are percent-encoded."""
    for code in (*range(0x21), 0x7F):
        c = F.replace(c, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return c


def _record(kind: Column, payload: Column) -> Column:
    """A record as text for the writer; ``kind`` tells revisits, which have
    only the HTTP header as their block."""
    revisit = kind == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(BREAK))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.octet_length(payload))
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), kind, F.lit("\r\n"),
        _line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _line("WARC-Date", F.col("date")), _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            F.lit(f"WARC-Profile: {PROFILE}\r\n"),
            _line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_id"), F.lit(">"))),
            _line("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
            _line("WARC-Refers-To-Date", F.col("refers_to_date")))).otherwise(F.lit("")),
        _line(ROW_HEADER, F.col("row_id").cast("string")),
        F.lit(f"Content-Type: {HTTP_TYPE}\r\nContent-Length: "), block.cast("string"), F.lit(BREAK), http)
    body = F.when(revisit, F.lit(b"")).otherwise(payload)
    return F.concat(head.cast("binary"), body).cast("string")


def _write(records: DataFrame, path: str) -> None:
    records.select(_record(F.col("record_type"), F.col("payload")).alias("value")) \
        .write.option("lineSep", BREAK).option("compression", "gzip").text(path)


def write_responses(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                    payload_col: str = "html") -> None:
    """Write one response record per row into the new folder ``path``.

    A null payload counts as empty; a null id or URI leaves its header out.
    Record ids are random, so repeated rows have records of their own; other
    columns are not read."""
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    none = F.lit(None).cast("string")
    _write(pages.select(
        F.concat(F.lit("urn:uuid:"), F.uuid()).alias("record_id"), F.lit("response").alias("record_type"),
        F.col(f"`{id_col}`").cast("long").alias("row_id"), _uri(F.col(f"`{uri_col}`")).alias("uri"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
        payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), none.alias("refers_to_id"),
        none.alias("refers_to_uri"), none.alias("refers_to_date")), path)


class RecordStream:
    """Records off the pieces of a file that was cut at each double line break."""

    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.rest, self.mark = pieces, b"", BREAK.encode()

    def _take(self, n: int) -> bytes:
        parts, have = [self.rest], len(self.rest)
        while have < n:
            piece = next(self.pieces, None)
            if piece is None:
                raise ValueError("a record ends before its stated length")
            parts += [piece, self.mark]
            have += len(piece) + len(self.mark)
        data = b"".join(parts)
        self.rest = data[n:]
        return data[:n]

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """(headers by lower-case name, block) of each record."""
        while True:
            while (end := self.rest.find(self.mark)) < 0:
                piece = next(self.pieces, None)
                if piece is None:
                    if self.rest.strip():
                        raise ValueError("a record's header does not end")
                    return
                self.rest += piece + self.mark
            head, self.rest = self.rest[:end], self.rest[end + len(self.mark):]
            lines = head.decode("utf-8").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError("no record begins where the one before ends")
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            block = self._take(int(headers["content-length"]))
            if self._take(len(self.mark)) != self.mark:
                raise ValueError("a record is longer than stated")
            yield headers, block


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _payload(headers: dict[str, str], block: bytes) -> tuple[dict, bytes | None]:
    """A record's row, and its payload (none for a revisit). The digest of a
    payload is computed, and compared with the header's if that is SHA-256."""
    kind = headers.get("warc-type")
    http = headers.get("content-type", "").replace(" ", "").startswith("application/http")
    payload = block[block.find(b"\r\n\r\n") + 4:] if http and b"\r\n\r\n" in block else block
    method, _, stated = headers.get("warc-payload-digest", "").rpartition(":")
    digest, size = stated or None, None
    if kind == "revisit":
        payload = None
    else:
        digest, size = sha256(payload).hexdigest(), len(payload)
        if method.lower() in ("sha256", "sha-256") and stated.lower() != digest:
            raise ValueError(f"payload digest differs in record {headers.get('warc-record-id')}")
    row = headers.get(ROW_HEADER.lower())
    return {"record_id": _bare(headers.get("warc-record-id")), "record_type": kind, "row_id": int(row) if row else None,
            "uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"), "payload_digest": digest,
            "payload_bytes": size, "refers_to_id": _bare(headers.get("warc-refers-to")),
            "refers_to_uri": headers.get("warc-refers-to-target-uri"), "refers_to_date": headers.get("warc-refers-to-date")}, payload


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per response and revisit record of the compressed archives in
    ``path``: record_id, record_type, row_id, uri, date, payload_digest,
    payload_bytes (null for revisits, see ``resolve_revisits``), refers_to_id,
    refers_to_uri, refers_to_date and, with ``payloads``, payload (null for revisits). Records of other
    types are passed over. A broken record or a payload that does not match
    its SHA-256 header is an error; no record, no row."""
    schema = _HEADERS | ({"payload": "binary"} if payloads else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = {"file": None, "stream": None}

        def pieces() -> Iterator[bytes]:
            for batch in batches:
                for value, file in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    if file != held["file"]:
                        if held["stream"].rest.strip():
                            raise ValueError("an archive ends within a record")
                        held["file"] = file
                    yield value.as_py()

        cols: dict[str, list] = {c: [] for c in schema}
        size = 0
        held["stream"] = RecordStream(pieces())
        for headers, block in held["stream"]:
            if headers.get("warc-type") not in ("response", "revisit"):
                continue
            row, payload = _payload(headers, block)
            for c, values in cols.items():
                values.append(payload if c == "payload" else row[c])
            size += 256 + (len(payload or b"") if payloads else 0)
            if size > HAND_ON:
                yield cols
                cols, size = {c: [] for c in schema}, 0
        yield cols

    read = spark.read.option("lineSep", BREAK).option("pathGlobFilter", "*.gz").text(path) \
        .select(F.col("value").cast("binary"), F.xxhash64("_metadata.file_path").alias("file"))
    return map_batches(read, ", ".join(f"{c} {t}" for c, t in schema.items()), run, rows_per_batch=1024)


def _join_groups(rows: DataFrame, one: DataFrame, key: str, n: str, spread: Column) -> DataFrame:
    """``rows`` left-joined to ``one`` (unique in ``key``; ``n``: how many rows have
    it) without ``n``. Beyond a broadcast's bounds, the rows of a hot key are
    dealt over several copies of its partner by the hash of ``spread``."""
    small, fits = broadcast_if_bounded(one.drop(n))
    if fits:
        return rows.join(small, key, "left")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = one.agg(F.sum(n)).first()[0] or 0
    limit = max(64, int(HOT_SHARE * total / max(1, parts)))
    salt, copies = free_name(rows, "_salt"), free_name(rows, "_copies")
    # At most parts / HOT_SHARE keys have more rows than the limit.
    hot = F.broadcast(one.filter(F.col(n) > limit).select(key, F.ceil(F.col(n) / limit).cast("long").alias(copies)))
    dealt = rows.join(hot, key, "left") \
        .withColumn(salt, F.coalesce(F.pmod(F.xxhash64(spread), F.col(copies)), F.lit(0).cast("long"))).drop(copies)
    partner = one.withColumn(salt, F.explode(F.sequence(
        F.lit(0).cast("long"), F.when(F.col(n) > limit, F.ceil(F.col(n) / limit) - 1).otherwise(0).cast("long")))).drop(n)
    return dealt.join(partner, [key, salt], "left").drop(salt)


def find_originals(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(payload_digest, n, original struct<row_id, record_id, uri, date>) of the
    payloads of at least ``min_bytes`` that several records have, revisits
    included: the response with the smallest row id (null loses; then the
    smallest record id)."""
    order = F.struct(F.col("row_id").isNull().alias("none"), "row_id", "record_id", "uri", "date")
    return headers.filter(_shared(min_bytes)).groupBy("payload_digest") \
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("record_type") == "response", order)).alias("original")) \
        .filter("n > 1 and original is not null").withColumn("original", F.col("original").dropFields("none"))


def _shared(min_bytes: int) -> Column:
    """Records that an original can stand for; of a revisit only the digest is known."""
    return (F.col("record_type") == "revisit") & F.col("payload_digest").isNotNull() \
        | (F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes)


def _fresh(record_id: Column) -> Column:
    """The id of the record that takes another's place: the same each time."""
    h = F.md5(F.concat(F.lit("deduplicated "), record_id))
    return F.concat(F.lit("urn:uuid:"), *[x for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
                                          for x in (F.substring(h, a, b), F.lit("-"))][:-1])


def dedupe_archives(spark: SparkSession, source: str, target: str, min_bytes: int = MIN_BYTES) -> None:
    """Write the records of the archives in ``source`` to the new folder
    ``target``, each under a fresh id. A response whose payload (of at least
    ``min_bytes``) an original has becomes a revisit of it; a revisit of the
    source refers to the original of its digest or, if the source has none, to
    the fresh record of the response that it named. No archive, no record."""
    headers = materialise(read_archives(spark, source, payloads=False), "warc_headers")
    originals = materialise(find_originals(headers, min_bytes), "warc_originals")
    shared = headers.filter(_shared(min_bytes)).select("record_id", "payload_digest")
    joined = _join_groups(shared, originals, "payload_digest", "n", F.col("record_id"))
    revisits = joined.filter("original is not null and original.record_id != record_id").select("record_id", "original")
    revisits, _ = broadcast_if_bounded(materialise(revisits, "warc_revisits"))
    copy = F.col("original").isNotNull()
    records = read_archives(spark, source).join(revisits, "record_id", "left")
    _write(records.select(
        _fresh(F.col("record_id")).alias("record_id"), F.when(copy, F.lit("revisit")).otherwise(F.col("record_type")).alias("record_type"),
        "row_id", "uri", "date", F.coalesce("payload", F.lit(b"")).alias("payload"), "payload_digest",
        F.coalesce("payload_bytes", F.lit(0)).cast("long").alias("payload_bytes"),
        _fresh(F.when(copy, F.col("original.record_id")).otherwise(F.col("refers_to_id"))).alias("refers_to_id"),
        F.when(copy, F.col("original.uri")).otherwise(F.col("refers_to_uri")).alias("refers_to_uri"),
        F.when(copy, F.col("original.date")).otherwise(F.col("refers_to_date")).alias("refers_to_date")), target)


def resolve_revisits(headers: DataFrame) -> DataFrame:
    """The rows of ``read_archives`` (a written table) with payload_bytes of
    revisits taken from the response they refer to, and refers_to (long): that
    response's row id. A revisit whose response is not there keeps nulls."""
    headers = headers.drop("refers_to")
    uses = headers.filter("refers_to_id is not null").groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("n"))
    found = headers.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("row_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"))
    found = materialise(uses.join(found, "refers_to_id"), "warc_referred")
    joined = _join_groups(headers, found, "refers_to_id", "n", F.col("record_id"))
    return joined.select(*[F.coalesce("payload_bytes", "_bytes").alias(c) if c == "payload_bytes" else F.col(c)
                           for c in headers.columns], "refers_to")

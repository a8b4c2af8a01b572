"""Dictionary-compressed WARC archives.

A Zstandard dictionary is built from a bounded sample of the records to archive. Every archive begins with a skippable frame
that holds it, so an archive can be read alone; each record is a Zstandard frame of its own behind that.
Tasks write archives of their own rows into a shared folder and return a manifest; only archives in the
manifest count, so what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from streamloom.llm.common import bounded, fresh, hashed_sample, written
from streamloom.session import scratch
from streamloom.shipping import ship_by_value

#: Fixed values of the formats: the skippable frame that holds a dictionary, and the profile of a revisit.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The dictionary is built from so many records at most, none longer than this many bytes.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 32_768, 65_536
#: A task begins a new archive when it has written this many compressed bytes.
ARCHIVE_BYTES = 256 << 20
#: Digests with copies that are broadcast at most (about 80 bytes each); more are joined by shuffle.
MOST_DIGESTS = 100_000


def record(kind: str, key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, whose length is that of the full payload, and no payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if kind == "revisit" else head + payload
    fields = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:row:{'null' if key is None else key}>", f"WARC-Date: {date}"]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.translate({10: "%0A", 13: "%0D"}))
    if kind == "revisit":
        fields += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:row:{refers_to}>"]
    fields += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(sample: list[bytes]) -> bytes:
    """A dictionary for records like these; the records themselves where there are too few to learn from."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sample)[:DICTIONARY_BYTES]


def with_first_copy(pages: DataFrame, key: str, payload: str, shortest: int) -> DataFrame:
    """``pages`` with ``digest``, ``n_bytes`` and ``first``, the smallest key of equal payloads of at least ``shortest`` bytes.

    Only digests are grouped, and only those that occur twice are joined back.
    """
    rows = pages.withColumn(payload, F.coalesce(payload, F.lit("")))
    rows = rows.withColumn("digest", F.sha2(payload, 256)).withColumn("n_bytes", F.octet_length(payload).cast("long"))
    same, first = fresh(*rows.columns), "first"
    copies = rows.where(F.col("n_bytes") >= shortest).groupBy(F.col("digest").alias(same)).agg(F.min(key).alias(first), F.count("*").alias("n"))
    copies = bounded(written(copies.where("n > 1").drop("n"), "copies"), MOST_DIGESTS)
    return rows.join(copies, rows["digest"] == copies[same], "left").drop(same)


def write_archives(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url", payload: str = "html", shortest: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Archive every row and return the manifest: ``archive``, ``records``, ``bytes``.

    A NULL payload is an empty one; a NULL key is written as ``null`` and is first among copies only of
    itself. Rows that repeat the first key with the same payload are responses too. Other columns of
    ``pages`` are not archived. An empty table has an empty manifest.
    """
    from streamloom.llm.warc import record, train

    path = path or scratch(pages.sparkSession, "warc")
    rows = with_first_copy(pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload")), "key", "payload", shortest)
    rows = rows.withColumn("kind", F.when(F.col("first").isNull() | F.col("first").eqNullSafe(F.col("key")), "response").otherwise("revisit"))
    short = rows.where((F.col("kind") == "response") & (F.col("n_bytes") <= SAMPLE_BYTES))
    sample: list[Row] = hashed_sample(short, SAMPLE_RECORDS, "digest", "key").collect()
    dictionary = train([record(r.kind, r.key, r.url, r.payload.encode(), r.digest, r.first, date) for r in sample])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct
        import uuid

        import pyarrow as pa
        import zstandard
        from pyarrow import fs

        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        frame = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        out, name, records = None, "", 0
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            if out is not None:
                done.append((name, records, out.tell()))
                out.close()

        for batch in batches:
            columns = [batch.column(c) for c in ("kind", "key", "url", "payload", "digest", "first")]
            for kind, own, where, body, digest, first in zip(*columns):
                if out is None or out.tell() >= ARCHIVE_BYTES:
                    close()
                    name, records = f"{folder}/{uuid.uuid4().hex}.warc.zst", 0
                    out = store.open_output_stream(name, compression=None)
                    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
                data = record(kind.as_py(), own.as_py(), where.as_py(), body.as_py().encode("utf-8", "surrogatepass"), digest.as_py(), first.as_py(), date)
                out.write(frame.compress(data))
                records += 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), ("string", "int64", "int64"))], names=["archive", "records", "bytes"])

    manifest = written(rows.select("kind", "key", "url", "payload", "digest", "first").mapInArrow(write, "archive string, records long, bytes long"), "manifest")
    return manifest.withColumn("folder", F.lit(path))


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the archives of a manifest, each payload checked against its digest.

    ``key``, ``url``, ``record_type``, ``refers_to``, ``payload_digest``, ``payload_bytes`` (of the full
    payload, for revisits too) and, if asked for, ``payload`` (binary; NULL for revisits). A task reads archives as streams.
    """
    made = ["key", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", *["payload"] * with_payload]
    kinds = dict(key="int64", url="string", record_type="string", refers_to="int64", payload_digest="string", payload_bytes="int64", payload="binary")
    schema = "key long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long" + ", payload binary" * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import io
        import struct

        import pyarrow as pa
        import zstandard
        from pyarrow import fs

        number = lambda urn: None if urn is None or urn == "<urn:row:null>" else int(urn[9:-1])

        def records(stream) -> Iterator[tuple]:
            magic, size = struct.unpack("<II", stream.read(8))
            if magic != DICTIONARY_FRAME:
                raise ValueError("no dictionary in front of the archive")
            dictionary = zstandard.ZstdDecompressor().decompress(stream.read(size))
            trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
            text = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=trained).stream_reader(stream, read_across_frames=True), 1 << 20)
            while text.readline():
                fields = {}
                while (line := text.readline()) != b"\r\n":
                    name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
                    fields[name] = value
                head, _, payload = text.read(int(fields["Content-Length"])).partition(b"\r\n\r\n")
                text.read(4)
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload and digest differ: {fields['WARC-Record-ID']}")
                n_bytes = int(head.rpartition(b"Content-Length: ")[2])
                yield (number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, number(fields.get("WARC-Refers-To")), digest, n_bytes, payload if kind == "response" else None)

        for batch in batches:
            for folder, archive in zip(batch.column("folder"), batch.column("archive")):
                store, _ = fs.FileSystem.from_uri(folder.as_py())
                rows: list[tuple] = []
                held = 0
                with store.open_input_stream(archive.as_py(), compression=None) as stream:
                    for row in records(stream):
                        rows.append(row)
                        held += row[5]
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for n, c in zip(made, zip(*rows))], names=made)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for n, c in zip(made, zip(*rows))], names=made)

    n = max(1, manifest.count())
    return manifest.select("folder", "archive").repartition(n, "archive").mapInArrow(read, schema)


ship_by_value(__name__)

"""WARC archives in Zstandard: one frame per record behind a dictionary in the leading skippable frame.

Writing: pages are digested, later copies of a payload become revisits, and every task packs its rows into
archives of bounded size in a folder that all executors share; a manifest table lists what the successful tasks have
written. Reading: the manifest is dealt to the executors, which load the archives; each frame is located by its block
headers, decoded with the archive's dictionary and checked.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marajo.llm.arrow import as_bytes, small_batches, steps
from marajo.llm.shared import load, new_folder, save
from marajo.session import small_side, stash

#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Uncompressed bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
#: Tasks that read archives, unless there are fewer archives.
READ_TASKS = 50_000
DICTIONARY_BYTES = 16 << 10
#: Payloads, and bytes of each, from which an archive's dictionary is trained.
SAMPLES, SAMPLE_BYTES = 128, 4096

_DICTIONARY_MAGIC = 0x184D2A5D
_FRAME_MAGIC = 0xFD2FB528
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAME = "urn:page:"
_RECORDS = "page_id long, record_type string, target_uri string, refers_to long, payload_digest string, payload_bytes long, payload binary, archive string, problem string"


class InvalidRecord(ValueError):
    """A frame or record that breaks the format."""


# --- one record ---------------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; ``digest`` is the payload's SHA-1 in hex. A revisit carries the HTTP head only."""
    name = f"{_NAME}{'' if page_id is None else page_id}"
    target = "".join(f"%{ord(c):02X}" if c < "!" or c == "\x7f" else c for c in url or "") or name
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        *([f"WARC-Refers-To: <{_NAME}{refers_to}>", f"WARC-Profile: {_PROFILE}"] if refers_to is not None else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = head.decode("utf-8").split("\r\n")
    found = {}
    for line in rest:
        name, colon, value = line.partition(":")
        if not colon:
            raise InvalidRecord(f"no field in {line[:80]!r}")
        found[name.strip().lower()] = value.strip()
    return first, found


def _page(uri: str) -> int | None:
    if not uri.startswith(f"<{_NAME}") or not uri.endswith(">"):
        raise InvalidRecord(f"unknown record id {uri[:80]!r}")
    digits = uri[len(_NAME) + 1 : -1]
    return int(digits) if digits else None


def parse(data: bytes) -> dict:
    """The fields of one record, validated: version, mandatory headers, lengths, ending, digest."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise InvalidRecord("no end of headers")
    version, fields = _fields(head)
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise InvalidRecord(f"version {version[:20]!r}")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise InvalidRecord(f"no {name}")
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise InvalidRecord(f"record type {kind!r}")
    if not fields["content-length"].isdigit() or int(fields["content-length"]) != len(rest) - 4:
        raise InvalidRecord(f"block of {len(rest) - 4} bytes, header says {fields['content-length']}")
    if not rest.endswith(b"\r\n\r\n"):
        raise InvalidRecord("record doesn't end in two line ends")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    if not gap:
        raise InvalidRecord("no end of HTTP headers")
    size = int(_fields(http)[1].get("content-length", "-1"))
    algorithm, _, text = fields.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha1" or len(text) != 32:
        raise InvalidRecord("no SHA-1 payload digest")
    digest = base64.b32decode(text).hex()
    if kind == "response":
        if len(payload) != size:
            raise InvalidRecord(f"payload of {len(payload)} bytes, header says {size}")
        if hashlib.sha1(payload).hexdigest() != digest:
            raise InvalidRecord("payload digest differs")
    elif payload or "warc-refers-to" not in fields:
        raise InvalidRecord("a revisit has a payload or refers to nothing")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None,
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload if kind == "response" else None,
    }


# --- one archive --------------------------------------------------------------------------------------------


def train(payloads: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the first payloads, None where they are too few or too alike to train one."""
    samples = [p[:SAMPLE_BYTES] for p in payloads[:SAMPLES] if p]
    if len(samples) < 16:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, d=8, k=256)
    except zstandard.ZstdError:
        return None


def pack(records: list[bytes], payloads: list[bytes], level: int = 3) -> bytes:
    """An archive: the compressed dictionary in a skippable frame, if there is one, then a frame per record."""
    trained = train(payloads)
    parts = []
    if trained is not None:
        body = zstandard.ZstdCompressor(level=level).compress(trained.as_bytes())
        parts += [struct.pack("<II", _DICTIONARY_MAGIC, len(body)), body]
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True, write_checksum=True)
    return b"".join([*parts, *(packer.compress(r) for r in records)])


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that starts at ``at`` ends, from its header and block headers."""
    try:
        head = bytes(data[at : at + 18])
        end = at + zstandard.frame_header_size(head)
        checksum = zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError as e:
        raise InvalidRecord(f"no frame at byte {at}: {e}") from None
    last = False
    while not last:
        if end + 3 > len(data):
            raise InvalidRecord(f"frame at byte {at} is cut off")
        block = int.from_bytes(data[end : end + 3], "little")
        last = bool(block & 1)
        end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
    end += 4 * checksum
    if end > len(data):
        raise InvalidRecord(f"frame at byte {at} is cut off")
    return end


def unpack(data: bytes, report: bool = False):
    """The validated records of an archive, one from each frame; with ``report`` an invalid one gives its ``problem``."""
    try:
        yield from _unpack(data, report)
    except InvalidRecord as e:  # no frame can be told from here on
        if not report:
            raise
        yield {"problem": str(e)}


def _unpack(data: bytes, report: bool):
    view, at, trained = memoryview(data), 0, None
    while at < len(view):
        if len(view) - at < 8:
            raise InvalidRecord(f"{len(view) - at} stray bytes at {at}")
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(view):
                raise InvalidRecord(f"skippable frame at byte {at} is cut off")
            if magic == _DICTIONARY_MAGIC and at == 0:
                body = bytes(view[8 : 8 + size])
                if body[:4] == struct.pack("<I", _FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                trained = zstandard.ZstdCompressionDict(body)
            at += 8 + size
            continue
        end = frame_end(view, at)
        try:
            found = parse(zstandard.ZstdDecompressor(dict_data=trained).decompressobj().decompress(view[at:end]))
        except (zstandard.ZstdError, ValueError) as e:
            if not report:
                raise InvalidRecord(f"frame at byte {at}: {e}") from None
            found = {"problem": f"frame at byte {at}: {e}"}
        yield found
        at = end


# --- on Spark -----------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html`` (null: empty), ``digest`` and ``refers_to``: of equal payloads of
    ``REVISIT_BYTES`` or more, all but those with the largest page id refer to it."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long = rows.where(F.octet_length("html") >= REVISIT_BYTES)
    copies = long.groupBy("digest").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col("holder").isNotNull())
    copies = small_side(copies.select("digest", "holder"), "copies")
    holder = F.when(F.col("page_id").eqNullSafe(F.col("holder")), F.lit(None)).otherwise(F.col("holder"))
    return rows.join(copies, "digest", "left").select("page_id", "url", "html", "digest", holder.alias("refers_to"))


def write_archives(pages: DataFrame, root: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` as archives under ``root``, a URI that executors can write to; returns their manifest: ``uri``
    and ``records`` of each, a table that stays with the executors.

    ``root`` must be on a file system that pyarrow opens (file, hdfs, s3, gs). Null html is an empty payload, null
    ids and urls keep their rows, repeated rows are repeated records. Without rows there is no archive.
    """

    def write(batches):
        records: list[bytes] = []
        payloads: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict({"uri": [save(root, pack(records, payloads), ".warc.zst")], "records": pa.array([len(records)], pa.int64())})
            records.clear()
            payloads.clear()
            return made

        for batch in batches:
            for part in steps(batch, "html"):
                columns = [part.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
                for page_id, url, digest, refers_to, payload in zip(*columns, as_bytes(part.column("html")), strict=True):
                    records.append(record(page_id, url, payload, digest, refers_to, date))
                    if len(payloads) < SAMPLES and refers_to is None:
                        payloads.append(payload)
                    held += len(records[-1])
                    if held >= archive_bytes:
                        yield close()
                        held = 0
        if records:
            yield close()

    return stash(small_batches(with_revisits(pages)).mapInArrow(write, "uri string, records long"), "manifest")


def read_archives(manifest: DataFrame, payload: bool = True, invalid: str = "fail") -> DataFrame:
    """A row per record of the archives that ``manifest`` lists in its column ``uri``, read by the executors.

    The first invalid record fails the read; with ``invalid="report"`` it becomes a row whose ``problem`` says what is
    wrong and whose other columns are null but for ``archive``, and reading goes on with the next frame, or the next
    archive where the frame's end can't be found. ``payload=False`` leaves the payloads out after they are validated.
    A null ``uri`` names no archive, a repeated one is read again; other columns are not read. An empty manifest gives
    no rows.
    """
    if invalid not in ("fail", "report"):
        raise ValueError(f"invalid={invalid!r}")

    def read(batches):
        kind = pa.schema([
            ("page_id", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.int64()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("archive", pa.string()), ("problem", pa.string()),
        ])
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                rows, held = [], 0
                for row in unpack(load(uri), report=invalid == "report"):
                    held += len(row.get("payload") or b"")
                    rows.append(row | {"archive": uri} if payload else row | {"archive": uri, "payload": None})
                    if held > ARCHIVE_BYTES or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    listed = manifest.where(F.col("uri").isNotNull()).select("uri")
    # an archive is megabytes, its name is not: names are dealt out by their number
    return listed.repartition(min(max(listed.count(), 1), READ_TASKS)).mapInArrow(read, _RECORDS)


def round_trip(pages: DataFrame, payload: bool = False) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back: a row per record."""
    return read_archives(write_archives(pages, new_folder(pages.sparkSession, "warc")), payload)

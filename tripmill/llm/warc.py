"""Derivatives of WARC responses: linked metadata and plain-text conversion records.

Each response gives a ``metadata`` record (application/warc-fields: title, language,
source headers and digests, outgoing links) and a ``conversion`` record (text/plain).
Both refer to the response by its identifier, target and date; identifiers are derived
from the response's, so a repeated run writes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import ship

VERSION = "WARC/1.1"
#: Bytes of blocks that are handed on at once.
BATCH_BYTES = 4 << 20
RECORD = (
    "record_id string, type string, refers_to string, target_uri string, date string,"
    " content_type string, content_length long, block_digest string, payload_digest string,"
    " headers array<struct<name:string,value:string>>, block binary"
)
_TAG = r"""[^<>"']*+(?:"[^"]*"[^<>"']*+|'[^']*'[^<>"']*+)*+"""
# What stands between the name of an element and the end of its tag, as browsers read it. The
# scan goes on from where this stops, so tags that never end are read once and not once a tag.
_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+"""
_HIDDEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b"
    rf"{_INSIDE}(>.*?(?:</\1\s*>|\Z))?+",
    re.I | re.S,
)
_ELEMENT = re.compile(rf"<(?:/?([a-z][a-z0-9]*)\b|[!?]){_TAG}>", re.I)
# Elements that end a line of text.
_LINE = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section select table tbody"
    " td tfoot th thead title tr ul".split()
)
_TITLE = re.compile(r"<title\b[^<>]*>", re.I)
_TITLE_END = re.compile(r"</title", re.I)
_LANG = re.compile(r"""<html\b[^<>]*?\blang\s*=\s*["']?([\w-]+)""", re.I)
_ANCHOR = re.compile(rf"<a(?=[\s/])({_INSIDE})(>?)", re.I)
_ATTRIBUTE = re.compile(
    r"""([^\s=/"']++)(?:\s*+(=)\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))?+)?+"""
)


def digest(data: bytes) -> str:
    """SHA-1 in Base32, as digests are written in WARC headers."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _break(element: re.Match) -> str:
    return "\n" if (element[1] or "").lower() in _LINE else ""


def _shown(page: str) -> str:
    """The page without comments and elements that show no text."""
    return _HIDDEN.sub(lambda m: m[0] if m[1] and not m[2] else " ", page)


def plain_text(page: str) -> str:
    """The visible text: one line for each block, single spaces, entities resolved."""
    text = html.unescape(_ELEMENT.sub(_break, _shown(page)))
    return "\n".join(filter(None, (" ".join(line.split()) for line in text.split("\n"))))


def _href(attributes: str) -> str | None:
    """The value of the first ``href``; None without one."""
    for name, equals, *value in _ATTRIBUTE.findall(attributes):
        if equals and name.lower() == "href":
            return "".join(value)
    return None


def links(page: str, base: str | None) -> list[str]:
    """Targets of the page's links, resolved, in order, each once.

    Time grows with the length of the page, also where its tags never end.
    """
    found: dict[str, None] = {}
    for attributes, end in _ANCHOR.findall(_shown(page)):
        value = _href(attributes) if end else None
        if value is None:
            continue
        target = html.unescape(value).strip()
        try:
            found.setdefault(urljoin(base or "", target))
        except ValueError:  # not a URL, kept as written
            found.setdefault(target)
    return list(found)


def title_of(page: str) -> str | None:
    """The visible text of the first title that ends; None without one."""
    start = _TITLE.search(page)
    end = start and _TITLE_END.search(page, start.end())
    return plain_text(page[start.end() : end.start()]) if end else None


def _one_line(value: str) -> str:
    """A value that cannot end its header line."""
    return " ".join(value.splitlines()).strip()


def metadata(response: dict, page: str, payload_digest: str) -> bytes:
    """The block of the metadata record: named fields, one a line."""
    lang = _LANG.search(page)
    fields = [
        ("title", title_of(page)),
        ("languages-declared", lang[1].lower() if lang else None),
        ("source-payload-digest", payload_digest),
        *((f"source-{h['name'].lower()}", h["value"]) for h in response["headers"] or [] if h["name"]),
        *(("outlink", target) for target in links(page, response["target_uri"])),
    ]
    return "".join(f"{k}: {_one_line(v)}\r\n" for k, v in fields if v is not None).encode()


def derivatives(response: dict) -> Iterator[tuple]:
    """The two records of a response, as tuples in the order of ``RECORD``."""
    payload = response["payload"] or b""
    page = payload.decode("utf-8", "replace")
    payload_digest = response["payload_digest"] or digest(payload)
    made = (
        ("metadata", "application/warc-fields", metadata(response, page, payload_digest)),
        ("conversion", "text/plain;charset=utf-8", plain_text(page).encode("utf-8", "replace")),
    )
    for kind, content_type, block in made:
        name = uuid.uuid5(uuid.NAMESPACE_URL, f"{response['record_id']} {kind}")
        record_id, block_digest = f"<urn:uuid:{name}>", digest(block)
        values = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_id),
            ("WARC-Date", response["date"]),
            ("WARC-Target-URI", response["target_uri"]),
            ("WARC-Refers-To", response["record_id"]),
            ("WARC-Refers-To-Target-URI", response["target_uri"]),
            ("WARC-Refers-To-Date", response["date"]),
            ("WARC-Payload-Digest", payload_digest if kind == "metadata" else block_digest),
            ("WARC-Block-Digest", block_digest),
            ("Content-Type", content_type),
            ("Content-Length", str(len(block))),
        ]
        headers = [{"name": k, "value": _one_line(v)} for k, v in values if v is not None]
        yield (
            record_id, kind, response["record_id"], response["target_uri"], response["date"],
            content_type, len(block), block_digest, payload_digest, headers, block,
        )


def responses_of_pages(pages: DataFrame, date: str) -> DataFrame:
    """Pages (page_id, url, html) in the role of responses captured at ``date``.

    The identifier is derived from page_id and url. A null url is left out of the records,
    a null page is an empty payload.
    """
    name = F.sha1(F.concat_ws(" ", F.col("page_id").cast("string"), F.coalesce("url", F.lit(""))))
    record_id = F.concat(
        F.lit("<urn:uuid:"),
        F.regexp_replace(name, r"^(.{8})(.{4}).(.{3}).(.{3})(.{12}).*$", "$1-$2-5$3-8$4-$5"),
        F.lit(">"),
    )
    payload = F.coalesce("html", F.lit("")).cast("binary")
    header = F.struct(F.lit("content-type").alias("name"), F.lit("text/html;charset=utf-8").alias("value"))
    return pages.select(
        "page_id",
        record_id.alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.array(header).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
        payload.alias("payload"),
    )


def derive(responses: DataFrame, carry: str = "page_id") -> DataFrame:
    """Two records for each response, with the ``carry`` column first. Starts no exchange.

    ``responses`` has record_id, target_uri, date, headers (name and value), payload_digest
    (null: computed) and payload. A null payload is empty; null targets, dates and headers
    are left out; repeated rows give repeated records; an empty table gives none. Other
    columns are not read.
    """
    ship(responses.sparkSession)
    kind = responses.schema[carry].dataType.simpleString()
    columns = ["record_id", "target_uri", "date", "headers", "payload_digest", "payload"]
    schema = f"{carry} {kind}, {RECORD}"
    names = [part.split()[0] for part in re.split(r", (?![^<]*>)", schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own, size = [], [], 0
            for i, response in enumerate(batch.select(columns).to_pylist()):
                found = list(derivatives(response))
                rows.extend(found)
                own.extend([i] * len(found))
                size += sum(len(r[-1]) for r in found)
                if size >= BATCH_BYTES:
                    yield pack(batch, rows, own)
                    rows, own, size = [], [], 0
            if rows:
                yield pack(batch, rows, own)

    def pack(batch: pa.RecordBatch, rows: list[tuple], own: list[int]) -> pa.RecordBatch:
        text, header = pa.string(), pa.struct([("name", pa.string()), ("value", pa.string())])
        kinds = [text] * 6 + [pa.int64(), text, text, pa.list_(header), pa.binary()]
        carried = batch.column(0).take(pa.array(own))
        columns_ = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([carried, *columns_], names)

    return responses.select(carry, *columns).mapInArrow(run, schema)


def serialise(headers: list[dict], block: bytes) -> bytes:
    """One record as it stands in a file."""
    lines = [VERSION, *(f"{h['name']}: {h['value']}" for h in headers)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_bytes(records: DataFrame) -> DataFrame:
    """``records`` with record_bytes, ready to be concatenated into files."""
    ship(records.sparkSession)

    @F.arrow_udf("binary")
    def of(headers: pa.Array, blocks: pa.Array) -> pa.Array:
        pairs = zip(headers, blocks, strict=True)
        return pa.array([serialise(h.as_py(), b.as_py()) for h, b in pairs], pa.binary())

    return records.withColumn("record_bytes", of("headers", "block"))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield headers, data[start:stop]
        at = stop + 4

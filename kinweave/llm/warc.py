"""WARC derivatives: metadata and plain-text conversion records of responses.

Every response gives a metadata record (title, language, outlinks, the source's HTTP headers) and a
conversion record (its text). Both name the response in WARC-Refers-To, keep its target, date and payload
digest, and carry their own block digest; identifiers derive from the response's, so that a run
that is repeated after a lost executor yields the same records. Records are made where the response is: no shuffle.

Defined results: a null page is an empty one and gives two records with an empty title and text; a null URL
is an empty target; broken mark-up never fails (what is no tag stays text, what never ends hides nothing) and costs one pass; repeated rows give repeated
records; extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm.common import released, text_batches, text_slices

#: Extension fields of a derived record: the source's payload digest, and each of the source's HTTP header lines.
SOURCE_DIGEST, SOURCE_HEADER = "WARC-Refers-To-Payload-Digest", "WARC-Refers-To-Header"
#: The date of responses that bring none.
DATE = "1970-01-01T00:00:00Z"
FIELDS = {
    "record_type": "string", "record_id": "string", "refers_to": "string", "target_uri": "string", "warc_date": "string",
    "content_type": "string", "content_length": "long", "block_digest": "string", "source_digest": "string", "source_headers": "string", "block": "string",
}

_opening = re.compile(r"(?i)<!--|<(script|style|noscript|template|head)\b")
_breaks = re.compile(r"(?i)</?(?:p|div|br|hr|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|blockquote|pre)\b[^>]*>")
_tags = re.compile(r"</?[A-Za-z!?][^>]*>")
_title, _title_end = re.compile(r"(?i)<title\b[^>]*>"), re.compile(r"(?i)</title\s*>")
_root, _lang = re.compile(r"(?i)<html\b"), re.compile(r"(?i)\blang\s*=\s*[\"']?([A-Za-z-]+)")
_anchor, _target = re.compile(r"(?i)<a\b"), re.compile(r"(?i)(?<![\w-])href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_blank = re.compile(r"[^\S\n]+")
#: Bytes of records that are handed on at once.
BATCH_BYTES = 4_000_000


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def shown(page: str) -> str:
    """The page with a space for each comment and each hidden element; one that never ends hides nothing.

    One pass: what has no end from here on has none later either, so it is looked for once.
    """
    out, at, kept, endless = [], 0, 0, set()
    while m := _opening.search(page, at):
        name = (m[1] or "--").lower()
        end = -1
        if name not in endless:
            if name == "--":
                end = page.find("-->", m.end())
                end += 3 if end >= 0 else 0
            elif close := re.compile(rf"(?i)</{name}\s*>").search(page, m.end()):
                end = close.end()
        if end < 0:
            endless.add(name)
            at = m.end()
            continue
        out += [page[kept : m.start()], " "]
        at = kept = end
    return "".join([*out, page[kept:]])


def to_last_tag(page: str) -> tuple[str, str]:
    """The page up to the last closing bracket, and the rest: in the first part every tag ends, so tags are found in one pass."""
    end = page.rfind(">") + 1
    return page[:end], page[end:]


def plain_text(page: str) -> str:
    """The visible text of a page: one line for each block, white space collapsed, empty lines dropped."""
    marked, rest = to_last_tag(shown(page))
    text = html.unescape(_tags.sub(" ", _breaks.sub("\n", marked)) + rest)
    lines = (_blank.sub(" ", x).strip() for x in text.split("\n"))
    return "\n".join(x for x in lines if x)


def tags(page: str, name: re.Pattern) -> Iterator[tuple[int, int]]:
    """Start and end of each tag that begins with the pattern and has an end."""
    at = 0
    while m := name.search(page, at):
        at = page.find(">", m.end())
        if at < 0:
            return
        yield m.end(), at


def outlinks(page: str) -> list[str]:
    """Distinct targets of the anchors outside scripts and comments, in order; of several targets in a tag the first counts."""
    page, found = shown(page), []
    for start, end in tags(page, _anchor):
        if (m := _target.search(page, start)) and m.start() < end:
            found.append(html.unescape(next(x for x in (*m.groups(), "") if x is not None)).strip())
    return list(dict.fromkeys(x for x in found if x))


def title(page: str) -> str:
    start = _title.search(to_last_tag(page)[0])
    end = start and _title_end.search(page, start.end())
    return " ".join(html.unescape(page[start.end() : end.start()]).split()) if end else ""


def language(page: str) -> str:
    found = (_lang.search(page, start, end) for start, end in tags(page, _root))
    return next((m[1].lower() for m in found if m), "")


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def derive(source_id: str, uri: str, date: str, headers: str, body: str) -> list[dict]:
    """The metadata and the conversion record of one response."""
    source_digest = digest(body.encode("utf-8", "replace"))
    fields = [("title", title(body)), ("language", language(body)), ("source-payload-digest", source_digest)]
    fields += [("outlink", x) for x in outlinks(body)] + [("source-header", x) for x in headers.splitlines() if x]
    blocks = {
        "metadata": ("application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields)),
        "conversion": ("text/plain; charset=utf-8", plain_text(body)),
    }
    out = []
    for kind, (content_type, block) in blocks.items():
        raw = block.encode("utf-8", "replace")
        values = (kind, record_id(kind, source_id, source_digest), source_id, uri, date, content_type, len(raw), digest(raw), source_digest, headers, block)
        out.append(dict(zip(FIELDS, values, strict=True)))
    return out


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Pages as responses (key, record_id, target_uri, warc_date, headers, body)."""
    body = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    length = F.octet_length(body).cast("string")
    name = F.md5(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(url_col, F.lit("")), F.sha2(body.cast("binary"), 256)).cast("binary"))
    part = lambda a, n: F.substring(name, a, n)
    return pages.select(
        F.col(id_col).alias("key"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">")).alias("record_id"),
        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.concat(F.lit("HTTP/1.1 200 OK\nContent-Type: text/html; charset=utf-8\nContent-Length: "), length).alias("headers"),
        body.alias("body"),
    )


def derivatives(source: DataFrame, key: str = "key") -> DataFrame:
    """key and the fields of both records for every response."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, bodies in text_slices(batch.column(5)):
                others = [batch.column(i).slice(a, b - a).to_pylist() for i in range(1, 5)]
                flat = [r for row in zip(*others, bodies, strict=True) for r in derive(*(x or "" for x in row))]
                keys = batch.column(0).slice(a, b - a).take(pa.array([i for i in range(b - a) for _ in range(2)], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *(pa.array([r[f] for r in flat], pa.int64() if t == "long" else pa.string()) for f, t in FIELDS.items())], names=[key, *FIELDS])

    kind = source.schema[key].dataType.simpleString()
    rows = text_batches(source.select(key, "record_id", "target_uri", "warc_date", "headers", "body"))
    return rows.mapInArrow(lambda batches: released(run(batches)), f"`{key}` {kind}, " + ", ".join(f"{f} {t}" for f, t in FIELDS.items()))


def serialise(r: dict) -> bytes:
    """One record in WARC/1.1 form."""
    raw = r["block"].encode("utf-8", "replace")
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['warc_date']}", f"WARC-Target-URI: {r['target_uri']}"]
    if r["refers_to"]:
        lines += [f"WARC-Refers-To: {r['refers_to']}", f"WARC-Refers-To-Target-URI: {r['target_uri']}", f"WARC-Refers-To-Date: {r['warc_date']}"]
    lines += [f"{SOURCE_DIGEST}: {r['source_digest']}", *(f"{SOURCE_HEADER}: {x.strip()}" for x in r["source_headers"].splitlines() if x.strip())]
    lines += [f"WARC-Block-Digest: {r['block_digest']}", f"Content-Type: {r['content_type']}", f"Content-Length: {len(raw)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + raw + b"\r\n\r\n"


def members(records: DataFrame) -> DataFrame:
    """record_id and a gzip member for every record; members put one after another are a .warc.gz file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = list(FIELDS).index("block")
        for batch in batches:
            for a, b, _ in text_slices(batch.column(at)):
                rows = batch.slice(a, b - a).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([r["record_id"] for r in rows], pa.string()), pa.array([gzip.compress(serialise(r), mtime=0) for r in rows], pa.binary())], names=["record_id", "member"])

    return text_batches(records.select(*FIELDS)).mapInArrow(run, "record_id string, member binary")


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The headers (names in lower case, repeated ones one a line) and the block of each record of a file, compressed or not, one after another."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = (x.strip() for x in line.decode("utf-8", "replace").partition(":"))
            name = name.lower()
            headers[name] = f"{headers[name]}\n{value}" if name in headers else value
        yield headers, stream.read(int(headers.get("content-length", "0") or 0))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The responses of WARC files (a file is one task's work), with their own identifiers, dates and HTTP headers.

    A file is held compressed and unpacked record by record; about BATCH_BYTES of records are handed on at once.
    """
    names = ["key", "record_id", "target_uri", "warc_date", "headers", "body"]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(6)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for h, block in parse(batch.column(0)[i].as_py()):
                    if h.get("warc-type") == "response":
                        head, _, body = block.partition(b"\r\n\r\n")
                        rows.append((h.get("warc-record-id", ""), h.get("warc-record-id", ""), h.get("warc-target-uri", ""), h.get("warc-date", DATE), head.decode("utf-8", "replace").replace("\r\n", "\n"), body.decode("utf-8", "replace")))
                        held += len(block)
                    if held > BATCH_BYTES:
                        yield pack(rows)
                        rows, held = [], 0
                yield pack(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, ", ".join(f"{n} string" for n in names))

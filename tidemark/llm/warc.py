"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

Each response gives two records.  The *metadata* record
(``application/warc-fields``) has the page's title, language, character
set and outlinks, the source's HTTP status and headers, and its digests.
The *conversion* record (``text/plain``) has the visible text.  Both name
the response in ``WARC-Refers-To`` and each other in
``WARC-Concurrent-To``, and keep its target URI, date and payload digest.
Record ids are named by a page's key, URI and content, so a repeated run
gives the same records, and two captures of one page have their own.

All is one pass over the pages, without a shuffle.  ``write_warc`` has
every task write one file of gzip members, one for each record, under a
name of its own, renamed when it is whole; ``read_warc`` reads such files
back.

Null or empty pages give an empty text and a metadata record without
title; a null URI leaves out the header.  Line breaks in a URI are
percent-encoded and in header values replaced by spaces, so that no
record can forge a header.  Repeated rows give equal records.  An empty
table gives an empty result and no file.  A character set that cannot be
decoded with counts as UTF-8, a marked section as a comment; a start tag
that cannot stand in an unclosed ``svg`` ends it.  ``row`` holds the key,
and what other columns ``carry`` names.

Pages are read by the standard library's parser.  Ordinary text and tags
after each of its steps are read by one pattern, which takes only what
that parser reads alike; attributes are parsed where one is looked at.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import quoted, small_batches

SPACE = uuid.UUID("7f1c3f0e-5a7e-5f1a-9d55-0c6a3f6f2b10")  # names record ids
RECORDS = ("record_type string, record_id string, refers_to string, concurrent_to string, target_uri string, date string, "
           "content_type string, source_payload_digest string, payload_digest string, block_digest string, headers string, block binary")
NAMES = [column.split()[0] for column in RECORDS.split(", ")]
SKIPPED = frozenset(("script", "style", "noscript", "template", "svg", "iframe", "object", "head"))
IN_HEAD = frozenset(("html", "head", "title", "meta", "link", "base", "basefont", "bgsound", "style", "script", "noscript", "noframes", "template"))
# HTML's list of start tags that end foreign content.
BREAKOUT = frozenset(("b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4",
                      "h5", "h6", "head", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small",
                      "span", "strong", "strike", "sub", "sup", "table", "tt", "u", "ul", "var"))
INSIDE_SVG = frozenset(("foreignobject", "desc"))  # parts of an svg where HTML may stand
BLOCKS = frozenset(("address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure",
                    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre",
                    "section", "table", "td", "th", "title", "tr", "ul"))
READ = frozenset(("html", "meta", "base", "title", "a", "area", "img", "iframe", "script"))  # tags with more to them than text
# Elements whose content the parser of some Python version reads as text.
RAW = frozenset(("script", "style", "title", "textarea", "plaintext", "xmp", "iframe", "noembed", "noframes", "noscript"))
APART = READ | SKIPPED | RAW
VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>=][^\s>]*+)"""
ORDINARY = re.compile(  # text, and an end tag or a start tag
    r"([^<]*+)<(?:/([a-zA-Z][a-zA-Z0-9]*+)[ \t\n\r\f]*+>"
    rf"|([a-zA-Z][a-zA-Z0-9]*+)((?:[ \t\n\r\f]++[a-zA-Z][a-zA-Z0-9_:.-]*+(?:={VALUE})?+)*+)[ \t\n\r\f]*+(/?)>)")
ATTRIBUTE = re.compile(rf"([a-zA-Z][a-zA-Z0-9_:.-]*+)(?:=({VALUE}))?+")
# Links that urljoin gives back unchanged, and those it puts after scheme and host.
WHOLE = re.compile(r"https?://[a-z0-9-]+(?:\.[a-z0-9-]+)*+(?:/[\w~.%-]*+)*+")
ROOTED = re.compile(r"/[\w-]++(?:/[\w-]++)*+")
PAIRS = [a + b for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567" for b in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"]  # base 32


def as_responses(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html",
                 date: str = "1970-01-01T00:00:00Z", carry: list[str] | None = None) -> DataFrame:
    """Pages as response records: ``row`` (the key, or the columns of ``carry``), ``record_id``, ``target_uri``, ``date``,
    ``http`` (status line and headers) and ``payload``."""
    payload = F.coalesce(F.col(quoted(html)).cast("binary"), F.lit(b""))
    parts = [F.coalesce(F.concat(F.lit("="), F.col(quoted(c)).cast("string")), F.lit("-")) for c in (key, uri)]  # null is no text
    name = F.sha2(F.concat_ws("\n", F.lit("response"), *parts, F.length(payload).cast("string"), F.hex(F.xxhash64(payload))), 256)
    ident = F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (name.substr(a, n), F.lit("-"))][:-1], F.lit(">"))
    row = F.struct(*[F.col(quoted(c)) for c in (carry or [key])])
    return pages.select(row.alias("row"), ident.alias("record_id"), F.col(quoted(uri)).cast("string").alias("target_uri"),
                        F.lit(date).alias("date"), F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                                                            F.length(payload).cast("string"), F.lit("\r\n")).alias("http"), payload.alias("payload"))


def derivatives(responses: DataFrame) -> DataFrame:
    """Two rows per response: ``row`` and the columns of a record (see RECORDS)."""
    small_batches(responses.sparkSession)
    schema = T.StructType([responses.schema["row"], *T.StructType.fromDDL(RECORDS).fields])
    return responses.mapInArrow(derive, schema)


class Page(HTMLParser):
    """Visible text, title, language, links and character set of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.links: list[str] = []
        self.skipped: list[str] = []
        self.title, self.lang, self.charset, self.base = "", "", "", ""
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        if tag in READ:
            self.read_tag(tag, {k: v or "" for k, v in attrs})
        if self.skipped:
            if self.skipped[-1] == "svg":
                if tag in BREAKOUT:
                    self.skipped.pop()
                elif tag in INSIDE_SVG:
                    self.skipped.append(tag)
            if tag == "body" and "head" in self.skipped:  # a head that was never closed
                self.skipped.remove("head")
            if tag not in IN_HEAD:
                self.end_head()
        if tag in SKIPPED:
            self.skipped.append(tag)
        elif tag in BLOCKS:
            self.parts.append("\n")

    def read_tag(self, tag, values):
        if tag == "html":
            self.lang = self.lang or values.get("lang", "")
        elif tag == "meta":
            self.charset = self.charset or values.get("charset", "")
        elif tag == "base":
            self.base = self.base or values.get("href", "")
        elif tag == "title":
            self.in_title = "svg" not in self.skipped
        elif tag in ("a", "area"):
            if values.get("href"):
                self.links.append(values["href"])
        elif values.get("src"):
            self.links.append(values["src"])

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in self.skipped:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag in self.skipped:
            while self.skipped.pop() != tag:
                pass
        elif tag in BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        else:
            if self.skipped and not data.isspace():
                self.end_head()
            if not self.skipped:
                self.parts.append(data)

    def end_head(self):
        """HTML lets the end of a head and the start of a body be left out: what cannot stand in a head ends it."""
        while self.skipped and self.skipped[-1] == "head":
            self.skipped.pop()

    def ordinary(self, i):
        """Reads ordinary text and tags from place i on, if it is one, and returns the place after them."""
        if i < 0 or self.cdata_elem is not None:
            return i
        match, text, add = ORDINARY.match, self.rawdata, self.parts.append
        while found := match(text, i):
            data, ended, started, attrs, empty = found.groups()
            visible = not self.skipped and not self.in_title
            if data:
                data = unescape(data) if "&" in data else data
                add(data) if visible else self.handle_data(data)
            if ended:
                tag = ended.lower()
                if not visible:
                    self.handle_endtag(tag)
                elif tag in BLOCKS:
                    add("\n")
            else:
                tag = started.lower()
                if visible and tag not in APART:
                    if tag in BLOCKS:
                        add("\n")
                    i = found.end()
                    continue
                if tag in RAW:
                    return found.end(1)
                values = [(k.lower(), unescape(v[1:-1] if v[:1] in "'\"" else v)) for k, v in ATTRIBUTE.findall(attrs)] if tag in READ else []
                if empty:
                    self.handle_startendtag(tag, values)
                else:
                    self.handle_starttag(tag, values)
            i = found.end()
        return i

    def parse_starttag(self, i):
        return self.ordinary(super().parse_starttag(i))

    def parse_endtag(self, i):
        return self.ordinary(super().parse_endtag(i))

    def parse_pi(self, i):
        return self.ordinary(super().parse_pi(i))

    def parse_html_declaration(self, i):
        return self.ordinary(super().parse_html_declaration(i))

    def parse_marked_section(self, i, report=1):
        """Of any name: HTML has none and takes it for a comment, up to the text's end if it is not closed."""
        end = self.parse_bogus_comment(i, report)
        return len(self.rawdata) if end < 0 else end

    def parse_comment(self, i, report=1):
        """HTML's two abrupt ends, and a comment that is not closed, which goes up to the text's end."""
        for whole in ("<!-->", "<!--->"):
            if self.rawdata.startswith(whole, i):
                return self.ordinary(i + len(whole))
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 else self.ordinary(end)

    def updatepos(self, i, j):  # nobody asks for line numbers
        return j

    def text(self) -> str:
        lines = (tidy(line) for line in "".join(self.parts).split("\n") if line)
        return "\n".join(line for line in lines if line)


def tidy(text: str) -> str:
    """Its words, a space between them."""
    if "  " not in text and text.isprintable():  # no other white space than single spaces
        return text.strip(" ")
    return " ".join(text.split())


def parsed(payload: bytes, charset: str = "utf-8") -> Page:
    page = Page()
    try:
        text = payload.decode(charset, "replace")
    except (LookupError, UnicodeError):  # an unknown character set, or one that no text can be in
        text = payload.decode("utf-8", "replace")
    page.feed(text)
    page.close()
    return page


def digest(*data: bytes) -> str:
    """Of all the parts, one after the other."""
    sha = hashlib.sha1(usedforsecurity=False)
    for part in data:
        sha.update(part)
    raw, out = sha.digest(), "sha1:"
    for i in range(0, 20, 5):  # five bytes are eight digits
        n = int.from_bytes(raw[i:i + 5])
        out += PAIRS[n >> 30] + PAIRS[n >> 20 & 1023] + PAIRS[n >> 10 & 1023] + PAIRS[n & 1023]
    return out


def line(value: str | None) -> str:
    if value is None or value.isprintable():  # neither control characters nor line ends
        return (value or "").strip()
    return re.sub(r"[\x00-\x1f\x7f\x85\u2028\u2029]+", " ", value or "").strip()


def safe_uri(uri: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri or "")


def record_id(source: str | None, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{source} {kind}')}>"


def derive(batches):
    for batch in batches:
        rows, out = [], []
        for i, r in enumerate(batch.select(["record_id", "target_uri", "date", "http", "payload"]).to_pylist()):
            payload, http = r["payload"] or b"", r["http"] or ""
            source_digest, source_block = digest(payload), digest(http.encode(), b"\r\n", payload)
            declared = re.search(r"(?im)^content-type:.*?charset=[\"']?([\w.:-]+)", http)
            page = parsed(payload, declared[1] if declared else "utf-8")
            uri = safe_uri(r["target_uri"])
            ids = {k: record_id(r["record_id"], k) for k in ("metadata", "conversion")}
            base = urljoin(uri, page.base) if page.base else uri
            fields = [("title", " ".join(page.title.split())), ("language", page.lang), ("charset", page.charset or (declared[1] if declared else "")),
                      *[("outlink", x) for x in outlinks(base, dict.fromkeys(page.links))],
                      *[("source-http-header", x) for x in http.splitlines() if x],
                      ("source-payload-digest", source_digest), ("source-block-digest", source_block)]
            blocks = {"metadata": "".join([f"{k}: {x}\r\n" for k, v in fields if (x := line(v))]).encode(), "conversion": page.text().encode()}
            kinds = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}
            for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
                block = blocks[kind]
                block_digest = digest(block)
                about = {"record_type": kind, "record_id": ids[kind], "refers_to": r["record_id"], "concurrent_to": ids[other], "target_uri": uri or None,
                         "date": r["date"], "content_type": kinds[kind], "source_payload_digest": source_digest, "payload_digest": block_digest,
                         "block_digest": block_digest}
                rows.append(i)
                out.append(about | {"headers": headers(about, len(block)), "block": block})
        table = pa.Table.from_pylist(out, pa.schema([(n, pa.binary() if n == "block" else pa.string()) for n in NAMES]))
        row = batch.column("row").take(pa.array(rows, pa.int64()))
        yield from table.add_column(0, "row", row).combine_chunks().to_batches()


def outlinks(base: str, links) -> list[str]:
    """The links as seen from ``base``."""
    out, root = [], None
    for link in links:
        if ROOTED.fullmatch(link):
            if root is None:
                root = joined(base, "/a")[:-1]
            out.append(root + link[1:])
        else:
            out.append(link if WHOLE.fullmatch(link) else joined(base, link))
    return out


def joined(base: str, link: str) -> str:
    try:
        return safe_uri(urljoin(base, link.strip()))
    except ValueError:  # not a URI
        return safe_uri(link)


def headers(about: dict, length: int) -> str:
    named = [("WARC-Type", about["record_type"]), ("WARC-Record-ID", about["record_id"]), ("WARC-Date", about["date"]),
             ("WARC-Target-URI", about["target_uri"]), ("WARC-Refers-To", about["refers_to"]), ("WARC-Refers-To-Target-URI", about["target_uri"]),
             ("WARC-Refers-To-Date", about["date"]), ("WARC-Concurrent-To", about["concurrent_to"]),
             ("WARC-Source-Payload-Digest", about["source_payload_digest"]), ("WARC-Payload-Digest", about["payload_digest"]),
             ("WARC-Block-Digest", about["block_digest"]), ("Content-Type", about["content_type"]), ("Content-Length", str(length))]
    return "WARC/1.1\r\n" + "".join([f"{k}: {line(v)}\r\n" for k, v in named if v]) + "\r\n"


def write_warc(records: DataFrame, path: str) -> list[str]:
    """Write the records into files of the new folder ``path`` (shared by all executors); returns the files' names."""
    store, root = fs.FileSystem.from_uri(path)
    store.create_dir(root)
    written = records.select("headers", "block").mapInArrow(lambda batches: write_file(batches, path), "file string")
    return sorted(f"{path}/{r.file}" for r in written.collect())


def write_file(batches, path: str):
    store, root = fs.FileSystem.from_uri(path)
    name, out = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", None
    for batch in batches:
        for head, block in zip(batch.column("headers").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if out is None:
                out = store.open_output_stream(f"{root}/.{name}", compression=None)
            out.write(gzip.compress(head.encode() + block + b"\r\n\r\n", 2, mtime=0))
    if out is not None:
        out.close()
        store.move(f"{root}/.{name}", f"{root}/{name}.warc.gz")
        yield pa.RecordBatch.from_pydict({"file": [f"{name}.warc.gz"]})


def read_warc(spark: SparkSession, files: list[str]) -> DataFrame:
    """The records of the files: ``headers`` (map), ``block``; a file is read member by member."""
    paths = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))
    return paths.mapInArrow(read_files, "headers map<string,string>, block binary")


READ_BYTES = 1 << 15  # each member takes with it a copy of what is left of them


def members(source):
    """The gzip members of a stream, one at a time."""
    rest = b""
    while True:
        rest = rest or source.read(READ_BYTES)
        if not rest:
            return
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if not rest and not (rest := source.read(READ_BYTES)):
                raise ValueError("a WARC file ends inside a record")
            parts.append(member.decompress(rest))
            rest = member.unused_data
        yield b"".join(parts)


def read_files(batches):
    kind = pa.map_(pa.string(), pa.string())
    for batch in batches:
        for file in batch.column("file").to_pylist():
            store, name = fs.FileSystem.from_uri(file)
            heads, bodies, size = [], [], 0
            with store.open_input_stream(name, compression=None, buffer_size=1 << 20) as source:
                for record in members(source):
                    head, _, body = record.partition(b"\r\n\r\n")
                    named = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
                    heads.append(list(named.items()))
                    bodies.append(body[:int(named["Content-Length"])])
                    size += len(record)
                    if size > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(heads, kind), pa.array(bodies, pa.binary())], ["headers", "block"])
                        heads, bodies, size = [], [], 0
            if heads:
                yield pa.RecordBatch.from_arrays([pa.array(heads, kind), pa.array(bodies, pa.binary())], ["headers", "block"])

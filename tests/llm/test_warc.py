import base64
import gzip
import hashlib

import pytest
from pyarrow import fs

from tidemark.llm import warc
from tidemark.session import work_dir

PAGES = [
    (1, "http://a.example/x?y=1", "<!DOCTYPE html><html lang='fr'><head><meta charset=utf-8><title>A &amp; B\n c</title><style>p{}</style><script>var t='</p>';</script>"
        "</head><body><nav><a href='/one'>One</a><a href=two>Two</a></nav><!-- no --><p>Caf&eacute; &lt;b&gt; <b>bold</b>x<br>next<p>last", "r"),
    (2, None, None, "r"), (3, "", "", "r"), (4, "http://b.example/\r\nWARC-Type: forged", "<title>t</title><p>one</p>two<table><tr><td>c1<td>c2</table>", "r"),
    (5, "http://c.example/", "no tags at all", "r"), (6, "http://d.example/", "<p>" + "long text " * 20000, "r"), (7, "x", "<a href='http://[bad'>l</a><body><head>z</head>k", "r"),
    (None, "http://e.example/", "<p>null key</p>", "r"), (5, "http://c.example/", "no tags at all", "r"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, row string")


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records(pages):
    got = warc.derivatives(warc.as_responses(pages)).collect()
    assert len(got) == 2 * len(PAGES)
    by = {(g.row.page_id, g.record_type): g for g in got}
    text, meta = by[1, "conversion"], by[1, "metadata"]
    assert bytes(text.block).decode() == "OneTwo\nCafé <b> boldx\nnext\nlast"
    fields = bytes(meta.block).decode().split("\r\n")
    assert fields[:5] == ["title: A & B c", "language: fr", "charset: utf-8", "outlink: http://a.example/one", "outlink: http://a.example/two"]
    assert "source-http-header: Content-Type: text/html; charset=utf-8" in fields
    payload = PAGES[0][2].encode()
    assert f"source-payload-digest: {sha1(payload)}" in fields
    for g in got:
        other = by[g.row.page_id, "metadata" if g.record_type == "conversion" else "conversion"]
        assert g.refers_to == other.refers_to and g.concurrent_to == other.record_id and g.block_digest == sha1(bytes(g.block))
        assert g.source_payload_digest == sha1((dict((p[0], p[2]) for p in PAGES)[g.row.page_id] or "").encode())
    assert bytes(by[2, "conversion"].block) == b"" == bytes(by[3, "conversion"].block) and by[2, "conversion"].target_uri is None
    assert bytes(by[4, "conversion"].block) == b"one\ntwo\nc1\nc2"
    assert "forged" not in dict(x.split(": ", 1) for x in by[4, "metadata"].headers.split("\r\n")[1:] if x)["WARC-Type"]
    assert len(bytes(by[6, "conversion"].block)) == 20000 * 10 - 1


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>T</title><p>Hello</p></html>", "Hello"),
    ("<head><title>T</title>\n plain <b>words</b>", "plain words"),
    ("<head><meta charset=utf-8><link href=x><style>p{}</style><noscript><img src=y>no</noscript><template><p>no</p></template><div>yes", "yes"),
    ("<head><script>var x = '<p>no</p>';</script><svg><text>no</text></svg><p>yes", "yes"),
    ("<head><head><title>T</title></head>after", "after"),
    ("<head><title>T</title><body>b", "b"),
])
def test_head_that_is_not_closed(html, text):
    page = warc.parsed(html.encode())
    assert page.text() == text and page.title in ("T", "")


def test_files_round_trip(spark, pages):
    records = warc.derivatives(warc.as_responses(pages))
    files = warc.write_warc(records, work_dir(spark, "test-warc"))
    got = warc.read_warc(spark, files).collect()
    want = records.collect()
    key = lambda h, b: (h["WARC-Record-ID"], bytes(b))
    assert sorted(key(g.headers, g.block) for g in got) == sorted((w.record_id, bytes(w.block)) for w in want)
    assert all(g.headers["WARC-Block-Digest"] == sha1(bytes(g.block)) for g in got)
    store, name = fs.FileSystem.from_uri(files[0])
    with store.open_input_file(name) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_repeated_runs_agree(pages):
    rows = lambda: sorted((g.record_id, g.headers, bytes(g.block)) for g in warc.derivatives(warc.as_responses(pages)).collect())
    assert rows() == rows()


def test_empty_table(spark, pages):
    records = warc.derivatives(warc.as_responses(pages.limit(0)))
    assert records.collect() == [] and warc.write_warc(records, work_dir(spark, "test-warc")) == []
    assert warc.read_warc(spark, []).collect() == []


@pytest.mark.parametrize("html, text", [
    ("a<![bogus[x]]>b", "ab"), ("a<![CDATA[x]]>b", "ab"), ("a<![if IE]>b<![endif]>c", "abc"), ("a<![", "a"), ("a<!bogus>b<!-->c<?pi ?>d", "abcd"),
    ("<svg><title>Icon</title><text>no</text></svg>yes", "yes"), ("<svg><circle r=1><p>yes", "yes"), ("<svg><text>no<div>yes</div>", "yes"),
    ("<svg><foreignObject><p>no</p></foreignObject><text>no</text></svg>yes", "yes"), ("<svg><desc><p>no</p></desc></svg>yes", "yes"),
    ("<svg/>yes", "yes"), ("a<!--->b<!-- c", "ab"), ("<svg><desc/><p>yes", "yes"),
])
def test_odd_declarations_and_unclosed_graphics(html, text):
    assert warc.parsed(html.encode()).text() == text


def test_the_title_is_the_pages_own():
    assert warc.parsed(b"<title>Page</title><svg><title>Icon</title></svg>").title == "Page"


@pytest.mark.parametrize("charset", ["idna", "undefined", "hex", "no-such", "utf-16", "punycode", "unicode_escape"])
def test_any_declared_character_set(spark, charset):
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={charset}\r\n"
    rows = [(("k",), "<urn:uuid:1>", "http://a.example/", "1970-01-01T00:00:00Z", http, b"<p>caf\xc3\xa9 x..y</p>"), (("k",), "<urn:uuid:2>", None, None, None, None)]
    given = spark.createDataFrame(rows, "row struct<k:string>, record_id string, target_uri string, date string, http string, payload binary")
    got = warc.derivatives(given).collect()
    assert len(got) == 4
    if charset in ("idna", "undefined", "hex", "no-such"):
        assert bytes(got[1].block).decode() == "café x..y"


def test_ids_follow_content_and_nulls(spark):
    rows = [(5, None, "a"), (None, "5", "a"), (5, "u", "one"), (5, "u", "two"), (5, "u", "two"), (5, "u", None), (5, "u", "")]
    got = warc.as_responses(spark.createDataFrame(rows, "page_id long, url string, html string")).select("record_id").collect()
    ids = [g.record_id for g in got]
    assert len(set(ids)) == 5 and ids[3] == ids[4] and ids[5] == ids[6]


def test_text_of_generated_pages():
    """Pages written from a tree whose text is known."""
    import html
    import random

    inline, block, hidden = ("b", "i", "span", "a", "em"), ("p", "div", "li", "td", "h2"), ("script", "style", "svg", "template", "noscript")
    r = random.Random(8)

    def node(depth):
        kind = r.random()
        if depth == 0 or kind < 0.4:
            word = r.choice(["caf\u00e9", "a < b", "x & y", "  two\nlines ", "\u65e5\u672c", "&amp;", "plain"])
            return html.escape(word), word
        inner = [node(depth - 1) for _ in range(r.randrange(1, 4))]
        source, text = "".join(i[0] for i in inner), "".join(i[1] for i in inner)
        if kind < 0.6:
            tag = r.choice(inline)
            return f"<{tag} class='c'>{source}</{tag.upper()}>", text
        if kind < 0.85:
            tag = r.choice(block)
            return f"<{tag}>{source}</{tag}>", f"\0{text}\0"
        tag = r.choice(hidden)
        return f"<!-- c > d --><{tag}>var x = 1;</{tag}>", ""

    for _ in range(300):
        parts = [node(4) for _ in range(3)]
        page = warc.parsed(("<!DOCTYPE html><html><head><title>t</title></head><body>" + "".join(p[0] for p in parts) + "</body></html>").encode())
        lines = (" ".join(x.split()) for line in "".join(p[1] for p in parts).split("\0") for x in line.split("\n"))
        assert page.text().split("\n") == [x for x in lines if x] or not any(lines)


class Plain(warc.Page):
    """Every construct by the library's parser."""

    def ordinary(self, i):
        return i


def seen(kind, text):
    page = kind()
    page.feed(text)
    page.close()
    return page.parts, page.links, page.skipped, page.title, page.lang, page.charset, page.base


def test_ordinary_tags_are_read_as_the_parser_reads_them():
    import random

    r = random.Random(5)
    parts = ["<", ">", "</", "/>", "/ >", "=", "==", "\"", "'", " ", "\n", "\t", "\f", "\v", "\u00a0", "\x1c", "\0", "&amp;", "&lt", "&", "&#65;", "text", "x",
             "<p>", "</p>", "<P >", "</P\n>", "</ p>", "</p x>", "</>", "<br/>", "<br />", "<br / >", "<p/x>", "<a", "<A HREF=/x>", "<a href='/y&amp;z'>",
             "<a href=\"/q\" class=c>", "<a href=/x/>", "<a href=x />", "<img src=i.png/>", "<img src=\"i\"/>", "<a href=\"a\"href='b'>", "<a href = z>",
             "<a href>", "<a href=>", "<a href=/>", "<a href='' href=2>", "<a\u00a0href=1>", "<a href=1\u00a0b=2>", "<a href=\"1\"\u00a0b=2>", "<a b=\"", "<a b='>",
             "<a @x=1 href=2>", "<base href=/b>", "<html lang=en>", "<meta charset='utf-8'/>", "<title>", "</title>", "<script>", "<script src=s>", "</script>",
             "</script >", "</SCRIPT>", "<style>", "</style>", "<style/>", "<textarea>", "</textarea>", "<svg>", "</svg>", "<desc>", "<head>", "</head>", "<body>",
             "<!doctype html>", "<!-- c > -->", "<!-->", "<!--", "-->", "<!x>", "<![if]>", "<![", "<?pi?>", "<?", "<x-y>", "<x:y z>", "<h1 a b c=d e>", "<\u00e9>",
             "<p\u00e9>", " href=1", " href", ">"]
    for _ in range(20000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 25)))
        assert seen(warc.Page, text) == seen(Plain, text), text


def test_the_parser_is_asked_for_what_is_not_ordinary_only(monkeypatch):
    asked = []
    real = warc.HTMLParser.parse_starttag
    monkeypatch.setattr(warc.HTMLParser, "parse_starttag", lambda self, i: asked.append(i) or real(self, i))
    page = warc.parsed(b"<!DOCTYPE html><html lang=en>" + b"<p class='x'>a<br/><a href=\"/y\">b</a></p>" * 500)
    assert page.text() == "\n".join(["a", "b"] * 500) and len(page.links) == 500 and page.lang == "en"
    assert len(asked) <= 1


@pytest.mark.parametrize("base", ["", "http://a.example", "http://a.example/x/y?z#w", "HTTPS://A.example:80/x/", "mailto:a@b", "x", "/x/y", "http:x", "http://[bad", "//h/x",
                                  "ftp://f/x;p", "data:,x", "http://a.example/%20", "http://\u2100.example/"])
def test_links_are_joined_as_urljoin_does(base):
    links = ["/a", "/a/b-c_d", "/\u00fcber", "/a//b", "//h/a", "/../a", "/a/", "/a?b", "/a;b", " /a ", "\t/a", "/a b", "a", "", " ", "#x", "http://a.example", "http://a.example/",
             "https://b.example/c/../d/%41~x.html", "https://b.example//c", "http://b.example:8/c", "http://B.example/c", "http://b..example/", "http://b.example/c ", "http://[bad",
             "http://b.example/c?", "http://b.example/c#", "HTTP://b.example/", "javascript:x", "http:/a", "http:a", "/a\n"]
    assert warc.outlinks(base, links) == [warc.joined(base, x) for x in links]


def test_digests_of_parts():
    import random

    for n in (0, 1, 63, 64, 1000):
        data = random.Random(n).randbytes(n)
        assert warc.digest(data) == sha1(data) == warc.digest(data[:n // 2], data[n // 2:])

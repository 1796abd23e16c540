import gzip
import hashlib
import html as stdlib_html
import io
import re

import pytest
from pyarrow import fs

from panelwright.lineage import scratch_folder
from panelwright.llm.extraction import Template, extract, is_aside, main_text
from panelwright.llm.html import tokens
from panelwright.llm.warc import (
    info_record,
    members,
    page_id_of,
    page_record,
    parse_record,
    read_archives,
    record_id,
    write_archives,
)


def pages_of(spark, rows):
    rows = [(*r, "x", "y", 3) for r in rows]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, payload string, n int")


def test_record_ids():
    for page in (0, 7, -1, 2**63 - 1, -(2**63), None):
        assert page_id_of(record_id(page)) == page


def test_members_and_digests():
    records = [info_record("a"), page_record(1, "http://x/\r\ny", b"<p>1</p>", None), page_record(2, None, b"z" * 90_000, 1)]
    source = b"".join(records)
    found = [parse_record(m) for m in members(io.BytesIO(source))]
    assert [h["warc-type"] for h, _ in found] == ["warcinfo", "response", "revisit"]
    assert found[1][0]["warc-target-uri"] == "http://x/%0D%0Ay" and found[1][1].endswith(b"<p>1</p>")
    assert [gzip.decompress(r) for r in records] == list(members(io.BytesIO(source)))
    with pytest.raises(ValueError, match="ends within"):
        list(members(io.BytesIO(source[:-9])))
    plain = gzip.decompress(records[1])
    with pytest.raises(ValueError, match="block digest"):
        parse_record(plain.replace(b"<p>1", b"<p>2"))
    with pytest.raises(ValueError, match="content length"):
        parse_record(plain[:-5])
    assert list(members(io.BytesIO(b""))) == []


def brute_records(rows):
    out = []
    for page, _, text in rows:
        data = (text or "").encode()
        same = [p for p, _, t in rows if (t or "") == (text or "") and p is not None]
        first = max(same) if same and len(data) >= 1000 and sum((t or "") == (text or "") for _, _, t in rows) > 1 else page
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if page == first else "revisit", None if page == first else first))
    return out


def test_archives_round_trip(spark):
    long = "é<p>" * 400
    rows = [(i, f"http://h/{i}", long if i % 3 else f"<p>{i}</p>") for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "u", "x" * 999), (103, "u", "x" * 999), (104, "u", "\x00\r\n\r\n" * 300)]
    rows += [(105, "u", "WARC/1.1\r\n" * 200_000), (59, "http://h/59", long), (None, "u", long)]
    folder = scratch_folder(spark, "warc-test")
    manifest = write_archives(pages_of(spark, rows), folder)
    assert sum(r["records"] for r in manifest.collect()) == len(rows)
    got = read_archives(spark, folder, manifest).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(brute_records(rows), key=repr)
    texts = {p: t or "" for p, _, t in rows}
    assert all(bytes(r["payload"]).decode() == texts[r["page_id"]] for r in got if r["record_type"] == "response")
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")
    none = write_archives(pages_of(spark, []), folder)
    assert read_archives(spark, folder, none).collect() == []


def test_damaged_archive_fails(spark):
    folder = scratch_folder(spark, "warc-damaged")
    manifest = write_archives(pages_of(spark, [(1, "u", "<p>text</p>")]), folder)
    store, place = fs.FileSystem.from_uri(folder)
    path = f"{place}/{manifest.first()['archive']}"
    with store.open_input_stream(path, compression=None) as f:
        data = f.read()
    with store.open_output_stream(path, compression=None) as f:
        f.write(data[:-20])
    with pytest.raises(Exception, match="ends within"):
        read_archives(spark, folder, manifest).collect()


def page(title, body, extra=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>x('</p>')</script></head><body>"
        f'<header><h2>Site</h2></header><nav><ul><li><a href="/">Home<li><a>News</ul></nav><!-- a <p>note</p> -->'
        f'<div class="ad">Buy</div><article><header><h1>{title}</h1></header>{body}<aside>More</aside>'
        f'<form>mail <input></form><div class="share">Share</div></article>{extra}<section id="comments"><p>First!</p>'
        "</section><div role=contentinfo>c</div><footer>&copy; me</footer></body></html>"
    )


def test_blocks_of_a_page():
    body = "<p>One &amp; <b>tw</b>o<br>three\n &nbsp; four<p>Five &lt;six&gt;<ul><li>a<li>b</ul><table><tr><td>x<td>y</table>tail"
    text = main_text(page("Big &eacute;", body), Template(None))
    assert text == "Big é\n\nOne & two three four\n\nFive <six>\n\na\n\nb\n\nx\n\ny\n\ntail"
    assert main_text("", Template(None)) == "" and main_text("just text", Template(None)) == "just text"
    assert main_text("<nav>only</nav>", Template(None)) == ""
    assert main_text("<p>open <b>never closed", Template(None)) == "open never closed"
    assert main_text("<article>cut &am", Template(None)) == "cut &am"
    assert len(main_text(f"<article>{'<p>w ' * 20_000}</article>", Template(None)).split()) == 20_000
    assert main_text('<div><p title="a>b">long main text here</p></div><div class="sidebar"><p>x</p></div>', Template(None)) == "long main text here"


def test_aside_words():
    assert is_aside("/html/body/div.cookie.bar/p") and is_aside("/body/section.comments/article.comment/p")
    assert not is_aside("/html/body.header/article/p") and not is_aside("/body/div.reads/p")
    assert not is_aside("/body/article/header/h1") and is_aside("/body/header/h1")


def test_names_of_wrappers():
    def text(html):
        return main_text(f"<html><body>{html}</body></html>", Template(None))

    article = "<article><p>main text</p></article>"
    assert text("<article class='post comments-open'><p>a</p></article>") == "a"
    assert text("<main class='with-sidebar'><p>a</p></main><div class=sidebar><p>b</p></div>") == "a"
    assert text("<main class='sidebar'><p>a</p></main>") == "a" and text("<article class=hidden><p>a</p></article>") == "a"
    assert text(f"<div class='page header-fixed'>{article}<div class='site-header'>x</div></div>") == "main text"
    assert text(f"<p>skip</p><div class='page sidebar'>{article}<div class=related><article>t</article></div></div>") == "main text"
    # A page in one form, with and without an article; forms that hold no main text.
    asp = "<form id=aspnetForm><div class=menu>m</div>{}<div class=footer-links>f</div></form><p>c</p>"
    assert text(asp.format(article)) == "main text"
    assert text(asp.format("<div class=x><h1>h</h1><p>long main text</p></div>")) == "h\n\nlong main text\n\nc"
    assert text("<form><p>mail</p></form><p>long main text</p>") == "long main text"
    assert text("<div class=widget><h1>h</h1><p>all of the page</p></div>") == "h\n\nall of the page"
    assert text("<div class='intro'>i</div><div id='main-content'><p>a</p></div><div class=x>the longest text</div>") == "a"
    assert text("<div class='page sidebar'><p>skip</p><div id='main-content'><p>text</p></div></div>") == "text"
    # Articles that are comments or teasers stay out.
    assert text("<div><p>the long main text</p></div><div class=related><article><p>teaser</p></article></div>") == "the long main text"
    assert text("<article><p>a</p><article class=comment><p>b</p></article></article>") == "a"
    assert is_aside("/html/body/div.cookie-bar/p") and is_aside("/body/ul.related-posts/li")
    assert [t.path for t in tokens("<div class='a-1 b_2 9' id=x.y>")][0] == "/div.a.b.x-y"


def test_tokens_close_what_is_open():
    kinds = [t.kind for t in tokens("<div><p>a<div>b</div><li>c<li>d")]
    assert kinds.count("open") == kinds.count("close")


def test_elements_that_nest_without_end():
    for tag in ("div", "x-a", "p", "li", "td", "article"):
        for before in ("", "<p><div>", "<li><ul>"):
            page_ = f"{before}{f'<{tag}>' * 100_000}deep text"
            assert main_text(page_, Template(None)) == "deep text"
    found = tokens("<div>a" * 50_000 + "</div>" * 50_000 + "<p>end")
    assert len(found) == 150_003 and found[-2].text == "end"


def test_drawings_and_formulas():
    def text(html):
        return main_text(f"<article>{html}</article>", Template(None))

    assert text("<p>a</p><svg class='x'/><p>b</p>") == "a\n\nb"
    assert text('<p>a <svg href="#i" /> b</p><math/><p>c</p><svg><text>no</text></svg><p>d</p>') == "a b\n\nc\n\nd"
    assert text("<svg><svg><text>in</text></svg><svg/><text>out</text></svg><p>e</p>") == "e"
    assert text("<SVG width=5/><text>in</text></SVG><p>f</p>") == "f"
    assert text("<p>g</p><svg><p>h</p>") == "g\n\nh"
    assert text("<script>x('<svg>')</script><!-- </svg> --><p>i</p><svg hidden/><p>j</p>") == "i\n\nj"
    assert text("<svg><!-- </svg> <text> --><text>no</text></svg><p>k</p>") == "k"


def test_template_text_goes(spark):
    rows = []
    for i in range(30):
        more = f"<p>para {i}</p>" * (i % 4 + 1)
        body = f"<p>Subscribe now</p><p>story {i}</p>{more}<p>Written by staff</p>"
        rows.append((i, f"https://User@Big.example.com:80/{i}", page(f"Title {i}", body)))
    # Few pages with one text: copies, not a template. And no marked article.
    rows += [(100 + i, "http://small.example.com/a", page("Same", "<p>same text</p>")) for i in range(3)]
    for i in range(12):
        body = "".join(f"<p>line {i} {k} of some length</p>" for k in range(i % 5 + 1))
        rows.append((200 + i, "http://plain.example.com/", f"<html><body><div class=menu><p>Menu {i}</p></div><div class=text>{body}</div><div class=x><p>tiny {i}</p></div></body></html>"))
    rows += [(300, None, None), (301, "not an address", ""), (302, "http://solo/", "<article><p>a</p></article>"), (5, rows[5][1], rows[5][2])]
    got = sorted(extract(pages_of(spark, rows)).collect(), key=lambda r: r["page_id"])
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    texts = {r["page_id"]: r["text"] for r in got}
    for i in range(30):
        assert texts[i] == "\n\n".join([f"Title {i}", "Subscribe now", f"story {i}", *[f"para {i}"] * (i % 4 + 1), "Written by staff"])
    assert {texts[100 + i] for i in range(3)} == {"Same\n\nsame text"}
    for i in range(12):
        assert texts[200 + i] == "\n\n".join(f"line {i} {k} of some length" for k in range(i % 5 + 1))
    assert (texts[300], texts[301], texts[302]) == ("", "", "a")
    assert extract(pages_of(spark, [])).collect() == []


def test_all_slots_of_a_page_without_article(spark):
    def body(i):
        return f"<h1>Head {i}</h1><div class=lead>lead {i}</div><div class=text><p>long text of the page {i}</p></div><div class=end>end {i}</div>"

    def whole(i):
        return f"Head {i}\n\nlead {i}\n\nlong text of the page {i}\n\nend {i}"

    rows = [(i, "http://body.example.com/", f"<html><body><div class=body>{body(i)}</div><div class=menu>m {i}</div></body></html>") for i in range(12)]
    rows += [(100 + i, "http://flat.example.com/", f"<html><body><h1>Head {i}</h1><div class=lead>lead {i}</div><div class=text>long text of the page {i}</div><p>end {i}</p></body></html>") for i in range(12)]
    parts = [f"<section id={n}><h2>{n}</h2><p>{n} {'word ' * k}</p></section>" for n, k in (("a", 3), ("b", 9), ("c", 1))]
    rows += [(200, "http://one.example.com/", f"<html><body>{''.join(parts)}</body></html>")]
    rows += [(201, "http://other.example.com/", f"<html><body><div id=page>{''.join(parts)}</div><footer>f</footer></body></html>")]
    texts = {r["page_id"]: r["text"] for r in extract(pages_of(spark, rows)).collect()}
    assert all(texts[i] == texts[100 + i] == whole(i) for i in range(12))
    want = "\n\n".join(["a", "a word word word", "b", "b" + " word" * 9, "c", "c word"])
    assert texts[200] == texts[201] == want


def test_copies_of_a_page_are_no_template(spark):
    # Copies with an odd and an even number, and pages without a host.
    rows = [(i, f"http://mirror.example.com/{i}", page("Same", "<p>same text</p>")) for i in range(12)]
    rows += [(100 + i, f"http://two.example.com/{i}", page("Two", f"<p>text {i % 2}</p>")) for i in range(25)]
    rows += [(200 + i, None, page("Lost", "<p>no host</p>")) for i in range(11)]
    texts = {r["page_id"]: r["text"] for r in extract(pages_of(spark, rows)).collect()}
    assert {texts[i] for i in range(12)} == {"Same\n\nsame text"}
    assert all(texts[100 + i] == f"Two\n\ntext {i % 2}" for i in range(25))
    assert {texts[200 + i] for i in range(11)} == {"Lost\n\nno host"}


def test_query_by_brute_force(spark):
    from panelwright.llm import CORPUS

    folder = "/root/testdata/sf0.001"
    got = {r["page_id"]: r for r in CORPUS["op5_html_extraction"].run(spark, folder).collect()}
    given = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(given)
    for r in given:
        inner = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        blocks = [" ".join(stdlib_html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        text = "\n\n".join(b for b in blocks if b)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (text, len(text), r["url"])

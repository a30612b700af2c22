"""Wrapper induction on hand-made sites, and archives against an exact round trip."""

import hashlib
from collections import Counter

import pytest
import zstandard

from cashline.llm import warc, wrappers
from cashline.llm.common import new_folder
from cashline.llm.dom import parse
from cashline.llm.wrappers import Slot, learn, main_text, merge, prune

PAGES = "page_id long, url string, html string, host string, text string, digest string"


def shape(node):
    return (node.tag, [shape(k) if not isinstance(k, str) else k for k in node.kids])


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>one<p>two <b>bold</b>ly<br>on", "one\ntwo boldly on"),
        ("<article><h1>T &amp; U</h1><p>a&nbsp;b\n c</p></article><p>no</p>", "T & U\na b c"),
        ("<nav>n</nav><p>x</p><aside>s</aside><footer>f</footer><header>h</header>", "x"),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><p>yes</p><!-- <p>no</p> -->", "yes"),
        ("<script>never closed <p>a</p>", ""),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"),
        ("<p>a</div></span></p></article>b", "a\nb"),
        ('<div class="comment-list"><p>c</p></div><div id="Cookie-Notice">n</div><p class="lead">l</p>', "l"),
        ("<main><p>m</p><form>f<p>g</p></form></main><p>out</p>", "m"),
        ('<article><p>a</p><section class="comments"><article class="comment">c</article></section></article>', "a"),
        ("<a href='x'>all</a> <a>links</a>", "all links"),
        ("<p>text of the page</p><div><a>one</a> <a>two</a></div>", "text of the page"),
        ("<p title='a > b'>q</p><p x=\"open>r</p>", "q\nr"),
        ("< p>1 < 2 &lt;b&gt; &#8364; &#x41; &bogus; &amp", "< p>1 < 2 <b> € A &bogus; &"),
        ("<p>" + "long " * 30_000 + "</p>", ("long " * 30_000).strip()),
        ("<div>" * 300 + "deep" + "</div>" * 300, "deep"),
        ('<div class="has-sidebar"><div class="side-bar sidebar">s</div><article><header class="entry-header"><h1>t</h1></header><p>x</p></article></div>', "t\nx"),
        ('<div id="no-comments"><p>p</p></div><div class="comments-area">c</div>', "p"),
        ("<font>a " * 5000, ("a " * 5000).strip()),
    ],
)
def test_single_pages(html, text):
    assert main_text(html) == text


def test_trees():
    assert shape(parse("<ul><li>a<li>b<b>c</ul>d")) == ("", [("ul", [("li", ["a"]), ("li", ["b", ("b", ["c"])])]), "d"])
    assert shape(parse("<p>a<div>b</div>c</p>")) == ("", [("p", ["a"]), ("div", ["b"]), "c"])


def site(n, body="<p>own {0} words</p><p>more {0}</p>"):
    page = '<div class="bar{0}">Site name</div><div class="x"><p>Best site ever</p></div><div class="c">' + body + "</div><div>All rights</div>"
    return [page.format(k) for k in range(n)]


def template_of(pages):
    root = Slot("")
    for number, html in enumerate(pages, 1):
        learn(root, parse(html), number)
        wrappers._turn(root, number)
    wrappers.judge(root)
    return root


def test_what_pages_share_is_template():
    pages = site(4)
    root = template_of(pages)
    assert [main_text(p, root) for p in pages] == [f"own {k} words\nmore {k}" for k in range(4)]


def test_two_pages_prove_nothing_and_copies_keep_their_text():
    few = site(2)
    assert main_text(few[0], template_of(few)).startswith("Site name")
    copies = ["<article><h1>t</h1><p>same text</p></article>"] * 5
    assert main_text(copies[0], template_of(copies)) == "t\nsame text"


def test_optional_blocks_align():
    pages = site(6)
    pages[2] = pages[2].replace('<div class="c">', '<div class="z">extra of 2</div><div class="c">')
    pages[4] = pages[4].replace("<p>more 4</p>", "<p>more 4</p><p>and more</p><h2>head</h2>")
    root = template_of(pages)
    texts = [main_text(p, root) for p in pages]
    assert texts[2] == "extra of 2\nown 2 words\nmore 2"
    assert texts[4] == "own 4 words\nmore 4\nand more\nhead"
    assert texts[5] == "own 5 words\nmore 5"


def test_templates_of_parts_merge_to_that_of_all():
    pages = site(9)
    whole = template_of(pages)
    left, right = template_of(pages[:4]), template_of(pages[4:])
    merge(left, right)
    wrappers.judge(left)
    assert left.plain() == whole.plain()
    assert [main_text(p, left) for p in pages] == [main_text(p, whole) for p in pages]


def test_a_site_without_a_common_shape_stays_small(monkeypatch):
    monkeypatch.setattr(wrappers, "MOST_SLOTS", 50)
    letters = "abcdefghij"
    pages = [f'<div class="{letters[k % 10] * (k // 10 + 1)}q"><p>t {k}</p></div><div class="f">foot</div>' for k in range(80)]
    root = template_of(pages)
    prune(root)
    wrappers.judge(root)
    assert root.size() <= 60
    assert [main_text(p, root) for p in pages] == [f"t {k}" for k in range(80)]


def messy_pages():
    rows = [(k, f"https://h.example/{k}", html, "x", "y", "z") for k, html in enumerate(site(5))]
    rows += [(9, None, None, *"xyz"), (10, "no url", "", *"xyz"), (None, "http://o.example/\r\nx", "<p>" + "é" * 200, *"xyz")]
    rows += [(11, "http://a.example", "<p>" + "é" * 200, *"xyz"), (12, "http://b.example", "<p>" + "é" * 200, *"xyz")]
    rows += [(13, "u", "short", *"xyz"), (14, "u", "short", *"xyz"), (15, "u", "<p>" + "long " * 100_000, *"xyz")]
    return rows + [rows[0], rows[0], rows[5]]


def test_extraction_of_messy_pages(spark):
    found = wrappers.extract(spark.createDataFrame(messy_pages(), PAGES)).collect()
    texts = Counter((r.page_id, r.url, r.text) for r in found)
    assert len(found) == len(messy_pages())
    assert texts[(0, "https://h.example/0", "own 0 words\nmore 0")] == 3
    assert texts[(9, None, "")] == 2 and texts[(10, "no url", "")] == 1
    assert texts[(None, "http://o.example/\r\nx", "é" * 200)] == 1
    assert max(len(r.text) for r in found) == 499_999
    assert wrappers.extract(spark.createDataFrame([], PAGES)).count() == 0


def extracted(spark, pages):
    rows = [(k, f"https://h.example/{k}", html) for k, html in enumerate(pages)]
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5, "page_id"))
    return {r.page_id: r.text for r in found.collect()}


def test_copies_of_a_page_prove_nothing(spark):
    copy = '<article><h1>T</h1><p>same words</p><ul class="q"><li>only here</li></ul></article>'
    pages = [copy] * 6 + [f"<article><h1>T{k}</h1><p>own {k}</p></article>" for k in range(8)]
    found = extracted(spark, pages)
    assert [found[k] for k in range(6)] == ["T\nsame words\nonly here"] * 6
    assert [found[6 + k] for k in range(8)] == [f"T{k}\nown {k}" for k in range(8)]


def test_a_fixed_block_among_blocks_of_its_sign_goes(spark):
    pages = [f"<article><p>own words {k}</p><p>more {k}</p><p>Fixed notice</p></article>" for k in range(7)]
    assert extracted(spark, pages) == {k: f"own words {k}\nmore {k}" for k in range(7)}
    pages = [f"<div>Home About</div><div><p>this is the page's own text {k}</p></div><div>All rights</div>" for k in range(7)]
    assert extracted(spark, pages) == {k: f"this is the page's own text {k}" for k in range(7)}


def test_near_copies_alone_on_a_host_keep_title_and_text(spark):
    pages = [f"<article><h1>Title</h1><p>long first part</p><p>differs {k}</p><p>long last part</p></article>" for k in range(7)]
    assert extracted(spark, pages) == {k: f"Title\nlong first part\ndiffers {k}\nlong last part" for k in range(7)}


def test_slots_that_are_dropped_are_judged_all_the_same(spark, monkeypatch):
    letters = "abcdefghij"
    html = '<div class="{0}q"><div class="s">Boiler {0}</div><p class="t">the own text of page {1}</p></div><div class="f">foot</div>'
    pages = [html.format(letters[k % 10] * (k // 50 + 1), k) for k in range(150)]
    found = wrappers.main_text
    root = Slot("")
    for number, page in enumerate(pages[:10], 1):
        learn(root, parse(page), number)
        wrappers._turn(root, number)
    monkeypatch.setattr(wrappers, "MOST_SLOTS", 8)
    prune(root)
    again = html.format("a", 7) + '<p class="u">other {}</p>'
    for number in (101, 102, 103):
        learn(root, parse(again.format(number)), number)
        wrappers._turn(root, number)
    wrappers.judge(root)
    assert "text of page 7" in found(again.format(101), root)
    paths = wrappers.shared_blocks(spark.createDataFrame([(f"http://h/{k}", p) for k, p in enumerate(pages)], "url string, html string"))
    [row] = paths.collect()
    texts = [found(p, root, set(row.shared)) for p in pages]
    assert texts == [f"the own text of page {k}" for k in range(150)]


def word(k):
    return "".join(chr(ord("a") + int(c)) for c in str(k))


def test_what_a_template_has_no_room_for_is_judged_by_place(spark):
    parts = "".join(f'<b class="{word(n)}x">{{1}} </b>' for n in range(45))
    html = '<hr><div class="s">own words {1}</div><div class="{0}y">' + parts + "</div>"
    pages = [html.format(word(k // 4), k) for k in range(400)]
    for k in (3, 120, 377):  # fewer pages than any other slot, and of a path that others have with other text
        pages[k] = '<div class="s">Fixed <i>words</i></div>' + pages[k]
    pages[50] = '<h2>seen <i>once</i></h2><p>and this</p>' + pages[50]
    found = extracted(spark, pages)
    expected = {k: f"own words {k}\n" + " ".join([str(k)] * 45) for k in range(400)}
    assert found == expected | {50: "seen once\nand this\n" + expected[50]}


def test_a_closed_slot_is_judged_by_all_of_its_places():
    pages = [f'<div class="t">Head<p class="{word(k % 3)}q">same</p></div><p>own {k}</p>' for k in range(12)]
    root = template_of(pages)
    wrappers._drop(root, 5)
    assert root.kids[0].closed and not wrappers.judge(root.kids[0])
    places, number = {}, wrappers._number(0, 0)
    wrappers._place(parse(pages[0]), root, places)
    [(place, (above, texts, nodes))] = [(k, v) for k, v in places.items() if v[2]]
    assert above == (number,) and texts == ["same"] and [n.tag for n in nodes] == ["p"]
    assert main_text(pages[0], root) == "Head\nsame\nown 0"
    wrappers.judge(root, {place})
    assert main_text(pages[0], root, proven={place}) == "Head\nown 0"
    wrappers.judge(root, {place, number})
    assert main_text(pages[0], root, proven={place, number}) == "own 0"


def archived(spark, rows):
    folder = new_folder(spark, "test-warc")
    warc.write(spark.createDataFrame(rows, PAGES), folder)
    return warc.read(spark, folder).collect()


def test_archives_round_trip(spark):
    rows = messy_pages()
    found = archived(spark, rows)
    firsts = {}
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        if page_id is not None:
            firsts[payload] = min(page_id, firsts.get(payload, page_id))
    expected = Counter()
    for page_id, _, html, *_ in rows:
        payload = (html or "").encode()
        first = firsts.get(payload)
        revisit = len(payload) >= 100 and first is not None and page_id != first
        expected[(
            page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response",
            first if revisit else None, None if revisit else payload,
        )] += 1
    assert expected == Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None)
        for r in found
    )
    assert {r.url for r in found} >= {"http://o.example/%0D%0Ax", "", "no%20url"}


def test_an_archive_of_nothing(spark):
    assert archived(spark, []) == []


def archive(records, dictionary=b"0123456789abcdef" * 8):
    pack = zstandard.ZstdCompressor(dict_data=warc._dictionary(dictionary)).compress
    head = warc.struct.pack("<II", warc.SKIPPABLE, len(dictionary)) + dictionary
    return head + b"".join(map(pack, records))


def test_one_frame_per_record_and_broken_archives_raise():
    payload = b"0123456789abcdef" * 5000
    digest = hashlib.sha256(payload).hexdigest()
    records = [warc.record(k, "u", payload, digest, None, "2024-01-01T00:00:00Z") for k in range(3)]
    data = archive(records)
    assert list(warc.frames(data)) == records
    assert warc.parse(records[1])["payload"] == payload
    assert list(warc.frames(archive([], b""))) == []
    for broken in (data[:-3], data[8:], b"", data[:4]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(broken))
    for bad in (
        records[0].replace(b"WARC/1.1", b"WARC/9.9"),
        records[0][:-5] + records[0][-4:],
        records[0].replace(b"0123", b"0124", 1),
        records[0].replace(b"WARC-Type", b"WARC-Kind"),
    ):
        with pytest.raises(ValueError):
            warc.parse(bad)


def foreign(kind, block, *fields, version="WARC/1.0", names=str):
    head = [("WARC-Type", kind), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "2020-01-01T00:00:00Z"), *fields]
    lines = "".join(f"{names(n)}: {v}\r\n" for n, v in [*head, ("Content-Length", len(block))])
    return f"{version}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


PAGE = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>text</p>"


@pytest.mark.parametrize(
    "record, kind, payload",
    [
        (foreign("warcinfo", b"software: x\r\n"), "warcinfo", b"software: x\r\n"),
        (foreign("response", PAGE), "response", b"<p>text</p>"),
        (foreign("response", PAGE, names=str.lower), "response", b"<p>text</p>"),
        (foreign("response", PAGE, names=str.upper, version="WARC/1.1"), "response", b"<p>text</p>"),
        (foreign("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n"), "request", b""),
        (foreign("metadata", b""), "metadata", b""),
        (foreign("resource", b"a\r\n\r\nb", ("WARC-Target-URI", "x:\r\n y")), "resource", b"a\r\n\r\nb"),
        (foreign("response", PAGE, ("WARC-Payload-Digest", "sha1:KX5JR2VB4ZPRV3B6V5QOPPD2XFRRSCNC")), None, None),
        (foreign("response", PAGE, ("WARC-Payload-Digest", "md5:00")), "response", b"<p>text</p>"),
    ],
)
def test_records_of_others(record, kind, payload):
    if kind is None:  # the digest is that of other bytes
        with pytest.raises(warc.ArchiveError):
            warc.parse(record)
        return
    found = warc.parse(record)
    assert (found["record_type"], found["payload"], found["page_id"]) == (kind, payload, None)
    assert found["record_id"] == "<urn:uuid:1>" and found["payload_digest"] == hashlib.sha256(payload).hexdigest()


def test_digests_of_others_are_verified():
    for kind in ("sha1", "sha256"):
        digest = hashlib.new(kind, b"<p>text</p>")
        for written in (digest.hexdigest(), digest.hexdigest().upper(), warc.base64.b32encode(digest.digest()).decode()):
            assert warc.parse(foreign("response", PAGE, ("WARC-Payload-Digest", f"{kind}:{written}")))["payload_bytes"] == 11


@pytest.mark.parametrize(
    "record",
    [
        b"",
        b"WARC/1.0\r\n\xff: x\r\n\r\n\r\n\r\n",
        foreign("response", PAGE)[:-6],
        foreign("response", PAGE).replace(b"Content-Length: 41", b"Content-Length: x"),
        foreign("response", PAGE).replace(b"WARC-Date: ", b"WARC-Date "),
        foreign("response", PAGE.replace(b"Server: x", b"content-length: 12")),
        foreign("response", PAGE, ("WARC-Block-Digest", "sha1:00")),
        foreign("revisit", b""),
        foreign("revisit", b"", ("WARC-Payload-Digest", "sha256:00")),
    ],
)
def test_what_is_no_record_raises_one_kind_of_error(record):
    with pytest.raises(warc.ArchiveError):
        warc.parse(record)


@pytest.mark.parametrize("record", [PAGE.replace(b"Server: x", b"Content-Length: 99")])
def test_truncated_payloads_may_be_shorter(record):
    assert warc.parse(foreign("response", record, ("WARC-Truncated", "length")))["payload_bytes"] == 11


def test_dictionaries_compressed_missing_and_other_skippable_frames():
    records, dictionary = [foreign("response", PAGE), foreign("metadata", b"x")], b"0123456789abcdef" * 8
    plain = b"".join(map(zstandard.ZstdCompressor().compress, records))
    assert list(warc.frames(plain)) == records
    packed = zstandard.ZstdCompressor().compress(dictionary)
    head = warc.struct.pack("<II", warc.SKIPPABLE, len(packed)) + packed
    other = warc.struct.pack("<II", warc.SKIPPABLE - 8, 3) + b"abc"
    own = zstandard.ZstdCompressor(dict_data=warc._dictionary(dictionary)).compress
    assert list(warc.frames(head + own(records[0]) + other + own(records[1]))) == records
    for broken in (plain[:-1], b"no frame at all", other[:-1] + b"", plain + b"tail"):
        with pytest.raises(warc.ArchiveError):
            list(warc.frames(broken))


def test_revisits_are_held_against_their_responses(spark):
    page = b"<p>" + b"x" * 200
    digest, other = hashlib.sha256(page).hexdigest(), hashlib.sha256(b"other").hexdigest()
    date = "2024-01-01T00:00:00Z"
    made = [warc.record(1, "u", page, digest, None, date), warc.record(2, "u", page, digest, 1, date)]
    made += [warc.record(3, "u", page, other, 1, date), warc.record(4, "u", page, digest, 9, date)]
    rows = [{k: r[k] for k in ("record_id", "record_type", "refers_to_id", "payload_digest")} for r in map(warc.parse, made)]
    schema = "record_id string, record_type string, refers_to_id string, payload_digest string"
    broken = warc.broken_revisits(spark.createDataFrame([tuple(r.values()) for r in rows], schema))
    assert sorted(r.record_id for r in broken.collect()) == ["<urn:page:3>", "<urn:page:4>"]
    assert warc.broken_revisits(spark.createDataFrame([], schema)).count() == 0

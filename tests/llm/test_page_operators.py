"""Operators on pages, with nulls, empty and long pages, ties, repeats and clashing columns."""

import base64
import collections
import hashlib
import html.parser
import random
import re
import time
import zlib

import pytest

from cohortlake.llm import html_text, url_filter, warc

SCHEMA = "page_id long, url string, html string, host string, path string, key long, text string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "p", 1, "t") for r in rows], SCHEMA)


LONG = "<p>" + "é long text " * 20_000
ODD = [(1, None, None), (2, "", ""), (3, "http://a.example/x", "same"), (4, "http://a.example/y\r\nX: 1", "same"), (5, "http://a.example/z", LONG), (6, "http://b.example/z", LONG), (None, "http://b.example", "same"), (None, "u", "alone"), (7, "no scheme", "x"), (4, "http://a.example/y\r\nX: 1", "same"), (8, None, "")]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archives_round_trip(spark, data):
    table = spark.read.parquet(f"{data}/pages.parquet")
    rows = ODD + [(100 + r[0], r[1], r[2]) for r in table.select("page_id", "url", "html").collect()]
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    wanted = collections.Counter()
    for i, _, h in rows:
        holder = last.get(h or "")
        again = holder is not None and i != holder
        wanted[i, len((h or "").encode()), digest(h), "revisit" if again else "response", holder if again else None] += 1
    found = collections.Counter(map(tuple, warc.round_trip(pages(spark, rows), segment_bytes=1000).collect()))
    assert found == wanted
    assert warc.round_trip(pages(spark, []), 1000).count() == 0


def test_repeated_long_pages_give_a_row_each(spark):
    rows = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (2, "http://a/2", LONG), (2, "http://a/3", LONG), (None, "http://a/4", LONG + "x"), (None, "http://a/4", LONG + "x"), (None, "http://a/5", LONG), (None, "http://a/6", "short")]
    files = warc.write_warc(pages(spark, rows), segment_bytes=1000)
    read = warc.read_warc(files).collect()
    assert collections.Counter((r.page_id, r.url, r.record_type) for r in read) == collections.Counter((i, u, "revisit" if i == 1 or u == "http://a/5" else "response") for i, u, _ in rows)
    assert len({r.record_id for r in read}) == len(rows)
    assert {r.refers_to_record for r in read if r.record_type == "revisit"} <= {r.record_id for r in read if r.page_id == 2}
    found = warc.round_trip(pages(spark, rows), segment_bytes=1000).collect()
    assert collections.Counter((r.page_id, r.payload_bytes, r.refers_to) for r in found) == collections.Counter((i, len(h.encode()), 2 if i == 1 or u == "http://a/5" else None) for i, u, h in rows)


def test_payloads_are_read_back(spark):
    rows = [(1, "http://a/", "short"), (2, "http://a/b", LONG)]
    read = {r.page_id: r for r in warc.read_warc(warc.write_warc(pages(spark, rows), segment_bytes=700)).collect()}
    assert bytes(read[1].payload) == b"short" and bytes(read[2].payload) == LONG.encode() and read[2].url == "http://a/b"


def test_chunks_and_damage(spark):
    for size in (0, 1, 8192, 8193, 30_000):
        body = random.Random(size).randbytes(size)
        assert warc.unchunked(warc.chunked(body)) == body
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")
    members = warc.page_records(1, "u", b"x" * 5000, None, 1000)
    assert [f["WARC-Type"] for f, _ in warc.parse_file(b"".join(members))] == ["response"] + ["continuation"] * (len(members) - 1)
    raw = zlib.decompress(members[0], 31)
    with pytest.raises(ValueError):
        list(warc.parse_file(__import__("gzip").compress(raw[:-6] + b"\r\n\r\n")))


def test_files_of_other_writers():
    import gzip

    record = lambda name, block: f"WARC/1.0\r\nwarc-type: response\r\nWARC-RECORD-ID:<{name}>\r\nWarc-Target-Uri: http://x/\r\n  y\r\ncontent-length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    one, two = record("a", b"first \r\n\r\n block"), record("b", b"")
    for data in (one + two, gzip.compress(one + two), gzip.compress(one) + gzip.compress(two)):
        found = list(warc.parse_file(data))
        assert [(f["WARC-Record-ID"], f.get("WARC-Type"), f["WARC-Target-URI"], b) for f, b in found] == [("<a>", "response", "http://x/ y", b"first \r\n\r\n block"), ("<b>", "response", "http://x/ y", b"")]
    assert "Warc-Record-Id" in found[0][0] and "other" not in found[0][0] and list(warc.parse_file(b"")) == []
    for bad in (one[:-5], b"WARC/1.0\r\nno end", gzip.compress(one)[:-9], one + b"more", b"junk"):
        with pytest.raises((ValueError, warc.zlib.error)):
            list(warc.parse_file(bad))


def test_lost_segments_are_found(spark):
    parts = [("r", "response", 1, "u", None, "d", "o", 1, None, b"ab", None, None), ("s", "continuation", None, None, None, "", "o", 3, 3, b"c", None, None)]
    df = spark.createDataFrame(parts, warc._RECORD)
    with pytest.raises(Exception, match="missing"):
        warc.reassemble(df).collect()


def rule_of(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut].lower(), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    for what, rule in sorted(url_filter.RULES, key=lambda x: -len(x[1])):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            return host, path, rule, what
    return host, path, None, None


def scores(rows, damping=url_filter.DAMPING):
    """Relative masses and ranks of each host, by dense matrices."""
    import numpy as np

    pages_of = collections.defaultdict(lambda: [0, 0, 0])
    links = collections.Counter()
    for _, url, html in rows:
        host, _, _, what = rule_of(url)
        if not host:
            continue
        pages_of[host][0] += what == "allow"
        pages_of[host][1] += what == "block"
        pages_of[host][2] += 1
        for href in re.findall(r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", html or ""):
            if not re.match(r"(?i)(mailto|javascript|tel|data):", href):
                m = re.match(r"(?i)(?:[a-z][a-z0-9+.-]*:)?//([^/?#]+)", href)
                links[host, m[1].lower() if m else host] += 1
    hosts = sorted({*pages_of, *(h for pair in links for h in pair)})
    at = {h: i for i, h in enumerate(hosts)}
    count = np.zeros((len(hosts), len(hosts)))
    for (a, b), n in links.items():
        count[at[a], at[b]] = n
    share = lambda x: np.divide(x, x.sum(axis=1, keepdims=True), out=np.zeros_like(x), where=x.sum(axis=1, keepdims=True) > 0)
    seeds = [np.array([pages_of[h][k] / pages_of[h][2] if h in pages_of else 0.0 for h in hosts]) for k in (0, 1)]
    out = {}
    for name, way, seed in (("trust", share(count), seeds[0]), ("distrust", share(count.T), seeds[1])):
        solve = lambda v, w=way: np.linalg.solve(np.eye(len(hosts)) - damping * w.T, (1 - damping) * v)
        rank, every = solve(seed), solve(np.ones(len(hosts)))
        # The textbook's way to the same distribution: rank at hosts without links goes back to the seeds.
        v, none = seed / seed.sum(), (way.sum(axis=1) == 0).astype(float)
        full = damping * (way.T + np.outer(v, none))
        assert np.allclose(np.linalg.solve(np.eye(len(hosts)) - full, (1 - damping) * v), rank / rank.sum())
        out[name], out["relative_" + name] = rank / rank.sum(), rank / every
    return {h: {k: x[i] for k, x in out.items()} for h, i in at.items()}


def test_url_rules_and_propagation(spark, data):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">x</a>' for h in hosts)
    rows = ODD + [
        (20, "HTTP://Bad.NET/p", link("good.org")), (21, "http://farm.example.edu/1", link("bad.net", "bad.net")), (22, "http://farm2.example.edu/1", link("farm.example.edu")),
        (23, "http://clean.edu/a", link("good.org")), (24, "http://good.org/fr/1", link("clean.edu") + "<a href='/in'>i</a> <a href=mailto:x@y>m</a>"), (25, "http://www.Example.net/en/x?q#f", ""), (26, "http://example.net/enx", ""), (27, "http://notexample.net?x/en/", ""),
        (28, "http://sub.example.com/de/", ""), (29, "http://example.com/de", ""), (30, "x://y://z.net/", ""), (31, "http:///path", ""),
    ] + [(100 + r[0], r[1], r[2]) for r in spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").collect()]
    state = scores(rows)
    wanted = collections.Counter()
    for i, url, _ in rows:
        host, path, rule, what = rule_of(url)
        own = state.get(host, {"relative_trust": 0, "relative_distrust": 0})
        bad = own["relative_distrust"] >= url_filter.THRESHOLD and own["relative_distrust"] > own["relative_trust"]
        wanted[i, host, path, rule, what or ("block" if bad else "allow")] += 1
    found = collections.Counter(map(tuple, url_filter.judge_urls(pages(spark, rows)).collect()))
    assert found == wanted
    own = {r.host: r.asDict() for r in url_filter.host_scores(pages(spark, rows)).collect()}
    assert own.keys() == state.keys() and all(abs(own[h][k] - x) < 1e-6 for h in own for k, x in state[h].items())
    assert abs(sum(x["trust"] for x in own.values()) - 1) < 1e-9 and abs(sum(x["distrust"] for x in own.values()) - 1) < 1e-9
    assert own["farm.example.edu"]["distrust"] > own["farm2.example.edu"]["distrust"] > own["clean.edu"]["distrust"] == 0 and own["clean.edu"]["trust"] > 0
    assert url_filter.judge_urls(pages(spark, [])).count() == 0


def test_a_popular_blocked_host_hands_on_no_more_in_all(spark):
    link = lambda host: f'<a href="http://{host}/x">x</a>'
    rows = [(1, "http://bad.net/", ""), (2, "http://hub.net/", ""), (3, "http://one.edu/", link("bad.net"))] + [(10 + k, f"http://many{k}.edu/", link("hub.net") + link("news.org")) for k in range(40)]
    own = {r.host: r for r in url_filter.host_scores(pages(spark, rows)).collect()}
    assert own["bad.net"].distrust == pytest.approx(own["hub.net"].distrust)
    assert own["one.edu"].distrust == pytest.approx(sum(own[f"many{k}.edu"].distrust for k in range(40)))
    found = {r.host: r.verdict for r in url_filter.judge_urls(pages(spark, rows)).collect()}
    assert found["one.edu"] == "block" and {found[f"many{k}.edu"] for k in range(40)} == {"allow"}


def test_links_alone_block_a_farm_and_no_neighbour(spark):
    link = lambda n, host: f'<a href="http://{host}/x">x</a>' * n
    rows = [
        (1, "http://bad.net/", link(1, "plain.edu")), (2, "http://farm.edu/1", link(50, "bad.net") + "<a href=/in>i</a>"), (3, "http://farm.edu/2", link(49, "bad.net")),
        (4, "http://clean.edu/", link(9, "plain.edu") + link(1, "bad.net")), (5, "http://plain.edu/", "<a href=/in>i</a>"), (6, "http://linked.edu/", ""), (7, "http://farm.edu/3", link(1, "linked.edu")),
    ]
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages(spark, rows)).collect()}
    assert found == {1: ("net/", "block"), 2: (None, "block"), 3: (None, "block"), 7: (None, "block"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow")}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- ad --><div class="ad">Buy</div>
<article><header><h1>Head &amp; line</h1></header><p><b>One  two.<br>
<p>Three &lt;b&gt; four <span class="share">Share</span>five</p><div class="comments"><p>Nice!</p></div><aside>Side</aside><form>Name <input value="a>b"></form>last</article><footer>&copy; x</footer></body></html>"""


def test_blocks_of_a_marked_article(spark):
    assert html_text.text_of(PAGE) == "Head & line\nOne two.\nThree <b> four\nfive\nlast"
    assert html_text.text_of(None) == html_text.text_of("") == html_text.text_of("<script>x") == html_text.text_of("<!-- x") == ""
    assert html_text.text_of("a < b and <p>c") == "a < b and\nc"
    assert html_text.text_of("<div hidden>x</div><span class=ad>y <span>z</span> w</span>v") == "v"


def test_differencing_of_unmarked_pages(spark, data):
    page = lambda *own: "<div>Welcome all</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>See you</div>"
    rows = [(1, "http://h/a/1", page("one", "two")), (2, "http://h/a/2", page("three")), (3, "http://h/b", page("four")), (4, "http://other/a", page("five")), (5, "http://h5/a/1", PAGE), *[(10 + (r[0] or 0), r[1], r[2]) for r in ODD]]
    found = {r.page_id: r for r in html_text.extract_text(pages(spark, rows)).collect()}
    assert found[1].text == "one\ntwo" and found[2].text == "three" and found[3].text == "four"
    assert found[4].text == "Welcome all\nfive\nSee you"
    assert found[5].text == html_text.text_of(PAGE) and found[5].n_chars == len(found[5].text)
    assert found[11].text == "" and found[11].n_chars == 0
    assert html_text.extract_text(pages(spark, rows)).count() == len(rows)
    assert html_text.extract_text(pages(spark, [])).count() == 0
    table = spark.read.parquet(f"{data}/pages.parquet")
    texts = {r[0]: r[1] for r in html_text.extract_text(table).select("page_id", "text").collect()}
    assert texts == {r[0]: html_text.text_of(r[1]) for r in table.select("page_id", "html").collect()} and all(texts.values())


class Articles(html.parser.HTMLParser):
    """An independent reading of pages whose article is marked once and holds headings, paragraphs and inline elements."""

    def __init__(self):
        super().__init__()
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if tag in ("article", "h1", "h2", "p", "div", "ul", "li"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag in ("article", "h1", "h2", "p", "div", "ul", "li"):
            self.blocks.append("")
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data


def test_text_of_the_table_by_another_parser(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract_text(table).collect()}
    for r in table.collect():
        other = Articles()
        other.feed(r.html)
        other.close()
        assert found[r.page_id] == "\n".join(x for x in (re.sub(r"\s+", " ", b).strip() for b in other.blocks) if x)


@pytest.mark.parametrize("part", ["<a ", "<div a='b\" ", '<p a="', "</p>", "<x><p></p>", "<li>", "<span class=related>", "<!-- ", "<![", "<a b=", "<i x=1><", "a<b ", "<div><span class='ad'>", "<a b='>' "])
def test_parser_is_linear_on_malformed_pages(part):
    start = time.perf_counter()
    html_text.blocks_of("<div class='related'><span id=q>" + "<y>" * 4000 + part * (2_000_000 // len(part)))
    assert time.perf_counter() - start < 20


def test_differencing_decides_what_is_the_article(spark):
    story = "".join(f"<p>Sentence {{0}} {k} of a story that is longer than its teaser.</p>" for k in range(4))
    teaser = "<div>Welcome</div><article><p>Read our other story</p></article>"
    inner = "<article><h1>{0}</h1><section class='share-prices'><p>Prices {0}</p></section><div class='notice-board related'><p>Board {0}</p><p>Shared board</p></div><div class='comments'><p>Nice {0}</p></div><p>quoted</p></article>"
    two = "<article><p>Everywhere</p></article><article><p>Own {0}</p></article>"
    rows = [(10 * k + i, f"http://{h}/{i}", t.format(f"w{i}")) for k, (h, t) in enumerate([("t", teaser + story), ("c", inner), ("m", two)]) for i in range(3)]
    found = {r.page_id: r.text for r in html_text.extract_text(pages(spark, rows)).collect()}
    for i in range(3):
        assert found[i] == "\n".join(f"Sentence w{i} {k} of a story that is longer than its teaser." for k in range(4))
        assert found[10 + i] == f"w{i}\nPrices w{i}\nBoard w{i}\nquoted"
        assert found[20 + i] == f"Own w{i}"
    alone = html_text.extract_text(pages(spark, [(1, "http://t/1", rows[0][2]), (2, "http://c/1", rows[3][2])])).collect()
    assert {r.page_id: r.text.split("\n")[-1] for r in alone} == {1: "Sentence w0 3 of a story that is longer than its teaser.", 2: "quoted"}


@pytest.mark.parametrize("partitions", ["1", "4"])
def test_copies_are_no_neighbours(spark, monkeypatch, partitions):
    page = lambda *own: "<div>Welcome</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>Bye</div>"
    rows = [(i, f"http://h/b/{i:03d}", page("copied")) for i in range(50)] + [(60, "http://h/a", page("one")), (61, "http://h/c/1", page("copied", "more"))]
    rows += [(70, "http://only/1", page("x")), (71, "http://only/2", page("x")), (72, "http://mark/1", page("y")), (73, "http://mark/2", page("y").replace("<p>", "<article><p>")), (74, "http://mark/3", page("z"))]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {r.page_id: r.text for r in html_text.extract_text(pages(spark, ODD + rows)).collect() if r.page_id is None or r.page_id not in (5, 6)}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[60] == "one" and found[61] == "more"
    assert {found[i] for i in range(10, 50)} == {"copied"}
    assert found[70] == found[71] == "Welcome\nx\nBye"
    assert found[72] == "y" and found[73] == "y\nBye" and found[74] == "z"


def test_equal_pages_keep_their_text(spark):
    found = {r.page_id: r.text for r in html_text.extract_text(pages(spark, ODD)).collect()}
    assert found[3] == found[4] == "same"


@pytest.mark.parametrize("cells", [html_text.MOST_CELLS, 6])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, cells):
    monkeypatch.setattr(html_text, "MOST_CELLS", cells)
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        own = html_text.shared_lines(a, b)
        assert len(own) == len(set(own)) == table[-1][-1] and own == sorted(own)
        rest = iter(b)
        assert all(a[i] in rest for i in own)

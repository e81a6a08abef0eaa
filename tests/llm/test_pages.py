"""Operators over pages against brute force, on the small tables and on odd rows."""

import base64
import hashlib
import html
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest

from layercake.llm import link_rank, max_segment, queries, warc_revisit

SCHEMA = "page_id long, url string, html string, verdict int"


def pages(sf):
    return pq.read_table(f"{sf}/pages.parquet").to_pylist()


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(5, "http://A.b.ORG/x y", "<p>one</p>", 1), (3, "http://c.com/de/", "<p>one</p>", 1), (4, None, None, 1),
            (None, "no scheme", "<p>one</p>", None), (3, "http://c.com/fr/#a", "<p>one</p>", 2), (8, "x://", "", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archives_round_trip(spark, sf):
    rows, first = sorted(pages(sf), key=lambda r: r["page_id"]), {}
    for r in rows:
        first.setdefault(digest(r["html"]), r["page_id"])
    got = {r.page_id: r for r in queries.op4_warc_revisit(spark, sf).collect()}
    for r in rows:
        g, d = got[r["page_id"]], digest(r["html"])
        again = first[d] != r["page_id"]
        assert (g.payload_bytes, g.payload_digest) == (len((r["html"] or "").encode()), d)
        assert (g.record_type, g.refers_to) == (("revisit", first[d]) if again else ("response", None))


def test_archives_of_odd_rows(spark, odd_pages):
    got = warc_revisit.archive_round_trip(odd_pages).collect()
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=str) == sorted(
        [(5, "revisit", 3), (3, "response", None), (3, "response", None), (4, "response", None),
         (None, "revisit", 3), (8, "revisit", 4)], key=str)
    least = warc_revisit.archive_round_trip(odd_pages, min_bytes=5).collect()
    assert sum(r.record_type == "revisit" for r in least) == 2
    assert warc_revisit.archive_round_trip(odd_pages.limit(0)).count() == 0


def test_main_text(spark, sf):
    got = {r.page_id: r for r in queries.op7_max_segment(spark, sf).collect()}
    for r in pages(sf):
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<br>|</?(b|i|a)\b[^>]*>", " " if "<br>" in b else "", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"]].text == want and got[r["page_id"]].n_chars == len(want)


def test_main_text_leaves_boilerplate_out(spark):
    body = "<p>" + "Main words of this page go on. " * 10 + "</p>"
    page = (f"<html><head><title>t</title><script>a('<p>x</p>')</script></head><body><nav><a href=/>home</a></nav>"
            f"<header><a href=/>site</a></header><main><h1>Head &amp; line</h1>{body}<aside>side</aside>"
            f"<form>name</form><p>End\n  here.</p></main><div class='comments'><p>first!</p></div>"
            f"<footer>&copy; me</footer></body></html>")
    df = spark.createDataFrame([(i, "u", page, 0) for i in range(30)] + [(90, None, None, 1), (91, "", "<div>", 1)], SCHEMA)
    got = {r.page_id: r.text for r in max_segment.main_text(df).collect()}
    want = "Head & line\n\n" + ("Main words of this page go on. " * 10).strip() + "\n\nEnd here."
    assert got[0] == want and got[90] == "" and got[91] == ""
    assert max_segment.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("mark", [
    '<img class="banner">', '<hr class="related">', '<input class="subscribe">', '<div class="ad"/>',
    "<p class=notice>GONE", "<ul><li class=social>GONE</ul>", "<ul><li class=social>GONE<li>Item.</ul>",
    "<dl><dt class=ad>GONE<dd>Item.</dl>", "<table><tr class=ad><td>GONE<tr><td>Item.</table>",
    "<div><p class=notice>GONE</div>", '<span class="ad">GONE <span>GONE</span> GONE</span>',
    '<svg width="1"/>', "<svg><title/><svg/><g>GONE</g></svg>", "<datalist><option>GONE<option value=b></datalist>",
    "<button-group>Item.</button-group>", "<title-bar>Item.</title-bar>", "<select><option>GONE</select>",
    "<button>", "<button>GONE</button>", "<script>GONE</script >", "<aside>GONE<p>GONE</aside>", "<!-- GONE -->"])
def test_main_text_goes_on_after(mark):
    words = "Main words of this page go on. " * 5
    got = max_segment.extract(f"<main><p>{words}</p>{mark}<p>{words}</p><p>{words}End.</p></main>", {})
    want = [words.strip(), *["Item."] * ("Item." in mark), words.strip(), words + "End."]
    assert got.split("\n\n") == want


def test_raw_text_runs_to_the_end():
    for name in ("script", "style", "textarea", "title", "!--"):
        assert max_segment.extract(f"<p>Some words here.</p><{name}><p>never shown</p>", {}) == "Some words here."


def test_rules(spark, sf, odd_pages):
    rules = [(h + p, v) for v, h, p in link_rank.RULES]
    for r in queries.op8_link_rank(spark, sf).collect() + link_rank.judge(odd_pages).collect():
        fits = [(len(k), k, v) for k, v in rules for h, _, p in [k.partition("/")]
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith("/" + p)]
        assert r.rule == (max(fits)[1] if fits else None)
        assert not fits or r.verdict == max(fits)[2]
    got = sorted((r.host, r.path) for r in link_rank.judge(odd_pages).collect())
    assert got == [("", ""), ("", ""), ("", ""), ("a.b.org", "/x y"), ("c.com", "/de/"), ("c.com", "/fr/")]
    assert link_rank.judge(odd_pages.limit(0)).count() == 0


def test_trust_and_distrust_follow_links(spark):
    a = "<a href='{}'>x</a>"
    df = spark.createDataFrame([
        (1, "http://good.org/", a.format("http://fine.net/p"), 0), (2, "http://fine.net/", "", 0),
        (3, "http://bad.com/de/", "", 0), (4, "http://spam.net/", a.format("//BAD.com/x"), 0),
        (5, "http://mixed.net/", a.format("http://good.org/") + a.format("http://far.net/"), 0)], SCHEMA)
    got = {r.page_id: r for r in link_rank.judge(df).collect()}
    # brute force over the four edges
    edges = {("good.org", "fine.net"): 1, ("spam.net", "bad.com"): 1, ("mixed.net", "good.org"): 1, ("mixed.net", "far.net"): 1}

    def walk(seed, back):
        mass = dict(seed)
        for _ in range(10):
            new = {h: 0.15 * m for h, m in seed.items()}
            for (s, d), n in edges.items():
                s, d = (d, s) if back else (s, d)
                out = sum(v for (x, y), v in edges.items() if (y if back else x) == s)
                new[d] = new.get(d, 0) + 0.85 * mass.get(s, 0) * n / out
            mass = new
        return mass

    trust, bad = walk({"good.org": 1.0}, False), walk({"bad.com": 1.0}, True)
    for r in got.values():
        assert abs(r.trust - trust.get(r.host, 0)) < 1e-9 and abs(r.distrust - bad.get(r.host, 0)) < 1e-9
    assert [got[i].verdict for i in (1, 2, 3, 4, 5)] == ["allow", "allow", "block", "block", "allow"]


def test_walks_settle_on_long_chains_and_cycles(spark):
    a = "<a href='http://{}/'>x</a>"
    names = [f"h{i}.net" for i in range(14)]
    links = {names[i]: [names[i - 1]] for i in range(2, 14)} | {"h1.net": ["bad.com"], "x.net": ["y.net"]}
    links |= {"good.org": ["x.net"], "y.net": ["x.net", "bad.com"]}
    rows = [(i, f"http://{h}/", "".join(map(a.format, to)), 0) for i, (h, to) in enumerate(links.items())]
    got = {r.host: r for r in link_rank.judge(spark.createDataFrame(
        [*rows, (99, "http://bad.com/de/", "", 0)], SCHEMA)).collect()}
    assert all(got[h].verdict == "block" for h in names[1:])
    hosts = sorted(got)
    for kind, seed in (("trust", "good.org"), ("distrust", "bad.com")):
        step = np.zeros((len(hosts), len(hosts)))
        for s, to in links.items():
            for d in to:
                x, y = (s, d) if kind == "trust" else (d, s)
                step[hosts.index(y), hosts.index(x)] = 1
        step /= np.maximum(step.sum(axis=0), 1)
        settled = np.linalg.solve(np.eye(len(hosts)) - 0.85 * step, 0.15 * (np.array(hosts) == seed))
        assert np.allclose([got[h][kind] for h in hosts], settled, rtol=1e-5, atol=0)


@pytest.mark.parametrize("unit", ["<a href='", "<a x'>y'", "<script ", "<svg><script/>", "</script ", "<!", "<option ",
                                  "<a<a", "<a\" '", "<p><div>"])
@pytest.mark.parametrize("tail", ["", ">"])
def test_broken_markup_takes_linear_time(unit, tail):
    page = "<p>Some words here.</p>" + unit * (200_000 // len(unit)) + tail
    began = time.process_time()
    max_segment.extract(page, {})
    assert time.process_time() - began < 5


def test_tag_ends():
    assert max_segment.tokens("a<b x='>' y=\">\">c</b>d < e") == [
        ("text", "", "a"), ("open", "b", ""), ("text", "", "c"), ("close", "b", ""), ("text", "", "d < e")]
    # a quote that is never closed: the first > of all ends the tag
    assert max_segment.tokens("<b x='>c<i>d") == [("open", "b", ""), ("text", "", "c"), ("open", "i", ""), ("text", "", "d")]

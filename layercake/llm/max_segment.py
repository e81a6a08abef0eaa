"""Operator 7: main text of web pages by a maximum-scoring subsequence.

Words score positive and tags negative.  The weights come from labelled pages: pages that
mark their content with ``<article>`` or ``<main>``.  Over all of them Spark counts how often
each tag and the words next under it stand inside and outside the marked part; log-odds of
these counts, clipped to the side asked for, are the weights.  Kadane's linear scan finds the
best contiguous region of a page; boilerplate elements inside it are left out.

Edge cases: NULL and empty pages, and pages without words, have empty text; void and
self-closing elements hold nothing; unclosed elements end where HTML implies it or with their
parent, misnested tags are taken as they come; without any labelled page the default weights hold;
repeated rows are extracted each; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import html as entities
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..names import col as named

#: Element names by their part in a page.
RAW = frozenset("script style title textarea".split())
DROPPED = frozenset("noscript template iframe svg select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
SKIP = frozenset("nav footer aside form dialog menu".split())
SKIP_NAMES = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie "
                       "cookies footer menu nav navbar newsletter notice popup promo related share sharing sidebar "
                       "social sponsor sponsored subscribe toolbar widget".split())
CONTENT = frozenset(["article", "main"])
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
OPTION_END = re.compile(r"</option\s*>", re.I)
MARKS = re.compile(r"[>\"']")
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Tags seen fewer times than this in labelled pages keep the default weights.
LEAST_SEEN, DEFAULT_TAG, DEFAULT_WORD, FLOOR = 20, -3.0, 1.0, 0.05


#: Unquoted values may end in a slash, which closes nothing.
UNQUOTED_END = re.compile(r"=\s*[^\s\"'>]*/$")


def _implied() -> dict[str, tuple[frozenset[str], frozenset[str]]]:
    """Per opened element: the elements whose end HTML implies there, and those that bar it."""
    bar = frozenset("html body table caption td th object button template ul ol menu dir dl datalist section article "
                    "main aside nav header footer form fieldset blockquote figure details dialog".split())
    out = {x: (frozenset(["p"]), bar) for x in (
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
        "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul").split()}
    table = frozenset(["table"])
    for names, also in (("li", "p"), ("dt dd", "p")):
        out |= {x: (frozenset([*names.split(), also]), bar) for x in names.split()}
    out |= {x: (frozenset(["td", "th"]), table | {"tr"}) for x in ("td", "th")}
    out["tr"] = frozenset(["tr"]), table
    out |= {x: (frozenset("thead tbody tfoot tr caption colgroup".split()), table) for x in ("thead", "tbody", "tfoot")}
    out |= {x: (frozenset(["rt", "rp"]), frozenset(["ruby"])) for x in ("rt", "rp")}
    return out


IMPLIED, NONE = _implied(), (frozenset(), frozenset())


class TagEnds:
    """Where a tag's ``>`` stands: the first one outside quotes, or, where a quote is never
    closed, the first one at all.  The marks of a page are read once, so that unclosed quotes
    cost no further passes."""

    def __init__(self, page: str) -> None:
        marks = [(m.start(), m.group()) for m in MARKS.finditer(page)]
        self.page, self.at = page, [i for i, _ in marks]
        self.outside = [-1] * (len(marks) + 1)
        later = {"'": -1, '"': -1}
        for x in range(len(marks) - 1, -1, -1):
            i, mark = marks[x]
            if mark == ">":
                self.outside[x] = i
            else:
                # an opening quote leads behind the next one like it
                self.outside[x] = self.outside[later[mark] + 1] if later[mark] >= 0 else -1
                later[mark] = x

    def after(self, begin: int) -> int:
        end = self.outside[bisect.bisect_left(self.at, begin)]
        return end if end >= 0 else self.page.find(">", begin)


def tags(page: str, in_svg: Callable[[], bool]) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, close, name, attributes) of a page's mark-up, in one pass.  Comments,
    declarations, options and raw text have no name; a ``<`` that no ``>`` follows is text."""
    last, at, ends = page.rfind(">"), 0, TagEnds(page)
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            yield start, at, "", "", ""
            continue
        if start > last:
            continue
        if page[at] in "!?":
            at = page.find(">", at) + 1
            yield start, at, "", "", ""
            continue
        m = NAME.match(page, start)
        if not m:
            continue
        close, name, begin = m[1], m[2].lower(), m.end()
        if not close and name in RAW:
            at = page.find(">", begin) + 1
            if not (page[at - 2] == "/" and in_svg()):
                ended = RAW_END[name].search(page, at)
                at = (page.find(">", ended.end()) + 1 if ended else 0) or len(page)
            yield start, at, "", "", ""
        elif not close and name == "option":
            at = page.find("<", page.find(">", begin))
            ended = OPTION_END.match(page, at) if at >= 0 else None
            at = ended.end() if ended else at if at >= 0 else len(page)
            yield start, at, "", "", ""
        else:
            at = ends.after(begin) + 1
            yield start, at, close, name, page[begin:at - 1]


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(kind, name, text): kind is open, void (opened and closed at once), close or text;
    boilerplate by class counts as ``x-skip``.  Only raw text and comments run to the page's
    end; of a DROPPED element that is never closed only the tag goes."""
    out, at, opened, held = [], 0, [], Counter()
    for start, end, close, name, attrs in tags(page, lambda: held["svg"] > 0):
        if start > at:
            out.append(("text", "", page[at:start]))
        at = end
        if not name:
            continue
        ended = name in VOID or attrs.endswith("/") and not UNQUOTED_END.search(attrs)
        if name in DROPPED:
            if not close and not ended:
                opened.append((name, len(out)))
                held[name] += 1
            elif close and held[name]:
                inner = ""
                while inner != name:
                    inner, begin = opened.pop()
                    held[inner] -= 1
                del out[begin:]
        elif close:
            out.append(("close", name, ""))
        elif ended:
            out.append(("void", name, ""))
        elif name not in SKIP and name not in CONTENT and attrs and any(
                SKIP_NAMES.intersection(re.split(r"[\s_-]+", "".join(g).lower())) for g in NAMES.findall(attrs)):
            out.append(("open", f"{name} x-skip", ""))
        else:
            out.append(("open", name, ""))
    if at < len(page):
        out.append(("text", "", page[at:]))
    return out


def parsed(page: str) -> list[tuple[str, str, str, int, int]]:
    """Tokens with, per text, the block element that it stands under, the words of it, and where
    the innermost boilerplate element around it opened (-1: none).

    Elements end at their close tag, where HTML implies their end, or with their parent.
    """
    out, under, held, skips = [], [], Counter(), []

    def shut(depth: int) -> None:
        held.subtract(bare for bare, _ in under[depth:])
        del under[depth:]
        while skips and skips[-1][0] >= depth:
            skips.pop()

    for kind, name, text in tokens(page):
        bare = name.split(" ")[0]
        if kind == "text":
            out.append((kind, under[-1][1] if under else "", text, len(text.split()), skips[-1][1] if skips else -1))
            continue
        block = bare not in INLINE or bare == "a"
        if kind == "close":
            if held[bare]:
                depth = next(i for i in range(len(under) - 1, -1, -1) if under[i][0] == bare)
                name = under[depth][1] if block else name
                shut(depth)
        else:
            ends, bars = IMPLIED.get(bare, NONE)
            if left := sum(held[x] for x in ends):
                depth = None
                for i in range(len(under) - 1, -1, -1):
                    if under[i][0] in ends:
                        depth, left = i, left - 1
                    if not left or under[i][0] in bars:
                        break
                if depth is not None:
                    shut(depth)
            skip = bare in SKIP or name.endswith("x-skip")
            if kind == "open" and (block or skip or skips):
                if skip:
                    skips.append((len(under), len(out)))
                under.append((bare, name if block else under[-1][1] if under else ""))
                held[bare] += 1
        out.append(("close" if kind == "close" else "open", name, "", 0, -1))
    return out


def label_counts(page: str) -> Counter:
    """(token, inside) counts of a page with marked content; empty for other pages."""
    seq, out = parsed(page), Counter()
    opens = [i for i, t in enumerate(seq) if t[0] == "open" and t[1] in CONTENT]
    closes = [i for i, t in enumerate(seq) if t[0] == "close" and t[1] in CONTENT]
    if not opens or not closes or opens[0] > closes[-1]:
        return out
    for i, (kind, name, _, n, _) in enumerate(seq):
        inside = opens[0] < i < closes[-1]
        if kind == "text":
            if n:
                out[f"w {name if name not in CONTENT else ''}", inside] += n
        elif name not in CONTENT:
            out[f"t {name}", inside] += 1
    return out


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights per token from all labelled pages of ``pages`` (column html)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            total = Counter()
            for page in pdf["html"]:
                total.update(label_counts(page))
            yield pd.DataFrame([(k, i, n) for (k, i), n in total.items()], columns=["token", "inside", "n"])

    counts = pages.filter(F.col("html").rlike("(?i)<(article|main)\\b")).mapInPandas(
        run, "token string, inside boolean, n long").groupBy("token").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("b")).filter(
        F.col("a") + F.col("b") >= LEAST_SEEN)
    # a page can invent element names: only the 5,000 most frequent tokens are weighed
    rows = counts.orderBy(F.desc(F.col("a") + F.col("b")), "token").limit(5000).collect()
    weights = {}
    for token, a, b in rows:
        odds = math.log((a + 0.5) / (b + 0.5))
        weights[token] = max(FLOOR, min(odds, 4.0)) if token[0] == "w" else min(-FLOOR / 50, odds)
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the maximum-scoring contiguous run; empty if nothing is positive."""
    best, start, end, run, begin = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, begin = 0.0, i
        run += s
        if run > best:
            best, start, end = run, begin, i + 1
    return start, end


def extract(page: str, weights: dict[str, float]) -> str:
    """The main text: blocks of the best region joined by blank lines."""
    seq = parsed(page)
    scores = [n * weights.get(f"w {name if name not in CONTENT else ''}", DEFAULT_WORD) if kind == "text"
              else (0.0 if name in CONTENT else weights.get(
                  f"t {name}", 0.0 if name in INLINE and name != "a" else DEFAULT_TAG)) for kind, name, _, n, _ in seq]
    start, end = best_region(scores)
    blocks, now = [], []
    for kind, name, text, _, skip in seq[start:end]:
        bare = name.split(" ")[0]
        if kind == "text":
            if skip < start:
                now.append(text)
        elif bare == "br":
            now.append(" ")
        elif bare not in INLINE:
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    clean = (" ".join(entities.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    picked = pages.select(named(id_col).cast("string").alias("page_id"), named(url_col).alias("url"),
                          F.coalesce(named(html_col), F.lit("")).alias("html"))
    weights = learn(picked.select("html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"],
                                "text": [extract(p, weights) for p in pdf["html"]]})

    return picked.mapInPandas(run, "page_id string, url string, text string").select(
        F.col("page_id").cast("long"), "url", "text", F.length("text").cast("long").alias("n_chars"))

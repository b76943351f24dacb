"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags.  Words score positive and tags negative
(words inside menus, forms, adverts and the like score as markup), with weights
learned from labelled pages: pages whose own markup names one article, and a
few templates labelled by hand.  One linear scan finds the contiguous region of
the greatest total; the text of that region, without the elements that are
never part of an article, is the result.

Null and empty pages give an empty text.  Each input row gives one row.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages read at most for training, chosen by a hash of their id and url.
SAMPLE = 2_000
#: Elements whose content is no text; elements that are never part of an article; class, id and role words that mark such elements.
RAW = ("script", "style", "title", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "video", "audio", "textarea", "select")
ASIDE = ("nav", "footer", "aside", "form", "header", "button", "dialog", "menu", "label", "input")
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|adsense|banner|promo|promotion|sponsor|sponsored|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|overlay"
    r"|comment|comments|disqus|replies|respond|sidebar|side|widget|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|toc|footer|foot|header|masthead|topbar|share|sharing|social"
    r"|related|recommended|newsletter|subscribe|signup|login|search|pagination|pager|skip|toolbar|complementary|contentinfo)(?:$|[\s_-])")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
KNOWN = INLINE | VOID | set(ASIDE) | set(RAW) | {"html", "head", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
                                                 "table", "thead", "tbody", "tr", "td", "th", "blockquote", "pre", "figure"}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?>(?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*)(?:(?<=/)>|>(?:.*?</(?P=raw)\s*>|.*\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
#: Share of a page's words from which on a marked element is the page itself, whatever its class says.
MOST = 0.9
_NAMED = re.compile(r"<(?:article|main)\b", re.I)
#: A class such as "has-sidebar" describes the page around an element, not the element.
AROUND = re.compile(r"(?:^|[\s_-])(?:has|with|without|no)(?:$|[\s_-])")
_MARK = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

#: Pages labelled by hand: the article stands between the two marks.
TEMPLATES = (
    "<body><div class='top'><ul><li><a>Home</a></li><li><a>News</a></li><li><a>About us</a></li></ul></div><div id=content>@@<h1>A walk along the river</h1><p>We left early and the fog still lay on the water when the first boats came past.</p><p>Nobody spoke until noon, and then only about the bread.</p>@@</div><div class='comments'><p>Great story, thanks!</p></div><div><a>Imprint</a> <a>Terms</a></div></body>",
    "<body><header><a>Site</a></header><table><tr><td><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></td><td>@@<h2>How to bake</h2><p>Mix the flour with water, add salt and wait for an hour.<p>Then heat the oven and bake until the crust is brown.@@</td></tr></table><footer>Copyright, all rights reserved</footer></body>",
    "<body><div><a>Log in</a> | <a>Register</a></div><main>@@<h1>Minutes</h1><p>The council met on Monday and agreed on the plan.</p><ul><li>The road is closed in May.</li><li>The bridge will be painted.</li></ul><blockquote>It took us long enough.</blockquote>@@</main><aside><h3>Also read</h3><ul><li><a>Budget</a></li><li><a>Schools</a></li></ul></aside></body>",
    "<body><div id='nav'><ul><li><a>Start</a></li><li><a>Contact</a></li></ul></div><div class='text'>@@<h1>What to pack</h1><p>You will need little for two days:</p><ul><li>a warm coat and a hat</li><li>good shoes for wet paths</li><li>bread, cheese and <a>a map</a></li></ul><p>The huts sell the rest.</p><table><tr><td>Hut one</td><td>open all year</td></tr><tr><td>Hut two</td><td>closed in winter</td></tr></table><p>Have a good time, and write to us.</p>@@</div><div id='footer'><a>Imprint</a></div></body>",
    "<body><div class='cookie'><p>We use cookies.</p><button>Accept</button></div><section>@@<p>A short note on the weather, which was mild and dry for most of the week.</p>@@</section><form><input><label>Mail</label><button>Subscribe</button></form><div class='sidebar'><p>Popular posts</p><a>First</a><a>Second</a></div></body>",
)


class Page:
    """Tokens of one page: (feature, text, drop); text is "" for a tag that ends a block and None for other markup."""

    def __init__(self, source: str):
        kept: frozenset[int] = frozenset()
        while more := self._read(source, kept) - kept:
            kept |= more

    def _read(self, source: str, kept: frozenset[int]) -> set[int]:
        """Reads the tokens; returns the places of marked elements (other than ``kept``) with nearly all words of the page."""
        self.tokens: list[tuple[str, str | None, bool]] = []
        open_aside: list[str] = []  # elements that are not part of an article, innermost last
        outer, seen, heavy = -1, 0, {}  # where the outermost of them starts, words of the page, words by that start
        named_before = False
        links, heads, inside = 0, 0, False
        named = bool(_NAMED.search(source))  # the page says where its article is: what stands outside is told apart
        self.article = [None, None, 0]  # first and last token inside <article>, number of them
        for m in _TOKEN.finditer(source):
            if not open_aside:
                outer = -1
            if (text := m["text"]) is not None:
                n = len(text.split())
                seen += n
                if open_aside:
                    heavy[outer] = heavy.get(outer, 0) + n
                drop = bool(open_aside) and not (heads and inside and open_aside == ["header"])
                feature = ("gap" if inside else "aside") if drop else "word" if inside else "out:word" if named else "link" if links else "word"
                self.tokens.append((feature, text, drop))
                continue
            if (name := m["name"]) is None:
                self.tokens.append(("gap" if inside else "out:tag" if named else "t:raw", None, False))
                continue
            name, end = name.lower(), bool(m["end"])
            marked = not end and m.start() not in kept and name not in ("html", "body") and bool(a := m["attrs"]) and any(
                MARKED.search(x) and not AROUND.search(x) for x in map("".join, _MARK.findall(a.lower())))
            # an article among comments or the like, or one marked so itself, is none; the page's own one ends what was left open before it
            other = name in ("article", "main") and (name in open_aside if end else marked or bool(open_aside) and named_before)
            if name in ("article", "main") and not other:
                open_aside.clear()
                named_before = True
                if name == "article":
                    if not end:
                        self.article[0], self.article[2] = len(self.tokens) + 1, self.article[2] + 1
                    elif self.article[1] is None:
                        self.article[1] = len(self.tokens)
                inside = not end
            links = max(0, links + (-1 if end else 1)) if name == "a" else links
            heads = max(0, heads + (-1 if end else 1)) if re.fullmatch("h[1-6]", name) else heads
            marked = (other and not end) or (marked and name not in ("article", "main")) or name in ASIDE and m.start() not in kept
            if end:
                if name in open_aside:
                    while open_aside.pop() != name:
                        pass
            elif name not in VOID and not m["attrs"].endswith("/") and (marked or open_aside and name in open_aside):
                if not open_aside:
                    outer = m.start()
                open_aside.append(name)
            if inside:  # what an article element holds besides its text does not end the region
                feature = "gap" if marked or open_aside else "in:tag"
            else:
                feature = "out:tag" if named else "t:marked" if marked else f"t:{'/' if end else ''}{name if name in KNOWN else 'other'}"
            self.tokens.append((feature, None if name in INLINE else "", False))
        return {at for at, n in heavy.items() if at >= 0 and n > MOST * seen}

    def text(self, first: int, last: int) -> str:
        """Text of tokens first to last: character references decoded, blocks joined by one space."""
        out = []
        for _, text, drop in self.tokens[first:last]:
            if text == "":
                out.append(" ")
            elif text is not None and not drop:
                out.append(html.unescape(text))
        return " ".join("".join(out).split())


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and past-the-last place of the contiguous stretch with the greatest sum (the longest of equals; empty if no score is positive)."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += s
        if total > best or total == best > 0:
            best, at = total, (start, i + 1)
    return at


def weights(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Scores of features from their (inside, outside) counts: log odds, held positive for words and negative for markup."""
    n1, n0 = (sum(c[k] for c in counts.values()) + 1 for k in (0, 1))
    out = {}
    for f, (a, b) in counts.items():
        odds = math.log((a + 1) / (n1 + 10)) - math.log((b + 1) / (n0 + 10))
        out[f] = max(0.5, min(3.0, odds)) if f == "word" else max(-4.0, min(-0.05, odds))
    return {"word": 1.0, "link": -0.5, "aside": -1.0, "out:word": -1.0, "out:tag": -1.0, "in:tag": -0.05} | out | {"gap": 0.0}


def count_features(page: Page, first: int, last: int) -> Counter:
    out: Counter = Counter()
    for i, (f, text, drop) in enumerate(page.tokens):
        n = len(text.split()) if text else int(not text)
        out[f, first <= i < last and not drop] += n
    return out


def learn(pages: DataFrame, html_col: str = "html", order: tuple[str, ...] = ("page_id", "url"), sample: int = SAMPLE) -> dict[str, float]:
    """Feature weights from pages with exactly one article element (at most ``sample``) and the hand-labelled templates."""
    def run(batches):
        total: Counter = Counter()
        for b in batches:
            for x in b.column(0):
                page = Page(x.as_py())
                if page.article[2] == 1:
                    total += count_features(page, page.article[0], page.article[1] or len(page.tokens))
        yield pa.RecordBatch.from_pydict({"f": [k[0] for k in total], "inside": [k[1] for k in total], "n": [float(v) for v in total.values()]},
                                         schema=pa.schema([("f", pa.string()), ("inside", pa.bool_()), ("n", pa.float64())]))

    named = pages.where(F.lower(html_col).contains("<article")).select(html_col, F.xxhash64(*order).alias("_h"))
    first = named.select("_h").orderBy("_h").limit(sample).distinct()  # hashes only: no task gathers pages
    picked = named.join(F.broadcast(first), "_h", "left_semi").select(html_col)
    rows = picked.mapInArrow(run, "f string, inside boolean, n double").groupBy("f", "inside").agg(F.sum("n").alias("n")).collect()
    counts: dict[str, list[float]] = {}
    for r in rows:
        counts.setdefault(r["f"], [0.0, 0.0])[0 if r["inside"] else 1] += r["n"]
    scale = max(1.0, sum(map(sum, counts.values())) / 5000)  # so that the templates stay a part of the whole
    for t in TEMPLATES:
        a, body, b = t.split("@@")
        page = Page(a + body + b)
        first, last = len(Page(a).tokens), len(Page(a + body).tokens)
        for (f, inside), n in count_features(page, first, last).items():
            counts.setdefault(f, [0.0, 0.0])[0 if inside else 1] += n * scale
    return weights(counts)


def extract_text(source: str | None, weight: dict[str, float]) -> str:
    """Main text of one page."""
    page = Page(source or "")
    scores = []
    for f, text, drop in page.tokens:
        if text:
            scores.append(weight[f] * len(text.split()))
        else:
            scores.append(weight.get(f, weight.get("t:other", -0.5)))
    return page.text(*best_region(scores))


def extract(pages: DataFrame, keep: list[str], html_col: str = "html", weight: dict[str, float] | None = None) -> DataFrame:
    """``keep`` of every row, ``text`` and ``n_chars`` (its code points).

    Null, empty and cut pages give what text they have.  Of regions with equal
    sums the longest of the first is taken.  Each row is read alone: repeated
    rows give equal texts, an empty table none.  Columns outside ``keep`` are
    not read, whatever their names; ``text`` and ``n_chars`` cannot be kept ones.
    """
    weight = learn(pages, html_col) if weight is None else weight

    def run(batches):
        for b in batches:
            texts = [extract_text(x.as_py(), weight) for x in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*keep, "text", "n_chars"])

    src = pages.select(*keep, html_col)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    return src.mapInArrow(run, kinds + "text string, n_chars long")

"""Main text of web pages by boosted trees over DOM nodes.

A page becomes a tree of block elements.  Boosted trees give each the probability that it belongs
to the article, from the density of text and links below it, the tokens of its attributes, its
depth and its siblings.  Decoding picks the labels of the whole tree at once, so that nothing
below a dropped node is kept.  The trees are trained here, on generated pages with known labels.
"""

from __future__ import annotations

import html as htmllib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
HIDDEN = frozenset("head script style noscript template svg iframe select button textarea object audio video canvas form annotation annotation-xml dialog".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What an opening tag ends if it is still open.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: What may stand in the head; all else ends it.
HEADLINES = frozenset("head title base link meta style script noscript template".split())
#: What only the tags of a table or page close past.
BARS = frozenset("td th table body".split())
PAST_BARS = frozenset("table tr tbody thead body html".split())
#: Where the search for what to end stops.
WALLS = frozenset("ul ol dl table tbody thead body html article section div main aside".split())
TAGS = "html body div section article main header footer nav aside p h ul li table form figure blockquote pre other".split()
_TAG_AT = {t: i for i, t in enumerate(TAGS)} | {f"h{i}": TAGS.index("h") for i in range(1, 7)} | {"ol": TAGS.index("ul"), "dl": TAGS.index("ul"), "menu": TAGS.index("nav"), "dd": TAGS.index("li"), "dt": TAGS.index("li"), "tr": TAGS.index("table"), "td": TAGS.index("table"), "th": TAGS.index("table"), "tbody": TAGS.index("table"), "thead": TAGS.index("table")}
GROUPS = {
    "menu": "nav navbar menu breadcrumb breadcrumbs pagination pager toc tabs toolbar topbar navigation links tags",
    "head": "header masthead banner hero logo branding top",
    "foot": "footer foot bottom copyright legal colophon credits",
    "side": "sidebar aside side rail related recommended widget popular trending teaser more secondary",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion promoted dfp banner-ad outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription paywall message warning disclaimer",
    "talk": "comment comments commentlist reply replies disqus discussion responses respond thread feedback",
    "share": "share sharing social follow like tweet buttons",
    "ask": "form login signin signup search register contact input field",
    "text": "article post content main story entry body text copy prose page hentry articlebody maincontent",
    "by": "byline author meta date time published timestamp",
}
_GROUP_OF = {w: i for i, ws in enumerate(GROUPS.values()) for w in ws.split()}
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@lru_cache(4096)
def attribute_groups(attrs: str) -> tuple[float, ...]:
    """Which groups of words the class, id and role of an element name."""
    on = [0.0] * len(GROUPS)
    for m in _ATTR.finditer(attrs):
        value = m[2] or m[3] or m[4] or ""
        for w in {x.lower() for x in _PIECE.findall(value)} | {value.lower()}:
            if (g := _GROUP_OF.get(w)) is not None:
                on[g] = 1.0
    return tuple(on)


class Page:
    """The block elements of a page in order, and its texts with the element that each is in."""

    def __init__(self, source: str):
        self.tag, self.attrs, self.parent, self.depth = ["html"], [""], [-1], [0]
        self.hidden = [False]
        self.events: list[tuple[int, str | None, bool]] = []  # element, text or None for a break, in a link
        self._parse(source)

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.hidden.append(self.hidden[parent] or tag in HIDDEN)
        return len(self.tag) - 1

    def _parse(self, s: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # tag, and the block that it is in or is
        places: dict[str, list[int]] = {"html": [0]}  # where in the stack each tag is open
        blocks, walls, bars = [0], [0], []  # where blocks, WALLS and BARS are
        at, end, add = 0, len(s), self.events.append
        lower = None

        def last(tag: str) -> int:
            own = places.get(tag)
            return own[-1] if own else -1

        def cut(i: int) -> bool:
            """Close all from place i on; whether a block was among it."""
            broke = False
            while len(stack) > i:
                tag = stack.pop()[0]
                places[tag].pop()
                for own in (blocks, walls, bars):
                    if own and own[-1] == len(stack):
                        own.pop()
                        broke |= own is blocks
            return broke

        while at < end:
            lt = s.find("<", at)
            if lt < 0:
                lt = end
            linked = last("a") > 0
            if lt > at:
                text = s[at:lt]
                if stack[-1][0] == "head" and text.strip():
                    cut(len(stack) - 1)
                add((stack[-1][1], text, linked))
            if lt == end:
                break
            nxt = s[lt + 1 : lt + 2]
            if nxt == "!" or nxt == "?":
                if s.startswith("<!--", lt):
                    at = s.find("-->", lt + 4)
                    at = end if at < 0 else at + 3
                else:
                    at = s.find(">", lt)
                    at = end if at < 0 else at + 1
                continue
            closing = nxt == "/"
            if not s[lt + 1 + closing : lt + 2 + closing].isalpha():
                add((stack[-1][1], "<", linked)) if not closing else None
                if closing:
                    at = s.find(">", lt)
                    at = end if at < 0 else at + 1
                else:
                    at = lt + 1
                continue
            gt = self._tag_end(s, lt + 1)
            inside = s[lt + 1 + closing : gt]
            at = gt + 1
            head, attrs = (*inside.split(None, 1), "")[:2]
            tag = head.rstrip("/").lower()
            if closing:
                i = last(tag)
                if i > 0 and (tag in PAST_BARS or not bars or i >= bars[-1]) and cut(i):
                    add((stack[-1][1], None, False))
                continue
            if stack[-1][0] == "head" and tag not in HEADLINES:
                cut(len(stack) - 1)
            if tag in VOID:
                add((stack[-1][1], None if tag == "hr" else " ", False))
                continue
            if tag in BLOCK:
                add((stack[-1][1], None, False))
                if stack[blocks[-1]][0] == "p":  # a paragraph ends where a block begins
                    cut(blocks[-1])
            if tag in ENDS and (i := max(map(last, ENDS[tag]))) > walls[-1]:
                cut(i)
            block = tag in BLOCK or tag in HIDDEN
            node = self._open(tag, attrs, stack[-1][1]) if block else stack[-1][1]
            if tag in RAW:
                if lower is None:
                    lower = s.lower() if len(s.lower()) == len(s) else re.sub("[A-Z]+", lambda m: m[0].lower(), s)
                close = lower.find(f"</{tag}", at)
                gt = s.find(">", close) if close >= 0 else -1
                at = end if gt < 0 else gt + 1
                continue
            if inside.endswith("/") and tag in ("svg", "path"):
                continue
            for own, names in ((blocks, BLOCK), (walls, WALLS), (bars, BARS)):
                if tag in names:
                    own.append(len(stack))
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, node))

    @staticmethod
    def _tag_end(s: str, at: int) -> int:
        """Where the tag that begins before `at` ends; quoted values may hold `>`."""
        gt = s.find(">", at)
        if gt < 0:
            return len(s)
        inside = s[at:gt]
        if inside.count('"') % 2 == 0 and inside.count("'") % 2 == 0:
            return gt
        m = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""").match(s, at)
        return m.end() - 1 if m else gt

    def features(self) -> np.ndarray:
        n = len(self.tag)
        chars, linked, stops, tags, paras = [0.0] * n, [0.0] * n, [0.0] * n, [1.0] * n, [0.0] * n
        first = [1e9] * n
        total = 1.0
        hidden = self.hidden
        for node, text, in_link in self.events:
            if text and not hidden[node]:
                k = len(text)
                first[node] = min(first[node], total)
                chars[node] += k
                total += k
                if in_link:
                    linked[node] += k
                stops[node] += text.count(".") + text.count(",")
        own = chars[:]
        children, same = [0] * n, {}
        index = [0] * n
        for i in range(1, n):
            p = self.parent[i]
            index[i] = children[p]
            children[p] += 1
            key = (p, self.tag[i])
            same[key] = same.get(key, 0) + 1
        biggest = [0.0] * n
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            stops[p] += stops[i]
            tags[p] += tags[i]
            paras[p] += paras[i] + (self.tag[i] == "p")
            first[p] = min(first[p], first[i])
            biggest[p] = max(biggest[p], chars[i])
        groups = [attribute_groups(a) if a else _NONE for a in self.attrs]
        inherited = [_NONE] * n
        rows = []
        tag_at = _TAG_AT.get
        other = len(TAGS) - 1
        under = [(0.0,) * 4] * n
        for i in range(n):
            p = self.parent[i]
            kind = tag_at(self.tag[i], other)
            if i:
                g, up = groups[p], inherited[p]
                inherited[i] = up if g is _NONE else tuple(map(max, g, up))
                a, m, s, f = under[p]
                t = self.tag[p]
                under[i] = (1.0 if t == "article" else a, 1.0 if t == "main" else m, 1.0 if t in ("aside", "nav") else s, 1.0 if t in ("footer", "header") else f)
            c = chars[i]
            hot = [0.0] * len(TAGS)
            hot[kind] = 1.0
            siblings = children[p] if i else 1
            rows.append(
                (*hot, *groups[i], *inherited[i], *under[i], c, linked[i] / (c + 1), stops[i] / (c + 1), c / tags[i], paras[i], own[i], self.depth[i], index[i], siblings, same.get((p, self.tag[i]), 1), min(first[i], total) / total, c / total, c / (biggest[p] + 1) if i else 1.0, float(tag_at(self.tag[p], other)) if i else -1.0)
            )
        return np.array(rows, np.float64)

    def decode(self, keep: np.ndarray) -> list[bool]:
        """The labels of least cost of all elements, if nothing below a dropped one is kept."""
        n = len(self.tag)
        p = np.clip(keep, 1e-4, 1 - 1e-4)
        yes, no = (-np.log(p)).tolist(), (-np.log(1 - p)).tolist()
        for i in range(n - 1, 0, -1):
            q = self.parent[i]
            if self.hidden[i]:
                yes[i], no[i] = 1e9, 0.0
            yes[q] += min(yes[i], no[i])
            no[q] += no[i]
        out = [True] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]] and (yes[i] <= no[i] or self.tag[i] == "body")
        return out

    def text(self, kept: list[bool]) -> str:
        blocks, now = [], []
        for node, text, _ in [*self.events, (0, None, False)]:
            if text is None:
                if now:
                    block = "".join(now)
                    block = " ".join((htmllib.unescape(block) if "&" in block else block).split())
                    if block:
                        blocks.append(block)
                    now = []
            elif kept[node] and not self.hidden[node]:
                now.append(text)
        return "\n\n".join(blocks)


_NONE = (0.0,) * len(GROUPS)


# --- generated pages -----------------------------------------------------------------------------


def generated(seed: int) -> tuple[str, str]:
    """(page, its article's text) of a random layout."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghilmnoprstuvé") for _ in range(r.randint(1, 9)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    said: list[str] = []

    def sentence(a: int = 3, b: int = 14) -> str:
        return words(a, b).capitalize() + r.choice(".....!?")

    def prose() -> str:
        style = r.random()
        if style < 0.1:
            return " ".join(word().upper() + "!!" for _ in range(r.randint(2, 90)))
        if style < 0.2:
            return " ".join(word() + r.choice(("***", "###", "%%%", "$$$")) for _ in range(r.randint(2, 90)))
        if style < 0.3:
            return " | ".join(word() for _ in range(r.randint(2, 60)))
        return " ".join(sentence() for _ in range(r.choice((1, 1, 2, 4, 8, 20))))

    def block(open_: str, close: str, text: str | None = None) -> str:
        text = text or prose()
        said.append(text)
        x = htmllib.escape(text, quote=False)
        if r.random() < 0.2:
            x = f"<b>{x}</b>" if r.random() < 0.5 else f"<b>{x}<br>"
        elif r.random() < 0.15:
            x += f' <a href="/{word()}">{(w := word())}</a>'
            said[-1] += " " + w
        return open_ + x + close

    def links(n: int, cls: str = "") -> str:
        return f"<ul{cls}>" + "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n)) + "</ul>"

    def named(*names: str) -> str:
        return r.choice((f' class="{r.choice(names)}"', f' id="{r.choice(names)}"', f' class="{word()} {r.choice(names)}-{word()}"'))

    def advert() -> str:
        return f"<div{named('ad', 'ads', 'advert', 'sponsored', 'promo')}>{sentence()}</div>"

    def notice() -> str:
        return f"<div{named('cookie-notice', 'consent', 'newsletter', 'alert', 'notice', 'popup')}><p>{sentence()}</p>{r.choice(('', '<button>OK</button>'))}</div>"

    def talk() -> str:
        t = r.choice(("section", "div", "ol", "ul"))
        inner = "li" if t in ("ol", "ul") else r.choice(("div", "p", "article"))
        return f"<{t}{named('comments', 'responses', 'discussion', 'comment-list')}>" + r.choice(("", f"<h3>{words(1, 2)}</h3>")) + "".join(f"<{inner}{r.choice(('', ' class=comment'))}>{r.choice(('', '<b>' + word() + '</b> '))}{sentence()} {sentence()}</{inner}>" for _ in range(r.randint(1, 6))) + f"</{t}>"

    def side() -> str:
        t = r.choice(("aside", "div"))
        return f"<{t}{named('sidebar', 'related', 'widget', 'side') if t == 'div' or r.random() < 0.5 else ''}><h3>{words(1, 3)}</h3>" + r.choice((links(r.randint(2, 8)), f"<p>{sentence()}</p>" * r.randint(1, 3))) + f"</{t}>"

    def share() -> str:
        return f"<div{named('share', 'social', 'tags', 'breadcrumb')}>" + "".join(f'<a href="#">{word()}</a> ' for _ in range(r.randint(2, 5))) + "</div>"

    def ask() -> str:
        return f"<form{r.choice(('', named('search', 'login', 'contact')))}><label>{words(1, 3)}</label><input name=q><button>{word()}</button></form>"

    def nav() -> str:
        t = r.choice(("nav", "nav", "div", "header"))
        return f"<{t}{named('menu', 'nav', 'navigation', 'top') if t == 'div' or r.random() < 0.3 else ''}>{links(r.randint(2, 9))}</{t}>"

    def foot() -> str:
        t = r.choice(("footer", "footer", "div"))
        return f"<{t}{named('footer', 'copyright', 'bottom') if t == 'div' or r.random() < 0.3 else ''}>{r.choice(('&copy; ' + word() + ' &middot; ', ''))}{sentence()}{r.choice(('', chr(10) + sentence(), links(3)))}</{t}>"

    def article() -> str:
        out = []
        title = block("<h1>", "</h1>", words(1, 8)) if r.random() < 0.85 else ""
        if title and r.random() < 0.2:
            title = f"<header>{title}</header>"
        for _ in range(r.choice((0, 1, 2, 3, 6, 12, 30))):
            x = r.random()
            if x < 0.78:
                out.append(block("<p>", r.choice(("</p>", "</p>", "", "\n"))))
            elif x < 0.84:
                out.append(block("<h2>", "</h2>", words(1, 6)))
            elif x < 0.88:
                out.append("<ul>" + "".join(block("<li>", "</li>") for _ in range(r.randint(1, 4))) + "</ul>")
            elif x < 0.92:
                out.append("<blockquote>" + block("<p>", "</p>") + "</blockquote>")
            elif x < 0.95:
                out.append("<table><tr>" + block("<td>", "</td>") + block("<td>", "</td>") + "</tr></table>")
            else:
                out.append(block("<div>", "</div>"))
            if r.random() < 0.06:
                out.append(r.choice((advert, side, share, notice))())
        if not out:
            out.append(block("<p>", r.choice(("</p>", ""))))
        return title + "\n".join(out)

    shell = r.choice(("<article>|</article>",) * 4 + ("<main>|</main>", "<main><article>|</article></main>", f"<div{named('content', 'post', 'story', 'entry', 'main')}>|</div>", f"<div{named('content', 'article')}>|</div>", f"<div class={word()}>|</div>", "<section>|</section>", "|")).split("|")
    before = [f() for f in (nav, notice, advert, share, ask) if r.random() < (0.8 if f is nav else 0.35)]
    after = [f() for f in (talk, side, advert, ask, share, nav, notice, foot) if r.random() < (0.85 if f is foot else 0.3)]
    r.shuffle(before)
    inner = article()
    if r.random() < 0.12:
        inner += r.choice((talk, share, side))()
    head = f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head>"
    page = f"{head}<body>{''.join(before)}<!-- {word()} -->{shell[0]}{inner}{shell[1]}{''.join(after)}</body></html>"
    return page, "\n\n".join(said)


def labels(page: Page, article: str) -> np.ndarray:
    """1 for elements that hold some block of the article, by their texts; hidden ones are 0."""
    wanted = set(article.split("\n\n"))
    n = len(page.tag)
    y, owner = np.zeros(n), -1
    now: list[str] = []
    for node, text, _ in [*page.events, (0, None, False)]:
        if text is None:
            block = " ".join(htmllib.unescape("".join(now)).split())
            if block in wanted:
                while owner >= 0 and not y[owner]:
                    y[owner] = 1
                    owner = page.parent[owner]
            now = []
        elif not page.hidden[node]:
            if not now:
                owner = node
            now.append(text)
    return y


@lru_cache(1)
def trained(pages: int = 700) -> boosting.Trees:
    xs, ys = [], []
    for seed in range(pages):
        source, article = generated(seed)
        page = Page(source)
        shown = [i for i in range(1, len(page.tag)) if not page.hidden[i]]
        xs.append(page.features()[shown])
        ys.append(labels(page, " ".join(article.split(" ")))[shown])
    return boosting.fit(np.concatenate(xs), np.concatenate(ys))


def extract(sources: list[str], trees: boosting.Trees) -> list[str]:
    """The main texts of some pages."""
    pages = [Page(s) for s in sources]
    rows = [p.features() for p in pages]
    keep = trees.predict(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for page, x in zip(pages, rows):
        out.append(page.text(page.decode(keep[at : at + len(x)])))
        at += len(x)
    return out


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", trees: boosting.Trees | None = None) -> DataFrame:
    """(page_id, text) for each row of pages.

    Null pages are empty and give the empty text, as do pages without an article.  Pages are read
    whole, however broken their markup; ids may be null or repeat; an empty table gives no rows.
    """
    trees = trees or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            for i in range(0, batch.num_rows, 64):
                out += extract([x or "" for x in batch.column(1).slice(i, 64).to_pylist()], trees)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), batch.column(2)], names=["page_id", "text", "url"])

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"), (F.col("url") if "url" in pages.columns else F.lit(None)).cast("string").alias("url"))
    return own.mapInArrow(run, "page_id long, text string, url string")


def op7_html_trees(spark, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

"""Main-text extraction from web pages by tree scoring."""

from __future__ import annotations

import html as _html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is never text of the page.
DROP = frozenset(
    "head script style noscript template button select textarea iframe object svg math canvas audio video title noembed noframes xmp".split()
)
#: What a name (class, id, role or tag) says of an element; the scores decide whether it is believed.
PLAIN, FURNITURE, LISTS, THIN, ADVERT = range(5)
_SAYS = {
    ADVERT: "ad ads adbox adv advert adverts advertisement advertising sponsor sponsored",
    FURNITURE: "banner cookie cookies consent gdpr notice notices alert comment comments commentlist disqus reply replies respond responses "
    "discussion sidebar sidenav newsletter subscribe subscription signup popup modal overlay breadcrumb breadcrumbs pagination pager "
    "nav navbar navigation menu menubar toolbar footer masthead topbar login search searchform skip notification notifications "
    "announcement toast",
    LISTS: "related recommended recommendations",
    THIN: "share sharing social widget widgets promo promotion feedback disclaimer",
}
#: Names that are believed wherever they stand. Of the others some are also what sections of an article are about.
FIRM = frozenset("comment comments commentlist disqus reply replies".split()) | frozenset(_SAYS[ADVERT].split())
LOOSE = frozenset(
    "discussion responses respond search alert announcement social login notice notices notification notifications promotion feedback disclaimer "
    "subscription recommendations recommended related signup widget widgets".split()
)
NAMES = {word: kind for kind, words in _SAYS.items() for word in words.split()}
GOOD = frozenset("article content post entry story main body text prose".split())
#: A word after one of these says what a layout lacks or has beside the text.
NEGATED = frozenset("no not non without has with hide".split())
TAGS = dict.fromkeys("nav footer aside form dialog menu".split(), FURNITURE)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: How much of a paragraph's points counts inside an element that is said to be of this kind.
WEIGHT = {PLAIN: 1.0, FURNITURE: 0.1, LISTS: 0.4, THIN: 0.3, ADVERT: 0.05}
WHOLE = frozenset("html body article main".split())
#: Elements of running text: only an advert's name is believed of them.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr tbody table figure figcaption b i em strong code sub sup".split())
CONTAINERS = frozenset("div section td article main body html form center".split())
#: Headings of readers' comments: those that an article's own section would not have, and those that it might.
_REPLIES = re.compile(r"\W*(\d+ (comments?|responses?|replies|reply)|(comments|responses|replies) \W?\d+|(reader|user) comments|leave a (reply|comment))\W*", re.I)
_COMMENTS = re.compile(r"\W*(comments|kommentare|commentaires|comentarios)\W*", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag closes these open elements, up to a boundary.
_TABLE = frozenset(["table"])
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th"]), _TABLE), "td": (frozenset(["td", "th"]), _TABLE | {"tr"}),
    "th": (frozenset(["td", "th"]), _TABLE | {"tr"}),
}
_P_KEEPS = frozenset("table td th button object caption li body html article main section div aside nav".split())


#: How surely something is said: by a tag, a role or a firm name; by another name; by a name that may be an article's subject.
SURE, NAMED, MAYBE = range(3)


def _said(tag: str, attrs: str, inside: bool) -> tuple[int, bool, int]:
    """What the tag and attributes say an element is, whether they call it the text itself, and how surely they say what it is."""
    kind, good = TAGS.get(tag, PLAIN), False
    if tag == "header" and not inside:
        kind = FURNITURE
    sure = NAMED if tag == "form" or not kind else SURE
    if not attrs.strip():
        return kind, good, sure
    words = []
    for name, a, b, c in _ATTR.findall(attrs):
        name, raw = name.lower(), a or b or c
        value = raw.lower()
        if name in ("class", "id") and tag not in WHOLE:
            parts = re.split(r"[\s_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", raw).lower())
            for before, word in zip(["", *parts], parts):
                says = NAMES.get(word, FURNITURE if word == "header" and not inside else PLAIN)
                if says and before not in NEGATED and (says == ADVERT or tag not in RUNNING):
                    kind = max(kind, says) if ADVERT in (kind, says) else min(kind or says, says)
                    words.append(word)
                good = good or word in GOOD
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            kind, sure = kind or FURNITURE, SURE
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            kind, sure = kind or FURNITURE, SURE
    if sure == NAMED and words:
        sure = SURE if FIRM.intersection(words) else MAYBE if LOOSE.issuperset(words) else NAMED
    return kind, good, sure


class _Tree:
    """Elements as parallel lists, parents before children, and the text in page order as (element, text)."""

    def __init__(self, page: str):
        self.tag, self.parent, self.drop, self.texts = ["html"], [-1], [False], []
        self.kind, self.weight, self.attrs, self.sure = [PLAIN], [1.0], [""], [NAMED]
        self.stack, self.inside, self.open = [0], [False], {}
        self._read(page)

    def _open(self, tag: str, attrs: str) -> int:
        top = self.stack[-1]
        inside = self.inside[top] or self.tag[top] in ("article", "main")
        kind, good, sure = _said(tag, attrs, inside)
        # Of an article's own header only the title is text.
        byline = self.tag[top] == "header" and tag not in HEADINGS and tag not in ("hgroup", "div", "header", *WHOLE, "section", "form")
        drop = self.drop[top] or tag in DROP
        self.kind.append(max(kind, THIN) if byline and kind != FURNITURE else kind)
        self.weight.append(self.weight[top] * WEIGHT[kind] * (1.25 if good else 1.0))
        self.attrs.append(attrs.strip())
        self.sure.append(SURE if byline else sure)
        self.tag.append(tag)
        self.parent.append(top)
        self.drop.append(drop)
        self.inside.append(inside)
        return len(self.tag) - 1

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        if raw and not self.drop[top]:
            self.texts.append((top, _html.unescape(raw) if "&" in raw else raw))

    def _pop_to(self, depth: int) -> None:
        for i in self.stack[depth:]:
            self.open[self.tag[i]] -= 1
            if self.tag[i] in BLOCK:
                self.texts.append((self.parent[i], "\n"))
        del self.stack[depth:]

    def _read(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            lt = page.find("<", at)
            if lt < 0:
                self._text(page[at:])
                return
            if lt > at:
                self._text(page[at:lt])
            nxt = page[lt + 1 : lt + 2]
            if page.startswith("<!--", lt):
                stop = page.find("-->", lt + 4)
                at = end if stop < 0 else stop + 3
                continue
            if nxt in ("!", "?"):
                stop = page.find(">", lt)
                at = end if stop < 0 else stop + 1
                continue
            if not (nxt.isascii() and nxt.isalpha() or nxt == "/" and page[lt + 2 : lt + 3].isalpha()):
                self._text("<")
                at = lt + 1
                continue
            if page.find(">", lt) < 0:  # the page ends inside a tag
                return
            m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
            if not m:
                self._text("<")
                at = lt + 1
                continue
            at, tag = m.end(), m[2].lower()
            if m[1]:
                self._close(tag)
                continue
            self._implied(tag)
            node = self._open(tag, m[3])
            if tag in BLOCK:
                self.texts.append((self.parent[node], "\n"))
            if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
                continue
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}", re.I).search(page, at)
                at = stop.start() if stop else end

    def _implied(self, tag: str) -> None:
        if tag in ("html", "body") and len(self.stack) > 1 and self.tag[self.stack[-1]] == "head":
            self._pop_to(len(self.stack) - 1)
        if tag in BLOCK and tag != "br" and self.open.get("p"):
            for depth in range(len(self.stack) - 1, 0, -1):
                t = self.tag[self.stack[depth]]
                if t == "p":
                    self._pop_to(depth)
                    break
                if t in _P_KEEPS:
                    break
        if tag in CLOSES:
            which, until = CLOSES[tag]
            for depth in range(len(self.stack) - 1, 0, -1):
                t = self.tag[self.stack[depth]]
                if t in until:
                    break
                if t in which:
                    self._pop_to(depth)
                    if tag != "tr":
                        break

    def _close(self, tag: str) -> None:
        if not self.open.get(tag):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            t = self.tag[self.stack[depth]]
            if t == tag:
                self._pop_to(depth)
                return
            if t in ("article", "main", "body", "td", "th", "table", "div", "section") and tag in ("p", "b", "i", "em", "strong", "span", "a", "li"):
                return


def _measures(t: _Tree):
    """Per element: characters, those in links, its own paragraph's points, the longest paragraph below it, and its own characters."""
    n = len(t.tag)
    block, link = [0] * n, [False] * n
    for i in range(1, n):
        p = t.parent[i]
        block[i] = i if t.tag[i] in BLOCK else block[p]
        link[i] = link[p] or t.tag[i] == "a"
    size, linked, own, commas = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in t.texts:
        k = len(text.strip())
        if k:
            size[i] += k
            if link[i]:
                linked[i] += k
            else:
                own[block[i]] += k
                commas[block[i]] += text.count(",")
    worth = [0.0] * n
    for i in range(n):
        if own[i]:
            worth[i] = (1 + commas[i] + min(own[i] / 100, 3)) if own[i] >= 25 and t.tag[i] not in HEADINGS else own[i] / 100
    longest = list(own)
    for i in range(n - 1, 0, -1):
        p = t.parent[i]
        size[p] += size[i]
        linked[p] += linked[i]
        longest[p] = max(longest[p], longest[i])
    return size, linked, worth, longest, own


#: Characters of a paragraph from which on it reads as running text.
READS = 50


def _runs(t: _Tree, own: list[int], linked: list[int], size: list[int], best: int, path: list[bool]) -> list[bool]:
    """Whether an element that a name calls furniture is a section of the article all the same.

    It is if it lies in the best container (or the article element around that), has two paragraphs of running text or more and
    next to no links, and stands between other paragraphs of the element around it; under a name that may be a section's subject
    it may also come first or last.
    """
    n = len(t.tag)
    end, below, plain, inside = list(range(1, n + 1)), [0] * n, [0] * (n + 1), [False] * n
    paragraph = [own[i] >= READS and t.tag[i] not in HEADINGS for i in range(n)]
    called = [False] * n
    for i in range(n):
        p = t.parent[i]
        called[i] = bool(t.kind[i]) and not path[i] or i > 0 and called[p]
        inside[i] = i == best or i > 0 and inside[p] or path[i] and t.tag[i] in ("article", "main")
        plain[i + 1] = plain[i] + (paragraph[i] and not called[i])
    for i in range(n - 1, -1, -1):
        below[i] += paragraph[i]
        if i:
            p = t.parent[i]
            below[p] += below[i]
            end[p] = max(end[p], end[i])
    out = [False] * n
    for i in range(1, n):
        p = t.parent[i]
        if t.kind[i] and t.sure[i] != SURE and inside[p] and below[i] >= 2 and linked[i] <= 0.1 * size[i]:
            out[i] = t.sure[i] == MAYBE or plain[i] > plain[p] and plain[end[p]] > plain[end[i]]
    return out


def _scores(t: _Tree, size, linked, worth) -> list[float]:
    """Points of the paragraphs below each element, less with distance, discounted by its share of link text."""
    n = len(t.tag)
    points = [0.0] * n
    for i in range(n):
        if worth[i]:
            # A container's direct text is its own paragraph; a paragraph's goes to those above it.
            up, share = (i if t.tag[i] in CONTAINERS else t.parent[i]), 1
            while up >= 0 and share <= 6:
                points[up] += worth[i] * t.weight[i] / share
                up, share = t.parent[up], share + 1 if share == 1 else share + 2
    score = [0.0] * n
    for i, p in enumerate(points):
        if size[i] and p and (i == 0 or t.tag[i] in BLOCK or t.tag[i] == "span"):
            bonus = 1.25 if t.tag[i] in ("article", "main") else 1.0
            score[i] = (p * bonus + (t.weight[i] if bonus > 1 else 0)) * (1 - linked[i] / size[i])
    return score


def main_text(page: str | None) -> str:
    """The article of a page as one line; empty if there is none."""
    if not page:
        return ""
    t = _Tree(page)
    n = len(t.tag)
    size, linked, worth, longest, own_size = _measures(t)
    if not size[0]:
        return ""
    score = _scores(t, size, linked, worth)
    best = max(range(n), key=lambda i: (score[i], -i))
    path, up = [False] * n, best
    while up >= 0:
        path[up] = True
        up = t.parent[up]

    if t.weight[best] < 0.2 and size[best] - linked[best] < 250:
        below, paragraphs = [False] * n, 0
        for i in range(n):
            below[i] = i == best or i > 0 and below[t.parent[i]]
            paragraphs += below[i] and worth[i] >= 1
        if paragraphs < 2:
            return ""  # a few words that are said to be furniture, and nothing beside them
    if linked[0] >= 0.8 * size[0] and max(worth) < 1:
        return ""  # links and nothing beside them
    runs = _runs(t, own_size, linked, size, best, path)
    like_path = {(t.tag[i], t.attrs[i]) for i in range(n) if path[i] and t.attrs[i]}

    def dense(i: int) -> float:
        return linked[i] / size[i] if size[i] else 0.0

    def furniture(i: int) -> bool:
        kind = t.kind[i]
        if not kind or path[i] or runs[i] or (t.tag[i], t.attrs[i]) in like_path:
            return False
        return kind in (FURNITURE, ADVERT) or kind == LISTS and dense(i) >= 0.25 or kind == THIN and (dense(i) >= 0.25 or longest[i] < 100)

    # Readers' comments follow a heading that says so, whatever their elements are called.
    heads: dict[int, list[str]] = {}
    gone, at_heading, heading = [False] * n, {}, [0] * n
    for i in range(1, n):
        heading[i] = i if t.tag[i] in HEADINGS else heading[t.parent[i]]
    for i, text in t.texts:
        if heading[i]:
            heads.setdefault(heading[i], []).append(text)
    for h, parts in heads.items():
        title = " ".join("".join(parts).split())
        if _REPLIES.fullmatch(title) or _COMMENTS.fullmatch(title) and not path[t.parent[h]]:
            at_heading[t.parent[h]] = min(h, at_heading.get(t.parent[h], h))
    kept = [0.0] * n
    for i in range(1, n):
        p = t.parent[i]
        below = p in at_heading and i >= at_heading[p] and not path[i]
        gone[i] = gone[p] or furniture(i) or below
        kept[i] = 0.0 if gone[i] else worth[i]
    for i in range(n - 1, 0, -1):
        kept[t.parent[i]] += kept[i]

    # From the best container to the element around it, as long as that adds little or is the article itself.
    top = best
    while (p := t.parent[top]) > 0 and t.tag[p] not in ("body", "html"):
        if not (kept[p] <= 1.05 * kept[top] or t.tag[p] == "article" and kept[p] <= 2 * kept[top]):
            break
        top = p
    chosen = [False] * n
    chosen[best] = True
    within, up = {}, best  # parents whose other children are judged one by one
    while up != top:
        up = t.parent[up]
        within[up] = t.tag[up] in ("article", "main")
    if top and t.tag[top] not in ("body", "html"):
        within[t.parent[top]] = None
    for i in range(1, n):
        p = t.parent[i]
        if i == best or p not in within or path[i] or not size[i]:
            continue
        alike = t.tag[i] == t.tag[best] and t.attrs[i] == t.attrs[best]
        strong = score[i] >= max(2 if alike else 10, (0.2 if alike else 0.35) * score[best])
        if within[p] is None and t.tag[top] in ("article", "main"):
            chosen[i] = t.tag[i] == t.tag[top] and score[i] >= 0.2 * score[best]
        elif within[p]:
            chosen[i] = dense(i) < 0.5
        else:
            reads = t.tag[i] in ("p", "pre", "blockquote", "ul", "ol", "table", "figure") or t.tag[i] == "header" and within[p] is not None
            chosen[i] = strong or t.tag[i] in HEADINGS or reads and dense(i) < 0.25
    for i in range(1, n):
        chosen[i] = not gone[i] and (chosen[i] or chosen[t.parent[i]])
    own = {up for up in within if within[up] is not None}  # direct text of what was climbed
    return " ".join("".join(text for i, text in t.texts if chosen[i] or i in own or text == "\n").split())


def extract_pages(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Each page becomes a tree. Paragraphs give points for length and commas to the elements above them, less with
    distance, and each element's points are discounted by its share of link text. Tags, roles and names in class or id
    (of menus, headers, footers, sidebars, notices, adverts, forms and comments) only weigh the points; an article or
    main element has a bonus. The best container is kept, with the elements closely around it and its siblings that score or
    read like text. Of these, elements that are said to be furniture and don't hold the best container are left out, unless only a name says so and
    they read as a section of the article (``_runs``); names of lists of links count only where there are links, and in running text only an
    advert's name counts. Scripts, styles and form controls are never text; a page of links alone has none. Work is linear in a page's
    elements and characters, however deeply they are nested.

    A null or empty page gives an empty text; broken markup is read as far as it goes; null or repeated ids and
    repeated rows are extracted row by row; other columns are not read; an empty table gives an empty result.
    """
    src = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")
    )

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = [src.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return src.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")

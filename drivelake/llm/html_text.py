"""Main text of HTML pages by composite text density.

For every node of a page's tree: C characters of text, T tags, LC characters
and LT tags of links below it, and the composite density
C/T * log((C/LC) * (T/LT)) to the base ln((C/nLC) * LC + (LCb/Cb) * C + e),
where nLC = C - LC and b stands for the body. A node's density sum adds the
densities of its children. The node with the largest sum is the centre of the
text. The threshold is the smallest density on its path to the body; the
centre's neighbours on that path that reach the threshold belong to the text,
and so does the whole outermost article element around the centre (main where
there is none); neighbours of it join by the same threshold.

Left out beforehand: scripts, styles, forms, menus, page headers and footers,
sidebars, hidden parts, and parts whose class, id or role is as a whole the name of
an advert, notice, menu or reader comments. Ids of headings and paragraphs do not
count. Within the article, ids of sections (unless they name reader comments), names
such as search, related or tags, and labels, dialogs and field sets outside a form
count only where half of the part is links. A text is its blocks in page order, joined by
a line feed; white space within a block becomes one space, as does a br.

Rows: a null html is the empty page, which has the empty text; a page without
markup is one block; null page_id or url stay null; repeated rows give repeated
results; an empty table gives none. Whole pages are read, of any length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivelake.llm.common import slices

_TAG = re.compile(r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"[ \t\n\r\f\v\xa0]+")
_words = lambda s: frozenset(s.split())
#: Element names of HTML by their role.
_VOID = _words("area base br col embed hr img input link meta param source track wbr")
_RAW = _words("script style textarea title noscript template iframe svg object xmp noembed noframes")
_ENDLESS = _words("script style textarea title")  # without an end tag these take the rest of the page
_IN_HEAD = _words("base link meta noscript script style template title")
_BLOCK = _words("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
                "li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption xmp")
_OUT = _words("head nav aside form footer button select option label menu dialog fieldset canvas audio video annotation annotation-xml")
_PERHAPS = _words("label dialog fieldset")  # outside a form in the article, their share of links decides
_HEADINGS = _words("h1 h2 h3 h4 h5 h6")
_ENDS = {"li": _words("li"), "dt": _words("dt dd"), "dd": _words("dt dd"), "tr": _words("tr td th"), "td": _words("td th"), "th": _words("td th"), "option": _words("option")}
_SCOPE = {"li": _words("ul ol menu"), "dt": _words("dl"), "dd": _words("dl"), "tr": _words("table tbody thead tfoot"), "td": _words("tr"), "th": _words("tr"), "option": _words("select")}
_P_SCOPE = _words("article aside body div td th li section main table blockquote header footer form figure dd button")
#: Names in class, id or role that mark a part as no text of the article: whole ones, made of these words and nothing else.
_WORD = (r"ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|"
         r"subscribe|subscription|signup|login|sidebar|side-?bar|side|nav|navbar|navigation|menus?|breadcrumbs?|pagination|pager|toolbar|masthead|topbar|site-?header|page-?header|site-?footer|"
         r"page-?footer|footer|copyright|comments?|comment-?list|commentlist|replies|reply|respond|disqus|related|recommended|recommendations|share|sharing|social|widgets?|tags|toc|"
         r"complementary|contentinfo|search|skip-?link|disclaimer")
#: Of these, names that a part of the article can have too: there the share of links decides.
_DOUBTFUL = r"side|search|related|recommended|recommendations|tags|toc"
_PLACE = r"site|page|main|top|bottom|left|right|box|bar|list|links?|buttons?|icons?|wrapper|wrap|container|section|block|area|form|items?|posts?|articles?|stories|media|slot|inner|outer|[0-9]+"
_NAMES = re.compile(rf"(?:(?:{_PLACE})[_-])*(?:{_WORD})(?:[_-](?:{_WORD}|{_PLACE}))*", re.I)
_ANSWERS = re.compile(rf"(?:comments?|commentlist|replies|respond|disqus)(?:[_-](?:{_PLACE}))*", re.I)
_MAYBE = re.compile(rf"(?:(?:{_PLACE})[_-])*(?:{_DOUBTFUL})(?:[_-](?:{_PLACE}))*", re.I)
_names = lambda v, of=_NAMES: any(map(of.fullmatch, v.split()))


class Page:
    """Nodes in page order; node 0 is the root. parts of a node: numbers of its child nodes, and texts."""

    def __init__(self, html: str):
        self.tag, self.parent, self.parts, self.out = ["body"], [-1], [[]], [False]
        self.inner, self.in_form = [False], [False]  # within an article or main part, within a form
        self.doubtful: list[int] = []
        self.open: Counter[str] = Counter()  # by element name, so that no walk looks for what is not there
        self.endless: set[str] = set()
        stack, pos, at = [0], 0, _TAG.search
        while True:
            m = at(html, pos)
            text = html[pos: m.start()] if m else html[pos:]
            if text:
                if self.tag[stack[-1]] == "head" and text.strip():
                    self._cut(stack, len(stack) - 1)
                self.parts[stack[-1]].append(unescape(text) if "&" in text else text)
            if not m:
                break
            pos = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name, closing = name.lower(), m[1] or m[4]
            if closing:
                if self.open[name]:
                    i = len(stack) - 1
                    while self.tag[stack[i]] != name:
                        i -= 1
                    self._cut(stack, i)
                continue
            if name not in _IN_HEAD and name not in ("html", "head"):
                self._close(stack, ("head",), ())
            if name in ("svg", "math") and (m[3] or m[6] or "").endswith("/"):
                continue
            if name in _RAW:
                end = None if name in self.endless else re.compile(f"</{name}(?![^\\s/>])[^>]*>", re.I).search(html, pos)
                if not end:
                    self.endless.add(name)  # nor will a later one have an end
                if end and name == "xmp":
                    self._close(stack, ("p",), _P_SCOPE)
                    self.parts[self._open(name, m[3] or m[6] or "", stack[-1])].append(html[pos: end.start()])
                if end or name in _ENDLESS:
                    pos = end.end() if end else len(html)
                continue
            if name in ("html", "body"):
                continue
            if name in _BLOCK:
                self._close(stack, ("p",), _P_SCOPE)
            if name in _ENDS:
                self._close(stack, _ENDS[name], _SCOPE[name])
            node = self._open(name, m[3] or m[6] or "", stack[-1])
            if name not in _VOID:
                stack.append(node)
                self.open[name] += 1
        self._settle()

    def _cut(self, stack: list[int], at: int) -> None:
        for node in stack[at:]:
            self.open[self.tag[node]] -= 1
        del stack[at:]

    def _close(self, stack: list[int], names, scope) -> None:
        """Close the open elements of these names, up to the next of the scope."""
        left = sum(self.open[name] for name in names)
        for i in range(len(stack) - 1, 0, -1):
            if not left:
                return
            tag = self.tag[stack[i]]
            if tag in names:
                self._cut(stack, i)
                left = sum(self.open[name] for name in names)
            elif tag in scope:
                return

    def _open(self, name: str, attrs: str, parent: int) -> int:
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(parent)
        self.parts.append([])
        self.parts[parent].append(node)
        self.inner.append(self.inner[parent] or name in ("article", "main"))
        self.in_form.append(self.in_form[parent] or name == "form")
        perhaps = name in _PERHAPS and self.inner[parent] and not self.in_form[parent]
        if perhaps:
            self.doubtful.append(node)
        out = name in _OUT and not perhaps or name == "header" and not self.inner[parent]
        if attrs and not out:
            for k, a, b, c in _ATTR.findall(attrs):
                k, v = k.lower(), a or b or c
                named = k in ("class", "id", "role") and name not in ("article", "main", "body") and _names(v)
                if named and k == "id" and (name in _HEADINGS or name == "p"):
                    named = False  # made from the words of the text
                elif named and self.inner[parent] and (k == "id" and name == "section" and not _names(v, _ANSWERS) or all(map(_MAYBE.fullmatch, filter(_NAMES.fullmatch, v.split())))):
                    self.doubtful.append(node)
                    named = False
                out |= (named or k == "hidden"
                        or k == "aria-hidden" and v.lower() == "true" or k == "style" and bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v, re.I)))
        self.out.append(out)
        return node

    def _settle(self) -> None:
        """Doubtful parts go where half of their characters are links, as in menus and the like; inner parts are settled first."""
        if not self.doubtful:
            return
        n, doubtful = len(self.tag), set(self.doubtful)
        chars, links = [0] * n, [0] * n
        for i in range(n - 1, 0, -1):  # children come after their parents
            chars[i] += sum(len(" ".join(p.split())) for p in self.parts[i] if isinstance(p, str))
            if self.tag[i] == "a":
                links[i] = chars[i]
            self.out[i] |= i in doubtful and 2 * links[i] >= chars[i]
            if not self.out[i]:
                chars[self.parent[i]] += chars[i]
                links[self.parent[i]] += links[i]

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite density and density sum of every node."""
        n = len(self.tag)
        chars, tags, links, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for i in range(n - 1, -1, -1):  # children come after their parents
            if self.out[i]:
                chars[i] = tags[i] = links[i] = link_tags[i] = 0
            else:
                chars[i] += sum(len(" ".join(p.split())) for p in self.parts[i] if isinstance(p, str))
                if self.tag[i] == "a":
                    links[i], link_tags[i] = chars[i], tags[i] + 1
            if i:
                up = self.parent[i]
                chars[up] += chars[i]
                links[up] += links[i]
                link_tags[up] += link_tags[i]
                tags[up] += tags[i] + (0 if self.out[i] else 1)
        share = links[0] / max(chars[0], 1)
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            c, t, lc = chars[i], max(tags[i], 1), max(links[i], 1)
            if c and not self.out[i]:
                base = math.log(c / max(c - links[i], 1) * lc + share * c + math.e)
                density[i] = c / t * math.log(c / lc * t / max(link_tags[i], 1)) / math.log(max(base, 1.0001))
            if i:
                sums[self.parent[i]] += density[i]
        return density, sums

    def chosen(self) -> list[int]:
        """Roots of the subtrees that make the text, in page order."""
        density, sums = self.densities()
        seen = [True]
        for i in range(1, len(sums)):
            seen.append(seen[self.parent[i]] and not self.out[i])
        centre = max(range(len(sums)), key=lambda i: (sums[i], -i) if seen[i] else (-math.inf, 0))
        if sums[centre] <= 0:
            centre = 0
        path = [centre]
        while path[-1] > 0:
            path.append(self.parent[path[-1]])
        least = min(density[i] for i in path)
        marked = [k for k, i in enumerate(path) if self.tag[i] == "article"] or [k for k, i in enumerate(path) if self.tag[i] == "main"] or [0]
        path = path[marked[-1]:]  # the outermost article (or main part) around the centre belongs to the text as a whole
        roots = {path[0]}
        for up, below in zip(path[1:], path):
            for i in self.parts[up]:
                if isinstance(i, int) and i != below and not self.out[i] and (density[i] >= least or self.tag[i] in _HEADINGS and i < below):
                    roots.add(i)
        return sorted(roots)

    def text(self) -> str:
        blocks: list[str] = []
        line: list[str] = []

        def close():
            if block := _SPACE.sub(" ", "".join(line)).strip(" "):
                blocks.append(block)
            line.clear()

        for root in self.chosen():
            close()
            todo = [(root, 0)]
            while todo:
                node, k = todo.pop()
                if k == 0 and self.tag[node] in _BLOCK:
                    close()
                elif k == 0 and self.tag[node] == "br":
                    line.append(" ")
                parts = self.parts[node]
                while k < len(parts) and isinstance(parts[k], str):
                    line.append(parts[k])
                    k += 1
                if k < len(parts):
                    todo.append((node, k + 1))
                    if not self.out[parts[k]]:
                        todo.append((parts[k], 0))
                elif self.tag[node] in _BLOCK:
                    close()
        close()
        return "\n".join(blocks)


def extract(html: str | None) -> str:
    return Page(html or "").text()


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [extract(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")

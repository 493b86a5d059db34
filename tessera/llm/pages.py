"""Main text of web pages by wrapper induction over the pages of a host.

One page of every host is its reference. Every page's DOM tree is aligned with it by simple
tree matching (the largest order-keeping match of equally labelled nodes; runs of equal
siblings count as one repeated node). Nodes of the reference gather how many distinct pages
match them, how often the text is the same, and how much text varies below them. Text that is
the same on nearly all distinct pages of the host is template; the content slot is found by
following the varying text down from the root to an article, or as long as nothing but template
and regions marked as menus, adverts and the like stands beside it. A page's text is what
stands in the node aligned with that slot, without the text that equals the template's.

Copies of a page are reduced to one by a hash, pre-aggregated in every task. The counts are
added up by Spark per host and node, pre-aggregated too, so a host with a third of all pages
costs no more than its share; references are joined to pages, by broadcast only while they
are small.
"""

from __future__ import annotations

import functools
import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.graph import checkpointed
from tessera.llm.ship import ship
from tessera.llm.words import add_columns, column, without

#: Reference pages and templates up to this many bytes are broadcast.
BROADCAST_BYTES = 16 << 20
#: Text is template if it is the same on this share of a host's distinct pages, of at least so many:
#: ten equal pages of ten show, at 95 %, that more than 3/4 of a host's pages have the text; three
#: show that no more than 3/8 have, and a heading that a series of three articles shares is content.
CONSTANT, PAGES = 0.98, 10
#: Largest table of the matching of two rows of children; larger ones are matched in halves.
CELLS = 1_000_000

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
                   "section select summary table tbody td tfoot th thead tr ul".split())
_CLOSES_P = _BLOCK - frozenset("body html caption dd dt li option tbody td tfoot th thead tr legend".split())
#: An opening tag ends an open one of these, up to the nearest of the borders.
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
         "tr": (("tr",), ("table", "tbody", "thead", "tfoot")), "td": (("td", "th"), ("tr", "table")),
         "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select", "datalist"))}
#: Tags that such searches for an open element look at, and those that make a header an article's.
_GROUPS = (("p",), ("td", "th", "table", "button", "object")), *dict.fromkeys(_ENDS.values())
_GROUP_OF = {tag: _GROUPS.index(found) for tag, found in _ENDS.items()}
_ARTICLE = ("article", "main")
_SEARCHED = frozenset(t for group in _GROUPS for tags in group for t in tags).union(_ARTICLE)
_CONTAINER = frozenset("html body main article section div center table tbody tr td figure details".split())
#: Elements, roles and class or id words whose text is not an article's.
_ASIDE = frozenset("head nav footer aside form script style textarea title noscript iframe xmp noembed noframes svg button "
                   "select dialog template object canvas menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu "
                   "breadcrumb breadcrumbs sidebar aside footer header masthead comment comments reply replies disqus cookie cookies "
                   "consent notice notices alert popup modal overlay newsletter subscribe subscription share sharing social related "
                   "recommended widget login signup search pagination pager toolbar skip hidden".split())
#: Those that also mark an element inside an article, by a whole name.
_INSIDE = frozenset("ad ads advert adverts advertisement advertising sponsored comment comments reply replies disqus".split())
#: Parts of compound names that leave the meaning to the other parts.
_NEUTRAL = frozenset("site main top bottom left right box bar list section wrapper container area block inner outer links link button "
                     "buttons icons item items form user reader global primary secondary mobile desktop".split())
# A tag by the states of the HTML standard: a quote opens a value only right after "=". No part can
# be read in two ways (possessive repeats), so a tag is read once. A quote that is never closed
# is a character of the value.
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+))?+""")
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:{_ATTRIBUTE.pattern.replace('(', '(?:', 1).replace('("', '(?:"')})*+[\s/]*+)>")


class Node:
    __slots__ = ("tag", "label", "aside", "kids", "sig", "at", "size")

    def __init__(self, tag: str, label: str, aside: bool):
        self.tag, self.label, self.aside = tag, label, aside
        self.kids: list = []
        self.sig = self.at = self.size = 0


def _marked(name: str, in_article: bool) -> bool:
    """Whether a class or id marks a menu, advert and the like. Inside an article only a whole
    name does, and only of adverts and comments; elsewhere also a compound of marks and neutral parts."""
    if in_article:
        return name in _INSIDE
    parts = [part for part in re.split(r"[_\-]+", name) if part]
    return not _WORDS.isdisjoint(parts) and all(part in _WORDS or part in _NEUTRAL for part in parts)


def _open(tag: str, raw: str, in_article: bool) -> Node:
    aside, label = tag in _ASIDE or (tag == "header" and not in_article), tag
    if not raw or not raw.strip(" /"):
        return Node(tag, tag, aside)
    names: list[str] = []
    for m in _ATTRIBUTE.finditer(raw):
        key, value = m[1].lower(), m[2] or ""
        value = entities.unescape(value[1:-1] if value[:1] in ("'", '"') else value).lower()
        if key in ("class", "id"):
            names += value.split()
            if key == "class":
                label = f"{tag}.{value}"
        elif key == "role":
            aside = aside or value in _ROLES
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            aside = True
    if tag not in ("html", "body", "article", "main") and any(_marked(name, in_article) for name in names):
        aside = True
    return Node(tag, label, aside)


class _Stack:
    """Open elements, of any depth. ``near`` has, for every element, where the nearest open one of
    each group is (0: none, or behind a border), and last the number of articles around."""

    def __init__(self, root: Node):
        self.nodes, self.near = [root], [(0,) * len(_GROUPS) + (0,)]
        self.open: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        tag, near, at = node.tag, self.near[-1], len(self.nodes)
        if tag in _SEARCHED:
            near = (*(at if tag in tags else 0 if tag in borders else was for (tags, borders), was in zip(_GROUPS, near, strict=False)),
                    near[-1] + (tag in _ARTICLE))
        self.nodes.append(node)
        self.near.append(near)
        self.open.setdefault(tag, []).append(at)

    def cut(self, at: int) -> None:
        """Close the element at this place and those in it."""
        for node in self.nodes[at:]:
            self.open[node.tag].pop()
        del self.nodes[at:], self.near[at:]

    def end(self, tag: str) -> None:
        if self.open.get(tag):
            self.cut(self.open[tag][-1])

    def close(self, group: int) -> None:
        if self.near[-1][group]:
            self.cut(self.near[-1][group])


def parse(text: str) -> Node:
    """DOM tree of a page; whatever is not well formed is closed where HTML would close it. Every
    character is read a bounded number of times; a tag or comment that never ends takes the rest."""
    root = Node("#root", "#root", False)
    stack, at, n = _Stack(root), 0, len(text)
    while at < n:
        begin = text.find("<", at)
        if begin != at:
            begin = n if begin < 0 else begin
            stack.nodes[-1].kids.append(text[at:begin])
            at = begin
            continue
        follows = text[at + 1:at + 3]
        if not (follows[:1] in ("!", "?") or follows[:1].isalpha() and follows[:1].isascii() or follows[:1] == "/" and follows[1:]):
            stack.nodes[-1].kids.append("<")
            at += 1
            continue
        if text.startswith("<!--", at):
            end = text.find("-->", at + 2)
            at = n if end < 0 else end + 3
            continue
        if follows[0] in "!?" or (follows[0] == "/" and not (follows[1].isalpha() and follows[1].isascii())):
            end = text.find(">", at)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(text, at)
        if m is None:
            break
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            stack.end(tag)
            continue
        if tag in _CLOSES_P:
            stack.close(0)
        if tag in _ENDS:
            stack.close(_GROUP_OF[tag])
        node = _open(tag, m[3], stack.near[-1][-1] > 0)
        stack.nodes[-1].kids.append(node)
        if tag in _VOID:
            continue
        if tag in _RAW:
            # its end tag is read as any other, and ends nothing else
            end = _raw_end(tag).search(text, at)
            at = end.start() if end else n
            continue
        if not m[3].endswith("/") or tag in _BLOCK or tag == "a":
            stack.push(node)
    return root


@functools.cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.I)


class Matcher:
    """Simple tree matching with scores kept by shape; shapes are numbered on first sight."""

    def __init__(self):
        self.numbers: dict = {}
        self.shapes: list = []
        self.sizes: list = []
        self.scores: dict = {}

    def number(self, root: Node) -> Node:
        """Number shapes bottom-up and nodes in page order."""
        order, todo = [], [root]
        while todo:
            node = todo.pop()
            node.at = len(order)
            order.append(node)
            todo.extend(k for k in reversed(node.kids) if type(k) is Node)
        for node in reversed(order):
            runs: list = []
            for k in node.kids:
                if type(k) is Node:
                    if runs and runs[-1][0] == k.sig:
                        runs[-1][1] += 1
                    else:
                        runs.append([k.sig, 1])
            shape = (node.label, tuple(map(tuple, runs)))
            sig = self.numbers.get(shape)
            if sig is None:
                sig = self.numbers[shape] = len(self.shapes)
                self.shapes.append(shape)
                self.sizes.append(1 + sum(times * self.sizes[kid] for kid, times in shape[1]))
            node.sig = sig
        return root

    def score(self, a: int, b: int) -> int:
        """Nodes in the largest match of two shapes (0 if the labels differ)."""
        if a == b:
            return self.sizes[a]
        if self.shapes[a][0] != self.shapes[b][0]:
            return 0
        if not self.shapes[a][1] or not self.shapes[b][1]:
            return 1
        got = self.scores.get((a, b))
        if got is not None:
            return got
        todo = [(a, b, False)]  # shapes may be nested deeper than calls can be
        while todo:
            a, b, ready = todo.pop()
            if (a, b) in self.scores:
                continue
            left, right = self.shapes[a][1], self.shapes[b][1]
            missing = () if ready else self._unknown(left, right)
            if missing:
                todo.append((a, b, True))
                todo.extend(missing)
                continue
            got = self.scores[a, b] = 1 + sum(
                min(left[i][1], right[j][1]) * self.score(left[i][0], right[j][0]) for i, j in self._pairs(left, right))
        return got

    def _unknown(self, left, right) -> list[tuple[int, int, bool]]:
        """Pairs of children's shapes that may match and have no score yet."""
        begin, end_l, end_r = _between(left, right)
        mine, theirs = {sig for sig, _ in left[begin:end_l]}, {sig for sig, _ in right[begin:end_r]}
        return [(a, b, False) for a in mine for b in theirs
                if a != b and self.shapes[a][0] == self.shapes[b][0] and self.shapes[a][1] and self.shapes[b][1]
                and (a, b) not in self.scores]

    def _pairs(self, left, right) -> list[tuple[int, int]]:
        """Matched runs of two rows of children, from the last to the first. Equal runs at both
        ends are matched at once, what is between them by dynamic programming: over one table
        of up to ``CELLS`` places, else in halves, which takes the memory of a few rows."""
        begin, end_l, end_r = _between(left, right)
        out = [(len(left) - k, len(right) - k) for k in range(1, len(left) - end_l + 1)]
        if (end_l - begin) * (end_r - begin) <= CELLS:
            table = [[0] * (end_r - begin + 1)]
            for sig, times in left[begin:end_l]:
                above, row = table[-1], [0]
                for j, (other, n) in enumerate(right[begin:end_r]):
                    row.append(max(above[j + 1], row[j], above[j] + min(times, n) * self.score(sig, other)))
                table.append(row)
            i, j = end_l - begin, end_r - begin
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((begin + i, begin + j))
        elif end_l - begin > end_r - begin:
            out += [(i, j) for j, i in self._halves(right[begin:end_r], left[begin:end_l], begin)]
        else:
            out += self._halves(left[begin:end_l], right[begin:end_r], begin)
        return out + [(i, i) for i in reversed(range(begin))]

    def _halves(self, left, right, begin: int) -> list[tuple[int, int]]:
        """The same largest match: the upper and the lower half of ``left`` are each scored
        against all beginnings and ends of ``right``, which is cut where the sum is largest."""
        number = {sig: i for i, sig in enumerate(dict.fromkeys(sig for sig, _ in right))}
        which, times = np.array([number[sig] for sig, _ in right]), np.array([n for _, n in right])
        scores: dict = {}

        def gains(i, j0, j1):
            sig, n = left[i]
            if sig not in scores:
                scores[sig] = np.array([self.score(sig, other) for other in number], np.int32)
            return np.minimum(n, times[j0:j1]) * scores[sig][which[j0:j1]]

        def best(rows, j0, j1, step):
            row = np.zeros(j1 - j0 + 1, np.int64)
            for i in rows:
                row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + gains(i, j0, j1)[::step]))
            return row

        out, todo = [], [(0, len(left), 0, len(right))]
        while todo:
            i0, i1, j0, j1 = todo.pop()
            if i0 == i1 or j0 == j1:
                continue
            if i1 - i0 == 1:
                gain = gains(i0, j0, j1)
                j = int(gain.argmax())
                if gain[j] > 0:
                    out.append((begin + i0, begin + j0 + j))
                continue
            half = (i0 + i1) // 2
            upper, lower = best(range(i0, half), j0, j1, 1), best(range(i1 - 1, half - 1, -1), j0, j1, -1)
            j = j0 + int((upper + lower[::-1]).argmax())
            todo += [(i0, half, j0, j), (half, i1, j, j1)]
        return out

    def align(self, page: Node, ref: Node) -> list[tuple[Node, Node]]:
        """Matched nodes of two trees with equal roots."""
        out, todo = [], [(page, ref)]
        while todo:
            p, r = todo.pop()
            out.append((p, r))
            mine, theirs = [k for k in p.kids if type(k) is Node], [k for k in r.kids if type(k) is Node]
            if not mine or not theirs:
                continue
            if p.sig == r.sig:
                todo.extend(zip(mine, theirs, strict=True))
                continue
            left, right = self.shapes[p.sig][1], self.shapes[r.sig][1]
            ends_p, ends_r = _ends(left), _ends(right)
            for i, j in self._pairs(left, right):
                todo.extend(zip(mine[ends_p[i]:ends_p[i + 1]], theirs[ends_r[j]:ends_r[j + 1]], strict=False))
        return out

    def trim(self) -> None:
        if self.full():
            self.__init__()

    def full(self) -> bool:
        return len(self.shapes) > 100_000 or len(self.scores) > 1_000_000


def _between(left, right) -> tuple[int, int, int]:
    """Where two rows of children begin to differ, and where each ends to."""
    begin, end_l, end_r = 0, len(left), len(right)
    while begin < min(end_l, end_r) and left[begin] == right[begin]:
        begin += 1
    while min(end_l, end_r) > begin and left[end_l - 1] == right[end_r - 1]:
        end_l, end_r = end_l - 1, end_r - 1
    return begin, end_l, end_r


def _ends(runs) -> list[int]:
    out = [0]
    for _, times in runs:
        out.append(out[-1] + times)
    return out


def own_text(node: Node) -> str:
    """Normalized text directly in a node and its inline children."""
    return " ".join(entities.unescape(_inline(node)).split())


def _inline(node: Node) -> str:
    out, todo = [], list(reversed(node.kids))
    while todo:
        k = todo.pop()
        if type(k) is str:
            out.append(k)
        elif k.tag == "br":
            out.append(" ")
        elif not k.aside and k.tag not in _BLOCK:
            todo.extend(reversed(k.kids))
    return "".join(out)


def blocks(node: Node, template: frozenset | set = frozenset()) -> list[str]:
    """Texts of the blocks below a node, in page order, without marked regions and template nodes.

    ``template``: ids of nodes whose direct text is left out.
    """
    out: list[str] = []
    piece: list[str] = []

    def flush():
        text = " ".join(entities.unescape("".join(piece)).split())
        if text:
            out.append(text)
        piece.clear()

    todo: list = [(node, False)]
    while todo:
        item, leave = todo.pop()
        if leave:
            flush()
        elif type(item) is tuple:
            piece.append(item[0])
        elif item.tag == "br":
            piece.append(" ")
        else:
            if item.aside and item is not node:
                continue
            block = item.tag in _BLOCK
            if block:
                flush()
                todo.append((item, True))
            quiet = id(item) in template
            for k in reversed(item.kids):
                if type(k) is Node:
                    todo.append((k, False))
                elif not quiet:
                    todo.append(((k,), False))
    flush()
    return out


def _body(root: Node) -> list[Node]:
    """The nodes of the elements that pages mark as article (or main, or body)."""
    for tag in ("article", "main", "body"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag == tag:
                found.append(node)
            elif not node.aside:
                todo.extend(k for k in reversed(node.kids) if type(k) is Node)
        if found:
            return found
    return [root]


def _measure(root: Node, pairs: list[tuple[Node, Node]]):
    """(reference node, text is the same, has text, varying characters below) of each match."""
    with_ref = {id(p): r for p, r in pairs}
    order, todo = [], [(root, False, True)]
    while todo:
        node, aside, block = todo.pop()
        order.append((node, aside, block))
        todo.extend((k, aside or k.aside, k.tag in _BLOCK) for k in node.kids if type(k) is Node)
    rows = []
    for node, aside, block in reversed(order):
        text = own_text(node) if block and not aside else ""
        ref = with_ref.get(id(node))
        same = bool(text) and ref is not None and own_text(ref) == text
        node.size = (0 if same else len(text)) + sum(k.size for k in node.kids if type(k) is Node)
        if ref is not None:
            rows.append((ref.at, same, bool(text), node.size))
    return rows


def _constant(ref: Node, stats: dict[int, tuple[int, int, int, int]]) -> set[int]:
    """Nodes of the reference whose text is template: the same on nearly all distinct pages of the
    host, which all match the root. Where nothing varies at all, nothing tells template from content."""
    pages, _, _, size = stats.get(ref.at, (0, 0, 0, 0))
    if pages < PAGES or not size:
        return set()
    return {at for at, (_, same, _, _) in stats.items() if same >= CONSTANT * pages}


def _slot(ref: Node, stats: dict[int, tuple[int, int, int, int]], constant: set[int]) -> int:
    """Where the text is: the first article or main on the way down, or the deepest container
    beside which no page has any text but template and marked regions."""
    order, todo = [], [(ref, True)]
    while todo:
        node, block = todo.pop()
        order.append((node, block))
        todo.extend((k, k.tag in _BLOCK) for k in node.kids if type(k) is Node and not k.aside)
    own: dict[int, int] = {}  # nodes below, with text that is no template
    for node, block in reversed(order):
        own[node.at] = (block and node.at not in constant and bool(own_text(node))) + sum(
            own[k.at] for k in node.kids if type(k) is Node and not k.aside)
    node = ref
    while node.tag not in ("article", "main"):
        have = stats.get(node.at, (0, 0, 0, 0))[3]
        kids = [k for k in node.kids if type(k) is Node and k.tag in _CONTAINER and not k.aside]
        best = max(kids, key=lambda k: stats.get(k.at, (0, 0, 0, 0))[3], default=None)
        if best is None or not have or stats.get(best.at, (0, 0, 0, 0))[3] < have or own[best.at] < own[node.at]:
            break
        node = best
    return node.at


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    return F.when(found != "", found)


def _column(part, name):
    return part.column(part.schema.get_field_index(name))


class _References:
    """Parsed reference pages of the hosts last seen, for one matcher."""

    def __init__(self):
        self.matcher, self.kept, self.plans = Matcher(), {}, {}

    def get(self, host: str, source: str) -> Node:
        if self.matcher.full() or len(self.kept) > 200:
            self.matcher.trim()
            self.kept.clear()
            self.plans.clear()
        root = self.kept.get(host)
        if root is None:
            root = self.kept[host] = self.matcher.number(parse(source))
        return root

    def plan(self, host: str, ref: Node, stats) -> tuple[int | None, dict[int, str]]:
        """Content slot of a host, none if nothing varies, and the text of its template nodes."""
        found = self.plans.get(host)
        if found is None:
            table = {s["at"]: (s["pages"], s["same"], s["texts"], s["size"]) for s in stats}
            constant, texts, todo = _constant(ref, table), {}, [ref]
            while todo:
                node = todo.pop()
                if node.at in constant:
                    texts[node.at] = own_text(node)
                todo.extend(k for k in node.kids if type(k) is Node)
            varies = table.get(ref.at, (0, 0, 0, 0))[3] > 0
            found = self.plans[host] = _slot(ref, table, constant) if varies else None, texts
        return found


def _joined(pages: DataFrame, side: DataFrame, size: Column) -> DataFrame:
    small = (side.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES
    return pages.join(F.broadcast(side) if small else side, "__host", "left")


def references(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(__host, __ref): the page of the smallest id of every host."""
    rows = pages.select(host_of(column(url)).alias("__host"), column(page_id).alias("__id"), column(html).alias("__ref"))
    rows = rows.where("__host is not null and __ref is not null and __id is not null")
    first = checkpointed(rows.groupBy("__host").agg(F.min("__id").alias("__id")))
    first = F.broadcast(first) if first.count() * 64 <= BROADCAST_BYTES else first
    found = rows.join(first, ["__host", "__id"])  # repeated rows of an id: the smallest text
    return checkpointed(found.groupBy("__host").agg(F.min("__ref").alias("__ref")))


def templates(pages: DataFrame, url: str, html: str, refs: DataFrame) -> DataFrame:
    """(__host, __stats): what the host's pages have in common with its reference."""
    rows = pages.select(host_of(column(url)).alias("__host"), column(html).alias("__html"))
    rows = rows.where("__host is not null and __html is not null")
    # copies are one page: of each hash one stays in every task, and one of those after the shuffle
    rows = rows.groupBy("__host", F.md5(F.col("__html").cast("binary")).alias("__hash")).agg(F.first("__html").alias("__html"))
    source = _joined(rows.select("__host", "__html"), refs, F.octet_length("__ref"))

    def run(batches):
        keep = _References()
        for batch in batches:
            sums: dict = {}
            for host, text, ref in zip(*(_column(batch, c).to_pylist() for c in ("__host", "__html", "__ref")), strict=True):
                if ref is None:
                    continue
                root_ref = keep.get(host, ref)
                root = keep.matcher.number(parse(text))
                for at, same, has, size in _measure(root, keep.matcher.align(root, root_ref)):
                    s = sums.setdefault((host, at), [0, 0, 0, 0])
                    s[0] += 1
                    s[1] += same
                    s[2] += has
                    s[3] += size
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in sums], pa.string()), pa.array([a for _, a in sums], pa.int64())]
                + [pa.array([s[i] for s in sums.values()], pa.int64()) for i in range(4)],
                names=["__host", "at", "pages", "same", "texts", "size"])

    counted = source.mapInArrow(run, "__host string, at long, pages long, same long, texts long, size long")
    names = ("pages", "same", "texts", "size")
    return (counted.groupBy("__host", "at").agg(*[F.sum(c).alias(c) for c in names])
            .groupBy("__host").agg(F.collect_list(F.struct("at", *names)).alias("__stats")))


def main_text(text: str | None, host: str | None, source: str | None, stats, keep: _References) -> str:
    if not text:
        return ""
    root, regions, template = parse(text), [], set()
    if source is not None and stats:
        ref = keep.get(host, source)
        keep.matcher.number(root)
        slot, constant = keep.plan(host, ref, stats)
        for p, r in keep.matcher.align(root, ref):
            if r.at == slot:
                regions.append(p)
            if r.at in constant and own_text(p) == constant[r.at]:
                template.add(id(p))
    regions = regions or _body(root)
    return "\n".join(t for region in regions for t in blocks(region, template))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            keep: list[str] | None = None) -> DataFrame:
    """Append text (main text, blocks joined by a line feed) and n_chars to every page.

    A null or empty page has an empty text. A page without a host, or whose tree has no node
    at the host's content slot, is read by its own marks (article, main, else body); so is the
    only page of a host in effect, as nothing varies there, and a host of one page in many
    copies. Every row of a repeated page has its text, but copies of a page count as one when a
    host's template is learned. Columns of ``pages`` named text or n_chars give way.
    """
    ship(pages.sparkSession)
    pages = without(pages, ["__host", "__ref", "__stats"])
    refs = references(pages, page_id, url, html)
    found = checkpointed(templates(pages, url, html, refs))
    known = checkpointed(refs.join(found, "__host", "left"))
    names = [c for c in (keep or pages.columns) if c.lower() not in ("text", "n_chars")]
    with_host = _joined(pages.withColumn("__host", host_of(column(url))), known,
                        F.octet_length("__ref") + 40 * F.coalesce(F.size("__stats"), F.lit(0)))
    cache: dict = {}

    def rows_of(part):
        kept = cache.setdefault("refs", _References())
        texts = [main_text(*row, kept) for row in zip(*(_column(part, c).to_pylist() for c in (html, "__host", "__ref", "__stats")),
                                                      strict=True)]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return add_columns(with_host, rows_of, fields, names, html, use=("__host", "__ref", "__stats"))

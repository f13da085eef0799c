"""Operator 6: main text of pages by wrapper induction.

The pages of a host are aligned by simple tree matching of their trees: each tree shape with the host's most
frequent one. Nodes whose text is the same on most pages belong to the template, the others are slots. A run
of like siblings (menu entries, paragraphs) is one node of the shape, so a host has few shapes. What a
page keeps are its slots, without the parts whose element or name says what they are (menus, footers, adverts,
forms, comments). An article element, where there is one, is a slot like the others: of its lines only those at its
beginning and end can be template, if most different articles of the host have them and they are a small part of the
article. So copies and near copies of an article on one host do not turn it into template.

Only counts of shapes and of text hashes are gathered per host; the pages themselves meet their host's
template in one join, for which the pages of a large host are dealt out over all parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import shuffle_width, whole
from lumenframe.llm.dom import BLOCK, RAW, Node, one_line, parse
from lumenframe.session import checkpoint

#: A text is template if it stands in the same place of so many different pages of the host, and in this share.
LEAST_PAGES = 3
LEAST_SHARE = 0.5
#: Template at the ends of an article holds at most this share of its text; with more the articles are near copies.
MOST_OF_ARTICLE = 0.25

# Elements and name words of what is not the article.
DROPPED = frozenset(
    "nav footer aside form button select option input label dialog menu head canvas audio video object".split()
) | RAW
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "complementary contentinfo consent cookie cookies copyright disqus footer gdpr login masthead menu modal nav "
    "navbar navigation newsletter notice notices notification pagination pager paywall popup promo promoted promotion "
    "recommended related reply replies search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
_PAGE_HEADER = frozenset("banner header masthead".split())
_MAIN_NAMES = frozenset("article articlebody main".split())


#: First words of names that tell a page's kind or layout, not what the element is.
_ABOUT = frozenset("category format has hide is layout no page post single tag template type with without".split())


def dropped(node: Node, in_article: bool) -> bool:
    """Whether the element is said not to be part of the article.

    An article or main element has to be named by a whole name; another one by the first or last word of a name
    that does not tell the layout, and never if most of the text of the page's articles lies in it.
    """
    if node.tag in ("article", "main"):
        return any(len(words) == 1 and words[0] in NAMES for words in node.names())
    if node.holds:
        return False
    if node.tag in DROPPED or (node.tag == "header" and not in_article):
        return True
    if not node.marks:
        return False
    wanted = NAMES if in_article else NAMES | _PAGE_HEADER
    return any(words and words[0] not in _ABOUT and not wanted.isdisjoint((words[0], words[-1])) for words in node.names())


def page_of(html: str) -> Node:
    """The tree of a page; elements that hold most of the text of its articles know it."""
    root = parse(html)
    order = [root]
    for node in order:
        order.extend(node.nodes())
    size: dict[int, int] = {}  # of the text below, and of that in articles
    held: dict[int, int] = {}
    for node in reversed(order):
        below = node.nodes()
        size[id(node)] = sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(size[id(c)] for c in below)
        article = node.tag in ("article", "main") and not dropped(node, False)
        held[id(node)] = size[id(node)] if article else sum(held[id(c)] for c in below)
    for node in order:
        node.holds = 2 * held[id(node)] > held[id(root)]
    return root


def articles(node: Node) -> list[Node]:
    """The outermost article elements (else main, else elements named so) outside dropped ones."""

    def search(wanted) -> list[Node]:
        found, todo = [], [node]
        while todo:
            n = todo.pop()
            if n is not node and dropped(n, False):
                continue
            if n is not node and wanted(n):
                found.append(n)
            else:
                todo.extend(c for c in reversed(n.children) if isinstance(c, Node))
        return found

    return (
        search(lambda n: n.tag == "article")
        or search(lambda n: n.tag == "main")
        or search(lambda n: any(len(words) == 1 and words[0] in _MAIN_NAMES for words in n.names()))
    )


def blocks(node: Node, in_article: bool, keep=None) -> list[str]:
    """The lines of the blocks below a node, in page order; ``keep(text)`` false drops a block."""
    out, line = [], []

    def flush() -> None:
        said = one_line(line)
        line.clear()
        if said and (keep is None or keep(said)):
            out.append(said)

    todo: list = [node]
    while todo:
        n = todo.pop()
        if n is None:
            flush()
        elif isinstance(n, str):
            line.append(n)
        elif n.tag in ("br", "td", "th"):
            line.append(" ")
            todo.extend(reversed(n.children))
        elif n is node or not dropped(n, in_article):
            if n.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(n.children))
    flush()
    return out


def shape(root: Node) -> tuple[str, list[tuple[int, int]]]:
    """The tree's shape and (node of the shape, hash of its text) of every block outside the content slot.

    The shape is written in preorder as depth and tag. Articles, and repeated siblings of one shape, are one node.
    """
    content = {id(n) for n in articles(root)}
    kinds: dict[tuple, int] = {}  # (tag, kinds of the children) -> number
    trees: list[tuple] = []
    sizes: list[int] = []
    kind_of: dict[int, int] = {}

    def children(node: Node) -> list[Node]:
        return [c for c in node.nodes() if c.tag not in RAW and c.tag != "head"]

    order = [root]
    for node in order:
        order.extend(() if id(node) in content else children(node))
    for node in reversed(order):
        parts: list[int] = []
        if id(node) not in content:
            for k in (kind_of[id(c)] for c in children(node)):
                if not parts or parts[-1] != k:
                    parts.append(k)
        tree = ("article!" if id(node) in content else node.tag, tuple(parts))
        if tree not in kinds:
            kinds[tree] = len(trees)
            trees.append(tree)
            sizes.append(1 + sum(sizes[k] for k in parts))
        kind_of[id(node)] = kinds[tree]

    lines, todo = [], [(kind_of[id(root)], 0)]
    while todo:
        k, depth = todo.pop()
        lines.append(f"{depth} {trees[k][0]}")
        todo.extend((part, depth + 1) for part in reversed(trees[k][1]))

    hashes, places = [], [(root, 0)]
    while places:
        node, at = places.pop()
        if id(node) in content:
            continue
        own = one_line([c if isinstance(c, str) else " " for c in node.children])
        if own:
            hashes.append((at, xxhash.xxh64_intdigest(own.encode("utf-8", "replace")) >> 1))
        below, last, found = at + 1, None, []
        for child in children(node):
            k = kind_of[id(child)]
            if last is not None and k != last:
                below += sizes[last]
            last = k
            found.append((child, below))
        places.extend(reversed(found))
    return "\n".join(lines), hashes


def _tree(written: str) -> list[tuple[str, list[int]]]:
    nodes, path = [], []
    for k, line in enumerate(written.split("\n")):
        depth, tag = line.split(" ", 1)
        del path[int(depth) :]
        if path:
            nodes[path[-1]][1].append(k)
        nodes.append((tag, []))
        path.append(k)
    return nodes


def tree_matching(left: str, right: str) -> list[int]:
    """For each node of ``left`` the node of ``right`` it is matched with, or -1.

    Simple tree matching: roots match if their tags do, children are aligned in order so that most nodes match.
    """
    a, b = _tree(left), _tree(right)
    weights: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def alike(i: int, j: int) -> list[tuple[int, int]]:
        """The pairs of children whose weights a pair needs."""
        return [(r, c) for r in a[i][1] for c in b[j][1] if a[r][0] == b[c][0]]

    def solve(i: int, j: int) -> None:
        rows, columns = a[i][1], b[j][1]
        best = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
        for x, r in enumerate(rows):
            for y, c in enumerate(columns):
                met = best[x][y] + (weights[r, c][0] if a[r][0] == b[c][0] else 0)
                best[x + 1][y + 1] = max(best[x][y + 1], best[x + 1][y], met)
        pairs, x, y = [], len(rows), len(columns)
        while x and y:
            if best[x][y] == best[x - 1][y]:
                x -= 1
            elif best[x][y] == best[x][y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                pairs.append((rows[x], columns[y]))
        weights[i, j] = (best[-1][-1] + 1, pairs)

    # Nodes match at equal depth only: pairs are listed from the roots on and solved from the leaves up.
    order = [(0, 0)] if a[0][0] == b[0][0] else []
    for i, j in order:
        order.extend(alike(i, j))
    for i, j in reversed(order):
        solve(i, j)

    matched = [-1] * len(a)
    todo = order[:1]
    while todo:
        i, j = todo.pop()
        matched[i] = j
        todo.extend(weights[i, j][1])
    return matched


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shape(page_of(t)) for t in batch.column("html").to_pylist()]
        nodes = pa.array([[n for n, _ in h] for _, h in found], type=pa.list_(pa.int32()))
        hashes = pa.array([[x for _, x in h] for _, h in found], type=pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), pa.array([s for s, _ in found], type=pa.string()), nodes, hashes],
            names=["host", "shape", "nodes", "hashes"],
        )


@lru_cache(maxsize=4096)
def _matched(left: str, right: str) -> list[int]:
    return tree_matching(left, right)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("shape").to_pylist(), batch.column("usual").to_pylist(), strict=True)
        matched = pa.array([_matched(s, u) for s, u in pairs], type=pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("shape"), matched], names=["host", "shape", "matched"]
        )


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """``pages`` (host, html) -> (host, constants): the hashes of the texts that are template on the host.

    Pages with the same texts in the same places count once.
    """
    shapes = pages.mapInArrow(_shapes, "host string, shape string, nodes array<int>, hashes array<long>").distinct()
    shapes = checkpoint(shapes)
    counted = shapes.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"))
    usual = counted.groupBy("host").agg(F.max(F.struct("n", "shape")).alias("u"), F.sum("n").alias("pages"))
    usual = usual.where(F.col("pages") >= least_pages).select("host", "pages", F.col("u.shape").alias("usual"))
    aligned = counted.join(usual, "host").select("host", "shape", "usual").mapInArrow(
        _align, "host string, shape string, matched array<int>"
    )
    placed = shapes.join(aligned, ["host", "shape"]).select(
        "host", "matched", F.explode(F.array_distinct(F.arrays_zip("nodes", "hashes"))).alias("t")
    )
    votes = placed.select("host", F.element_at("matched", F.col("t.nodes") + 1).alias("node"), F.col("t.hashes").alias("hash"))
    votes = votes.where("node >= 0").groupBy("host", "node", "hash").agg(F.count(F.lit(1)).alias("n"))
    constant = votes.where(F.col("n") >= least_pages).join(usual.select("host", "pages"), "host")
    constant = constant.where(F.col("n") >= least_share * F.col("pages"))
    return constant.groupBy("host").agg(F.collect_set("hash").alias("constants"))


def line_hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "replace")) >> 1


def article_lines(root: Node) -> list[str]:
    return [line for n in articles(root) for line in blocks(n, True)]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [article_lines(page_of(t)) for t in batch.column("html").to_pylist()]
        bodies = pa.array([line_hash("\n".join(lines)) for lines in found], type=pa.int64())
        hashes = pa.array([list(dict.fromkeys(map(line_hash, lines))) for lines in found], type=pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("host"), bodies, hashes], names=["host", "body", "hashes"])


def repeated_lines(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """``pages`` (host, html) -> (host, repeated): the hashes of the lines that most different articles of the host have."""
    bodies = pages.mapInArrow(_lines, "host string, body long, hashes array<long>").where("size(hashes) > 0")
    bodies = bodies.dropDuplicates(["host", "body"])  # copies of an article count once
    counts = bodies.select("host", F.explode(F.concat(F.array(F.lit(-1).cast("long")), "hashes")).alias("hash"))
    counts = checkpoint(counts.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages))
    every = counts.where("hash = -1").select("host", F.col("n").alias("articles"))
    often = counts.where("hash >= 0").join(every, "host").where(F.col("n") >= least_share * F.col("articles"))
    return often.groupBy("host").agg(F.collect_set("hash").alias("repeated"))


def inner_lines(lines: list[str], repeated: list[int] | None) -> range:
    """The places of the lines of an article without the repeated ones it begins and ends with."""
    known = frozenset(repeated or ())
    own = [k for k, line in enumerate(lines) if line_hash(line) not in known] if known else []
    if not own:
        return range(len(lines))
    kept = range(own[0], own[-1] + 1)
    total, left = sum(map(len, lines)), sum(len(lines[k]) for k in kept)
    return kept if total - left <= MOST_OF_ARTICLE * total else range(len(lines))


def slots(root: Node, content: list[Node], constants: frozenset[int], repeated: list[int] | None) -> list[str]:
    """The lines of the articles, and of the blocks around them that are not template, in page order.

    A block is template if the texts of all its elements are, each by itself, as the pages of the host were voted on.
    """
    inside = {id(n) for n in content}
    found: list[tuple[str, bool]] = []  # lines, and whether they are of an article
    line: list[str] = []
    fresh = False  # whether the block has a text that is no template

    def flush() -> None:
        nonlocal fresh
        said = one_line(line)
        if said and fresh and line_hash(said) not in constants:
            found.append((said, False))
        line.clear()
        fresh = False

    todo: list = [root]
    while todo:
        n = todo.pop()
        if n is None:
            flush()
        elif isinstance(n, str):
            line.append(n)
        elif id(n) in inside:
            flush()
            found.extend((said, True) for said in blocks(n, True))
        elif n.tag in ("br", "td", "th") or n is root or not dropped(n, False):
            if n.tag in ("br", "td", "th"):
                line.append(" ")
            elif n.tag in BLOCK:
                flush()
                todo.append(None)
            own = one_line([c if isinstance(c, str) else " " for c in n.children])
            parts = [*n.children]
            if own and line_hash(own) not in constants:
                parts = [c if not isinstance(c, str) or not c.strip() else _Fresh(c) for c in parts]
            todo.extend(reversed(parts))
        if isinstance(n, _Fresh):
            fresh = True
    flush()
    article = [said for said, own in found if own]
    kept, place, out = inner_lines(article, repeated), 0, []
    for said, own in found:
        if not own or place in kept:
            out.append(said)
        place += own
    return out


class _Fresh(str):
    """A text of an element whose text is no template."""


def main_text(html: str, constants: list[int] | None, repeated: list[int] | None = None) -> str:
    """The slots of a page. Where nothing is known of the host's template, an article stands for them."""
    root = page_of(html)
    content, known = articles(root), frozenset(constants or ())
    if content and known:
        return "\n".join(slots(root, content, known, repeated))
    if content:
        lines = article_lines(root)
        return "\n".join(lines[k] for k in inner_lines(lines, repeated))
    keep = (lambda s: line_hash(s) not in known) if known else None
    return "\n".join(blocks(root, False, keep))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = (batch.column(c).to_pylist() for c in ("html", "constants", "repeated"))
        texts = [main_text(*page) for page in zip(*told, strict=True)]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page; null or empty html gives the empty text.

    Blocks are joined by newlines, white space inside a block is one space, character references are decoded.
    Pages without a url or host are a host of their own together. Repeated pages get repeated results; an empty
    table gives no rows.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        F.lower(F.regexp_extract(whole(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        whole(html).alias("html"),
    )
    own = rows.select("host", "html")
    constants = templates(own).join(repeated_lines(own), "host", "full")
    # A host with more pages than a part of the shuffle should get is dealt out by page; there are few such hosts.
    width = shuffle_width(pages.sparkSession)
    counts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    large = counts.where(F.col("n") * 4 * width > rows.count()).select("host")
    large = F.broadcast(large.withColumn("large", F.lit(True)))  # at most 4 x width hosts
    seats = F.when(F.col("large"), F.lit(width)).otherwise(F.lit(1))
    dealt = rows.join(large, "host", "left").withColumn("seat", F.pmod(F.xxhash64("page_id", "url"), seats))
    constants = constants.join(large, "host", "left").withColumn(
        "seat", F.explode(F.sequence(F.lit(0).cast("long"), (seats - 1).cast("long")))
    )
    joined = dealt.drop("large").join(constants.drop("large"), ["host", "seat"], "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    found = joined.select("page_id", "url", "html", "constants", "repeated").mapInArrow(
        _extract, f"page_id {kind}, url string, text string"
    )
    return found.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by removal of site templates.

Every element's subtree is hashed (tag, kind and content). Spark counts, for
each host, in how many different surroundings each hash stands; subtrees that
recur in many are template and are deleted, as are elements whose tag or class
says that they are no article text. Of what is left the article is kept: the
``article`` or ``main`` elements where a page has them, else the whole body.

Surroundings are told apart by the longest texts outside the subtree: a host may
serve one article at many addresses, and its parts then count once. Counts
within articles and outside them are kept apart. Within an article only whole
containers (boxes, lists, sections) can be template: a heading, a paragraph or a
run of words that several articles share is their text, and so is a container
that holds over half of its article.

Furniture whose words differ from page to page recurs in form alone. So on pages
without an ``article`` or ``main`` skeletons are counted too: tag, kind and the
forms of the blocks and links below, without text, equal siblings folded. With each skeleton
go the text that it holds, its spread and its links. A container whose place holds
half of its pages' text is the article's; boxes outside it whose skeleton recurs
with little text are furniture, and boxes of links wherever they are. Headings and
paragraphs never are.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_small_batches, materialise, returning_memory, without_nulls

#: A subtree is template where it stands on this share of its host's pages (or articles), and on so many.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.3, 4
#: So many pages, and this share of very large hosts, are enough too: furniture of a section of the site.
SECTION_SHARE, SECTION_PAGES = 0.01, 100
#: Stand for a page and an article as a whole among the hashes, those within articles being negative.
PAGES, ARTICLES = 0, -1
#: Longest texts outside a subtree by which its surroundings are told apart.
LONGEST = 3
#: Text under this many characters recurs by chance and is template only with its surroundings.
TEMPLATE_CHARS = 8
#: A skeleton's box is a menu if so much of its text is links, and furniture if it holds so little of its pages' text, on average and in spread.
LINK_SHARE, SMALL_SHARE = 0.5, 0.2
#: So much of its pages' text the article's container holds.
CONTAINER_SHARE = 0.5
#: What a row of counts is of, and the last two bits of what skeletons are found to be.
EXACT, SKELETON, PLACE = 0, 1, 2
LINKS, SMALL, CONTAINER = 1, 2, 3
#: Most bytes of template hashes that are sent to all tasks; more are joined by host.
BROADCAST_BYTES = 32 << 20

# Elements without end tag, elements of raw text, blocks, and what is no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg canvas".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
NEVER = frozenset("script style noscript template iframe svg canvas head title nav aside footer form menu select button input textarea dialog object embed audio video map".split())
#: What can be template within an article.
BOXES = frozenset("address aside center details div dl fieldset figure footer header hgroup menu ol section table ul".split())
#: What can be furniture by its skeleton.
FURNITURE = BOXES | frozenset("nav form menu dir".split())
#: No text at all, whatever tags and classes are held to mean.
UNSEEN = frozenset("script style noscript template iframe svg canvas head title textarea".split())
#: Within the article an id of these names a place in the text.
TITLES = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: ``p`` ends where one of these begins.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Words of class, id and role that mark what is no article text.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|commentlist|disqus|cookie|cookies|consent|gdpr|disclaimer|footer|masthead|login|menu|modal|nav|navbar|navigation|newsletter|notice|notices|notification|pager|pagination|popup|promo|related|recommended|replies|respond|search|share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|subscription|tags|toolbar|widget|widgets|complementary|contentinfo|alert|alertdialog)(?:$|[\s_-])"
)
#: Such words that within an article may just as well mark its own text; boxes that recur there are found by their counts.
_TEXT_MARKS = frozenset("search tags related recommended complementary".split())
#: Such words that mark a notice if a box has them, but may mark a paragraph or a run of the text.
_NOTICES = frozenset("notice notices disclaimer".split())
_MARK = re.compile(r"[\s_-]+")
#: Marks of a header; within the article it holds the headline, elsewhere it is site furniture.
_HEADER = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])")
#: Marks of an ``article`` element that is not the page's article.
_OTHER_ARTICLE = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|comment|comments|promo|related|reply|sponsored|teaser|recommended)(?:$|[\s_-])")
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)|[\"'=])*)(?:>|\Z)", re.S)
_KIND = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\b(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_CAMEL = re.compile(r"([a-z])([A-Z])")


class Node:
    __slots__ = ("tag", "kind", "parts", "hash", "chars", "drop", "skeleton", "place", "links")

    def __init__(self, tag: str, kind: str = "", drop: bool = False):
        self.tag, self.kind, self.parts, self.drop = tag, kind, [], drop
        self.hash = self.chars = self.skeleton = self.place = self.links = 0


def _hyphened(kinds) -> str:
    return _CAMEL.sub(r"\1-\2", " ".join(kinds)).lower()


def parse(page: str, known: bool = True) -> Node:
    """A tree of the page; end tags may be missing, and stray ones are ignored. ``known``: whether tags and classes tell what is no article text."""
    root = Node("#root")
    stack, at = [root], 0
    while True:
        found = _MARKUP.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            text = page[at:end]
            stack[-1].parts.append(html.unescape(text) if "&" in text else text)
        if not found:
            return root
        at = found.end()
        name = found.group(2)
        if name is None:
            continue
        tag = name.lower()
        if found.group(1):
            depth = len(stack) - 1
            while depth and stack[depth].tag != tag:
                depth -= 1
            if depth:
                del stack[depth:]
            continue
        attributes = found.group(3)
        kinds = [(n.lower(), a or b or c) for n, a, b, c in _KIND.findall(attributes)] if attributes else []
        if tag in ENDS_P and any(n.tag == "p" for n in stack[-4:]):
            depth = max(k for k, n in enumerate(stack) if n.tag == "p")
            del stack[depth:]
        elif tag == "li" and stack[-1].tag == "li" or tag in ("dd", "dt") and stack[-1].tag in ("dd", "dt") or tag in ("td", "th") and stack[-1].tag in ("td", "th"):
            stack.pop()
        elif tag == "tr" and stack[-1].tag in ("td", "th", "tr"):
            while stack[-1].tag in ("td", "th", "tr"):
                stack.pop()
        elif tag == "option" and stack[-1].tag == "option":
            stack.pop()
        kind = _hyphened(k for _, k in kinds)
        marks = {"html": None, "body": None, "main": None, "article": _OTHER_ARTICLE}.get(tag, BOILERPLATE)
        marked = bool(kind) and marks is not None and bool(marks.search(kind))
        if marked and any(map(_is_main, stack)):
            own = _hyphened(k for n, k in kinds if n != "id" or tag not in TITLES)
            marked = bool(marks.search(" ".join(w for w in _MARK.split(own) if w not in (_TEXT_MARKS if tag in BOXES else _TEXT_MARKS | _NOTICES)) if marks is BOILERPLATE else own))
        node = Node(tag, kind, tag in NEVER or marked or bool(attributes) and bool(_HIDDEN.search(attributes)) if known else tag in UNSEEN)
        stack[-1].parts.append(node)
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.parts.append(page[at : close.start() if close else len(page)])
            at = close.end() if close else len(page)
            continue
        stack.append(node)


def _walk(root: Node):
    """All nodes, children before parents."""
    todo, order = [root], []
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in node.parts if isinstance(p, Node)]
    return reversed(order)


def hash_subtrees(root: Node) -> None:
    """Sets each node's ``hash`` (of tag, kind and content, white space evened out) and ``chars`` (of what isn't dropped)."""
    for node in _walk(root):
        held, node.chars = [node.tag, node.kind], 0
        for part in node.parts:
            if isinstance(part, Node):
                held.append(str(part.hash))
                node.chars += 0 if part.drop else part.chars
            else:
                text = " ".join(part.split())
                held.append(text)
                node.chars += len(text)
        node.hash = xxhash.xxh64_intdigest("\x1f".join(held), 42) >> 1


_DIGITS = re.compile(r"\d+")


def hash_skeletons(root: Node) -> None:
    """Sets each node's ``skeleton``, ``place`` (tags and kinds from the root on; the last two bits of both are 0) and ``links`` (characters); ``chars`` must be set."""
    above: dict[Node, int] = {}
    order = list(_walk(root))
    for node in reversed(order):  # parents before children
        node.place = xxhash.xxh64_intdigest(f"{above.get(node, 0)} {node.tag} {_DIGITS.sub('#', node.kind)}", 42) >> 3 << 2
        above.update((part, node.place) for part in node.parts if isinstance(part, Node))
    for node in order:
        below = [part for part in node.parts if isinstance(part, Node) and not part.drop]
        node.links = node.chars if node.tag == "a" else sum(part.links for part in below)
        forms = dict.fromkeys(part.skeleton for part in below if part.tag in BLOCKS or part.tag == "a")
        node.skeleton = xxhash.xxh64_intdigest(" ".join([node.tag, _DIGITS.sub("#", node.kind), *map(str, forms)]), 43) >> 3 << 2


def skeleton_candidates(root: Node) -> dict[tuple[int, int], list[int]]:
    """By (SKELETON or PLACE, hash) the characters of text and of links of a page's boxes and places, those alike added up."""
    found: dict[tuple[int, int], list[int]] = {}
    todo = [root]
    while todo:
        node = todo.pop()
        todo += [p for p in node.parts if isinstance(p, Node) and not p.drop]
        keys = [(PLACE, node.place)] if node.tag in BLOCKS and node.tag not in TITLES else []
        if node.tag in FURNITURE and node.chars:
            keys.append((SKELETON, node.skeleton))
        for key in keys:
            sums = found.setdefault(key, [0, 0])
            sums[0] += node.chars
            sums[1] += node.links
    return found


def drop_furniture(root: Node, found: frozenset[int] | set[int]) -> None:
    """Marks the boxes that ``found`` holds: of links anywhere, small ones outside the innermost container of the article; never half of the page."""
    inner, todo = None, [root]
    while todo:
        node = todo.pop()
        if node.place | CONTAINER in found and 2 * node.chars >= root.chars:
            inner = node
        todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.drop and 2 * p.chars >= root.chars]
    steps = [(root, inner is None)]
    while steps:
        node, within = steps.pop()
        within = within or node is inner
        if node.tag in FURNITURE and 2 * node.chars < root.chars and (node.skeleton | LINKS in found and node.links >= LINK_SHARE * node.chars or not within and node.skeleton | SMALL in found):
            node.drop = True
        else:
            steps += [(p, within) for p in node.parts if isinstance(p, Node) and not p.drop]


def _is_main(node: Node) -> bool:
    return node.tag in ("article", "main") or node.kind == "main"


def _mains(root: Node) -> list[Node]:
    """The outermost articles and mains in page order; a main has its articles and what stands beside them."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.drop:
            continue
        if _is_main(node):
            found.append(node)
        else:
            todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return found


def _surroundings(top: Node):
    """(node, within an article below ``top``, hash of the longest texts outside the node) of the nodes that aren't dropped.

    For ``top`` itself the longest texts are its own.
    """
    texts: list[tuple[int, str]] = []
    spans: list[tuple[Node, bool, int, int]] = []
    todo: list[tuple] = [(top, False, -1)]
    while todo:
        part, within, first = todo.pop()
        if isinstance(part, str):
            if text := " ".join(part.split()):
                texts.append((len(text), text))
        elif first >= 0:
            spans.append((part, within, first, len(texts)))
        elif not part.drop:
            inner = within or part is not top and _is_main(part)
            todo.append((part, inner, len(texts)))
            todo += [(p, inner, -1) for p in reversed(part.parts)]
    before: list[list] = [[]]
    for t in texts:
        before.append(sorted([*before[-1], t], reverse=True)[:LONGEST])
    after: list[list] = [[]]
    for t in reversed(texts):
        after.append(sorted([*after[-1], t], reverse=True)[:LONGEST])
    for node, within, first, end in spans:
        rest = before[-1] if node is top else sorted(before[first] + after[len(texts) - end], reverse=True)[:LONGEST]
        yield node, within, xxhash.xxh64_intdigest("\x1f".join(t for _, t in rest), 42) >> 1


def template_candidates(root: Node) -> set[tuple[int, int]]:
    """(hash, surroundings) of the subtrees outside the article that could be template."""
    return {(node.hash, rest) for node, within, rest in _surroundings(root) if not within and node.tag not in ("#root", "html", "body") and node.chars >= TEMPLATE_CHARS}


def _is_box(node: Node, top: Node) -> bool:
    """Whether a node within the article ``top`` can be template."""
    return node.tag in BOXES and TEMPLATE_CHARS <= node.chars <= top.chars / 2


def article_candidates(top: Node) -> set[tuple[int, int]]:
    """(hash, surroundings) of the subtrees of an article that could be template, hashes inverted, and of the article as ARTICLES."""
    found = set()
    for node, _, rest in _surroundings(top):
        if node is top:
            found.add((ARTICLES, rest))
        elif _is_box(node, top):
            found.add((~node.hash, rest))
    return found


def main_text(root: Node, template: frozenset[int] | set[int] = frozenset(), known: bool = True) -> str:
    """The article's blocks, trimmed and joined by empty lines.

    ``template``: hashes outside articles, inverted ones within them, and what
    skeletons are found to be. ``known``: as in ``parse``.
    """
    mains = _mains(root) if known else []
    if template and not mains:
        hash_skeletons(root)
        drop_furniture(root, template)
    inside = bool(mains)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    for top in mains or [root]:
        steps: list = [top]
        while steps:
            step = steps.pop()
            if isinstance(step, str):
                line.append(step)
            elif step is None:
                flush()
            elif step.drop or (~step.hash in template and step is not top and _is_box(step, top) if inside else step.hash in template):
                continue
            elif known and not inside and (step.tag == "header" or _HEADER.search(step.kind)) and step.tag not in ("html", "body"):
                continue
            elif step.tag == "br":
                line.append(" ")
            else:
                block = step.tag in BLOCKS or step.tag == "#root"
                if block:
                    flush()
                    steps.append(None)
                steps += reversed(step.parts)
        flush()
    return "\n\n".join(blocks)


def _host(url) -> F.Column:
    return F.coalesce(F.lower(F.try_parse_url(F.regexp_replace(url, r"[\s\\^`{}|<>\"]", ""), F.lit("HOST"))), F.lit(""))


def site_templates(pages: DataFrame, known: bool = True) -> DataFrame:
    """(host, hashes): subtrees that recur on many pages, or in many articles (inverted), of the host, and its skeletons.

    ``pages`` has columns host and html. A page's share is bounded by its
    elements, so a host has at most (elements of a page) / SECTION_SHARE of
    them, or (elements of all pages) / TEMPLATE_PAGES if that is less.
    """
    def hashed(batches):
        for batch in batches:
            rows: list[tuple] = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root = parse(page, known)
                hash_subtrees(root)
                own = template_candidates(root)
                own |= {(PAGES, rest) for node, _, rest in _surroundings(root) if node is root}
                mains = _mains(root) if known else []
                for top in mains:
                    own |= article_candidates(top)
                rows += [(host, EXACT, h, rest, 0, 0, 0.0, 0.0) for h, rest in own]
                if not mains and root.chars:
                    hash_skeletons(root)
                    rows.append((host, SKELETON, PAGES, 0, 0, 0, 0.0, 0.0))
                    rows += [(host, what, h, 0, c, links, c / root.chars, (c / root.chars) ** 2) for (what, h), (c, links) in skeleton_candidates(root).items()]
            yield pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema).combine_chunks().to_batches()[0] if rows else pa.record_batch([[]] * len(schema), schema)

    kinds = {"host": pa.string(), "what": pa.int32(), "hash": pa.int64(), "rest": pa.int64(), "chars": pa.int64(), "links": pa.int64(), "share": pa.float64(), "square": pa.float64()}
    schema, sums = pa.schema(kinds), ("chars", "links", "share", "square")
    each = by_small_batches(pages).select("host", "html").mapInArrow(returning_memory(hashed), "host string, what int, hash long, rest long, chars long, links long, share double, square double")
    # an exact subtree counts once in each of its surroundings, a skeleton on each page
    each = each.groupBy("host", "what", "hash", "rest").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in sums))
    counts = each.groupBy("host", "what", "hash").agg(F.sum(F.when(F.col("what") == EXACT, 1).otherwise(F.col("n"))).alias("n"), *(F.sum(c).alias(c) for c in sums))
    often = counts.where(F.col("n") >= TEMPLATE_PAGES)
    often = materialise(often, "subtrees")
    is_total = F.col("hash").isin(PAGES, ARTICLES)
    often = often.withColumn("of", F.when(F.col("what") != EXACT, SKELETON).when(F.col("hash") < 0, ARTICLES).otherwise(PAGES))
    totals = often.where(is_total).select("host", "of", F.col("n").alias("pages"))
    least = F.least(TEMPLATE_SHARE * F.col("pages"), F.greatest(F.lit(float(SECTION_PAGES)), SECTION_SHARE * F.col("pages")))
    mean, n = F.col("share") / F.col("n"), F.col("n")
    spread = F.sqrt(F.greatest(F.col("square") / n - mean * mean, F.lit(0.0)))
    meaning = (
        F.when(F.col("what") == EXACT, F.col("hash"))
        .when(F.col("what") == PLACE, F.when(mean >= CONTAINER_SHARE, F.col("hash").bitwiseOR(F.lit(CONTAINER))))
        .when(F.col("links") >= LINK_SHARE * F.col("chars"), F.col("hash").bitwiseOR(F.lit(LINKS)))
        .when((mean <= SMALL_SHARE) & (spread <= SMALL_SHARE), F.col("hash").bitwiseOR(F.lit(SMALL)))
    )
    enough = n >= F.when(F.col("what") == EXACT, least).otherwise(TEMPLATE_SHARE * F.col("pages"))
    kept = often.where(~is_total).join(totals, ["host", "of"]).where(enough).select("host", meaning.alias("hash")).where("hash is not null")
    return kept.groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", known: bool = True) -> DataFrame:
    """Per row: page_id, url, ``text`` and ``n_chars`` (code points).

    Null and empty pages give an empty text. Pages without a host (null or odd
    addresses) share one nameless host. Repeated rows are extracted each, and
    count as pages of their host. Other columns are ignored. Character
    references are decoded, white space within a block becomes one space, and
    nothing of the article is cut. ``known``: whether tags and classes tell what
    is no article text; without it the counts alone do.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), _host(F.col(url_column)).alias("host"), without_nulls(F.col(html_column)).alias("html"))
    templates = materialise(site_templates(rows, known), "templates")
    size = templates.agg(F.coalesce(F.sum(8 * F.size("hashes") + 64 + F.length("host")), F.lit(0)).alias("bytes")).first()["bytes"]
    kind = rows.schema["page_id"].dataType.simpleString()
    small = None
    if size <= BROADCAST_BYTES:
        small = spark.sparkContext.broadcast({r["host"]: frozenset(r["hashes"]) for r in templates.collect()})
        rows = rows.withColumn("hashes", F.lit(None).cast("array<long>"))
    else:
        # a host may hold a third of all pages: AQE splits its partition and sends its templates along
        rows = rows.join(templates.hint("merge"), "host", "left")

    def extracted(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = []
                for host, page, own in zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in ("host", "html", "hashes"))):
                    template = small.value.get(host, frozenset()) if small else frozenset(own or ())
                    root = parse(page, known)
                    if template:
                        hash_subtrees(root)
                    texts.append(main_text(root, template, known))
                ids, urls = (part.column(part.schema.get_field_index(c)) for c in ("page_id", "url"))
                yield pa.record_batch([ids, urls, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return by_small_batches(rows).mapInArrow(returning_memory(extracted), f"page_id {kind}, url string, text string, n_chars long")

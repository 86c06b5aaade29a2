"""Main-text extraction by wrapper induction.

Pages of one host come from one template.  The DOM tree of each page is
reduced to a skeleton (block elements; siblings with the same tag and class
become one node, as records of a list).  The host's most frequent skeleton is
the reference; the others are aligned with it by simple tree matching, so
that nodes of different pages get common template nodes.  Over all pages of
the host it is counted which texts a template node holds:

* a node with the same text on most pages is part of the template and goes,
* a node whose text varies is a slot, and its blocks are content.

Markup comes second.  Menus, footers, asides, forms, scripts and headers go
by their tags alone.  ``article`` and ``main`` declare where the content is:

* Inside declared slots the verdict goes by block: a text that most of the
  host's different declared slots with its path hold is part of the template
  and goes, and so does a block of links in a menu.  Pages whose declared
  slots are equal count once, so copies do not make their story a constant.
* A slot outside stays if it is known to vary and is long: ``LONG_SLOT``
  characters, or more than the declared slots hold together.

A class, id or role with a word like ``comments``, ``sidebar`` or ``ad`` says
that its element is no content, except where the element holds the page's
story: its longest slot after the verdicts above, among the declared ones if
one of them is under no such name.  A slot under no such name is the story
unless one under a name is twice as long, and readers' comments are only if
nothing else is left.  A word that is a part of a name
(``has-sidebar``) counts on containers only.

All counts are Spark aggregations over (host, node, text hash) and (host,
path, text hash): no host is gathered in one task, and alignment runs once
per (host, skeleton).

Cases: a null or empty html gives an empty text; a null url is the host "";
hosts with fewer than ``LEAST_PAGES`` pages have no constants and rely on the
markup; unclosed, misnested and truncated markup closes where HTML closes it,
and a tag with an unclosed quote ends at its first ``>``; elements have their
own node and role at any depth; of slots equally long the first is the story.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import Scratch, map_documents, schema_of
from tillroll.plans.materialize import write_and_read

#: A template node is constant when one text has this share of its pages, and
#: it was seen on this many.
CONSTANT_SHARE = 0.6
LEAST_PAGES = 4
#: Links that make a slot a menu, as a share of its characters.
LINK_SHARE = 0.5
#: Characters that make a varying slot outside the declared ones content.
LONG_SLOT = 200

# HTML element names by their behaviour.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements closed by the start of another of their group, up to a container.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NEVER = frozenset(
    "nav footer aside form script style noscript template iframe button select textarea svg head title dialog menu "
    "object canvas audio video fieldset search input label".split()
)
NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "notice notices alert popup modal newsletter subscribe signup login sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer comment comments disqus reply replies respond share sharing social "
    "related recommended widget toolbar pagination pager contentinfo complementary search skip".split()
)

#: Words of readers' comments, and those that count as parts of names inside
#: declared slots (all others only outside).
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
INSIDE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent popup "
    "modal newsletter subscribe signup login sidebar breadcrumb breadcrumbs share sharing social related recommended "
    "widget toolbar pagination pager".split()
)
#: Elements on which a part of a name counts.
CONTAINERS = frozenset("div section article aside ul ol dl table header figure details center address".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"(?:^|(?<=\s))(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/:?#]+)")

PLAIN, EXCLUDED, DECLARED = 0, 1, 2


@dataclass
class Node:
    """A block element; ``texts`` are its own blocks (page order, text, link
    characters)."""

    label: str
    tag: str = ""
    names: str = ""
    role: int = 0
    named: int = 0
    children: list["Node"] = field(default_factory=list)
    texts: list[tuple[int, str, int]] = field(default_factory=list)


def _hash64(text: str) -> int:
    """Signed 64-bit hash."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))).astype(np.int64))


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _named(names: str) -> bool:
    """A whole class, id or role is one of ``NEVER_WORDS``."""
    return bool(names) and not NEVER_WORDS.isdisjoint(names.split())


def _name_kind(node: Node) -> int:
    """0: the names say nothing, 1: no content, 2: readers' comments."""
    if not node.names or node.tag in ("html", "body"):
        return 0
    tokens = set(node.names.split())
    words = set(_WORD.findall(node.names)) if node.tag in CONTAINERS else tokens
    if not COMMENT_WORDS.isdisjoint(words):
        return 2
    parts = INSIDE_WORDS if node.role == DECLARED else NEVER_WORDS
    return int(not (NEVER_WORDS.isdisjoint(tokens) and parts.isdisjoint(words)))


def assign_roles(root: Node) -> None:
    """Roles by tags, and what the names say, of all nodes."""
    order = [root]
    for node in order:
        order.extend(node.children)
        for child in node.children:
            if node.role == EXCLUDED or child.tag in NEVER or (child.tag == "header" and node.role != DECLARED):
                child.role = EXCLUDED
            else:
                child.role = DECLARED if child.tag in ("article", "main") else node.role
            child.named = _name_kind(child)


def parse(source: str | None) -> Node:
    """The tree of block elements of a page."""
    root = Node("page")
    # (tag, node for its text, excluded inline (1 by a name, 2 by its tag), link)
    stack: list[tuple[str, Node, int, bool]] = [("", root, 0, False)]
    parts: list[str] = []
    links = order = 0

    def flush() -> None:
        nonlocal links, order
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                stack[-1][1].texts.append((order, text, min(links, len(text))))
                order += 1
            parts.clear()
        links = 0

    def add(text: str) -> None:
        nonlocal links
        _, _, skip, link = stack[-1]
        if skip:
            return
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        if link:
            links += len(text.strip())

    def close(to: int) -> None:
        while len(stack) > to:
            if stack[-1][0] in BLOCK:
                flush()
            stack.pop()

    def close_open(names: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                close(i)
                return
            if stack[i][0] in until:
                return

    page = source or ""
    at, n = 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        if m is None:
            if (cut := page.find("<", at)) >= 0 and re.match(r"</?[a-zA-Z]|<!", page[cut : cut + 3]):
                add(page[at:cut])  # the page ends inside a tag
            else:
                add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        ends, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
                if stack[i][0] in BLOCK and tag not in BLOCK:
                    break  # an inline end tag does not close a block
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}", re.I).search(page, at)
            at = end.start() if end else n
            if (gt := page.find(">", at)) >= 0 and end:
                at = gt + 1
            continue
        if tag == "br":
            add(" ")
            continue
        if tag == "hr":
            flush()
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            flush()
            close_open({"p"}, {"table", "button", "td", "th"})
        if tag in CLOSES:
            close_open(*CLOSES[tag])
        _, node, skip, link = stack[-1]
        names = " ".join(a or b or c for _, a, b, c in _NAMES.findall(attributes)).lower() if attributes else ""
        if tag in BLOCK:
            if skip == 1 and tag in ("article", "main"):
                skip = 0
            label = tag + ("." + ".".join(sorted(set(_WORD.findall(names)))) if names else "")
            child = Node(label, tag, names)
            node.children.append(child)
            stack.append((tag, child, skip, link))
        else:
            skip = max(skip, 2 if tag in NEVER else int(_named(names)))
            stack.append((tag, node, skip, link or tag == "a"))
    close(1)
    flush()
    assign_roles(root)
    return root


@dataclass
class Skeleton:
    """Merged tree of a page: nodes in preorder, and each block's node."""

    labels: list[str] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    named: list[int] = field(default_factory=list)
    # order, node, role, text, links
    blocks: list[tuple[int, int, int, str, int]] = field(default_factory=list)

    def chains(self) -> list[tuple[int, ...]]:
        """Of each node, the named nodes from the top down to itself."""
        out: list[tuple[int, ...]] = [()] * len(self.labels)  # preorder
        for i, below in enumerate(self.children):
            if self.named[i]:
                out[i] += (i,)
            for c in below:
                out[c] = out[i]
        return out

    def marks(self) -> list[tuple[int, int, int]]:
        """(block's number, hash of its node's path, hash of path and text)
        of each declared block."""
        paths = [0] * len(self.labels)  # preorder: a node comes before its children
        for i, below in enumerate(self.children):
            paths[i] = _hash64(f"{paths[i]}/{self.labels[i]}")
            for c in below:
                paths[c] = paths[i]
        return [
            (k, paths[node], _hash64(f"{paths[node]}\n{text}"))
            for k, (_, node, role, text, *_) in enumerate(self.blocks)
            if role == DECLARED
        ]

    @property
    def text(self) -> str:
        """The skeleton as a string: labels with brackets around children."""

        out, todo = [], [0]
        while todo:
            i = todo.pop()
            if i < 0:
                out.append(")")
                continue
            out.append(("(" if i else "") + self.labels[i])
            todo += [-1] * (i > 0) + self.children[i][::-1]
        return "".join(out)


def skeleton(root: Node) -> Skeleton:
    """Merge siblings with one label into one node, from the top down."""
    out = Skeleton()

    todo: list[tuple[int, list[Node]]] = [(-1, [root])]
    while todo:
        above, nodes = todo.pop()
        number = len(out.labels)
        out.labels.append(nodes[0].label)
        out.children.append([])
        out.named.append(nodes[0].named)
        if above >= 0:
            out.children[above].append(number)
        groups: dict[str, list[Node]] = {}
        for node in nodes:
            out.blocks += [(order, number, node.role, text, links) for order, text, links in node.texts]
            for child in node.children:
                groups.setdefault(child.label, []).append(child)
        todo += [(number, same) for same in reversed(groups.values())]
    out.blocks.sort(key=lambda b: b[0])
    return out


def read_skeleton(text: str) -> tuple[list[str], list[list[int]]]:
    """Labels and children (preorder) of a skeleton string."""
    labels: list[str] = []
    children: list[list[int]] = []
    path: list[int] = []
    for label, mark in re.findall(r"([^()]*)([()]|$)", text):
        if label:
            if path:
                children[path[-1]].append(len(labels))
            path.append(len(labels))
            labels.append(label)
            children.append([])
        if mark == ")":
            path.pop()
    return labels, children


def match_trees(a: tuple[list[str], list[list[int]]], b: tuple[list[str], list[list[int]]]) -> dict[int, int]:
    """Simple tree matching: the largest order-keeping match of two labelled
    trees with equal roots, as {node of a: node of b}."""
    (la, ca), (lb, cb) = a, b
    if la[0] != lb[0]:
        return {}
    # Pairs of equal labels below equal pairs, each after the pair above it.
    pairs = [(0, 0)]
    for i, j in pairs:
        pairs.extend((p, q) for p in ca[i] for q in cb[j] if la[p] == lb[q])
    sizes: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], np.ndarray] = {}
    for i, j in reversed(pairs):
        table = np.zeros((len(ca[i]) + 1, len(cb[j]) + 1), dtype=np.int64)
        for x, p in enumerate(ca[i]):
            for y, q in enumerate(cb[j]):
                table[x + 1, y + 1] = max(table[x, y + 1], table[x + 1, y], table[x, y] + sizes.get((p, q), 0))
        tables[i, j] = table
        sizes[i, j] = int(table[-1, -1]) + 1

    found: dict[int, int] = {}
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        found[i] = j
        table, x, y = tables[i, j], len(ca[i]), len(cb[j])
        while x and y:
            if table[x, y] == table[x - 1, y]:
                x -= 1
            elif table[x, y] == table[x, y - 1]:
                y -= 1
            else:
                x, y = x - 1, y - 1
                todo.append((ca[i][x], cb[j][y]))
    return found


_TEXTS = (
    "host string, shape long, skeleton string, node int, text_hash long, pages long, chars long, links long, "
    "path long, content long"
)


def node_texts(pages: DataFrame) -> DataFrame:
    """How often each skeleton node of a host holds which text, summed per
    task slice.  ``shape`` is the skeleton's hash; node -1 stands for the page
    itself and carries the skeleton.  Rows with ``content``
    (a hash of all declared blocks of a page) are single declared blocks by
    ``path``, once per content and slice."""
    schema = schema_of(_TEXTS)
    names = schema.names

    def run(cols: dict) -> dict:
        sums: Counter = Counter()
        chars: Counter = Counter()
        links: Counter = Counter()
        declared: set[tuple[str, int, int, int]] = set()
        for url, source in zip(cols["url"], cols["html"]):
            s = skeleton(parse(source))
            name, host = s.text, host_of(url)
            marks = s.marks()
            content = _hash64(" ".join(str(m) for _, _, m in marks))
            declared.update((host, path, mark, content) for _, path, mark in marks)
            own: dict[int, list] = {}
            for _, node, _, text, linked in s.blocks:
                held = own.setdefault(node, [xxhash.xxh3_64(), 0, 0])
                held[0].update(text.encode("utf-8", "replace") + b"\n")
                held[1] += len(text)
                held[2] += linked
            shape = _hash64(name)
            sums[host, shape, name, -1, 0] += 1
            for node, (digest, n, linked) in own.items():
                key = (host, shape, None, node, int(np.uint64(digest.intdigest()).astype(np.int64)))
                sums[key] += 1
                chars[key] += n
                links[key] += linked
        keys = list(sums)
        rows = [(*k, sums[k], chars[k], links[k], None, None) for k in keys]
        rows += [(host, None, None, None, mark, 1, 0, 0, path, content) for host, path, mark, content in declared]
        return dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}

    return map_documents(pages, run, schema, ["url", "html"], text_col="html")


def _alignments(counts: DataFrame) -> DataFrame:
    """(host, shape, node, place): the template node of each skeleton node as
    the reference's number, or a negative number of its own."""
    shapes = counts.where("node = -1").groupBy("host", "shape").agg(
        F.sum("pages").alias("pages"), F.min("skeleton").alias("skeleton")
    )
    reference = shapes.groupBy("host").agg(
        F.max(F.struct("pages", "skeleton")).getField("skeleton").alias("reference")
    )

    def align(cols: dict) -> dict:
        out = {"host": [], "shape": [], "node": [], "place": []}
        for host, shape, text, ref in zip(cols["host"], cols["shape"], cols["skeleton"], cols["reference"]):
            tree = read_skeleton(text)
            found = match_trees(tree, read_skeleton(ref))
            own = int(xxhash.xxh3_64_intdigest(text) % 2**40) << 20
            for node in range(len(tree[0])):
                out["host"].append(host)
                out["shape"].append(shape)
                out["node"].append(node)
                out["place"].append(found.get(node, -own - node - 1))
        return out

    return map_documents(
        shapes.join(reference, "host"),
        align,
        schema_of("host string, shape long, node int, place long"),
        ["host", "shape", "skeleton", "reference"],
        text_col="skeleton",
    )


def induce(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, shape, drop, menus, varying, constants): the skeleton nodes of
    each host that belong to the template or are menus, those that are menus,
    those known to vary, and the marks of the host's constant blocks in
    declared slots."""
    found = scratch.write(node_texts(pages), "block_texts")
    counts = scratch.write(
        found.where("content is null").groupBy("host", "shape", "node", "text_hash").agg(
            F.sum("pages").alias("pages"),
            F.sum("chars").alias("chars"),
            F.sum("links").alias("links"),
            F.min("skeleton").alias("skeleton"),
        ),
        "node_texts",
    )
    placed = scratch.write(_alignments(counts), "node_places")
    by_text = counts.join(placed, ["host", "shape", "node"]).groupBy("host", "place", "text_hash").agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("links").alias("links")
    )
    by_place = by_text.groupBy("host", "place").agg(
        F.sum("pages").alias("seen"), F.max("pages").alias("most"), F.sum("chars").alias("chars"), F.sum("links").alias("links")
    )
    constant = F.col("most") >= CONSTANT_SHARE * F.col("seen")
    menu = F.col("links") > LINK_SHARE * F.col("chars")
    kind = F.when(menu, "menu").when(F.col("seen") < LEAST_PAGES, None).when(constant, "constant").otherwise("varying")
    told = by_place.select("host", "place", kind.alias("kind")).where("kind is not null")
    among = lambda *kinds: F.collect_set(F.when(F.col("kind").isin(*kinds), F.col("node")))
    nodes = placed.join(told, ["host", "place"]).groupBy("host", "shape").agg(
        among("constant", "menu").alias("drop"), among("menu").alias("menus"), among("varying").alias("varying")
    )
    shapes = counts.where("node = -1").select("host", "shape").distinct()
    return shapes.join(nodes, ["host", "shape"], "left").join(_constant_blocks(found), "host", "left")


def _constant_blocks(found: DataFrame) -> DataFrame:
    """(host, constants): marks of the declared blocks that most different
    declared slots with their path hold (at most blocks of a page /
    ``CONSTANT_SHARE`` per path)."""
    blocks = found.where("content is not null").select("host", "path", "text_hash", "content").distinct()
    held = blocks.groupBy("host", "path", "text_hash").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES)
    slots = blocks.select("host", "path", "content").distinct().groupBy("host", "path").agg(F.count("*").alias("seen"))
    constant = held.join(slots, ["host", "path"]).where(F.col("n") >= CONSTANT_SHARE * F.col("seen"))
    return constant.groupBy("host").agg(F.collect_set("text_hash").alias("constants"))


BLOCKS = "array<struct<node:int,role:int,mark:bigint,links:int,chain:array<int>,comment:boolean,text:string>>"


def blocks_of(s: Skeleton) -> list[dict]:
    """The blocks of a page in order, without those excluded by tags: node,
    role, mark of a declared block, characters of links, the named nodes above
    and whether one of them is of comments."""
    marks = {k: mark for k, _, mark in s.marks()}
    chains = s.chains()
    return [
        {
            "node": node,
            "role": role,
            "mark": marks.get(k),
            "links": links,
            "chain": list(chains[node]),
            "comment": any(s.named[i] == 2 for i in chains[node]),
            "text": text,
        }
        for k, (_, node, role, text, links) in enumerate(s.blocks)
        if role != EXCLUDED
    ]


def page_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, shape, blocks) of each page."""
    schema = T.StructType(
        [pages.schema["page_id"], pages.schema["url"], *schema_of(f"host string, shape long, blocks {BLOCKS}")]
    )

    def run(cols: dict) -> dict:
        found = [skeleton(parse(source)) for source in cols["html"]]
        return {
            "page_id": cols["page_id"],
            "url": cols["url"],
            "host": [host_of(u) for u in cols["url"]],
            "shape": [_hash64(s.text) for s in found],
            "blocks": [blocks_of(s) for s in found],
        }

    return map_documents(pages, run, schema, ["page_id", "url", "html"], text_col="html")


def story_chain(blocks: list[dict]) -> set[int]:
    """The named nodes above the page's longest slot (a node's blocks)."""
    slots: dict[int, list] = {}
    for b in blocks:
        slot = slots.setdefault(b["node"], [0, b])
        slot[0] += len(b["text"])
    pool = [x for x in slots.values() if not x[1]["comment"]] or list(slots.values())
    # Beside a declared slot under no name, nothing named is the story.
    if any(x[1]["role"] == DECLARED and not x[1]["chain"] for x in pool):
        pool = [x for x in pool if x[1]["role"] == DECLARED]
    if not pool:
        return set()
    longest = max(pool, key=lambda x: x[0])  # the first of equal ones
    free = max((x for x in pool if not x[1]["chain"]), key=lambda x: x[0], default=None)
    if free is not None and 2 * free[0] >= longest[0]:
        longest = free
    return set(longest[1]["chain"])


def choose(blocks: list[dict], drop=(), menus=(), varying=(), constants=()) -> list[dict]:
    """The blocks of a page that are content, by the induced verdicts on its
    nodes (``drop``, ``menus``, ``varying``) and declared blocks
    (``constants``)."""

    def told(b: dict) -> bool:
        if b["role"] != DECLARED:
            return b["node"] not in drop
        return b["mark"] not in constants and not (b["node"] in menus and b["links"] > LINK_SHARE * len(b["text"]))

    kept = [b for b in blocks if told(b)]
    if not any(b["role"] == DECLARED for b in kept):
        # Declared slots of template blocks only are kept as they are.
        kept = [b for b in blocks if b["role"] == DECLARED or told(b)]
    story = story_chain(kept)
    kept = [b for b in kept if story.issuperset(b["chain"])]
    declared = sum(len(b["text"]) for b in kept if b["role"] == DECLARED)
    if not declared:
        return kept
    slots: Counter = Counter()
    for b in kept:
        slots[b["node"]] += len(b["text"])
    long = min(LONG_SLOT, declared + 1)
    return [b for b in kept if b["role"] == DECLARED or (b["node"] in varying and slots[b["node"]] >= long)]


def page_text(source: str | None, **verdicts) -> str:
    """Main text of one page."""
    return "\n".join(b["text"] for b in choose(blocks_of(skeleton(parse(source))), **verdicts))


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages``."""
    scratch = Scratch(pages.sparkSession)
    wrappers = write_and_read(induce(pages, scratch), "wrappers")
    scratch.drop()
    joined = page_blocks(pages).join(wrappers, ["host", "shape"], "left")
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])
    verdicts = ("drop", "menus", "varying", "constants")

    def run(cols: dict) -> dict:
        texts = []
        for blocks, *sets in zip(cols["blocks"], *(cols[v] for v in verdicts)):
            kept = choose(blocks, *(frozenset(x or ()) for x in sets))
            texts.append("\n".join(b["text"] for b in kept))
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts}

    sized = joined.withColumn("held", F.array_join(F.col("blocks.text"), ""))
    return map_documents(sized, run, schema, ["page_id", "url", "blocks", *verdicts, "held"], text_col="held")

"""Main text of web pages by a graphical model on the element tree.

Every element that is not plain inline markup is a node with two states, content or boilerplate.
A node has a potential from its features (tag, words of its class, id and role, size and link share
of its own text) and one with its parent. Messages passed up from the leaves and down from the root
(sum-product, exact on a tree) give each node's marginal; the text that a node holds itself is
content if its marginal says so, and comes out block by block in page order.

The weights are fitted by gradient ascent on the likelihood of labelled pages, drawn towards priors
that know the usual names of page furniture, so that names the sample lacks still count. Pages label
themselves where their markup names the article. Where hardly a page of the sample does, the article
is the smallest element with most of the page's plain text (outside links and furniture).
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.session import ship
from riskloom.llm.carry import distinct_draws, free_name

# Bounds of the training sample.
SAMPLE_PAGES = 150
SAMPLE_BYTES = 60_000
# With fewer pages that name their article, the others are labelled by where their text lies.
NAMED_PAGES = 20
# Share of an element's plain text that a child must hold to be entered.
MOST = 0.7
ROUNDS = 25
# Output rows are handed on in batches of about this many bytes.
OUT_BYTES = 4 << 20

# Element names of HTML.
# Raw elements that swallow the rest of the page if they are never closed.
GREEDY = frozenset("script style title textarea iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg math object select datalist canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Names of page furniture and of main text, as tags and as words of class, id or role.
FURNITURE_TAGS = frozenset("head nav header footer aside form button menu dialog search".split())
FURNITURE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising aside banner breadcrumb breadcrumbs byline comment comments contentinfo cookie cookies consent "
    "disclaimer discussion disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup "
    "promo promoted recommended related replies reply respond responses search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe "
    "tags toc toolbar topbar widget widgets alert toast warning".split()
)
# Those that no page wraps around its article.
SURE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising breadcrumb breadcrumbs comment comments contentinfo cookie cookies consent disclaimer discussion "
    "disqus footer form login menu navbar newsletter pager pagination popup promo promoted related replies respond responses sharing sponsor sponsored subscribe".split()
)
WHOLE_PAGE = frozenset("html body article main".split())
CONTENT_TAGS = frozenset("article main".split())
CONTENT_WORDS = frozenset("article body content entry main post story text".split())

# A value in quotes may hold brackets; a quote that never closes is part of a bare value.
_ATTRS = r"""(?:[^>=]++|=\s*+(?>"[^"]*+"|'[^']*+'|[^\s>]*+))*+"""
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>" + _ATTRS + r")>|<[!?][^>]*>", re.S)
_CUT = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
_ATTR = re.compile(r"""([^\s/>=]++)\s*+(?:=\s*+(?>"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_NAMING = frozenset("class id role".split())
_WORD = re.compile(r"[a-z]+")


class Node:
    """An element of the tree, with the pieces of text it holds itself."""

    __slots__ = ("tag", "words", "parent", "children", "blocks", "size", "linked", "furniture", "main")

    def __init__(self, tag: str, words: frozenset[str], parent: int) -> None:
        self.tag, self.words, self.parent = tag, words, parent
        self.children: list[int] = []
        self.blocks: list[int] = []
        self.size = self.linked = 0
        self.furniture = tag in FURNITURE_TAGS or not FURNITURE_WORDS.isdisjoint(words)
        self.main = tag in CONTENT_TAGS


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order (parents first) and blocks as (node, text).

    Raw and hidden elements are left out with all they hold. An end tag without a start is ignored,
    elements still open at the end are closed there, and a cut-off tag at the very end is dropped.
    The work is linear in the page but for its depth.
    """
    nodes = [Node("html", frozenset(), -1)]
    blocks: list[tuple[int, list[str]]] = []
    # The open elements as (tag, node), and how many of each tag; inline markup has the node around it.
    stack: list[tuple[str, int]] = [("html", 0)]
    count: dict[str, int] = defaultdict(int)
    fresh = True  # the next text begins a block
    unclosed: set[str] = set()  # raw elements known to have no end tag further on
    at, size = 0, len(page)

    def text(upto: int) -> None:
        nonlocal fresh
        raw = page[at:upto]
        if not raw:
            return
        own = html.unescape(raw) if "&" in raw else raw
        node = stack[-1][1]
        if fresh or not blocks or blocks[-1][0] != node:
            if not own.strip():
                return
            nodes[node].blocks.append(len(blocks))
            blocks.append((node, []))
            fresh = False
        blocks[-1][1].append(own)
        length = len(own.strip())
        nodes[node].size += length
        if count["a"]:
            nodes[node].linked += length

    def close(depth: int) -> None:
        nonlocal fresh
        while len(stack) > depth:
            tag, node = stack.pop()
            count[tag] -= 1
            fresh = fresh or node != stack[-1][1]

    def close_open(name: str, through: frozenset[str]) -> None:
        """Close the innermost open ``name``, if only tags of ``through`` stand above it."""
        if count[name]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if through and stack[depth][0] not in through:
                    break

    # Nothing is a tag behind the last closing bracket, so no search runs to the end in vain.
    last = page.rfind(">") + 1
    position = 0
    while m := _TOKEN.search(page, position, last):
        text(m.start())
        at = position = m.end()
        name = m["name"]
        if name is None:
            if page.startswith("<!--", m.start()) and not m[0].endswith("-->"):
                at = size
                break
            continue
        name = name.lower()
        if m["end"]:
            # Inline markup does not close the blocks around it.
            close_open(name, INLINE if name in INLINE else frozenset())
            continue
        attrs = m["attrs"]
        if name in RAW:
            closing = None
            if name not in unclosed:
                closing = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at, last)
                if closing is None:
                    unclosed.add(name)
            if closing or name in GREEDY:
                at = position = closing.end() if closing else size
            if at == size:
                break
            continue
        if name == "br":
            if blocks and not fresh:
                blocks[-1][1].append(" ")
            continue
        if name in VOID:
            fresh = fresh or name == "hr"
            continue
        if name in CLOSES_P or name == "body":
            close_open("p", INLINE)
            close_open("head", frozenset())
        if name in SIBLINGS:
            ends, scope = SIBLINGS[name]
            depth = len(stack) - 1
            lowest = 0
            while depth > 0 and stack[depth][0] not in scope and any(count[t] for t in ends):
                lowest = depth if stack[depth][0] in ends else lowest
                depth -= 1
            if lowest:
                close(lowest)
        if name == "a":
            close_open("a", frozenset())
        words: frozenset[str] = frozenset()
        if "=" in attrs and name not in WHOLE_PAGE:
            words = frozenset(w for n, *v in _ATTR.findall(attrs) if n.lower() in _NAMING for w in _WORD.findall("".join(v).lower()))
        node = stack[-1][1]
        if name not in INLINE or not FURNITURE_WORDS.isdisjoint(words):
            nodes.append(Node(name, words, node))
            nodes[node].children.append(len(nodes) - 1)
            node = len(nodes) - 1
            fresh = True
        stack.append((name, node))
        count[name] += 1
    if at < size:
        cut = _CUT.search(page, at)
        text(cut.start() if cut else size)
    return nodes, [(n, " ".join("".join(parts).split())) for n, parts in blocks]


def features(node: Node, parent: Node | None) -> list[str]:
    """Names of a node's features."""
    found = [f"tag {node.tag}", *(f"word {w}" for w in node.words)]
    if parent is not None:
        found.append(f"under {parent.tag}")
    if not node.size:
        found.append("no text")
    else:
        share = node.linked / node.size
        found.append(f"size {min(9, int(log(node.size, 2)))}")
        found.append("links " + ("none" if not share else "few" if share < 0.34 else "half" if share < 0.8 else "all"))
    return found


def prior(feature: str) -> float:
    """What is expected of a feature's weight before any page was seen (positive: content)."""
    kind, _, name = feature.partition(" ")
    if kind == "tag":
        return -25.0 if name in FURNITURE_TAGS else 3.0 if name in CONTENT_TAGS else 0.0
    if kind == "word":
        return -100.0 if name in SURE_WORDS else -25.0 if name in FURNITURE_WORDS else 1.0 if name in CONTENT_WORDS else 0.0
    return {"links all": -1.5, "links half": -0.5}.get(feature, 0.0)


# Log-potentials of (parent, child): a child of boilerplate is next to never content.
PAIR_PRIOR = ((0.0, -14.0), (-1.0, 0.0))


class TreeModel:
    """Feature weights and parent-child potentials; marginals by sum-product messages."""

    def __init__(self) -> None:
        self.weights: dict[str, float] = {}
        self.pair = [list(r) for r in PAIR_PRIOR]

    def unary(self, nodes: list[Node]) -> list[float]:
        get = self.weights.get
        out = []
        for n in nodes:
            total = 0.0
            for f in features(n, nodes[n.parent] if n.parent >= 0 else None):
                w = get(f)
                total += prior(f) if w is None else w
            out.append(max(-120.0, min(120.0, total)))
        return out

    def marginals(self, nodes: list[Node]) -> tuple[list[float], list[list[float]]]:
        """Probability of content for each node, and expected counts of parent-child states."""
        n = len(nodes)
        score = self.unary(nodes)
        pair = [[exp(x) for x in r] for r in self.pair]
        # Belief from below, scaled to a sum of one; nodes come parents first.
        up = [[1.0, exp(s)] for s in score]
        sent: list[tuple[float, float]] = [(1.0, 1.0)] * n
        for i in range(n - 1, -1, -1):
            b, c = up[i]
            total = b + c
            up[i] = [b / total, c / total]
            if i:
                b, c = up[i]
                to = (pair[0][0] * b + pair[0][1] * c, pair[1][0] * b + pair[1][1] * c)
                sent[i] = to
                above = up[nodes[i].parent]
                above[0] *= to[0]
                above[1] *= to[1]
                if above[0] + above[1] < 1e-200:
                    above[0] *= 1e200
                    above[1] *= 1e200
        expected = [[0.0, 0.0], [0.0, 0.0]]
        belief = [0.0] * n
        belief[0] = up[0][1]
        for i in range(1, n):
            # The parent's belief without what this node had sent, times the node's own.
            p = belief[nodes[i].parent]
            rest = ((1.0 - p) / sent[i][0], p / sent[i][1])
            joint = [[rest[x] * pair[x][y] * up[i][y] for y in (0, 1)] for x in (0, 1)]
            total = sum(map(sum, joint)) or 1.0
            for x in (0, 1):
                for y in (0, 1):
                    expected[x][y] += joint[x][y] / total
            belief[i] = (joint[0][1] + joint[1][1]) / total
        return belief, expected

    def text(self, page: str | None) -> str:
        """The blocks of content nodes, joined by an empty line."""
        if not page:
            return ""
        nodes, blocks = parse(page)
        belief, _ = self.marginals(nodes)
        return "\n\n".join(t for n, t in blocks if t and belief[n] >= 0.5)


def densest(nodes: list[Node]) -> int | None:
    """The smallest element with most of the page's plain text; none if there is no plain text."""
    barred = [False] * len(nodes)
    plain = [0] * len(nodes)
    for i, n in enumerate(nodes):
        barred[i] = n.furniture or (n.parent >= 0 and barred[n.parent])
        plain[i] = 0 if barred[i] else n.size - n.linked
    for i in range(len(nodes) - 1, 0, -1):
        plain[nodes[i].parent] += plain[i]
    if not plain[0]:
        return None
    at = 0
    while nodes[at].children:
        child = max(nodes[at].children, key=plain.__getitem__)
        # A paragraph among others is not entered, nor one that stands alone in its element.
        if plain[child] < MOST * plain[at] or not nodes[child].children:
            break
        at = child
    return at


def labelled(nodes: list[Node], article: int | None = None) -> list[int] | None:
    """States of a page whose markup names its article; none if it names none or holds no text in it.

    ``article`` is the element to take instead of those that the markup names.

    Furniture is boilerplate with all it holds. Other nodes are content if they or nodes below them
    hold text inside the article.
    """
    inside = [False] * len(nodes)
    barred = [False] * len(nodes)
    for i, n in enumerate(nodes):
        inside[i] = (n.main if article is None else i == article) or (n.parent >= 0 and inside[n.parent])
        barred[i] = (n.furniture and not n.main) or (n.parent >= 0 and barred[n.parent])
    state = [int(inside[i] and not barred[i] and n.size > 0) for i, n in enumerate(nodes)]
    if not any(state):
        return None
    for i in range(len(nodes) - 1, 0, -1):
        if state[i]:
            state[nodes[i].parent] = 1
    # A wrapper that only holds the article is content; text beside the article is not.
    for i, n in enumerate(nodes):
        if n.size and not (inside[i] and not barred[i]) and not any(state[c] for c in n.children):
            state[i] = 0
    return state


def train(pages: list[str], rounds: int = ROUNDS, rate: float = 0.05, pull: float = 0.02) -> TreeModel:
    """Fit weights and potentials to labelled pages by gradient ascent from the priors."""
    model = TreeModel()
    trees = [parse(page)[0] for page in pages]
    states = [labelled(nodes) for nodes in trees]
    if sum(s is not None for s in states) < NAMED_PAGES:
        found = [densest(nodes) if s is None else None for nodes, s in zip(trees, states)]
        states = [s if a is None else labelled(nodes, a) for nodes, s, a in zip(trees, states, found)]
    examples = [(nodes, state) for nodes, state in zip(trees, states) if state is not None]
    for _ in range(rounds if examples else 0):
        for nodes, state in examples:
            belief, expected = model.marginals(nodes)
            step: dict[str, float] = defaultdict(float)
            for i, n in enumerate(nodes):
                gap = state[i] - belief[i]
                if abs(gap) > 1e-3:
                    for f in features(n, nodes[n.parent] if n.parent >= 0 else None):
                        step[f] += gap
            for f, g in step.items():
                w = model.weights.get(f, prior(f))
                model.weights[f] = w + rate * (max(-3.0, min(3.0, g)) - pull * (w - prior(f)))
            seen = [[0, 0], [0, 0]]
            for i in range(1, len(nodes)):
                seen[state[nodes[i].parent]][state[i]] += 1
            for x in (0, 1):
                for y in (0, 1):
                    g = max(-3.0, min(3.0, seen[x][y] - expected[x][y]))
                    model.pair[x][y] += rate * (g - pull * (model.pair[x][y] - PAIR_PRIOR[x][y]))
    return model


def fit_page_model(df: DataFrame, page: str = "html", key: str = "page_id", sample: int = SAMPLE_PAGES) -> TreeModel:
    """Train on at most ``sample`` pages chosen by a hash of key and page; pages over ``SAMPLE_BYTES`` are not.

    Rows equal in both are drawn once. One count of all rows sets the sampling rate; the sample itself
    is all that is collected.
    """
    usable = df.where(F.octet_length(df[page]) <= SAMPLE_BYTES)
    count = usable.count()
    if not count:
        return TreeModel()
    rate = min(1.0, 1.3 * sample / count)
    given = usable.select(df[page].cast("string").alias("page"), F.xxhash64(df[key].cast("string"), df[page], F.lit("page")).alias("h"))
    rows = distinct_draws(given.where(F.pmod("h", F.lit(1 << 24)) < int(rate * (1 << 24))), F.col("h"), sample).collect()
    return train([r["page"] for r in sorted(rows, key=lambda r: (r["h"], r["page"]))])


def _extractor(model, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: TreeModel = model.value
        for batch in batches:
            pages = batch.column(batch.num_columns - 1)
            at = 0
            while at < batch.num_rows:
                begin, size, texts = at, 0, []
                while at < batch.num_rows and size < OUT_BYTES:
                    texts.append(fitted.text(pages[at].as_py()))
                    size += len(texts[-1])
                    at += 1
                keep = batch.slice(begin, at - begin).columns[:-1]
                columns = [*[c.cast(f.type) for c, f in zip(keep, schema)], pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def extract_text(df: DataFrame, model: TreeModel, page: str = "html", column: str = "text") -> DataFrame:
    """``df`` without ``page`` and with its main text in ``column`` (replaced if there already).

    A null or empty page, or one without content, has an empty text. Rows are kept as they are,
    equal rows alike; nothing is shuffled.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    ship(spark)
    names = [c for c in df.columns if c not in (page, column)]
    out = T.StructType([df.schema[c] for c in names]).add(column, "string")
    given = df.select(*[df[c] for c in names], df[page].cast("string").alias(free_name(df, "_page")))
    # The model has one weight per feature name of the bounded sample.
    return given.mapInArrow(_extractor(spark.sparkContext.broadcast(model), to_arrow_schema(out)), out)

"""Main-text extraction by minimum-cut labelling of a page's blocks.

A page is read once into blocks: the text between two block-level tags, with its
ancestors. A logistic classifier over the shape of a block (length, links,
punctuation, ...) and the hints of its ancestors (tags, words in class and id)
gives the two terminal capacities: what it costs to call the block content, or
boilerplate. Neighbours in the page and consecutive blocks of one parent are
joined by smoothness edges, stronger the closer the blocks are in the DOM and weaker
where their hints differ; a heading holds to what follows it twice as fast. The edges'
scale is a usual cost of shape.
The minimum cut is the cheapest labelling; the source side is the article.

A block whose preference outweighs all its edges is decided before the flow (an
exact reduction: its label is the same in some minimum cut), so max-flow runs on
the undecided remainder only.

The classifier is fitted on a bounded sample: about ``SAMPLE`` pages, those whose hash of
``page_id`` falls in their share, and at most ``PER_PAGE`` labelled blocks of each. Labels come
from what it does not see, the tree: the element with most unlinked text in its own
children holds the article; those children are content, blocks outside of it boilerplate,
and blocks deeper inside have no label. Each block is learnt from three times: whole, without
its hints, and without hints and tag, so that pages of plain divisions are told by their text.
A boilerplate hint weighs its log odds among the labelled blocks (half a block added to each).

Defined cases: null, empty or text-free html gives an empty text; tags left open,
stray end tags and pages cut off inside a tag are read as far as they go; repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import texts_of, text_runs

SAMPLE = 400
PER_PAGE = 200
BATCH_BYTES = 4 << 20

# Element names by their role, and words in class or id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li "
    "main menu nav noscript ol option p pre section select summary table tbody td textarea tfoot "
    "th thead title tr ul".split())
CLOSES_P = BLOCK - {"button", "option", "iframe"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPE = frozenset("article aside body div dl footer form header main nav ol section table td th "
                  "ul".split())
HIDDEN = frozenset("head title script style template noscript svg iframe object".split())
BOILER_TAGS = frozenset("nav footer aside form button select menu dialog textarea".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer"
    r"|header|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|pager|pagination|"
    r"popup|promo\w*|recommend\w*|related|replies|reply|respond|search|share|sharing|sidebar|"
    r"signup|skip|social|sponsor\w*|subscribe|teaser|toolbar|widget)(?=$|[\s_-])", re.I)
CONTENT_WORDS = re.compile(
    r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?=$|[\s_-])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript|svg|iframe|object)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S | re.I)
ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SHAPE, FEATURES = 10, 12
TAGS = slice(4, 7)
#: The strongest smoothness edge, as a share of the mean cost of the sampled blocks, and what
#: a change of hints adds to the distance of two blocks.
SMOOTH = 1.0
CROSS = 4.0
#: (weights, strongest edge) where nothing can be learnt.
DEFAULT = (np.array([-2.0, 2.0, -4.0, 2.0, 1.0, 1.0, -1.0, 0.5, -1.0, -0.5, -6.0, 3.0]), 2.0)


class Block:
    """Text between two block-level tags; ``path`` numbers its open elements and ``parent``
    is the element around its block-level one."""

    __slots__ = ("text", "tag", "path", "parent", "boiler", "content", "link", "raw")

    def __init__(self, tag, path, parent, boiler, content):
        self.tag, self.path, self.parent, self.boiler, self.content = (
            tag, path, parent, boiler, content)
        self.raw, self.link, self.text = [], 0, ""


def blocks_of(page: str) -> list[Block]:
    """The non-empty blocks of a page in order."""
    out: list[Block] = []
    # One entry per open element: tag, number, boilerplate hint, content hint, hidden.
    stack = [("", 0, False, False, False)]
    links, serial, current = 0, 0, None

    def add(text, link):
        nonlocal current
        if stack[-1][4]:
            return
        if current is None:
            own = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in BLOCK), 0)
            current = Block(stack[own][0], tuple(e[1] for e in stack), stack[max(own - 1, 0)][1],
                            stack[-1][2], stack[-1][3])
            out.append(current)
        current.raw.append(text)
        if link:
            current.link += len(text.strip())

    def pop_to(tags, scope=frozenset()):
        nonlocal links, current
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                links -= sum(e[0] == "a" for e in stack[i:])
                if any(e[0] in BLOCK for e in stack[i:]):
                    current = None
                del stack[i:]
                return
            if stack[i][0] in scope:
                return

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()], links > 0)
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            continue
        if m[2] or m[5]:
            if name in BLOCK:
                current = None
            pop_to({name}, SCOPE if name == "p" else frozenset())
            continue
        if name in BLOCK:
            current = None
            if name in CLOSES_P:
                pop_to({"p"}, SCOPE)
            if name in SIBLINGS:
                pop_to(SIBLINGS[name], SCOPE - SIBLINGS[name])
            if name == "body":
                pop_to({"head"})
        if name == "br":
            add(" ", False)
        if name in VOID:
            continue
        serial += 1
        links += name == "a"
        _, _, boiler, content, hidden = stack[-1]
        attrs = " ".join(a or b or c for a, b, c in ATTR.findall(m[4] or m[7] or ""))
        if name not in ("html", "body"):
            boiler = (boiler or name in BOILER_TAGS or (name == "header" and not content)
                      or bool(attrs and BOILER_WORDS.search(attrs)))
        content = content or name in CONTENT_TAGS or bool(attrs and CONTENT_WORDS.search(attrs))
        stack.append((name, serial, boiler, content, hidden or name in HIDDEN))
    add(page[at:], links > 0)
    for b in out:
        b.text = " ".join(html.unescape("".join(b.raw)).split())
    return [b for b in out if b.text]


def features(blocks: list[Block]) -> np.ndarray:
    """Shape of each block (length, links, punctuation, case, digits, kind of tag), then its
    hints: boilerplate, content and nothing of boilerplate."""
    rows = np.empty((len(blocks), FEATURES))
    for i, b in enumerate(blocks):
        t = b.text
        n = len(t)
        words = t.count(" ") + 1
        rows[i] = (1.0, min(np.log1p(words), 6) / 3, min(1.0, b.link / n),
                   min(1.0, 10 * sum(map(t.count, ".,;!?")) / n), b.tag[:1] == "h" and
                   b.tag[1:].isdigit(), b.tag in ("p", "blockquote", "pre"), b.tag == "li",
                   t[-1] in ".!?:\"'”", any(c in t for c in "©|»·"),
                   min(1.0, 5 * sum(c.isdigit() for c in t[:200]) / min(n, 200)),
                   b.boiler, b.content and not b.boiler)
    return rows


def labels(blocks: list[Block]) -> dict[int, bool]:
    """Blocks told by the tree alone: the children, of their commonest tag, of the element with
    most unlinked text of its own (the first such) are content, all outside of it is not."""
    mass: dict[int, dict[str, int]] = {}
    for b in blocks:
        of = mass.setdefault(b.parent, {})
        of[b.tag] = of.get(b.tag, 0) + max(len(b.text) - b.link, 0)
    if not mass:
        return {}
    main = max(mass, key=lambda e: sum(mass[e].values()))
    tag = max(mass[main], key=mass[main].get)
    return {i: b.parent == main for i, b in enumerate(blocks)
            if main not in b.path or (b.parent == main and b.tag == tag)}


def fit(pages: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Logistic weights and the strongest edge, from the labelled blocks of the sampled pages.
    Without both labels: ``DEFAULT``."""
    total = pages.where(F.col("page_id").isNotNull()).count()
    share = min(1.0, sample / max(total, 1))
    place = F.pmod(F.xxhash64("page_id"), F.lit(1 << 30)) / float(1 << 30)

    def run(batches):
        for batch in text_runs(batches, "html", BATCH_BYTES):
            for page in texts_of(batch.column(0)):
                blocks = blocks_of(page)
                told = labels(blocks)
                keys = list(told)
                if len(keys) > PER_PAGE:
                    keys = [keys[i * len(keys) // PER_PAGE] for i in range(PER_PAGE)]
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(features([blocks[i] for i in keys]).tolist(),
                                  pa.list_(pa.float64())),
                         pa.array([float(told[i]) for i in keys])], names=["x", "y"])

    got = pages.where(place < share).select("html").mapInArrow(
        run, "x array<double>, y double").toArrow()
    y = got.column("y").to_numpy()
    if len(y) == 0 or y.min() == y.max():
        return DEFAULT
    x = np.array(got.column("x").to_pylist())
    told = [(x[y == k, SHAPE].sum() + 0.5) / ((y == k).sum() + 1) for k in (0, 1)]
    x[:, SHAPE] = 0
    plain = x.copy()
    plain[:, SHAPE:] = 0
    bare = plain.copy()
    bare[:, TAGS] = 0
    x, y = np.concatenate([x, plain, bare]), np.concatenate([y, y, y])
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(FEATURES)
    for _ in range(1000):  # ridge keeps the weights small where the classes are separable
        p = 1 / (1 + np.exp(-x @ w))
        w -= 1.0 * ((x.T @ (weight * (p - y))) / len(y) + 0.001 * w)
    strongest = float(SMOOTH * np.abs(x @ w).mean())
    w[SHAPE] = np.log(told[1] / told[0])
    return w, strongest


def smoothness(blocks: list[Block], strongest: float) -> dict[tuple[int, int], float]:
    """Edges between page neighbours and between consecutive blocks of one parent."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}

    def join(i, j):
        p, q = blocks[i].path, blocks[j].path
        same = 0
        for a, b in zip(p, q):
            if a != b:
                break
            same += 1
        unlike = (blocks[i].boiler, blocks[i].content) != (blocks[j].boiler, blocks[j].content)
        heading = blocks[i].tag[:1] == "h" and blocks[i].tag[1:].isdigit()
        edges[i, j] = (1 + heading) * strongest / (1 + (len(p) + len(q) - 2 * same) / 2 + CROSS * unlike)

    for i, b in enumerate(blocks):
        if i:
            join(i - 1, i)
        if b.parent in last and last[b.parent] < i - 1:
            join(last[b.parent], i)
        last[b.parent] = i
    return edges


def min_cut(gain: np.ndarray, edges: dict[tuple[int, int], float]) -> np.ndarray:
    """Labels that minimise (cost of labels + weight of cut edges); ``gain`` is the cost
    of calling a block boilerplate less that of calling it content."""
    return cut(gain, edges)[0]


def cut(gain: np.ndarray, edges: dict[tuple[int, int], float]) -> tuple[np.ndarray, int]:
    """(labels of the minimum cut, number of blocks that went into the flow)."""
    n = len(gain)
    label = np.full(n, -1)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0) + w
        near[j][i] = near[j].get(i, 0) + w
    gain = gain.astype(float).tolist()
    todo = deque(range(n))
    while todo:  # decided blocks hand their edges to their neighbours' terminals
        i = todo.popleft()
        if label[i] >= 0 or abs(gain[i]) < sum(near[i].values()) or (
                gain[i] == 0 and near[i]):
            continue
        label[i] = gain[i] > 0
        for j, w in near[i].items():
            del near[j][i]
            gain[j] += w if label[i] else -w
            todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] < 0]
    if rest:
        side = max_flow(rest, gain, near)
        for i in rest:
            label[i] = i in side
    return label == 1, len(rest)


def max_flow(nodes: list[int], gain: list[float], near: list[dict[int, float]]) -> set[int]:
    """Source side of a minimum cut (shortest augmenting paths, breadth first)."""
    source, sink, eps = -1, -2, 1e-9
    cap: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in nodes:
        cap[i] = dict(near[i])
    for i in nodes:
        if gain[i] > 0:
            cap[source][i] = gain[i]
            cap[i][source] = 0.0
        elif gain[i] < 0:
            cap[i][sink] = -gain[i]
            cap[sink][i] = 0.0
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > eps and v not in came:
                    came[v] = u
                    queue.append(v)
        if sink not in came:
            return set(came) - {source}
        path, v = [], sink
        while v != source:
            path.append((came[v], v))
            v = came[v]
        push = min(cap[u][v] for u, v in path)
        for u, v in path:
            cap[u][v] -= push
            cap[v][u] = cap[v].get(u, 0.0) + push


def main_blocks(page: str, costs: tuple[np.ndarray, float]) -> tuple[str, int, int, int, int]:
    """(the content blocks of a page, one a line; blocks; those whose own cost does not outweigh
    their edges; those left to the flow; those whose label is not the one their cost prefers)."""
    blocks = blocks_of(page)
    if not blocks:
        return "", 0, 0, 0, 0
    weights, strongest = costs
    gain = features(blocks) @ weights
    edges = smoothness(blocks, strongest)
    held = np.zeros(len(blocks))
    for (i, j), w in edges.items():
        held[i] += w
        held[j] += w
    keep, flowed = cut(gain, edges)
    return ("\n".join(b.text for b, k in zip(blocks, keep) if k), len(blocks),
            int((np.abs(gain) < held).sum()), flowed, int((keep != (gain > 0)).sum()))


def main_text(page: str, costs: tuple[np.ndarray, float] = DEFAULT) -> str:
    """The content blocks of a page, one a line."""
    return main_blocks(page, costs)[0]


def extract(pages: DataFrame, costs: tuple[np.ndarray, float] | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars, n_blocks, n_open, n_flow, n_changed)`` of every page."""
    costs = fit(pages) if costs is None else costs

    def run(batches):
        for batch in text_runs(batches, "html", BATCH_BYTES):
            found = [main_blocks(p, costs) for p in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([len(f[0]) for f in found], pa.int64()),
                 *(pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 3, 4))],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_open", "n_flow",
                       "n_changed"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long, n_blocks long, "
        "n_open long, n_flow long, n_changed long")

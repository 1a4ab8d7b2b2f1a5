"""Problem 7: markup left in pages (HTML, Markdown, wiki, LaTeX), found and turned into clean text.

A page is read as a tree: the page is the root, elements, spans and lone signs that look like the beginning of one are
nodes, nested as they stand.  Each node is `markup` or `text that looks like it`.  All potentials are learned from labelled
pages, those of which raw_text and clean_ocr are known: unary ones from how often a construct of that type disappeared
between the two, parent-child ones from how often nested constructs (and the constructs of one page, through the root) went
together.  Sum-product messages, upward then downward, give exact marginals, and these decide.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, written

#: Labelled pages that the potentials are fitted on, at most, out of so many times as many pages looked at.
FIT_PAGES, LOOKED_AT = 5_000, 4
#: Constructs of all types that a type's own share is drawn towards, as if so many of it had been seen.
POOLED = 8.0
#: Bounds of a learned unary probability, and the most that one neighbour may add to a node's odds.
SURE, TIE_MOST = 0.98, 3.0

#: HTML elements, and those of them without an end tag.
ELEMENTS = frozenset(
    "a abbr address article aside audio b base big blockquote body br button caption center cite code col colgroup dd del details dfn dir div dl dt em figcaption figure font footer form frame h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark menu meta nav noscript object ol option p pre q s samp script section select small span strike strong style sub summary sup table tbody td textarea tfoot th thead time title tr tt u ul var video".split()
)
VOID = frozenset("base br col frame hr img input link meta".split())

#: What a construct or a lone sign begins with, in Java's and Python's regular expressions alike.  A text is parsed from
#: these places only, so a text without one of them holds no node, and the test costs no construct.
SUSPECT = r"[<&`*_~|#>{=\\$\[]|!\[|[-+] \[|''"
#: What closes an open element of the same name, if that is the innermost one.
IMPLIED = frozenset("p li td th tr dt dd option".split())
#: Lone signs that are nodes where no construct begins.
SIGNS = {"<": "html", "&": "html", "#": "markdown", "*": "markdown", "_": "markdown", ">": "markdown", "[": "wiki", "$": "latex"}

TOKENS = re.compile(
    r"""(?P<comment><!--.*?-->)
    |(?P<tag></?[A-Za-z][A-Za-z0-9]*(?:\s+[\w:-]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+))?)*\s*/?>)
    |(?P<entity>&(?:[A-Za-z]{2,8}[0-9]?|\#\d{1,6}|\#x[0-9a-fA-F]{1,6});)
    |(?P<fence>(?:```|~~~)[\s\S]*?(?:```|~~~))
    |(?P<code>``[^`]+``|`[^`\n]+`)
    |(?P<image>!\[[^\]\n]*\]\([^)\n]*\))
    |(?P<link>\[[^\]\n]+\]\([^)\n]+\))
    |(?P<strong>\*\*[^*\n]+(?:\n[^*\n]+)?\*\*|(?<![\w])__(?=\S)[^_\n]+(?:\n[^_\n]+)?__(?!\w)|(?<!\w)__\s[^_\n]+\s__(?!\w))
    |(?P<strike>~~[^~\n]+~~)
    |(?P<emphasis>(?<![\w*])\*[A-Za-z][^*\n]*[A-Za-z.]\*(?![\w*])|(?<![\w_])_[A-Za-z][^_\n]*[A-Za-z.]_(?![\w_]))
    |(?P<mdrule>\|\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)*\|)
    |(?P<heading>(?:(?<=\n)|(?<=\s)|^)\#{1,6}[ ]+(?=[A-Za-z]))
    |(?P<quote>(?:(?<=\n)|(?<=[.:!?>][ ])|^)>[ ]+(?=[A-Za-z]))
    |(?P<task>(?:(?<=\s)|^)[-*+][ ]\[[ xX]\][ ])
    |(?P<wtable>\{\|[\s\S]*?\|\})
    |(?P<template>\{\{[^{}]*\}\})
    |(?P<wlink>\[\[[^\[\]\n]+\]\])
    |(?P<wheading>(?:(?<=\s)|^)(?P<eq>={2,6})[ ]*[^=\n]+?[ ]*(?P=eq)(?=\s|$))
    |(?P<setext>(?:(?<=\n)|(?<=[ ])|^)={4,}(?=\s|$))
    |(?P<wstrong>'''[^'\n]+'''|(?<!')''[^'\n]+''(?!'))
    |(?P<env>\\(?:begin|end)\{\w+\*?\})
    |(?P<command>\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})+|\\(?:item|times|alpha|beta|mu|pm|leq|geq|frac|cdot|degree|par|noindent|hline|newline|ldots|sim|approx|rightarrow|section|textbf|emph)(?![A-Za-z]))
    |(?P<math>\$(?=[^$\n]*[\\^_{])[^$\n]+\$|\\\([^\n]*?\\\)|\\\[[\s\S]*?\\\])""",
    re.X,
)
DIALECT = {
    "comment": "html", "tag": "html", "entity": "html", "fence": "markdown", "code": "markdown", "image": "markdown", "link": "markdown", "strong": "markdown",
    "strike": "markdown", "emphasis": "markdown", "mdrule": "markdown", "heading": "markdown", "quote": "markdown", "task": "markdown", "setext": "markdown",
    "wtable": "wiki", "template": "wiki", "wlink": "wiki", "wheading": "wiki", "wstrong": "wiki", "env": "latex", "command": "latex", "math": "latex",
}
#: Spans whose inside is read for further constructs.
OPEN = frozenset(["strong", "strike", "emphasis", "wtable", "wheading", "link"])
TAG_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9]*)")
SUSPECTED = re.compile(SUSPECT)


class Node:
    __slots__ = ("start", "end", "kind", "type", "children", "marginal", "inner", "close", "source")

    def __init__(self, start: int, end: int, kind: str, type_: str, source: str = ""):
        self.start, self.end, self.kind, self.type, self.source = start, end, kind, type_, source
        self.children: list[Node] = []
        self.marginal, self.inner, self.close = 0.5, end, end

    def all(self) -> list[Node]:
        """The nodes below this one, parents before children."""
        found = list(self.children)
        for node in found:
            found.extend(node.children)
        return found


def dialect(node: Node) -> str | None:
    return SIGNS[node.source] if node.kind == "sign" else DIALECT.get(node.kind)


def parse(text: str) -> Node:
    """The tree of a page.  An end tag closes the nearest open element of its name; what stays open holds nothing."""
    root = Node(0, len(text), "page", "page")
    spans = [(root, 0, len(text))]
    for node, start, end in spans:
        spans += _parse(text, start, end, node)
    return root


def _sign(text: str, at: int) -> str:
    """The type of a lone sign: what it is, and the sort of character beside it."""
    beside = ["^" if not 0 <= k < len(text) else "a" if text[k].isalpha() else "0" if text[k].isdigit() else " " if text[k] in " \t\xa0" else "n" if text[k] == "\n" else "." for k in (at - 1, at + 1)]
    return f"sign {beside[0]}{text[at]}{beside[1]}"


def _parse(text: str, start: int, end: int, parent: Node) -> list[tuple[Node, int, int]]:
    """Adds the nodes of a stretch of text and returns the spans within which further ones may stand."""
    stack, inside, at = [parent], [], start

    def hoist(k: int) -> None:
        """Closes the elements above the k-th: they hold nothing, and what stood in them stands beside them."""
        for open_ in stack[k + 1 :]:
            stack[k].children += open_.children
            open_.children = []
        del stack[k + 1 :]

    while head := SUSPECTED.search(text, at, end):
        m = TOKENS.match(text, head.start(), end)
        if not m:
            at = head.start() + 1
            if (sign := text[head.start()]) in SIGNS and parent.kind == "page" and text[head.start() - 1 : head.start()] != sign and text[at : at + 1] != sign:
                stack[-1].children.append(Node(head.start(), at, "sign", _sign(text, head.start()), sign))
            continue
        at = m.end()
        kind = m.lastgroup if m.lastgroup != "eq" else "wheading"
        if kind == "tag":
            name = TAG_NAME.match(m[0])[1].lower()
            if name not in ELEMENTS:
                continue
            if m[0][1] == "/":
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].source == name), 0)
                if k:
                    hoist(k)
                    node = stack.pop()
                    node.inner, node.close, node.type = m.start(), m.end(), f"tag {name} closed"
                else:
                    stack[-1].children.append(Node(m.start(), m.end(), "tag", f"tag {name} end", name))
                continue
            if name in IMPLIED and len(stack) > 1 and stack[-1].source == name:
                node = stack.pop()
                node.inner = node.close = m.start()
            node = Node(m.start(), m.end(), "tag", f"tag {name}", name)
            stack[-1].children.append(node)
            if name not in VOID and not m[0].endswith("/>"):
                stack.append(node)
            continue
        if kind == "entity" and html.unescape(m[0]) == m[0]:
            continue
        node = Node(m.start(), m.end(), kind, kind)
        stack[-1].children.append(node)
        if kind in OPEN:
            lead = 2 if kind not in ("emphasis", "link") else 1
            inside.append((node, m.start() + lead, m.end() - lead))
    hoist(0)
    return inside


def infer(root: Node, model: dict) -> Node:
    """Sum-product on the tree: messages from the leaves to the root, then back; sets the marginal of every node."""
    rate, same, other = model["rate"], model["same"], model["other"]
    order: list[tuple[Node, Node | None]] = [(root, None)]
    for node, _ in order:
        order.extend((child, node) for child in node.children)

    def own(node: Node) -> float:
        p = model["page"] if node.kind == "page" else rate.get(node.type, rate.get(node.kind, model["unknown"]))
        return p / (1 - p)

    def tie(a: Node, b: Node) -> float:
        return model["sign"] if a.kind == "sign" else same if dialect(a) == dialect(b) else other

    belief = {id(n): own(n) for n, _ in order}
    sent: dict[int, float] = {}
    for node, parent in reversed(order):
        if parent is not None:
            t, b = tie(node, parent), belief[id(node)]
            sent[id(node)] = (t * b + 1) / (b + t)
            belief[id(parent)] *= sent[id(node)]
    for node, parent in order:
        if parent is not None:
            t, rest = tie(node, parent), belief[id(parent)] / sent[id(node)]
            belief[id(node)] *= (t * rest + 1) / (rest + t)
        b = belief[id(node)]
        node.marginal = b / (1 + b) if b < 1e12 else 1.0
    return root


#: The model of a corpus without labelled pages: constructs are rather markup, lone signs are not.
DEFAULT = {"rate": {"sign": 0.1}, "page": 0.3, "same": 2.0, "other": 1.2, "sign": 1.0, "unknown": 0.6}


def evidence(raw: str | None, clean: str | None) -> Counter:
    """What a labelled page says: `type`, `gone type` of its constructs, and `edge` with the fates of parent and child.

    A construct of the raw text is gone if the cleaned text has its beginning less often.
    """
    said: Counter = Counter()
    if not raw or not clean:
        return said
    root = parse(raw)
    nodes = root.all()
    gone = {}
    for node in nodes:
        piece = raw[max(0, node.start - 2) : node.start + 4] if node.kind == "sign" else raw[node.start : min(node.end, node.start + 30)] if node.kind not in ("tag", "entity", "comment") else raw[node.start : node.end]
        gone[id(node)] = raw.count(piece) > clean.count(piece)
    if not nodes:
        return said
    for node in nodes:
        said[f"type {'gone ' if gone[id(node)] else ''}{node.type}"] += 1
    n_gone, n_all = sum(gone[id(n)] for n in nodes if n.kind != "sign"), sum(n.kind != "sign" for n in nodes)
    if n_all:
        said[f"type {'gone ' if n_gone else ''}page"] += 1
    for node in (root, *nodes):
        for child in node.children:
            own = child.kind != "sign"
            if node is root and n_all == own:
                continue  # what a page is must be told by its other constructs
            up = n_gone > (own and gone[id(child)]) if node is root else gone[id(node)]
            said[f"edge {'sign' if not own else 'same' if dialect(node) == dialect(child) else 'other'} {up:d}{gone[id(child)]:d}"] += 1
    return said


def learned(said: dict[str, int]) -> dict:
    """The model from summed evidence.

    Cleaning leaves some markup behind, so labels are positive or unknown: the share of gone constructs of a type is
    divided by the share among markup, which is the mean of the types' shares over all gone constructs (Elkan and Noto).
    A tie is the root of the odds ratio of parent and child, as it is in a pairwise model.
    """
    gone = {k.removeprefix("type gone "): n for k, n in said.items() if k.startswith("type gone ")}
    kept = {k.removeprefix("type "): n for k, n in said.items() if k.startswith("type ") and not k.startswith("type gone ")}
    types = (gone.keys() | kept.keys()) - {"page"}
    markup = sum(gone.get(t, 0) for t in types)
    if not markup:
        return DEFAULT

    def pooled(own: set[str], before: float = 0.5, weight: float = 1.0) -> float:
        """The share of gone constructs of some types, drawn towards what is known of all as if seen `weight` times."""
        n = sum(gone.get(t, 0) for t in own)
        return (n + weight * before) / (n + sum(kept.get(t, 0) for t in own) + weight)

    signs = {t for t in types if t.startswith("sign")}
    general = {True: pooled(signs), False: pooled(types - signs)}
    share = {t: pooled({t}, general[t in signs], POOLED) for t in types}
    found = sum(gone.get(t, 0) * share[t] for t in types) / markup

    def of(own: float) -> float:
        return min(SURE, max(1 - SURE, own / found))

    def tie(kind: str) -> float:
        """From counts smoothed towards independence, so that fates which never vary tie nothing."""
        a, b, c, d = (said.get(f"edge {kind} {x}", 0) for x in ("11", "10", "01", "00"))
        n = a + b + c + d
        up, down = (a + b + 0.5) / (n + 1), (a + c + 0.5) / (n + 1)
        a, b, c, d = a + POOLED * up * down, b + POOLED * up * (1 - down), c + POOLED * (1 - up) * down, d + POOLED * (1 - up) * (1 - down)
        return min(TIE_MOST, max(1.0, math.sqrt(a * d / (b * c))))

    rate = {t: of(x) for t, x in share.items()}
    for kind in {t.split()[0] for t in types}:  # a type that no labelled page has goes by its kind
        rate.setdefault(kind, of(pooled({t for t in types if t.split()[0] == kind}, general[kind == "sign"], POOLED)))
    return {"rate": {**DEFAULT["rate"], **rate}, "page": of(pooled({"page"})), "same": tie("same"), "other": tie("other"), "sign": tie("sign"), "unknown": of(general[False])}


def fit(pairs: list[tuple[str, str]]) -> dict:
    """The model from (raw text, cleaned text) pairs."""
    return learned(sum((evidence(raw, clean) for raw, clean in pairs), Counter()))


def kinds_of(text: str, model: dict) -> list[str]:
    """The kinds of markup whose constructs have a marginal of at least one half."""
    return sorted({dialect(n) for n in infer(parse(text), model).all() if n.marginal >= 0.5})


HEADINGS = re.compile(r"^h([1-6])$")
#: Elements whose inside is trimmed or left out.
TRIMMED = frozenset("li td th tr pre code script style head br hr".split())


def clean_text(text: str | None, model: dict) -> str | None:
    """The text without markup that keeps headings (#), lists (-), tables (cells between |), code (```) and formulas ($).

    Constructs whose marginal is below one half stay as they are, and so does a text that has no other.  Null stays null.
    """
    if not text or not SUSPECTED.search(text):
        return text
    root = infer(parse(text), model)
    nodes = root.all()
    if not any(n.marginal >= 0.5 for n in nodes):
        return text
    made: dict[int, list] = {}
    for node in reversed(nodes):  # children before parents
        made[id(node)] = _one(text, node, made) if node.marginal >= 0.5 else [text[node.start : node.close]]
    whole = _flat(_render(text, root, made, root.start, root.end))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", whole)).strip()


def _render(text: str, node: Node, made: dict[int, list], start: int, end: int) -> list:
    """The stretch of a node as pieces: texts, and the pieces of its children."""
    out, at = [], start
    for child in node.children:
        out += (text[at : child.start], made[id(child)])
        at = child.close
    out.append(text[at:end])
    return out


def _flat(pieces: list) -> str:
    """The text of nested pieces, without recursion."""
    out, open_ = [], [iter(pieces)]
    while open_:
        for piece in open_[-1]:
            if isinstance(piece, str):
                out.append(piece)
            else:
                open_.append(iter(piece))
                break
        else:
            open_.pop()
    return "".join(out)


def _one(text: str, node: Node, made: dict[int, list]) -> list:
    """The pieces that a construct becomes; `made` has those of its children."""
    if node.kind == "tag":
        inside = _render(text, node, made, node.end, node.inner) if node.close > node.end else []
        if node.source in ("p", "div", "ul", "ol", "table", "section", "article", "blockquote", "dl", "dd", "dt") and not node.type.endswith(" end"):
            return ["\n", inside, "\n"]
        if not (HEADINGS.match(node.source) or node.source in TRIMMED) and not node.type.endswith(" end"):
            return inside
        return [_piece(text, node, _flat(inside))]
    if node.kind in ("strong", "strike"):
        return [_flat(_render(text, node, made, node.start + 2, node.end - 2)).strip()]
    if node.kind == "emphasis":
        return _render(text, node, made, node.start + 1, node.end - 1)
    return [_piece(text, node, "")]


def _piece(text: str, node: Node, inside: str) -> str:
    piece = text[node.start : node.end]
    match node.kind:
        case "tag":
            name = node.source
            if node.type.endswith(" end"):
                return ""
            if m := HEADINGS.match(name):
                return f"\n{'#' * int(m[1])} {inside.strip()}\n"
            if name == "li":
                return f"\n- {inside.strip()}"
            if name in ("td", "th"):
                return f" {inside.strip()} |"
            if name == "tr":
                return f"\n| {inside.strip()}" if not inside.strip().startswith("|") else f"\n{inside.strip()}"
            if name in ("pre", "code"):
                return f"\n```\n{inside.strip()}\n```\n" if name == "pre" else f"`{inside.strip()}`"
            if name in ("script", "style", "head"):
                return ""
            return "\n"  # br, hr
        case "entity":
            return html.unescape(piece).replace("\xa0", " ")
        case "comment" | "template" | "image":
            return ""
        case "link":
            return piece[1 : piece.index("](")]
        case "wstrong":
            return piece.strip("'")
        case "quote":
            return ""
        case "task":
            return "- "
        case "setext":
            return ""
        case "wheading":
            return f"# {piece.strip('= ')}"
        case "wlink":
            return "" if piece.lower().startswith("[[category:") else piece[2:-2].rsplit("|", 1)[-1]
        case "wtable":
            rows = [r for r in re.split(r"\|-+", re.sub(r"^\{\|[^\n|!]*|\|\}$", "", piece)) if r.strip()]
            return "".join("\n| " + " | ".join(c.strip() for c in re.split(r"\|\||!!|\n\s*[|!]|^\s*[|!]|(?<=\s)!\s", r) if c.strip()) + " |" for r in rows) + "\n"
        case "env":
            return ""
        case "command":
            m = re.match(r"\\(\w+)\*?(?:\[[^\]]*\])?((?:\{[^{}]*\})*)", piece)
            name, body = m[1], m[2].strip("{}")
            if name in ("section", "subsection", "subsubsection", "chapter"):
                return f"# {body}"
            return "\n-" if name == "item" else f"${piece}$" if name in ("frac", "times", "geq", "leq", "pm") else body
        case _:  # code, fence, math, heading, mdrule keep their shape
            return piece


def texts_of(pages: DataFrame, corpus: DataFrame) -> DataFrame:
    """(page_key, field, text) of the suspected texts: current clean_ocr and every raw_text; the test runs in the JVM."""
    suspected = F.col("text").rlike(SUSPECT)
    clean = pages.select("page_key", F.lit("clean_ocr").alias("field"), F.col("clean_ocr").alias("text"))
    raw = corpus.select("page_key", F.lit("raw_text").alias("field"), F.col("raw_text").alias("text")).where("page_key is not null")
    return clean.unionByName(raw).where(suspected)


def fitted(pages: DataFrame, corpus: DataFrame, most: int = FIT_PAGES) -> dict:
    """The model, from at most `most` labelled pages with a construct in raw_text (those whose hash comes first).

    Pages are chosen by hash before any text is looked at; only counts of types and edges reach the driver.
    """
    raw = corpus.where("page_key is not null").select("page_key", "raw_text")
    n = raw.count()
    chosen = raw.where(F.pmod(F.xxhash64("page_key"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, LOOKED_AT * most / max(1, n))))
    sample = written(bounded_sample(chosen.where(F.col("raw_text").rlike(SUSPECT)), most), "labelled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said: Counter = Counter()
        for batch in batches:
            for raw_text, clean in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                said.update(evidence(raw_text, clean))
        yield pa.RecordBatch.from_arrays([pa.array(list(said), pa.string()), pa.array(list(said.values()), pa.int64())], ["key", "n"])

    keys = F.broadcast(sample.select("page_key").distinct())  # reaches the scan, so that only chosen pages are shuffled
    pairs = pages.select("page_key", "clean_ocr").join(keys, "page_key", "left_semi").join(sample, "page_key").select("raw_text", "clean_ocr")
    return learned({r.key: r.n for r in pairs.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()})


def markup_kinds(pages: DataFrame, corpus: DataFrame, model: dict) -> DataFrame:
    """(page_key, field, markup), one row for each kind of markup in a field of a page; null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for key, field, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for kind in kinds_of(text, model):
                    for x, v in zip(out, (key, field, kind)):
                        x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in out], ["page_key", "field", "markup"])

    return texts_of(pages, corpus).mapInArrow(run, "page_key string, field string, markup string").distinct()


def clean_pages(pages: DataFrame, model: dict) -> DataFrame:
    """(page_key, text) of all current pages (page_key, clean_ocr), cleaned; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean_text(t, model) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(texts, pa.string())], ["page_key", "text"])

    return pages.select("page_key", "clean_ocr").mapInArrow(run, "page_key string, text string")

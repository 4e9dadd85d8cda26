"""Markup residue: find it, and turn marked-up text into clean text that keeps headings, lists, code and formulas.

A text is read into a tree (blocks, inline spans, HTML elements, LaTeX environments and commands, wiki and Markdown
constructs, plain text). Which nodes carry content is inferred jointly: every node has a potential from its kind and its
shape (size, sentence ends, share of links, place among its siblings, parent), every parent-child edge a potential for the
pair of states, and one upward and one downward sum-product pass give each node's content marginal. Node potentials are a
logistic regression, edge potentials counts, both from labelled pages. Labels go by content: a list of links to other
pages is dropped, a list of findings kept, though both are lists.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperlake.llm.canonical import NEEDS_TABLE, TABLE
from paperlake.llm.quality import CLOSED_END, SENTENCE_END
from paperlake.llm.sampling import bounded_sample

FORMULA = re.compile(r"\$\$.*?\$\$|\$[^$\n]*\$", re.S)
BRACED = r"\{(?:[^{}]++|\{(?:[^{}]++|\{[^{}]*+\})*+\})*+\}"
GROUPS = {
    "formula": r"\$\$.*?\$\$|\$[^$\n]*\$",
    "comment": r"<!--.*?-->",
    "fence": r"(?m:^)(?:```|~~~)[^\n]*\n.*?(?:```|~~~)(?=\s|$)",
    "tag": r"</?[A-Za-z][\w:-]*(?:\s[^<>]*)?/?>",
    "entity": r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});",
    "template": r"\{\{(?:[^{}]++|\{\{[^{}]*+\}\})*+\}\}",
    "table": r"(?m:^)\{\|.*?\|\}|(?m:^)\|[^\n]*\|[ \t]*(?m:$)",
    "wikilink": r"\[\[[^\[\]\n]+\]\]",
    "link": r"!?\[[^\[\]\n]*\]\((?=[^()\s]*[./#:])[^()\n]*\)|\[https?://[^\s\]]+[^\]\n]*\]",
    "env": r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?",
    "newline": r"\\\\(?:\*?\[[^\]\n]*\])?",
    "command": r"~?\\[A-Za-z]+\*?(?:\[[^\[\]\n]*\])*(?:" + BRACED + r")*",
    "setext": r"(?m:^)[^\n]+\n(?:={3,}|-{3,})[ \t]*(?m:$)",
    "wikihead": r"(?m:^)(={1,6})[ \t]*[^=\n]+?[ \t]*(?:={1,6})[ \t]*(?m:$)",
    "head": r"(?m:^)(?:#[ \t]+|#{3,6}[ \t]+)(?=\S)",
    "rule": r"(?m:^)(?:-{4,}|\*{3,}|_{3,})[ \t]*(?m:$)",
    "item": r"(?m:^)[ \t]*(?:[*+][ \t]+|(?!##[ \t])[*#]{2,6}[ \t]+|[0-9]{1,3}[.)][ \t]+|[;:]+[ \t]+)(?=\S)",
    "quote": r"(?m:^)>[ \t]?",
    "code": r"`[^`\n]+`",
    "bold": r"\*\*(?=\S)[^*\n]+?(?<=\S)\*\*|(?<!\w)__(?=\S)[^_\n]+?(?<=\S)__|'''[^'\n](?:[^\n]*?[^'\n])?'''",
    "italic": r"(?<![\w*])\*(?=[\w“«(¿¡„])[^*\n]*?(?<=[^\s*])\*(?![\w*])|(?<![\w_])_(?=[^\W_]|[“«(¿¡„])[^_\n]*?(?<=[^\s_])_(?![\w_])|''[^'\n]+''|~~[^~\n]+~~",
}
TOKEN = re.compile("|".join(f"(?P<{k}>{v})" for k, v in GROUPS.items()), re.S)
#: A cheap necessary condition, in a dialect that both engines read.
HINT = r"<[/!A-Za-z]|&[#A-Za-z]|\\[A-Za-z\\]|`|\*\S|(^|[^A-Za-z0-9_])_+[^\s_]|''|\{\{|\{\||\[\[|\]\(|\[http|(?m)^(?:#(?!# )|[=>*+;:|])|(?m)^ *[0-9]{1,3}[.)] |(?m)^[-=*_]{3,} *$|~~"
OWN_HINT = re.compile(HINT.replace("(?m)", ""), re.M)


def prepared(text: str) -> str:
    """Width, kinds of space and ignorable characters settled, so that disguised text is read like plain text."""
    text = text.replace("\r\n", "\n")
    return text.translate(TABLE) if NEEDS_TABLE.search(text) else text


def has_markup(text: str | None) -> bool:
    """Whether anything but the project's own marks and formulas is found. Null and empty: no."""
    if not text:
        return False
    text = prepared(text)
    return any(m.lastgroup != "formula" for m in TOKEN.finditer(text))


@dataclass
class Node:
    kind: str
    text: str = ""
    children: list[Node] = field(default_factory=list)
    label: int | None = None  # only on labelled pages
    marginal: float = 1.0

    def walk(self) -> Iterator[Node]:
        yield self
        for child in self.children:
            yield from child.walk()

    def plain(self) -> str:
        return self.text + "".join(c.plain() for c in self.children)


# What HTML elements and LaTeX names stand for. Names not listed are transparent groups.
ELEMENTS = {
    "h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading", "li": "item", "ul": "list", "ol": "list",
    "p": "paragraph", "div": "paragraph", "section": "paragraph", "article": "paragraph", "blockquote": "paragraph", "tr": "item", "td": "group", "th": "group", "table": "list",
    "pre": "pre", "code": "inline", "em": "inline", "i": "inline", "b": "inline", "strong": "inline", "span": "inline", "a": "link", "sup": "sup", "sub": "inline",
    "script": "script", "style": "script", "nav": "nav", "footer": "nav", "header": "nav", "aside": "nav", "form": "nav", "ref": "reference", "math": "inline",
}
#: Elements nested deeper than this no longer open a level of their own.
DEEPEST = 150
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr"}
ENVIRONMENTS = {
    "itemize": "list", "enumerate": "list", "description": "list", "equation": "display", "equation*": "display", "align": "display", "align*": "display", "gather": "display",
    "displaymath": "display", "eqnarray": "display", "verbatim": "pre", "lstlisting": "pre", "abstract": "paragraph", "quote": "paragraph", "theorem": "paragraph", "proof": "paragraph",
}
HEADINGS = {"section", "subsection", "subsubsection", "chapter", "part", "paragraph", "title"}
SPANS = {"emph", "textbf", "textit", "texttt", "textsc", "textrm", "mbox", "hbox", "underline", "text", "textsf", "enquote", "author", "caption"}
NOTES = {"footnote", "thanks", "footnotetext"}
POINTERS = {"cite", "citep", "citet", "ref", "eqref", "label", "pageref", "autoref", "cref", "bibliography", "bibliographystyle", "input", "include", "url"}


def parse(text: str) -> Node:
    root = Node("root")
    stack = [root]
    here = 0

    def close(kinds: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].kind in kinds:
                del stack[depth:]
                return

    def add(node: Node) -> None:
        stack[-1].children.append(node)

    for m in TOKEN.finditer(text):
        if m.start() > here:
            add(Node("text", text[here : m.start()]))
        here, token, group = m.end(), m[0], m.lastgroup
        if group == "formula":
            add(Node("formula", token))
        elif group in ("comment", "rule"):
            add(Node(group, ""))
        elif group == "fence":
            add(Node("pre", token[token.index("\n") + 1 : -3].strip("\n")))
        elif group == "tag":
            name = re.match(r"</?([\w:-]+)", token)[1].lower()
            kind = ELEMENTS.get(name, "group")
            if token.startswith("</"):
                close({kind})
            elif name == "br":
                add(Node("break", "\n"))
            elif name in VOID or token.endswith("/>"):
                add(Node("reference" if kind == "reference" else "rule"))
            elif len(stack) < DEEPEST:
                node = Node(kind)
                add(node)
                stack.append(node)
        elif group == "entity":
            add(Node("text", html.unescape(token).replace("\xa0", " ")))
        elif group == "template":
            last = token[2:-2].rpartition("|")[2]
            add(Node("template", "", [Node("text", last)] if "=" in last else parse(last).children))
        elif group == "table":
            add(_table(token))
        elif group == "wikilink":
            add(Node("link", "", [Node("text", token[2:-2].rsplit("|", 1)[-1])]))
        elif group == "link":
            if token.startswith("!"):
                add(Node("image", token))
            else:
                shown = re.match(r"\[https?://\S+?(?:\s+([^\]]*))?\]$", token)
                add(Node("link", "", [Node("text", (shown[1] or "") if shown else token[1 : token.index("](")])]))
        elif group == "env":
            name = token[token.index("{") + 1 : token.index("}")]
            kind = ENVIRONMENTS.get(name, "group")
            if token.startswith("\\end"):
                close({"item"}) if kind == "list" else None
                close({kind})
            elif len(stack) < DEEPEST:
                node = Node(kind)
                add(node)
                stack.append(node)
        elif group == "newline":
            add(Node("break", " "))
        elif group == "command":
            _command(token, stack, add, close)
        elif group == "setext":
            add(Node("heading", "", [Node("text", token.split("\n")[0].strip())]))
        elif group == "wikihead":
            add(Node("heading", "", [Node("text", token.strip().strip("=").strip())]))
        elif group == "head":
            add(Node("mark", "## "))
        elif group == "item":
            add(Node("mark", "- "))
        elif group == "quote":
            add(Node("mark", ""))
        elif group in ("code", "bold", "italic"):
            add(Node("inline", "", [Node("text", token.strip("`*_~'"))]))
    if here < len(text):
        add(Node("text", text[here:]))
    return root


def _table(token: str) -> Node:
    """A wiki table, or one Markdown row, as rows of cells; rows of dashes and attributes are no content."""
    wiki = token.startswith("{|")
    rows = re.split(r"(?m)^\|-[^\n]*$", token[2:-2].partition("\n")[2]) if wiki else [token]
    table = Node("list")
    for row in rows:
        cells = re.split(r"(?m)^[|!]+\+?|\|\||!!", row) if wiki else row.strip().strip("|").split("|")
        if not wiki and not re.search(r"[^\s|:-]", row):
            table.children.append(Node("rule"))
            continue
        shown = [parse(re.sub(r"^[^|\[\]{}\n]*=[^|\n]*\|(?!\|)", "", c).strip()).children for c in cells if c.strip()]
        if shown:
            item = Node("item")
            for k, children in enumerate(shown):
                item.children += [Node("text", " | ")] * (k > 0) + [Node("group", "", children)]
            table.children.append(item)
    return table


def _command(token: str, stack: list[Node], add, close) -> None:
    body = token.lstrip("~")
    name = re.match(r"\\([A-Za-z]+)", body)[1]
    args = [a[1:-1] for a in re.findall(BRACED, body)]
    if stack[-1].kind == "display":
        add(Node("formula-part", body))
    elif name == "item":
        close({"item"})
        node = Node("item", " ".join(args))
        add(node)
        stack.append(node)
    elif name in HEADINGS and args:
        add(Node("heading", "", parse(args[-1]).children))
    elif name in SPANS and args:
        add(Node("inline", "", parse(args[-1]).children))
    elif name in NOTES and args:
        add(Node("note", "", parse(args[-1]).children))
    elif name in POINTERS:
        add(Node("reference", " ".join(args)))
    else:
        add(Node("layout", "", [c for a in args for c in parse(a).children]))


ENDS = re.compile(r"\w\w\W*[.!?。！？]")


CAPITALS = re.compile(r"\b[A-ZÀ-ÞА-Я]")


def features(root: Node) -> dict[int, list[str]]:
    """What every node's own potential looks at: its kind, and beside the kind its size, whether a sentence ends in it,
    the share of its text that is links, how much of it is capitalised or figures, its place among its siblings and its
    parent's kind. One pass from the leaves up, one down."""
    size: dict[int, int] = {}
    linked: dict[int, int] = {}
    ends: dict[int, bool] = {}
    order = list(root.walk())
    out: dict[int, list[str]] = {}
    for n in reversed(order):
        k, own, i = n.kind, len(n.text.strip()), id(n)
        size[i] = own + sum(size[id(c)] for c in n.children)
        linked[i] = size[i] if k == "link" else sum(linked[id(c)] for c in n.children)
        ends[i] = any(ends[id(c)] for c in n.children) or bool(n.text and ENDS.search(n.text))
        grade = min(5, int(math.log10(size[i] + 1) * 2)) if size[i] else "-"
        links = 0 if not linked[i] else 1 if 2 * linked[i] < size[i] else 2
        end = "end" if ends[i] else "open"
        out[i] = [k, f"{k}|size{grade}", f"{k}|{end}", f"links{links}", f"{k}|links{links}", f"size{grade}", f"{end}|links{links}"]
    for n in order:
        for i, c in enumerate(n.children):
            out[id(c)] += [f"{c.kind}<{n.kind}", f"{c.kind}|place{0 if i == 0 else 2 if i == len(n.children) - 1 else 1}"]
            if c.text and len(c.text) < 60:
                share = min(2, 2 * len(CAPITALS.findall(c.text)) // max(1, len(c.text.split())))
                out[id(c)].append(f"{c.kind}<{n.kind}|capitals{share}|digits{any(x.isdigit() for x in c.text)}")
    return out


class ContentModel:
    """Node and edge potentials from labelled trees; exact marginals on a tree."""

    def __init__(self) -> None:
        self.node: dict[str, float] = {}
        self.edge = [[0.0, 0.0], [0.0, 0.0]]

    def own(self, of: list[str]) -> float:
        """Log-odds of content by a node's own features."""
        return self.node.get("", 0.0) + sum(self.node.get(f, 0.0) for f in of)

    def fit(self, pages: list[Node], rounds: int = 8, rate: float = 0.15, decay: float = 1e-4) -> ContentModel:
        """Stochastic gradient steps for the node potentials, in a fixed order; smoothed counts for the edges."""
        pairs, states, seen = [[1.0, 1.0], [1.0, 1.0]], [1.0, 1.0], []
        for page in pages:
            of = features(page)
            for node in page.walk():
                if node.kind == "text" and not node.text.strip():
                    continue  # space belongs to what stands around it
                seen.append((of[id(node)], node.label))
                states[node.label] += 1
                for child in node.children:
                    pairs[node.label][child.label] += 1
        rng, weights = random.Random(1), self.node
        for step in range(rounds):
            rng.shuffle(seen)
            for of, label in seen:
                miss = (rate / (1 + step)) * (label - _logistic(self.own(of)))
                for f in ("", *of):
                    w = weights.get(f, 0.0)
                    weights[f] = w + miss - rate * decay * w
        for p in (0, 1):
            total = sum(pairs[p])
            for c in (0, 1):
                self.edge[p][c] = math.log(pairs[p][c] / total) - math.log(states[c] / sum(states))
        return self

    def infer(self, root: Node) -> None:
        """Sum-product: messages up from the leaves, then down from the root. Works on log-odds, iteratively."""
        order = list(root.walk())
        own = {k: self.own(of) for k, of in features(root).items()}
        up: dict[int, float] = {}
        belief: dict[int, float] = {}
        for n in reversed(order):
            total = own[id(n)] + sum(up[id(c)] for c in n.children)
            belief[id(n)] = total
            up[id(n)] = self.message(total, False)
        root.marginal = _logistic(belief[id(root)])
        full = {id(root): belief[id(root)]}
        for n in order:
            for c in n.children:
                full[id(c)] = belief[id(c)] + self.message(full[id(n)] - up[id(c)], True)
                c.marginal = _logistic(full[id(c)])

    def message(self, odds: float, down: bool) -> float:
        """Log-odds that one end of an edge sends to the other."""
        e = self.edge
        score = [0.0, 0.0]
        for target in (0, 1):
            a, b = (e[0][target], e[1][target]) if down else (e[target][0], e[target][1])
            score[target] = _log_add(a, b + odds)
        return score[1] - score[0]


def _log_add(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log(math.exp(a - high) + math.exp(b - high))


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


# Words of menus and footers, for the labelled pages.
MENU = "Home About Search Login Contact Imprint Terms Privacy Help News Archive Sitemap Register Subscribe Download Share Print Next Previous Top".split()
#: Kinds that carry no content wherever they stand.
EMPTY = {"comment", "image", "reference", "rule", "script"}


def labelled_pages(texts: list[str], seed: int = 1) -> list[Node]:
    """Pages whose labels are known by construction: lines of clean texts rendered with the constructs of the markups,
    and between them boilerplate in the same constructs (menus as lists, paragraphs or links, boxes, pointers, layout
    commands). What was rendered from a text is content, whatever its kind; the rest is not."""
    rng = random.Random(seed)
    short = lambda s: " ".join(s.split(" ")[: rng.randint(1, 6)])
    keeps = [lambda s: f"<p>{s}</p>", lambda s: f"<p>{amid(s)}</p>", lambda s: f"<ul><li>{short(s)}</li><li>{amid(s)}</li></ul>", lambda s: f'<div class="x">{s}</div>', lambda s: f"\\emph{{{s}}}", lambda s: f"'''{s}'''", lambda s: f"**{s}**",
             lambda s: f"<h2>{short(s)}</h2>", lambda s: f"\\section{{{short(s)}}}", lambda s: f"== {short(s)} ==", lambda s: f"* {s}", lambda s: f"<ul><li>{s}</li><li>{short(s)}</li></ul>",
             lambda s: f"\\begin{{itemize}}\n\\item {s}\n\\item {short(s)}\n\\end{{itemize}}", lambda s: f"```\n{s}\n```", lambda s: f"<pre><code>{s}</code></pre>",
             lambda s: f'{s} <a href="https://x.example/">{short(s)}</a>', lambda s: f"{short(s)} [{short(s)}](https://x.example/a) {s}", lambda s: f"{s} [[{short(s)}]]", lambda s: f"{s}\\footnote{{{s[:80]}}}", lambda s: f"> {s}",
             lambda s: f"\\marked{{{s}}}", lambda s: f"{{{{quote|{s}}}}}", lambda s: f"| {s[:40]} | {s[-40:]} |", lambda s: f"$x_1$ {s} $$y$$", lambda s: f"{s}<sup>2</sup> &amp; <em>{s[:25]}</em>",
             lambda s: f"\\begin{{equation}}a+b \\alpha\\end{{equation}} {s}", lambda s: f"a line\\\\ {s}<br/>"]
    inner = [lambda s: f"\\emph{{{s}}}", lambda s: f"<b>{s}</b>", lambda s: f"[{s}](https://x.example/b)", lambda s: f"[[{s}]]", lambda s: f"[[{s.title()} (term)|{s.title()}]]", lambda s: f'<a href="/x">{s.title()}</a>', lambda s: f"`{s}`", lambda s: f"\\textbf{{{s}}}", lambda s: f"<span>{s}</span>",
             lambda s: f"''{s}''", lambda s: f"{s}\\cite{{k}}", lambda s: f"{s} &ndash;", lambda s: f"{s}~\\ref{{a}}", lambda s: f"$a_{{{rng.randint(1, 99)}}}$ {s}"]

    def amid(s: str) -> str:
        """Markup inside a sentence, so that what stands before and behind may be short."""
        w = s.split(" ")
        a = rng.randint(0, min(4, len(w) - 1))
        b = a + rng.randint(1, 3)
        return " ".join([*w[:a], rng.choice(inner)(" ".join(w[a:b])), *w[b:]])

    def twice(s: str) -> str:
        w = s.split(" ")
        return " ".join(amid(" ".join(part)) for part in (w[: len(w) // 2], w[len(w) // 2 :]) if part)

    keeps += [amid] * 6 + [twice] * 3 + [lambda s: f"<p>{twice(s)}</p>"] * 3
    word = lambda: rng.choice(MENU)
    links = lambda sep, n: sep.join(f'<a href="/{k}">{word()}</a>' for k in range(n))
    drops = [lambda: "<!-- hidden -->", lambda: f"<nav>{word()} {word()} {word()}</nav>", lambda: "<script>var a = 1;</script>", lambda: "<style>p {color: red}</style>",
             lambda: "{{Infobox x|year=2001|bound=3}}", lambda: f"{{{{Infobox {word()}\n| name = {word()} {word()}\n| bound = {rng.randint(1, 99)}.{rng.randint(1, 999)}\n}}}}", lambda: "{{reflist}}", lambda: "![plot](fig.png)", lambda: '<ref name="r1"/>', lambda: "\\cite{key2001}", lambda: "\\ref{sec:a}", lambda: "\\vspace{2mm}",
             lambda: "\\noindent", lambda: "\\hspace{1em}", lambda: "<hr/>", lambda: "----", lambda: f"<footer>{word()} {word()}</footer>", lambda: f"<div>{links(' | ', rng.randint(2, 6))}</div>",
             lambda: f"<ul>{''.join(f'<li><a href="/{k}">{word()}</a></li>' for k in range(rng.randint(3, 8)))}</ul>", lambda: f"<p>{links(' ', rng.randint(2, 5))}</p>",
             lambda: "|---|---|", lambda: "\\setlength{\\parindent}{0pt}", lambda: "\\label{eq:1}"]
    pages = []
    for text in texts:
        root = Node("root", label=1)
        for line in text.split("\n"):
            s = line.removeprefix("## ").removeprefix("- ").strip()
            if not s or TOKEN.search(s):
                continue
            _grow(root, rng.choice(keeps)(s) if rng.random() < 0.6 else s, 1)
            if rng.random() < 0.5:
                _grow(root, rng.choice(drops)(), 0)
        pages.append(root)
    return pages


def _grow(root: Node, markup: str, label: int) -> None:
    for node in parse(markup).children:
        _label(node, label)
        root.children.append(node)
    root.children.append(Node("text", "\n", label=1))


def _label(node: Node, label: int) -> None:
    node.label = 0 if node.kind in EMPTY else label
    for child in node.children:
        _label(child, node.label)


BLOCKS = {"heading", "item", "list", "paragraph", "pre", "display"}


def render(node: Node, threshold: float = 0.5) -> str:
    """Clean text of a tree: nodes whose content marginal is below ``threshold`` are left out with all below them."""
    if node.marginal < threshold:
        return ""
    inner = node.text + "".join(render(c, threshold) for c in node.children)
    match node.kind:
        case "heading":
            return f"\n\n## {' '.join(inner.split())}\n"
        case "item":
            return f"\n- {' '.join(inner.split())}"
        case "list" | "paragraph":
            return f"\n\n{inner.strip()}\n\n"
        case "pre":
            return f"\n\n{inner.strip(chr(10))}\n\n"
        case "display":
            return f"\n\n$${inner.strip()}$$\n\n"
        case "note":
            return f" ({inner.strip()})"
        case "sup":
            return f"^{inner}" if inner.isdigit() else inner
        case _:
            return inner


def clean(text: str, model: ContentModel) -> str:
    """Texts without markup stay as they are."""
    if not has_markup(text):
        return text
    root = parse(prepared(text))
    model.infer(root)
    root.marginal = 1.0
    out = re.sub(r"[ \t]+\n", "\n", render(root))
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"(?<=\S)[ \t]{2,}", " ", out)).strip("\n")


def fit_model(results: DataFrame, rows: int = 300) -> ContentModel:
    """Train on pages built from a bounded sample (``rows``) of texts."""
    sample = bounded_sample(results.where("text is not null").select("result_id", "text"), "result_id", rows)
    texts = [t for t in sample["text"] if t and not has_markup(t)]
    return ContentModel().fit(labelled_pages(texts or ["Some text stands here."]))


def lacks_sentences(text: Column) -> Column:
    """The structural test of texts that are no prose (see the quality operator)."""
    high = F.regexp_count(text, F.lit(r"[^\x00-\x7f]"))
    return ~text.rlike(SENTENCE_END) & ~text.rlike(CLOSED_END) & (high < 0.15 * F.char_length(text))


def _hinted(results: DataFrame) -> DataFrame:
    """Rows that could hold markup; plain ASCII signs are looked for after undoing full-width forms."""
    plain = F.translate("text", "".join(chr(c) for c in range(0xFF01, 0xFF5F)), "".join(chr(c) for c in range(0x21, 0x7F)))
    return results.where(F.col("text").isNotNull()).where(plain.rlike(HINT) & ~lacks_sentences(F.col("text")))


def is_residue(text: str | None, model: ContentModel) -> bool:
    """Whether inference over the text's tree gives another text than it already is. Null and empty: no."""
    return bool(text) and clean(text, model) != text


def marked_up(results: DataFrame, model: ContentModel) -> DataFrame:
    """result_id of rows with markup residue. Texts that are no prose (lists, tables, junk) are no cases."""

    @F.pandas_udf("boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: is_residue(t, model))

    return _hinted(results).select("result_id", found("text").alias("found")).where("found").select("result_id")


def cleaned(results: DataFrame, model: ContentModel) -> DataFrame:
    """result_id, clean_text for every row; text without markup is unchanged, null stays null."""

    @F.pandas_udf("string")
    def convert(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: clean(t, model), na_action="ignore")

    return results.select("result_id", convert("text").alias("clean_text"))

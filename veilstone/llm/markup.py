"""Problem 1: markup residue in text documents.

A text is parsed into one tree of candidate nodes of four languages (HTML, Markdown, wiki, LaTeX): whatever could
be markup is a node, also signs in their ordinary sense. Elements, environments, tables and fences hold the nodes
between their ends; headings, rows, emphasis, links, templates and arguments of commands hold those inside them,
however deeply nested. Gradient-boosted trees score each node from its subtree
density, attribute tokens, depth and siblings. A hierarchical decoding then labels the tree as a whole: what stands
inside code is content, both ends of a pair and a table with its rows agree. The accepted nodes give the found
languages and the clean text, which keeps headings, lists, tables, code and formulas.

The trees are fitted on a generated set of snippets (see snippets()), fixed by a seed, so no labelled rows are read.

Null, empty and sentinel texts have no nodes: clean text is the text itself, no case. Repeated rows give repeated
results, reported once by p1_found. Columns besides id and text are ignored.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import SENTINEL, table
from veilstone.llm.boosting import BoostedTrees

LANGS = ["html", "markdown", "wiki", "latex"]
# Texts without any of these signs have no nodes at all.
SIGNS = r"""[<&*_#`\[{=|\\$~]|''|(?m)^[ \t]*[-+>:!]"""

# Element, command and environment names of the public specifications.
HTML_NAMES = set(
    "html head body title meta link style script div span p br hr h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption col colgroup a img b i u s em strong small big sub sup tt code pre kbd samp var blockquote q cite center font form input button select option textarea label section article header footer nav aside main figure figcaption iframe object embed abbr address del ins mark strike video audio source canvas svg path map area noscript base param time".split()
)
ENTITIES = set("amp lt gt quot apos nbsp times copy reg euro pound yen cent sect para middot bull hellip ndash mdash lsquo rsquo ldquo rdquo laquo raquo deg plusmn frac12 frac14 frac34 divide minus le ge ne larr rarr uarr darr infin sum alpha beta gamma delta pi micro shy ensp emsp thinsp zwnj zwj trade iexcl iquest".split())
LATEX_NAMES = set(
    "section subsection subsubsection chapter paragraph begin end item textbf textit texttt textsc textrm emph underline frac dfrac tfrac sqrt sum prod int lim times cdot div pm leq geq neq le ge ne approx infty alpha beta gamma delta epsilon theta lambda mu pi sigma omega Delta Omega left right label ref eqref cite footnote caption includegraphics centering hline toprule midrule bottomrule multicolumn newline newpage clearpage noindent indent hfill vspace hspace quad qquad today title author date maketitle documentclass usepackage tableofcontents bibliography item url href text mathrm mathbf mathit operatorname overline hat bar vec dots ldots cdots par large Large small tiny bf it rm em verb LaTeX TeX textwidth linewidth input include in to rightarrow leftarrow forall exists partial nabla cup cap subset max min log ln sin cos tan".split()
)

# Spans end at a closing sign or a blank line, however long they are: where a class of characters doesn't end them, it
# is read without going back, and stops at the next opener, so that a text is read in linear time.
# every node starts with a sign, or with blanks before one at a line's start; ordinary characters fail at once
_NODE = re.compile(
    r"""(?:(?=[-<>&`~{|=!\#\[\\$*+:;'_])|(?<![^\n])(?=[ \t]+[-{|!=\#:*+;>`~_]))"""
    r"""(?:(?P<h_comment><!--.*?-->)"""
    r"""|(?P<h_tag></?(?P<name>[A-Za-z][A-Za-z0-9]*)(?P<attrs>(?:\s[^<>]{0,300}|\s(?:[^<>\n]|\n(?![ \t]*\n))*)?)/?>)"""
    r"""|(?P<h_entity>&(?:(?P<ent>[A-Za-z][A-Za-z0-9]{1,8})|\#[0-9]{2,6}|\#x[0-9A-Fa-f]{2,6});)"""
    r"""|(?P<m_fence>^[ ]{0,3}(?P<fence>```+|~~~+)[^\n`~]*$)"""
    r"""|(?P<w_table>^[ \t]*\{\|[^\n]*$|^[ \t]*\|\}[ \t]*$)"""
    r"""|(?P<w_row>^[ \t]*\|-+[ \t]*$|^[ \t]*![^\n]*!![^\n]*$|^[ \t]*\|(?!\|)[^\n|]*\|\|[^\n]*$)"""
    r"""|(?P<w_heading>^[ \t]*(?P<eq>={2,6})[ \t]*(?=[^=\s])[^\n=]*?[^=\s][ \t]*(?P=eq)[ \t]*$)"""
    r"""|(?P<m_setext>(?<=\S\n)(?:={3,}|-{3,})[ \t]*$)"""
    r"""|(?P<m_heading>^[ ]{0,3}\#{1,6}[ \t]+\S[^\n]*$)"""
    r"""|(?P<m_sep>^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)+\|?[ \t]*$)"""
    r"""|(?P<m_row>^[ \t]*\|[^\n|]+(?:\|[^\n|]*)*\|[ \t]*$)"""
    r"""|(?P<w_link>\[\[)|(?P<w_call>\{\{)"""
    r"""|(?P<w_quote>'{2,5}(?=[^'\s])(?:[^'\n]|'(?!'))+?(?<=[^'\s])'{2,5})"""
    r"""|(?P<l_env>\\(?:begin|end)\{(?P<env>[A-Za-z]+)\*?\}(?:\{[^{}\n]*\})?)"""
    r"""|(?P<l_math>\\\((?:.{1,300}?|(?:(?!\\[()]|\n[ \t]*\n).)++)\\\)|\\\[(?:.{1,300}?|(?:(?!\\\]|(?<!\\)\\\[|\n[ \t]*\n).)++)\\\]|\$\$?(?=[^\s$])(?P<math>[^$\n]+?)(?<=[^\s$])\$\$?)"""
    r"""|(?P<l_cmd>\\(?P<cmd>[A-Za-z]+)\*?(?:\[[^\]\n]*\])?)"""
    r"""|(?P<l_esc>\\[%&_\#\$\{\}]|\\\\(?=[ \t]*$)|(?<=\w)~(?=\\))"""
    r"""|(?P<m_image>!\[(?:[^\]\n]{0,200}|[^\[\]\n]*+)\]\((?:[^)\n]{1,300}|(?:[^)\n\]]|\](?!\())++)\))"""
    r"""|(?P<m_link>\[(?:[^\]\n]{1,200}|[^\[\]\n]++)\]\((?:[^)\s]{1,300}|(?:[^)\s\]]|\](?!\())++)\))"""
    r"""|(?P<m_strong>\*\*(?=[^\s*])(?:[^\n*]|\*(?!\*))+?(?<=[^\s*])\*\*|(?<![\w_])__(?=[^\s_])(?:[^\n_]|_(?!_))+?(?<=[^\s_])__(?![\w_]))"""
    r"""|(?P<m_strike>~~(?=[^\s~])[^\n~]+?(?<=[^\s~])~~)"""
    r"""|(?P<m_code>`(?=[^\s`])[^`\n]++`)"""
    r"""|(?P<m_bullet>^[ \t]*[-*+]{1,3}[ \t]+(?=\S))"""
    r"""|(?P<w_indent>^[ \t]*[:;*]+[ \t]*(?=\[\[|'''|\{\{))"""
    r"""|(?P<m_quote>^[ ]{0,3}>[ \t]?(?=\S))"""
    r"""|(?P<m_em>(?<![\w*\\])\*(?=[^\s*])[^\n*]+?(?<=[^\s*])\*(?![\w*])|(?<![\w_\\])_(?=[^\s_])[^\n_]+?(?<=[^\s_])_(?![\w_]))"""
    r"""|(?P<m_rule>^[ ]{0,3}(?:\*[ \t]*){3,}$|^[ ]{0,3}(?:_[ \t]*){3,}$)"""
    r"""|(?P<b_brace>\{[^{}\n]{1,80}\})|(?P<b_angle><[^<>]{1,60}>)|(?P<b_sign>[<>&*_\#`|$~=](?=[ \t\n])))""",
    re.M | re.X | re.S,
)
KINDS = [k for k in _NODE.groupindex if "_" in k]
LANG_OF = {"h": "html", "m": "markdown", "w": "wiki", "l": "latex", "b": ""}
CODE_TAGS, CODE_ENVS = {"pre", "code", "style", "script"}, {"verbatim", "lstlisting"}
SPANS = {"m_heading", "w_heading", "m_row", "w_row", "m_strong", "m_em", "m_strike", "w_quote", "m_link", "m_image", "w_link", "w_call", "l_cmd"}  # kinds that hold nodes inside them
_PAIRS = {"w_call": re.compile(r"\{\{|\}\}"), "w_link": re.compile(r"\[\[|\]\]|\n[ \t]*\n"), "l_cmd": re.compile(r"\\.|[{}]|\n[ \t]*\n", re.S)}


class Node:
    __slots__ = ("kind", "lang", "start", "end", "name", "attrs", "parent", "pair", "children", "close", "code", "depth", "inner", "args")

    def __init__(self, kind: str, start: int, end: int, name: str = "", attrs: str = "", parent: int = -1):
        self.kind, self.lang, self.start, self.end, self.name, self.attrs = kind, LANG_OF[kind[0]], start, end, name, attrs
        self.parent, self.pair, self.children, self.close, self.code, self.depth = parent, -1, [], False, False, 0
        self.inner: list[int] = []  # nodes inside a span
        self.args: list[tuple[int, int]] = []  # arguments of a command, without their braces


def balanced(text: str, kind: str) -> dict[int, int]:
    """Start of each opener that has its closer -> end of the closer; those of links and arguments stand in one paragraph."""
    out: dict[int, int] = {}
    stack: list[int] = []
    for m in _PAIRS[kind].finditer(text):
        sign = m.group()
        if sign[0] == "\n":
            stack.clear()
        elif sign[0] in "{[":
            stack.append(m.start())
        elif sign[0] in "}]" and stack:
            out[stack.pop()] = m.end()
    return out


def content_of(x: Node, text: str) -> tuple[int, int]:
    """The stretch inside a span, without its own signs."""
    a, b, raw = x.start, x.end, text[x.start : x.end]
    if x.kind in ("m_heading", "w_heading"):
        body = raw.strip().strip("#=").strip()
        a += raw.find(body)
        return a, a + len(body)
    if x.kind in ("m_row", "w_row"):
        return a + len(raw) - len(raw.lstrip()) + 1, b
    if x.kind == "w_quote":
        n = min(len(raw) - len(raw.lstrip("'")), len(raw) - len(raw.rstrip("'")))
        return a + n, b - n
    if x.kind in ("m_link", "m_image"):
        return a + raw.index("[") + 1, a + raw.index("](")
    n = 1 if x.kind == "m_em" else 2
    return a + n, b - n


def parse(text: str) -> list[Node]:
    """Candidate nodes, each before those inside it, as a tree through parent and children; openers are paired with their closers."""
    nodes: list[Node] = []
    spans = {k: balanced(text, k) if sign in text else {} for k, sign in (("w_call", "{{"), ("w_link", "[["), ("l_cmd", "\\"))}
    work = [(0, len(text), -1)]  # stretches to be read, with the span they are inside of
    while work:
        a, b, holder = work.pop()
        stack: list[int] = []  # open elements, environments, fences and tables
        at = a
        while m := _NODE.search(text, at, b):
            kind = m.lastgroup if "_" in (m.lastgroup or "") else next(k for k in KINDS if m.group(k) is not None)
            start, end = m.span()
            at = max(end, at + 1)
            args: list[tuple[int, int]] = []
            if kind in ("w_call", "w_link"):
                end = spans[kind].get(start, 0)
                if not end or end > b or end - start < 5:
                    at = start + 1
                    continue
                at = end
            elif kind == "l_cmd":
                while text.startswith("{", end) and (close := spans[kind].get(end, 0)) and close <= b:
                    args.append((end + 1, close - 1))
                    end = close
                at = end
            name = (m.group("name") or m.group("env") or m.group("cmd") or m.group("ent") or "") if kind in ("h_tag", "l_env", "l_cmd", "h_entity") else ""
            node = Node(kind, start, end, name if kind[0] == "l" else name.lower(), m.group("attrs") or "" if kind == "h_tag" else "")
            node.args = args
            i = len(nodes)
            opens = closes = False
            if kind == "h_tag":
                closes, opens = text[start + 1] == "/", node.name not in ("br", "hr", "img", "meta", "link", "input") and text[end - 2] != "/"
                opens = opens and not closes
                node.code = node.name in CODE_TAGS
            elif kind == "l_env":
                closes = text.startswith("\\end", start)
                opens, node.code = not closes, node.name in CODE_ENVS
            elif kind == "w_table":
                closes = text[start:end].strip() == "|}"
                opens = not closes
            elif kind == "m_fence":
                node.code, node.name = True, m.group("fence")[:3]
                closes = any(nodes[k].kind == kind and nodes[k].name == node.name for k in stack)
                opens = not closes
            node.close = closes
            if closes:
                for d in range(len(stack) - 1, -1, -1):
                    k = stack[d]
                    if nodes[k].kind == kind and nodes[k].name == node.name:
                        node.pair, nodes[k].pair = k, i
                        del stack[d:]
                        break
            up = stack[-1] if stack else holder
            if up >= 0:
                node.parent, node.depth = up, nodes[up].depth + 1
                nodes[up].children.append(i)
            if holder >= 0:
                nodes[holder].inner.append(i)
            nodes.append(node)
            if opens:
                stack.append(i)
            if kind in SPANS:
                work += [(x, y, i) for x, y in (args if kind == "l_cmd" else [content_of(node, text)]) if y > x]
    # what an opener without a closer had taken in belongs to the level above
    for n in nodes:
        while n.parent >= 0 and nodes[n.parent].pair < 0 and nodes[n.parent].kind not in SPANS:
            n.parent, n.depth = nodes[n.parent].parent, n.depth - 1
    return nodes


def features(text: str, nodes: list[Node]) -> np.ndarray:
    """One row per node; columns as in FEATURES."""
    out = np.zeros((len(nodes), len(KINDS) + 18), dtype=np.float32)
    kinds: dict[str, int] = {}
    langs: dict[str, int] = {}
    family: dict[tuple[int, str], int] = {}
    covered = 0
    for n in nodes:
        kinds[n.kind] = kinds.get(n.kind, 0) + 1
        langs[n.lang] = langs.get(n.lang, 0) + 1
        family[n.parent, n.lang] = family.get((n.parent, n.lang), 0) + 1
        covered += n.end - n.start
    base = len(KINDS)
    for i, n in enumerate(nodes):
        row = out[i]
        row[KINDS.index(n.kind)] = 1
        a, b = n.start, n.end
        raw = text[a:b]
        inner = raw.strip("$*_~`'{}[]|=# \t<>!-+:>")
        before, after = text[a - 1 : a], text[b : b + 1]
        last = nodes[n.pair].end if n.pair > i else b
        end_line = text.find("\n", b)
        line_rest = text[b : end_line if end_line >= 0 else len(text)]
        row[base] = n.name in HTML_NAMES if n.kind == "h_tag" else n.name in LATEX_NAMES if n.kind in ("l_cmd", "l_env") else (not n.name or n.name in ENTITIES) if n.kind == "h_entity" else 0
        row[base + 1] = n.pair >= 0
        row[base + 2] = n.close
        row[base + 3] = len(n.attrs.split())  # attribute tokens
        row[base + 4] = "=" in n.attrs or not n.attrs.strip()
        row[base + 5] = n.depth
        row[base + 6] = min(family[n.parent, n.lang], 20)  # siblings of its language
        row[base + 7] = min(kinds[n.kind], 20)
        row[base + 8] = (sum(nodes[k].end - nodes[k].start for k in n.children) + b - a) / max(1, last - a)  # subtree density
        row[base + 9] = covered / max(1, len(text))
        row[base + 10] = before.isalnum() or before in (":", "@", "\\", "/")
        row[base + 11] = after.isalnum()
        row[base + 12] = before.isdigit() or after.isdigit() or (after == " " and text[b + 1 : b + 2].isdigit())
        row[base + 13] = not inner or inner.replace(" ", "").isdigit()
        row[base + 14] = a == 0 or text[max(0, a - 2) : a].strip(" \t") in ("\n\n", "") and (a < 2 or text[a - 1] == "\n" and text[a - 2] == "\n")  # opens a block
        row[base + 15] = bool(raw[:1].isspace() or raw[1:2].isspace() or raw[-2:-1].isspace())
        if n.kind in ("m_bullet", "m_quote", "b_sign"):  # a number follows, or a number and a closing sign is all there is
            row[base + 16] = 2 if re.match(r"\s*[\dOlIivx]{1,5}\s*[-~*+]+\s*$", line_rest) else bool(re.match(r"\s*\d", line_rest))
        row[base + 17] = bool(re.search(r"\\|[_^]\{|^[A-Za-z]$|[=+<>]", inner)) if n.kind == "l_math" else min(len(raw if n.kind == "m_rule" else inner), 60) / 60
        prev_line = text.rfind("\n", 0, max(0, a - 1))
        if n.kind in ("m_bullet", "m_quote") and not row[base + 14]:  # follows a line of its own kind
            row[base + 14] = 0.5 * bool(re.match(r"\s*(?:[-*+>:]+\s|\*\*)", text[prev_line + 1 : a]))
    return out


def snippets(seed: int = 5, n: int = 1200) -> tuple[np.ndarray, np.ndarray]:
    """Generated training nodes: markup and ordinary signs set into sentences of made-up words."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    def words(a: int = 2, b: int = 6) -> str:
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def sentence() -> str:
        return words(5, 12).capitalize() + "."

    def num() -> str:
        return str(rng.choice([rng.randint(1, 99), rng.randint(100, 99999)]))

    def page() -> str:
        n = str(rng.randint(1, 400))
        return n.translate(str.maketrans("0123456789", "०१२३४५६७८९")) if rng.random() < 0.3 else n

    def tag() -> str:
        t = rng.choice(["p", "div", "h2", "b", "i", "span", "td", "li", "sup", "font", "code", "a"])
        t = t.upper() if rng.random() < 0.2 else t
        at = rng.choice(["", "", f' class="{word()}"', f" id={word()}", f" href='/{word()}/{num()}'", f' data-x="{num()},{num()}"'])
        return rng.choice([f"<{t}{at}>{words()}</{t}>", f"<{t}{at}>{words()}</{t}>", f"{words()}</{t}>", f"<{t}{at}>{words()}", f"<{rng.choice(['br', 'br/', 'hr', 'img src=x.png'])}>"])

    def block(mark: list[str], extra=lambda: "") -> str:
        return "\n\n" + "\n".join(f"{rng.choice(mark)} {extra()}{words()}" for _ in range(rng.randint(1, 5))) + "\n\n"

    def table(row: str, n: int = 3) -> str:
        return "\n".join(row.format(words(), num()) for _ in range(rng.randint(1, n)))

    yes = [
        tag, tag, tag, tag, lambda: f"\n\n<ul><li>{words()}</li><li>{words()}</li></ul>\n\n", lambda: f"\n\n<table border=1><tr><th>{word()}</th></tr><tr><td>{num()}</td></tr></table>\n\n",
        lambda: f"\n\n<style>p {{color:{word()}}}</style>\n\n", lambda: f"<!-- {words()} -->", lambda: f"{word()}&{rng.choice(['nbsp', 'amp', 'gt', 'lt', 'times', 'copy', 'quot', 'mdash'])};{word()}", lambda: f"&#{rng.randint(100, 9000)};{num()}",
        lambda: f"&lt;{rng.choice(['b', 'i', 'p'])}&gt;{word()}&lt;/b&gt;", lambda: f"\n\n<pre><code>if {word()} &gt; {num()}:\n    {word()}({word()})</code></pre>\n\n",
        lambda: f"\n\n{'#' * rng.randint(1, 4)} {words()}{rng.choice(['', '', ' ###'])}\n\n", lambda: f"\n\n{words()}\n{rng.choice('=-') * rng.randint(3, 14)}\n\n", lambda: block(["-", "*", "+"]), lambda: block(["-", "*", "+"], lambda: num() + " "), lambda: block(["* ", "**", "*"], lambda: "[[") .replace("\n\n\n", "\n\n"),
        lambda: f"\n\n```\n{word()} {num()}: {words()}\n{word()}={num()}\n```\n\n", lambda: f"\n\n~~~\n{word()} < {num()} & {word()}\n~~~\n\n", lambda: f"`{word()}`", lambda: f"**{words(1, 2)}**", lambda: f"__{word()}__", lambda: f"*{words(1, 2)}*", lambda: f"_{word()}_", lambda: f"~~{word()}~~",
        lambda: f"[{words(1, 3)}](https://{word()}.example/{word()})", lambda: f"\n\n![{words()} {num()}](img_{num()}.png)\n\n", lambda: f"\n\n> {words()}.\n> **{word()}** {words()}\n\n", lambda: f"\n\n> {sentence()}\n\n",
        lambda: f"\n\n| {word()} | {word()} |\n|{rng.choice([':---', '---'])}|---:|\n{table('| {} | {} |')}\n\n", lambda: f"\n\n{rng.choice(['***', '* * *', '___', '_____'])}\n\n",
        lambda: f"\n\n{rng.choice(['==', '==='])} {words()} ==\n\n".replace("=== ", "== ", 1), lambda: f"[[{words()}]]", lambda: f"[[{word()}:{word()}.png|thumb|{words()}]] '''{word()}'''", lambda: f"{{{{{word()}|{word()}={num()}}}}}", lambda: f"{{{{{word()}}}}}", lambda: f"''{word()}''", lambda: f"'''{word()}'''",
        lambda: f"\n\n{{| class=\"{word()}\"\n! {word()} !! {word()}\n|-\n{table('| {} || {}' + chr(10) + '|-')}\n|}}\n\n", lambda: block([":", "*", "**"], lambda: "[[" + word() + "]] "), lambda: f"\n\n=== {words()} ===\n\n",
        lambda: f"\n\n\\{rng.choice(['section', 'subsection*', 'section*'])}{{{words()}}}\n\n", lambda: f"\\{rng.choice(['textbf', 'emph', 'underline', 'textit'])}{{{words(1, 2)}}}", lambda: f"\n\n\\begin{{itemize}}\n\\item {words()}\n\\item {words()}\n\\end{{itemize}}\n\n",
        lambda: f"\n\n\\begin{{equation}}\n{rng.choice('abcD')} = r \\times \\sum_{{i=1}}^{{n}} d_i\n\\end{{equation}}\n\n", lambda: f"\n\n\\begin{{tabular}}{{lr}}\n{words()} & {num()} \\\\\n{words()} & {num()} \\\\\n\\end{{tabular}}\n\n", lambda: f"\n\n\\begin{{verbatim}}\n{word()}={num()}\n\\end{{verbatim}}\n\n",
        lambda: f"$\\frac{{{num()}}}{{{num()}}}$", lambda: f"$x_{{{num()}}}$", lambda: f"$a = {num()}$", lambda: f"\\(x_{{5}} \\leq {num()}\\)", lambda: f"{num()}\\%", lambda: f"{word()}~\\ref{{{word()}}}", lambda: f"\\noindent\\textit{{{word()}}} \\hfill \\today",
    ]
    no = [
        lambda: f"{word()} < {num()} and > {num()} {word()}", lambda: f"{word()} <\n{num()} and\n> {num()} {word()}", lambda: f"<{word()} {word()}ed>", lambda: f"<{word()}\n{word()}>", lambda: f"{word()[:1].upper()} & {word()[:1].upper()} {word()}", lambda: f"US$ {num()} {words(1, 3)} US$ {num()}", lambda: f"${num()} {words(1, 2)} ${num()}.",
        lambda: f"{word()} #{num()} {words()} #{num()}", lambda: f"{num()} * {num()} {word()} {num()} * {num()}", lambda: f"{word()} {num()}\n* {num()} {words()}", lambda: f"{word()} {num()}\n- {num()} {words()}", lambda: f"{word().title()} | {word().title()} | {words(2, 3)}", lambda: f"{{{word()}}}", lambda: f"{{{words(2, 3)}}}",
        lambda: f"[{word()}]", lambda: f"[{num()}]", lambda: f"\n- {rng.randint(1, 40)} -\n", lambda: f"\n~ {rng.randint(1, 40)} ~\n", lambda: f"\nP a g e | {rng.randint(1, 40)}\n", lambda: f"{word()}_{word()}_{num()}.pdf", lambda: f"C:\\{word()}\\{word()}", lambda: f"D:\\{rng.choice(['item', 'text', 'date'])}\\{word()}\\{num()}.doc", lambda: f"{word()}_{word()[:2]}@{word()}.example",
        lambda: f"{word()}+{word()}@{word()}.example", lambda: "\n\n" + "_" * rng.randint(8, 300) + "\n\n", lambda: f"{word()} = {num()}", lambda: f"{word()}@{word()} {word()}!{word()} {word()}({word()}", lambda: f"{word()} ~{num()} {word()}", lambda: f"{word()} [at] {word()} [dot] {word()}", lambda: f"{word()}&{word()}", lambda: f"{num()} = {num()}", lambda: f"{word()} {word()}\n- {word()} {word()}\n{words()}", lambda: f"'{words()}' {word()}'s", lambda: f"{word()}\n+91-{num()}", lambda: f"** {num()} **" if rng.random() < 0.2 else f"{word()} * {word()}",
        lambda: f"\n\n- {page()} -\n{words().title()}\n- {page()} -\n", lambda: f"\n\n- {page()} -\n{sentence()}", lambda: "\n\n" + "_" * rng.randint(300, 4000) + "\n\n", lambda: f"{word()}\n> {num()} {words()}", lambda: f"<{num()} {word()}>", lambda: f"<{word()} {num()}>", lambda: f"{word()} ({word()} | {word()})", lambda: f"{word()} {word()}\n* {num()} {words()}",
    ]
    x, y = [], []
    for _ in range(n):
        want = rng.random() < 0.55
        body = rng.choice(yes if want else no)()
        text = " ".join(sentence() for _ in range(rng.randint(0, 2))) + " " + body + " " + " ".join(sentence() for _ in range(rng.randint(0, 2)))
        text = text.strip()
        if not want and rng.random() < 0.3:
            text += "\n\n" + rng.choice(no)() + " " + sentence()
        nodes = parse(text)
        if nodes:
            x.append(features(text, nodes))
            # code content and stray signs inside markup aren't markup of their own
            y += [float(want and n.lang != "") for n in nodes]
        plain = f"{sentence()} {rng.choice(no)()} {sentence()}"
        mixed = f"{plain}\n\n{rng.choice(yes)()}"
        nodes = parse(mixed)
        if nodes and rng.random() < 0.5:
            x.append(features(mixed, nodes))
            y += [float(n.start >= len(plain) and n.lang != "") for n in nodes]
    return np.concatenate(x), np.array(y)


@functools.cache
def fitted() -> BoostedTrees:
    return BoostedTrees(trees=60, depth=5, rate=0.25).fit(*snippets())


def decode(nodes: list[Node], p: np.ndarray) -> np.ndarray:
    """Best consistent labels: the two choices of each node are scored bottom-up over its subtree.

    A code node labelled markup makes its whole subtree content; both ends of a pair share a label, which sums
    their scores; rows are markup only with their table.
    """
    n = len(nodes)
    p = np.clip(p, 1e-4, 1 - 1e-4)
    gain = np.log(p) - np.log(1 - p)  # of yes over no
    own = gain.copy()
    for i, x in enumerate(nodes):
        if x.pair > i:
            own[i] = gain[i] + gain[x.pair]
            own[x.pair] = 0.0
    label = np.zeros(n, dtype=bool)
    best_free = np.zeros(n)  # best score of the subtree where nothing above forbids
    kids: list[list[int]] = [[] for _ in range(n)]
    for i, x in enumerate(nodes):
        if x.parent >= 0:
            kids[x.parent].append(i)
    takes = np.zeros(n, dtype=bool)
    for i in range(n - 1, -1, -1):
        x = nodes[i]
        if 0 <= x.pair < i:
            continue
        below = sum(best_free[k] for k in kids[i])
        same = sum(best_free[k] for k in kids[i] if nodes[k].lang == x.lang and nodes[k].code)
        yes = own[i] + (same if x.code else below)
        no = 0.0 if x.kind == "w_table" else below
        takes[i] = yes > no
        best_free[i] = max(yes, no)
    forbidden = np.zeros(n, dtype=bool)
    for i, x in enumerate(nodes):
        if 0 <= x.pair < i:
            label[i] = label[x.pair]
            continue
        up = x.parent
        blocked = up >= 0 and (forbidden[up] or (nodes[up].code and label[up]) or (nodes[up].kind == "w_table" and not label[up]))
        if blocked and up >= 0 and nodes[up].code and label[up] and x.code and x.lang == nodes[up].lang:
            blocked = False  # <pre><code>
        forbidden[i] = blocked
        label[i] = takes[i] and not blocked and x.lang != ""
    return label


def language_of(nodes: list[Node], label: np.ndarray, text: str) -> list[str]:
    """Language of each accepted node; list lines and bare quotes take that of what surrounds them."""
    out = [x.lang if y else "" for x, y in zip(nodes, label)]
    for i, x in enumerate(nodes):
        if not label[i]:
            continue
        if x.kind == "m_bullet":
            line = text[x.end : (text.find("\n", x.end) + 1 or len(text) + 1) - 1]
            star = text[x.start : x.end].strip()[0] == "*"
            beside = [nodes[k].lang for k in (i - 1, i + 1) if 0 <= k < len(nodes) and label[k] and nodes[k].kind in ("w_indent", "w_link")]
            if star and ("[[" in line or "'''" in line or beside):
                out[i] = "wiki"
        if x.parent >= 0 and label[x.parent] and x.lang != nodes[x.parent].lang and nodes[x.parent].kind in ("l_env", "w_table") and x.kind in ("m_bullet", "m_row", "b_sign"):
            out[i] = nodes[x.parent].lang
    return out


def clean(text: str, nodes: list[Node], label: np.ndarray) -> str:
    """Text without the accepted markup; headings, list lines, cells, code and formulas stay as plain lines."""
    done: dict[int, tuple[str, int]] = {}  # what stands for a node, and where the text goes on; spans after what is inside them
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        if label[i]:
            done[i] = put_for(text, nodes, x, done)
        elif x.inner:
            done[i] = render(text, nodes, x.start, x.end, x.inner, done), x.end
    inside = {k for x in nodes for k in x.inner}
    joined = render(text, nodes, 0, len(text), [i for i in range(len(nodes)) if i not in inside], done)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", joined)).strip()


def render(text: str, nodes: list[Node], a: int, b: int, ids: list[int], done: dict[int, tuple[str, int]]) -> str:
    """text[a:b] with what stands for the nodes ids; others are kept as they are."""
    out, at = [], a
    for i in ids:
        x = nodes[i]
        if i in done and x.start >= at and x.end <= b:
            put, go_on = done[i]
            out += [text[at : x.start], put]
            at = go_on
    out.append(text[at:b])
    return "".join(out)


def put_for(text: str, nodes: list[Node], x: Node, done: dict[int, tuple[str, int]]) -> tuple[str, int]:
    """What stands for an accepted node, and where the text goes on."""
    raw = text[x.start : x.end]

    def content(a: int, b: int) -> str:
        return render(text, nodes, a, b, x.inner, done)

    if x.kind == "h_tag":
        if x.name in ("style", "script") and not x.close:
            return "", nodes[x.pair].end if x.pair >= 0 else x.end
        if x.name == "li" and not x.close:
            return "\n- ", x.end
        if x.name in ("td", "th") and x.close:
            return " | ", x.end
        block = x.name in ("p", "div", "tr", "br", "ul", "ol", "table", "pre") or re.fullmatch(r"h[1-6]", x.name)
        return "\n" * bool(block), x.end
    if x.kind == "h_entity":
        return html.unescape(raw), x.end
    if x.kind in ("m_heading", "w_heading", "m_strong", "m_strike", "m_em", "w_quote", "m_link", "m_image"):
        return content(*content_of(x, text)), x.end
    if x.kind in ("m_bullet", "w_indent"):
        return "- ", x.end
    if x.kind in ("m_row", "w_row"):
        cells = [c.strip() for c in re.split(r"\|\||!!|\|", content(x.start, x.end).strip().strip("!|"))]
        return " | ".join(c for c in cells if c.strip("-")), x.end
    if x.kind == "m_code":
        return raw.strip("`"), x.end
    if x.kind in ("w_link", "w_call"):
        bars = [x.start + m.start() for m in re.finditer(r"\|", raw)]
        bars = [p for p in bars if not any(nodes[k].start <= p < nodes[k].end for k in x.inner)]
        parts = [(p + 1, q) for p, q in zip([x.start + 1, *bars], [*bars, x.end - 2])]
        if x.kind == "w_link":
            return content(*parts[-1]), x.end
        # of a template its unnamed values stay
        return " ".join(content(p, q).strip() for p, q in parts[1:] if "=" not in text[p:q]), x.end
    if x.kind == "l_math":
        return raw.strip("$").removeprefix("\\(").removesuffix("\\)").removeprefix("\\[").removesuffix("\\]"), x.end
    if x.kind == "l_cmd":
        if x.name == "item":
            return "- ", x.end
        if x.args and x.name not in ("ref", "label", "cite"):
            return " ".join(content(p, q) for p, q in x.args), x.end
        return raw if x.name in ("sum", "times", "frac", "leq", "geq") else "", x.end
    if x.kind == "l_esc":
        return raw[1:] if raw[1:2] not in ("\\", "") else "", x.end
    return "", x.end


def judge(texts: list[str], model: BoostedTrees) -> Iterator[tuple[list[Node], np.ndarray]]:
    """Nodes and labels of each text; the trees run once over the nodes of all texts."""
    parsed = [parse(t) if t else [] for t in texts]
    rows = [features(t, n) for t, n in zip(texts, parsed) if n]
    p = model.predict(np.concatenate(rows)) if rows else np.zeros(0)
    at = 0
    for nodes in parsed:
        yield nodes, decode(nodes, p[at : at + len(nodes)])
        at += len(nodes)


def detect(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per record and markup language found: id, markup, n_nodes."""
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(fitted())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = []
            for key, text, (nodes, label) in zip(ids, texts, judge(texts, model)):
                if not label.any():
                    continue
                count: dict[str, int] = {}
                for lang in language_of(nodes, label, text):
                    if lang:
                        count[lang] = count.get(lang, 0) + 1
                rows += [(key, lang, n) for lang, n in count.items()]
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.column(0).type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32())], names=[id_col, "markup", "n_nodes"])

    rows = df.select(id_col, text_col).filter(F.col(text_col).rlike(SIGNS) & ~F.col(text_col).rlike(SENTINEL))
    return rows.mapInArrow(run, f"{id_col} {kind}, markup string, n_nodes int")


def clean_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, clean_text for every row."""
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(fitted())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            sign = re.compile(SIGNS.replace("(?m)", ""), re.M)
            plain = re.compile(SENTINEL)
            due = [t if t and sign.search(t) and not plain.match(t) else "" for t in texts]
            done = [clean(t, n, y) if y.any() else raw for raw, t, (n, y) in zip(texts, due, judge(due, shared.value))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.string())], names=[id_col, "clean_text"])

    return df.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, clean_text string")


def p1_found(spark, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "sheet3"), "record_id", "full_extracted_text").select("record_id", "markup").distinct()


def p1_clean_text(spark, sf_dir: str) -> DataFrame:
    return clean_text(table(spark, sf_dir, "sheet3"), "record_id", "full_extracted_text").distinct()


QUERIES = {"p1_found": p1_found, "p1_clean_text": p1_clean_text}
ORACLES: dict[str, str] = {}

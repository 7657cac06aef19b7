"""Problem 6: personal information inside free text.

A text is read into candidate nodes: units (what has the form of an address, number or e-mail, in any spelling) and
the words of possible names. A skip-chain conditional random field labels them: node potentials are a log-linear
model over form, neighbouring words and name lists; chain edges join neighbouring words; skip edges join repeated
or similar nodes anywhere in the document. Loopy message passing runs over all nodes of a batch at once. A final
form check drops labels whose value can't be of that type (a phone number needs its digits).

Node weights are fitted on some SAMPLE_ROWS rows, drawn by hash and labelled by the detectors' tags; detectors miss values, so
untagged nodes weigh less. Edge potentials are fitted after them on the same rows by pseudo-likelihood. All rows and whole texts are searched.

Null and empty fields hold nothing. Repeated rows give repeated results, reported once by p6_found. A field equal to
another of its row isn't read twice. Columns not named are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import sample, table
from veilstone.llm.scan_noise import title_key

LABELS = ["O", "email", "phone", "identity_number", "street_address", "person_name"]
O, EMAIL, PHONE, IDENT, ADDRESS, NAME = range(6)
SAMPLE_ROWS = 5000  # rows of the training sample
SIZE = 1 << 15
MISSED, MISSED_NAME = 0.02, 0.08  # weight of untagged units and name words: detectors miss many
CHAIN, SKIP, SIMILAR = range(3)  # kinds of edges: neighbouring words, equal nodes, similar nodes
FIRST, MOST_EDGE = (1.2, 1.0, 0.8), 3.0  # potentials of equal labels along edges before fitting, and at most
LISTED_PAIR = 2.0  # potential of words of a run with two listed name words, or with one and an initial
ROUNDS, SETTLED = 50, 1e-3  # rounds of message passing at most, and the change of a message that ends them

# Chosen lists: titles, and words of ways and houses.
TITLES = set("shri sri smt mr mrs ms miss dr prof kumari km er adv late".split())
TITLES_DEVA = {"श्री", "श्रीमती", "सुश्री", "डॉ"}
_DIGIT = "0-9०-९০-৯۰-۹٠-٩௦-௯"
_LEVEL = str.maketrans("०१२३४५६७८९০১২৩৪৫৬৭৮৯۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩௦௧௨௩௪௫௬௭௮௯", "0123456789" * 5)
_WAYS = r"Road|Street|Gali|Marg|Colony|Lane|Cross|Layout|Residency|Nagar|Sector|Market|Block|Chowk|Path|Bagh|Enclave|Apartments?|Society|Avenue|Vihar|Phase|Main"
_AT, _DOT = r"(?:\s?[\[({<]\s?(?i:at)\s?[\])}>]\s?|\s+(?i:at)\s+)", r"(?:\s?[\[({<]\s?(?i:dot)\s?[\])}>]\s?|\s+(?i:dot)\s+)"
_SAYS_DOT = re.compile("dot", re.I)
# each pattern starts with a set of characters, so that the scan passes over the rest quickly; look-behinds follow
_L, _C = r"A-Za-z0-9._%+\-", f"{_DIGIT}OIl"
_MAIL = re.compile(rf"[{_L}](?<![{_L}].)[{_L}]*\s?@\s?[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{{2,}}")
_SPELT = re.compile(rf"[{_L}](?<![{_L}].)[{_L}]*{_AT}[A-Za-z0-9\-]+(?:{_DOT}[A-Za-z0-9\-]+)+")
_HOUSE = re.compile(
    rf"[FPRDHSQ](?<![\w#].)(?:lat|lot|oom|oor|ouse|hop|uarter|tr|\.\s?No)\b\.?\s*(?:No\b\.?\s*)?[A-Z]?-?[{_DIGIT}]+[A-Za-z]?(?:[-/][{_DIGIT}A-Za-z]+)*(?=(?:,|\s+(?:behind|near|opp|opposite|beside|ke)\b)\s*\S)"
    rf"|[मघफपकदবফவகمفہ](?<![ऀ-ॿঀ-৿஀-௿؀-ۿ].)(?:कान|र|्लैट|़्लैट|्लॉट|मरा|रवाज़ा|াড়ি|্ল্যাট|ீட்டு|தவு|کان|لیٹ)\s+(?:(?:नं|क्र|नंबर|संख्या|নং|எண்|نمبر)\.?\s*)?[{_DIGIT}]+[A-Za-z]?(?:[-/][{_DIGIT}A-Za-z]+)*(?=(?:[,،]|\s+के\b)\s*\S)"
)
_BARE_HOUSE = re.compile(rf"[{_DIGIT}](?<![\w#/.,:-].)(?<!\$\s.)[{_DIGIT}]{{0,3}}[A-Z]?(?:[-/][{_DIGIT}]+)?,\s+(?:[A-Z][a-z]+\s+){{1,3}}(?:{_WAYS})\b")
# how an address goes on after its house: in Latin letters over capitalised words, numbers and what stands near them,
# in other scripts over words up to one that goes on with the sentence
_NEAR = r"(?:behind|near|opp\.?|opposite|beside|next\s+to|off|ke|paas|peeche)\b(?:\s+(?:the|a)\b)?(?:\s+[a-z]+(?=[\s,.])){0,3}?"
_REST_LATIN = re.compile(rf",?\s+(?:(?:{_NEAR}(?=,|\.|\s+[A-Z]|\s*$))|(?:No|St|Dr|Mt|Sec|Nr|Opp)\.(?=\s*[A-Z{_DIGIT}])|[A-Z][A-Za-z]*(?:[-'’][A-Za-z{_DIGIT}]+)*\b\.?(?=,)|[A-Z][A-Za-z]*(?:[-'’][A-Za-z{_DIGIT}]+)*\b|[{_DIGIT}]+\b(?![/.]\d))")
_FIRST = re.compile(r"\s*[,،]?\s*[^\s,،।]+")
_GOES_ON = "है हैं था थी हूँ असा आहे आहेत होता होती में मध्ये पर से का की के को ने और व तथा येथे मेरा मेरी मेरे हम माझा माझे माझी फोन संपर्क एवं এ তে থেকে আমি আমার এবং আছে এর ہے ہیں تھا تھی میں پر سے کا کی کے کو نے اور میرا میری ஆகும் இல் என் எனது மற்றும்".split()
_REST_OTHER = re.compile(rf"(?:\s*[,،]\s*|[^\S\n]+|[^\S\n]*\n[^\S\n]*(?=\S))(?!(?:{'|'.join(_GOES_ON)})(?![ऀ-ॣॱ-ॿঀ-৿஀-௿؀-ۿ]))(?:(?:नं|क्र|নং|எண்)\.|[^\s,،।.;:!?()\[\]A-Za-z]+(?!\S*[@/]))")
_NUMBER = re.compile(rf"[(+{_C}](?<![\w@/.].)[+{_C}]*(?:[-\s)]{{1,2}}(?=[({_C}])[({_C}]+)*(?![\w@]|[/.][{_DIGIT}])")
_LETTERED = re.compile(
    rf"[A-Z](?<![A-Za-z0-9@/.].)(?:[A-Z]{{4}}\s?[{_C}]{{4}}\s?[A-Z]\b|[A-Z][-\s]?[0-9OI]{{2}}[-\s]?[A-Z]{{1,3}}[-\s]?[0-9OISB]{{4}}\b|[A-Z]{{0,5}}-?[0-9][0-9OIl]{{5,14}}\b)(?![@/])"
    rf"|[0-9I](?<![A-Za-z0-9@/.].)[A-Z]{{3}}[0-9OIB]{{4}}\b|[0-9](?<=\b[a-z]{{5}}.)[0-9]{{3}}[a-z]\b"
)
_ACCOUNT = re.compile(r"(?:account|a/c|acct|khata|खाता|खाते|খাতা|হিসাব|கணக்கு|اکاؤنٹ|کھاتہ)\S*(?:\s+(?:no|number|num|नं|नंबर|क्रमांक|संख्या|নং|எண்|نمبر)\b\.?)?\s*[:.#-]?\s*$", re.I)
_GROUP = re.compile(rf"[(+{_C}]+")
_TOKEN_L = re.compile(r"[A-Z](?:[A-Za-z@0159!(]*[A-Za-z])?(?:[-‐¬\xad~]\n[a-z]+)?")
_SEQ = re.compile(r"[A-Z](?<![\w@.+\\<\-].)(?:\.|(?:[A-Za-z@0159!(]*[A-Za-z])?(?:[-‐¬\xad~]\n[a-z]+)?\.?)(?:[ \t]*\n?[ \t]*(?:(?<=\.)|(?<=\s))[A-Z](?:[A-Za-z@0159!(]*[A-Za-z])?(?:[-‐¬\xad~]\n[a-z]+)?\.?)*(?![\w@+])")
_DEVA = re.compile(r"[ऀ-ॣॱ-ॿ]+")
_WORD_BEFORE = re.compile(r"(\S+)\s*$")
_MASKED = re.compile(r"[*]{2,}|X{3,}|REDACTED|^\W*(?:\w\.\s?)+\W*$")


def level(s: str) -> str:
    return s.translate(_LEVEL)


def value_key(s: str) -> str:
    """Form under which values meet whatever their spelling."""
    s = re.sub(r"\s*[\[(]?\b(at|dot)\b[\])]?\s*", lambda m: "@" if m.group(1).lower() == "at" else ".", s, flags=re.I) if re.search(r"dot[\s\])]", s, re.I) else s
    return re.sub(r"[\W_]+", "", level(s).casefold())


# The forms of identifiers, on text without spaces and hyphens, capital letters.
_FORMS = [
    ("pan", re.compile(r"[A-Z]{5}[\dOIl]{4}[A-Z]")), ("voter", re.compile(r"[A-Z]{3}[\dO]{7}")), ("passport", re.compile(r"[A-Z][\dO]{7,8}")), ("vehicle", re.compile(r"[A-Z]{2}[\dOS]{1,2}[A-Z]{1,3}[\dOSIB]{4}")),
    ("family", re.compile(r"[\dI][A-Z]{3}[\dOIB]{4}|[A-Z0-9]{8}(?<=\d)")), ("hospital", re.compile(r"[A-Z]{2,6}\d{5,15}")),
]


def forms_of(raw: str) -> tuple[str, str]:
    """(form, digits) of a number candidate; form '' if it has none of a known identifier or phone."""
    flat = re.sub(r"[-\s]", "", level(raw))
    digits = re.sub(r"\D", "", flat.translate(str.maketrans("OolI", "0011")) if sum(c.isdigit() for c in flat) >= 6 else flat)
    plus = raw.lstrip("(").startswith("+")
    letters = sum(c.isalpha() and c not in "OIl" for c in flat)
    if not letters:
        n = len(digits)
        if plus:
            return ("phone+", digits) if 11 <= n <= 13 else ("", digits)
        if n == 10:
            return ("phone10" if digits[0] in "6789" else "ten", digits)
        if n == 11:
            return ("phone0" if digits[0] == "0" and digits[1] in "6789" else "", digits)
        if n == 12:
            return ("twelve91" if digits[:2] == "91" and digits[2] in "6789" else "twelve", digits)
        if n == 16 and re.search(r"[-\s]", raw) or n == 16:
            return ("sixteen" + ("g" if re.search(r"\d[-\s]", raw) else ""), digits)
        return ("account" if 9 <= n <= 18 and n > 12 else "", digits)
    up = flat.upper()
    for name, form in _FORMS:
        if form.fullmatch(up):
            return name, digits
    return "", digits


LISTED = ("given", "surname", "seen", "i")
WITH_INITIAL = {"k|r=i|given", "k|r=i|surname", "k|r=i|seen"}


class Node:
    __slots__ = ("kind", "start", "end", "key", "feats", "seq", "form")

    def __init__(self, kind: str, start: int, end: int, key: str, feats: list[str], seq: int, form: str = ""):
        self.kind, self.start, self.end, self.key, self.feats, self.seq, self.form = kind, start, end, key, feats, seq, form


def words_before(text: str, at: int, n: int = 3) -> list[str]:
    out = text[max(0, at - 40) : at].split()
    if at > 40 and out and not text[at - 40].isspace():
        out = out[1:]
    return [w.lower() for w in out[-n:]]


def words_after(text: str, at: int, n: int = 2) -> list[str]:
    return [w.lower() for w in text[at : at + 28].split()[:n]]


ALONE = {"phone10", "phone0", "twelve", "twelve91"}  # forms of one group that is a value by itself
MOST = 18  # digits of the longest form


def numbers(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """(start, end, form) of the numbers in groups that stand side by side.

    Of all ways to part the groups, the one that leaves the fewest groups over, then the one with the fewest numbers.
    A group that is a number by itself is joined with others only under a prefix, groups of two paragraphs only if
    no part of them is a number, and a hyphen is cut only beside a number of one group.
    """
    groups = [g.span() for g in _GROUP.finditer(text, start, end)]
    n = len(groups)
    single = [forms_of(text[a:b])[0] for a, b in groups]
    seps = ["", *(text[x[1] : y[0]] for x, y in zip(groups, groups[1:])), ""]
    # best[i]: (groups left over, numbers, length of the piece at i, its form) from group i on
    best: list[tuple[int, int, int, str]] = [(0, 0, 0, "")] * (n + 1)
    inner: set[tuple[int, int]] = set()  # pieces with a form inside one paragraph
    for i in range(n - 1, -1, -1):
        best[i] = (best[i + 1][0] + 1, best[i + 1][1], 0, "")
        size, apart, alone = 0, False, False
        for j in range(i, n):
            a, b = groups[i][0], groups[j][1]
            size += sum(c not in "(+" for c in text[groups[j][0] : b])
            if size > MOST:
                break
            apart = apart or j > i and seps[j].count("\n") > 1
            alone = alone or single[j] in ALONE
            form = single[i] if i == j else forms_of(text[a:b])[0]
            if not form:
                continue
            if j > i and alone and not (form.startswith("phone") or form == "twelve91"):
                continue
            if ("-" in seps[i] or "-" in seps[j + 1]) and (i < j or form not in ALONE):
                continue
            if apart and any((x, y) in inner for x in range(i, j + 1) for y in range(x, j + 1)):
                continue
            if not apart:
                inner.add((i, j))
            got = (best[j + 1][0], best[j + 1][1] + 1, j + 1 - i, form)
            if got[:2] < best[i][:2] or got[:2] == best[i][:2] and got[2] > best[i][2]:
                best[i] = got
    out, i = [], 0
    while i < n:
        k = best[i][2]
        if k:
            out.append((groups[i][0], groups[i + k - 1][1], best[i][3]))
        i += max(1, k)
    return out


def address_end(text: str, start: int, end: int) -> int:
    """Where an address that starts with text[start:end] ends."""
    rest = _REST_OTHER if re.search(r"[ऀ-ॿঀ-৿஀-௿؀-ۿ]", text[start:end]) else _REST_LATIN
    m = rest.match(text, end) or _FIRST.match(text, end)
    while m:
        end = m.end()
        m = rest.match(text, end)
    return end


def units(text: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, form) of what has the form of an e-mail, address or number; earlier kinds take precedence."""
    if "@" in text:
        for m in _MAIL.finditer(text):
            yield "mail", m.start(), m.end(), "at"
    if _SAYS_DOT.search(text):
        for m in _SPELT.finditer(text):
            yield "mail", m.start(), m.end(), "spelled"
    for pattern, form in ((_HOUSE, "house"), (_BARE_HOUSE, "bare")):
        for m in pattern.finditer(text):
            yield "addr", m.start(), address_end(text, *m.span()), form
    for m in _LETTERED.finditer(text):
        a, b = m.span()
        if text[a].isdigit() and text[b - 1].islower():
            a -= 5  # a tax number in small letters
        if m := re.match(r"(?:ID|NO)[-\s]", text[a:b]):  # the end of the words before it
            a += m.end()
        form, _ = forms_of(text[a:b])
        if form:
            yield "num", a, b, form
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 9:
            continue
        found = numbers(text, *m.span())
        if not found and _ACCOUNT.search(text, max(0, m.start() - 40), m.start()):  # a short account number shows only by the words before it
            digits = re.sub(r"\D", "", level(m.group()))
            found = [(*m.span(), "account")] if 9 <= len(digits) <= 18 else []
        for a, b, form in found:
            if text[a] == "(" and ")" not in text[a:b]:
                a += 1
            yield "num", a, b, form


def read(text: str, names: dict[str, str]) -> list[Node]:
    """Candidate nodes of a text in order."""
    nodes: list[Node] = []
    taken: list[tuple[int, int]] = []
    seq = 0
    used: list[tuple[str, int, int, str]] = []
    for u in units(text):
        if all(u[2] <= x[1] or u[1] >= x[2] for x in used):
            used.append(u)
    used.sort(key=lambda u: u[1])
    for kind, a, b, form in used:
        taken.append((a, b))
        before, after = words_before(text, a), words_after(text, b)
        w1 = re.sub(r"[\d०-९]+", "0", before[-1]) if before else "^"
        w2 = re.sub(r"[\d०-९]+", "0", before[-2]) if len(before) > 1 else "^"
        feats = [f"{kind}", f"f={form}", f"f|1={form}|{w1}", f"1={kind}|{w1}", f"2={kind}|{w2} {w1}", f"a={kind}|{after[0] if after else '$'}", f"f|2={form}|{w2}"]
        seq += 1
        nodes.append(Node(kind, a, b, value_key(text[a:b]), feats, seq, form))
    ti = 0
    for m in _SEQ.finditer(text):
        a, b = m.span()
        while ti < len(taken) and taken[ti][1] <= a:
            ti += 1
        if ti < len(taken) and taken[ti][0] < b and taken[ti][1] > a:
            continue
        toks = [(x.start(), x.end()) for x in _TOKEN_L.finditer(text, a, b)]
        while toks and text[toks[0][0] : toks[0][1]].lower() in TITLES:
            toks = toks[1:]
        if len(toks) < 2 or all(names.get(text[x:y].lower()) == "never" for x, y in toks):
            continue
        seq += 1
        nodes += name_nodes(text, toks, names, seq)
    # words of unspaced-case scripts: only beside listed names, titles and where a paragraph is all there is
    if not text.isascii():
        toks = [(x.start(), x.end()) for x in _DEVA.finditer(text)]
        titles = {i for i, (a, b) in enumerate(toks) if text[a:b] in TITLES_DEVA}
        want = set()
        for i, (a, b) in enumerate(toks):
            w = text[a:b]
            if names.get(w, "never") != "never":
                want.update(range(max(0, i - 2), i + 3))
            elif i in titles:
                want.update(range(i + 1, i + 4))
            elif w in ("नाम", "नाव"):
                want.update([*range(max(0, i - 3), i), *range(i + 1, i + 4)])
        if toks and toks[-1][1] >= len(text.rstrip()) - 1:
            line = text.rfind("\n", 0, toks[-1][0])
            tail = [i for i in range(max(0, len(toks) - 3), len(toks)) if toks[i][0] > line]
            if line >= 0 and len(text[line:].split()) <= 3:
                want.update(tail)
        run: list[tuple[int, int]] = []
        for i in sorted(i for i in want if i < len(toks) and i not in titles):
            t = toks[i]
            if run and (text[run[-1][1] : t[0]].strip() or "\n\n" in text[run[-1][1] : t[0]]):
                seq += 1
                nodes += name_nodes(text, run, names, seq)
                run = []
            run.append(t)
        if run:
            seq += 1
            nodes += name_nodes(text, run, names, seq)
    nodes.sort(key=lambda n: n.start)
    return nodes


def name_nodes(text: str, toks: list[tuple[int, int]], names: dict[str, str], seq: int) -> list[Node]:
    out = []
    low = [re.sub(r"[-‐¬\xad~]\n", "", text[a:b]).lower() for a, b in toks]
    kinds = ["i" if len(w) == 1 else names.get(w, "-") for w in low]
    first, last = toks[0][0], toks[-1][1]
    before, after = words_before(text, first), words_after(text, last)
    line_start = text.rfind("\n", 0, first) + 1
    line_end = text.find("\n", last)
    alone = not text[line_start:first].strip() and not text[last : line_end if line_end >= 0 else len(text)].strip()
    final = last >= len(text.rstrip()) - 1
    w1, w2 = before[-1] if before else "^", before[-2] if len(before) > 1 else "^"
    after1 = after[0] if after else "$"
    known = sum(k in ("given", "surname") for k in kinds)
    for i, ((a, b), w, k) in enumerate(zip(toks, low, kinds)):
        left, right = (low[i - 1], kinds[i - 1]) if i else (w1, "^"), (low[i + 1], kinds[i + 1]) if i + 1 < len(low) else (after1, "$")
        feats = [
            "n", f"k={k}", f"k|l={left[1]}|{k}", f"k|r={k}|{right[1]}", f"w={w}", f"l={left[0]}", f"r={right[0]}", f"1={w1}|{len(toks)}", f"2={w2} {w1}", f"a={after1}",
            f"known={min(known, 2)}|{len(toks)}|{alone}|{final}", f"e={w[-3:]}", f"c={text[a:b].isupper()}|{alone}|{k}",
        ]
        out.append(Node("name", a, b, w, feats, seq, k))
    return out


class Field:
    """The random field: node weights, and message passing over a batch of documents."""

    def __init__(self):
        self.w = np.zeros((SIZE, len(LABELS)), dtype=np.float32)
        self.known: dict[str, int] = {}
        self.forms: dict[str, str] = {}
        self.theta = np.array(FIRST)

    def __getstate__(self):
        return {"w": self.w, "known": {}, "forms": {}, "theta": self.theta}

    def similar(self, key: str) -> str:
        """Form that a name shares with its misread spellings."""
        form = self.forms.get(key)
        if form is None:
            if len(self.forms) > 200_000:
                self.forms.clear()
            form = self.forms[key] = title_key(key)
        return form

    def index(self, f: str) -> int:
        i = self.known.get(f)
        if i is None:
            if len(self.known) > 400_000:
                self.known.clear()
            i = self.known[f] = zlib.crc32(f.encode("utf-8", "surrogatepass")) % SIZE
        return i

    def edges(self, doc: list[Node]) -> Iterator[tuple[int, int, int]]:
        """(node, node, kind): neighbouring words of a name, and each node with the last one like it.

        So edges grow with the nodes only, and evidence goes from one repeat to the next through the whole document.
        """
        seen: dict[tuple[str, str], int] = {}
        alike: dict[str, int] = {}
        for i, n in enumerate(doc):
            if i and n.kind == "name" and doc[i - 1].seq == n.seq:
                yield i - 1, i, CHAIN
            if len(n.key) > 1:
                same = seen.get((n.kind, n.key))
                if same is not None:
                    yield same, i, SKIP
                seen[n.kind, n.key] = i
                if n.kind == "name" and len(n.key) > 3:
                    form = self.similar(n.key)
                    like = alike.get(form)
                    if like is not None and like != same:
                        yield like, i, SIMILAR
                    alike[form] = i

    def fit_edges(self, docs: list[list[Node]], labels: list[int], steps: int = 200, rate: float = 0.5) -> "Field":
        """Edge potentials by pseudo-likelihood: each node's label given its features and the labels of its neighbours.

        Nodes weigh as in fit(); kinds of edges that the sample has none of keep their first value.
        """
        nodes = [n for d in docs for n in d]
        y = np.array(labels)
        near = np.zeros((len(nodes), len(FIRST), len(LABELS)))
        at = 0
        for d in docs:
            for i, j, k in self.edges(d):
                near[at + i, k, y[at + j]] += 1
                near[at + j, k, y[at + i]] += 1
            at += len(d)
        weight = np.where(y != O, 1.0, [MISSED_NAME if n.kind == "name" else MISSED for n in nodes])
        held = (near.sum(axis=(1, 2)) > 0).nonzero()[0]
        if not len(held):
            return self
        unary = np.full((len(held), len(LABELS)), -30.0)
        for r, i in enumerate(held):
            allowed = self.allowed(nodes[i])
            unary[r, allowed] = self.w[[self.index(f) for f in nodes[i].feats]].sum(axis=0)[allowed]
        near, y, weight = near[held], y[held], weight[held] / weight[held].sum()
        theta = np.array(FIRST)
        told = near[np.arange(len(y)), :, y]
        for _ in range(steps):
            z = unary + np.einsum("k,nkl->nl", theta, near)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            theta = np.clip(theta + rate * (weight[:, None] * (told - np.einsum("nl,nkl->nk", p, near))).sum(axis=0), 0.0, MOST_EDGE)
        self.theta = theta
        return self

    @staticmethod
    def allowed(n: Node) -> list[int]:
        if n.kind == "name":
            return [O, NAME]
        if n.kind == "mail":
            return [O, EMAIL]
        if n.kind == "addr":
            return [O, ADDRESS]
        if n.form.startswith("phone"):
            return [O, PHONE] + ([IDENT] if n.form == "phone10" else [])
        return [O, IDENT, PHONE] if n.form == "twelve91" else [O, IDENT]

    def fit(self, nodes: list[Node], labels: list[int], seed: int = 11, epochs: int = 8, rate: float = 0.25, l2: float = 1e-4) -> "Field":
        rng = np.random.default_rng(seed)
        idx = [np.array([self.index(f) for f in n.feats]) for n in nodes]
        y = np.array(labels)
        weight = np.where(y != O, 1.0, [MISSED_NAME if n.kind == "name" else MISSED for n in nodes])
        mask = np.full((len(nodes), len(LABELS)), -30.0)
        for i, n in enumerate(nodes):
            mask[i, self.allowed(n)] = 0.0
        square = np.full(self.w.shape, 1e-4)
        w = np.zeros(self.w.shape)
        for _ in range(epochs):
            order = rng.permutation(len(nodes))
            for i in range(0, len(order), 128):
                part = order[i : i + 128]
                flat = np.concatenate([idx[k] for k in part])
                row = np.repeat(np.arange(len(part)), [len(idx[k]) for k in part])
                z = mask[part].copy()
                np.add.at(z, row, w[flat])
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                err = -p
                err[np.arange(len(part)), y[part]] += 1
                err *= weight[part][:, None]
                use, at = np.unique(flat, return_inverse=True)
                grad = np.zeros((len(use), len(LABELS)))
                np.add.at(grad, at, err[row])
                grad -= l2 * len(part) * w[use]
                square[use] += grad**2
                w[use] += rate * grad / np.sqrt(square[use])
        self.w = w.astype(np.float32)
        return self

    def label(self, docs: list[list[Node]], extra: list[dict[int, int]] | None = None) -> list[np.ndarray]:
        """Labels of the nodes of each document. extra: per document, node number -> label that other evidence names."""
        flat_nodes = [n for d in docs for n in d]
        if not flat_nodes:
            return [np.zeros(0, dtype=int) for _ in docs]
        index = self.index
        flat = np.fromiter((index(f) for n in flat_nodes for f in n.feats), dtype=np.int64)
        sizes = np.array([len(n.feats) for n in flat_nodes])
        unary = np.add.reduceat(self.w[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0).astype(np.float64)
        mask = np.full(unary.shape, -30.0)
        edges, strength = [], []
        at = 0
        for k, d in enumerate(docs):
            for i, n in enumerate(d):
                mask[at + i, self.allowed(n)] = 0.0
            for i, j, k_edge in self.edges(d):
                edges.append((at + i, at + j))
                strength.append(self.theta[k_edge])
            for i, n in enumerate(d):
                if n.kind == "name" and n.form in LISTED and (n.feats[10].startswith("known=2") or n.feats[2].startswith("k|l=i") or n.feats[3] in WITH_INITIAL):
                    unary[at + i, NAME] += LISTED_PAIR
            for i, lab in (extra[k] if extra else {}).items():
                if mask[at + i, lab] == 0:
                    unary[at + i, lab] += 4.0
            at += len(d)
        belief = unary + mask
        if edges:
            e = np.array(edges)
            j = np.exp(np.array(strength))[:, None]
            src, dst = np.concatenate([e[:, 0], e[:, 1]]), np.concatenate([e[:, 1], e[:, 0]])
            back = np.concatenate([np.arange(len(e)) + len(e), np.arange(len(e))])
            gain = np.concatenate([j, j])
            msg = np.zeros((len(src), len(LABELS)))
            for _ in range(ROUNDS):
                total = belief.copy()
                np.add.at(total, dst, msg)
                cavity = total[src] - msg[back]
                cavity -= cavity.max(axis=1, keepdims=True)
                p = np.exp(cavity)
                was, msg = msg, np.log(p * (gain - 1) + p.sum(axis=1, keepdims=True))
                msg -= msg.mean(axis=1, keepdims=True)
                if np.abs(msg - was).max() < SETTLED:
                    break
            np.add.at(belief, dst, msg)
        best = belief.argmax(axis=1)
        out, at = [], 0
        for d in docs:
            out.append(best[at : at + len(d)])
            at += len(d)
        return out


def spans(text: str, nodes: list[Node], labels: np.ndarray) -> list[tuple[int, int, str]]:
    """(start, end, type) of the accepted values, 0-based; the form check comes here."""
    out: list[tuple[int, int, str]] = []
    i = 0
    while i < len(nodes):
        n, lab = nodes[i], labels[i]
        if lab == NAME:
            k = i
            while k + 1 < len(nodes) and labels[k + 1] == NAME and nodes[k + 1].seq == n.seq and not text[nodes[k].end : nodes[k + 1].start].replace(".", "").strip() and "\n\n" not in text[nodes[k].end : nodes[k + 1].start]:
                k += 1
            # the rest of a listed name beside what was accepted belongs to it
            lo, hi = i, k
            while lo > 0 and nodes[lo - 1].seq == n.seq and nodes[lo - 1].form in LISTED and not text[nodes[lo - 1].end : nodes[lo].start].strip(". "):
                lo -= 1
            while hi + 1 < len(nodes) and nodes[hi + 1].seq == n.seq and nodes[hi + 1].form in LISTED and not text[nodes[hi].end : nodes[hi + 1].start].strip(". "):
                hi += 1
            run = nodes[lo : hi + 1]
            while len(run) > 1 and len(run[-1].key) == 1:
                run = run[:-1]
            k, n = hi, run[0]
            if len(run) >= 2 and any(len(x.key) > 1 for x in run):
                out.append((n.start, run[-1].end, LABELS[NAME]))
            i = k + 1
            continue
        if lab != O:
            a = n.start
            if n.kind == "num" and lab == IDENT and text[a] in "(+":
                a += len(text[a : n.end]) - len(text[a : n.end].lstrip("(+"))
            out.append((a, n.end, LABELS[lab]))
        i += 1
    return out


TAG_TYPES = [("EMAIL", EMAIL), ("PHONE", PHONE), ("PERSON", NAME), ("NAME", NAME), ("ADDRESS", ADDRESS), ("STREET", ADDRESS)]
IDENT_TAGS = ("AADHAAR", "PAN", "VOTER", "PASSPORT", "UHID", "VEHICLE", "BANK", "CARD", "PPP")


def type_of_tag(tag: str) -> int:
    t = tag.upper()
    for word, kind in TAG_TYPES:
        if word in t:
            return kind
    return IDENT if any(w in t for w in IDENT_TAGS) else O


def tags_of(tagged: str | None) -> list[tuple[int, str]]:
    return [(type_of_tag(m.group(1)), m.group(2)) for m in (re.match(r"\[([^\]]+)\]\s*(.*)", p, re.S) for p in (tagged or "").split(" | ")) if m]


def masked_nodes(text: str, tagged: str | None, names: dict[str, str]) -> tuple[list[Node], dict[int, int]]:
    """Nodes of an anonymised value list; the tag at the same place in the tagged list is further evidence."""
    nodes: list[Node] = []
    extra: dict[int, int] = {}
    tags = tags_of(tagged)
    parts = text.split(" | ")
    at = 0
    for i, part in enumerate(parts):
        sub = at
        for piece in part.split(" / "):
            if piece.strip() and not _MASKED.search(piece):
                kind = tags[i][0] if len(tags) == len(parts) else None
                found = read(piece, names)
                if kind == NAME or kind is None and not found:
                    toks = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_][\wऀ-ॿঀ-৿஀-௿@!(]*", piece) if m.group().lower() not in TITLES and not (m.group()[0].isascii() and m.group()[0].islower())]
                    if len(toks) >= 2 and kind == NAME:
                        found = name_nodes(piece, toks, names, 0)
                for n in found:
                    if kind == O:
                        continue
                    n.start, n.end, n.seq = n.start + sub, n.end + sub, n.seq + 1000 * len(nodes) + 1
                    if kind is not None:
                        extra[len(nodes)] = kind
                    nodes.append(n)
                # nodes of one name stay one sequence
                for n in found:
                    if n.kind == "name":
                        n.seq = 10_000_000 + sub
            sub += len(piece) + 3
        at += len(part) + 3
    return nodes, extra


def train(df: DataFrame, name_parts: DataFrame, text_col: str, tags_col: str, sample_rows: int = SAMPLE_ROWS) -> tuple[Field, dict[str, str]]:
    """Fit on some sample_rows rows; names: the list (a small fixed table) and words of names tagged in the sample."""
    names = {r.token.lower(): r.part_kind for r in name_parts.filter("token IS NOT NULL").select("token", "part_kind").collect()}
    rows = sample(df.select(F.col(text_col).alias("t"), F.col(tags_col).alias("g")), sample_rows).filter("t IS NOT NULL AND g IS NOT NULL AND t NOT LIKE '[%'").collect()
    seen: dict[str, int] = {}
    for r in rows:
        for kind, value in tags_of(r.g):
            if kind == NAME:
                for w in re.findall(r"[^\W\d_][\wऀ-ॣॱ-ॿ]*", value):
                    seen[w.lower()] = seen.get(w.lower(), 0) + 1
    for w, n in seen.items():
        if n >= 2 and len(w) > 2 and w not in names and w not in TITLES:
            names[w] = "given" if n < 2 else "seen"
    # words of title-case runs met often and never in a tagged name: runs of these alone are no candidates
    common: dict[str, int] = {}
    for r in rows:
        for w in {w for m in _SEQ.finditer(r.t) for w in re.findall(r"[A-Z][A-Za-z]+", m.group())}:
            common[w.lower()] = common.get(w.lower(), 0) + 1
    names.update({w: "never" for w, n in common.items() if n >= 5 and w not in names and w not in seen})
    nodes, labels, docs = [], [], []
    for r in rows:
        values: dict[str, int] = {value_key(v): k for k, v in tags_of(r.g) if k != O}
        people = [re.sub(r"\s+", " ", v).lower() for k, v in tags_of(r.g) if k == NAME]
        docs.append(read(r.t, names))
        for n in docs[-1]:
            if n.kind == "name":
                around = re.sub(r"\s+", " ", re.sub(r"[-‐¬\xad~]\n", "", r.t[max(0, n.start - 40) : n.end + 40])).lower()
                lab = NAME if any(n.key in p and p in around for p in people) else O
            else:
                lab = values.get(n.key, O)
                if lab == O and len(n.key) > 5:
                    lab = next((k for v, k in values.items() if k in Field.allowed(n) and (v.startswith(n.key) or n.key.startswith(v) or v.endswith(n.key)) and len(v) > 4), O)
                if lab not in Field.allowed(n):
                    lab = O
            nodes.append(n)
            labels.append(lab)
    if not nodes:
        return Field(), names
    return Field().fit(nodes, labels).fit_edges(docs, labels), names


def find(df: DataFrame, id_col: str, fields: list[str], masked: str | None, tags_col: str | None, model: tuple[Field, dict[str, str]], redact: bool = False) -> DataFrame:
    """One row per open value: id, field, pii_type, start_pos (1-based), end_pos (inclusive), value.

    With redact, one row per input row instead: id and the fields with typed placeholders in place of the values.
    """
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)
    all_fields = fields + ([masked] if masked else [])
    out = f"{id_col} {kind}, " + (", ".join(f"{f} string" for f in all_fields) if redact else "field string, pii_type string, start_pos int, end_pos int, value string")
    cols = [id_col, *all_fields, *([tags_col] if tags_col else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, names = shared.value
        for whole in batches:
            for at in range(0, max(1, whole.num_rows), 1000):
                b = whole.slice(at, 1000)
                data = {c: b.column(i).to_pylist() for i, c in enumerate(cols)}
                docs, extra, where = [], [], []
                same: list[tuple[int, str, str]] = []
                for i in range(b.num_rows):
                    read_as: dict[str, str] = {}
                    for f in fields:
                        t = data[f][i]
                        if not t:
                            continue
                        if t in read_as:
                            same.append((i, f, read_as[t]))
                            continue
                        read_as[t] = f
                        docs.append(read(t, names))
                        extra.append({})
                        where.append((i, f, t))
                    if masked and data[masked][i]:
                        n, x = masked_nodes(data[masked][i], data[tags_col][i] if tags_col else None, names)
                        docs.append(n)
                        extra.append(x)
                        where.append((i, masked, data[masked][i]))
                found: dict[tuple[int, str], list[tuple[int, int, str]]] = {}
                for (i, f, t), nodes, labels in zip(where, docs, field.label(docs, extra)):
                    found[i, f] = spans(t, nodes, labels)
                for i, f, g in same:
                    found[i, f] = found[i, g]
                if redact:
                    arrays = [b.column(0)]
                    for f in all_fields:
                        done = []
                        for i, t in enumerate(data[f]):
                            for a, e, label in reversed(found.get((i, f), [])):
                                t = t[:a] + f"[{label.upper()}]" + t[e:]
                            done.append(t)
                        arrays.append(pa.array(done, pa.string()))
                    yield pa.RecordBatch.from_arrays(arrays, names=[id_col, *all_fields])
                else:
                    rows = [(data[id_col][i], f, label, a + 1, e, data[f][i][a:e]) for (i, f), s in found.items() for a, e, label in s]
                    cs = list(zip(*rows)) or [[]] * 6
                    types = [b.column(0).type, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cs, types)], names=[id_col, "field", "pii_type", "start_pos", "end_pos", "value"])

    return df.select(*cols).mapInArrow(run, out)


FIELDS, MASKED, TAGS = ["full_extracted_text", "spell_corrected_text"], "anonymized_pii_output", "detected_pii_with_tags"


def _model(spark, sf_dir: str):
    sheet = table(spark, sf_dir, "sheet3")
    return sheet, train(sheet, table(spark, sf_dir, "name_parts"), "full_extracted_text", TAGS)


def p6_found(spark, sf_dir: str) -> DataFrame:
    sheet, model = _model(spark, sf_dir)
    return find(sheet, "record_id", FIELDS, MASKED, TAGS, model).select("record_id", "field", "pii_type", F.col("start_pos").cast("bigint").alias("start_pos")).distinct()


def p6_redacted(spark, sf_dir: str) -> DataFrame:
    sheet, model = _model(spark, sf_dir)
    return find(sheet, "record_id", FIELDS, MASKED, TAGS, model, redact=True).distinct()


QUERIES = {"p6_found": p6_found, "p6_redacted": p6_redacted}
ORACLES: dict[str, str] = {}

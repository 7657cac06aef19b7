"""Problem 3: sentence boundaries across languages and scripts.

Candidate boundaries (terminal marks of any script) are classified by a maximum-entropy model over neighbouring
tokens, case, length, digits and script. It is trained on reliable boundaries: marks at the end of a paragraph and
marks no writer leaves open are boundaries; marks before a lower-case word are none. How often a token with its
mark ends paragraphs tells abbreviations that never do (titles, "No.") from those that may ("p.m.", "etc.").

Blank lines always end a sentence, single line ends never; marks inside quotations and brackets end nothing.
Marks without letters or digits after them (emoji) belong to the sentence before.

Training takes some SAMPLE_ROWS rows, drawn by hash; every text asked for is split whole. Null and empty texts have no
sentences; sentinel texts are one. Repeated rows give repeated results, reported once by p3_found.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import SENTINEL, flat_map, sample, table
from veilstone.llm.maxent import MaxEnt

SAMPLE_ROWS = 3000  # rows of the training sample
PAIRS = {'"': '"', "“": "”", "«": "»", "「": "」", "『": "』", "„": "“", "(": ")", "[": "]", "（": "）"}
CLOSERS = "\"”’»」』)\\]）*_'"
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_MARK = re.compile(rf"(?:[.!?।॥؟۔…]+[{CLOSERS}]*(?=\s|$)|[。！？।॥۔؟][。！？।॥۔؟!?]*[{CLOSERS}]*)")
_TOKEN = re.compile(r"\S+$")
_DIGITS = re.compile(r"\d+")
_SPACES = re.compile(r"\s*")
_NEXT = re.compile(r"\s*[\"“«「『(\[（'‘*_]*(\S+)")


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches between blank lines, without outer white space."""
    at = 0
    for m in [*_BLANK.finditer(text), None]:
        a, b = at, m.start() if m else len(text)
        at = m.end() if m else b
        part = text[a:b]
        a, b = a + len(part) - len(part.lstrip()), b - len(part) + len(part.rstrip())
        if b > a:
            yield a, b


def enclosed(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Spans inside quotations or brackets of one paragraph; openers whose closer is missing count for nothing."""
    spans, stack = [], []
    for i in range(a, b):
        c = text[i]
        if c not in '"“”«»「」『』„()[]（）':
            continue
        if stack and c == PAIRS.get(text[stack[-1]]):
            spans.append((stack.pop(), i))
        elif c in PAIRS:
            stack.append(i)
        else:
            for d in range(len(stack) - 1, -1, -1):
                if PAIRS[text[stack[d]]] == c:
                    spans.append((stack[d], i))
                    del stack[d:]
                    break
    return sorted(s for s in spans)


def shape(c: str) -> str:
    if not c:
        return "none"
    if c.isdigit():
        return "digit"
    if c.islower():
        return "lower"
    if c.isupper():
        return "upper"
    if c.isalpha() or unicodedata.category(c)[0] == "M":
        o = ord(c)
        return "deva" if 0x900 <= o < 0x980 else "beng" if 0x980 <= o < 0xA00 else "taml" if 0xB80 <= o < 0xC00 else "arab" if 0x600 <= o < 0x780 else "han" if o > 0x3000 else "letter"
    return "sign"


def token_key(word: str, mark: str) -> str:
    """A token with its mark, digits levelled."""
    return _DIGITS.sub("0", word.lower()) + mark


class Candidate:
    __slots__ = ("start", "end", "mark", "token", "next", "features", "last")


def candidates(text: str, a: int, b: int, ends: Counter, total: Counter) -> Iterator[Candidate]:
    """Marks of one paragraph that stand outside quotations and brackets, with their features."""
    inside = enclosed(text, a, b)
    starts, furthest = [x for x, _ in inside], list(accumulate((y for _, y in inside), max))
    opened = {y: x for x, y in inside}  # by their closers
    for m in _MARK.finditer(text, a, b):
        s, e = m.span()
        closes = False
        k = bisect_left(starts, s)
        if k and furthest[k - 1] >= s:
            # the outermost enclosure must be closed by this very candidate
            if furthest[k - 1] >= e:
                continue
            closes = text[min((opened[y], y) for y in range(s, e) if opened.get(y, s) < s)[1]] in '"”»」』'
        c = Candidate()
        c.start, c.end, c.mark = s, e, text[s]
        tok = _TOKEN.search(text, max(a, s - 40), s)
        word = (tok.group() if tok else "").lstrip("\"“«「『([（'")
        nxt = _NEXT.match(text, e, b)
        following = nxt.group(1) if nxt else ""
        c.token, c.next, c.last = word, following, e >= b
        key = token_key(word, c.mark)
        n, k = total[key], ends[key]
        rate = "new" if n < 3 else "never" if k == 0 else "rare" if k * 20 < n else "often"
        then, before = shape(following[:1]), shape(word[-1:])
        size = str(min(len(word), 8))
        inner = "dotted" if "." in word else "plain"
        initial = "initial" if len(word) == 1 and word.isupper() else "word"
        c.features = [
            "bias", f"mark={c.mark}", f"marks={text[s:e][:3]}", f"end={rate}", f"then={then}", f"before={before}", f"size={size}",
            f"end|then={rate}|{then}", f"mark|then={c.mark}|{then}", f"before|size|inner={before}|{size}|{inner}", f"quote={closes}|{then}",
            f"{initial}|{then}", f"token={key}", f"token|then={key}|{then}", f"mark|before={c.mark}|{before}", f"case={word[:1].isupper()}|{size}|{then}",
        ]
        yield c


def reliable(c: Candidate) -> int | None:
    """Label of a candidate that needs no model: 1 boundary, 0 none, null unsure."""
    then = shape(c.next[:1])
    if c.last:
        return 1
    if then == "lower" and c.next[:1].isascii():
        return 0
    if c.mark in "।。！？۔॥" and then not in ("digit", "none", "sign") and "quote=True" not in c.features[10]:
        return 1
    if "quote=True" in c.features[10]:
        return 1 if then == "upper" else 0
    if c.mark in "!?" and then == "upper":
        return 1
    if c.mark == "." and then == "digit" and not c.token[-1:].isdigit() and "end=never" in c.features[3]:
        return 0
    if len(c.token) == 1 and c.token.isupper():
        return 0
    return None


class SentenceModel:
    def __init__(self):
        self.ends, self.total, self.model = Counter(), Counter(), MaxEnt()

    def fit(self, texts: list[str]) -> "SentenceModel":
        for t in texts:
            for a, b in paragraphs(t):
                for c in candidates(t, a, b, self.ends, self.total):
                    # where a lower-case word or number follows, the token shows itself as an abbreviation
                    key = token_key(c.token, c.mark)
                    self.total[key] += 1
                    self.ends[key] += c.last
        rows, y = [], []
        for t in texts:
            for a, b in paragraphs(t):
                cs = list(candidates(t, a, b, self.ends, self.total))
                for c in cs:
                    label = reliable(c)
                    if label is None:
                        key = token_key(c.token, c.mark)
                        n, k = self.total[key], self.ends[key]
                        # a token seen often that never ends a paragraph doesn't end a sentence; one that does may
                        dotted = "." in c.token and len(c.token) <= 6
                        if k == 0 and (n >= 8 and len(c.token) <= 4 or n >= 3 and dotted):
                            label = 0
                        elif dotted and k == 0:
                            continue
                        elif k >= 2 or len(c.token) > 4:
                            label = 1
                        else:
                            continue
                    feats = c.features
                    if c.last:  # what comes next isn't known at a paragraph's end: learn the token, not the end
                        feats = [f for f in feats if "then" not in f and f[:5] not in ("quote", "case=") and not f.startswith(("initial|", "word|"))]
                    rows.append(feats)
                    y.append(label)
        self.model.fit(rows, y)
        # only tokens seen often enough to matter are kept
        self.total = Counter({k: n for k, n in self.total.items() if n >= 3})
        self.ends = Counter({k: self.ends[k] for k in self.total})
        return self

    def split(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the sentences, 0-based and half-open."""
        out: list[tuple[int, int]] = []
        for a, b in paragraphs(text):
            start = a
            last = next((i for i in range(b - 1, a - 1, -1) if text[i].isalnum()), -1)
            first = a  # of the letters and digits from start on
            for c in candidates(text, a, b, self.ends, self.total):
                if c.last or self.model.score(c.features) > 0:
                    if c.end > last:
                        break
                    while first < c.end and not text[first].isalnum():
                        first += 1
                    if first < c.end:
                        # marks that follow before the next word belong here (emoji)
                        k = c.end
                        for i in range(c.end, b):
                            x = text[i]
                            if unicodedata.category(x) in ("So", "Sk", "Cf", "Mn") and not x.isalnum() or x in CLOSERS and i == k:
                                k = i + 1
                            elif not x.isspace():
                                break
                        out.append((start, k))
                        start = first = _SPACES.match(text, k, b).end()
            if any(x.isalnum() for x in text[start:b]) or not out:
                out.append((start, b))
            elif start < b and out:
                out[-1] = (out[-1][0], b) if start > a else out[-1]
        return out


def train(df: DataFrame, text_col: str, sample_rows: int = SAMPLE_ROWS) -> SentenceModel:
    rows = sample(df.select(F.col(text_col).alias("t")), sample_rows).filter(F.col("t").isNotNull() & ~F.col("t").rlike(SENTINEL))
    return SentenceModel().fit([r.t for r in rows.collect()])


def split_sentences(df: DataFrame, id_col: str, text_col: str, model: SentenceModel) -> DataFrame:
    """id, sentence_no, start_pos, end_pos (1-based, inclusive) and sentence of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def step(key, text):
            for i, (a, b) in enumerate(m.split(text), 1):
                yield key, i, a + 1, b, text[a:b]

        return step

    rows = df.select(id_col, text_col).filter(F.length(text_col) > 0)
    return flat_map(rows, make, f"{id_col} {kind}, sentence_no int, start_pos int, end_pos int, sentence string")


def p3_sentences(spark, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "sheet3")
    return split_sentences(sheet, "record_id", "full_extracted_text", train(sheet, "full_extracted_text")).distinct()


def p3_found(spark, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "sheet3")
    model = train(sheet, "full_extracted_text")
    checked = sheet.select("record_id", "full_extracted_text").join(table(spark, sf_dir, "sentence_check").select("record_id"), "record_id", "left_semi")
    return split_sentences(checked, "record_id", "full_extracted_text", model).select("record_id", "end_pos").distinct()


def p3_rejoined(spark, sf_dir: str) -> DataFrame:
    """Round trip: the MD5 of the letters, marks and digits of each record's sentences put together again; signs alone make no sentence."""
    parts = p3_sentences(spark, sf_dir).filter("record_id IS NOT NULL").select("record_id", "sentence_no", F.regexp_replace("sentence", f"[^{_KEPT}]+", "").alias("s")).filter("s <> ''")
    whole = parts.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("sentence_no", "s"))).alias("p"))
    return whole.select("record_id", F.md5(F.array_join(F.transform("p", lambda x: x["s"]), "").cast("binary")).alias("text_md5"))


_KEPT = r"\p{L}\p{M}\p{N}"
QUERIES = {"p3_found": p3_found, "p3_sentences": p3_sentences, "p3_rejoined": p3_rejoined}
ORACLES = {
    "p3_rejoined": rf"""SELECT DISTINCT record_id, md5(regexp_replace(full_extracted_text, '[^{_KEPT}]+', '', 'g')) AS text_md5 FROM sheet3
        WHERE record_id IS NOT NULL AND regexp_replace(full_extracted_text, '[^{_KEPT}]+', '', 'g') <> ''""",
}

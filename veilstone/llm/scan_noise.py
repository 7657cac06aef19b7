"""Problem 4: noise in text from scanned pages.

Noisy channel: every word is read as a true word times the probability that its characters were confused. How often
each pair of characters is confused is estimated from the corpus: rare words are aligned with frequent ones that they
become with one confused character put right. The language model is the corpus itself, its exact word and word-pair counts over all rows. These stay distributed: words
that can be read for each other share a form (see CLASSES) and meet under it, which gives every word its candidates;
these are joined with the texts that hold the word, and the counts that a text's lines ask for are joined with it.
Each line is decoded by Viterbi over the candidate words. A word counts as misread if the decoded word differs from it.
Own occurrences are left out of a word's count, so the rule is the same at every corpus size.

Lines that hold only a page number, title lines repeated over the pages and words parted at line ends are found by
their form and place; whether a hyphen belongs to the word is asked of the same counts.

Null, empty and sentinel texts have no noise and are repaired to themselves. Repeated rows give repeated results,
reported once by p4_found. Columns besides id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import SENTINEL, flat_map, table
from veilstone.llm.sketch import key_counts, key_hash

# A chosen list: characters a scanner confuses, read form -> true forms.
CONFUSED = {
    "0": ["o"], "1": ["l", "i"], "!": ["i", "l"], "|": ["l", "i"], "5": ["s"], "9": ["g"], "6": ["b"], "8": ["b"], "@": ["a"], "$": ["s"], "(": ["c"], "c": ["e"], "f": ["t"], "b": ["h"], "ii": ["u"], "cl": ["d"],
    "rn": ["m"], "vv": ["w"], "li": ["h"], "nn": ["m"], "q": ["g"],
}
SIGNS = set("0156789!|@$(")
# Each read form and its true forms come to one form if these are replaced: 'rn' and 'm' both to 'nn'.
CLASSES = ("i1!|e(rf5$90@", "llllccntssgoa"), [("q", "g"), ("u", "ll"), ("h", "ll"), ("b", "ll"), ("6", "ll"), ("8", "ll"), ("d", "cl"), ("m", "nn"), ("w", "vv")]
EVEN = {(read, true): math.log(0.01) for read, ways in CONFUSED.items() for true in ways}  # costs where none are estimated
_CONFUSABLE = re.compile("|".join(re.escape(x) for x in CONFUSED))
LOG_CONFUSE, LOG_TWO = math.log(0.01), math.log(0.001)  # one confused character, two of them: means over all pairs
RARE, FREQUENT, STEADY = 2, 20, 20.0  # counts of words aligned for the estimate, and how many alignments its mean weighs
LOG_SIGN = math.log(1e-4)  # that a true word holds a digit or sign between letters
UNDONE = 60  # characters up to which all ways to put a word right are tried; longer ones are compared with known words
ALPHA = 0.05  # count of a word never seen
PAIR = 0.7  # weight of the word-pair model against single words
MARKS = "-‐‑¬­~–"
_D = "0-9०-९০-৯۰-۹٠-٩௦-௯"
_PAGE = re.compile(
    rf"(?:(?:page|pg\.?|p\.|पृष्ठ|पान|पृ\.|صفحہ|পৃষ্ঠা|பக்கம்|第)\s*[-:.|]?\s*[{_D}OlI]{{1,5}}(?:\s*(?:of|/|का|में से|میں سے)\s*[{_D}OlI]{{1,5}})?(?:\s*[页頁])?"
    rf"|p\s?a\s?g\s?e\s*\|?\s*[{_D}OlI]{{1,5}}|[{_D}]{{1,5}}\s*/\s*[{_D}]{{1,5}}|[{_D}]{{1,5}}\s*(?:ページ|页|頁)"
    rf"|[-~–—=*]+\s*(?:[{_D}OlI]{{1,4}}|[ivx]{{1,7}})\s*[-~–—=*]+|[\[(]\s*(?:[{_D}OlI]{{1,4}}|[ivx]{{1,7}})\s*[\])])",
    re.I,
)
_BARE = re.compile(rf"[{_D}]{{1,4}}|[ivx]{{1,7}}|[IVX]{{1,7}}")
_STRIP_L, _STRIP_R = "\"'“‘([{«<*_>#", "\"'”’)]}»>.,;:?!*_…।"
_LATIN = re.compile(r"[a-z]")
_CODE = re.compile(r"[@/\\=&#<>{}+_]|\d.*\d|\.\w|-\d|\d-")
# a number with a letter read for a digit; four digits and a letter end a tax number
_NUMBER = re.compile(r"(?=[^A-Za-z]*[OolI])(?!\d{4}[A-Z]$)[+(]{0,2}[\dOolI][\dOolI,.\-)(]{3,}|[A-Z\d/-]*\d[OolISB]\d[A-Z\d/-]*")
_END = re.compile(r"[.!?।॥。！？۔؟…:;,]\W*$")


class Numbers(dict):
    """What number() makes of a token, kept."""

    def __missing__(self, raw: str) -> str | None:
        if len(self) > 300_000:
            self.clear()
        self[raw] = x = None if raw.isalpha() else Cleaner.number(raw)
        return x


class Words(dict):
    """Normalised form of a raw token, kept; '' for tokens that hold no Latin word."""

    def __init__(self):
        super().__init__()
        self.numbers = Numbers()

    def __missing__(self, raw: str) -> str:
        w = raw.lower().rstrip(_STRIP_R)
        if w[:1] != "(" or not _LATIN.match(w[1:2]) or ")" in w:
            w = w.lstrip(_STRIP_L)
        w = w.lstrip("\"'“‘[{«<")
        if len(w) < 2 or not _LATIN.search(w) or _is_code(w):
            w = ""
        if len(self) > 300_000:
            self.clear()
        self[raw] = w
        return w


def _is_code(w: str) -> bool:
    """Addresses, numbers, identifiers and markup aren't words; a single '@' between letters may be a misread letter."""
    if "@" in w and "." not in w and not re.search(r"\d", w):
        w = w.replace("@", "a")
    return bool(_CODE.search(w))


def keys_maker():
    words = Words()

    def keys(text: str) -> list[str]:
        tokens = [words[t] for t in text.split()]
        out = [t for t in tokens if t]
        out += [a + " " + b for a, b in zip(tokens, tokens[1:]) if a and b]
        return out

    return keys


def language_model(df: DataFrame, text_col: str) -> DataFrame:
    """(key_hash, key, n): exact word and word-pair counts of all rows; key is null for pairs."""
    return key_counts(df.filter(F.length(text_col) > 0), text_col, keys_maker, named=lambda k: " " not in k).persist(StorageLevel.DISK_ONLY)


def same_form(word: Column) -> Column:
    """The form that words share that can be read for each other, by any number of confused characters."""
    out = F.translate(word, *CLASSES[0])
    for read, form in CLASSES[1]:
        out = F.replace(out, F.lit(read), F.lit(form))
    return out


def of_same_form(counts: DataFrame) -> DataFrame:
    """(words): the words with their counts that can be read for each other."""
    words = counts.filter("key IS NOT NULL")
    return words.groupBy(same_form(F.col("key")).alias("form")).agg(F.collect_list(F.struct("key", "n")).alias("words")).filter("size(words) > 1").select("words")


def confusion_costs(counts: DataFrame) -> dict[tuple[str, str], float]:
    """(read, true) -> log probability, estimated from rare words aligned with frequent ones; at most one row for each pair of CONFUSED is collected."""

    def make():
        def step(words):
            known = {x["key"]: x["n"] for x in words}
            frequent = {w for w, n in known.items() if n >= FREQUENT}
            channel = Channel(1, known, {})
            for w in known if frequent else ():
                if known[w] <= RARE and len(w) > 2:
                    yield from {(read, true) for c, read, true in channel.undo(w) if c in frequent}

        return step

    seen = flat_map(of_same_form(counts), make, "read string, true string").groupBy("read", "true").count()
    return costs_of({(r["read"], r["true"]): r["count"] for r in seen.collect()})


def costs_of(seen: dict[tuple[str, str], int]) -> dict[tuple[str, str], float]:
    """Shares of the pairs among all alignments, smoothed by their mean, about LOG_CONFUSE."""
    pairs = [(read, true) for read, ways in CONFUSED.items() for true in ways]
    mean = sum(seen.values()) / len(pairs)
    return {p: LOG_CONFUSE + math.log((seen.get(p, 0) + STEADY) / (mean + STEADY)) for p in pairs}


def all_candidates(counts: DataFrame, total: int) -> DataFrame:
    """(word, options) of the words that have other candidates than themselves."""
    groups, costs = of_same_form(counts), confusion_costs(counts)

    def make():
        def step(words):
            channel = Channel(total, {x["key"]: x["n"] for x in words}, {}, costs=costs)
            for x in words:
                found = channel.search(x["key"])
                if len(found) > 1:
                    yield x["key"], [{"word": c, "p": p} for c, p in found]

        return step

    return flat_map(groups, make, "word string, options array<struct<word:string,p:double>>")


def alignment(w: str, c: str, most: int, costs: dict[tuple[str, str], float]) -> float | None:
    """Least cost of turning w into c by up to most confused characters put right; None if it can't be.

    A read form and its true one differ in their first character, so each stands where the words part.
    """
    i = 0
    while i < len(w) and i < len(c) and w[i] == c[i]:
        i += 1
    if w[i:] == c[i:]:
        return 0.0
    if not most:
        return None
    ways = [(read, true, rest) for read, true in costs if w.startswith(read, i) and c.startswith(true, i) if (rest := alignment(w[i + len(read) :], c[i + len(true) :], most - 1, costs)) is not None]
    return max((costs[read, true] + rest for read, true, rest in ways), default=None)


class Channel:
    """Candidates of words and the decoding of lines."""

    def __init__(self, total: int, counts: dict, options: dict[str, list[tuple[str, float]]], of=lambda k: k, costs: dict[tuple[str, str], float] | None = None):
        """counts: by what of() makes of a word or pair; options: candidates of the words that have any; costs: see confusion_costs()."""
        self.total, self.counts, self.options, self.of, self.costs = max(1, total), counts, options, of, costs or EVEN

    def n(self, key: str) -> int:
        return self.counts.get(self.of(key), 0)

    def one(self, w: str) -> dict[str, float]:
        """Words that w becomes with one confused character put right, with its cost; long words are compared with the others of their form."""
        if len(w) > UNDONE:
            return {c: x for c in self.counts if c != w and (x := alignment(w, c, 1, self.costs)) is not None}
        out: dict[str, float] = {}
        for c, read, true in self.undo(w):
            out[c] = max(out.get(c, -math.inf), self.costs[read, true])
        return out

    def two(self, w: str, first: dict[str, float]) -> dict[str, float]:
        """As one(), with two characters."""
        if len(w) > UNDONE:
            found = {c: x for c in self.counts if c != w and c not in first and (x := alignment(w, c, 2, self.costs)) is not None}
        else:
            found = {}
            for a, cost in first.items():
                for c, read, true in self.undo(a):
                    if c not in first and c != w:
                        found[c] = max(found.get(c, -math.inf), cost + self.costs[read, true])
        return {c: x + LOG_TWO - 2 * LOG_CONFUSE for c, x in found.items()}

    def undo(self, w: str) -> Iterator[tuple[str, str, str]]:
        """(word, read, true) for each way to put one confused character of w right."""
        for i in range(len(w)):
            for size in (1, 2):
                read = w[i : i + size]
                if len(read) == size:
                    for true in CONFUSED.get(read, ()):
                        yield w[:i] + true + w[i + size :], read, true

    def prior(self, w: str, own: int = 0) -> float:
        return math.log(max(self.n(w) - own, 0) + ALPHA) - math.log(self.total)

    @staticmethod
    def itself(w: str) -> tuple[str, float]:
        return w, LOG_SIGN if any(c in SIGNS for c in w) and not w[-1:].isdigit() else 0.0

    def candidates(self, w: str) -> list[tuple[str, float]]:
        return self.options.get(w) or [self.itself(w)]

    def search(self, w: str) -> list[tuple[str, float]]:
        """True words for a read word with the channel's log probability; the read word itself comes first."""
        odd = any(c in SIGNS for c in w)
        itself = self.itself(w)
        out = [itself]
        stay = self.prior(w, 1) + itself[1]
        # a word so frequent that no other can outdo it has no candidates
        if self.n(w) * math.exp(LOG_CONFUSE) < self.total * 0.08 or odd:
            first = self.one(w) if len(w) > 2 else {}
            for c, cost in first.items():
                if self.n(c) > 1 and self.prior(c) + cost > stay - 3 and not any(x in SIGNS for x in c):
                    out.append((c, cost))
            if len(out) == 1 and len(w) > 3:
                for c, cost in self.two(w, first).items():
                    if self.n(c) > 2 and self.prior(c) + cost > stay and not any(x in SIGNS for x in c):
                        out.append((c, cost))
            out = out[:1] + sorted(out[1:], key=lambda x: (-(self.prior(x[0]) + x[1]), x[0]))
        return out

    def asked(self, line: list[str]) -> Iterator[str]:
        """Words and pairs whose counts decide on a line; elsewhere all its readings have the same."""
        if self.options.keys().isdisjoint(line):
            return
        options = [[c for c, _ in self.options[w]] if w in self.options else [w] for w in line]
        for i, o in enumerate(options):
            before = options[i - 1] if i else [""]
            if len(o) > 1 or len(before) > 1:
                yield from (c for c in o + before if c)
                yield from (a + " " + b for a in before for b in o if a and b)

    def step(self, a: str, b: str, own: int) -> float:
        """log P(b | a): word pairs backed by single words; own occurrences are left out."""
        single = (max(self.n(b) - own, 0) + ALPHA) / self.total
        if not a:
            return math.log(single)
        pair = max(self.n(a + " " + b) - own, 0) / max(self.n(a), 1)
        return math.log(PAIR * pair + (1 - PAIR) * single)

    def decode(self, line: list[str]) -> list[str]:
        """Most likely true words of one line."""
        if self.options.keys().isdisjoint(line):
            return line
        options = [self.candidates(w) if w else [("", 0.0)] for w in line]
        best = [(self.step("", c, int(c == line[0])) if c else 0.0) + p for c, p in options[0]]
        back: list[list[int]] = []
        for i in range(1, len(line)):
            now, came = [], []
            for c, p in options[i]:
                if not c:
                    j = max(range(len(best)), key=best.__getitem__)
                    now.append(best[j])
                else:
                    own = int(c == line[i])
                    scores = [b + self.step(a, c, own and int(a == line[i - 1] or not a)) for b, (a, _) in zip(best, options[i - 1])]
                    j = max(range(len(scores)), key=scores.__getitem__)
                    now.append(scores[j] + p)
                came.append(j)
            best, back = now, [*back, came]
        j = max(range(len(best)), key=best.__getitem__)
        out = [options[-1][j][0]]
        for i in range(len(line) - 2, -1, -1):
            j = back[i][j]
            out.append(options[i][j][0])
        return out[::-1]


_CANON = str.maketrans("0159@!|($ecfthb", "olsgaillseettbb")


def title_key(line: str) -> str:
    """Form under which a title line and its copies meet: case, spacing and confusable characters aside."""
    k = " ".join(line.casefold().split())
    for a, b in (("rn", "m"), ("cl", "d"), ("ii", "u"), ("vv", "w")):
        k = k.replace(a, b)
    return k.translate(_CANON)


class Cleaner:
    def __init__(self, channel: Channel, words: Words | None = None):
        self.channel, self.words = channel, Words() if words is None else words
        self.numbers = self.words.numbers

    def kept(self, text: str) -> tuple[set[str], list[str]]:
        """Kinds of noise lines, and the other lines."""
        lines = text.split("\n")
        kind = [""] * len(lines)
        bare = []
        for i, line in enumerate(lines):
            s = line.strip()
            if not s:
                continue
            if _PAGE.fullmatch(s):
                kind[i] = "page_number"
            elif _BARE.fullmatch(s):
                above = next((x.strip() for x in reversed(lines[:i]) if x.strip()), "")
                if not above.endswith((":", "$", "=", "|")):
                    bare.append(i)
        if bare and (len(lines) > 2):
            for i in bare:
                kind[i] = "page_number"
        titles = {i for i, x in enumerate(lines) if not kind[i] and self.is_title(x.strip())}
        if titles:
            keys = [title_key(x) if not kind[i] and len(x.strip()) > 3 else "" for i, x in enumerate(lines)]
            count = Counter(keys)
            for i in sorted(titles):
                if keys[i] and count[keys[i]] > 1 and self.is_furniture(lines, kind, keys, keys[i]):
                    kind[i] = "running_header"
        return {k for k in kind if k}, [x for x, k in zip(lines, kind) if not k]

    def asked(self, text: str) -> set[str]:
        """Words and pairs whose counts analyse() may ask for."""
        out: set[str] = set()
        heads: set[str] = set()  # what may stand before the mark at the end of the line before
        for line in self.kept(text)[1]:
            out.update(self.channel.asked([self.words[t] for t in line.split(" ")]))
            tokens = line.split()
            if not tokens:
                continue
            ways = self.ways(tokens[0]) if heads or len(tokens) == 1 else set()
            out.update(self.words[h + x + t] for h in heads for t in ways for x in ("", "-"))
            ends = {h + t for h in heads | {""} for t in ways} if len(tokens) == 1 else self.ways(tokens[-1]) if tokens[-1][-1] in MARKS else set()
            heads = {e[:-1] for e in ends if e[-1:] and e[-1] in MARKS}
        return out - {""}

    def ways(self, raw: str) -> set[str]:
        """What read() may make of a token."""
        w = self.words[raw]
        out = {raw} | {self.put(raw, w, c) for c, _ in (self.channel.candidates(w) if w else ())}
        return out | {x for t in out if (x := self.number(t))}

    def analyse(self, text: str) -> tuple[set[str], str]:
        """Kinds of noise and the repaired text."""
        noise, kept = self.kept(text)
        out, i = [], 0
        fixed = [self.read(x, noise) for x in kept]
        while i < len(fixed):
            line = fixed[i]
            while i + 1 < len(fixed) and (nxt := self.following(fixed, i)) is not None:
                parted = self.parted(line, fixed[nxt])
                if parted is None:
                    break
                noise.add("hyphen_break")
                line, i = parted, nxt
            out.append(line)
            i += 1
        return noise, self.paragraphs(out)

    @staticmethod
    def following(lines: list[str], i: int) -> int | None:
        return next((k for k in range(i + 1, min(i + 3, len(lines))) if lines[k].strip()), None)

    @staticmethod
    def is_title(s: str) -> bool:
        if _END.search(s) or not any(c.isalpha() for c in s) or s[0] in "-*+#|=<>{\\![":
            return False
        first = next(c for c in s if c.isalpha())
        if first.isascii():
            named = [w for w in s.split() if w[:1].isalpha()]
            return len(named) > 1 and first.isupper() and 2 * sum(w[0].isupper() for w in named) >= len(named)
        return len(s.split()) > 1

    @staticmethod
    def is_furniture(lines: list[str], kind: list[str], keys: list[str], key: str) -> bool:
        """A title that stands between blank lines each time is a heading of the text; one that touches it is not."""
        for i in range(len(lines)):
            if keys[i] == key:
                above = lines[i - 1].strip() if i else ""
                below = lines[i + 1].strip() if i + 1 < len(lines) else ""
                if above and kind[i - 1] != "page_number" or below and kind[i + 1] != "page_number" or above and below:
                    return True
        return False

    def read(self, line: str, noise: set[str]) -> str:
        """The line with misread words and numbers put right."""
        if line.isascii() is False and not re.search(r"[A-Za-z]", line):
            return line
        raw = line.split(" ")
        words = [self.words[t] for t in raw]
        told = self.channel.decode(words) if any(words) else words
        changed = False
        for i, (w, c) in enumerate(zip(words, told)):
            if w != c:
                # parts of words at line ends aren't words
                if i == len(raw) - 1 and raw[i][-1:] in MARKS:
                    continue
                noise.add("misread")
                raw[i] = self.put(raw[i], w, c)
                changed = True
        for i, t in enumerate(raw):
            if (x := self.numbers[t]) is not None:
                noise.add("misread")
                raw[i] = x
                changed = True
        return " ".join(raw) if changed else line

    @staticmethod
    def put(raw: str, w: str, c: str) -> str:
        """The token with the true word c in place of w."""
        at = raw.lower().find(w)
        true = c.upper() if raw.isupper() else c.capitalize() if raw[at : at + 1].isupper() else c
        return raw[:at] + true + raw[at + len(w) :]

    @staticmethod
    def number(t: str) -> str | None:
        """The token with its digits put right, if it is a misread number."""
        core = t.strip("\"'“”‘’.,;:!?।")
        if _NUMBER.fullmatch(core) and sum(c.isdigit() for c in core) >= 3:
            return t.replace(core, re.sub(r"(?<=\d)[OolISB]|[OolISB](?=\d)", lambda m: "001158"["OolISB".index(m.group())], core))
        return None

    def parted(self, line: str, nxt: str) -> str | None:
        """Both lines joined, if a word is parted between them."""
        a, b = line.rstrip(), nxt.lstrip()
        if len(a) < 2 or a[-1] not in MARKS or not (a[-2].isalpha() or a[-2] in "्ािीुूेैोौं" or a[-2] in SIGNS - {"|"}) or not b:
            return None
        if not (b[0].islower() or b[0] in SIGNS or (b[0].isalpha() and not b[0].isascii() and not b[0].isupper())):
            return None
        head, tail = a[:-1].split()[-1], b.split()[0]
        if a[-1] == "-":
            whole, joined = self.words[head + "-" + tail], self.words[head + tail]
            if whole and joined and self.channel.n(whole) > 10 * self.channel.n(joined) + 2:
                return None
        return a[:-1] + b

    @staticmethod
    def paragraphs(lines: list[str]) -> str:
        text = "\n".join(x.rstrip() for x in lines)
        text = re.sub(r"\n{3,}", "\n\n", text)
        return re.sub(r"(?<=[^\n])\n(?=[^\n\s\-*+#|>\d])", " ", text).strip()


def analyse(df: DataFrame, id_col: str, text_col: str, counts: DataFrame) -> DataFrame:
    """id, noise (array of kinds, sorted) and repaired_text of every row; counts: see language_model."""
    kind = df.schema[id_col].dataType.simpleString()
    total = counts.filter("key IS NOT NULL").agg(F.sum("n")).first()[0] or 0
    # equal texts share what is joined with them
    texts = df.select(id_col, F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    usable = (F.length("text") > 0) & ~F.col("text").rlike(SENTINEL)

    def words_maker():
        words = Words()
        confusable: dict[str, bool] = {}

        def step(text_hash, text):
            for w in {words[t] for t in text.split()}:
                hit = confusable.get(w)
                if hit is None:
                    if len(confusable) > 300_000:
                        confusable.clear()
                    hit = confusable[w] = len(w) > 2 and _CONFUSABLE.search(w) is not None
                if hit:
                    yield text_hash, w

        return step

    held = flat_map(texts.filter(usable).select("text_hash", "text"), words_maker, "text_hash long, word string")
    options = held.join(all_candidates(counts, total), "word").groupBy("text_hash").agg(F.collect_set(F.struct("word", "options")).alias("options"))
    texts = texts.join(options, "text_hash", "left")

    def options_of(found) -> dict[str, list[tuple[str, float]]]:
        return {x["word"]: [(o["word"], o["p"]) for o in x["options"]] for x in found or ()}

    def keys_of_maker():
        words = Words()

        def step(text_hash, text, found):
            if found or any(m in text for m in MARKS):
                for k in Cleaner(Channel(total, {}, options_of(found)), words).asked(text):
                    yield text_hash, key_hash(k)

        return step

    asked = flat_map(texts.filter(usable).select("text_hash", "text", "options"), keys_of_maker, "text_hash long, key_hash long")
    told = asked.join(counts.select("key_hash", "n"), "key_hash").groupBy("text_hash").agg(F.collect_set(F.struct("key_hash", "n")).alias("told"))

    def make():
        words = Words()
        plain = re.compile(SENTINEL)

        def step(key, text, found, told):
            if not text or plain.match(text):
                yield key, [], text
                return
            channel = Channel(total, {x["key_hash"]: x["n"] for x in told or ()}, options_of(found), key_hash)
            noise, repaired = Cleaner(channel, words).analyse(text)
            yield key, sorted(noise), repaired

        return step

    done = texts.join(told, "text_hash", "left").select(id_col, "text", "options", "told")
    return flat_map(done, make, f"{id_col} {kind}, noise array<string>, repaired_text string")


def p4_repaired(spark, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "sheet3")
    done = analyse(sheet, "record_id", "full_extracted_text", language_model(sheet, "full_extracted_text"))
    return done.select("record_id", "repaired_text").distinct()


def p4_found(spark, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "sheet3")
    done = analyse(sheet, "record_id", "full_extracted_text", language_model(sheet, "full_extracted_text"))
    return done.select("record_id", F.explode("noise").alias("noise")).distinct()


QUERIES = {"p4_found": p4_found, "p4_repaired": p4_repaired}
ORACLES: dict[str, str] = {}

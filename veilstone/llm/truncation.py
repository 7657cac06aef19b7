"""Problem 5: text cut off by field limits.

Two kinds of evidence, both from prefixes:

1. Self-join by prefix. All distinct values are sorted (range-partitioned, so no group of equal beginnings ends up in
   one task); the values that a value is a strict prefix of follow it in this order, and all are judged. A value was cut
   if a longer copy goes on inside its last word or sentence, or in the same paragraph after no terminal mark.
   Where copies tell line ends, those without any don't decide on the paragraph.
2. The same question for the last words of a value, whose longer copy need not survive: hashed prefixes of all word
   triples of the corpus are counted and joined with the last words. A value was cut if its last words elsewhere are only the
   beginning of longer ones, or always go on, and never end a sentence or paragraph. Last words that are too rare are asked
   with fewer words before them. The end of the record's own text, which may be cut at the same place, doesn't count.

Values that end in a terminal mark are complete, unless the mark belongs to a word that never ends a paragraph. Points of
omission at the end are no terminal mark: the text before them is judged, and in brackets they tell a cut themselves.
Null, empty, blank and sentinel values are no cases. Rows are one case however often repeated. The report counts records
per office; records without an office are reported under null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilstone.llm.batches import SENTINEL, flat_map, table
from veilstone.llm.scan_noise import _PAGE
from veilstone.llm.sketch import key_counts, key_hash

OFTEN = 30  # places that show that a word with its point never ends a paragraph
NEVER_END = 0.001  # share of its places up to which a word with its point ends paragraphs only where texts are cut
RARE_END = 0.03  # last words that end a sentence in no more than this share of their places go on
LEAST = 3  # places in which the last words must go on
SHORTER = ((LEAST, RARE_END), (10, 0.01), (30, 0.003))  # places that decide and the share of ends, by words left out before the last
OWN_TAIL = 40  # last characters of a value that are sought in the record's own text
WRAPPED = 40  # characters of a line from which its end may be that of a wrapped line
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_FINAL, _CLOSING, _CLOSED = frozenset(".!?।॥。！？۔؟…"), "\"'”’»)]」』*_>", frozenset("\"”’»」』>}")
_OMISSION = re.compile(r"(?<![.…])(?:\.{3}|\. \. \.|…{1,2}|(?P<told>\[(?:\.{3}|\. \. \.|…)\]|\((?:\.{3}|\. \. \.|…)\)))$")  # seven characters at most
_MARKS = frozenset(".…])")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_OPEN_TAG = re.compile(r"<(?:/|/?[A-Za-z][^<>]*)$")
_PICTURE = re.compile(r"[\U0001F000-\U0001FAFF☀-➿️‍]+$")
_CJK = re.compile(r"[ぁ-ヿ㐀-鿿]")
_TOKEN = re.compile(r"[ぁ-ヿ㐀-鿿]|[^\sぁ-ヿ㐀-鿿]+")
_DIGITS = re.compile(r"[0-9०-९০-৯۰-۹]+")
_TAIL_LINE = re.compile(r"\s*(?:p\s?a\s?g\s?e|pg\.|page|पृष्ठ|[-~\[(|]|[0-9०-९]+\s*$|[ivx]+\s*$)", re.I)


def split_words(text: str) -> list[str]:
    """Words, digits levelled; a character of an unspaced script is a word."""
    t = _DIGITS.sub("0", text.lower())
    return _TOKEN.findall(t) if _CJK.search(t) else t.split()


def bare(token: str) -> str:
    return token.rstrip(".,;:!?।॥。！？۔؟…\"'”’»)]」』*_>")


def is_final(t: str) -> bool:
    """Whether a text without white space at its end ends in a terminal mark."""
    return t[-1:] in _CLOSED or t.rstrip(_CLOSING)[-1:] in _FINAL


def unmarked(text: str) -> tuple[str, bool]:
    """A text without points of omission at its end, and whether they stood in brackets."""
    t = text.rstrip()
    m = _OMISSION.search(t, max(0, len(t) - 7)) if t[-1:] in _MARKS else None
    return (t[: m.start()].rstrip(), bool(m["told"])) if m else (text, False)


def in_tag(t: str) -> bool:
    """Whether a text that has markup stops inside a tag."""
    at = t.rfind("<")
    return at > t.rfind(">") and bool(_OPEN_TAG.match(t, at)) and bool(_TAG.search(t))


def last_part(t: str) -> str:
    """What follows the last blank line of a text."""
    end = len(t)
    while (at := t.rfind("\n", 0, end)) >= 0:
        before = t.rfind("\n", 0, at)
        if before >= 0 and not t[before:at].strip():
            return t[at + 1 :]
        end = at
    return t


class Tokens(dict):
    """Raw word -> (word without end marks, whether it ends a sentence, key of its point or ''), kept."""

    def __missing__(self, w: str) -> tuple[str, bool, str]:
        b = bare(w)
        if len(self) > 300_000:
            self.clear()
        self[w] = out = (b, len(b) < len(w) and is_final(w), w if w[-1:] == "." else "")
        return out


def keys_maker():
    tokens = Tokens()

    def keys(text: str) -> list[str]:
        out: list[str] = []
        for part in _BLANK.split(text.strip()):
            if "\n" in part:
                part = " ".join(x for x in part.split("\n") if len(x) > 20 or not _PAGE.fullmatch(x.strip()))
            words = split_words(part)
            if not words:
                continue
            n = 3 if _CJK.search(part) else 2
            before = ["^"] * n + words
            last = len(words) - 1
            for i, w in enumerate(words):
                b, ends, point = tokens[w]
                ctx = " ".join(before[i : i + n])
                out.append(("E" if ends or i == last else "G") + ctx + " " + b)
                if point:
                    out.append(("Q" if i == last else "D") + w)
        return out

    return keys


def shorter(ctx: str) -> str:
    """A context, each of its words with a blank after it, without its first word."""
    return ctx[ctx.find(" ") + 1 :]


def prefixes(counted: dict[str, int]) -> dict[str, int]:
    """Adds the counts of all prefixes of each word in its context, and those in contexts of one and two words less.

    A word that ends a paragraph also counts as met.
    """
    out = dict(counted)
    of = out.get
    last = {k: n for k, n in counted.items() if k[0] in "EG"}
    for left_out in range(len(SHORTER)):
        if left_out:
            less: dict[str, int] = {}
            for k, n in last.items():
                short = k[0] + shorter(k[1:])
                less[short] = less.get(short, 0) + n
            for k, n in less.items():
                out[k] = of(k, 0) + n
            last = less
        met: dict[str, int] = {}
        for k, n in last.items():
            met[k[1:]] = met.get(k[1:], 0) + n
        for k, n in met.items():
            at = k.rfind(" ") + 1
            if len(k) - at < 25:
                k = "P" + k
                for j in range(at + 2, len(k)):
                    out[k[:j]] = of(k[:j], 0) + n
    for k, n in counted.items():
        if k[0] == "Q":
            out["D" + k[1:]] = of("D" + k[1:], 0) + n
    return out


def context(words: list[str], i: int, wide: bool) -> str:
    """The words before the i-th that a count is conditioned on; '^' stands for the paragraph's start."""
    n = 3 if wide else 2
    before = words[max(0, i - n) : i]
    return " ".join(["^"] * (n - len(before)) + before) + " "


def corpus_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(key_hash, n) of the word triples of all texts and their prefixes."""
    return key_counts(df.filter(F.length(text_col) > 0).filter(~F.col(text_col).rlike(SENTINEL)), text_col, keys_maker, expand=prefixes)


def tail_keys(text: str) -> list[tuple[str, str]]:
    """(role, key) that decide on the last words of a value; role 'cut' needs no count, none means complete.

    E and G: the last words end a sentence or go on; P: they are the beginning of longer ones, each with the number of words
    left out before the last; D and Q: the last word with its point anywhere, and at the end of a paragraph.
    """
    t = text.rstrip()
    if _PICTURE.match(t[-1:]):
        t = _PICTURE.sub("", t).rstrip()
    t, told = unmarked(t)
    if not t:
        return []
    if t[-1] == "�" or told and not is_final(t) or in_tag(t):
        return [("cut", "")]
    part = last_part(t)
    wide = bool(_CJK.search(part))
    words = split_words(part if wide else " ".join(part.rsplit(None, 3)[-3:]))
    if not words:
        return []
    w = words[-1]
    if is_final(t):
        # only a mark of a word that is often met and never ends a paragraph leaves the sentence open
        return [("D", "D" + w), ("Q", "Q" + w)] if w[-1:] == "." and any(c.isalpha() for c in w) else []
    b = bare(w)
    ctx = context(words, len(words) - 1, wide)
    out = []
    for left_out in range(len(SHORTER) if any(c.isalpha() for c in b) else 1):
        out += [(f"E{left_out}", "E" + ctx + b), (f"G{left_out}", "G" + ctx + b)]
        if not wide and len(b) == len(w):  # after a comma or colon the last word itself is whole
            out.append((f"P{left_out}", "P" + ctx + b))
        ctx = shorter(ctx)
    return out


def own_end(text: str | None) -> set[str]:
    """The keys that a text's last word is counted under as an end, though no more than the end of the text shows it.

    Points of omission show more, and so does a letter with its point, which may be a label or initial.
    """
    if not text or unmarked(text)[0] != text:
        return set()
    return {k for _, k in tail_keys(text) if k[:1] == "E" or k[:1] == "Q" and len(k) > 3}


def by_tail(df: DataFrame, counts: DataFrame) -> DataFrame:
    """record_id of values cut by their last words; df: record_id, value, own (the record's text among those counted)."""
    kind = df.schema["record_id"].dataType.simpleString()

    def make():
        def ask(key, text, own):
            keys = tail_keys(text)
            if not keys:
                return
            value, ends = key_hash(text), own_end(own)
            if own and own_goes_on(text, own):
                yield key, value, "cut", key_hash(""), 0
            for role, k in keys:
                yield key, value, role, key_hash(k), int(k in ends or role == "D" and "Q" + k[1:] in ends)

        return ask

    asked = flat_map(df, make, f"record_id {kind}, value long, role string, key_hash long, own int")
    # repeats of a row were counted as often as they come
    asked = asked.groupBy("record_id", "value", "role", "key_hash").agg(F.sum("own").alias("own"))
    n = F.greatest(F.coalesce("n", F.lit(0)) - F.col("own"), F.lit(0))
    of = {r: F.sum(F.when(F.col("role") == r, n).otherwise(0)) for r in [x + str(i) for i in range(len(SHORTER)) for x in "EGP"] + ["D", "Q"]}
    sums = asked.join(counts, "key_hash", "left").groupBy("record_id", "value").agg(*[c.alias(r) for r, c in of.items()], F.max(F.col("role") == "cut").alias("broken"))
    goes = F.lit(False)
    for i, (least, share) in reversed([*enumerate(SHORTER)]):
        ends, on = F.col(f"E{i}"), F.col(f"G{i}") + F.col(f"P{i}")
        goes = F.when(ends + on >= least, (on >= least) & (ends <= share * (ends + on))).otherwise(goes)
    is_cut = F.col("broken") | ((F.col("D") >= OFTEN) & (F.col("Q") <= NEVER_END * F.col("D"))) | goes
    return sums.filter(is_cut).select("record_id")


def level(text: str) -> tuple[str, str]:
    """Words parted by single blanks, and where a blank stands for line ends: 'offset' or, of a blank line, 'offset='."""
    if "\n" not in text:
        return " ".join(text.split()), ""
    lines, breaks, at, blank = [], [], 0, False
    for line in text.split("\n"):
        words = " ".join(line.split())
        if not words:
            blank = True
            continue
        if lines:
            breaks.append(f"{at}=" if blank else f"{at}")
            at += 1
        lines.append(words)
        at += len(words)
        blank = False
    return " ".join(lines), " ".join(breaks)


def own_goes_on(text: str, own: str) -> bool:
    """Whether a value's last word or words go on in the same line at each place where the record's own text has them.

    The text may differ before them, by noise or markup, so that the value isn't its prefix. A text that tells no line ends
    goes on only with a lower-case letter.
    """
    t = unmarked(text.rstrip())[0]
    if not t or is_final(t):
        return False
    tail = " ".join(t[-2 * OWN_TAIL :].split())[-OWN_TAIL:]
    if len(tail) < OWN_TAIL:
        return False
    copy, places = " ".join(own.split()), []
    at = copy.find(tail)
    while at >= 0:
        places.append(at + OWN_TAIL)
        at = copy.find(tail, at + 1)
    after = [copy[i : i + 2].lstrip() for i in places]
    if not all(x[:1].isalnum() for x in after):
        return False
    places = [i for i in places if copy[i] == " "]  # others are inside a word
    if not places:
        return bool(after)
    ends = {int(x.rstrip("=")) for x in level(own)[1].split()}
    return all(i not in ends and (bool(ends) or copy[i + 1].islower()) for i in places)


def verdict(value: str, copy: str, breaks: str) -> str:
    """goes_on() of a longer copy; 'joined' if it goes on in a paragraph but the copy tells no line ends."""
    return goes_on(copy[len(value) : len(value) + 60], value, breaks.split())


def longer_copies(values: DataFrame, every: DataFrame, n_parts: int) -> DataFrame:
    """(value_key, verdict) of targets that are strict prefixes of other values, one for each kind of verdict.

    values: value_key, value, breaks, is_target, distinct. Sorted over range partitions; each task keeps the values that the
    current one begins with. Those at the end of a task that begin the next task's first value meet every value (value,
    breaks, as they are read, without a shuffle) in a second, small step.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        first, seen = None, None
        open_: list[tuple[str, set, set]] = []  # values that the current one begins with: value, ids, verdicts

        def close(n: int) -> None:
            while len(open_) > n:
                _, ids, told = open_.pop()
                out.extend(("found", k, v, part, None) for k in ids for v in told)

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [[]] * 5
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string()))], names=["what", "value_key", "verdict", "part", "value"]
            )

        for b in batches:
            for key, value, breaks, target in zip(*(b.column(i).to_pylist() for i in range(4))):
                first = value if first is None else first
                if (value, breaks) != seen:
                    seen = value, breaks
                    n = len(open_)
                    while n and not value.startswith(open_[n - 1][0]):
                        n -= 1
                    close(n)
                    for v, ids, told in open_:
                        if len(v) < len(value) and ids and "cut" not in told:
                            told.add(verdict(v, value, breaks))
                    if not open_ or open_[-1][0] != value:
                        open_.append((value, set(), set()))
                if target:
                    open_[-1][1].add(key)
            yield flush()
        if first is not None:
            out.append(("first", None, None, part, first))
            out += [("last", k, None, part, v) for v, ids, told in open_ if "cut" not in told for k in ids]
            close(0)
            yield flush()

    rows = values.repartitionByRange(n_parts, "value").sortWithinPartitions("value", "breaks").mapInArrow(scan, "what string, value_key long, verdict string, part int, value string")
    rows = rows.persist()
    found = rows.filter("what = 'found'").select("value_key", "verdict")
    # one 'first' row per partition that has rows; the next of them is the neighbour
    nexts = rows.filter("what = 'first'").select("part", F.lead("value").over(Window.orderBy("part")).alias("v2"))
    lasts = rows.filter("what = 'last'").select("value_key", "part", "value").join(nexts, "part")
    # at most one chain of prefixes for each border between partitions
    edge = lasts.filter(F.startswith(F.col("v2"), F.col("value"))).select("value_key", F.col("value").alias("short"))
    beyond = every.join(F.broadcast(edge), F.startswith(F.col("value"), F.col("short")) & (F.col("value") != F.col("short")))

    def maker():
        return lambda key, short, value, breaks: iter([(key, verdict(short, value, breaks))])

    return found.unionByName(flat_map(beyond.select("value_key", "short", "value", "breaks"), maker, "value_key long, verdict string"))


def goes_on(rest: str, value: str = "", breaks: list[str] | None = None) -> str:
    """What the rest of a longer copy says: 'cut' inside a word, sentence or paragraph, 'whole', 'unknown' or 'joined'.

    breaks: the copy's line ends as in level(); 'joined' if there are none, so that the paragraph may have ended.
    """
    if not rest.strip():
        return "whole"
    c = rest[0]
    if not c.isspace():
        if c.isalnum() or ord(c) > 0x300:
            return "cut"
        inside = value and not is_final(value) and not is_final(c) and any(x.isalnum() for x in rest)
        return "cut" if inside else "unknown"
    if "\n" in rest[: len(rest) - len(rest.lstrip())] or _TAIL_LINE.match(rest):
        return "unknown"
    if rest.lstrip()[0].islower():
        return "cut"
    if is_final(value) or not value:
        return "unknown"
    if not breaks:
        return "joined"
    if f"{len(value)}=" in breaks:
        return "unknown"
    if str(len(value)) in breaks:  # a line of a wrapped paragraph is long, those of lists and letter ends aren't
        before = max((n for x in breaks if (n := int(x.rstrip("="))) < len(value)), default=0)
        return "cut" if len(value) - before >= WRAPPED else "unknown"
    return "cut"


def find_cut(df: DataFrame, id_col: str, text_col: str, copies: list[tuple[DataFrame, str]], corpus: tuple[DataFrame, str], n_parts: int) -> DataFrame:
    """Distinct (record_id, evidence) of the cut values of df.text_col; evidence is 'copy' or 'tail'.

    copies: further (table, column) pairs in which longer copies may survive; corpus: the table and column counted, whose
    rows, where it is df, tell each value's own text.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def level_maker():
        def one(key, text, target):
            value, breaks = level(unmarked(text)[0] if target else text)
            if value:  # nothing would begin every copy
                yield key, value, breaks, target

        return one

    usable = F.col("value").isNotNull() & (F.length("value") > 0) & ~F.col("value").rlike(SENTINEL)
    raw = df.select(F.col(id_col).alias("record_id"), F.col(text_col).alias("value")).filter(usable)
    values = raw.withColumn("is_target", F.lit(True))
    for other, column in copies:
        values = values.unionByName(other.select(F.lit(None).cast(kind).alias("record_id"), F.col(column).alias("value"), F.lit(False).alias("is_target")).filter(usable))
    levelled = "record_id {}, value string, breaks string, is_target boolean"
    key = F.xxhash64("value").alias("value_key")
    # each value is sorted and judged once, however many records hold it; the verdicts come back to them by its hash
    every = flat_map(values, level_maker, levelled.format(kind))
    distinct = every.groupBy("value", "breaks").agg(F.max("is_target").alias("is_target")).select(key, "value", "breaks", "is_target")
    copied = longer_copies(distinct, every.select("value", "breaks"), n_parts)
    # copies that tell no line ends decide only where no other does
    told = copied.groupBy("value_key").agg(*[F.max(F.col("verdict") == v).alias(v) for v in ("cut", "joined", "unknown")])
    cut = told.filter("cut OR joined AND NOT unknown").select("value_key")
    holders = flat_map(raw.withColumn("is_target", F.lit(True)), level_maker, levelled.format(kind)).select("record_id", key)
    by_copy = holders.join(cut, "value_key").select("record_id", F.lit("copy").alias("evidence"))
    own = F.col(corpus[1]) if corpus[0] is df else F.lit(None).cast("string")
    asking = df.select(F.col(id_col).alias("record_id"), F.col(text_col).alias("value"), own.alias("own")).filter(usable)
    tails = by_tail(asking, corpus_counts(*corpus)).withColumn("evidence", F.lit("tail"))
    return by_copy.unionByName(tails).distinct()


def _find(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sheet = table(spark, sf_dir, "sheet3")
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sheet.rdd.getNumPartitions())
    return sheet, find_cut(sheet, "record_id", "spell_corrected_text", [(sheet, "full_extracted_text")], (sheet, "full_extracted_text"), n_parts)


def p5_found(spark, sf_dir: str) -> DataFrame:
    return _find(spark, sf_dir)[1].select("record_id").distinct()


def p5_offices(spark, sf_dir: str) -> DataFrame:
    """office_code, n_records, n_cut, cut_share; the share is null for an office all of whose record ids are null."""
    sheet, found = _find(spark, sf_dir)
    records = sheet.select("record_id", "office_code").distinct().join(found.select("record_id").distinct().withColumn("cut", F.lit(1)), "record_id", "left")
    out = records.groupBy("office_code").agg(F.countDistinct("record_id").alias("n_records"), F.countDistinct(F.when(F.col("cut") == 1, F.col("record_id"))).alias("n_cut"))
    return out.withColumn("cut_share", F.try_divide(F.col("n_cut"), F.col("n_records")))


QUERIES = {"p5_found": p5_found, "p5_offices": p5_offices}
ORACLES: dict[str, str] = {}

"""Text functions: Column -> Column, built from Spark's own expressions, no shuffle, no Python per row.

Null text: every function gives null, except language() which gives 'English' as for empty text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilstone.constants import D, DIGIT_LOOKALIKES, EXCLUDED_ORGS, NOISE_WORDS, S, S_IN, TITLE_NAME, W


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value evaluated once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, f"^{S}+|{S}+$", "")


def count_chars(text: Column, char_class: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{char_class}]", ""))


def has_devanagari(text: Column) -> Column:
    return text.rlike(r"[\x{0900}-\x{097F}]")


def language(text: Column) -> Column:
    """English, Hindi or Mixed by the share of Devanagari among Devanagari and Latin letters."""
    deva, latin = count_chars(F.coalesce(text, F.lit("")), r"\x{0900}-\x{097F}"), count_chars(F.coalesce(text, F.lit("")), "A-Za-z")
    share = deva / (deva + latin)
    return (
        F.when(deva == 0, "English")
        .when(latin == 0, "Hindi")
        .when(share > 0.6, "Hindi")
        .when(share > 0.2, "Mixed")
        .otherwise("English")
    )


def sanitise(text: Column, italics_and_spaces: bool = True) -> Column:
    """Plain text of OCR output: attributes, tags, table rules, headings and emphasis taken out.

    Without italics_and_spaces this is the OCR worker's variant, which keeps underscores and runs of spaces.
    """
    t = F.regexp_replace(text, rf'(?iu){S}*data-{W}+="[^"]*"', "")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    t = F.regexp_replace(t, rf"(?md)^{S}*\|?[-:{S_IN}|]+\|?{S}*$", "")

    def row(line: Column) -> Column:
        cells = F.filter(F.transform(F.split(line.substr(F.lit(2), F.length(line) - 2), r"\|", -1), strip), lambda c: c != "")
        return F.when(line.rlike(r"(?d)^\|.+\|$"), F.array_join(cells, "  ")).otherwise(line)

    t = F.array_join(F.transform(F.split(t, "\n", -1), row), "\n")
    t = F.regexp_replace(t, rf"(?md)^#{{1,6}}{S}*", "")
    t = F.regexp_replace(t, r"(?d)\*\*(.+?)\*\*", "$1")
    if italics_and_spaces:
        t = F.regexp_replace(t, r"(?d)_(.+?)_", "$1")
        t = F.regexp_replace(t, r"[ \t]+", " ")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def markdown_lines(text: Column) -> Column:
    """Array of lines without rules, table pipes and bullets; blank lines dropped."""

    def clean(line: Column) -> Column:
        x = strip(F.regexp_replace(F.regexp_replace(line, r"^\|", ""), r"\|+$", ""))
        x = F.regexp_replace(x, rf"{S}*\|{S}*", "  ")
        return F.regexp_replace(x, rf"^[-*]{S}+", "")

    lines = F.transform(F.split(text, "\n", -1), strip)
    return F.filter(F.transform(F.filter(lines, lambda x: (x != "") & ~x.rlike(rf"^[-:{S_IN}]+$")), clean), lambda x: x != "")


def text_lines(text: Column) -> Column:
    """Lines stripped, blank ones dropped; \\r\\n and \\r end lines too."""
    lines = F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n", -1)
    return F.array_join(F.filter(F.transform(lines, strip), lambda x: x != ""), "\n")


def chunks(text: Column, size: int = 1800, overlap: int = 200) -> Column:
    """Array of overlapping pieces of fixed size; the last one ends with the text."""
    step = size - overlap
    n = F.when(F.length(text) <= size, 1).otherwise(F.ceil((F.length(text) - size) / step) + 1).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: text.substr(i * step + 1, F.lit(size)))


def normalise_digits(text: Column) -> Column:
    """Letters read for digits put right in words of digits, and twelve-digit runs grouped by four."""

    def fix(w: Column) -> Column:
        digits = F.length(F.regexp_replace(w, rf"[^{D}²³¹]", ""))
        wordy = (F.length(w) >= 4) & w.rlike(f"^{W}") & (digits >= F.greatest(F.lit(2), F.length(w) - 2))
        return F.when(wordy, F.translate(w, *DIGIT_LOOKALIKES)).otherwise(w)

    words = F.regexp_extract_all(text, F.lit(rf"{W}+|[^\p{{L}}\p{{N}}_]+"), F.lit(0))
    return F.regexp_replace(F.array_join(F.transform(words, fix), ""), rf"({D}{{4}}){S}?({D}{{4}}){S}?({D}{{4}})", "$1 $2 $3")


def title_names(text: Column) -> Column:
    """Array of titles with the words that follow them."""
    return F.regexp_extract_all(text, F.lit(TITLE_NAME), F.lit(0))


def keep_first(items: Column, key: Callable[[Column], Column]) -> Column:
    """Items whose key hasn't stood earlier in the array, in order; time grows as that of a sort."""

    def sorted_out(pairs: Column) -> Column:
        first = F.filter(pairs, lambda p, i: (i == 0) | (F.get(pairs, i - 1)["k"] != p["k"]))
        return F.transform(F.array_sort(F.transform(first, lambda p: F.struct(p["i"], p["v"]))), lambda p: p["v"])

    def keyed(keys: Column) -> Column:
        pairs = F.array_sort(F.transform(items, lambda x, i: F.struct(F.get(keys, i).alias("k"), i.alias("i"), x.alias("v"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), items).otherwise(let(pairs, sorted_out))

    return let(F.transform(items, key), keyed)


def capital_words(text: Column) -> Column:
    """Capitalised words of four letters or more that aren't noise, without their signs; first spelling of each."""
    noise = NOISE_WORDS + EXCLUDED_ORGS
    # the cheap tests come first: few words are left for the others
    words = F.filter(F.split(strip(text), f"{S}+"), lambda w: (F.length(w) > 3) & w.rlike(r"^\p{Lu}") & ~w.isin(noise))
    bare = F.filter(F.transform(words, lambda w: F.regexp_replace(w, rf"[^\p{{L}}\p{{N}}_]", "")), lambda c: (F.length(c) > 3) & ~F.lower(c).isin([n.lower() for n in noise]))
    return let(bare, lambda a: keep_first(a, F.lower))


def missed_words(text: Column, found_lower: Column) -> Column:
    """capital_words() of a text that aren't among the found."""
    return unfound(capital_words(text), found_lower)


def unfound(words: Column, found_lower: Column) -> Column:
    return F.filter(words, lambda w: ~F.array_contains(found_lower, F.lower(w)))

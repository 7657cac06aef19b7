"""Problem 10: repetition inside a single document.

A threshold table is compiled into one Spark projection: every measure (length, symbols, stop words, repeated
lines, words and letters) is a built-in column expression, every row of the table a comparison of one measure with
its limit; a flag holds if all its rows do, and where only the flag is asked for, a row is computed only if those
before it hold. No user function, no shuffle.

Repeated letters: the text is reduced to its words (case, spacing, punctuation and digits aside; a character of
Chinese or Japanese script counts as a word). Blocks of up to six words that follow each other directly are
taken out by one pass and counted; in the rest, words of a run of seven words that stood earlier are counted through
sorted hashes of the runs. Texts mostly of unspaced script have runs of fourteen characters and blocks of up to
thirteen. No letter of a word's first occurrence counts, so the share of letters in words met before
(repeated_word_share) is an upper bound and stands before it in the table.

Null and empty texts have no letters: all shares are 0 and nothing is flagged. Rows are judged one by one, so
repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.llm.batches import table

RUN_WORDS, RUN_CHARS = 7, 14
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー"
# Threshold table: flag, measure, comparison, limit. Flags are columns of the report.
THRESHOLDS = [
    ("is_repetitive", "repeated_word_share", ">=", 0.40),
    ("is_repetitive", "repeated_share", ">=", 0.40),
    ("has_repeated_lines", "repeated_line_share", ">=", 0.30),
    ("is_symbol_heavy", "symbol_share", ">", 0.30),
    ("lacks_stop_words", "stop_word_share", "<", 0.02),
    ("is_short", "n_letters", "<", 50),
]
# A chosen list: frequent function words of the languages at hand.
STOP_WORDS = "the of and to a in is was for on by that with ke ki ka ko ne se hai mein par aur nahi के की का को ने से है में पर और नहीं आहे ने च्या এর ও এবং না کے کی کا کو نے سے ہے میں اور نہیں".split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value bound once: a lambda variable isn't evaluated again where it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Normalised text: words of letters and marks, each followed by one space; unspaced characters stand alone."""
    letters = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")
    apart = let(letters, lambda x: F.when(x.rlike(f"[{UNSPACED}]"), F.regexp_replace(F.regexp_replace(x, f"([{UNSPACED}])", " $1 "), " +", " ")).otherwise(x))
    return F.concat(F.trim(apart), F.lit(" "))


def letters_in(words: Column) -> Column:
    return F.length(F.replace(words, F.lit(" "), F.lit("")))


def run_letters(words: Column, n: Column) -> Column:
    """Letters of words inside runs of n words that stood earlier."""

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.xxhash64(F.slice(w, i, n)))
        # most texts repeat no run: the set of hashes tells before anything is sorted
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), spans(w, h)).otherwise(0))

    def spans(w: Column, h: Column) -> Column:
        runs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), (i + 1).alias("i"))))
        start = let(
            runs,
            lambda r: F.array_sort(
                F.transform(
                    F.filter(F.sequence(F.lit(2), F.size(r)), lambda j: F.element_at(r, j)["h"] == F.element_at(r, j - 1)["h"]),
                    lambda j: F.element_at(r, j)["i"],
                )
            ),
        )
        # union of the runs' word spans, left to right
        none = F.struct(F.lit(0).alias("last"), F.lit(0).alias("letters"))

        def add(state: Column, i: Column) -> Column:
            first = F.greatest(state["last"] + 1, i)
            return F.struct(
                (i + n - 1).alias("last"),
                (state["letters"] + F.length(F.array_join(F.slice(w, first, i + n - first), ""))).alias("letters"),
            )

        return F.aggregate(start, none, add)["letters"]

    return F.when(F.size(words) > n, let(words, counted)).otherwise(0)


def repeated_share(s: Column) -> Column:
    """Of normalised text: share of letters in blocks and runs that stood earlier."""
    total = letters_in(s)
    unspaced = F.when(s.rlike(f"[{UNSPACED}]"), F.length(F.regexp_replace(s, f"[^{UNSPACED}]", ""))).otherwise(0)

    def once(run: int) -> Column:
        # blocks of less than a run that repeat at once; the first stays
        return F.regexp_replace(s, rf"(?<![^ ])((?:[^ ]++ ){{1,{run - 1}}}?)\1+", "$1")

    def share(o: Column, run: int) -> Column:
        return (total - letters_in(o) + run_letters(F.split(F.trim(o), " "), F.lit(run))) / total

    def of_run(run: int) -> Column:
        return let(once(run), lambda o: share(o, run))

    return F.when(total == 0, F.lit(0.0)).when(unspaced * 2 > total, of_run(RUN_CHARS)).otherwise(of_run(RUN_WORDS))


def repeated_word_share(s: Column) -> Column:
    """Of normalised text: share of letters in words that stood earlier."""
    total = letters_in(s)
    first = F.length(F.array_join(F.array_distinct(F.split(F.trim(s), " ")), ""))
    return F.when(total > 0, 1 - first / total).otherwise(F.lit(0.0))


def stop_word_share(s: Column) -> Column:
    return F.when(letters_in(s) > 0, let(F.split(F.trim(s), " "), lambda w: F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))) / F.size(w))).otherwise(0.0)


def repeated_line_share(text: Column) -> Column:
    lines = F.filter(F.transform(F.split(text, r"\n"), lambda x: F.lower(F.regexp_replace(x, r"[^\p{L}\p{M}]+", ""))), lambda x: F.length(x) > 0)
    return let(lines, lambda x: F.when(F.size(x) > 0, 1 - F.size(F.array_distinct(x)) / F.size(x)).otherwise(F.lit(0.0)))


def symbol_share(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.length(F.regexp_replace(text, r"[\p{L}\p{M}\p{N}\s]", "")) / F.length(text)).otherwise(0.0)


OF_TEXT = {"symbol_share": symbol_share, "repeated_line_share": repeated_line_share}
OF_WORDS = {"n_letters": lambda s: letters_in(s).cast("bigint"), "stop_word_share": stop_word_share, "repeated_word_share": repeated_word_share, "repeated_share": repeated_share}
COMPARE = {">=": lambda a, b: a >= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b}


def assess(df: DataFrame, id_col: str, text_col: str, thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """id, the measures that the table names, and one boolean column per flag of the table."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    wanted = list(dict.fromkeys(m for _, m, _, _ in thresholds))
    of_words = let(words_of(text), lambda s: F.struct(*[OF_WORDS[m](s).alias(m) for m in wanted if m in OF_WORDS]))
    rows = df.select(id_col, of_words.alias("_words"), *[OF_TEXT[m](text).alias(m) for m in wanted if m in OF_TEXT])
    rows = rows.select(id_col, *[F.col(m) if m in OF_TEXT else F.col(f"_words.{m}").alias(m) for m in wanted])
    flags = {f: functools.reduce(Column.__and__, [COMPARE[op](F.col(m), F.lit(limit)) for g, m, op, limit in thresholds if g == f]) for f, *_ in thresholds}
    return rows.select("*", *[c.alias(f) for f, c in flags.items()])


def flagged(df: DataFrame, id_col: str, text_col: str, flag: str, thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """Ids of the rows for which a flag holds; its measures are computed in the table's order as long as they hold."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = [r for r in thresholds if r[0] == flag]

    def holds(s: Column, due: list[tuple]) -> Column:
        _, m, op, limit = due[0]
        here = COMPARE[op](OF_TEXT[m](text) if m in OF_TEXT else OF_WORDS[m](s), F.lit(limit))
        return F.when(here, holds(s, due[1:])).otherwise(False) if len(due) > 1 else here

    return df.filter(let(words_of(text), lambda s: holds(s, rows))).select(id_col)


def p10_found(spark, sf_dir: str) -> DataFrame:
    return flagged(table(spark, sf_dir, "documents"), "doc_id", "text", "is_repetitive")


def p10_measures(spark, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_ratios(spark, sf_dir: str) -> DataFrame:
    """The table's plain ratios, rounded."""
    wanted = ["n_letters", "symbol_share", "repeated_line_share", "repeated_word_share"]
    rows = assess(table(spark, sf_dir, "documents"), "doc_id", "text", [r for r in THRESHOLDS if r[1] in wanted])
    return rows.select("doc_id", "n_letters", *[F.round(c, 9).alias(c) for c in wanted[1:]])


QUERIES = {"p10_found": p10_found, "p10_measures": p10_measures, "p10_ratios": p10_ratios}
_SQL_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}ー"
ORACLES = {
    "p10_ratios": rf"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
            w AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(regexp_replace(lower(text), '[^\p{{L}}\p{{M}}]+', ' ', 'g'), '([{_SQL_UNSPACED}])', ' \1 ', 'g'), ' '), lambda x: x <> '') AS words,
                list_filter(list_transform(string_split(text, chr(10)), lambda x: lower(regexp_replace(x, '[^\p{{L}}\p{{M}}]+', '', 'g'))), lambda x: x <> '') AS lines FROM t),
            n AS (SELECT *, length(array_to_string(words, '')) AS letters FROM w)
        SELECT doc_id, letters AS n_letters, CASE WHEN length(text) > 0 THEN round(length(regexp_replace(text, '[\p{{L}}\p{{M}}\p{{N}}\s\x{{0b}}]', '', 'g'))::DOUBLE / length(text), 9) ELSE 0 END AS symbol_share,
            CASE WHEN len(lines) > 0 THEN round(1 - len(list_distinct(lines))::DOUBLE / len(lines), 9) ELSE 0 END AS repeated_line_share,
            CASE WHEN letters > 0 THEN round(1 - length(array_to_string(list_distinct(words), ''))::DOUBLE / letters, 9) ELSE 0 END AS repeated_word_share FROM n""",
}

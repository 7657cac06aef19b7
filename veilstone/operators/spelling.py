"""Spelling correction: by a registered model, else against a frequency dictionary (nearest term within two edits).

The dictionary is searched by deletion neighbourhoods. Up to MAX_TERMS terms it is broadcast: each worker indexes the
deletions once and remembers the words it has met, so texts are corrected in one pass without a shuffle. A larger one
stays distributed: the distinct words of all texts meet the terms under their deletions, and texts take the corrected
words by a hash of the text.

Null, empty and Devanagari texts stay as they are. Words in capitals, of signs and digits, with '@' or of up to two
letters are kept; others take the nearest term (fewest edits, then highest count, then alphabetical order). Words of
a corrected text are parted by single blanks.

A model reads the first MODEL_CHARS characters. Its empty answer keeps the text; where it fails, takes longer than
MODEL_SECONDS for a batch or gives null, the dictionary decides.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from veilstone.constants import S
from veilstone.functions.text import has_devanagari, strip
from veilstone.operators.backends import log, within

MAX_TERMS = 500_000
PREFIX = 7
MODEL_CHARS, MODEL_TOKENS, MODEL_SECONDS = 2000, 1024, 600
KNOWN = 300_000  # words a worker remembers
_KEEP = re.compile(r"[A-Z]{2,}\Z|[\d\W]+\Z")
_DEVA = re.compile(r"[ऀ-ॿ]")
_model: list[Callable[[pd.Series], pd.Series]] = []


def register_model(fix: Callable[[pd.Series], pd.Series]) -> None:
    """fix: texts of at most MODEL_CHARS characters -> corrected texts of at most MODEL_TOKENS tokens."""
    _model[:] = [fix]


def unregister_model() -> None:
    _model.clear()


def edits(a: str, b: str, most: int = 2) -> int:
    """Restricted edit distance with adjacent swaps; most + 1 if it is larger than most."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if two is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


def deletions(word: str, most: int = 2) -> set[str]:
    level, out = {word[:PREFIX]}, {word[:PREFIX]}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out |= level
    return out


def is_kept(w: str) -> bool:
    return len(w) <= 2 or "@" in w or _KEEP.match(w) is not None


class Speller:
    def __init__(self, terms: dict[str, int]):
        self.terms, self.known = terms, {}
        self.index: dict[str, list[str]] = {}
        for t in terms:
            for d in deletions(t):
                self.index.setdefault(d, []).append(t)

    def word(self, w: str) -> str:
        hit = self.known.get(w)
        if hit is None:
            if len(self.known) > KNOWN:
                self.known.clear()
            hit = self.known[w] = w if is_kept(w) or w in self.terms else self.nearest(w)
        return hit

    def nearest(self, w: str) -> str:
        near = {t for d in deletions(w) for t in self.index.get(d, ())}
        return min(((e, -self.terms[t], t) for t in near if (e := edits(w, t)) <= 2), default=(9, 0, w))[2]

    def text(self, t: str | None) -> str | None:
        if not t or _DEVA.search(t):
            return t
        return " ".join(map(self.word, t.split()))


_spellers: dict[int, Speller] = {}


def speller_of(terms: dict[str, int]) -> Speller:
    """The worker's speller for a broadcast dictionary, built once; it holds the terms, so their id isn't used again."""
    if id(terms) not in _spellers:
        _spellers.clear()
        _spellers[id(terms)] = Speller(terms)
    return _spellers[id(terms)]


def term_counts(dictionary: DataFrame) -> DataFrame:
    return dictionary.filter("term IS NOT NULL").groupBy("term").agg(F.coalesce(F.max("term_count"), F.lit(0)).alias("n"))


def load_terms(dictionary: DataFrame, most: int) -> dict[str, int] | None:
    """The terms, or None if there are more than most."""
    rows = term_counts(dictionary).limit(most + 1).collect()
    return None if len(rows) > most else {r.term: r.n for r in rows}


def by_model(texts: list[str | None], fix: Callable[[pd.Series], pd.Series]) -> list[str | None]:
    """The model's corrections; None where the dictionary decides."""
    out: list[str | None] = [None] * len(texts)
    asked = [i for i, t in enumerate(texts) if t and not _DEVA.search(t)]
    if not asked:
        return out
    try:
        said = list(within(MODEL_SECONDS, fix, pd.Series([texts[i][:MODEL_CHARS] for i in asked], dtype=object)))
    except Exception as e:  # noqa: BLE001
        log.warning("spelling model failed on %d texts: %s", len(asked), e)
        return out
    for i, x in zip(asked, said):
        out[i] = (x.strip() or texts[i]) if isinstance(x, str) else None
    return out


def appended(df: DataFrame, text_col: str, out_col: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """df with out_col, what make()'s result says of each batch's texts."""
    schema = StructType([*df.schema.fields, StructField(out_col, StringType())])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        say = make()
        for b in batches:
            done = pa.array(say(b.column(at).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, done], names=[*b.schema.names, out_col])

    return df.mapInArrow(run, schema)


def correct(
    df: DataFrame, text_col: str, dictionary: DataFrame, out_col: str = "corrected_text", max_terms: int = MAX_TERMS, where: str = "true", model: Callable[[pd.Series], pd.Series] | None = None
) -> DataFrame:
    """df with out_col added. Rows for which where doesn't hold keep their text. model: instead of the registered one."""
    if where != "true":
        due = fresh(df, "due")
        out = correct(df.withColumn(due, F.when(F.expr(where), F.col(text_col))), due, dictionary, out_col, max_terms, model=model)
        return out.withColumn(out_col, F.when(F.expr(where), F.col(out_col)).otherwise(F.col(text_col))).drop(due)
    terms = load_terms(dictionary, max_terms)
    fix = model or (_model[0] if _model else None)
    if terms is None:
        return correct_by_join(df, text_col, dictionary, out_col, fix)
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def make() -> Callable[[list], list]:
        speller = speller_of(shared.value)

        def say(texts: list) -> list:
            told = by_model(texts, fix) if fix else [None] * len(texts)
            return [speller.text(t) if x is None else x for t, x in zip(texts, told)]

        return say

    return appended(df, text_col, out_col, make)


def _deletion_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows of df with each deletion of a column of words."""
    several = F.udf(lambda w: sorted(deletions(w)), "array<string>", useArrow=True)
    return df.withColumn("deletion", F.explode(several(F.col(column))))


def nearest_terms(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, term) of distinct words that are no terms themselves and have a term within two edits."""
    terms = term_counts(dictionary)
    unknown = words.join(terms.select(F.col("term").alias("word")), "word", "left_anti")
    pairs = _deletion_rows(unknown, "word").join(_deletion_rows(terms, "term"), "deletion").select("word", "term", "n").distinct()

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([edits(x, y) for x, y in zip(a, b)], dtype="int32")

    near = pairs.withColumn("e", distance("word", "term")).filter("e <= 2")
    return near.groupBy("word").agg(F.min(F.struct("e", (-F.col("n")).alias("n"), "term")).alias("b")).select("word", F.col("b.term").alias("term"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    while name in df.columns:
        name += "_"
    return name


def correct_by_join(df: DataFrame, text_col: str, dictionary: DataFrame, out_col: str, fix=None) -> DataFrame:
    """As correct(), with the dictionary distributed. Words and terms meet under their deletions; a text takes only what changes in it."""
    text = F.col(text_col)
    words = F.filter(F.split(strip(text), f"{S}+"), lambda w: w != "")

    def plain(w: Column) -> Column:
        """is_kept() as a column; patterns for Python's own classes of digits and word characters."""
        return (F.length(w) <= 2) | F.contains(w, F.lit("@")) | w.rlike(r"^(?:[A-Z]{2,}|[\p{Nd}²³¹[^\p{L}\p{N}_]]+)$")

    usable = text.isNotNull() & (text != "") & ~has_devanagari(text)
    key, changes, told = (fresh(df, x) for x in ("text_key", "changes", "told"))
    texts = df.filter(usable).select(F.xxhash64(text).alias(key), F.explode(F.array_distinct(F.filter(words, lambda w: ~plain(w)))).alias("word")).distinct()
    changed = texts.join(nearest_terms(texts.select("word").distinct(), dictionary), "word")
    maps = changed.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", "term"))).alias(changes))
    joined = df.withColumn(key, F.xxhash64(text)).join(maps, key, "left")
    put = F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at(F.col(changes), w), w)), " ")
    done = joined.withColumn(out_col, F.when(~usable, text).when(F.col(changes).isNull(), F.array_join(words, " ")).otherwise(put)).select(*df.columns, out_col)
    if fix is None:
        return done
    return appended(done, text_col, told, lambda: lambda ts: by_model(ts, fix)).withColumn(out_col, F.coalesce(told, out_col)).drop(told)

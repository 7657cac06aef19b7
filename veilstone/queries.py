"""Queries over the tables of a folder, and the same in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilstone import constants as K
from veilstone.functions import pii, text as tx
from veilstone.operators import detectors, entities
from veilstone.operators import records as rec
from veilstone.operators.spelling import correct
from veilstone.operators.tuning import by_key, spread
from veilstone.plans import report

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def of_texts(spark: SparkSession, sf_dir: str, *made: Column) -> DataFrame:
    """record_id and what is made of each distinct extracted text of a record.

    Texts aren't shuffled to drop repeated rows: results are, with the text's hash, and where they are made of a scan
    it runs once, in the stage that reads the table.
    """
    sheet = spread(table(spark, sf_dir, "sheet3").select("record_id", "full_extracted_text"))
    return sheet.select("record_id", F.xxhash64("full_extracted_text").alias("text_key"), *made).distinct().drop("text_key")


def exploded(df: DataFrame, array: str, *names: str, keep: list[str] | None = None) -> DataFrame:
    """One row per element of an array, with its position from 1 as the first of two names.

    An outer explode with a filter after it: of a plain one the optimiser infers a filter on the array's size, pushes
    it down to the scan and has the array computed twice.
    """
    rows = df.select(*(keep or ["record_id"]), F.posexplode_outer(array).alias("_pos", names[-1])).filter("_pos IS NOT NULL")
    return rows.withColumn(names[0], (F.col("_pos") + 1).cast("bigint")).drop("_pos") if len(names) > 1 else rows.drop("_pos")


def extracted() -> Column:
    return F.col("full_extracted_text")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return of_texts(spark, sf_dir, pii.regex_hits(extracted()).alias("hits"))


# SQL pieces -----------------------------------------------------------------------------------------------------------
S_IN = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
TEXTS = "texts AS (SELECT DISTINCT record_id, full_extracted_text AS text FROM sheet3)"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{S_IN}]+|[{S_IN}]+$', '', 'g')"


def sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def sql_normal(x: str) -> str:
    words = rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+')"
    fix = (
        rf"lambda w: CASE WHEN length(w) >= 4 AND regexp_matches(w, '^[\p{{L}}\p{{N}}_]') "
        rf"AND length(regexp_replace(w, '[^\p{{Nd}}²³¹]', '', 'g')) >= greatest(2, length(w) - 2) THEN translate(w, 'OolISB', '001158') ELSE w END"
    )
    return rf"regexp_replace(array_to_string(list_transform({words}, {fix}), ''), '(\p{{Nd}}{{4}})[{S_IN}]?(\p{{Nd}}{{4}})[{S_IN}]?(\p{{Nd}}{{4}})', '\1 \2 \3', 'g')"


def ascii_bounds(pattern: str) -> str:
    """A Java pattern in RE2 syntax."""
    pattern = pattern.replace(rf"(?:\G|(?<![{K.LETTERS}0-9._%+\-]))", "")
    pattern = re.sub(r"\(\?=(?:\[[^\]]*\]|\\p\{Nd\})\)" + re.escape(f"(?<!{K.W})"), r"\\b", pattern)
    return pattern.replace(K.END, r"\b").replace("(?iu)", "(?i)").replace("'", "''")


def sql_pattern(label: str) -> str:
    """The label's pattern in RE2 syntax; its word boundary is ASCII, which makes no difference on these texts."""
    if label == "Bank_Account":
        return ""
    return ascii_bounds(K.PATTERNS[label])


def sql_values(label: str, normal: str = "normal") -> str:
    if label == "Bank_Account":
        return rf"list_filter(regexp_extract_all({normal}, '\p{{Nd}}+'), lambda x: length(x) BETWEEN 14 AND 18)"
    return f"regexp_extract_all({normal}, '{sql_pattern(label)}')"


def sql_key(x: str) -> str:
    return rf"lower(regexp_replace({x}, '[{S_IN}\-]', '', 'g'))"


def sql_hits(labels: list[str], places: bool = True) -> str:
    """CTEs up to hits(record_id, ord, label, value)."""
    parts = " UNION ALL ".join(
        f"SELECT record_id, {i} AS p, '{x}' AS label, unnest({sql_values(x)}) AS raw, generate_subscripts({sql_values(x)}, 1) AS pos FROM normals" for i, x in enumerate(labels)
    )
    cities = ", ".join(f"({i}, '{c}', '{c.title()}')" for i, c in enumerate(K.CITIES))
    place = f" UNION ALL SELECT record_id, 100, 'Location', c.name, c.i FROM texts JOIN (VALUES {cities}) c(i, low, name) ON contains(lower(text), c.low)" if places else ""
    return f"""{TEXTS},
        normals AS (SELECT record_id, {sql_normal('text')} AS normal FROM texts),
        raws AS (SELECT record_id, p, label, {sql_strip('raw')} AS value, pos FROM ({parts}) WHERE upper({sql_strip('raw')}) NOT IN ({sql_list(K.EXCLUDED_ORGS)})),
        firsts AS (SELECT *, row_number() OVER (PARTITION BY record_id, label, {sql_key('value')} ORDER BY pos) AS rn FROM raws),
        every AS (SELECT record_id, p, label, value, pos FROM firsts WHERE rn = 1{place}),
        hits AS (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY p, pos) AS ord, label, value FROM every)"""


def sql_mask(label: str, value: str) -> str:
    v, t = sql_strip(value), f"upper({label})"
    d, c = rf"regexp_replace({v}, '\P{{Nd}}', '', 'g')", f"regexp_replace({v}, '[{S_IN}]+', '', 'g')"
    local = f"split_part({v}, '@', 1)"
    words = f"list_filter(regexp_split_to_array({v}, '[{S_IN}]+'), lambda w: w <> '')"
    initials = f"list_transform({words}, lambda w: w[1] || '.')"
    return f"""CASE WHEN {t} = 'AADHAAR' THEN CASE WHEN length({d}) = 12 THEN 'XXXX XXXX ' || right({d}, 4) ELSE 'XXXX XXXX XXXX' END
        WHEN {t} = 'PAN' THEN CASE WHEN length({c}) = 10 THEN left({c}, 5) || '****' || right({c}, 1) ELSE left({c}, 3) || '*****X' END
        WHEN contains({t}, 'PHONE') THEN CASE WHEN length({d}) >= 10 THEN 'XXXXXX' || right({d}, 4) ELSE 'XXXXXXXXXX' END
        WHEN contains({t}, 'EMAIL') THEN CASE WHEN NOT contains({v}, '@') THEN '*****@***.com'
            WHEN length({local}) > 2 THEN left({local}, 2) || repeat('*', length({local}) - 2) || '@' || substr({v}, length({local}) + 2)
            ELSE left({local}, 1) || '*@' || substr({v}, length({local}) + 2) END
        WHEN contains({t}, 'BANK') OR contains({t}, 'ACCOUNT') THEN CASE WHEN length({d}) >= 4 THEN repeat('*', length({d}) - 4) || right({d}, 4) ELSE 'XXXXXXXXXXXX' END
        WHEN contains({t}, 'CARD') OR contains({t}, 'CREDIT') THEN CASE WHEN length({d}) >= 16 THEN 'XXXX-XXXX-XXXX-' || right({d}, 4) ELSE 'XXXX-XXXX-XXXX-XXXX' END
        WHEN {t} IN ('DOB', 'DATE', 'DATE_OF_BIRTH') THEN CASE WHEN regexp_matches({v}, '(19|20)\\p{{Nd}}{{2}}') THEN '**/**/' || regexp_extract({v}, '(?:19|20)\\p{{Nd}}{{2}}') ELSE '**/**/****' END
        WHEN contains({t}, 'PASSPORT') THEN CASE WHEN length({c}) >= 8 THEN left({c}, 1) || 'XXXXX' || right({c}, 2) ELSE left({c}, 1) || 'XXXXXX' END
        WHEN contains({t}, 'PERSON') OR {t} IN ('NAME', 'PER') THEN CASE WHEN len({words}) = 0 THEN '[NAME]' ELSE {initials}[1] || array_to_string({initials}[2:], ' ') END
        WHEN contains({t}, 'LOCATION') OR contains({t}, 'ADDRESS') OR {t} = 'LOC' THEN '[LOCATION REDACTED]'
        WHEN contains({t}, 'ORG') THEN '[ORG REDACTED]' ELSE '[REDACTED]' END"""


def sql_display(label: str) -> str:
    known = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.DISPLAY_NAMES.items())
    words = f"string_split(lower(replace({label}, '_', ' ')), ' ')"
    return f"CASE {label} {known} ELSE array_to_string(list_transform({words}, lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') END"


def sql_language(x: str) -> str:
    deva, latin = rf"length(regexp_replace(coalesce({x}, ''), '[^\x{{0900}}-\x{{097F}}]', '', 'g'))", f"length(regexp_replace(coalesce({x}, ''), '[^A-Za-z]', '', 'g'))"
    share = f"{deva} / greatest({deva} + {latin}, 1)"
    return f"CASE WHEN {deva} = 0 THEN 'English' WHEN {latin} = 0 THEN 'Hindi' WHEN {share} > 0.6 THEN 'Hindi' WHEN {share} > 0.2 THEN 'Mixed' ELSE 'English' END"


def sql_sanitise(x: str, full: bool = True) -> str:
    t = rf"""regexp_replace({x}, '(?i)[{S_IN}]*data-[\p{{L}}\p{{N}}_]+="[^"]*"', '', 'g')"""
    t = f"regexp_replace({t}, '<[^>]+>', '', 'g')"
    t = rf"regexp_replace({t}, '(?m)^[{S_IN}]*\|?[-:{S_IN}|]+\|?[{S_IN}]*$', '', 'g')"
    cells = f"list_filter(list_transform(string_split(substr(l, 2, length(l) - 2), '|'), lambda c: {sql_strip('c')}), lambda c: c <> '')"
    t = rf"array_to_string(list_transform(string_split({t}, chr(10)), lambda l: CASE WHEN regexp_matches(l, '^\|.+\|$') THEN array_to_string({cells}, '  ') ELSE l END), chr(10))"
    t = f"regexp_replace({t}, '(?m)^#{{1,6}}[{S_IN}]*', '', 'g')"
    t = rf"regexp_replace({t}, '\*\*(.+?)\*\*', '\1', 'g')"
    if full:
        t = rf"regexp_replace({t}, '_(.+?)_', '\1', 'g')"
        t = rf"regexp_replace({t}, '[ \t]+', ' ', 'g')"
    return sql_strip(rf"regexp_replace({t}, '\n{{3,}}', chr(10) || chr(10), 'g')")


# queries --------------------------------------------------------------------------------------------------------------
Q: dict[str, Query] = {}
O: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


@query("lang_detect", f"WITH {TEXTS} SELECT record_id, {sql_language('text')} AS language_tag FROM texts")
def lang_detect(spark, d):
    return of_texts(spark, d, tx.language(extracted()).alias("language_tag"))


@query("lang_histogram", f"WITH {TEXTS} SELECT {sql_language('text')} AS language_tag, count(*) AS n_records FROM texts GROUP BY 1")
def lang_histogram(spark, d):
    return lang_detect(spark, d).groupBy("language_tag").agg(F.count("*").alias("n_records"))


@query("digit_normalise", f"WITH {TEXTS} SELECT record_id, {sql_normal('text')} AS normal FROM texts")
def digit_normalise(spark, d):
    return of_texts(spark, d, tx.normalise_digits(extracted()).alias("normal"))


def _label_query(label: str) -> None:
    @query(f"pii_hits_{label.lower()}", f"WITH {sql_hits([label], places=False)} SELECT record_id, ord, value FROM hits")
    def one(spark, d):
        return exploded(of_texts(spark, d, tx.let(tx.normalise_digits(extracted()), lambda n: pii.label_hits(n, label)).alias("v")), "v", "ord", "value")


for _label in K.PATTERNS:
    _label_query(_label)


@query("pii_hits_all", f"WITH {sql_hits(list(K.PATTERNS))} SELECT record_id, ord, label, value FROM hits")
def pii_hits_all(spark, d):
    return exploded(hits(spark, d), "hits", "ord", "h").select("record_id", "ord", "h.label", "h.value")


@query(
    "city_scan",
    f"WITH {TEXTS} SELECT record_id, c.name AS city FROM texts JOIN (VALUES {', '.join(f'({chr(39)}{c}{chr(39)}, {chr(39)}{c.title()}{chr(39)})' for c in K.CITIES)}) c(low, name) ON contains(lower(text), c.low)",
)
def city_scan(spark, d):
    return exploded(of_texts(spark, d, pii.places(extracted()).alias("cities")), "cities", "city")


@query("pii_masked", f"SELECT DISTINCT label, hit_value, {sql_mask('label', 'hit_value')} AS masked FROM pii_hits WHERE label IS NOT NULL AND hit_value IS NOT NULL")
def pii_masked(spark, d):
    values = table(spark, d, "pii_hits").filter("label IS NOT NULL AND hit_value IS NOT NULL").select("label", "hit_value").distinct()
    return values.select("label", "hit_value", pii.mask(F.col("label"), F.col("hit_value")).alias("masked"))


_NOT = "array_to_string(list_transform(list_filter([{labels}], lambda x: NOT list_contains(coalesce(list_transform(labels, lambda l: upper(l)), []), upper(x))), lambda x: {show}), ', ')"
_NOT_DETECTED = _NOT.format(labels=sql_list(list(K.DISPLAY_NAMES)), show=sql_display("x"))


@query(
    "pii_summary",
    f"""WITH {sql_hits(list(K.PATTERNS))},
        per AS (SELECT record_id, string_agg('[' || label || '] ' || value, ' | ' ORDER BY ord) AS det, string_agg({sql_mask('label', 'value')}, ' | ' ORDER BY ord) AS anon, list(label) AS labels FROM hits GROUP BY record_id)
        SELECT t.record_id, coalesce(det, 'None') AS detected, coalesce(anon, 'None') AS masked, coalesce(nullif({_NOT_DETECTED}, ''), 'All PII types detected') AS not_detected
        FROM texts t LEFT JOIN per ON per.record_id IS NOT DISTINCT FROM t.record_id""",
)
def pii_summary(spark, d):
    h = F.col("hits")
    return hits(spark, d).select("record_id", pii.detected_text(h).alias("detected"), pii.masked_text(h).alias("masked"), pii.not_detected_text(h).alias("not_detected"))


@query(
    "pii_by_display_name",
    f"""WITH {sql_hits(list(K.PATTERNS))} SELECT record_id, {sql_display('label')} AS display_name, string_agg(value, ', ' ORDER BY ord) AS found, count(*) AS n_values FROM hits GROUP BY 1, 2""",
)
def pii_by_display_name(spark, d):
    groups = exploded(hits(spark, d).withColumn("groups", pii.values_by_name(F.col("hits"))), "groups", "g")
    return groups.select("record_id", "g.display_name", F.array_join("g.values", ", ").alias("found"), F.size("g.values").cast("bigint").alias("n_values"))


@query("files_with_pii", f"WITH {sql_hits(list(K.PATTERNS))} SELECT count(DISTINCT record_id) AS files_with_pii FROM hits")
def files_with_pii(spark, d):
    return spread(table(spark, d, "sheet3").select("record_id", "full_extracted_text")).filter(F.size(pii.regex_hits(extracted())) > 0).agg(F.countDistinct("record_id").alias("files_with_pii"))


@query("label_counts", f"WITH {sql_hits(list(K.PATTERNS))} SELECT upper(label) AS label, count(*) AS n_hits, count(DISTINCT record_id) AS n_records FROM hits GROUP BY 1")
def label_counts(spark, d):
    return pii_hits_all(spark, d).groupBy(F.upper("label").alias("label")).agg(F.count("*").alias("n_hits"), F.countDistinct("record_id").alias("n_records"))


@query(
    "pii_types_missing",
    f"""WITH {sql_hits(list(K.PATTERNS))} SELECT t.record_id, l.label FROM texts t CROSS JOIN (SELECT unnest([{sql_list(list(K.PATTERNS))}]) AS label) l
        WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.record_id = t.record_id AND upper(h.label) = upper(l.label))""",
)
def pii_types_missing(spark, d):
    found = F.transform(F.col("hits"), lambda h: F.upper(h["label"]))
    left = tx.let(found, lambda f: F.filter(F.array(*map(F.lit, K.PATTERNS)), lambda x: ~F.array_contains(f, F.upper(x))))
    return exploded(hits(spark, d).withColumn("left", left), "left", "label")


@query(
    "hits_merged",
    f"""WITH raws AS (SELECT DISTINCT record_id, hit_no, source, label, hit_value FROM pii_hits WHERE label IS NOT NULL AND {sql_strip('hit_value')} <> ''),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY record_id, upper(label), {sql_key('hit_value')}
            ORDER BY list_position([{sql_list(pii.PRIORITY)}], source), hit_no, source, label, hit_value) AS rn FROM raws)
        SELECT record_id, source, label, hit_value FROM ranked WHERE rn = 1""",
)
def hits_merged(spark, d):
    raw = table(spark, d, "pii_hits").select("record_id", "hit_no", "source", "label", "hit_value").filter(F.col("label").isNotNull() & (tx.strip(F.col("hit_value")) != "")).distinct()
    rank = F.array_position(F.array(*map(F.lit, pii.PRIORITY)), F.col("source"))
    # first of each value by priority: a partial aggregate, not a window, so a hot group is reduced before the shuffle
    best = F.min(F.struct(rank.alias("p"), "hit_no", "source", "label", "hit_value")).alias("b")
    return raw.groupBy("record_id", F.upper("label").alias("u"), pii.value_key(F.col("hit_value")).alias("k")).agg(best).select("record_id", "b.source", "b.label", "b.hit_value")


@query("sanitise_ocr", f"WITH {TEXTS} SELECT record_id, {sql_sanitise('text')} AS clean FROM texts")
def sanitise_ocr(spark, d):
    return of_texts(spark, d, tx.sanitise(extracted()).alias("clean"))


@query("strip_markup", f"WITH {TEXTS} SELECT record_id, {sql_sanitise('text', full=False)} AS clean FROM texts")
def strip_markup(spark, d):
    return of_texts(spark, d, tx.sanitise(extracted(), italics_and_spaces=False).alias("clean"))


_MD = sql_strip(r"regexp_replace(regexp_replace(l, '^\|', ''), '\|+$', '')")
_MD = rf"regexp_replace(regexp_replace({_MD}, '[{S_IN}]*\|[{S_IN}]*', '  ', 'g'), '^[-*][{S_IN}]+', '')"


@query(
    "md_lines",
    f"""WITH {TEXTS} SELECT record_id, array_to_string(list_filter(list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda l: {sql_strip('l')}),
        lambda l: l <> '' AND NOT regexp_matches(l, '^[-:{S_IN}]+$')), lambda l: {_MD}), lambda l: l <> ''), chr(10)) AS md FROM texts""",
)
def md_lines(spark, d):
    return of_texts(spark, d, F.array_join(tx.markdown_lines(extracted()), "\n").alias("md"))


@query(
    "text_lines",
    rf"WITH {TEXTS} SELECT record_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)), lambda l: {sql_strip('l')}), lambda l: l <> ''), chr(10)) AS lines FROM texts",
)
def text_lines(spark, d):
    return of_texts(spark, d, tx.text_lines(extracted()).alias("lines"))


@query(
    "chunks",
    """WITH t AS (SELECT DISTINCT record_id, spell_corrected_text AS text FROM sheet2 WHERE spell_corrected_text IS NOT NULL),
        n AS (SELECT *, unnest(range(0, CASE WHEN length(text) <= 1800 THEN 1 ELSE CAST(ceil((length(text) - 1800) / 1600.0) AS BIGINT) + 1 END)) AS i FROM t)
        SELECT record_id, CAST(i + 1 AS BIGINT) AS chunk_no, substr(text, CAST(i * 1600 + 1 AS BIGINT), 1800) AS chunk FROM n""",
)
def chunk_rows(spark, d):
    text = F.col("spell_corrected_text")
    made = table(spark, d, "sheet2").select("record_id", F.xxhash64(text).alias("text_key"), tx.chunks(text).alias("chunks"))
    # repeated rows go by their chunks, each by itself, so that no shuffled row holds a whole text
    return exploded(made, "chunks", "chunk_no", "chunk", keep=["record_id", "text_key"]).distinct().drop("text_key")


@query(
    "title_names",
    f"WITH {TEXTS}, n AS (SELECT record_id, regexp_extract_all(text, '{ascii_bounds(K.TITLE_NAME)}') AS l FROM texts) SELECT record_id, unnest(l) AS name, CAST(generate_subscripts(l, 1) AS BIGINT) AS ord FROM n",
)
def title_name_rows(spark, d):
    return exploded(of_texts(spark, d, tx.title_names(extracted()).alias("names")), "names", "ord", "name")


_NOISE = K.NOISE_WORDS + K.EXCLUDED_ORGS


@query(
    "missed_entities",
    rf"""WITH {TEXTS}, w AS (SELECT record_id, regexp_split_to_array({sql_strip('text')}, '[{S_IN}]+') AS l FROM texts),
        u AS (SELECT record_id, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM w),
        c AS (SELECT record_id, w, pos, regexp_replace(w, '[^\p{{L}}\p{{N}}_]', '', 'g') AS c FROM u),
        k AS (SELECT *, row_number() OVER (PARTITION BY record_id, lower(c) ORDER BY pos) AS rn FROM c WHERE length(c) > 3 AND regexp_matches(w, '^\p{{Lu}}')
            AND w NOT IN ({sql_list(_NOISE)}) AND lower(c) NOT IN ({sql_list([x.lower() for x in _NOISE])}))
        SELECT record_id, c AS word FROM k WHERE rn = 1""",
)
def missed_entities(spark, d):
    none = F.array().cast("array<string>")
    return exploded(of_texts(spark, d, tx.missed_words(extracted(), none).alias("words")), "words", "word")


def sql_fixed(source: str) -> str:
    """CTEs up to fixed(text, corrected) for a query of distinct texts that aren't null."""
    return rf"""w AS (SELECT text, regexp_matches(text, '[\x{{0900}}-\x{{097F}}]') OR text = '' AS kept, regexp_split_to_array({sql_strip('text')}, '[{S_IN}]+') AS l FROM ({source})),
        u AS (SELECT text, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM w WHERE NOT kept),
        d AS (SELECT term, max(term_count) AS n FROM spell_dictionary WHERE term IS NOT NULL GROUP BY term),
        v AS (SELECT DISTINCT w, regexp_replace(w, '[^\x00-\x7f]', chr(127), 'g') AS x FROM u WHERE NOT (regexp_full_match(w, '[A-Z]{{2,}}') OR regexp_full_match(w, '[\p{{Nd}}²³¹]*([^\p{{L}}\p{{N}}_][\p{{Nd}}]*)*') OR contains(w, '@') OR length(w) <= 2)),
        p AS (SELECT w, x, term, n FROM v JOIN d ON abs(length(w) - length(term)) <= 2 AND damerau_levenshtein(x, term) <= 2),
        o AS (SELECT w, term, n, least(levenshtein(x, term), coalesce(list_min(flatten(list_transform(range(1, length(x)), lambda i: list_transform([i - 1, i, i + 1], lambda j:
            CASE WHEN j >= 1 AND substr(term, j, 2) = substr(x, i + 1, 1) || substr(x, i, 1)
                THEN 1 + damerau_levenshtein(substr(x, 1, i - 1), substr(term, 1, j - 1)) + damerau_levenshtein(substr(x, i + 2), substr(term, j + 2)) ELSE 9 END)))), 9)) AS e FROM p),
        c AS (SELECT w, term, row_number() OVER (PARTITION BY w ORDER BY e, n DESC, term) AS rn FROM o WHERE e <= 2),
        g AS (SELECT text, string_agg(coalesce(c.term, u.w), ' ' ORDER BY pos) AS corrected FROM u LEFT JOIN c ON c.w = u.w AND c.rn = 1 GROUP BY text),
        fixed AS (SELECT w.text, CASE WHEN w.kept THEN w.text ELSE g.corrected END AS corrected FROM w LEFT JOIN g ON g.text = w.text)"""


@query("spell_correct", f"WITH {TEXTS}, {sql_fixed('SELECT DISTINCT text FROM texts WHERE text IS NOT NULL')} SELECT record_id, corrected FROM texts JOIN fixed USING (text)")
def spell_correct(spark, d):
    rows = spread(table(spark, d, "sheet3").select("record_id", F.col("full_extracted_text").alias("text"), F.xxhash64("full_extracted_text").alias("text_key")).filter("text IS NOT NULL"))
    return correct(rows, "text", table(spark, d, "spell_dictionary"), "corrected").drop("text").distinct().drop("text_key")


def scripted_speller(texts: pd.Series) -> pd.Series:
    """A stand-in for a spelling model: of three texts it answers one, leaves one empty and one to the dictionary."""
    return texts.map(lambda t: {0: None, 1: " "}.get(len(t) % 3, t + " ok"))


@query(
    "spell_model",
    rf"""WITH {TEXTS}, {sql_fixed('SELECT DISTINCT text FROM texts WHERE text IS NOT NULL')}
        SELECT record_id, CASE WHEN regexp_matches(text, '[\x{{0900}}-\x{{097F}}]') OR text = '' OR least(length(text), 2000) % 3 = 0 THEN corrected WHEN least(length(text), 2000) % 3 = 1 THEN text
            ELSE {sql_strip("(left(text, 2000) || ' ok')")} END AS corrected FROM texts JOIN fixed USING (text)""",
)
def spell_model(spark, d):
    rows = spread(table(spark, d, "sheet3").select("record_id", F.col("full_extracted_text").alias("text"), F.xxhash64("full_extracted_text").alias("text_key")).filter("text IS NOT NULL"))
    return correct(rows, "text", table(spark, d, "spell_dictionary"), "corrected", model=scripted_speller).drop("text").distinct().drop("text_key")


_ROUTE = f"CASE WHEN {' OR '.join(f'ends_with(lower(path), {chr(39)}{e}{chr(39)})' for e in K.IMAGE_EXTENSIONS)} THEN 'image' WHEN {' OR '.join(f'ends_with(lower(path), {chr(39)}{e}{chr(39)})' for e in K.DOCUMENT_EXTENSIONS)} THEN 'document' END"


@query("ext_route", f"SELECT DISTINCT path, {_ROUTE} AS route FROM source_files")
def ext_route(spark, d):
    return table(spark, d, "source_files").select("path", rec.route(F.col("path")).alias("route")).distinct()


@query("file_counts", f"SELECT coalesce({_ROUTE}, 'other') AS route, count(DISTINCT path) AS n_files FROM source_files GROUP BY 1")
def file_counts(spark, d):
    return table(spark, d, "source_files").groupBy(F.coalesce(rec.route(F.col("path")), F.lit("other")).alias("route")).agg(F.countDistinct("path").alias("n_files"))


def records(spark, d) -> DataFrame:
    """Records of the delivered files with the texts that the report kept of them, corrected."""
    files = table(spark, d, "source_files").select("record_id", "path").distinct()
    raw = spread(table(spark, d, "sheet3").select("record_id", F.col("full_extracted_text").alias("raw_text"))).join(files, "record_id")
    # a path is one file; of several texts the first in order counts
    raw = raw.groupBy("path").agg(F.min("raw_text").alias("raw_text"))
    made = rec.build_records(by_key(files, "path"), raw, ["record_id", "path"])
    return rec.with_language(correct(made, "raw_text", table(spark, d, "spell_dictionary"), "corrected_text", where="NOT is_failed"))


_F = "regexp_extract(path, '[^/]*$')"
_RECORDS = f"""{TEXTS}, files AS (SELECT DISTINCT record_id, path FROM source_files),
    ocr AS (SELECT path, min(text) AS raw_text FROM texts JOIN files USING (record_id) GROUP BY path),
    routed AS (SELECT f.record_id, f.path, {_F.replace('path', 'f.path')} AS source_file, {_ROUTE.replace('path', 'f.path')} AS route, raw_text FROM files f LEFT JOIN ocr r ON r.path = f.path),
    made AS (SELECT record_id, path, source_file, CASE WHEN route = 'image' THEN 'IMAGE' ELSE upper(regexp_extract(source_file, '\\.([^.]*)$', 1)) END AS file_type,
        CASE WHEN route = 'image' THEN coalesce(raw_text, '[OCR FAILED: ' || source_file || ']') WHEN coalesce({sql_strip('raw_text')}, '') = '' THEN '[EMPTY: ' || source_file || ']' ELSE raw_text END AS raw_text,
        CASE WHEN route = 'image' THEN starts_with(coalesce(raw_text, '[OCR'), '[OCR') ELSE coalesce({sql_strip('raw_text')}, '') = '' END AS is_failed FROM routed WHERE route IS NOT NULL),
    {sql_fixed('SELECT DISTINCT raw_text AS text FROM made WHERE NOT is_failed')},
    records AS (SELECT made.*, CASE WHEN is_failed THEN raw_text ELSE fixed.corrected END AS corrected_text, {sql_language('raw_text')} AS language FROM made LEFT JOIN fixed ON fixed.text = made.raw_text)"""


@query("record_build", f"WITH {_RECORDS} SELECT record_id, path, source_file, file_type, raw_text, is_failed, corrected_text, language FROM records")
def record_build(spark, d):
    return records(spark, d)


def _report_hits() -> str:
    body = sql_hits(list(K.PATTERNS)).replace(TEXTS, f"{_RECORDS}, scanned AS (SELECT record_id, corrected_text AS text FROM records WHERE NOT is_failed)")
    head, tail = body.split("scanned AS", 1)
    return head + "scanned AS" + tail.replace("FROM texts", "FROM scanned")


@query(
    "sheet3",
    f"""WITH {_report_hits()}, named AS (SELECT record_id, min(ord) AS o, {sql_display('label')} || ': ' || string_agg(value, ', ' ORDER BY ord) AS part FROM hits GROUP BY record_id, {sql_display('label')}),
        types AS (SELECT record_id, string_agg(part, ' | ' ORDER BY o) AS found FROM named GROUP BY record_id),
        per AS (SELECT record_id, string_agg('[' || label || '] ' || value, ' | ' ORDER BY ord) AS det, string_agg({sql_mask('label', 'value')}, ' | ' ORDER BY ord) AS anon, list(label) AS labels FROM hits GROUP BY record_id)
        SELECT r.record_id, source_file, file_type, language, raw_text AS full_extracted_text, corrected_text AS spell_corrected_text,
            CASE WHEN is_failed THEN 'OCR Failed' ELSE coalesce(det, 'None') END AS detected_pii_with_tags, CASE WHEN is_failed THEN 'OCR Failed' ELSE coalesce(anon, 'None') END AS anonymized_pii_output,
            CASE WHEN is_failed THEN 'N/A' ELSE coalesce(found, 'None') END AS pii_types_detected,
            CASE WHEN is_failed THEN 'N/A' ELSE coalesce(nullif({_NOT_DETECTED}, ''), 'All PII types detected') END AS pii_types_not_detected
        FROM records r LEFT JOIN per p ON p.record_id = r.record_id LEFT JOIN types y ON y.record_id = r.record_id""",
)
def sheet3(spark, d):
    return report.sheet3(records(spark, d), ["record_id"])


_TITLES = ascii_bounds(K.TITLE_NAME)
_MODELS2 = ", ".join(f"'Load Failed' AS {m.lower()}_predicted_type, 'N/A' AS {m.lower()}_extracted_text, 'N/A' AS {m.lower()}_missed_entities" for m in K.NER_MODELS)


@query(
    "sheet2",
    f"""WITH {_RECORDS} SELECT record_id, source_file, file_type, language, raw_text AS full_extracted_text, corrected_text AS spell_corrected_text,
        coalesce(nullif(array_to_string(regexp_extract_all(corrected_text, '{_TITLES}'), ' | '), ''), 'None') AS regex_detected_names, {_MODELS2} FROM records""",
)
def sheet2(spark, d):
    return report.sheet2(records(spark, d), ["record_id"])


@query(
    "sheet1",
    f"""WITH {_report_hits()}, m AS (SELECT unnest([{sql_list([f'{k} ({v})' for k, v in K.NER_MODELS.items()])}]) AS model_name)
        SELECT model_name, (SELECT count(*) FROM records) AS total_files_processed, CAST(0 AS BIGINT) AS files_with_names, CAST(0 AS BIGINT) AS total_names_found, CAST(0 AS BIGINT) AS files_with_org, CAST(0 AS BIGINT) AS files_with_loc,
            (SELECT count(DISTINCT record_id) FROM hits) AS files_with_pii, CAST(0 AS DOUBLE) AS name_detection_rate FROM m""",
)
def sheet1(spark, d):
    return report.sheet1(records(spark, d))


_UNPIVOT = " UNION ALL ".join(f"SELECT record_id, run_id, '{m}' AS model, {m.lower()}_predicted_type AS kind FROM sheet2" for m in K.NER_MODELS)


@query(
    "model_summary",
    f"""WITH l AS (SELECT DISTINCT * FROM ({_UNPIVOT})),
        c AS (SELECT run_id, model, count(*) AS total_files, count(*) FILTER (contains(kind, 'PER')) AS files_with_names, count(*) FILTER (contains(kind, 'ORG')) AS files_with_org, count(*) FILTER (contains(kind, 'LOC')) AS files_with_loc FROM l GROUP BY 1, 2)
        SELECT *, round_even(100.0 * files_with_names / total_files, 2) AS name_detection_rate FROM c""",
)
def model_summary(spark, d):
    long = table(spark, d, "sheet2").select("record_id", "run_id", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"{m.lower()}_predicted_type").alias("kind")) for m in K.NER_MODELS])).alias("x"))
    long = long.select("record_id", "run_id", "x.model", "x.kind").distinct()
    counts = long.groupBy("run_id", "model").agg(
        F.count("*").alias("total_files"), *[F.count_if(F.contains("kind", F.lit(g))).alias(f"files_with_{n}") for g, n in (("PER", "names"), ("ORG", "org"), ("LOC", "loc"))]
    )
    return counts.withColumn("name_detection_rate", F.bround(100.0 * F.col("files_with_names") / F.col("total_files"), 2))


_WIDTHS = ["source_file", "file_type", "language", "full_extracted_text", "spell_corrected_text", "detected_pii_with_tags", "anonymized_pii_output", "pii_types_detected", "pii_types_not_detected"]


@query("column_widths", " UNION ALL ".join(f"SELECT '{c}' AS column_name, least(greatest(max(coalesce(length({c}), 0)), {len(c)}) + 4, 60) AS width FROM sheet3" for c in _WIDTHS))
def column_widths(spark, d):
    sheet = table(spark, d, "sheet3").agg(*[F.least(F.greatest(F.max(F.coalesce(F.length(c), F.lit(0))), F.lit(len(c))) + 4, F.lit(60)).cast("bigint").alias(c) for c in _WIDTHS])
    return sheet.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("width")) for c in _WIDTHS])).alias("x")).select("x.*")


SHEETS = {"Model Summary": "sheet1", "OCR NER Comparison": "sheet2", "PII Detection Tagged": "sheet3"}


@query("sheet_sizes", " UNION ALL ".join(f"SELECT '{s}' AS sheet, count(*) AS n_rows FROM (SELECT DISTINCT * FROM {t})" for s, t in SHEETS.items()))
def sheet_sizes(spark, d):
    parts = [table(spark, d, t).distinct().agg(F.count("*").alias("n_rows")).select(F.lit(s).alias("sheet"), "n_rows") for s, t in SHEETS.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# the model side: what detectors and models said is in sheet2 and pii_hits, and goes through the operators as their output
LOADED = [m for m in K.NER_MODELS if m != "XLM_RoBERTa"]  # one model stays out, as if it couldn't be loaded
SAID = r"^(PER|ORG|LOC): "


def said(column: str) -> Column:
    """Entities that a cell of a model's report lists, as the model's output."""
    groups = F.filter(F.split(F.col(column), r" \|\| "), lambda g: g.rlike(SAID))
    one = F.transform(groups, lambda g: F.transform(F.split(F.regexp_replace(g, SAID, ""), r" \| "), lambda w: F.struct(F.left(g, F.lit(3)).alias("label"), w.alias("value"))))
    return F.flatten(one)


_FAILED = rf"coalesce(regexp_matches(full_extracted_text, '^[{S_IN}]*$|^\[(OCR FAILED|OCR EMPTY|EMPTY): '), true)"


def judged_records(spark, d) -> DataFrame:
    """Records of the comparison sheet, with what each loaded model said."""
    text = F.col("full_extracted_text")
    failed = F.coalesce(text.rlike(rf"^[{K.S_IN}]*$|^\[(OCR FAILED|OCR EMPTY|EMPTY): "), F.lit(True))
    kept = ["record_id", "source_file", "file_type", "language", text.alias("raw_text"), F.coalesce("spell_corrected_text", F.lit("")).alias("corrected_text"), failed.alias("is_failed")]
    return spread(table(spark, d, "sheet2")).select(*kept, *[F.col(f"{m.lower()}_extracted_text").alias(m) for m in LOADED]).distinct()


def _judged() -> str:
    """CTEs up to report(record_id, uid, model, names, orgs, locs, predicted_type, extracted_text, missed_entities)."""
    cells = " UNION ALL ".join(f"SELECT uid, corrected_text, is_failed, '{m}' AS model, {m.lower()}_extracted_text AS cell FROM judged" for m in LOADED)
    cols = ", ".join(f"{m.lower()}_extracted_text" for m in LOADED)
    return rf"""judged AS (SELECT row_number() OVER () AS uid, * FROM (SELECT DISTINCT record_id, source_file, file_type, language, full_extracted_text AS raw_text, coalesce(spell_corrected_text, '') AS corrected_text,
            {_FAILED} AS is_failed, {cols} FROM sheet2)),
        cells AS (SELECT * FROM ({cells}) WHERE NOT is_failed),
        gs AS (SELECT uid, model, unnest(string_split(cell, ' || ')) AS g, generate_subscripts(string_split(cell, ' || '), 1) AS gi FROM cells),
        ws AS (SELECT uid, model, left(g, 3) AS grp, gi, unnest(string_split(substr(g, 6), ' | ')) AS w, generate_subscripts(string_split(substr(g, 6), ' | '), 1) AS wi FROM gs WHERE regexp_matches(g, '{SAID}')),
        cw AS (SELECT uid, model, grp, gi, wi, {sql_strip("replace(" + sql_strip('w') + ", '##', '')")} AS w FROM ws),
        bk AS (SELECT *, row_number() OVER (PARTITION BY uid, model, lower(w) ORDER BY gi, wi) AS rn FROM cw WHERE w <> '' AND upper(w) NOT IN ({sql_list(K.EXCLUDED_ORGS)})),
        ti AS (SELECT uid, model, unnest(l) AS w, generate_subscripts(l, 1) AS wi FROM (SELECT uid, model, regexp_extract_all(corrected_text, '{_TITLES}') AS l FROM cells)),
        nm AS (SELECT uid, model, 0 AS gi, wi, {sql_strip('w')} AS w FROM ti UNION ALL SELECT uid, model, gi, wi, w FROM bk WHERE rn = 1 AND grp = 'PER'),
        na AS (SELECT *, row_number() OVER (PARTITION BY uid, model, lower(w) ORDER BY gi, wi) AS rn FROM nm WHERE w NOT IN ('', 'None') AND upper(w) NOT IN ({sql_list(K.EXCLUDED_ORGS)})),
        said_words AS (SELECT uid, model, 'PER' AS grp, gi, wi, w FROM na WHERE rn = 1 UNION ALL SELECT uid, model, grp, gi, wi, w FROM bk WHERE rn = 1 AND grp <> 'PER'),
        lists AS (SELECT uid, model, list(w ORDER BY gi, wi) FILTER (grp = 'PER') AS names, list(w ORDER BY gi, wi) FILTER (grp = 'ORG') AS orgs, list(w ORDER BY gi, wi) FILTER (grp = 'LOC') AS locs, list(lower(w)) AS found FROM said_words GROUP BY 1, 2),
        tw AS (SELECT uid, model, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM (SELECT uid, model, regexp_split_to_array({sql_strip('corrected_text')}, '[{S_IN}]+') AS l FROM cells)),
        mw AS (SELECT tw.uid, tw.model, pos, w, regexp_replace(w, '[^\p{{L}}\p{{N}}_]', '', 'g') AS c FROM tw),
        mk AS (SELECT mw.uid, mw.model, pos, c, row_number() OVER (PARTITION BY mw.uid, mw.model, lower(c) ORDER BY pos) AS rn FROM mw LEFT JOIN lists ON lists.uid = mw.uid AND lists.model = mw.model
            WHERE length(c) > 3 AND regexp_matches(w, '^\p{{Lu}}') AND NOT coalesce(list_contains(found, lower(c)), false) AND w NOT IN ({sql_list(_NOISE)}) AND lower(c) NOT IN ({sql_list([x.lower() for x in _NOISE])})),
        mi AS (SELECT uid, model, string_agg(c, ' | ' ORDER BY pos) AS missed FROM mk WHERE rn = 1 GROUP BY 1, 2),
        report AS (SELECT c.uid, c.model, coalesce(len(names), 0) AS n_names, coalesce(len(orgs), 0) AS n_orgs, coalesce(len(locs), 0) AS n_locs,
            coalesce(nullif(array_to_string(list_filter([CASE WHEN len(names) > 0 THEN 'PER' END, CASE WHEN len(orgs) > 0 THEN 'ORG' END, CASE WHEN len(locs) > 0 THEN 'LOC' END], lambda x: x IS NOT NULL), ', '), ''), 'None') AS predicted_type,
            coalesce(nullif(array_to_string(list_filter([CASE WHEN len(names) > 0 THEN 'PER: ' || array_to_string(names, ' | ') END, CASE WHEN len(orgs) > 0 THEN 'ORG: ' || array_to_string(orgs, ' | ') END,
                CASE WHEN len(locs) > 0 THEN 'LOC: ' || array_to_string(locs, ' | ') END], lambda x: x IS NOT NULL), ' || '), ''), 'None') AS extracted_text, coalesce(missed, 'None') AS missed_entities
            FROM cells c LEFT JOIN lists l ON l.uid = c.uid AND l.model = c.model LEFT JOIN mi ON mi.uid = c.uid AND mi.model = c.model)"""


def _model_cells(m: str) -> str:
    if m not in LOADED:
        return f"'Load Failed' AS {m.lower()}_predicted_type, 'N/A' AS {m.lower()}_extracted_text, 'N/A' AS {m.lower()}_missed_entities"
    parts = [f"CASE WHEN j.is_failed THEN '{fail}' ELSE r_{m}.{c} END AS {m.lower()}_{c}" for c, fail in zip(report.MODEL_COLUMNS, ("OCR Failed", "N/A", "N/A"))]
    return ", ".join(parts)


@query(
    "sheet2_models",
    f"""WITH {_judged()} SELECT record_id, source_file, coalesce(nullif(array_to_string(regexp_extract_all(corrected_text, '{_TITLES}'), ' | '), ''), 'None') AS regex_detected_names, {', '.join(map(_model_cells, K.NER_MODELS))}
        FROM judged j {' '.join(f"LEFT JOIN report r_{m} ON r_{m}.uid = j.uid AND r_{m}.model = '{m}'" for m in LOADED)}""",
)
def sheet2_models(spark, d):
    sheet = report.sheet2(judged_records(spark, d), ["record_id"], {m: said(m) for m in LOADED})
    return sheet.drop("file_type", "language", "full_extracted_text", "spell_corrected_text")


# detectors' hits: those of pii_hits that aren't the scan's own, each once, by priority and number
_FOUND = f"""raws AS (SELECT record_id, label, {sql_strip('hit_value')} AS value, list_position([{sql_list(pii.PRIORITY)}], source) AS p, hit_no FROM pii_hits
        WHERE record_id IS NOT NULL AND source IN ({sql_list(pii.PRIORITY[1:])}) AND label IS NOT NULL AND {sql_strip('hit_value')} <> ''),
    singles AS (SELECT *, row_number() OVER (PARTITION BY record_id, upper(label), {sql_key('value')} ORDER BY p, hit_no, label, value) AS sn FROM raws)"""


def detectors_found(spark, d) -> DataFrame:
    """record_id, found: hits of the detectors by priority. First occurrences are kept before the hits of a record are gathered."""
    source = F.col("source")
    raw = table(spark, d, "pii_hits").filter(F.col("record_id").isNotNull() & source.isin(pii.PRIORITY[1:]) & F.col("label").isNotNull() & (tx.strip(F.col("hit_value")) != ""))
    rank = F.array_position(F.array(*map(F.lit, pii.PRIORITY)), source)
    first = F.min(F.struct(rank.alias("p"), "hit_no", "label", tx.strip(F.col("hit_value")).alias("value"), "source")).alias("b")
    singles = raw.groupBy("record_id", F.upper("label").alias("u"), pii.value_key(F.col("hit_value")).alias("k")).agg(first)
    ordered = F.array_sort(F.collect_list("b"))
    return singles.groupBy("record_id").agg(F.transform(ordered, lambda b: F.struct(b["source"], b["label"], b["value"])).alias("found"))


def _all_hits() -> str:
    """CTEs up to merged(uid, record_id, ord, label, value): the scan's hits, then the detectors', of records that haven't failed."""
    scan = sql_hits(list(K.PATTERNS)).replace(TEXTS + ",", "texts AS (SELECT uid AS record_id, corrected_text AS text FROM judged WHERE NOT is_failed),", 1).replace("raws", "scan_raws")
    return f"""{_judged()}, {scan}, {_FOUND},
        both_ AS (SELECT record_id AS uid, 0 AS p, ord AS o, 0 AS o2, label, value FROM hits UNION ALL SELECT uid, s.p, hit_no, 0, s.label, s.value FROM singles s JOIN judged j ON j.record_id = s.record_id WHERE sn = 1 AND NOT is_failed),
        one AS (SELECT *, row_number() OVER (PARTITION BY uid, upper(label), {sql_key('value')} ORDER BY p, o, label, value) AS rn FROM both_),
        merged AS (SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY p, o, label, value) AS ord, label, value FROM one WHERE rn = 1)"""


def with_found(spark, d) -> DataFrame:
    return by_key(judged_records(spark, d), "record_id").join(detectors_found(spark, d), "record_id", "left")


@query(
    "sheet3_detectors",
    f"""WITH {_all_hits()}, named AS (SELECT uid, min(ord) AS o, {sql_display('label')} || ': ' || string_agg(value, ', ' ORDER BY ord) AS part FROM merged GROUP BY uid, {sql_display('label')}),
        types AS (SELECT uid, string_agg(part, ' | ' ORDER BY o) AS found FROM named GROUP BY uid),
        per AS (SELECT uid, string_agg('[' || label || '] ' || value, ' | ' ORDER BY ord) AS det, string_agg({sql_mask('label', 'value')}, ' | ' ORDER BY ord) AS anon, list(label) AS labels FROM merged GROUP BY uid)
        SELECT record_id, source_file, CASE WHEN is_failed THEN 'OCR Failed' ELSE coalesce(det, 'None') END AS detected_pii_with_tags, CASE WHEN is_failed THEN 'OCR Failed' ELSE coalesce(anon, 'None') END AS anonymized_pii_output,
            CASE WHEN is_failed THEN 'N/A' ELSE coalesce(found, 'None') END AS pii_types_detected,
            CASE WHEN is_failed THEN 'N/A' ELSE coalesce(nullif({_NOT_DETECTED}, ''), 'All PII types detected') END AS pii_types_not_detected
        FROM judged j LEFT JOIN per p ON p.uid = j.uid LEFT JOIN types y ON y.uid = j.uid""",
)
def sheet3_detectors(spark, d):
    return report.sheet3(with_found(spark, d), ["record_id"], F.col("found")).drop("file_type", "language", "full_extracted_text", "spell_corrected_text")


@query(
    "sheet1_models",
    f"""WITH {_all_hits()}, m AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{k} ({v})')" for k, v in K.NER_MODELS.items())}) m(model, model_name)),
        c AS (SELECT model, count(*) FILTER (n_names > 0) AS files_with_names, sum(n_names)::BIGINT AS total_names_found, count(*) FILTER (n_orgs > 0) AS files_with_org, count(*) FILTER (n_locs > 0) AS files_with_loc FROM report GROUP BY 1)
        SELECT model_name, (SELECT count(*) FROM judged) AS total_files_processed, coalesce(files_with_names, 0) AS files_with_names, coalesce(total_names_found, 0) AS total_names_found, coalesce(files_with_org, 0) AS files_with_org,
            coalesce(files_with_loc, 0) AS files_with_loc, (SELECT count(DISTINCT uid) FROM merged) AS files_with_pii, round_even(100.0::DOUBLE * coalesce(files_with_names, 0) / greatest((SELECT count(*) FROM judged), 1), 2) AS name_detection_rate
        FROM m LEFT JOIN c ON c.model = m.model""",
)
def sheet1_models(spark, d):
    return report.sheet1(with_found(spark, d), {m: said(m) for m in LOADED}, F.col("found"))


def scripted_names(listed: dict[str, str]):
    """A stand-in for an entity model: the listed words of each chunk, as its output."""
    words = re.compile("[A-Za-z]+")

    def detect(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"entity_group": listed[w.lower()], "word": w} for w in words.findall(t) if w.lower() in listed])

    return detect


@query(
    "ner_chunked",
    """WITH t AS (SELECT DISTINCT record_id, spell_corrected_text AS text FROM sheet2 WHERE spell_corrected_text IS NOT NULL),
        n AS (SELECT *, unnest(range(0, CASE WHEN length(text) <= 1800 THEN 1 ELSE CAST(ceil((length(text) - 1800) / 1600.0) AS BIGINT) + 1 END)) AS i FROM t),
        w AS (SELECT record_id, text, i, unnest(l) AS w, generate_subscripts(l, 1) AS pos FROM (SELECT *, regexp_extract_all(substr(text, CAST(i * 1600 + 1 AS BIGINT), 1800), '[A-Za-z]+') AS l FROM n)),
        g AS (SELECT lower(token) AS low, CASE max(part_kind) WHEN 'given' THEN 'PER' WHEN 'surname' THEN 'LOC' ELSE 'OTHER' END AS grp FROM name_parts WHERE token IS NOT NULL GROUP BY 1),
        k AS (SELECT record_id, text, i, pos, w, grp, row_number() OVER (PARTITION BY record_id, text, lower(w) ORDER BY i, pos) AS rn FROM w JOIN g ON g.low = lower(w))
        SELECT record_id, CAST(row_number() OVER (PARTITION BY record_id, text ORDER BY i, pos) AS BIGINT) AS ord, grp, w AS word FROM k WHERE rn = 1""",
)
def ner_chunked(spark, d):
    groups = {"given": "PERSON", "surname": "GPE"}
    parts = table(spark, d, "name_parts").filter("token IS NOT NULL").groupBy(F.lower("token").alias("low")).agg(F.max("part_kind").alias("k"))
    listed = {r.low: groups.get(r.k, "MISC") for r in parts.collect()}  # a fixed table of some seventy words
    text = F.col("spell_corrected_text")
    rows = table(spark, d, "sheet2").filter(text.isNotNull()).select("record_id", F.xxhash64(text).alias("text_key"), detectors.model_entities("scripted", text, scripted_names(listed)).alias("e"))
    found = exploded(rows.withColumn("b", entities.buckets(F.col("e"))).select("record_id", "text_key", "b").distinct(), "b", "ord", "x")
    return found.select("record_id", "ord", F.col("x.label").alias("grp"), F.col("x.value").alias("word"))


def scripted_detector(kind: str):
    """Stand-ins for detectors, each with output in its model's own form."""

    def detect(texts: pd.Series, **asked) -> pd.Series:
        if kind == "Piiranha":
            return texts.map(lambda t: [{"entity_group": "TELEPHONENUM", "word": m[:5] + "##" + m[5:]} for m in re.findall("[6-9][0-9]{9}", t)])
        if kind == "GLiNER":
            label = asked["labels"][4]
            return texts.map(lambda t: [{"label": label, "text": m, "score": 0.9 if m[0] > "7" else 0.3} for m in re.findall("[6-9][0-9]{9}", t)])
        return texts.map(lambda t: [{"entity_type": "EMAIL_ADDRESS", "start": m.start(), "end": m.end()} for m in re.finditer(r"[A-Za-z0-9_.]+@[A-Za-z0-9.]+", t)])

    return detect


def _scripted(source: str, label: str, text: str, pattern: str, more: str = "TRUE") -> str:
    return f"SELECT record_id, text, '{source}' AS source, '{label}' AS label, unnest(l) AS value, generate_subscripts(l, 1) AS pos FROM (SELECT *, list_filter(regexp_extract_all({text}, '{pattern}'), lambda v: {more}) AS l FROM texts WHERE text IS NOT NULL)"


@query(
    "detectors_scripted",
    f"""WITH {TEXTS}, every AS ({_scripted('Presidio', 'EMAIL_ADDRESS', "CASE WHEN NOT regexp_matches(text, '[\\x{0900}-\\x{097F}]') THEN text END", '[A-Za-z0-9_.]+@[A-Za-z0-9.]+')}
            UNION ALL {_scripted('Piiranha', 'TELEPHONENUM', 'left(text, 512)', '[6-9][0-9]{9}')} UNION ALL {_scripted('GLiNER', 'PHONE_NUMBER', 'left(text, 1000)', '[6-9][0-9]{9}', "v[1] > '7'")}),
        k AS (SELECT *, row_number() OVER (PARTITION BY record_id, text, source, lower(value) ORDER BY pos) AS rn FROM every)
        SELECT record_id, source, label, value, CAST(row_number() OVER (PARTITION BY record_id, text, source ORDER BY pos) AS BIGINT) AS ord FROM k WHERE rn = 1""",
)
def detectors_scripted(spark, d):
    found = of_texts(spark, d, F.array(*[detectors.detector_hits(n, extracted(), scripted_detector(n)) for n in pii.PRIORITY[1:]]).alias("lists"))
    return exploded(exploded(found, "lists", "hits"), "hits", "ord", "h").select("record_id", "h.source", "h.label", "h.value", "ord")


PLANTED = [
    "Aadhaar 2345 6789 0123 and 234567890123, PAN ABCDE1234F, abcde1234f", "call 9876543210 or +91 9876543210 or +91 98 7654 3210", "a.b@mail.example and A.B@MAIL.EXAMPLE", "UHID: MRN0001234, episode.ABC-12345", "Passport K12345678 or Z1234567",
    "Voter ABC1234567, vehicle MH 12 AB 1234, mh12ab1234, MH-12-AB-1234", "account 1234567890129800001234 and 12345678901234", "card 4111 1111 1111 1111, 4111111111111111, 378282246310005", "born 12/05/1999, 31-12-2001, 32/13/1999", "PPP: ABCD1234, FAMILYID-X1Y2Z3W4, FID ABCDEF",
    "in New Delhi, Pune and GURUGRAM; the HOSPITAL", "123456789012345678901234567890", "", "no values here",
]


@query("pii_planted", f"WITH {sql_hits(list(K.PATTERNS)).replace(TEXTS, 'texts AS (SELECT CAST(i AS BIGINT) AS record_id, t AS text FROM (VALUES ' + ', '.join(f'({i}, {chr(39)}{t}{chr(39)})' for i, t in enumerate(PLANTED)) + ') x(i, t))')} SELECT record_id, ord, label, value, {sql_mask('label', 'value')} AS masked FROM hits")
def pii_planted(spark, d):
    rows = spark.createDataFrame(list(enumerate(PLANTED)), "record_id long, text string").select("record_id", pii.regex_hits(F.col("text")).alias("hits"))
    return exploded(rows, "hits", "ord", "h").select("record_id", "ord", "h.label", "h.value", pii.mask(F.col("h.label"), F.col("h.value")).alias("masked"))

"""Scan for identifiers, masking, and the per-document summary of hits. All native expressions, no shuffle.

A hit is a struct (source, label, value); arrays of hits keep scan order: patterns, then places, then detectors by
priority. Null text has no hits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilstone.constants import CITIES, DISPLAY_NAMES, EXCLUDED_ORGS, PATTERNS, S, S_IN
from veilstone.functions.text import keep_first, let, normalise_digits, strip

PRIORITY = ["Regex", "Presidio", "Piiranha", "GLiNER"]
MUST_HAVE = {"Email": "@"}
HIT = "array<struct<source:string,label:string,value:string>>"


def value_key(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, rf"[{S_IN}\-]", ""))


def matches(normal: Column, label: str) -> Column:
    """All values of one pattern in normalised text, in order."""
    every = F.regexp_extract_all(normal, F.lit(PATTERNS[label]), F.lit(0))
    if label in MUST_HAVE:  # the sign is looked for first: the pattern would try every word
        every = F.when(F.contains(normal, F.lit(MUST_HAVE[label])), every).otherwise(F.array().cast("array<string>"))
    return every


def firsts(values: Column) -> Column:
    """Values of a pattern without outer white space, excluded words and repeats."""
    return let(F.filter(F.transform(values, strip), lambda v: ~F.upper(v).isin(EXCLUDED_ORGS)), lambda a: keep_first(a, value_key))


def label_hits(normal: Column, label: str) -> Column:
    """Values of one pattern in normalised text, first of each kind."""
    return firsts(matches(normal, label))


def places(text: Column) -> Column:
    """City names the text contains, in alphabetical order."""
    return let(F.lower(text), lambda low: F.transform(F.filter(F.array(*map(F.lit, CITIES)), lambda c: F.contains(low, c)), F.initcap))


def regex_hits(text: Column) -> Column:
    def tag(values: Column, label: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit("Regex").alias("source"), label.alias("label"), v.alias("value")))

    # what is done with the values is said once for all patterns: a column of columns takes long to build and to plan
    raw = let(normalise_digits(text), lambda n: F.array(*[F.struct(F.lit(x).alias("label"), matches(n, x).alias("values")) for x in PATTERNS]))
    by_pattern = F.flatten(F.transform(F.filter(raw, lambda p: F.size(p["values"]) > 0), lambda p: tag(firsts(p["values"]), p["label"])))
    return F.coalesce(F.concat(by_pattern, tag(places(text), F.lit("Location"))), F.array().cast(HIT))


def merge_hits(*sources: Column) -> Column:
    """Hits of all detectors in priority order; a value found before under the same label, and blank ones, are dropped."""
    every = F.filter(F.concat(*sources), lambda h: strip(h["value"]) != "")
    return let(every, lambda a: keep_first(a, lambda h: F.concat(F.upper(h["label"]), F.lit("\x01"), value_key(h["value"]))))


def mask(label: Column, value: Column) -> Column:
    """Masked form of a value; the first rule that fits the label decides."""
    v, t = strip(value), F.upper(label)
    d, c = F.regexp_replace(v, r"\P{Nd}", ""), F.regexp_replace(v, f"{S}+", "")
    n, last4 = F.length(d), F.right(d, F.lit(4))

    def has(*words: str) -> Column:
        out = F.contains(t, F.lit(words[0]))
        for w in words[1:]:
            out = out | F.contains(t, F.lit(w))
        return out

    local = F.substring_index(v, "@", 1)
    domain = v.substr(F.length(local) + 2, F.length(v))
    words = F.filter(F.split(v, f"{S}+"), lambda w: w != "")
    initials = F.transform(words, lambda w: F.concat(F.left(w, F.lit(1)), F.lit(".")))
    rest = F.array_join(F.slice(initials, 2, F.greatest(F.size(initials), F.lit(1))), " ")
    year = F.regexp_extract(v, r"(?:19|20)\p{Nd}{2}", 0)
    return (
        F.when(t == "AADHAAR", F.when(n == 12, F.concat(F.lit("XXXX XXXX "), last4)).otherwise("XXXX XXXX XXXX"))
        .when(t == "PAN", F.when(F.length(c) == 10, F.concat(F.left(c, F.lit(5)), F.lit("****"), F.right(c, F.lit(1)))).otherwise(F.concat(F.left(c, F.lit(3)), F.lit("*****X"))))
        .when(has("PHONE"), F.when(n >= 10, F.concat(F.lit("XXXXXX"), last4)).otherwise("XXXXXXXXXX"))
        .when(
            has("EMAIL"),
            F.when(~F.contains(v, F.lit("@")), "*****@***.com")
            .when(F.length(local) > 2, F.concat(F.left(local, F.lit(2)), F.repeat(F.lit("*"), F.length(local) - 2), F.lit("@"), domain))
            .otherwise(F.concat(F.left(local, F.lit(1)), F.lit("*@"), domain)),
        )
        .when(has("BANK", "ACCOUNT"), F.when(n >= 4, F.concat(F.repeat(F.lit("*"), n - 4), last4)).otherwise("XXXXXXXXXXXX"))
        .when(has("CARD", "CREDIT"), F.when(n >= 16, F.concat(F.lit("XXXX-XXXX-XXXX-"), last4)).otherwise("XXXX-XXXX-XXXX-XXXX"))
        .when(t.isin("DOB", "DATE", "DATE_OF_BIRTH"), F.when(year != "", F.concat(F.lit("**/**/"), year)).otherwise("**/**/****"))
        .when(has("PASSPORT"), F.when(F.length(c) >= 8, F.concat(F.left(c, F.lit(1)), F.lit("XXXXX"), F.right(c, F.lit(2)))).otherwise(F.concat(F.left(c, F.lit(1)), F.lit("XXXXXX"))))
        .when(has("PERSON") | t.isin("NAME", "PER"), F.when(F.size(words) == 0, "[NAME]").otherwise(F.concat(F.element_at(initials, 1), rest)))
        .when(has("LOCATION", "ADDRESS") | (t == "LOC"), "[LOCATION REDACTED]")
        .when(has("ORGANISATION", "ORG"), "[ORG REDACTED]")
        .otherwise("[REDACTED]")
    )


def display_name(label: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in DISPLAY_NAMES.items() for x in kv])
    return F.coalesce(F.element_at(known, label), F.initcap(F.regexp_replace(label, "_", " ")))


def detected_text(hits: Column) -> Column:
    return F.when(F.size(hits) == 0, "None").otherwise(F.array_join(F.transform(hits, lambda h: F.concat(F.lit("["), h["label"], F.lit("] "), h["value"])), " | "))


def masked_text(hits: Column) -> Column:
    return F.when(F.size(hits) == 0, "None").otherwise(F.array_join(F.transform(hits, lambda h: mask(h["label"], h["value"])), " | "))


def values_by_name(hits: Column) -> Column:
    """Array of (display_name, values), names in order of their first hit, repeated values kept."""
    named = F.transform(hits, lambda h: F.struct(display_name(h["label"]).alias("name"), h["value"].alias("value")))
    return let(
        named,
        lambda a: F.transform(
            F.array_distinct(F.transform(a, lambda x: x["name"])),
            lambda n: F.struct(n.alias("display_name"), F.transform(F.filter(a, lambda x: x["name"] == n), lambda x: x["value"]).alias("values")),
        ),
    )


def detected_values_text(hits: Column) -> Column:
    return F.when(F.size(hits) == 0, "None").otherwise(
        F.array_join(F.transform(values_by_name(hits), lambda g: F.concat(g["display_name"], F.lit(": "), F.array_join(g["values"], ", "))), " | ")
    )


def not_detected_text(hits: Column) -> Column:
    found = F.transform(hits, lambda h: F.upper(h["label"]))
    left = let(found, lambda f: F.filter(F.array(*map(F.lit, DISPLAY_NAMES)), lambda x: ~F.array_contains(f, F.upper(x))))
    names = F.transform(left, display_name)
    return F.when(F.size(left) == 0, "All PII types detected").otherwise(F.array_join(names, ", "))

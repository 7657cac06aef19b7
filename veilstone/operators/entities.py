"""Merging of named entities: normalised groups, first-wins buckets, names from titles and models, missed words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilstone.constants import EXCLUDED_ORGS
from veilstone.functions.text import keep_first, let, strip, title_names, unfound

GROUPS = {"PER": ["PER", "PERSON", "NAME"], "ORG": ["ORG", "ORGANIZATION", "ORGANISATION"], "LOC": ["LOC", "LOCATION", "GPE", "FAC"]}
ENTITIES = "array<struct<label:string,value:string>>"


def group_of(label: Column) -> Column:
    x = F.upper(label)
    out = None
    for name, members in GROUPS.items():
        out = F.when(x.isin(members), name) if out is None else out.when(x.isin(members), name)
    return out.otherwise("OTHER")


def buckets(entities: Column) -> Column:
    """Entities with group and cleaned word; a word counts once, in the group of its first occurrence."""
    clean = F.transform(entities, lambda e: F.struct(group_of(e["label"]).alias("label"), strip(F.replace(strip(e["value"]), F.lit("##"), F.lit(""))).alias("value")))
    kept = F.filter(clean, lambda e: (e["value"] != "") & ~F.upper(e["value"]).isin(EXCLUDED_ORGS))
    return let(kept, lambda a: keep_first(a, lambda e: F.lower(e["value"])))


def bucket(entities: Column, group: str) -> Column:
    return F.transform(F.filter(entities, lambda e: e["label"] == group), lambda e: e["value"])


def titled_names(text: Column) -> Column:
    """Names after titles that count as names."""
    return F.filter(F.transform(title_names(text), strip), lambda n: (n != "") & (n != "None") & ~F.upper(n).isin(EXCLUDED_ORGS))


def all_names(titled: Column, entities: Column) -> Column:
    """Names after titles, then persons of the model; first spelling of each."""
    return let(F.concat(titled, bucket(entities, "PER")), lambda a: keep_first(a, F.lower))


def comparison(titled: Column, words: Column, entities: Column) -> Column:
    """Struct of one model's report: n_names, n_orgs, n_locs, predicted_type, extracted_text, missed_entities.

    titled, words: titled_names() and capital_words() of the text, which all models share.
    """

    def build(p: Column) -> Column:
        names, orgs, locs = p["n"], p["o"], p["l"]
        parts = [("PER", names), ("ORG", orgs), ("LOC", locs)]
        types = F.array_compact(F.array(*[F.when(F.size(a) > 0, g) for g, a in parts]))
        texts = F.array_compact(F.array(*[F.when(F.size(a) > 0, F.concat(F.lit(g + ": "), F.array_join(a, " | "))) for g, a in parts]))
        found = F.transform(F.concat(names, orgs, locs), F.lower)
        missed = let(found, lambda f: unfound(words, f))

        def or_none(a: Column, sep: str) -> Column:
            return F.when(F.size(a) == 0, "None").otherwise(F.array_join(a, sep))

        return F.struct(
            F.size(names).alias("n_names"), F.size(orgs).alias("n_orgs"), F.size(locs).alias("n_locs"),
            or_none(types, ", ").alias("predicted_type"), or_none(texts, " || ").alias("extracted_text"), or_none(missed, " | ").alias("missed_entities"),
        )

    return let(
        buckets(entities), lambda b: let(F.struct(all_names(titled, b).alias("n"), bucket(b, "ORG").alias("o"), bucket(b, "LOC").alias("l")), build)
    )

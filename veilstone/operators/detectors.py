"""Pluggable detectors and entity models: Series of texts -> Series of lists of hits, run in Arrow batches.

A detector that isn't registered yields no hits, an entity model that isn't registered is reported as not loaded;
results are never made up. A text on which a detector fails has no hits; an entity model skips the chunk it fails on.

A hit is a pair (label, value) or what the models themselves give, a dictionary: entity_group or entity with word;
label with text and score; entity_type with start and end. No detector or model sees a null text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from veilstone.functions.pii import PRIORITY
from veilstone.functions.text import has_devanagari
from veilstone.operators.backends import each_or_none

Detect = Callable[..., pd.Series]
ENTITIES = "array<struct<label:string,value:string>>"
CHUNK, OVERLAP = 1800, 200  # characters of a chunk that an entity model reads, and those shared with the next
TOGETHER = 64  # chunks in one call of an entity model

# The labels asked of GLiNER.
GLINER_LABELS = [
    "person", "organisation", "location", "date", "phone number", "email address", "bank account",
    "aadhaar", "pan card", "passport", "vehicle number", "credit card", "address",
]


@dataclass(frozen=True)
class Settings:
    """How a detector is called: characters it reads, arguments and least score, and how labels and values are written."""

    prefix: int | None = None
    arguments: dict[str, Any] = field(default_factory=dict)
    least_score: float = 0.0
    upper_labels: bool = False
    subwords: bool = False
    skips_blank: bool = True
    skips_devanagari: bool = False


SETTINGS = {
    "Presidio": Settings(skips_blank=False, skips_devanagari=True),
    "Piiranha": Settings(prefix=512, subwords=True),
    "GLiNER": Settings(prefix=1000, arguments={"labels": GLINER_LABELS, "threshold": 0.5}, least_score=0.5, upper_labels=True),
}
_registry: dict[str, Detect] = {}


def register(name: str, detect: Detect) -> None:
    """GLiNER's detect is called with labels and threshold as well, all others with the texts alone."""
    _registry[name] = detect


def unregister(name: str) -> None:
    _registry.pop(name, None)


def registered(name: str) -> Detect | None:
    return _registry.get(name)


def pair(hit: Any, text: str, least_score: float = 0.0) -> tuple[str, str] | None:
    """(label, value) of a hit in any of its forms; None if its score is too low."""
    if not isinstance(hit, dict):
        return hit[0], hit[1]
    if hit.get("score") is not None and hit["score"] < least_score:
        return None
    label = next((hit[k] for k in ("entity_group", "entity", "entity_type", "label") if hit.get(k)), "UNKNOWN")
    value = next((hit[k] for k in ("word", "text") if hit.get(k) is not None), None)
    return label, text[hit["start"] : hit["end"]] if value is None else value


def adapted(hits: Iterable[Any] | None, text: str, settings: Settings) -> list[dict[str, str]]:
    """A detector's hits without outer white space; blank ones and repeats of a label's value in any case dropped."""
    out, seen = [], set()
    for hit in () if hits is None else hits:
        found = pair(hit, text, settings.least_score)
        if found is None:
            continue
        label, value = found[0] or "UNKNOWN", found[1] or ""
        value = (value.replace("##", "") if settings.subwords else value).strip()
        if settings.upper_labels:
            label = label.upper().replace(" ", "_")
        key = label, value.lower()
        if value and key not in seen:
            seen.add(key)
            out.append({"label": label, "value": value})
    return out


def entities(name: str, text: Column, detect: Detect | None = None) -> Column:
    """array<struct<label,value>> of a registered (or the given) detector, or an empty array."""
    detect, settings = detect or _registry.get(name), SETTINGS.get(name, Settings())
    if detect is None:
        return F.array().cast(ENTITIES)

    @F.pandas_udf(ENTITIES)
    def run(texts: pd.Series) -> pd.Series:
        parts = texts.fillna("").str.slice(0, settings.prefix).tolist()
        asked = [i for i, (t, null) in enumerate(zip(parts, texts.isna())) if not null and (t.strip() or not settings.skips_blank)]
        found = each_or_none(lambda xs: detect(pd.Series(xs, dtype=object), **settings.arguments), [parts[i] for i in asked])
        out: list[list] = [[] for _ in parts]
        for i, hits in zip(asked, found):
            out[i] = adapted(hits, parts[i], settings)
        return pd.Series(out, dtype=object)

    return run(text)


def chunks_of(text: str) -> list[str]:
    return [text[i : i + CHUNK] for i in range(0, max(1, len(text) - OVERLAP), CHUNK - OVERLAP)]


def model_entities(name: str, text: Column, detect: Detect | None = None) -> Column:
    """Entities of a registered (or the given) model over the text's chunks, in order; repeats of overlaps are kept (see entities.buckets)."""
    detect = detect or _registry.get(name)
    if detect is None:
        return F.array().cast(ENTITIES)

    @F.pandas_udf(ENTITIES)
    def run(texts: pd.Series) -> pd.Series:
        out: list[list] = [[] for _ in range(len(texts))]
        cut = [(i, c) for i, t in enumerate(texts) if isinstance(t, str) for c in chunks_of(t)]
        for at in range(0, len(cut), TOGETHER):
            part = cut[at : at + TOGETHER]
            found = each_or_none(lambda xs: detect(pd.Series(xs, dtype=object)), [c for _, c in part])
            for (i, c), hits in zip(part, found):
                out[i] += [{"label": a or "", "value": b or ""} for a, b in (pair(h, c) for h in (() if hits is None else hits))]
        return pd.Series(out, dtype=object)

    return run(text)


def detector_hits(name: str, text: Column, detect: Detect | None = None) -> Column:
    """Hits of one detector as (source, label, value)."""
    if name not in PRIORITY:
        raise ValueError(f"unknown detector {name}")
    found = entities(name, text, detect)
    if SETTINGS[name].skips_devanagari:
        found = F.when(has_devanagari(text), F.array().cast(ENTITIES)).otherwise(found)
    return F.transform(found, lambda e: F.struct(F.lit(name).alias("source"), e["label"].alias("label"), e["value"].alias("value")))

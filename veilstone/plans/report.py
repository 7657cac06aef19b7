"""The three report relations as DataFrames.

Hits and entities come from the registered detectors and models, or from columns of the records that hold them
already (precomputed results of a detector that runs elsewhere).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilstone.constants import NER_MODELS
from veilstone.functions import pii
from veilstone.functions.text import capital_words, title_names
from veilstone.operators import detectors
from veilstone.operators.entities import comparison, titled_names

CONSTANTS = {"detected_pii_with_tags": "OCR Failed", "anonymized_pii_output": "OCR Failed", "pii_types_detected": "N/A", "pii_types_not_detected": "N/A"}
MODEL_COLUMNS = ["predicted_type", "extracted_text", "missed_entities"]


def scan(records: DataFrame, text_col: str = "corrected_text", found: Column | None = None) -> DataFrame:
    """records with hits; failed records have none, and no detector sees them. found: hits of other detectors, by priority."""
    text = F.col(text_col)
    others = [detectors.detector_hits(n, F.when(~F.col("is_failed"), text)) for n in pii.PRIORITY[1:] if detectors.registered(n)]
    if found is not None:
        others.append(F.coalesce(found, F.array().cast(pii.HIT)))
    none = F.array().cast(pii.HIT)
    return records.withColumn("hits", F.when(F.col("is_failed"), none).otherwise(pii.merge_hits(pii.regex_hits(text), *[F.coalesce(x, none) for x in others])))


def sheet3(records: DataFrame, keys: list[str], found: Column | None = None) -> DataFrame:
    """Per record: texts, tagged and masked values, types found and not found."""
    h, failed = F.col("hits"), F.col("is_failed")
    made = {
        "detected_pii_with_tags": pii.detected_text(h),
        "anonymized_pii_output": pii.masked_text(h),
        "pii_types_detected": pii.detected_values_text(h),
        "pii_types_not_detected": pii.not_detected_text(h),
    }
    texts = [F.col("raw_text").alias("full_extracted_text"), F.col("corrected_text").alias("spell_corrected_text")]
    return scan(records, found=found).select(*keys, "source_file", "file_type", "language", *texts, *[F.when(failed, CONSTANTS[c]).otherwise(x).alias(c) for c, x in made.items()])


def _none_row(kind: str) -> Column:
    zero = F.lit(0)
    return F.struct(zero.alias("n_names"), zero.alias("n_orgs"), zero.alias("n_locs"), F.lit(kind).alias("predicted_type"), F.lit("N/A").alias("extracted_text"), F.lit("N/A").alias("missed_entities"))


def with_models(records: DataFrame, entities: dict[str, Column] | None = None) -> DataFrame:
    """records with one struct column for each model (see entities.comparison), all in one pass over the texts.

    A model that neither is registered nor has its entities given isn't loaded, which shows also on failed records.
    """
    entities, failed = entities or {}, F.col("is_failed")
    loaded = [m for m in NER_MODELS if m in entities or detectors.registered(m)]
    if loaded:
        text = F.when(~failed, F.col("corrected_text"))
        records = records.withColumn("_titled", titled_names(text)).withColumn("_words", capital_words(text))
    for short in NER_MODELS:
        if short in entities:
            found = F.coalesce(entities[short], F.array().cast(detectors.ENTITIES))
        elif detectors.registered(short):
            found = detectors.model_entities(short, F.when(~failed, F.col("corrected_text")))
        else:
            records = records.withColumn(f"_{short}", _none_row("Load Failed"))
            continue
        records = records.withColumn(f"_{short}", F.when(failed, _none_row("OCR Failed")).otherwise(comparison(F.col("_titled"), F.col("_words"), found)))
    return records.drop("_titled", "_words")


def sheet2(records: DataFrame, keys: list[str], entities: dict[str, Column] | None = None) -> DataFrame:
    """Per record: names after titles, then three columns per model."""
    titled = F.coalesce(title_names(F.col("corrected_text")), F.array().cast("array<string>"))
    names = F.when(F.size(titled) == 0, "None").otherwise(F.array_join(titled, " | ")).alias("regex_detected_names")
    models = [F.col(f"_{m}.{c}").alias(f"{m.lower()}_{c}") for m in NER_MODELS for c in MODEL_COLUMNS]
    texts = [F.col("raw_text").alias("full_extracted_text"), F.col("corrected_text").alias("spell_corrected_text")]
    return with_models(records, entities).select(*keys, "source_file", "file_type", "language", *texts, names, *models)


def sheet1(records: DataFrame, entities: dict[str, Column] | None = None, found: Column | None = None) -> DataFrame:
    """Per model: records, records with names, organisations and places, names in all, records with hits, rate.

    One aggregate over the records: counts are summed in each task, so one row a task is shuffled.
    """
    judged = with_models(scan(records, found=found), entities)
    counts = [F.count("*").alias("n"), F.count_if(~F.col("is_failed") & (F.size("hits") > 0)).alias("with_pii")]
    for m in NER_MODELS:
        counts += [F.count_if(F.col(f"_{m}.n_{k}") > 0).alias(f"{m}_{k}") for k in ("names", "orgs", "locs")]
        counts.append(F.coalesce(F.sum(f"_{m}.n_names"), F.lit(0)).alias(f"{m}_all"))
    lines = [
        F.struct(F.lit(f"{m} ({model})").alias("model_name"), *[F.col(f"{m}_{k}").alias(as_) for k, as_ in (("names", "files_with_names"), ("all", "total_names_found"), ("orgs", "files_with_org"), ("locs", "files_with_loc"))])
        for m, model in NER_MODELS.items()
    ]
    rate = F.bround(100.0 * F.col("x.files_with_names") / F.greatest(F.col("n"), F.lit(1)), 2)
    return judged.agg(*counts).select("n", "with_pii", F.explode(F.array(*lines)).alias("x")).select(
        "x.model_name", F.col("n").alias("total_files_processed"), "x.files_with_names", "x.total_names_found", "x.files_with_org", "x.files_with_loc", F.col("with_pii").alias("files_with_pii"), rate.alias("name_detection_rate")
    )

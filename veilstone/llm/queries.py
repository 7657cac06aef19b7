"""All queries of the subpackage, and their SQL where there is one."""

from veilstone.llm import language, markup, packing, personal_data, repetition, scan_noise, sentences, splitting, tokenization, truncation

MODULES = [markup, splitting, sentences, scan_noise, truncation, personal_data, language, tokenization, packing, repetition]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in MODULES for k, s in m.ORACLES.items()}

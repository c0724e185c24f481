"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline

from . import collocations, fim, html_text, licenses, mixing, near_dedup, ngram_join, packing, pii, quality_classifier, quality_rules, warc, winnowing

QUERIES = {
    "op1_mix": mixing.query,
    "op2_ngram_join": ngram_join.query,
    "op3_main_text": html_text.query,
    "op4_pii": pii.query,
    "op5_pack": packing.query,
    "op6_licenses": licenses.query,
    "op7_quality_rules": quality_rules.query,
    "op8_quality_classifier": quality_classifier.query,
    "op9_warc": warc.query,
    "op10_near_dedup": near_dedup.query,
    "op11_fim": fim.query,
    "op12_collocations": collocations.query,
    "op13_winnowing": winnowing.query,
    "pipeline": corpus_pipeline.run,
}
SQL = {"op1_mix": mixing.ORACLE, "op2_ngram_join": ngram_join.ORACLE, "op9_warc": warc.ORACLE, "op10_near_dedup": near_dedup.ORACLE, "op11_fim": fim.ORACLE, "op12_collocations": collocations.ORACLE, "op13_winnowing": winnowing.ORACLE}

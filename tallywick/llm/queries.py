"""Queries of the text operators and their SQL twins, for the driver."""

from __future__ import annotations

from tallywick.llm import collocations, decontamination, fingerprints, html_text, licenses, linededup, nearwords, packing, quality, secrets, spelling, toxicity, warc

QUERIES = {
    "op8_line_dedup": linededup.op8_line_dedup,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_document_fingerprints": fingerprints.op4_document_fingerprints,
    "op1_benchmark_decontamination": decontamination.op1_benchmark_decontamination,
    "op5_html_extraction": html_text.op5_html_extraction,
    "op10_warc_derivatives": warc.op10_warc_derivatives,
    "op2_license_scan": licenses.op2_license_scan,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op9_minhash_near_dedup": nearwords.op9_minhash_near_dedup,
    "op7_secret_scan": secrets.op7_secret_scan,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}
ORACLES: dict[str, str] = {"op13_phrase_collocations": collocations.ORACLE}

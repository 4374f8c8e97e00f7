"""The registered queries of the corpus operators, each over its whole table, and their SQL where SQL can tell."""

from __future__ import annotations

from posttrend.llm import (
    audit, decontaminate, extract, infill, licenses, lines, minhash, mixing, quality, suffixes, tokens, toxicity,
    urls,
)
from posttrend.llm.common import table


def op1_line_dedup(spark, sf_dir):
    return lines.line_report(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"), ("source", "lang", "text"))


def op3_quality_rules(spark, sf_dir):
    return quality.measure_quality(table(spark, sf_dir, "documents"))


def op10_url_filter(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op4_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op5_suffix_dedup(spark, sf_dir):
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op6_decontaminate(spark, sf_dir):
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op7_mix_sources(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op8_extract_html(spark, sf_dir):
    return extract.extract_text(table(spark, sf_dir, "pages"))


def op9_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op11_filter_audit(spark, sf_dir):
    cells = audit.filter_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.audit_orders(cells)


def op12_toxicity(spark, sf_dir):
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark, sf_dir):
    return infill.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_token_counts, op3_quality_rules, op4_license_scan, op5_suffix_dedup, op6_decontaminate,
        op7_mix_sources, op8_extract_html, op9_minhash_dedup, op10_url_filter, op11_filter_audit,
        op12_toxicity, op13_fill_in_middle,
    )
}
ORACLES = {
    "op3_quality_rules": quality.oracle(), "op6_decontaminate": decontaminate.oracle(), "op7_mix_sources": mixing.oracle(),
    "op10_url_filter": urls.oracle(), "op11_filter_audit": audit.oracle(),
    "op13_fill_in_middle": infill.oracle(),
}

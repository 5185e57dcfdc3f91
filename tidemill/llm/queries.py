"""The registered queries of this subpackage, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from . import decontaminate, exact_dedup, language_id, ngram_join, packing, quality_crf, secret_scan, sharding, url_filters, warc

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_language_id": language_id.op4_language_id,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_quality_crf": quality_crf.op6_quality_crf,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_packing": packing.op8_packing,
    "op9_warc": warc.op9_warc,
    "op10_sharding": sharding.op10_sharding,
}
ORACLE_SQL = {"op7_exact_dedup": exact_dedup.ORACLE, "op9_warc": warc.ORACLE}

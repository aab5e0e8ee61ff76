"""The operators of this subpackage as registered queries, with SQL where it can express them."""

from __future__ import annotations

from gridloom.llm.collocations import COLLOCATIONS_SQL, collocations_query
from gridloom.llm.decontaminate import passages_query
from gridloom.llm.embedding_join import embedding_query
from gridloom.llm.language_id import language_query
from gridloom.llm.licenses import LICENSE_SQL, license_query
from gridloom.llm.mixing import MIX_SQL, mix_query
from gridloom.llm.ngram_join import ngram_query
from gridloom.llm.periodic_runs import runs_query
from gridloom.llm.personal_data import personal_data_query
from gridloom.llm.quality import quality_query
from gridloom.llm.quality_rules import QUALITY_RULES_SQL, quality_rules_query
from gridloom.llm.toxicity import toxicity_query
from gridloom.llm.warc import WARC_SQL, warc_query

QUERIES = {
    "op1_license_scan": license_query,
    "op2_source_mix": mix_query,
    "op3_warc_salvage": warc_query,
    "op4_benchmark_passages": passages_query,
    "op5_ngram_join": ngram_query,
    "op6_toxicity": toxicity_query,
    "op7_embedding_join": embedding_query,
    "op8_language_id": language_query,
    "op9_personal_data": personal_data_query,
    "op10_quality": quality_query,
    "op11_quality_rules": quality_rules_query,
    "op12_periodic_runs": runs_query,
    "op13_collocations": collocations_query,
}

CHECKS = {
    "op1_license_scan": LICENSE_SQL,
    "op2_source_mix": MIX_SQL,
    "op3_warc_salvage": WARC_SQL,
    "op11_quality_rules": QUALITY_RULES_SQL,
    "op13_collocations": COLLOCATIONS_SQL,
}

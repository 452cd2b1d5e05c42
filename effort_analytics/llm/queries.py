"""The subpackage's registered queries: name -> function(spark, sf_dir)."""

from __future__ import annotations

from . import filter_audit, lexical_search, voronoi_topk
from .filter_audit import op13_filter_audit
from .fingerprints import op2_document_fingerprints
from .html_extraction import op12_html_extraction
from .lexical_search import op11_lexical_search
from .license_scan import op1_license_scan
from .minhash_dedup import op4_minhash_near_dedup
from .mixing import op8_mixing
from .pseudonyms import op3_pseudonyms
from .sentencepiece_codec import op5_sentencepiece
from .substring_dedup import op7_substring_dedup
from .suffix_dedup import op6_suffix_array_dedup
from .toxicity import op10_toxicity
from .voronoi_topk import op9_voronoi_topk

QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_document_fingerprints, op3_pseudonyms, op4_minhash_near_dedup, op5_sentencepiece,
    op6_suffix_array_dedup, op7_substring_dedup, op8_mixing, op9_voronoi_topk, op10_toxicity,
    op11_lexical_search, op12_html_extraction, op13_filter_audit)}
#: DuckDB SQL of those that SQL can express.
ORACLES: dict[str, str] = {"op9_voronoi_topk": voronoi_topk.ORACLE, "op11_lexical_search": lexical_search.ORACLE,
                           "op13_filter_audit": filter_audit.ORACLE}

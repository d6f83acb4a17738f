"""The registered queries of this subpackage, and the SQL that must agree where SQL can say it."""

from __future__ import annotations

from voltatlas.llm.hilbert import op2_hilbert_neighbours
from voltatlas.llm.importance import OP12_SQL, op12_median_resample
from voltatlas.llm.jaccard import op9_multi_order_jaccard
from voltatlas.llm.language import op11_centroid_language
from voltatlas.llm.lines import op4_simhash_lines
from voltatlas.llm.mixing import OP5_SQL, op5_hash_threshold_mix
from voltatlas.llm.packing import op8_variable_best_fit
from voltatlas.llm.quality import op1_ngram_quality
from voltatlas.llm.repetition import op7_suffix_repetition
from voltatlas.llm.sharding import op6_virtual_slots
from voltatlas.llm.spelling import OP13_SQL, op13_partenum_spelling
from voltatlas.llm.substrings import op10_prefix_free_dedup
from voltatlas.llm.toxicity import op3_counterfactual_toxicity

_ALL = (
    op1_ngram_quality, op2_hilbert_neighbours, op3_counterfactual_toxicity, op4_simhash_lines, op5_hash_threshold_mix, op6_virtual_slots, op7_suffix_repetition,
    op8_variable_best_fit, op9_multi_order_jaccard, op10_prefix_free_dedup, op11_centroid_language, op12_median_resample, op13_partenum_spelling,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {"op5_hash_threshold_mix": OP5_SQL, "op12_median_resample": OP12_SQL, "op13_partenum_spelling": OP13_SQL}

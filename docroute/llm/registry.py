"""The queries of this folder by name."""

from docroute.llm.chat_format import ORACLE as _op11
from docroute.llm.chat_format import op11_chat_formatting
from docroute.llm.jaccard_join import ORACLE as _op4
from docroute.llm.jaccard_join import op4_ngram_jaccard_join
from docroute.llm.language_id import op6_language_id
from docroute.llm.media import op1_media_columns
from docroute.llm.mixing import op3_source_mixing
from docroute.llm.packing import op8_best_fit_packing
from docroute.llm.phrases import ORACLE as _op12
from docroute.llm.phrases import op12_phrase_collocations
from docroute.llm.quality_classifier import op5_quality_classifier
from docroute.llm.quality_rules import ORACLE as _op10
from docroute.llm.quality_rules import op10_quality_rules
from docroute.llm.spelling import op13_spelling_variants
from docroute.llm.substring_dedup import op7_substring_dedup
from docroute.llm.suffix_dedup import op9_suffix_array_dedup
from docroute.llm.toxicity import op2_toxicity

_ALL = (
    op1_media_columns, op2_toxicity, op3_source_mixing, op4_ngram_jaccard_join, op5_quality_classifier,
    op6_language_id, op7_substring_dedup, op8_best_fit_packing, op9_suffix_array_dedup, op10_quality_rules,
    op11_chat_formatting, op12_phrase_collocations, op13_spelling_variants,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {"op4_ngram_jaccard_join": _op4, "op10_quality_rules": _op10, "op11_chat_formatting": _op11, "op12_phrase_collocations": _op12}

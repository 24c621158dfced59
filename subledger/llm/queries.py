"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from subledger.llm.bpe import op6_bpe
from subledger.llm.collocations import ORACLE as COLLOCATIONS_SQL
from subledger.llm.collocations import op13_collocations
from subledger.llm.decontaminate import op10_decontaminate
from subledger.llm.langid import op7_language_id
from subledger.llm.licenses import op1_license_scan
from subledger.llm.lm import op3_lm_score
from subledger.llm.maxscore import ORACLE as MAXSCORE_SQL
from subledger.llm.maxscore import op11_maxscore
from subledger.llm.merkle import ORACLE as MERKLE_SQL
from subledger.llm.merkle import op12_merkle
from subledger.llm.nbsvm import op4_quality_classifier
from subledger.llm.preferences import ORACLE as PREFERENCES_SQL
from subledger.llm.preferences import op9_chat_preferences
from subledger.llm.quality_rules import ORACLE as QUALITY_RULES_SQL
from subledger.llm.quality_rules import op2_quality_rules
from subledger.llm.sharding import op5_sharding
from subledger.llm.simhash import op8_simhash

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_lm_score": op3_lm_score,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_sharding": op5_sharding,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_simhash": op8_simhash,
    "op9_chat_preferences": op9_chat_preferences,
    "op10_decontaminate": op10_decontaminate,
    "op11_maxscore": op11_maxscore,
    "op12_merkle": op12_merkle,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": QUALITY_RULES_SQL,
    "op9_chat_preferences": PREFERENCES_SQL,
    "op11_maxscore": MAXSCORE_SQL,
    "op12_merkle": MERKLE_SQL,
    "op13_collocations": COLLOCATIONS_SQL,
}

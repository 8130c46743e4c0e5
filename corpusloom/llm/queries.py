"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from .html import op6_html
from .knn import OP4_SQL, op4_knn
from .lattice import op2_sentencepiece
from .minhash import op8_minhash
from .packing import op3_packing
from .resharding import op7_resharding
from .rollups import op10_rollups
from .simhash import op9_simhash
from .suffix import op5_suffix
from .toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_packing": op3_packing,
    "op4_knn": op4_knn,
    "op5_suffix": op5_suffix,
    "op6_html": op6_html,
    "op7_resharding": op7_resharding,
    "op8_minhash": op8_minhash,
    "op9_simhash": op9_simhash,
    "op10_rollups": op10_rollups,
}
SQL: dict[str, str] = {"op4_knn": OP4_SQL}

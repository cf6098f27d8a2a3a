"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from .ann import op7_permutation
from .bpe import op9_bpe
from .bytetokens import op11_bytes
from .centroids import OP13_SQL, op13_centroids
from .editcount import op8_edits
from .katz import op3_katz
from .langid import op5_langid
from .linededup import op10_lines
from .mixing import op2_mixing
from .quality import OP6_SQL, op6_quality
from .repeats import op1_repeats
from .simhash import op4_simhash
from .variants import op12_variants

QUERIES = {
    "op1_repeats": op1_repeats,
    "op2_mixing": op2_mixing,
    "op3_katz": op3_katz,
    "op4_simhash": op4_simhash,
    "op5_langid": op5_langid,
    "op6_quality": op6_quality,
    "op7_permutation": op7_permutation,
    "op8_edits": op8_edits,
    "op9_bpe": op9_bpe,
    "op10_lines": op10_lines,
    "op11_bytes": op11_bytes,
    "op12_variants": op12_variants,
    "op13_centroids": op13_centroids,
}

ORACLES: dict[str, str] = {
    "op6_quality": OP6_SQL,
    "op13_centroids": OP13_SQL,
}

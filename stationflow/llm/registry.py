"""Names of the queries of this subpackage, and their SQL."""

from __future__ import annotations

from .bpe import op9_bpe
from .chat import OP8_SQL, op8_chat
from .decontamination import OP1_SQL, op1_decontamination
from .licences import op6_licences
from .manifest import OP12_SQL, op12_manifest
from .near_dedup import op4_near_dedup
from .neighbours import op11_neighbours
from .pii import OP2_SQL, op2_pii
from .prefix_trie import OP13_SQL, op13_prefix_trie
from .quality import op10_quality_rules
from .repeats import op7_repeats
from .token_counts import op3_token_counts
from .url_rules import OP5_SQL, op5_url_rules

_QUERIES = (
    op1_decontamination,
    op2_pii,
    op3_token_counts,
    op4_near_dedup,
    op5_url_rules,
    op6_licences,
    op7_repeats,
    op8_chat,
    op9_bpe,
    op10_quality_rules,
    op11_neighbours,
    op12_manifest,
    op13_prefix_trie,
)
_SQL = {
    "op1_decontamination": OP1_SQL,
    "op2_pii": OP2_SQL,
    "op5_url_rules": OP5_SQL,
    "op8_chat": OP8_SQL,
    "op12_manifest": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}


def queries():
    return {query.__name__: query for query in _QUERIES}


def oracle_sql():
    return dict(_SQL)

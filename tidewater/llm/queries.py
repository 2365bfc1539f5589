"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from tidewater.llm.chat import OP5_SQL, op5_chat
from tidewater.llm.fingerprints import op9_fingerprints
from tidewater.llm.langid import op3_langid
from tidewater.llm.manifest import OP12_SQL, op12_manifest
from tidewater.llm.mixing import OP1_SQL, op1_mix
from tidewater.llm.neardup import op7_neardup
from tidewater.llm.neighbours import op10_neighbours
from tidewater.llm.packing import op6_packing
from tidewater.llm.pii import op2_pii
from tidewater.llm.secrets import OP4_SQL, op4_secrets
from tidewater.llm.sharding import op11_sharding
from tidewater.llm.spelling import OP13_SQL, op13_spelling
from tidewater.llm.webpages import op8_webpages

QUERIES = {
    "op1_mix": op1_mix,
    "op2_pii": op2_pii,
    "op3_langid": op3_langid,
    "op4_secrets": op4_secrets,
    "op5_chat": op5_chat,
    "op6_packing": op6_packing,
    "op7_neardup": op7_neardup,
    "op8_webpages": op8_webpages,
    "op9_fingerprints": op9_fingerprints,
    "op10_neighbours": op10_neighbours,
    "op11_sharding": op11_sharding,
    "op12_manifest": op12_manifest,
    "op13_spelling": op13_spelling,
}

ORACLES = {
    "op1_mix": OP1_SQL,
    "op4_secrets": OP4_SQL,
    "op5_chat": OP5_SQL,
    "op12_manifest": OP12_SQL,
    "op13_spelling": OP13_SQL,
}

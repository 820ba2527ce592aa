"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from rostrum.llm import p2_splitting, p3_turns, p4_canonical, p5_neardup, p7_packing, p8_mixing, p9_stuffing

_MODULES = [p2_splitting, p3_turns, p4_canonical, p5_neardup, p7_packing, p8_mixing, p9_stuffing]
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in _MODULES for k, v in m.ORACLE.items()}

"""Registered queries of the numbered operators and their DuckDB counterparts."""

from __future__ import annotations

from corpusmill.llm.dedup_cuckoo import OP12_SQL, op12_cuckoo
from corpusmill.llm.jaccard_tree import op4_tree
from corpusmill.llm.lines_simhash import op2_simhash
from corpusmill.llm.mix_lengths import op9_lengths
from corpusmill.llm.pack_harmonic import op3_harmonic
from corpusmill.llm.passages_chain import op10_chains
from corpusmill.llm.ppm import op1_ppm
from corpusmill.llm.rp_forest import op6_forest
from corpusmill.llm.rules_divergence import op5_divergence
from corpusmill.llm.runs_suffix import op13_runs
from corpusmill.llm.search_blas import OP11_SQL, op11_blas
from corpusmill.llm.shard_slots import op8_slots
from corpusmill.llm.warc_segments import op7_segments

QUERIES = {
    "op1_ppm": op1_ppm,
    "op2_simhash": op2_simhash,
    "op3_harmonic": op3_harmonic,
    "op4_tree": op4_tree,
    "op5_divergence": op5_divergence,
    "op6_forest": op6_forest,
    "op7_segments": op7_segments,
    "op8_slots": op8_slots,
    "op9_lengths": op9_lengths,
    "op10_chains": op10_chains,
    "op11_blas": op11_blas,
    "op12_cuckoo": op12_cuckoo,
    "op13_runs": op13_runs,
}

ORACLES: dict[str, str] = {"op11_blas": OP11_SQL, "op12_cuckoo": OP12_SQL}

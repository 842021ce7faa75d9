"""Registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logstrata.llm.bpe import op3_bpe
from logstrata.llm.embeddings import OP1_SQL, op1_int8_tiles
from logstrata.llm.forest import op8_projection_forest
from logstrata.llm.jaccard import OP4_SQL, op4_segment_jaccard
from logstrata.llm.langid import op7_ppm_language
from logstrata.llm.linededup import OP6_SQL, op6_line_spread
from logstrata.llm.lm import op11_elias_fano_lm
from logstrata.llm.middle import OP13_SQL, op13_chunk_middle
from logstrata.llm.packing import op9_bin_completion
from logstrata.llm.phrases import OP12_SQL, op12_dynamic_counting
from logstrata.llm.sharding import op10_external_shuffle
from logstrata.llm.substring import OP2_SQL, op2_window_repeats
from logstrata.llm.tokenfile import op5_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_int8_tiles": op1_int8_tiles,
    "op2_window_repeats": op2_window_repeats,
    "op3_bpe": op3_bpe,
    "op4_segment_jaccard": op4_segment_jaccard,
    "op5_token_files": op5_token_files,
    "op6_line_spread": op6_line_spread,
    "op7_ppm_language": op7_ppm_language,
    "op8_projection_forest": op8_projection_forest,
    "op9_bin_completion": op9_bin_completion,
    "op10_external_shuffle": op10_external_shuffle,
    "op11_elias_fano_lm": op11_elias_fano_lm,
    "op12_dynamic_counting": op12_dynamic_counting,
    "op13_chunk_middle": op13_chunk_middle,
}

#: DuckDB SQL with the same columns and rows, where SQL can express the operator.
ORACLE_SQL: dict[str, str] = {
    "op1_int8_tiles": OP1_SQL,
    "op2_window_repeats": OP2_SQL,
    "op4_segment_jaccard": OP4_SQL,
    "op6_line_spread": OP6_SQL,
    "op12_dynamic_counting": OP12_SQL,
    "op13_chunk_middle": OP13_SQL,
}

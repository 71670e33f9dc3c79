"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chosen_paths import op12_chosen_path_copies
from .conversations import ORACLE_SQL as REPAIR_SQL
from .conversations import op11_auction_repair
from .decontamination import op7_latent_semantic_leaks
from .html_wrapper import op9_union_free_wrappers
from .jaccard import op10_partenum_jaccard
from .line_rules import op3_line_frequency
from .packing import op5_nnls_packing
from .private_data import op6_boosted_private_data
from .quality import op4_quadratic_discriminant
from .secrets import op2_structural_secrets
from .sharding import op1_histogram_sort
from .token_links import op13_token_links
from .token_files import op8_seekable_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_histogram_sort": op1_histogram_sort,
    "op2_structural_secrets": op2_structural_secrets,
    "op3_line_frequency": op3_line_frequency,
    "op4_quadratic_discriminant": op4_quadratic_discriminant,
    "op5_nnls_packing": op5_nnls_packing,
    "op6_boosted_private_data": op6_boosted_private_data,
    "op7_latent_semantic_leaks": op7_latent_semantic_leaks,
    "op8_seekable_token_files": op8_seekable_token_files,
    "op9_union_free_wrappers": op9_union_free_wrappers,
    "op10_partenum_jaccard": op10_partenum_jaccard,
    "op11_auction_repair": op11_auction_repair,
    "op12_chosen_path_copies": op12_chosen_path_copies,
    "op13_token_links": op13_token_links,
}

#: DuckDB SQL for queries that SQL can express.
ORACLES: dict[str, str] = {"op11_auction_repair": REPAIR_SQL}

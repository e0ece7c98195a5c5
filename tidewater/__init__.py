"""tidewater -- lakehouse data work as plain Spark DataFrame jobs.

Subpackages
-----------
sources    file/JDBC readers and table sinks (ingest, overwrite, WAP, compaction)
functions  column-level building blocks (key normalisation, tokens, casts,
           SQL table references, sensitive-value detectors)
operators  DataFrame -> DataFrame jobs (matching, gold dimensions/facts,
           usage report, sensitive scan)
plans      the driver query catalogue and its SQL oracles
"""

__version__ = "0.1.0"

from .functions.columns import (bool_normalize, canonicalize_columns, decimal_cast, rename_map,
                                rules_frame, stamp_ingest_date)
from .functions.text import det_key, normalize_key, text_features, tokenize
from .operators.dims import (build_gold, calendar_for, daily_wide, dim_date, fact_performance,
                             latest_snapshot, nav_change, scd2_dimension, scd2_refresh)
from .operators.match import (distance_summary, exact_match_pairs, fee_diff, jaccard_join,
                              load_counts, lsh_similarity_join, match_preview, resolve_masters,
                              unmatched)
from .operators.scan import findings, hash_sample, in_scope, scan_cells
from .operators.usage import flatten_query_log, newest_queries, table_refs_daily
from .sources.files import (read_audit_log, read_csv, read_flow_logs, read_nav_csv,
                            read_query_log, read_versioned_csv, with_line_numbers)
from .sources.jdbc import jdbc_options, watermark_filter, watermark_subquery
from .sources.sinks import (compact_partitions, full_overwrite, partition_overwrite,
                            replace_table, write_audit_publish)

__all__ = [n for n in dir() if not n.startswith("_") and n not in (
    "functions", "operators", "sources", "plans", "session", "annotations")]

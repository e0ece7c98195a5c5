"""Print a markdown summary of every catalogue query's physical plan.

    python -m tests.plan_report [sf_dir] > PLANS.md

For each query: the physical operators that matter at scale (exchanges,
join strategies, windows, Python evaluation, generators) and, per file
scan, the columns read and the filters pushed into the reader.
"""

from __future__ import annotations

import re
import sys

OPS = (r"BroadcastNestedLoopJoin|CartesianProduct|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
       r"Window|ArrowEvalPython|BatchEvalPython|Generate|Exchange \w+|SortAggregate|"
       r"ObjectHashAggregate|HashAggregate|TakeOrderedAndProject|Expand")


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tidewater.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Physical plans of the driver queries\n")
    print(f"Generated by `python -m tests.plan_report {sf}` (initial AQE plans; at run time AQE may")
    print("turn a sort-merge join into a broadcast when the measured side is small, and coalesce or")
    print("split shuffle partitions). Scans over files written by the query itself appear as")
    print("`ExistingRDD` (checkpointed data) or as CSV/JSON/Parquet scans of the scratch folder.\n")
    print("| query | operators | scans: columns read / pushed filters |")
    print("| --- | --- | --- |")
    for name, fn in sorted(E.queries().items()):
        p = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        ops = sorted(set(re.findall(OPS, p)))
        scans = re.findall(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", p)
        cells = []
        for fmt, cols, pf in scans:
            names = ", ".join(re.sub(r"#\d+L?", "", c) for c in cols.split(","))
            cells.append(f"{fmt}: {names} / {pf or '-'}".replace("|", "\\|"))
        print(f"| `{name}` | {', '.join(ops) or 'scan + project'} | {'<br>'.join(cells) or '-'} |")
    print(SCALE_NOTES)


SCALE_NOTES = """
## Reading these plans at 100 TB

* **Scans.** Every Parquet scan reads only the columns the query uses; date and watermark
  predicates appear under pushed filters, hour filters on the flow logs as partition filters.
  CSV/JSON scans read the stand-in files the query wrote from the driver tables.
* **Matching family** (`exact_match_pairs`, `unmatched_*`, `jaccard_join`, `fee_diff`,
  `distance_summary`, `match_preview`, `lsh_similarity_join`). `ArrowEvalPython` is the NFKC UDF,
  reached only by non-ASCII text. Exact matching shuffles 64-byte digests; the legacy side is
  aggregated to one row per key before the join, so a hot key is one row. The similarity joins
  shuffle: sets by (side, digest) with map-side partial aggregation, token hashes for document
  frequency, set ids for the prefix ranking (`Window`), prefix tokens for candidates, candidate
  pairs for the positional filter, then candidates with both token arrays for verification.
  Intermediates are cut into the shared checkpoint folder. No stage collects a group.
* **Gold family** (`scd2_dimension`, `nav_change`, `fact_performance`, `daily_wide`, `dim_date`,
  `latest_snapshot`). Inputs are first aggregated to one row per (key, day); every `Window` is
  per key over days, so its partition is bounded by the calendar. `SortAggregate` comes from
  `max_by` over strings/structs (string buffers are not hash-aggregatable) and still combines
  map-side. The calendar (`Generate` over `sequence`) is one row per day; AQE decides how it is
  joined.
* **Logs** (`table_refs_*`, `audit_log_scan`, `partition_projection`, `flow_log_scan`). One
  `Generate` explodes references/resources per row; aggregates combine map-side on
  (table, day) or (day, action). The newest-N window is a `TakeOrderedAndProject` (top-N per
  task, then a merge of N-row lists).
* **Sinks** (`partition_overwrite`, `full_overwrite`, `write_audit_publish`,
  `compact_partitions`, `routed_ingest`, `replace_table`). Writes are rebalanced on the
  partition columns (AQE splits a skewed partition); WAP audits the staged files in one
  aggregate and moves them into main; compaction reads file sizes and row counts from `_metadata`,
  rewrites only partitions with too many files and swaps those one by one.
* **Sensitive scan** (`sensitive_scan`, `sensitive_findings`, `hash_sample`). `unpivot` turns
  columns into cell rows (narrow); detectors are JVM regexes; findings aggregate on
  (object, detector, column).
"""


if __name__ == "__main__":
    main()

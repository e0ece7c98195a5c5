"""Sensitive-data scan with cell-level findings.

Cells come from an ``unpivot`` of the scanned columns, keyed by the row
key the caller names (a distributed table has no global line order), so
the scan is one narrow pass; findings are an aggregate over the small
(object, detector, column) key space. Cell positions are rows of the
``cells`` frame; :func:`finding_documents` gathers them into ordered lists of
bounded length, numbered chunks of one finding.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.detectors import DEFAULT_DETECTORS, Detector
from ..session import materialize

# Fixed value: share of objects scanned.
SAMPLING_PERCENTAGE = 75

#: Cell positions in one chunk of a finding document.
CELLS_PER_CHUNK = 100


def hash_bucket(key: Column | str) -> Column:
    """0..99 from the first 16 bits of ``md5(key)`` -- layout independent."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 4), 16, 10).cast("int") % 100


def hash_sample(df: DataFrame, key: str | Column, percentage: int = SAMPLING_PERCENTAGE) -> DataFrame:
    """P10: deterministic ``percentage`` % sample by key hash.

    Unlike ``df.sample`` the same key is always in or out, whatever the
    partitioning or the rerun. Sample rows by a key column, or whole
    objects by ``"_metadata.file_path"`` (every row of a kept file stays).
    """
    return df.filter(hash_bucket(key) < F.lit(percentage))


def object_key(root: str | None = None, path_col: str | None = None) -> Column:
    """The key of a row's object: ``path_col``, or the file's path below
    ``root`` whatever scheme or host the reader puts before it, or (without a
    root) the file name."""
    if path_col:
        return F.col(path_col)
    if root is None:
        return F.col("_metadata.file_name")
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).strip("/")
    return F.regexp_extract(F.col("_metadata.file_path"), "(?:^|/)" + re.escape(bare) + "/+(.*)$", 1)


def in_scope(df: DataFrame, prefixes: list[str], root: str | None = None,
             path_col: str | None = None) -> DataFrame:
    """Keep rows whose object key starts with one of ``prefixes``.

    With ``root`` a table that is a folder of part files is in scope as a
    whole when its folder's key is.
    """
    key = object_key(root, path_col)
    cond = F.lit(False)
    for x in prefixes:
        cond = cond | key.startswith(x)
    return df.filter(cond)


def scan_cells(df: DataFrame, row_key: str, columns: list[str] | None = None,
               detectors: tuple[Detector, ...] = DEFAULT_DETECTORS,
               object_name: str | Column = "object",
               positions: dict[str, int] | None = None) -> DataFrame:
    """F14 + detectors: one row per (cell, detector) with at least one hit.

    Columns: object, row (the key as text), column (1-based position in
    ``df``, or as given by ``positions``), columnName, detector, hits. All
    columns are scanned unless ``columns`` names some, the key's among them.
    """
    all_cols = df.columns
    cols = columns or all_cols
    pos = {c: (positions or {}).get(c, all_cols.index(c) + 1) for c in cols}
    obj = F.lit(object_name) if isinstance(object_name, str) else object_name
    base = df.select(F.col(row_key).cast("string").alias("__row"), obj.alias("__object"),
                     *[F.col(c).cast("string").alias(c) for c in cols])
    cells = base.unpivot(["__row", "__object"], cols, "columnName", "value").withColumnsRenamed(
        {"__row": "row", "__object": "object"})
    cells = cells.filter(F.col("value").isNotNull())
    colpos = F.element_at(F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))]),
                          F.col("columnName"))
    per_det = F.array(*[F.struct(F.lit(d.name).alias("detector"),
                                 d.hits(F.col("value"), F.col("columnName")).cast("long").alias("hits"))
                        for d in detectors])
    return (cells.select("object", "row", colpos.alias("column"), "columnName",
                         F.explode(per_det).alias("d"))
            .select("object", "row", "column", "columnName",
                    F.col("d.detector").alias("detector"), F.col("d.hits").alias("hits"))
            .filter(F.col("hits") > 0))


def findings(cells: DataFrame) -> DataFrame:
    """A5: per (object, detector, column): cells hit and total matches.

    The per-detector ``count`` of a finding is the sum over its columns.
    """
    return (cells.groupBy("object", "detector", "column", "columnName")
            .agg(F.count(F.lit(1)).alias("cells"), F.sum("hits").alias("hits")))


def object_totals(found: DataFrame) -> DataFrame:
    """A5: total matches per object, over all detectors and columns."""
    return found.groupBy("object").agg(F.sum("hits").alias("total_count"))


def finding_documents(cells: DataFrame, chunk_cells: int = CELLS_PER_CHUNK) -> DataFrame:
    """A5, nested: one row per (object, detector, chunk) with the ordered cell
    positions of that chunk.

    Columns: object, detector, chunk (from 0), ``total_count`` (matches in the
    object, all detectors), ``count`` (matches of this detector), ``n_chunks``,
    ``cells`` (array of (row, column, columnName), at most ``chunk_cells``).
    Cells are ordered by row (as a number where the key is one, such rows first,
    then as text), column, and name; a cell that stands in the input twice is
    listed twice. Objects without a finding have no row, an empty input gives
    an empty table.

    One object may hold most of all findings, so its positions are not numbered
    by a window over the object: cells are dealt out by ranges of the whole
    order, numbered in their partition, and a partition's first number within a
    finding is the sum of what earlier partitions hold of it (one row per
    partition and finding). Only a chunk is ever collected into one list.
    """
    at_row = F.col("row").try_cast("long")
    salt = F.xxhash64(F.monotonically_increasing_id())
    order = [F.col("object"), F.col("detector"), F.col("_at").asc_nulls_last(), F.col("row"), F.col("column"), F.col("columnName")]
    stored = materialize(cells.select("object", "detector", "row", "column", "columnName", "hits"), "cells", "parquet")
    placed = (stored.withColumns({"_at": at_row, "_salt": salt}).repartitionByRange(*order, F.col("_salt"))
              .sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = materialize(placed.select(
        "object", "detector", "row", "column", "columnName", "hits", F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND((1 << 33) - 1).alias("_pos")), "placed", "parquet")
    held = placed.groupBy("object", "detector", "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"), F.sum("hits").alias("_hits"))
    finding = Window.partitionBy("object", "detector")
    earlier = finding.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "count": F.sum("_hits").over(finding),
                             "n_chunks": F.ceil(F.sum("_n").over(finding) / chunk_cells)})
    held = materialize(held, "findings", "parquet")
    total = held.groupBy("object").agg(F.sum("_hits").alias("total_count"))
    numbered = placed.join(held.drop("_n", "_hits", "n_chunks", "count"), ["object", "detector", "_part"]).withColumn(
        "_rank", F.col("_before") + F.col("_pos") - F.col("_first"))
    chunks = (numbered.groupBy("object", "detector", F.floor(F.col("_rank") / chunk_cells).alias("chunk"))
              .agg(F.sort_array(F.collect_list(F.struct("_rank", "row", "column", "columnName"))).alias("_cells")))
    counts = held.select("object", "detector", "count", "n_chunks").distinct()
    return chunks.join(counts, ["object", "detector"]).join(total, "object").select(
        "object", "detector", "chunk", "total_count", "count", "n_chunks",
        F.transform("_cells", lambda c: F.struct(c["row"].alias("row"), c["column"].alias("column"),
                                                 c["columnName"].alias("columnName"))).alias("cells"))

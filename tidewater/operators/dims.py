"""Gold layer: SCD2 dimension, calendar, day-over-day change, latest
snapshot, point-in-time fact lookup and the daily wide table (W1-W5, J6, J7).

Scale notes
-----------
Every window here is partitioned by a business key and ordered by a date.
Inputs are first reduced to one row per (key, day), so the rows one window
partition can hold are bounded by the number of calendar days, never by
the row count of a hot key. The point-in-time lookup is an as-of merge
done with the same kind of window (union fact + dimension rows, carry the
last version forward) instead of a range join, so a key with many versions
costs O(rows) not O(facts x versions). The calendar is built from a single
``sequence`` of (max - min + 1) days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Fixed values (ours, the reference leaves them open): open rows end on this date,
# ISO weekday with weekend = 6, 7, fiscal year starts in April.
SCD2_OPEN_END = "9999-12-31"
FISCAL_START_MONTH = 4


def latest_snapshot(df: DataFrame, keys: list[str], order_col: str, tiebreak: list[str]) -> DataFrame:
    """Newest row per key (by ``order_col`` desc, then ``tiebreak`` desc).

    ``tiebreak`` names at least one column that tells loads of one date apart
    (a load sequence); rows that tie in it too are ordered by their values, so
    the result never depends on the order in which rows arrive. Done as
    ``max_by`` over a struct in an aggregate, which combines map-side, rather
    than a window that would sort all rows of a hot key in one task.
    """
    if not tiebreak:
        raise ValueError("latest_snapshot needs a tiebreak column")
    payload = F.struct(*[F.col(c) for c in df.columns])
    ordering = F.struct(F.col(order_col), *[F.col(t) for t in tiebreak], payload)
    return (df.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_row"))
            .select("_row.*"))


def daily_last(df: DataFrame, key: str, day_col: str, attrs: list[str], order_col: str) -> DataFrame:
    """One row per (key, day): the attributes of the row with the largest ``order_col``."""
    return (df.groupBy(key, day_col)
            .agg(F.max_by(F.struct(*[F.col(a) for a in attrs]), F.col(order_col)).alias("_a"))
            .select(key, day_col, *[F.col(f"_a.{a}").alias(a) for a in attrs]))


def scd2_dimension(daily: DataFrame, key: str, day_col: str, attrs: list[str],
                   sk_col: str | None = "dim_sk", open_end: str = SCD2_OPEN_END) -> DataFrame:
    """W1 + W2: type-2 history from one row per (key, day).

    A row starts a version when its attribute tuple differs (null-safe) from
    the previous day's; the version ends the day before the next one starts,
    open versions end on ``open_end`` and carry ``current_flag``. The
    surrogate key is :func:`surrogate_key` of the key and the start.
    """
    w = Window.partitionBy(key).orderBy(day_col)
    tup = F.struct(*[F.col(a) for a in attrs])
    changed = (daily.withColumn("_prev", F.lag(tup).over(w))
               .filter(F.col("_prev").isNull() | ~tup.eqNullSafe(F.col("_prev")))
               .drop("_prev"))
    nxt = F.lead(F.col(day_col)).over(w)
    out = (changed
           .withColumn("_next", nxt)
           .select(F.col(key), *[F.col(a) for a in attrs],
                   F.col(day_col).alias("effective_start_date"),
                   F.coalesce(F.date_sub(F.col("_next"), 1), F.lit(open_end).cast("date"))
                   .alias("effective_end_date"),
                   F.col("_next").isNull().alias("current_flag")))
    if sk_col:
        out = out.withColumn(sk_col, surrogate_key(F.col(key), F.col("effective_start_date")))
    return out


def surrogate_key(key: Column, start: Column) -> Column:
    """60 bits of ``md5(key|start)`` as a long: stable across reruns, and
    any engine with md5 computes the same."""
    text = F.concat_ws("|", key.cast("string"), F.date_format(start, "yyyy-MM-dd"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _touched_spans(dim: DataFrame, new: DataFrame, key: str, day_col: str) -> tuple[DataFrame, DataFrame]:
    """(versions that stay, spans to rebuild) of the keys in ``new``.

    A version is touched if a new day falls into it (days before the first
    version count for that one), or if it borders one that is. Touched versions
    in a row form a span (``_lo``, ``_hi``, ``_cur``: holds the open version)."""
    versions = dim.withColumns({"_day": F.col("effective_start_date"), "_new": F.lit(0)})
    days = new.select(F.col(key), F.col(day_col).alias("_day"), F.lit(1).alias("_new"))
    u = versions.unionByName(days, allowMissingColumns=True)
    along = Window.partitionBy(key).orderBy("_day", "_new").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    u = u.withColumns({"_n": F.sum("_new").over(along), "_all": F.sum("_new").over(Window.partitionBy(key))})
    w = Window.partitionBy(key).orderBy("_day")
    v = u.filter("_new = 0").withColumns({
        "_first": F.lag("_n").over(w).isNull(),
        "_hit": (F.coalesce(F.lead("_n").over(w), F.col("_all")) > F.col("_n"))
                | (F.lag("_n").over(w).isNull() & (F.col("_n") > 0))})
    v = v.withColumn("_touched", F.col("_hit") | F.coalesce(F.lag("_hit").over(w), F.lit(False))
                     | F.coalesce(F.lead("_hit").over(w), F.lit(False)))
    v = v.withColumn("_span", F.sum((~F.col("_touched")).cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = (v.filter("_touched").groupBy(key, "_span")
             .agg(F.min(F.when(F.col("_first"), F.lit("0001-01-01").cast("date")).otherwise(F.col("_day"))).alias("_lo"),
                  F.max("effective_end_date").alias("_hi"), F.max("current_flag").alias("_cur")).drop("_span"))
    return v.filter("NOT _touched").select(*dim.columns), spans


def scd2_refresh(dim: DataFrame, history: DataFrame, new_rows: DataFrame, key: str, day_col: str,
                 attrs: list[str], sk_col: str | None = "dim_sk",
                 open_end: str = SCD2_OPEN_END) -> DataFrame:
    """W1 with late or out-of-order loads: rebuild only what a new day borders.

    ``history`` holds the daily rows the current ``dim`` was built from;
    ``new_rows`` may fall anywhere in time (before, between or after known
    days); of a known day the new row wins. Only the versions a new day falls
    into, and their neighbours (with which they may merge), are rebuilt from
    the history of those days; all other rows of ``dim`` come back as they
    are. Equal to a full rebuild. The history is read once (a semi-join on the
    touched keys), and its days find their span by an as-of merge, so a key
    with many late days costs no product of days and spans. No new rows: ``dim``.
    """
    new = materialize(latest_snapshot(new_rows.select(key, day_col, *attrs), [key, day_col], day_col, [day_col]),
                      "new_days", "parquet")
    affected = new.select(key).distinct()
    kept, spans = _touched_spans(dim.join(affected, key, "left_semi"), new, key, day_col)
    daily = (history.select(key, day_col, *attrs).join(affected, key, "left_semi").withColumn("_kind", F.lit(1))
             .unionByName(new.withColumn("_kind", F.lit(2))))
    tup = F.struct(*[F.col(a) for a in attrs])
    newest = Window.partitionBy(key, day_col).orderBy(F.desc("_kind"), tup.desc())
    daily = daily.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    marks = spans.select(key, F.col("_lo").alias(day_col), F.lit(0).alias("_kind"), F.struct("_lo", "_hi", "_cur").alias("_in"))
    along = (Window.partitionBy(key).orderBy(day_col, "_kind")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a new day outside all spans belongs to a key that had no version yet
    days = (daily.unionByName(marks, allowMissingColumns=True).withColumn("_in", F.last("_in", ignorenulls=True).over(along))
            .filter((F.col("_kind") > 0) & F.when(F.col("_in").isNull(), F.col("_kind") == 2)
                    .otherwise(F.col(day_col) <= F.col("_in._hi"))))
    w = Window.partitionBy(key, "_in").orderBy(day_col)
    starts = (days.withColumn("_prev", F.lag(tup).over(w))
              .filter(F.col("_prev").isNull() | ~tup.eqNullSafe(F.col("_prev")))
              .withColumn("_next", F.lead(F.col(day_col)).over(w)))
    rebuilt = starts.select(
        F.col(key), *[F.col(a) for a in attrs], F.col(day_col).alias("effective_start_date"),
        F.coalesce(F.date_sub("_next", 1), "_in._hi", F.lit(open_end).cast("date")).alias("effective_end_date"),
        (F.col("_next").isNull() & F.coalesce("_in._cur", F.lit(True))).alias("current_flag"))
    if sk_col:
        rebuilt = rebuilt.withColumn(sk_col, surrogate_key(F.col(key), F.col("effective_start_date")))
    return dim.join(affected, key, "left_anti").unionByName(kept).unionByName(rebuilt.select(*dim.columns))


def assert_unique(df: DataFrame, cols: list[str] | str) -> None:
    """W2 check: no two rows share the key (for example a hashed surrogate key).

    One aggregate pass; raises with a sample of the colliding keys.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    dup = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(5).collect()
    if dup:
        raise ValueError(f"duplicate keys on {cols}: {[tuple(r)[:-1] for r in dup]}")


def nav_change(daily: DataFrame, key: str, day_col: str, value_col: str,
               value_type: str = "decimal(18,4)", pct_digits: int = 6) -> DataFrame:
    """Change from the previous day of the same key, absolute and in %.

    The absolute change stays decimal; the percentage is computed in double
    and rounded, because decimal(10,6) overflows on real swings. A zero
    previous value gives a null percentage (ANSI division would fail).
    """
    w = Window.partitionBy(key).orderBy(day_col)
    prev = F.lag(value_col).over(w)
    return (daily.withColumn("_prev", prev)
            .withColumn("price_change", (F.col(value_col) - F.col("_prev")).cast(value_type))
            .withColumn("price_change_rate_pct",
                        # try_divide: a zero previous value gives null, not a failed job
                        F.round(F.try_divide((F.col(value_col) - F.col("_prev")).cast("double"),
                                             F.col("_prev").cast("double")) * F.lit(100.0), pct_digits))
            .drop("_prev"))


def dim_date(bounds: DataFrame, start_col: str = "d0", end_col: str = "d1",
             fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """W5 + W2: one row per calendar day between the bounds (inclusive).

    ``bounds`` is a one-row frame (for example ``min``/``max`` of a fact's
    date). ``date_sk`` is the ``yyyyMMdd`` integer.
    """
    d = F.col("date_value")
    return (bounds.select(F.explode(F.sequence(F.col(start_col).cast("date"),
                                               F.col(end_col).cast("date"),
                                               F.expr("interval 1 day"))).alias("date_value"))
            .select(
                F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"),
                d,
                F.year(d).alias("year"),
                F.month(d).alias("month"),
                F.dayofmonth(d).alias("day"),
                (F.weekday(d) + 1).alias("day_of_week"),
                (F.weekday(d) >= 5).alias("is_weekend"),
                (F.last_day(d) == d).alias("is_month_end"),
                F.date_format(d, "yyyyMM").alias("year_month"),
                F.year(F.add_months(d, -(fiscal_start_month - 1))).alias("fiscal_year")))


def calendar_for(df: DataFrame, date_col: str, fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """Calendar spanning ``min..max`` of a date column of ``df``."""
    b = df.agg(F.min(F.to_date(date_col)).alias("d0"), F.max(F.to_date(date_col)).alias("d1"))
    return dim_date(b, fiscal_start_month=fiscal_start_month)


def asof_version(fact: DataFrame, dim: DataFrame, key: str, day_col: str,
                 start_col: str = "effective_start_date",
                 carry: list[str] | None = None) -> DataFrame:
    """J6 (fund part): for each fact row, the dimension version in effect.

    Equivalent to ``fact.key = dim.key AND fact.day BETWEEN start AND end``
    on a gap-free SCD2 history, computed as an as-of merge: union the
    version starts into the fact stream and carry the latest start forward
    with ``last(..., ignorenulls)``. ``carry`` lists dimension columns to
    bring along (default: the start date only).
    """
    carry = carry or []
    vcols = [start_col] + [c for c in carry if c != start_col]
    f = fact.select("*", *[F.lit(None).cast(dim.schema[c].dataType).alias(f"_v_{c}") for c in vcols],
                   F.lit(1).alias("_is_fact"))
    fact_cols = fact.columns
    d = dim.select(
        F.col(key), F.col(start_col).alias(day_col),
        *[F.lit(None).cast(fact.schema[c].dataType).alias(c) for c in fact_cols if c not in (key, day_col)],
        *[F.col(c).alias(f"_v_{c}") for c in vcols],
        F.lit(0).alias("_is_fact"))
    u = f.unionByName(d)
    w = (Window.partitionBy(key).orderBy(F.col(day_col), F.col("_is_fact"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    u = u.select(*fact_cols, "_is_fact",
                 *[F.last(f"_v_{c}", ignorenulls=True).over(w).alias(c) for c in vcols])
    return u.filter(F.col("_is_fact") == 1).drop("_is_fact")


def fact_performance(nav: DataFrame, dim: DataFrame, calendar: DataFrame, key: str,
                     day_col: str, carry: list[str] | None = None) -> DataFrame:
    """Daily fact with the dimension version and the ``date_sk`` (an
    equi-join on the day, left to the planner)."""
    f = asof_version(nav, dim, key, day_col, carry=carry)
    cal = calendar.select(F.col("date_value").alias(day_col), "date_sk")
    return f.join(cal, day_col, "left")


def daily_wide(daily: DataFrame, master: DataFrame, key: str, master_key: str | None = None) -> DataFrame:
    """Each daily row with the current master attributes (left join)."""
    mk = master_key or key
    m = master if mk == key else master.withColumnRenamed(mk, key)
    return daily.join(m, key, "left")


# The fund dimension's tracked attributes (the master's columns).
FUND_ATTRS = ["fund_category", "trust_fee_rate", "is_active", "fund_name", "nickname",
              "management_company", "manager_name", "manager_email"]


def build_gold(master_snapshots: DataFrame, nav: DataFrame, id_col: str = "fund_id",
               snapshot_col: str = "ingest_date", date_col: str = "base_date",
               value_col: str = "nav_price", attrs: list[str] | None = None,
               load_seq: str = "load_seq") -> dict[str, DataFrame]:
    """The gold star schema from bronze snapshots and NAV rows.

    Both inputs carry ``snapshot_col`` (the load date) and ``load_seq`` (which
    of several loads of one date is the newest); the newest load of a master
    day, and of a (fund, day) price, counts, so a corrected price replaces the
    earlier one whether higher or lower.

    * ``dim_fund``: SCD2 over the master snapshots, ``fund_sk`` surrogate key;
    * ``dim_date``: calendar spanning the NAV dates (``date_sk`` = yyyyMMdd);
    * ``fact``: one row per (fund, day) with the day-over-day change, the
      ``fund_sk`` of the version in effect that day and the ``date_sk``;
    * ``wide``: the fact with the attributes of that version.
    """
    attrs = [a for a in (attrs or FUND_ATTRS) if a in master_snapshots.columns]
    daily_master = latest_snapshot(master_snapshots, [id_col, snapshot_col], snapshot_col, [load_seq])
    dim = scd2_dimension(daily_master, id_col, snapshot_col, attrs, sk_col="fund_sk")
    daily_nav = latest_snapshot(nav, [id_col, date_col], snapshot_col, [load_seq]).select(id_col, date_col, value_col)
    changes = nav_change(daily_nav, id_col, date_col, value_col)
    cal = calendar_for(changes, date_col)
    fact = fact_performance(changes, dim, cal, id_col, date_col, carry=["fund_sk"])
    wide = fact.join(dim.select("fund_sk", *attrs), "fund_sk", "left")
    return {"dim_fund": dim, "dim_date": cal, "fact": fact, "wide": wide}

"""Data-quality checks.

Every check returns a DataFrame of findings (empty = passes); nothing is
collected. Completeness is checked by counts or presence bitmaps, never by
materialising a key cross product; gaps are intervals found between rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.calendar import epoch_micros, hour_floor, hours_between
from ..sources.spine import spine_between
from .sizing import checked_broadcast, stored


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Q1: keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def missing_instants(df: DataFrame, ts: str, keys=()) -> DataFrame:
    """Hourly instants between each series' first and last that are absent."""
    keys = list(keys)
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    spine = spine_between(bounds, "_lo", "_hi", ts, keys)
    return spine.join(df.select(*keys, ts), [*keys, ts], "left_anti")


def null_counts(df: DataFrame) -> DataFrame:
    """Q3: null count of every column in one pass (one row)."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in df.columns])


def incomplete_combinations(df: DataFrame, member_keys, group_keys) -> DataFrame:
    """Q4: groups (e.g. origin x hours_ahead) not covering every member (station)
    seen anywhere in the table; count form, no cross product."""
    member = F.struct(*member_keys)
    total = df.select(F.count_distinct(member).alias("t")).scalar()
    return (df.groupBy(*group_keys).agg(F.count_distinct(member).alias("n_present"))
            .withColumn("n_expected", total).filter(F.col("n_present") < F.col("n_expected")))


def series_length_profile(df: DataFrame, keys) -> DataFrame:
    """Q5: rows per series and whether all series are equally long (one row)."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("n_series"), F.min("n").alias("min_len"), F.max("n").alias("max_len"),
                 (F.count_distinct("n") == 1).alias("equal_length"))


def series_with_gaps(df: DataFrame, keys, ts: str) -> DataFrame:
    """Q6: series whose hour count is below the span between first and last hour."""
    g = df.groupBy(*keys).agg(F.min(ts).alias("first"), F.max(ts).alias("last"),
                              F.count_distinct(ts).alias("n_present"))
    span = hours_between("first", "last") + 1
    return (g.withColumn("n_expected", span)
            .withColumn("n_missing", F.col("n_expected") - F.col("n_present"))
            .filter(F.col("n_missing") > 0))


def key_difference(a: DataFrame, b: DataFrame, keys, distinct: bool = True) -> DataFrame:
    """Keys of ``a`` missing from ``b`` and of ``b`` missing from ``a``, tagged."""
    ka, kb = a.select(*keys), b.select(*keys)
    if distinct:
        left, right = ka.subtract(kb), kb.subtract(ka)
    else:
        left, right = ka.exceptAll(kb), kb.exceptAll(ka)
    return (left.withColumn("side", F.lit("only_left"))
            .unionByName(right.withColumn("side", F.lit("only_right"))))


def anti_join(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """J19."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def gap_intervals(df: DataFrame, ts: str, keys=()) -> DataFrame:
    """Q2/Q6/J19 as islands and gaps: ``keys..., first_missing, last_missing, n_missing`` of each run of absent hours
    between a series' first and last, without making its spine.

    One shuffle folds each (series, day) into its sorted hours; a second one
    orders the days of a series, a row a day, so that each day also sees the
    last hour before it. Gaps are then found inside that row, at most 24 a day.
    The work follows the rows present, not the hours that the series spans.
    Null instants and keys: null instants are left out, null keys are a series."""
    keys = list(keys)
    hours = df.filter(F.col(ts).isNotNull()).select(*keys, hour_floor(ts).alias("_h"))
    days = hours.groupBy(*keys, F.to_date("_h").alias("_day")).agg(F.array_sort(F.collect_set("_h")).alias("_hours"))
    before = F.lag(F.element_at("_hours", -1)).over(Window.partitionBy(*keys).orderBy("_day"))
    seen = days.withColumn("_before", before).select(
        *keys, F.concat(F.array_compact(F.array("_before")), F.col("_hours")).alias("_hours"))
    steps = F.zip_with(F.slice("_hours", 1, F.size("_hours") - 1), F.slice("_hours", 2, F.size("_hours")),
                       lambda a, b: F.struct(a.alias("a"), hours_between(a, b).alias("n")))
    gaps = seen.select(*keys, F.explode(F.filter(steps, lambda s: s["n"] > 1)).alias("_gap"))
    one, n = F.expr("interval 1 hour"), F.col("_gap.n").cast("int") - 1
    return gaps.select(*keys, (F.col("_gap.a") + one).alias("first_missing"),
                       (F.col("_gap.a") + F.make_dt_interval(F.lit(0), n)).alias("last_missing"), n.cast("bigint").alias("n_missing"))


def expand_gaps(gaps: DataFrame, ts: str, keys=()) -> DataFrame:
    """The hours of ``gap_intervals``, one row each."""
    return gaps.select(*keys, F.explode(F.sequence("first_missing", "last_missing", F.expr("interval 1 hour"))).alias(ts))


WORD_BITS = 32_768          # numbers that one bitmap of Spark's bitmap functions holds


def numbered_rows(df: DataFrame, name: str = "_id") -> tuple[DataFrame, int]:
    """``df``'s rows numbered 1, 2, ... without a gap, as a stored table, and their count: each task counts its own
    rows, and the tasks' counts, added up, say where each begins."""
    kept, n = stored(df.withColumn("_at", F.monotonically_increasing_id()))
    task, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = kept.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    begins = counts.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_begin"))     # a row a task
    out = kept.withColumn("_task", task).join(F.broadcast(begins), "_task")
    return out.withColumn(name, F.col("_begin") + row + 1).drop("_at", "_task", "_begin"), n


def missing_members(df: DataFrame, member_keys, group_keys) -> DataFrame:
    """Q4 by name: ``group_keys..., member_keys...`` of each member seen anywhere in the table that a group lacks.

    Members are numbered; a group's presence is one bitmap per word of
    ``WORD_BITS`` numbers, built before and merged after the shuffle
    (``bitmap_construct_agg``), so a group moves as a few KB and not as its
    members. Only words that hold fewer bits than there are members are read
    bit by bit; what is absent there is named by a join on the number. Null
    members do not count; a group of null members alone lacks them all."""
    member_keys, group_keys = list(member_keys), list(group_keys)
    members, n = numbered_rows(df.select(*member_keys).dropna().distinct())
    members = checked_broadcast(members)
    words = -(-n // WORD_BITS)
    present = (df.select(*group_keys, *member_keys).join(members, member_keys, "left")
               .groupBy(*group_keys, F.bitmap_bucket_number("_id").alias("_word"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits")))
    if words > 1:       # a group that lacks a whole word has no bitmap of it
        one = present.groupBy(*group_keys).agg(F.map_from_entries(F.collect_list(F.struct(F.coalesce("_word", F.lit(0)), "_bits"))).alias("_m"))
        present = one.select(*group_keys, F.explode(F.sequence(F.lit(1), F.lit(words))).alias("_word"), "_m") \
            .select(*group_keys, "_word", F.try_element_at("_m", F.col("_word").cast("bigint")).alias("_bits"))
    else:               # one word: null members have one of their own, dropped where the group has another
        present = present.groupBy(*group_keys).agg(F.max_by("_bits", F.coalesce("_word", F.lit(0))).alias("_bits"),
                                                   F.max("_word").alias("_some")) \
            .select(*group_keys, F.lit(1).alias("_word"), F.when(F.col("_some").isNotNull(), F.col("_bits")).alias("_bits"))
    base = (F.col("_word") - 1) * WORD_BITS
    held = F.least(F.lit(WORD_BITS), F.lit(n) - base)                 # members of the word
    short = present.filter(F.coalesce(F.bitmap_count("_bits"), F.lit(0)) < held).withColumn("_hex", F.hex("_bits"))
    # two hexadecimal digits a byte, the high one first
    digit = lambda p: F.conv(F.substring(F.col("_hex"), (F.floor(p / 8) * 2 + F.when(p % 8 < 4, 2).otherwise(1)).cast("int"), F.lit(1)), 16, 10)     # noqa: E731
    absent = F.filter(F.sequence(F.lit(0).cast("bigint"), held.cast("bigint") - 1),
                      lambda p: F.col("_hex").isNull() | (F.getbit(digit(p).cast("int"), (p % 4).cast("int")) == 0))
    ids = short.select(*group_keys, base.cast("bigint").alias("_base"), F.explode(absent).alias("_p")) \
        .select(*group_keys, (F.col("_base") + F.col("_p") + 1).alias("_id"))
    return ids.join(members, "_id").select(*group_keys, *member_keys)


def frequency_mode(df: DataFrame, ts: str, keys=()) -> DataFrame:
    """Most common step between consecutive distinct instants, per series.

    Consecutive pairs are found inside (series, day) groups plus one step per
    day boundary from a per-day summary, so no group spans the whole table.
    Returns ``keys..., step_seconds, n_steps``, one row per series."""
    keys = list(keys)
    d = df.select(*keys, ts).distinct().withColumn("_b", F.to_date(ts))
    secs = epoch_micros(ts) / 1_000_000
    d = d.withColumn("_s", secs)
    w = Window.partitionBy(*keys, "_b").orderBy("_s")
    inner = d.withColumn("step", F.col("_s") - F.lag("_s").over(w)).filter(F.col("step").isNotNull())
    days = d.groupBy(*keys, "_b").agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"))
    wd = Window.partitionBy(*keys).orderBy("_b")
    cross = days.withColumn("step", F.col("_first") - F.lag("_last").over(wd)).filter(F.col("step").isNotNull())
    steps = inner.select(*keys, "step").unionByName(cross.select(*keys, "step"))
    counts = steps.groupBy(*keys, "step").agg(F.count(F.lit(1)).alias("n_steps"))
    best = counts.groupBy(*keys).agg(F.max_by(F.struct("step", "n_steps"),
                                              F.struct("n_steps", F.negative("step"))).alias("_m"))
    return best.select(*keys, F.col("_m.step").cast("bigint").alias("step_seconds"),
                       F.col("_m.n_steps").alias("n_steps"))


def table_profile(df: DataFrame, ts: str, name: str, key_desc: str, keys=()) -> DataFrame:
    """Q8: start, end, frequency and key of a table (one row per series)."""
    keys = list(keys)
    span = df.groupBy(*keys).agg(F.min(ts).alias("start"), F.max(ts).alias("end"),
                                 F.count(F.lit(1)).alias("n_rows"))
    freq = frequency_mode(df, ts, keys)
    if keys:
        out = span.join(freq, keys, "left")
    else:
        out = span.withColumns({"step_seconds": freq.select("step_seconds").scalar(),
                                "n_steps": freq.select("n_steps").scalar()})
    return out.select(F.lit(name).alias("table"), *keys, "start", "end", "step_seconds", "n_rows",
                      F.lit(key_desc).alias("key"))

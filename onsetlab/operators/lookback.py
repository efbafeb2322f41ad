"""Categories of the events in the days before each disease onset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from onsetlab.functions.dates import day_number
from onsetlab.operators.cohort import ROW_COUNT, compact_cohort
from onsetlab.operators.lookup import BROADCAST_BYTES, ROW_OVERHEAD_BYTES, fits_broadcast, lookup_join
from onsetlab.operators.rows import expand_rows
from onsetlab.sources.staging import measured

LOOKBACK_DAYS = (0, 360)
CATEGORY_COUNT = "category_count"
#: A window meets at most one time bucket more than this.
BUCKETS_IN_WINDOW = 2
#: Measured bytes of a run of days: five numbers and what a row costs.
RUN_BYTES = 5 * 8 + ROW_OVERHEAD_BYTES


def lookback_events(
    cohort: DataFrame,
    events: DataFrame,
    concept_col: str,
    date_col: str,
    lookback: tuple[int, int] = LOOKBACK_DAYS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """A cohort left-joined to its lookback events, in counted form.

    An event belongs to a cohort row if it lies ``lookback`` (nearest, farthest)
    days before the row's onset, both inclusive. The result has one row per
    person, concept and event day, where ``event_rows`` equal events meet
    ``index_rows`` cohort rows: their product is the number of joined rows. A
    cohort row without any event has ``concept_id`` and ``event_date`` NULL and
    ``event_rows`` 1.

    Time is cut into buckets of half the window. Within a bucket the
    windows of a person become disjoint runs of days that equally many cohort
    rows look back on (:func:`_covered_runs`), so an event meets one run at most
    and is compared with no more runs than a bucket has days. Runs are joined to
    the events on person and bucket: broadcast up to ``max_bytes``, otherwise by
    a shuffle on both, which the count per day reuses, and which divides a person
    with very many events by time.

    The events are read once, the cohort three times (its size, runs, pieces of
    windows); stage it if it is costly.
    """
    nearest, farthest = lookback
    if farthest < nearest:
        raise ValueError("lookback is (nearest, farthest) in days before onset")
    width = -(-(farthest - nearest + 1) // BUCKETS_IN_WINDOW)

    index = (
        # The cohort's one shuffle: counts, runs and their totals all keep to it.
        compact_cohort(cohort)
        .repartition("person_id")
        .groupBy("person_id", "disease_start_date")
        .agg(F.sum(ROW_COUNT).alias("index_rows"))
    )
    pieces = _window_pieces(index, lookback, width)
    runs = _covered_runs(pieces, width)
    narrow = (
        events.select(
            "person_id",
            F.col(concept_col).alias("concept_id"),
            F.col(date_col).alias("event_date"),
        )
        .filter(F.col("person_id").isNotNull() & F.col("event_date").isNotNull())
        .withColumn("day", day_number("event_date"))
        .withColumn("bucket", _bucket(F.col("day"), width))
    )
    # No onset has more runs than two for each bucket that its window meets.
    onsets = (measured(cohort) or {"rows": None})["rows"]
    onsets = index.count() if onsets is None else onsets
    few = onsets * 2 * (BUCKETS_IN_WINDOW + 1) * RUN_BYTES <= max_bytes
    small = few or fits_broadcast(runs, max_bytes)
    met = (
        narrow.join(F.broadcast(runs) if small else runs.hint("merge"), ["person_id", "bucket"])
        .filter(F.col("day").between(F.col("first"), F.col("last")))
        .groupBy("person_id", "bucket", "concept_id", "event_date", "index_rows")
        .agg(F.count("*").alias("event_rows"))
    )
    events_met = met.select("person_id", "concept_id", "event_date", "event_rows", "index_rows")
    return events_met.unionByName(_without_event(pieces, met, events_met))


def _bucket(day: Column, width: int) -> Column:
    return F.floor(day / width)


def _window_pieces(index: DataFrame, lookback: tuple[int, int], width: int) -> DataFrame:
    """The window of each onset, cut at the buckets' borders: ``since`` and ``until`` are days.

    A window is no shorter than a bucket, so a piece begins where its bucket
    begins or ends where it ends. An onset without person or date has one piece
    without days.
    """
    nearest, farthest = lookback
    onset = day_number("disease_start_date")
    buckets = F.sequence(_bucket(onset - farthest, width), _bucket(onset - nearest, width))
    known = F.col("person_id").isNotNull()
    return index.withColumn("bucket", F.explode_outer(F.when(known, buckets))).withColumns(
        {
            "since": F.greatest(onset - farthest, F.col("bucket") * width),
            "until": F.least(onset - nearest, F.col("bucket") * width + width - 1),
        }
    )


def _covered_runs(pieces: DataFrame, width: int) -> DataFrame:
    """``person_id, bucket, first, last, index_rows``: disjoint days with the same cover above 0.

    A piece is a step up at its first day and a step down after its last; steps
    of one day are added, and their running total is the cover until the next.
    """
    up = F.struct(F.col("since").alias("first"), F.col("index_rows").alias("step"))
    down = F.struct((F.col("until") + 1).alias("first"), (-F.col("index_rows")).alias("step"))
    steps = (
        pieces.filter(F.col("bucket").isNotNull())
        .select("person_id", "bucket", F.inline(F.array(up, down)))
        .groupBy("person_id", "bucket", "first")
        .agg(F.sum("step").alias("step"))
    )
    by_day = Window.partitionBy("person_id", "bucket").orderBy("first")
    return steps.select(
        "person_id",
        "bucket",
        "first",
        (F.lead("first").over(by_day) - 1).alias("last"),
        F.sum("step").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("index_rows"),
    ).filter("index_rows > 0")


def _without_event(pieces: DataFrame, met: DataFrame, like: DataFrame) -> DataFrame:
    """The onsets whose window no event lies in, as rows of the lookback.

    A piece of a window reaches to one border of its bucket, so the first and
    the last event day of the person in the bucket tell whether it has one.
    """
    # That the count is used here too keeps this branch's shuffle the same as the
    # other's, which is then not done again.
    days = met.groupBy("person_id", "bucket").agg(
        F.min(day_number("event_date")).alias("earliest"),
        F.max(F.when(F.col("event_rows") > 0, day_number("event_date"))).alias("latest"),
    )
    has_event = F.col("earliest").between(F.col("since"), F.col("until")) | F.col("latest").between(
        F.col("since"), F.col("until")
    )
    return (
        pieces.join(days, ["person_id", "bucket"], "left")
        .groupBy("person_id", "disease_start_date")
        .agg(
            F.max("index_rows").alias("index_rows"),
            F.bool_or(F.coalesce(has_event, F.lit(False))).alias("met"),
        )
        .filter(~F.col("met"))
        .select(
            "person_id",
            F.lit(None).cast(like.schema["concept_id"].dataType).alias("concept_id"),
            F.lit(None).cast("date").alias("event_date"),
            F.lit(1).cast("bigint").alias("event_rows"),
            "index_rows",
        )
    )


def categorise(
    lookback: DataFrame,
    categories: DataFrame,
    category_col: str,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Lookback events with the names of their categories.

    A concept with several ancestors gives a row for each; one without any
    keeps its row with a NULL category. ``event_rows`` counts ancestors of the
    same name too.
    """
    names = categories.groupBy(
        F.col("descendant_concept_id").alias("concept_id"),
        F.col("ancestor_concept_name").alias(category_col),
    ).agg(F.count("*").alias("ancestors"))
    joined = lookup_join(
        lookback,
        names,
        on="concept_id",
        how="left",
        spread=["person_id", "event_date"],
        max_bytes=max_bytes,
        # Two columns and a count stand for rows of the map, so the map is no smaller.
        at_most=categories,
    )
    return joined.select(
        "person_id",
        category_col,
        "event_date",
        (F.col("event_rows") * F.coalesce("ancestors", F.lit(1))).alias("event_rows"),
        "index_rows",
    )


def joined_rows(categorised: DataFrame, category_col: str) -> DataFrame:
    """Each row's person, category, and the number of joined rows it stands for."""
    rows = F.col("event_rows") * F.col("index_rows")
    return categorised.select("person_id", category_col, rows.alias(CATEGORY_COUNT))


def count_categories(categorised: DataFrame, category_col: str) -> DataFrame:
    """Joined rows per person and category: ``person_id, category, category_count``."""
    return (
        joined_rows(categorised, category_col)
        .groupBy("person_id", category_col)
        .agg(F.sum(CATEGORY_COUNT).alias(CATEGORY_COUNT))
    )


def lookback_categories(
    cohort: DataFrame,
    events: DataFrame,
    concept_col: str,
    date_col: str,
    categories: DataFrame,
    category_col: str,
    lookback: tuple[int, int] = LOOKBACK_DAYS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Person and category, one row per cohort row, lookback event and ancestor."""
    met = lookback_events(cohort, events, concept_col, date_col, lookback, max_bytes)
    counts = count_categories(categorise(met, categories, category_col, max_bytes), category_col)
    return expand_rows(counts, CATEGORY_COUNT)


def top_categories(
    counts: DataFrame, category_col: str, n: int = 10, null_takes_slot: bool = True
) -> DataFrame:
    """The ``n`` categories with the most rows, with their ``category_count``.

    Takes the result of :func:`count_categories` or :func:`joined_rows`.
    Rows without a category compete for a place unless ``null_takes_slot`` is
    false. Ties are broken by name, rows without a category last.
    """
    if not null_takes_slot:
        counts = counts.filter(F.col(category_col).isNotNull())
    return (
        counts.groupBy(category_col)
        .agg(F.sum(CATEGORY_COUNT).alias(CATEGORY_COUNT))
        .orderBy(F.desc(CATEGORY_COUNT), F.asc_nulls_last(category_col))
        .limit(n)
    )


def top_category_names(
    counts: DataFrame, category_col: str, n: int = 10, null_takes_slot: bool = True
) -> list[str]:
    """The names of the top categories, at most ``n`` strings, in name order."""
    top = top_categories(counts, category_col, n, null_takes_slot)
    return sorted(row[0] for row in top.select(category_col).collect() if row[0] is not None)


def restrict_to_top(
    counts: DataFrame,
    category_col: str,
    n: int = 10,
    null_takes_slot: bool = True,
) -> DataFrame:
    """Counts of the top categories only; rows without a category are dropped.

    ``counts`` is read more than once; stage it if it is costly.
    """
    # At most n names, so there is nothing to measure before they are copied.
    top = top_categories(counts, category_col, n, null_takes_slot).select(category_col)
    return counts.join(F.broadcast(top), category_col, "left_semi").select(
        "person_id", category_col, CATEGORY_COUNT
    )


def common_categories(
    long_rows: DataFrame,
    category_col: str,
    n: int = 10,
    null_takes_slot: bool = True,
) -> DataFrame:
    """Person and category rows, restricted to the top categories.

    Takes the rows of :func:`lookback_categories`, or their counts.
    """
    if CATEGORY_COUNT not in long_rows.columns:
        long_rows = long_rows.groupBy("person_id", category_col).agg(
            F.count("*").alias(CATEGORY_COUNT)
        )
    return expand_rows(
        restrict_to_top(long_rows, category_col, n, null_takes_slot), CATEGORY_COUNT
    )

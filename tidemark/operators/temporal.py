"""Interval join: each fact with the version that was valid at its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.calendar import hour_number
from tidemark.operators.skew import ROWS_PER_GROUP, all_slots, heavy_groups, slot_of
from tidemark.schemas import VALID_FROM, VALID_TO
from tidemark.session import working_folder

# What goes to every task at most, in rows and in bytes, and versions of a key that are
# compared with each of its facts at most.
BROADCAST_VERSIONS = 1_000_000
BROADCAST_BYTES = 64 << 20
VERSIONS_PER_KEY = 64
# Keys with more versions that are told to every task.
BROADCAST_KEYS = 1_000_000


def _hours_covered(first_ts: Column, last_ts: Column) -> Column:
    """Hour numbers from one time to the other, none when the interval is empty."""
    first, last = hour_number(first_ts), hour_number(last_ts)
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _place(
    facts: DataFrame, versions: DataFrame, key: str, ts: str, rows_per_group: int | None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cut hot keys on both sides; also returns the columns to match, key included.

    Ordinary keys stay whole (hour 0, slot 0). A key that is heavy on either side
    is cut by the hour, its versions being repeated for each hour they cover between
    the first and the last fact of that key. An hour of such a key that is still
    heavy is split further, by a hash of the facts' rows, so that facts of one
    instant are spread as well; the versions are repeated for each split.

    Without heavy keys both sides come back as they are.
    """
    if rows_per_group is None:
        return facts, versions, [key]
    times = facts.select(key, F.col(ts).alias("_at")).unionAll(versions.select(key, "_opens"))
    heavy_keys = heavy_groups(times, [key], rows_per_group)
    if not heavy_keys:
        return facts, versions, [key]

    cut = F.col("_cut").isNotNull()
    of_heavy = heavy_keys.mark(facts.select(key, F.col(ts).alias("_at")), "_cut").where(cut)
    ranges = of_heavy.groupBy(F.col(key).alias("_key")).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last")
    )
    times = heavy_keys.mark(times, "_cut").where(cut)
    heavy_hours = heavy_groups(
        times.withColumn("_hour", hour_number(F.col("_at"))), [key, "_hour"], rows_per_group
    )
    spread_by = facts.columns
    facts = heavy_keys.mark(facts, "_cut").withColumn(
        "_hour", F.when(cut, hour_number(F.col(ts))).otherwise(0)
    )
    facts = heavy_hours.mark(facts, "_splits").withColumn("_slot", slot_of("_splits", spread_by))

    versions = heavy_keys.mark(versions, "_cut").join(
        heavy_keys.sized(ranges), cut & (F.col(key) == F.col("_key")), "left"
    )
    hours = F.when(
        F.col("_first").isNotNull(),
        _hours_covered(F.greatest("_opens", "_first"), F.least("_ends", "_last")),
    )
    versions = versions.withColumn(
        "_hour", F.explode(F.when(cut, hours).otherwise(F.array(F.lit(0))))
    ).drop("_key", "_first", "_last")
    versions = heavy_hours.mark(versions, "_splits").withColumn("_slot", all_slots("_splits"))
    return (
        facts.drop("_cut", "_splits"),
        versions.drop("_cut", "_splits"),
        [key, "_hour", "_slot"],
    )


def _size_of(versions: DataFrame) -> Column:
    text = [F.col(n) for n, kind in versions.dtypes if kind == "string"]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(8 * len(versions.columns)))
    return size.cast("bigint")


def _plan(versions: DataFrame, key: str) -> tuple[str, DataFrame | None]:
    """The plan for keys with few versions, and the keys that have many.

    One pass over the versions. A version counts with its text and 8 bytes a column.
    """
    per_key = versions.groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("n"), F.sum(_size_of(versions)).alias("size")
    )
    is_long = F.col("n") > VERSIONS_PER_KEY
    rows, size, long = per_key.agg(
        F.sum(F.when(~is_long, F.col("n"))), F.sum(F.when(~is_long, F.col("size"))), F.count_if(is_long)
    ).first()
    few = (rows or 0) <= BROADCAST_VERSIONS and (size or 0) <= BROADCAST_BYTES
    method = "broadcast" if few else "range"
    if not long:
        return method, None
    keys = per_key.where(is_long).select("_key", F.lit(True).alias("_long"))
    return method, F.broadcast(keys) if long <= BROADCAST_KEYS else keys


def _by_versions(
    facts: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    attributes: list[str],
    rows_per_group: int | None,
) -> DataFrame:
    """Each fact by the plan that suits its key: long histories as-of, the rest otherwise."""
    # The versions may be a long computation; they are read three times or more.
    path = f"{working_folder(right.sparkSession)}/versions"
    right.write.parquet(path)
    right = right.sparkSession.read.schema(right.schema).parquet(path)
    method, long = _plan(right, key)
    if long is None:
        return _join(facts, right, key, ts, attributes, method, rows_per_group)

    def parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = df.join(long, F.col(key) == F.col("_key"), "left").drop("_key")
        is_long = F.col("_long").isNotNull()
        return marked.where(is_long).drop("_long"), marked.where(~is_long).drop("_long")

    (long_facts, other_facts), (long_right, other_right) = parts(facts), parts(right)
    asof = _join(long_facts, long_right, key, ts, attributes, "asof", rows_per_group)
    rest = _join(other_facts, other_right, key, ts, attributes, method, rows_per_group)
    return asof.unionByName(rest)


def temporal_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    attributes: list[str],
    method: str = "auto",
    rows_per_group: int | None = ROWS_PER_GROUP,
) -> DataFrame:
    """Left join on ``key`` and ``valid_from <= ts < valid_to``.

    Versions of one key must not overlap; then every fact comes back exactly once,
    with NULL attributes where no version covers it. ``method`` picks the plan:

    * ``broadcast``: the facts stay where they are. More versions than BROADCAST_VERSIONS
      or BROADCAST_BYTES are joined by ``range`` instead.
    * ``range``: sort-merge join on the key, the interval as residual condition.
      For any number of keys with few versions each.
    * ``asof``: facts and versions are sorted together and the last version is
      carried forward, so the work is linear in facts plus versions.
    * ``auto``: writes the versions out, counts them by key, and joins the facts of keys
      with long histories by ``asof``, all others by ``broadcast`` or else ``range``.

    With ``range`` and ``asof`` the result stays partitioned by ``key``, unless hot
    keys had to be cut. ``rows_per_group=None`` leaves out the treatment of those.
    """
    if method not in ("auto", "broadcast", "range", "asof"):
        raise ValueError(f"unknown method: {method}")
    named = [F.col(name).alias(f"_v_{name}") for name in attributes]
    interval = F.col(VALID_FROM).alias("_opens"), F.col(VALID_TO).alias("_ends")
    right = versions.select(key, *interval, *named)
    if method == "auto":
        return _by_versions(facts, right, key, ts, attributes, rows_per_group)
    if method == "broadcast":
        # Every version counts here, those of long histories too.
        rows, size = right.agg(F.count("*"), F.sum(_size_of(right))).first()
        method = "broadcast" if rows <= BROADCAST_VERSIONS and (size or 0) <= BROADCAST_BYTES else "range"
    return _join(facts, right, key, ts, attributes, method, rows_per_group)


def _join(
    facts: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    attributes: list[str],
    method: str,
    rows_per_group: int | None,
) -> DataFrame:
    if method == "broadcast":
        left, right, place = facts, F.broadcast(right), [key]
    else:
        left, right, place = _place(facts, right, key, ts, rows_per_group)
    if method == "asof":
        return _carry_forward(left, right, facts.columns, place, ts, attributes)

    right = right.withColumnsRenamed({name: f"_m_{name}" for name in place})
    match = (F.col(ts) >= F.col("_opens")) & (F.col(ts) < F.col("_ends"))
    for name in place:
        match &= F.col(name) == F.col(f"_m_{name}")
    joined = left.join(right, match, "left")
    return joined.select(*facts.columns, *[F.col(f"_v_{n}").alias(n) for n in attributes])


def _carry_forward(
    left: DataFrame,
    right: DataFrame,
    columns: list[str],
    place: list[str],
    ts: str,
    attributes: list[str],
) -> DataFrame:
    # A struct, because a bare attribute that is NULL in the right version would
    # be skipped in favour of an older version's value.
    version = F.struct("_ends", *[f"_v_{name}" for name in attributes])
    starts = right.where(F.col("_opens") < F.col("_ends")).select(
        *place,
        F.col("_opens").alias(ts),
        version.alias("_version"),
        F.lit(0).alias("_is_fact"),
    )
    both = left.withColumn("_is_fact", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    earlier = (
        Window.partitionBy(*place)
        .orderBy(ts, "_is_fact")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = both.withColumn("_last", F.last("_version", ignorenulls=True).over(earlier)).where(
        "_is_fact = 1"
    )
    # The version may have ended before the fact, and NULL keys match nothing.
    covers = (F.col(ts) < F.col("_last._ends")) & F.col(place[0]).isNotNull()
    return filled.select(
        *columns, *[F.when(covers, F.col(f"_last._v_{name}")).alias(name) for name in attributes]
    )

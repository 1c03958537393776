"""Parties, addresses and invoices: what is new, what changed, which id it gets."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import BUCKETS, MEMBER_ROWS, SLICE_ROWS, fits_broadcast, hot_apart, lookup_join, member_join, spread_join


def unprocessed_only(feed: DataFrame, log: DataFrame, keys: Sequence[str], *, range_column: str | None = None) -> DataFrame:
    """Feed rows whose key is not in the log of processed keys. A NULL in the key never matches.

    ``range_column`` names a key column, such as a date, in which a feed covers a small part
    of the log: the log is then cut to the feed's range before it is shuffled, which also
    prunes the partitions and row groups of a log laid out by that column.
    """
    return spread_join(feed, _log_of_range(feed, log, range_column), keys, "left_anti")


def _log_of_range(feed: DataFrame, log: DataFrame, range_column: str | None) -> DataFrame:
    if range_column is None:
        return log
    low = feed.agg(F.min(range_column)).scalar()
    high = feed.agg(F.max(range_column)).scalar()
    return log.where((F.col(range_column) >= low) & (F.col(range_column) <= high))


def unprocessed_distinct(
    feed: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    made: Callable[[DataFrame], DataFrame],
    *,
    range_column: str | None = None,
    slice_rows: int = SLICE_ROWS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The distinct rows that ``made`` turns :func:`unprocessed_only` rows into, in one shuffle of the feed.

    ``made`` works row by row and keeps the keys. Equal rows have equal keys, so they meet where the
    join has placed them. Rows of hot keys only are dealt out for the join and shuffled once more.
    Reads the key columns of ``feed`` twice besides.
    """
    log = _log_of_range(feed, log, range_column).select(*keys).distinct()
    calm, hot = hot_apart(feed, keys, slice_rows=slice_rows, buckets=buckets)
    # shuffled also where the log is small: the rows are shuffled once either way, and sent to the feed it would put the scan,
    # the join and all that is made into one method, too long for the JVM to compile. The wide rows are not sorted for it: of
    # the log a task holds the keys of its part
    calm = calm.join(log.hint("shuffle_hash"), list(keys), "left_anti")
    hot = spread_join(hot, log, keys, "left_anti", slice_rows=slice_rows, buckets=buckets)
    return made(calm).distinct().unionByName(made(hot).distinct())


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    recency: Sequence[str],
    *,
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """One row per key: the most recent, then the one with fewer default or missing values.

    What still ties is settled by the values themselves, so the choice never depends on
    row order. The maximum is partially aggregated: a key with very many rows reaches the
    shuffle as one row per task.
    """
    defaults = defaults or {}
    filled = [F.col(v).isNotNull() & (F.col(v) != F.lit(defaults[v])) if v in defaults else F.col(v).isNotNull() for v in values]
    known = sum((F.coalesce(f, F.lit(False)).cast("int") for f in filled), F.lit(0)).alias("__known")
    best = F.max(F.struct(*recency, known, *values)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{v}").alias(v) for v in values])


def new_members(candidates: DataFrame, members: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Candidates, one row per key, whose key is not among the members."""
    keys = [key] if isinstance(key, str) else list(key)
    return candidates.join(members.select(*keys).distinct(), keys, "left_anti")


def changed_members(
    candidates: DataFrame,
    members: DataFrame,
    key: str | Sequence[str],
    attributes: Sequence[str],
    *,
    keep_known: Mapping[str, object] | None = None,
) -> DataFrame:
    """Candidates, one row per key, known under their key with another value in some attribute.

    NULL counts as a value: NULL against text is a change, NULL against NULL is none. With
    ``keep_known``, which maps attributes to their defaults, a missing or default value stands
    for what is known, so that it neither counts as a change nor erases anything.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = members.select(*keys, F.struct(*attributes).alias("__now"))
    offered = candidates.select(*keys, F.struct(*attributes).alias("__offer"))

    def offer(name: str) -> Column:
        new, now = F.col(f"__offer.{name}"), F.col(f"__now.{name}")
        if keep_known is None:
            return new
        missing = new.isNull()
        if name in keep_known:
            missing = missing | (new == F.lit(keep_known[name]))
        return F.when(missing & now.isNotNull(), now).otherwise(new)

    differs = F.lit(False)
    for name in attributes:
        differs = differs | ~F.col(f"__now.{name}").eqNullSafe(offer(name))
    # members are the left side: they may hold a key more than once, the candidates may not
    changed = spread_join(known, offered, keys).where(differs)
    return changed.select(*keys, *[offer(a).alias(a) for a in attributes]).distinct()


def row_digest(attributes: Sequence[str]) -> Column:
    """128 bits that tell rows with different ``attributes`` apart, NULL and text included; 16 bytes to be stored beside them."""
    return F.unhex(F.md5(F.to_json(F.struct(*attributes))))


def changed_by_digest(candidates: DataFrame, members: DataFrame, key: str | Sequence[str], attributes: Sequence[str], *, digest: str) -> DataFrame:
    """:func:`changed_members` on members that store ``digest``, their :func:`row_digest` of the same attributes.

    Of the members only keys and digests are read and shuffled, however wide they are; what a
    change consists of is taken from the candidates. Types of the attributes must be the same on
    both sides, as they were when the digest was made.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = members.select(*keys, F.col(digest).alias("__known"))
    offered = candidates.select(*keys, *attributes, row_digest(attributes).alias("__offered"))
    changed = spread_join(known, offered, keys).where(~F.col("__known").eqNullSafe(F.col("__offered")))
    return changed.select(*keys, *attributes).distinct()


def new_addresses(candidates: DataFrame, addresses: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidate addresses whose (party, postal code) is unknown."""
    return new_members(candidates, addresses, keys)


def changed_addresses(
    candidates: DataFrame,
    addresses: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    *,
    keep_known: Mapping[str, object] | None = None,
) -> DataFrame:
    """Candidate addresses whose (party, postal code) is known with another type, number or complement."""
    return changed_members(candidates, addresses, keys, attributes, keep_known=keep_known)


def resolve_party_address(
    rows: DataFrame, address_types: DataFrame, party_ids: DataFrame, *, type_column: str, party_key: str
) -> DataFrame:
    """Add the address type id (NULL where the type is unknown) and the party id (unknown parties drop out).

    ``address_types`` holds (``type_column``, id) and ``party_ids`` (``party_key``, id), one row per key.
    """
    typed = lookup_join(rows, address_types, type_column, "left")
    return member_join(typed, party_ids, party_key, "inner")


def build_invoice_fact(
    rows: DataFrame, party_ids: DataFrame, terms: DataFrame, *, party_key: str, term_column: str
) -> DataFrame:
    """Add party id and term id to feed rows; either is NULL where unknown. One row per key in both look-ups."""
    with_term = lookup_join(rows, terms, term_column, "left")
    return member_join(with_term, party_ids, party_key, "left")


def existing_facts_removed(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Distinct rows whose key is not among the facts."""
    return spread_join(rows.distinct(), facts, key, "left_anti")


def one_id_per_key(table: DataFrame, key: str | Sequence[str], id_column: str) -> DataFrame:
    """(key, id) with the lowest id where a key occurs more than once."""
    keys = [key] if isinstance(key, str) else list(key)
    return table.groupBy(*keys).agg(F.min(id_column).alias(id_column))


def ids_of_keys(table: DataFrame, wanted: DataFrame, key: str, id_column: str) -> DataFrame:
    """:func:`one_id_per_key` of the wanted keys only; ``wanted``: a stored frame with one row per key.

    Few keys go to the table and thin it out before anything of it is aggregated or shuffled;
    many meet what the aggregation leaves of it, on the partitioning that both already have.
    """
    keys = wanted.select(key)
    if fits_broadcast(keys, MEMBER_ROWS):
        return one_id_per_key(table.join(F.broadcast(keys), key, "left_semi"), key, id_column)
    return one_id_per_key(table, key, id_column).join(keys, key, "left_semi")


def merge_upsert(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str], *, insert: bool = True
) -> DataFrame:
    """The next version of ``target``: ``columns`` taken from ``changes`` where the key matches.

    ``changes`` must hold one row per key. With ``insert``, unmatched changes are added;
    target columns they do not have become NULL. A target of versions may repeat a key as often
    as it has versions of it. Write the result to a new place: it reads ``target``.
    """
    marked = changes.select(*keys, F.struct(*columns).alias("__new"), F.lit(True).alias("__hit"))
    # either side is read once: the outer join keeps target rows and brings in unmatched changes
    joined = target.join(marked, list(keys), "full") if insert else spread_join(target, marked, keys, "left")
    return joined.select(
        *[F.when(F.col("__hit"), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    )


def assign_surrogate_keys(
    rows: DataFrame,
    key: str | Sequence[str],
    id_column: str,
    *,
    ties: Sequence[str] = (),
    start_after: DataFrame | int = 0,
    spread: int = 3,
) -> DataFrame:
    """Give each row the next free id, densely, without a global sort.

    ``start_after`` is the last id in use, or the table (with ``id_column``) to take it
    from. ``rows`` must hold one row per key, or one per key and ``ties``; rows equal in those
    and in all else get distinct ids, whichever way round. Rows are numbered inside 16**``spread``
    groups (``spread`` from 1 to 4) by key digest, in key order, and each group starts where the groups before it
    end. The ids depend on the data alone, so a task that is run again assigns the same ones.
    """
    if not 1 <= spread <= 4:
        raise ValueError("spread must lie between 1 and 4: the groups' sizes are broadcast")
    keys = [key] if isinstance(key, str) else list(key)
    digest = F.md5(F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys]))
    grouped = rows.withColumn("__group", F.substring(digest, 1, spread))
    sizes = grouped.groupBy("__group").agg(F.count(F.lit(1)).alias("__size"))
    # at most 16**spread rows: small enough for one window and for a broadcast
    before = F.sum("__size").over(Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__group", F.coalesce(before, F.lit(0)).alias("__before"))
    if isinstance(start_after, int):
        last: Column = F.lit(start_after)
    else:
        last = F.coalesce(start_after.agg(F.max(id_column)).scalar(), F.lit(0))
    place = F.row_number().over(Window.partitionBy("__group").orderBy(*keys, *ties))
    numbered = grouped.withColumn("__place", place).join(F.broadcast(offsets), "__group")
    return numbered.select((last + F.col("__before") + F.col("__place")).cast("long").alias(id_column), *rows.columns)

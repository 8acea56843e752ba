"""Slowly changing dimensions and change application.

All functions are pure: (target, changes, keys, ...) -> new target. Nothing
unbounded is collected (only the capped hot-key table). Joins against the target are on the key only and always see at most
one change row per key (changes are reduced first by an aggregation that
combines map-side), so a hot key in the change feed cannot skew them. The
sequence-ordered work (dropping repeated values, closing intervals) goes through
``with_neighbors``, which splits hot keys into ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import fingerprint
from .sequence import RANGE_ROWS, range_cuts, with_neighbors

# Action labels and type labels written to ``_scd_action`` / ``_scd_type``.
INSERT, UPDATE, UNCHANGED = "INSERT", "UPDATE", "UNCHANGED"

# Order values of the last row seen of a key, kept on its open version (null on closed ones).
SEEN = "_scd_last_seen"


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols, F.lit(True))


def _same(left: str, right: str, cols) -> Column:
    return _all([F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols])


def _join_keys(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; the key columns of ``left`` stay."""
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    match = _all([F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_k_{k}" for k in keys])


def _pick(df: DataFrame, keys, order, fn) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = df.groupBy(*keys).agg(fn(F.struct(*order, *rest)).alias("_r"))
    return packed.select(*[F.col(k) for k in keys], *[F.col(f"_r.{c}").alias(c) for c in order + rest]).select(*df.columns)


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The last row per key by ``order``, remaining columns break ties.

    One aggregation of ``max(struct)``: partial results are combined on each
    mapper, so no key, however hot, is gathered into one task.
    """
    return _pick(df, keys, order, F.max)


def earliest_per_key(df: DataFrame, keys, order) -> DataFrame:
    return _pick(df, keys, order, F.min)


def scd0(target: DataFrame, changes: DataFrame, keys, order, batch_id: str) -> DataFrame:
    """Insert keys never seen (their first row); existing rows never change."""
    first = earliest_per_key(changes, keys, order)
    new = first.join(target.select(*keys), list(keys), "left_anti")
    new = new.withColumns({"_scd_type": F.lit("SCD0"), "_scd_action": F.lit(INSERT), "_scd_batch_id": F.lit(batch_id)})
    return target.unionByName(new.select(*target.columns))


def _overwrite(target: DataFrame, changes: DataFrame, keys, tracked, order, batch_id, scd_type: str | None) -> DataFrame:
    keys = list(keys)
    # Rows without a key cannot be matched or stored (the primary-key rule quarantines them);
    # filtering them here also makes both uses of ``latest`` one plan, so its shuffle is reused.
    keyed = changes.where(_all([F.col(k).isNotNull() for k in keys]))
    latest = latest_per_key(keyed, keys, order)
    business = [c for c in latest.columns]
    t, c = target.alias("t"), latest.alias("c")
    cond = _all([F.col(f"t.{k}") == F.col(f"c.{k}") for k in keys])
    hit = F.col(f"c.{keys[0]}").isNotNull()
    # An older row never replaces a newer one, whatever batch brings it.
    guard = [o for o in order if o in target.columns and o in business]
    newer = F.lit(True)
    if guard:
        newer = F.coalesce(F.struct(*[F.col(f"c.{o}") for o in guard]) >= F.struct(*[F.col(f"t.{o}") for o in guard]), F.lit(True))
    if tracked is None:
        changed = hit & newer
    else:
        changed = hit & newer & ~_same("t", "c", tracked)
    merged = t.join(c, cond, "left")
    cols = []
    for name in target.columns:
        if name in business and name not in keys:
            cols.append(F.when(changed, F.col(f"c.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
        elif name == "_scd_action" and scd_type:
            cols.append(F.when(changed, F.lit(UPDATE)).when(hit, F.lit(UNCHANGED)).otherwise(F.col("t._scd_action")).alias(name))
        elif name == "_scd_batch_id" and scd_type:
            cols.append(F.when(changed, F.lit(batch_id)).otherwise(F.col("t._scd_batch_id")).alias(name))
        else:
            cols.append(F.col(f"t.{name}").alias(name))
    updated = merged.select(*cols)
    new = latest.join(target.select(*keys), keys, "left_anti")
    if scd_type:
        new = new.withColumns({"_scd_type": F.lit(scd_type), "_scd_action": F.lit(INSERT), "_scd_batch_id": F.lit(batch_id)})
    return updated.unionByName(new.select(*target.columns))


def scd1(target: DataFrame, changes: DataFrame, keys, tracked, order, batch_id: str) -> DataFrame:
    """Overwrite with the latest value, no history; label INSERT / UPDATE / UNCHANGED."""
    return _overwrite(target, changes, keys, tracked, order, batch_id, "SCD1")


def upsert(target: DataFrame, changes: DataFrame, keys, order) -> DataFrame:
    """Insert new keys, replace existing ones by the latest change; no SCD metadata."""
    return _overwrite(target, changes, keys, None, order, None, None)


def action_label(df: DataFrame, keys) -> DataFrame:
    """UPSERT when the key is present, else INSERT."""
    present = _all([F.col(k).isNotNull() for k in keys])
    return df.withColumn("_scd_action", F.when(present, F.lit("UPSERT")).otherwise(F.lit(INSERT)))


def append(target: DataFrame, changes: DataFrame, dedup_keys=None, batch_id: str | None = None, order=()) -> DataFrame:
    """Insert only. With ``dedup_keys`` (an overlapping look-back read) rows whose key is already in
    the target are skipped, and of rows repeated within the batch the last by ``order`` is taken."""
    new = changes
    if dedup_keys:
        dedup_keys = list(dedup_keys)
        new = latest_per_key(new, dedup_keys, order).join(target.select(*dedup_keys), dedup_keys, "left_anti")
    if batch_id is not None and "_scd_batch_id" in target.columns:
        new = new.withColumns({"_scd_type": F.lit("APPEND"), "_scd_action": F.lit(INSERT), "_scd_batch_id": F.lit(batch_id)})
    return target.unionByName(new.select(*target.columns))


def scd2_history(changes: DataFrame, keys, tracked, order, range_rows: int = RANGE_ROWS, tie=()) -> DataFrame:
    """C4: versions with [effective, end) intervals from a full change log.

    A row opens a version when its tracked values differ (NULL-safe) from the
    previous row of its key; the version ends where the next version starts.
    Adds _scd_effective_date, _scd_end_date, _scd_is_current, _scd_hash and
    _scd_action (INSERT for the first version of a key, UPDATE for later ones).
    ``tie`` names columns that order rows equal in all of this.
    """
    keys, tracked, order = list(keys), list(tracked), list(order)
    total = order + [c for c in tracked if c not in order] + list(tie)
    base = changes.columns
    lead = order[0]
    # The same ranges serve both passes: kept rows are a subset of all rows.
    cuts = range_cuts(changes, keys, total, range_rows)
    step = with_neighbors(changes, keys, total, prev_cols=tracked, cuts=cuts)
    differs = ~_all([F.col(f"_prev_{c}").eqNullSafe(F.col(c)) for c in tracked])
    kept = step.where(F.col("_is_first") | differs).select(*base)
    closed = with_neighbors(kept, keys, total, next_cols=[lead], cuts=cuts)
    return closed.select(
        *base,
        F.col(lead).cast("timestamp_ntz").alias("_scd_effective_date"),
        F.col(f"_next_{lead}").cast("timestamp_ntz").alias("_scd_end_date"),
        F.col("_is_last").alias("_scd_is_current"),
        fingerprint(tracked).alias("_scd_hash"),
        F.when(F.col("_is_first"), F.lit(INSERT)).otherwise(F.lit(UPDATE)).alias("_scd_action"),
    )


def unseen(target: DataFrame, batch: DataFrame, keys, tracked, order) -> DataFrame:
    """The rows of the batch that say something new: a row inside the span of its key's open version
    (from its start to the last row seen) with the same tracked values is a repeat, as a look-back
    reads again, and changes nothing."""
    keys, order = list(keys), list(order)

    def seq():
        return F.struct(*[F.col(c) for c in order])

    open_rows = target.where(F.col("_scd_is_current")).select(
        *keys, seq().alias("_from"), F.coalesce(F.col(SEEN), seq()).alias("_to"), F.struct(*tracked).alias("_values")
    )
    repeat = seq().between(F.col("_from"), F.col("_to")) & _all([F.col(c).eqNullSafe(F.col(f"_values.{c}")) for c in tracked])
    return _join_keys(batch, open_rows, keys, "left").where(~F.coalesce(repeat, F.lit(False))).select(*batch.columns)


def with_seen(target: DataFrame, order) -> DataFrame:
    """``target`` with the last-seen column, null where an older table has none."""
    if SEEN in target.columns:
        return target
    return target.withColumn(SEEN, F.lit(None).cast(target.select(F.struct(*order)).schema[0].dataType))


def batch_flags(target: DataFrame, batch: DataFrame, keys, order) -> DataFrame:
    """Per key of the batch: ``_in_batch`` and ``_late`` (a batch row at or before the last row seen).

    One aggregation of the batch (combined map-side) joined with the open versions."""
    keys, order = list(keys), list(order)

    def seq():
        return F.struct(*[F.col(c) for c in order])

    first_new = batch.groupBy(*keys).agg(F.min(seq()).alias("_first_seq"), F.count(F.lit(1)).alias("_n"))
    open_seq = target.where(F.col("_scd_is_current")).select(*keys, F.coalesce(F.col(SEEN), seq()).alias("_cur_seq"))
    return _join_keys(first_new, open_seq, keys, "left").select(
        *keys,
        F.lit(True).alias("_in_batch"),
        F.coalesce(F.col("_first_seq") <= F.col("_cur_seq"), F.lit(False)).alias("_late"),
        "_n",
    )


def seen_rows(target: DataFrame, flags: DataFrame, batch: DataFrame, keys, order, log: DataFrame | None) -> DataFrame:
    """``batch`` plus what the versions of its late keys no longer show: the rows of ``log`` (all rows
    ever loaded), or without a log the last row seen of the open version."""
    late = flags.where(F.col("_late")).select(*keys)
    if log is not None:
        return batch.unionByName(_join_keys(log.select(*batch.columns), late, keys, "left_semi"))
    last = _join_keys(target.where(F.col("_scd_is_current") & F.col(SEEN).isNotNull()), late, keys, "left_semi")
    return batch.unionByName(last.select(*[F.col(f"{SEEN}.{c}").alias(c) if c in order else F.col(c) for c in batch.columns]))


def reopen(target: DataFrame, flags: DataFrame, batch: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Split the target into rows kept as they are and the change log to rebuild:
    the open versions of batch keys and every version of late keys, plus the batch."""
    keys = [c for c in flags.columns if c not in ("_in_batch", "_late", "_n")]
    tagged = _join_keys(target, flags, keys, "left")
    again = F.coalesce(F.col("_late") | (F.col("_in_batch") & F.col("_scd_is_current")), F.lit(False))
    keep = tagged.where(~again).select(*target.columns)
    business = list(batch.columns)
    # A stored label stays unless the key's whole history is rebuilt (late rows).
    stored = F.when(~F.coalesce(F.col("_late"), F.lit(False)), F.col("_scd_action"))
    log = tagged.where(again).select(*business, "_scd_batch_id", stored.alias("_stored_action"), F.lit(0).alias("_src"))
    log = log.unionByName(
        batch.select(
            *business,
            F.lit(batch_id).alias("_scd_batch_id"),
            F.lit(None).cast("string").alias("_stored_action"),
            F.lit(1).alias("_src"),
        )
    )
    return keep, log


def relabel(rebuilt: DataFrame) -> DataFrame:
    """Keep the stored action of re-examined open versions; new versions get the computed one."""
    return rebuilt.withColumn("_scd_action", F.coalesce(F.col("_stored_action"), F.col("_scd_action"))).drop(
        "_stored_action", "_src"
    )


def scd2_merge(
    target: DataFrame,
    batch: DataFrame,
    keys,
    tracked,
    order,
    batch_id: str,
    range_rows: int = RANGE_ROWS,
    log: DataFrame | None = None,
    flags: DataFrame | None = None,
    any_late: bool = True,
) -> DataFrame:
    """Merge one batch into an SCD2 table.

    Only the open version of a key in the batch is re-examined: together with
    the batch rows it is rebuilt by ``scd2_history``, which closes a changed
    row and inserts the new version in the same pass, and drops repeats. Closed
    versions stay as they are. Batch rows that only repeat the open version are
    left out first (``unseen``). A key whose other batch rows reach back to or
    before the last row seen of it (``_scd_last_seen``) has its whole history
    rebuilt, so the late row lands in its place: from its versions and ``log``,
    the rows loaded so far, which makes the result equal the history of the
    whole log; without ``log``, repeats other than the last one seen are not
    known. NULL keys are one key. A caller that has left out repeats and
    computed ``flags`` passes them, with ``any_late`` False when no key is late.
    The per-key flags come
    from one aggregation of the batch joined with the open versions, and the
    target meets them in one join, which AQE can turn into a broadcast when the
    batch is small. A version keeps the batch id of the row that opened it.
    """
    keys, order = list(keys), list(order)
    target = with_seen(target, order)
    if flags is None:
        batch = unseen(target, batch, keys, tracked, order)
        flags = batch_flags(target, batch, keys, order)
    if any_late:
        batch = seen_rows(target, flags, batch, keys, order, log)
    keep, changes = reopen(target, flags, batch, batch_id)
    rebuilt = relabel(scd2_history(changes, keys, tracked, order + ["_src"], range_rows=range_rows))
    last = changes.groupBy(*keys).agg(F.max(F.struct(*order)).alias(SEEN))
    rebuilt = _join_keys(rebuilt, last, keys, "left").withColumn(SEEN, F.when(F.col("_scd_is_current"), F.col(SEEN)))
    return keep.unionByName(rebuilt.select(*target.columns))


def empty_scd2(changes: DataFrame) -> DataFrame:
    """An empty SCD2 table with the columns ``scd2_merge`` writes."""
    return changes.limit(0).select(
        *changes.columns,
        F.lit(None).cast("string").alias("_scd_batch_id"),
        F.lit(None).cast("timestamp_ntz").alias("_scd_effective_date"),
        F.lit(None).cast("timestamp_ntz").alias("_scd_end_date"),
        F.lit(None).cast("boolean").alias("_scd_is_current"),
        F.lit(None).cast("string").alias("_scd_hash"),
        F.lit(None).cast("string").alias("_scd_action"),
    )


def current(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.where(F.col("_scd_is_current"))


def as_of(history: DataFrame, when) -> DataFrame:
    """Versions valid at ``when``: effective <= when < end (open end = now)."""
    ts = F.lit(when).cast("timestamp_ntz") if not isinstance(when, Column) else when
    return history.where((F.col("_scd_effective_date") <= ts) & (F.col("_scd_end_date").isNull() | (ts < F.col("_scd_end_date"))))


def scd3(target: DataFrame | None, changes: DataFrame, keys, tracked, order, batch_id: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Current value plus ``{c}_previous`` and ``{c}_change_date`` per tracked column.

    The stored row is the latest known state of its key; batch rows are applied
    after it in sequence order (rows not newer than the stored state are
    ignored). A column's previous value and change date come from its last
    change; a column that did not change keeps what was stored.
    """
    keys, tracked, order = list(keys), list(tracked), list(order)
    business = list(changes.columns)
    extra = [n for c in tracked for n in (f"{c}_previous", f"{c}_change_date")]
    lead = order[0]
    if target is None:
        target = changes.limit(0).select(
            *business,
            *[F.lit(None).cast(changes.schema[c].dataType).alias(f"{c}_previous") for c in tracked],
            *[F.lit(None).cast("timestamp_ntz").alias(f"{c}_change_date") for c in tracked],
            F.lit(None).cast("string").alias("_scd_batch_id"),
        )
    for c in tracked:  # columns that came after the table
        if f"{c}_previous" not in target.columns:
            target = target.withColumns({f"{c}_previous": F.lit(None).cast(changes.schema[c].dataType), f"{c}_change_date": F.lit(None).cast("timestamp_ntz")})
    seq = F.struct(*[F.col(c) for c in order])
    stored = target.select(*keys, seq.alias("_stored_seq"))
    newer = batch_rows = changes.join(stored, keys, "left").where(
        F.col("_stored_seq").isNull() | (F.struct(*[F.col(c) for c in order]) > F.col("_stored_seq"))
    ).drop("_stored_seq")
    touched = target.join(newer.select(*keys), keys, "left_semi")
    log = touched.select(*business, *extra, F.lit(0).alias("_src")).unionByName(
        batch_rows.select(*business, *[F.lit(None).cast(target.schema[n].dataType).alias(n) for n in extra], F.lit(1).alias("_src"))
    )
    total = [lead, "_src"] + [c for c in order[1:]] + [c for c in tracked if c not in order]
    step = with_neighbors(log, keys, total, prev_cols=tracked, range_rows=range_rows)
    aggs = [F.max(F.struct(*[F.col(c) for c in total], *[F.col(c) for c in business if c not in total])).alias("_last")]
    for c in tracked:
        change = (~F.col("_is_first")) & ~F.col(f"_prev_{c}").eqNullSafe(F.col(c))
        aggs.append(F.max(F.when(change, F.struct(*[F.col(x) for x in total], F.col(f"_prev_{c}").alias("p"), F.col(lead).cast("timestamp_ntz").alias("d")))).alias(f"_chg_{c}"))
        aggs.append(F.max(F.when(F.col("_src") == 0, F.struct(F.col(f"{c}_previous").alias("p"), F.col(f"{c}_change_date").alias("d")))).alias(f"_old_{c}"))
    folded = step.groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys] + [F.col(f"_last.{c}").alias(c) for c in business if c not in keys]
    for c in tracked:
        out.append(F.when(F.col(f"_chg_{c}").isNotNull(), F.col(f"_chg_{c}.p")).otherwise(F.col(f"_old_{c}.p")).alias(f"{c}_previous"))
        out.append(F.when(F.col(f"_chg_{c}").isNotNull(), F.col(f"_chg_{c}.d")).otherwise(F.col(f"_old_{c}.d")).alias(f"{c}_change_date"))
    out.append(F.lit(batch_id).alias("_scd_batch_id"))
    rebuilt = folded.select(*out)
    untouched = target.join(newer.select(*keys), keys, "left_anti")
    return untouched.unionByName(rebuilt.select(*target.columns))


def apply_scd(target: DataFrame | None, changes: DataFrame, table, batch_id: str) -> DataFrame:
    """Route one batch by the table's ``scd_type`` (default APPEND), as the config promises.

    ``table`` is a TableSpec: primary_key, scd_columns (tracked; default every
    non-key column that does not start with ``_``) and sequence_by (default the
    ingestion timestamp).
    """
    from .enrich import tracked_columns

    keys = list(table.primary_key)
    order = list(table.sequence_by) or ["_ingestion_timestamp"]
    tracked = list(table.scd_columns) if table.scd_columns else tracked_columns(changes, keys, exclude=order)
    kind = table.scd_type
    if kind == "SCD2":
        base = target if target is not None else empty_scd2(changes)
        return scd2_merge(base, changes, keys, tracked, order, batch_id)
    if kind == "SCD3":
        return scd3(target, changes, keys, tracked, order, batch_id)
    meta = {"_scd_type": F.lit(kind), "_scd_action": F.lit(INSERT), "_scd_batch_id": F.lit(batch_id)}
    if target is None:
        target = changes.limit(0).withColumns({k: v.cast("string") for k, v in meta.items()})
        if kind == "UPSERT":
            target = changes.limit(0)
    if kind == "SCD0":
        return scd0(target, changes, keys, order, batch_id)
    if kind == "SCD1":
        return scd1(target, changes, keys, tracked, order, batch_id)
    if kind == "UPSERT":
        return upsert(target, changes, keys, order)
    if kind == "APPEND":
        return append(target, changes, dedup_keys=keys if table.watermark_seconds else None, batch_id=batch_id, order=order)
    raise ValueError(f"unknown SCD type {kind!r}")


def as_of_join(facts: DataFrame, history: DataFrame, keys, fact_time: str, version_cols, version_order, range_rows: int = RANGE_ROWS) -> DataFrame:
    """C9 joined to facts: each fact row with the version of its key valid at ``fact_time``
    (effective <= t < end), NULL when none.

    Not a range join: facts and version starts are merged into one ordered
    stream per key and each fact takes the last version started at or before
    it (``fill_forward``), so no key ever pairs all its facts with all its
    versions. Versions sort before facts at the same instant, and among
    versions starting together the last in ``version_order`` wins, which is the
    one whose interval is not empty.
    """
    from .sequence import fill_forward

    keys = list(keys)
    vcols = list(version_cols)
    fact_cols = [c for c in facts.columns if c not in keys]
    tb = F.struct(*[F.col(c) for c in version_order])
    v = history.select(
        *keys,
        F.col("_scd_effective_date").cast("timestamp_ntz").alias("_t"),
        F.lit(0).alias("_kind"),
        tb.alias("_tb"),
        F.struct(*[F.col(c) for c in vcols]).alias("_v"),
        F.lit(None).cast(facts.select(F.struct(*fact_cols)).schema[0].dataType).alias("_f"),
    )
    f = facts.select(
        *keys,
        F.col(fact_time).cast("timestamp_ntz").alias("_t"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(history.select(tb).schema[0].dataType).alias("_tb"),
        F.lit(None).cast(history.select(F.struct(*[F.col(c) for c in vcols])).schema[0].dataType).alias("_v"),
        F.struct(*[F.col(c) for c in fact_cols]).alias("_f"),
    )
    stream = v.unionByName(f)
    filled = fill_forward(stream, keys, ["_t", "_kind", "_tb"], "_v", range_rows=range_rows)
    return filled.where(F.col("_kind") == 1).select(
        *keys, *[F.col(f"_f.{c}").alias(c) for c in fact_cols], *[F.col(f"_filled.{c}").alias(c) for c in vcols]
    )


def new_rows(target: DataFrame | None, changes: DataFrame, table) -> DataFrame:
    """Only the rows an APPEND or SCD0 load adds (for append-only layer tables).

    APPEND with a look-back buffer (``watermark_seconds``) skips keys already
    stored or repeated in the batch; SCD0 adds the first row of each new key."""
    keys = list(table.primary_key)
    order = list(table.sequence_by) or ["_ingestion_timestamp"]
    if table.scd_type == "SCD0":
        rows = earliest_per_key(changes, keys, order)
    elif table.watermark_seconds:
        rows = latest_per_key(changes, keys, order)
    else:
        return changes
    if target is None:
        return rows
    return rows.join(target.select(*keys), keys, "left_anti")

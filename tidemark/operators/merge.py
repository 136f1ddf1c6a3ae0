"""Change-data merge: classify feed winners against the target, build the next
state, count the changes.

One full outer join on the primary key carries everything: each output row has
the key, ``_t`` (the target row's other columns, NULL when the key is new),
``_s`` (the winning feed row, NULL when the feed does not touch the key) and
``_action``:

=============  ==================================================  ===========
action         when                                                next state
=============  ==================================================  ===========
keep           key not in the feed                                  target row
insert         A/O, key not in target                               feed row
update         A/O, key in target, a compared column differs        feed row over target row
unchanged      A/O, key in target, nothing differs                  target row
delete         D, key in target                                     (gone)
no_match       D, key not in target                                 (gone)
ignored        any other flag                                       target row if any
reinsert       bulk mode: D and A/O for one key (delete first)      feed row alone
stale          older than the stored version column (optional)     target row
rejected       NULL key (counted merges only)                      (nothing)
=============  ==================================================  ===========

Compared columns are the target columns the feed carries, key excluded, plus
``flag`` when the target stores it.  Columns absent from the feed keep the
target's value on update and are NULL on insert (decided by *presence*, so a
present NULL overwrites).

The key is unique on both sides (target by definition, winners by
``keep_last``), so the join has no hot keys.  A full outer join always shuffles both
sides; a merge into a stored snapshot therefore reads only the target rows that the
feed's keys hit (a semi join, which Spark broadcasts when the feed is small) and
joins those from the feed's side (``how="right_outer"``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.normalize import qcol
from tidemark.operators.quality import has_null_key
from tidemark.spec import FLAG_DELETE, UPSERT_FLAGS, TableSpec

ACTIONS = ("keep", "insert", "update", "unchanged", "delete", "no_match", "ignored", "reinsert", "stale",
           "rejected")
_STATE_ACTIONS = ("keep", "insert", "update", "unchanged", "reinsert")


@dataclass
class MergeInput:
    """A conformed feed and what it carries."""

    feed: DataFrame            # typed rows: present target columns, flag, pos (+ _bad)
    spec: TableSpec
    present: list[str]         # target columns the feed carries (flag handled separately)

    @property
    def keys(self) -> list[str]:
        return list(self.spec.pk)

    @property
    def written(self) -> list[str]:
        """Non-key target columns the merge writes (flag included when the target stores it)."""
        cols = [c for c in self.spec.columns if c in self.present and c not in self.spec.pk and c != "flag"]
        if self.spec.has_flag:
            cols.append("flag")
        return cols


def winners(mi: MergeInput, ignore_unknown_flags_first: bool = False) -> DataFrame:
    """Reject NULL keys, then keep the last row per key (all flags compete, so a
    last row with an unknown flag hides an earlier good one, unless
    ``ignore_unknown_flags_first``).

    NULL-key rows are grouped like any other key (collapsed map-side) and their
    groups dropped after the aggregation, through an aggregate column: a filter
    on the key before it would be pushed into the conversion projections by
    inlining them."""
    f = mi.feed
    rest = [c for c in f.columns if c not in mi.keys and c != "_bad"]
    order = F.col("pos")
    if ignore_unknown_flags_first:
        order = F.when(F.col("flag").isin(FLAG_DELETE, *UPSERT_FLAGS), order)
    agg = (f.groupBy(*[qcol(k) for k in mi.keys])
             .agg(F.max_by(F.struct(*[qcol(c) for c in rest]), order).alias("_w"),
                  F.max(has_null_key(mi.keys)).alias("_nk")))
    agg = agg.where(~F.col("_nk") & F.col("_w").isNotNull())
    return agg.select(*[qcol(k) for k in mi.keys], *[F.col("_w").getField(c).alias(c) for c in rest])


def _feed_counts(f: DataFrame) -> list[Column]:
    bad = (F.size("_bad") > 0) if "_bad" in f.columns else F.lit(False)
    return [F.count(F.lit(1)).alias("_n"), F.count_if(bad).alias("_nbad"),
            F.count_if(F.col("flag").isin(*UPSERT_FLAGS)).alias("_nao")]


def counted_winners(mi: MergeInput, ignore_unknown_flags_first: bool = False) -> DataFrame:
    """:func:`winners` plus per-key feed counts, in the same aggregation.

    NULL keys are not filtered first: they form their own groups (collapsed
    map-side like any hot key) and are classified ``rejected``.  Each winner
    carries ``_n`` (rows of its key), ``_nbad`` (rows with values the declared
    types cannot store) and ``_nao`` (A/O rows), so the feed's totals can be
    summed in the final stage of the merge instead of in a separate pass."""
    f = mi.feed
    rest = [c for c in f.columns if c not in mi.keys and c != "_bad"]
    order = F.col("pos")
    if ignore_unknown_flags_first:
        order = F.when(F.col("flag").isin(FLAG_DELETE, *UPSERT_FLAGS), order)
    agg = (f.groupBy(*[qcol(k) for k in mi.keys])
             .agg(F.max_by(F.struct(*[qcol(c) for c in rest]), order).alias("_w"), *_feed_counts(f)))
    return agg.select(*[qcol(k) for k in mi.keys], *[F.col("_w").getField(c).alias(c) for c in rest],
                      "_n", "_nbad", "_nao")


def bulk_winners(mi: MergeInput, counted: bool = False) -> DataFrame:
    """Bulk-load semantics: deletes first, then one A/O row per key (the last by
    position).  No keep-last over all flags.  Output: key, feed columns of the A/O
    winner (NULL when none), flag ('A'/'O' of the winner, else 'D'), pos, ``_has_d``."""
    f = mi.feed
    if not counted:
        f = f.where(~has_null_key(mi.keys))
    rest = [c for c in f.columns if c not in mi.keys and c != "_bad"]
    is_ao = F.col("flag").isin(*UPSERT_FLAGS)
    extra = _feed_counts(f) if counted else []
    agg = (f.groupBy(*[qcol(k) for k in mi.keys])
             .agg(F.max_by(F.struct(*[qcol(c) for c in rest]), F.when(is_ao, F.col("pos"))).alias("_w"),
                  F.max(F.col("flag") == FLAG_DELETE).alias("_has_d"), *extra))
    if not counted:
        agg = agg.where(F.col("_w").isNotNull() | F.col("_has_d"))
    cols = [qcol(k) for k in mi.keys]
    for c in rest:
        if c == "flag":
            cols.append(F.when(F.col("_w").isNotNull(), F.col("_w.flag")).otherwise(F.lit(FLAG_DELETE)).alias("flag"))
        else:
            cols.append(F.col("_w").getField(c).alias(c))
    return agg.select(*cols, F.col("_has_d"), *([F.col("_n"), F.col("_nbad"), F.col("_nao")] if counted else []))


def classify(target: DataFrame, won: DataFrame, mi: MergeInput, change_test: bool = True,
             bulk: bool = False, newer_than: str | None = None, counted: bool = False,
             how: str = "full_outer") -> DataFrame:
    """Join target x winners on the key -> key, ``_t``, ``_s``, ``_action``.  With
    ``how="right_outer"`` only the feed's keys come out (no ``keep`` rows).

    ``newer_than`` names a version column (e.g. an event id) stored in the target:
    a feed row whose value is lower than the stored one is ``stale`` and leaves
    the target row as it is.  This makes the result independent of the order in
    which files or micro-batches arrive."""
    keys = mi.keys
    t_cols = [c for c in mi.spec.columns if c not in keys]
    s_cols = ([c for c in mi.written if c != "flag"] + ["flag", "pos"] + (["_has_d"] if bulk else [])
              + (["_n", "_nbad", "_nao"] if counted else []))
    t = target.select(*[qcol(k) for k in keys], F.struct(*[qcol(c) for c in t_cols]).alias("_t"))
    s = won.select(*[qcol(k) for k in keys], F.struct(*[qcol(c) for c in s_cols]).alias("_s"))
    j = t.join(s, keys, how)
    st, ss = F.col("_t"), F.col("_s")
    flag = ss.getField("flag")
    cmp = mi.written
    if cmp and change_test:
        changed = ~F.struct(*[ss.getField(c).alias(c) for c in cmp]).eqNullSafe(
            F.struct(*[st.getField(c).alias(c) for c in cmp]))
    elif cmp:
        changed = F.lit(True)
    else:
        changed = F.lit(False)
    upsert = (F.when(st.isNull(), "insert").when(changed, "update").otherwise("unchanged"))
    if bulk:
        has_d = ss.getField("_has_d")
        upsert = F.when(has_d & st.isNotNull(), "reinsert").otherwise(upsert)
        upsert_cond = flag.isin(*UPSERT_FLAGS)
    else:
        upsert_cond = flag.isin(*UPSERT_FLAGS)
    action = F.when(ss.isNull(), "keep")
    if counted:
        action = action.when(has_null_key(keys), "rejected")
    if newer_than is not None:
        action = action.when(st.isNotNull() & (ss.getField(newer_than) < st.getField(newer_than)), "stale")
    action = (action
              .when(flag == FLAG_DELETE, F.when(st.isNotNull(), "delete").otherwise("no_match"))
              .when(upsert_cond, upsert)
              .otherwise("ignored"))
    return j.withColumn("_action", action)


def _state_columns(mi: MergeInput) -> list[Column]:
    """A row as it stands after the merge, in target column order."""
    a, st, ss = F.col("_action"), F.col("_t"), F.col("_s")
    written = set(mi.written)
    cols = []
    for c in mi.spec.columns:
        if c in mi.keys:
            cols.append(qcol(c))
        elif c in written:
            cols.append(F.when(a.isin("insert", "update", "reinsert"), ss.getField(c)).otherwise(st.getField(c)).alias(c))
        else:
            cols.append(F.when(a == "reinsert", F.lit(None)).otherwise(st.getField(c)).cast(mi.spec.dtype(c)).alias(c))
    return cols


def next_state(classified: DataFrame, mi: MergeInput) -> DataFrame:
    """The target after the merge, in target column order."""
    a = F.col("_action")
    keep = a.isin(*_STATE_ACTIONS) | (a.isin("ignored", "stale") & F.col("_t").isNotNull())
    return classified.where(keep).select(*_state_columns(mi))


def change_rows(classified: DataFrame, mi: MergeInput) -> DataFrame:
    """What the merge changes: rows inserted or updated as they stand afterwards, and
    the deleted rows, marked ``_gone``."""
    a = F.col("_action")
    changed = classified.where(a.isin("insert", "update", "reinsert", "delete"))
    return changed.select(*_state_columns(mi), (a == "delete").alias("_gone"))


def deleted_keys(target: DataFrame, won: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the target that the feed's last row deletes."""
    dead = won.where(F.col("flag") == FLAG_DELETE).select(*[qcol(k) for k in keys])
    return target.select(*[qcol(k) for k in keys]).join(dead, keys, "left_semi")


def changes(classified: DataFrame, mi: MergeInput) -> DataFrame:
    """Feed winners with their action: key, written columns, flag, pos, action."""
    ss = F.col("_s")
    cols = [qcol(k) for k in mi.keys] + [ss.getField(c).alias(c) for c in mi.written if c != "flag"]
    return (classified.where(ss.isNotNull())
            .select(*cols, ss.getField("flag").alias("flag"), ss.getField("pos").alias("pos"),
                    F.col("_action").alias("action")))


def count_columns(action: Column) -> list[Column]:
    return [
        F.count_if(action == "insert").alias("inserted"),
        F.count_if(action == "update").alias("updated"),
        F.count_if(action == "delete").alias("deleted"),
        F.count_if(action == "unchanged").alias("unchanged"),
        F.count_if(action == "no_match").alias("unmatched_deletes"),
        F.count_if(action == "ignored").alias("unknown_flags"),
        F.count_if(action == "stale").alias("stale"),
    ]


def change_summary(classified: DataFrame) -> DataFrame:
    """One row: received, inserted, updated, deleted, unchanged, rejected, and the
    decomposition rejected = null_pk + duplicates + unmatched_deletes + unknown_flags.

    ``classified`` comes from a counted merge: each winner carries the number of feed
    rows of its key, so the feed is read once."""
    agg = classified.agg(*feed_totals(), *count_columns(F.col("_action")))
    processed = F.col("inserted") + F.col("updated") + F.col("deleted") + F.col("unchanged")
    return agg.select(
        "received", "inserted", "updated", "deleted", "unchanged",
        (F.col("received") - processed).alias("rejected"),
        "null_pk",
        (F.col("received") - F.col("null_pk") - F.col("winners")).alias("duplicates"),
        "unmatched_deletes", "unknown_flags",
    )


def bulk_summary(mi: MergeInput) -> DataFrame:
    """Bulk-load counts are candidates: rows flagged D (key not NULL) and rows
    flagged A/O; ``null_key_upserts`` > 0 means the load fails (key columns are
    NOT NULL in the target)."""
    f, nk = F.col("flag"), has_null_key(mi.keys)
    return mi.feed.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(f.isin(*UPSERT_FLAGS)).alias("upserted"),
        F.count_if((f == FLAG_DELETE) & ~nk).alias("deleted"),
        F.count_if(f.isin(*UPSERT_FLAGS) & nk).alias("null_key_upserts"),
        F.count_if(F.size("_bad") > 0).alias("bad_rows"),
    ).select("received", "upserted", "deleted", (F.col("upserted") + F.col("deleted")).alias("rows_loaded"),
             "null_key_upserts", "bad_rows")


def merge(target: DataFrame, mi: MergeInput, mode: str = "api", change_test: bool = True,
          ignore_unknown_flags_first: bool = False, newer_than: str | None = None,
          counted: bool = False, how: str = "full_outer") -> DataFrame:
    """Classified rows for ``mode`` in (api, bulk).  With ``counted`` the feed's
    row counts ride along (see :func:`counted_winners`, :func:`feed_totals`)."""
    if mode == "bulk":
        return classify(target, bulk_winners(mi, counted), mi, change_test, bulk=True, newer_than=newer_than,
                        counted=counted, how=how)
    if mode != "api":
        raise ValueError("mode must be 'api' or 'bulk'")
    won = counted_winners(mi, ignore_unknown_flags_first) if counted else winners(mi, ignore_unknown_flags_first)
    return classify(target, won, mi, change_test, newer_than=newer_than, counted=counted, how=how)


def winner_totals(keys: list[str]) -> list[Column]:
    """Aggregates over counted winners: feed rows received, rows with unstorable values,
    rows with a NULL key, A/O rows with a NULL key."""
    nk = has_null_key(keys)
    z = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.sum("_n"), z).alias("received"),
        F.coalesce(F.sum("_nbad"), z).alias("bad_rows"),
        F.coalesce(F.sum(F.when(nk, F.col("_n"))), z).alias("null_pk"),
        F.coalesce(F.sum(F.when(nk, F.col("_nao"))), z).alias("null_key_upserts"),
    ]


def feed_totals() -> list[Column]:
    """The same over counted classified rows."""
    ss, a = F.col("_s"), F.col("_action")
    z = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.sum(ss.getField("_n")), z).alias("received"),
        F.coalesce(F.sum(F.when(a == "rejected", ss.getField("_n"))), z).alias("null_pk"),
        F.count_if(ss.isNotNull() & (a != "rejected")).alias("winners"),
    ]

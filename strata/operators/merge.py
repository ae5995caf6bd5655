"""History merge (SCD type 2) of an ADD batch and a CHANGE batch.

Semantics, in statement order, each step seeing the previous one's result:

1. ADD rows whose key has *no* history row at all (open or closed) are
   inserted as open versions.  Duplicates inside ADD are all inserted; a null
   in any key never matches, so such rows always insert.
2. Every open row that has a CHANGE row of the same key (plain ``=`` on the
   keys) differing in some value column is closed on ``as_of``.  A value
   difference is ``c.v <> m.v`` (three-valued: null vs value is *not* a
   difference) unless ``null_safe=True``.
3. ``CHANGE EXCEPT open rows`` (distinct, nulls equal, value columns) is
   inserted as open versions.

Plan shape (no shuffle of history when the batches are small):

    ADD:    keys(ADD) --measured broadcast--> semi-filter keys(history)
            -> distinct keys present -> ADD anti those keys
    close:  one pass over the versions flags each open row that closes, by a
            LEFT JOIN with one row per CHANGE key: the CHANGE rows themselves
            if they are few per key (measured), else a summary (least and
            greatest value per column).  Closed, closing and staying versions
            leave in that same pass
    insert: CHANGE EXCEPT (open rows equal to a CHANGE row that stay)

So a stored history is streamed three times, once for its keys only, through
broadcast hash joins; the only shuffles are over batch-sized data.  When a
batch is too large to broadcast (measured, see ``plans.sizing``) the same joins
run as sort-merge joins with AQE skew splitting.  Nothing is persisted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import (broadcast_limit as broadcast_limit_of, fits, measure_all,
                            measure_with_multiplicity)
from ..specs import END_DATE, START_DATE, FeedSpec
from .typed import as_date, stamp

VERSION_COLS = [START_DATE, END_DATE]
# Largest number of CHANGE rows sharing a key for which the close test may
# compare an open row with each of them (at most this many comparisons per
# row); above it the per-key summary join is used.  Both ways are exact.
PAIRWISE_MAX = 32


@dataclass(frozen=True)
class MergeKeys:
    keys: list[str]
    values: list[str]

    @property
    def business(self) -> list[str]:
        return self.keys + self.values

    @classmethod
    def of(cls, spec: FeedSpec | None = None, keys=None, values=None) -> "MergeKeys":
        if spec is not None:
            return cls(spec.keys, spec.values)
        return cls(list(keys), list(values))


def _c(alias: str, name: str) -> Column:
    return F.col(f"{alias}.`{name}`")


def key_condition(keys: list[str], left: str, right: str, null_safe: bool = False) -> Column:
    """`left.k = right.k AND ...` (or `<=>` when null_safe)."""
    parts = [(_c(left, k).eqNullSafe(_c(right, k)) if null_safe else _c(left, k) == _c(right, k))
             for k in keys]
    return reduce(lambda a, b: a & b, parts)


def diff_condition(values: list[str], left: str, right: str, null_safe: bool = False) -> Column:
    """OR over value columns of `left.v <> right.v`.

    Three-valued by default (a null on either side is no difference); with
    ``null_safe`` a null against a value counts as a difference.
    """
    if not values:
        return F.lit(False)
    parts = [(~_c(left, v).eqNullSafe(_c(right, v)) if null_safe else _c(left, v) != _c(right, v))
             for v in values]
    return reduce(lambda a, b: a | b, parts)


def new_key_rows(add: DataFrame, history: DataFrame, keys: list[str],
                 add_fits: bool | None = None, broadcast_limit: int | None = None) -> DataFrame:
    """ADD rows whose key has no history row (anti join, composite key).

    When ADD is measured small, history keys are semi-filtered against the
    broadcast ADD keys (a streaming pass, no shuffle of history), the matched
    keys are de-duplicated (partial aggregation first, so a hot key costs one
    row per task before the shuffle) and ADD is anti-joined against that set,
    which is no larger than ADD's key set.  Otherwise a sort-merge anti join.
    """
    kcols = [F.col(f"`{k}`") for k in keys]
    if add_fits is None:
        (rows, payload), = measure_all([add.select(*kcols)])
        add_fits = fits(rows, payload, broadcast_limit if broadcast_limit is not None
                        else broadcast_limit_of(add.sparkSession))
    hist_keys = history.select(*kcols)
    if add_fits:
        # build sides of semi/anti joins only test existence: duplicates are harmless
        add_keys = F.broadcast(add.select(*kcols).dropna())
        present = hist_keys.join(add_keys, keys, "left_semi").distinct()
        return add.join(F.broadcast(present), keys, "left_anti")
    # Shuffle fallback: de-duplicate history keys first (partial aggregation
    # map-side), so a hot key reaches the join as one row, not a third of
    # the history; AQE can only split the streamed (left) side of an anti join.
    return add.join(hist_keys.distinct(), keys, "left_anti")


CLOSES = "__closes"


@dataclass
class MergeParts:
    """The pieces of a merged history, each a DataFrame of the full layout."""
    shut: DataFrame | None  # versions closed before this run, if given apart
    flagged: DataFrame      # all other versions before CHANGE, with CLOSES
    inserted: DataFrame     # new open versions from CHANGE
    added: DataFrame | None  # new open versions from ADD (in ``flagged``, too)
    as_of: object

    def _end(self, rows: DataFrame) -> DataFrame:
        end = F.when(F.col(CLOSES), as_date(self.as_of)).otherwise(F.col(END_DATE))
        return rows.withColumn(END_DATE, end).drop(CLOSES)

    @property
    def closing(self) -> DataFrame:
        """Open versions closed by this run."""
        return self._end(self.flagged.filter(F.col(CLOSES)))

    @property
    def opened(self) -> DataFrame:
        """Versions opened by this run, whether or not it closes them too."""
        return self.inserted if self.added is None else self.added.unionByName(self.inserted)

    def opened_to_stay(self, new: Column) -> DataFrame:
        """Versions opened by this run that it does not close; ``new`` tells the
        versions of ADD in ``flagged``."""
        return self._end(self.flagged.filter(new & ~F.col(CLOSES))).select(*self.inserted.columns).unionByName(self.inserted)

    @property
    def updated(self) -> DataFrame:
        """The history after the close step."""
        rows = self._end(self.flagged)
        return rows if self.shut is None else self.shut.unionByName(rows)

    @property
    def open_rows(self) -> DataFrame:
        stay = self.flagged.filter(~F.col(CLOSES) & F.col(END_DATE).isNull()).drop(CLOSES)
        return stay.unionByName(self.inserted)

    def result(self) -> DataFrame:
        return self.updated.unionByName(self.inserted)


def _collated(df: DataFrame, collation: str | None) -> DataFrame:
    if not collation:
        return df
    return df.select(*[(F.collate(F.col(f"`{c}`"), collation) if t.startswith("string")
                        else F.col(f"`{c}`")).alias(c) for c, t in df.dtypes])


def _plain(df: DataFrame, collation: str | None) -> DataFrame:
    if not collation:
        return df
    return df.select(*[(F.col(f"`{c}`").cast("string") if t.startswith("string")
                        else F.col(f"`{c}`")).alias(c) for c, t in df.dtypes])


def same_row(names: list[str], left: str, right: str, collated: bool = False) -> Column:
    """Equality of all columns, nulls equal.  One struct comparison, which
    stays small in generated code however many columns there are; column by
    column under a collation."""
    if collated:
        return key_condition(names, left, right, null_safe=True)
    return F.struct(*[_c(left, n) for n in names]) == F.struct(*[_c(right, n) for n in names])


def _flag(rows: DataFrame, chg: DataFrame, mk: MergeKeys, null_safe: bool, test: str,
          side_fits: bool) -> DataFrame:
    """``rows`` with CLOSES: open, and some CHANGE row of the key differs.  A
    left join with one row per key, whatever the test."""
    is_open = F.col(END_DATE).isNull()
    columns = [F.col(f"m.`{c}`") for c in rows.columns]
    keyed = chg.dropna(subset=mk.keys)      # a null key never matches
    ck = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(mk.keys)]
    if test == "summary":
        side = change_summary(keyed, mk.keys, mk.values, null_safe)
        rest = [c for c in side.columns if c not in mk.keys]
        side = side.select(*ck, *rest)
        differs = closes_expr(mk.values, null_safe)
    else:
        one = F.struct(*[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(mk.values)], F.lit(1).alias("is"))
        if test == "unique":
            side = keyed.select(*ck, one.alias("__c"))
            differs = _differs(F.col("__c"), mk.values, null_safe) & F.col("__c").isNotNull()
        else:           # at most PAIRWISE_MAX rows of a key, as measured
            side = keyed.select(*ck, one.alias("__c")).groupBy(*[f"__k{i}" for i in range(len(ck))]).agg(
                F.collect_list("__c").alias("__c"))
            differs = F.exists("__c", lambda c: _differs(c, mk.values, null_safe))
    side = F.broadcast(side) if side_fits else side
    on = reduce(lambda x, y: x & y, [F.col(f"m.`{k}`") == F.col(f"c.__k{i}") for i, k in enumerate(mk.keys)])
    return rows.alias("m").join(side.alias("c"), on, "left").select(
        *columns, (is_open & F.coalesce(differs, F.lit(False))).alias(CLOSES))


def _differs(c: Column, values: list[str], null_safe: bool) -> Column:
    """Some value of version ``m`` differs from CHANGE row ``c`` (v0, v1, ..)."""
    parts = [(~F.col(f"m.`{v}`").eqNullSafe(c[f"v{i}"]) if null_safe else F.col(f"m.`{v}`") != c[f"v{i}"])
             for i, v in enumerate(values)]
    return reduce(lambda x, y: x | y, parts, F.lit(False))


def _unmet(chg: DataFrame, open_rows: DataFrame, mk: MergeKeys, collated: bool) -> DataFrame:
    """CHANGE rows, one of a key, that equal no open version (alias m).  Rows meet
    by their keys, nulls equal, and compare column by column there: wide rows are
    shuffled by their keys and neither hashed nor sorted whole.  What goes back to
    CHANGE is the keys of the rows that were met."""
    ks = [f"__k{i}" for i in range(len(mk.keys))]
    met = (open_rows.join(chg.alias("b"), key_condition(mk.keys, "m", "b", True))
           .groupBy(*[_c("b", k).alias(x) for k, x in zip(mk.keys, ks)])
           .agg(F.bool_or(same_row(mk.business, "m", "b", collated)).alias("__same")).where("__same"))
    on = reduce(lambda x, y: x & y, [_c("b", k).eqNullSafe(F.col(x)) for k, x in zip(mk.keys, ks)])
    return chg.alias("b").join(met, on, "left_anti")


def merge_parts(history: DataFrame, add: DataFrame | None, change: DataFrame | None,
                mk: MergeKeys, as_of, null_safe: bool = False,
                broadcast_limit: int | None = None, closed: DataFrame | None = None,
                collation: str | None = None, close_test: str = "auto",
                carry: dict[str, Column] | None = None, changes_only: bool = False,
                with_keys=None, _collated_now: bool = False) -> MergeParts:
    """The merge as separate parts (see ``MergeParts``).

    ``history`` holds every version; or, with ``closed`` given, ``history``
    holds the open versions only and ``closed`` the closed ones, so the open
    branches never touch closed data.  ``carry`` names further columns of
    ``history`` to keep, with their value for versions that ADD opens.

    ``changes_only``: the caller needs the versions that open and close, not
    those that stay.  Where CHANGE is too large to broadcast, versions of
    ``history`` without a CHANGE key are then left out by a semi join on the keys,
    which Spark's run-time Bloom filter can take ahead of the shuffle, or by
    ``with_keys(rows, change, keys)``, which a store has that can tell them without
    a shuffle of wide rows.

    ``collation`` (e.g. ``UTF8_LCASE``, ``UTF8_LCASE_RTRIM``) makes every
    string comparison of the merge -- key match, value difference, EXCEPT --
    follow that collation, as a database collation would; results come back
    as plain strings.  Among CHANGE rows equal under the collation, EXCEPT
    keeps one (which one is unspecified, as in SQL).

    ``close_test``: "pairwise" compares each open row with the CHANGE rows of
    its key, gathered in one row; "summary" joins a per-key CHANGE summary
    (linear however many CHANGE rows share a key); "auto" measures the largest
    number of CHANGE rows per key (in the same job as the batch sizes), uses
    pairwise only up to ``PAIRWISE_MAX`` and, where keys are unique, CHANGE as
    it is.
    """
    if collation:
        some = lambda d: None if d is None else _collated(d, collation)
        p = merge_parts(some(history), some(add), some(change), mk, as_of, null_safe,
                        broadcast_limit, some(closed), close_test=close_test, carry=carry,
                        changes_only=changes_only, _collated_now=True)
        back = [None if d is None else _plain(d, collation)
                for d in (p.shut, p.flagged, p.inserted, p.added)]
        return MergeParts(*back, as_of)
    carry = carry or {}
    keys, biz = mk.keys, mk.business
    layout = biz + VERSION_COLS
    cols = lambda df, names: df.select(*[F.col(f"`{n}`") for n in names])
    hist = cols(history, layout + list(carry))
    spark = hist.sparkSession

    # Measure both batches in one job; broadcast only what fits.
    limit = broadcast_limit if broadcast_limit is not None else broadcast_limit_of(spark)
    add_b = cols(add, biz) if add is not None else None
    chg = cols(change, biz) if change is not None else None
    batches = [b for b in (add_b, chg) if b is not None]
    multiplicity = 0
    if chg is not None and close_test == "auto":
        sizes, multiplicity = measure_with_multiplicity(batches, chg, keys)
    else:
        sizes = measure_all(batches) if batches else []
    test = close_test if close_test != "auto" else (
        "unique" if multiplicity <= 1 else "pairwise" if multiplicity <= PAIRWISE_MAX else "summary")
    add_fits = add is not None and fits(*sizes[0], limit)
    chg_fits = chg is not None and fits(*sizes[-1], limit)

    # 1. ADD -> new keys only, checked against every version.
    shut = cols(closed, layout) if closed is not None else None
    ins_add, rows = None, hist
    if add is not None:
        versions = cols(hist, keys) if shut is None else cols(hist, keys).unionByName(cols(shut, keys))
        ins_add = stamp(new_key_rows(add_b, versions, keys, add_fits, limit), as_of, biz).withColumns(carry)
        rows = hist.unionByName(ins_add)
    if chg is None:
        none = spark.createDataFrame([], hist.schema)
        return MergeParts(shut, rows.withColumn(CLOSES, F.lit(False)), none, ins_add, as_of)

    # 2. Flag what CHANGE closes, in one pass.
    side_fits = chg_fits and (test != "summary" or fits(*_summary_bound(sizes[-1], len(mk.values)), limit))
    if changes_only and not chg_fits:
        still = hist.filter(F.col(END_DATE).isNull())
        rows = with_keys(still, chg, keys) if with_keys is not None else still.alias("m").join(
            cols(chg, keys).distinct().alias("b"), key_condition(keys, "m", "b", True), "left_semi")
        rows = rows if ins_add is None else rows.unionByName(ins_add)
    flag = lambda df: _flag(df, chg, mk, null_safe, test, side_fits)
    flagged = flag(rows)

    # 3. CHANGE EXCEPT (distinct, null-equal) open rows.  Only rows that equal a
    #    CHANGE row matter; of those, the ones that stay open.  Where each key has
    #    one CHANGE row, a version that equals it differs from none and stays, and
    #    CHANGE is distinct as it is.
    once = test == "unique"
    alike = rows.filter(F.col(END_DATE).isNull()).alias("m")
    if once and not chg_fits:
        new = _unmet(chg, alike, mk, _collated_now)
    elif not chg_fits:
        alike = alike.join(cols(chg, keys).distinct().alias("b"), key_condition(keys, "m", "b", True),
                           "left_semi")
        new = chg.subtract(cols(flag(alike).filter(~F.col(CLOSES)), biz))
    else:
        alike = alike.join(F.broadcast(chg).alias("b"), same_row(biz, "m", "b", _collated_now), "left_semi")
        stay = cols(alike if once else flag(alike).filter(~F.col(CLOSES)), biz)
        new = (chg if once else chg.distinct()).alias("b").join(F.broadcast(stay.distinct()).alias("r"),
                                                                same_row(biz, "b", "r", _collated_now), "left_anti")
    return MergeParts(shut, flagged, stamp(new, as_of, biz).withColumns(carry), ins_add, as_of)


_MIN, _MAX, _NN, _N = "__min_", "__max_", "__nn_", "__n"


def change_summary(chg: DataFrame, keys: list[str], values: list[str],
                   null_safe: bool = False) -> DataFrame:
    """One row per (non-null) CHANGE key: per value column the least and
    greatest non-null value, and for the null-safe rule the non-null count,
    plus the row count.

    This is all the close test needs: an open row m closes iff some CHANGE
    row c of its key differs in some column v -- the two "some" swap, so it
    is iff some column v has a CHANGE value differing from m.v, and "every
    non-null CHANGE value of v equals m.v" is "least = greatest = m.v".
    Null keys never match with `=`, so their rows are left out.  Partial
    aggregation runs before the shuffle, so a hot key arrives as one row per
    task.
    """
    aggs = [F.count(F.lit(1)).alias(_N)]
    for i, v in enumerate(values):
        c = F.col(f"`{v}`")
        aggs += [F.min(c).alias(f"{_MIN}{i}"), F.max(c).alias(f"{_MAX}{i}")]
        if null_safe:
            aggs.append(F.count(c).alias(f"{_NN}{i}"))
    present = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    return chg.filter(present).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggs)


def closes_expr(values: list[str], null_safe: bool = False) -> Column:
    """True for an open row whose key has a CHANGE summary row (joined
    alongside) with a differing value; False otherwise (never null)."""
    parts = []
    for i, v in enumerate(values):
        m = F.col(f"m.`{v}`")
        lo, hi = F.col(f"{_MIN}{i}"), F.col(f"{_MAX}{i}")
        if null_safe:
            nn = F.col(f"{_NN}{i}")
            same = ((m.isNull() & (nn == 0))
                    | (m.isNotNull() & (nn == F.col(_N)) & (lo == m) & (hi == m)))
            parts.append(~same)
        else:
            # some non-null CHANGE value, m non-null, and not all equal to m
            parts.append(m.isNotNull() & lo.isNotNull() & ~((lo == m) & (hi == m)))
    anydiff = reduce(lambda a, b: a | b, parts) if parts else F.lit(False)
    return F.coalesce(F.col(_N).isNotNull() & anydiff, F.lit(False))


def _summary_bound(measured: tuple[int, int], n_values: int) -> tuple[int, int]:
    """Size bound of the summary from CHANGE's measured (rows, bytes): at most
    one row per CHANGE row, each holding two values per column and counts."""
    rows, payload = measured
    return rows, 2 * payload + rows * 8 * (2 + 2 * n_values)


def except_rows(batch: DataFrame, rows: DataFrame, names: list[str],
                batch_fits: bool) -> DataFrame:
    """``batch EXCEPT rows`` (distinct, nulls equal) over ``names``.

    With a measured-small batch, ``rows`` is only streamed: a broadcast semi
    join keeps its rows equal to some batch row, de-duplicated map-side, and
    the distinct batch is anti-joined against that set, which is no larger
    than the batch.  Otherwise Spark's EXCEPT (both sides shuffled).
    """
    if not batch_fits:
        return batch.subtract(rows)
    equal = rows.alias("r").join(F.broadcast(batch).alias("b"), same_row(names, "r", "b"),
                                 "left_semi").distinct()
    return batch.distinct().alias("b").join(F.broadcast(equal).alias("r"),
                                            same_row(names, "b", "r"), "left_anti")


def merge(history: DataFrame, add: DataFrame | None, change: DataFrame | None,
          spec: FeedSpec | None = None, as_of=None, null_safe: bool = False,
          keys=None, values=None, broadcast_limit: int | None = None,
          collation: str | None = None, close_test: str = "auto") -> DataFrame:
    """Merged history: business columns + start_date, end_date."""
    if as_of is None:
        raise ValueError("as_of is required: a fixed run date keeps reruns repeatable")
    mk = MergeKeys.of(spec, keys, values)
    return merge_parts(history, add, change, mk, as_of, null_safe, broadcast_limit,
                       collation=collation, close_test=close_test).result()


def open_versions(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END_DATE).isNull())


def except_changed(history: DataFrame, change: DataFrame, mk: MergeKeys,
                   broadcast_limit: int | None = None) -> DataFrame:
    """CHANGE rows (distinct) equal to no open history row, value columns only.

    Open rows are first restricted to CHANGE keys (null-safe semi join, keys
    broadcast when CHANGE is measured small): only those can equal a CHANGE
    row."""
    biz = mk.business
    cols = [F.col(f"`{n}`") for n in biz]
    chg = change.select(*cols)
    (rows, payload), = measure_all([chg])
    small = fits(rows, payload, broadcast_limit if broadcast_limit is not None
                 else broadcast_limit_of(chg.sparkSession))
    keyset = chg.select(*[F.col(f"`{k}`") for k in mk.keys])
    keyset = F.broadcast(keyset) if small else keyset.distinct()
    open_rel = (open_versions(history).alias("m")
                .join(keyset.alias("k"), key_condition(mk.keys, "m", "k", True), "left_semi")
                .select(*cols))
    return except_rows(chg, open_rel, biz, small)

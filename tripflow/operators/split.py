"""Chronological split (W1) without a global single-partition sort.

Semantics: order all raw rows by (pickup ascending, nulls last; tie-break key),
rows ``[0, n*6//10)`` are train, ``[n*6//10, n*8//10)`` validation, the rest test.

Plan: one grouped count per pickup hour gives the row total, the null count and
each hour's time and key range (the driver gets one small row per hour that has
data). The hour holding a cut is narrowed by equal-width buckets while it holds
more than ``exact_rows`` rows (one small grouped count per level, its range also
stated on the raw timestamp so parquet skips row groups), then by tie-break key
ranges if a single instant holds too many rows. Finally all cuts are resolved in
ONE scan: the rows of each cut's final range are numbered within that cut (a
window partitioned by cut, each partition at most ``exact_rows`` rows) and the
row at the cut's rank is the boundary; only those rows reach the driver. The
result is a pair of boundary keys; each split is then a plain comparison
predicate on (pickup, key) that Catalyst pushes into the parquet scan.

The tie-break key must be there and unique within an instant, else no predicate
could tell rows of one instant apart: ``fit`` counts null keys in its first pass
and equal keys at the cuts, and raises. Trips without such a key get a stable one
from where they are landed (``sources.tables.land_keyed``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.timefeat import ntz_micros
from tripflow.schema import PICKUP, SPLIT_NAMES, TRAIN_FRACTION, VALIDATION_END_FRACTION


@dataclass(frozen=True)
class Boundary:
    """First row of a split in (pickup, key) order. ``ts_micros is None`` means the row has a null pickup."""

    ts_micros: int | None
    key: int


def _micros(ts: Column) -> Column:
    return ntz_micros(ts)


def _ts_literal(micros: int) -> Column:
    value = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=micros)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(T.TimestampNTZType())


HOUR_MICROS = 3_600_000_000


def _cut_positions(n: int, fractions) -> list[int]:
    """Cut positions as the reference computes them: int(n * fraction) in double precision."""
    return [int(n * float(f)) for f in fractions]


class ChronologicalSplit:
    def __init__(self, ts_col: str = PICKUP, key_col: str = "trip_id", buckets: int = 1024,
                 exact_rows: int = 20_000, fractions=(TRAIN_FRACTION, VALIDATION_END_FRACTION)):
        self.ts_col = ts_col
        self.key_col = key_col
        self.buckets = buckets
        self.exact_rows = exact_rows
        self.fractions = fractions
        self.boundaries: list[Boundary | None] = []
        self.n_rows = 0

    # ----------------------------------------------------------------- fit
    def fit(self, raw: DataFrame) -> "ChronologicalSplit":
        keys = raw.select(F.col(self.ts_col).alias("ts"), F.col(self.key_col).cast("bigint").alias("k")).select(
            "ts", _micros(F.col("ts")).alias("m"), "k"
        )
        self._levels = {}
        m = F.col("m")
        # job 1: rows, key range and time range per pickup hour (null pickups form their own group);
        # one row per hour that has data, so the driver gets a small table
        hours = keys.groupBy(F.floor(m / F.lit(HOUR_MICROS)).alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.min("m").alias("lo"), F.max("m").alias("hi"),
            F.min("k").alias("klo"), F.max("k").alias("khi"), F.count_if(F.col("k").isNull()).alias("keyless")).collect()
        keyless = sum(r["keyless"] for r in hours)
        if keyless:
            raise ValueError(f"{keyless} rows have no {self.key_col}; land the trips with a row key first")
        nulls = next((r for r in hours if r["b"] is None), None)
        timed = sorted((r for r in hours if r["b"] is not None), key=lambda r: r["b"])
        nn = sum(r["c"] for r in timed)
        n = nn + (nulls["c"] if nulls else 0)
        self.n_rows = n
        cuts = _cut_positions(n, self.fractions)
        self.boundaries = [None] * len(cuts)
        nonnull = keys.where(m.isNotNull())
        exact = []  # (cut index, lo, hi, rank): resolved together below
        for i, pos in enumerate(cuts):
            if pos >= n:
                continue
            if pos >= nn:  # boundary among null pickups, ordered by key
                self.boundaries[i] = self._locate_key(keys.where(m.isNull()), pos - nn, nulls["klo"], nulls["khi"],
                                                      None, n - nn)
                continue
            seen = 0
            for hour in timed:
                if seen + hour["c"] > pos:
                    break
                seen += hour["c"]
            rank, lo, hi, count = pos - seen, hour["lo"], hour["hi"], hour["c"]
            while count > self.exact_rows and lo != hi:
                lo, hi, rank, count = self._narrow(nonnull, m, rank, lo, hi, on_time=True)
            if count > self.exact_rows:  # a hot instant: continue on the tie-break key
                self.boundaries[i] = self._locate_key(nonnull.where(self._in_time(lo, lo)), rank, hour["klo"],
                                                      hour["khi"], lo, count)
            else:
                exact.append((i, lo, hi, rank))
        if exact:
            self._resolve_exact(nonnull, exact)
        return self

    def _in_time(self, lo: int, hi: int) -> Column:
        """[lo, hi] on the micros column, also stated on the raw timestamp so the scan can skip row groups."""
        return F.col("ts").between(_ts_literal(lo), _ts_literal(hi)) & F.col("m").between(lo, hi)

    def _resolve_exact(self, frame: DataFrame, exact) -> None:
        """All remaining cuts in ONE scan: rows of each cut's final range (at most ``exact_rows`` each) are
        numbered in (pickup, key) order within that cut, and the row at the cut's rank is its boundary."""
        tags = F.array(*[F.when(self._in_time(lo, hi), F.lit(i)) for i, lo, hi, _ in exact])
        ranks = F.create_map(*[x for i, _, _, r in exact for x in (F.lit(i), F.lit(r))])
        wanted = F.reduce(F.array(*[self._in_time(lo, hi) for _, lo, hi, _ in exact]), F.lit(False),
                          lambda acc, x: acc | x)
        tagged = frame.where(wanted).select("m", "k", F.explode(tags).alias("cut")).where(F.col("cut").isNotNull())
        numbered = tagged.withColumn("rn", F.row_number().over(Window.partitionBy("cut").orderBy("m", "k"))) \
            .withColumn("equal", F.count(F.lit(1)).over(Window.partitionBy("cut", "m", "k")))
        for row in numbered.where(F.col("rn") == ranks[F.col("cut")] + 1).select("cut", "m", "k", "equal").collect():
            self._check_unique(row["k"], row["equal"])
            self.boundaries[row["cut"]] = Boundary(row["m"], row["k"])

    def _narrow(self, frame: DataFrame, value: Column, rank: int, lo: int, hi: int, on_time: bool = False):
        """One level: count rows per equal-width bucket of ``value`` in [lo, hi]; return the bucket holding ``rank``.

        On the time axis the range is also stated on the raw timestamp, so the parquet scan
        skips row groups outside it (min/max statistics) at every level after the first.
        Levels are memoised: both cut positions share the first one.
        """
        width = max(1, -(-(hi - lo + 1) // self.buckets))
        memo_key = (lo, hi) if on_time else None  # only the time axis always narrows the same frame
        counts = self._levels.get(memo_key) if memo_key else None
        if counts is None:
            cond = value.between(lo, hi)
            if on_time:
                cond = F.col("ts").between(_ts_literal(lo), _ts_literal(hi)) & cond
            counts = sorted(
                frame.where(cond).groupBy(F.floor((value - F.lit(lo)) / F.lit(width)).alias("b"))
                .agg(F.count(F.lit(1)).alias("c")).collect(),
                key=lambda r: r["b"],
            )
            if memo_key:
                self._levels[memo_key] = counts
        seen = 0
        for row in counts:
            if seen + row["c"] > rank:
                b_lo = lo + row["b"] * width
                return b_lo, min(hi, b_lo + width - 1), rank - seen, row["c"]
            seen += row["c"]
        raise RuntimeError("split boundary not found; input changed during fit")

    def _locate_key(self, frame: DataFrame, rank: int, klo: int, khi: int, ts_micros, count: int) -> Boundary:
        k = F.col("k")
        while count > self.exact_rows and klo != khi:
            klo, khi, rank, count = self._narrow(frame, k, rank, klo, khi)
        near = frame.where(k.between(klo, khi))
        row = near.orderBy("k").offset(rank).limit(1).first()
        self._check_unique(row["k"], near.where(k == F.lit(row["k"])).count())
        return Boundary(ts_micros, row["k"])

    def _check_unique(self, key: int, rows: int) -> None:
        if rows > 1:
            raise ValueError(f"{rows} rows at a cut share the {self.key_col} {key}; land the trips with a row key first")

    # ----------------------------------------------------------- predicates
    def _before(self, b: Boundary | None) -> Column:
        ts, key = F.col(self.ts_col), F.col(self.key_col)
        if b is None:
            return F.lit(True)
        if b.ts_micros is None:
            return ts.isNotNull() | (key.isNotNull() & (key < F.lit(b.key)))
        t = _ts_literal(b.ts_micros)
        # a row that arrived after the fit may lack its key: never null, so take and assign agree on it too
        return ts.isNotNull() & ((ts < t) | ((ts == t) & key.isNotNull() & (key < F.lit(b.key))))

    def split_column(self) -> Column:
        b1, b2 = self.boundaries
        return (
            F.when(self._before(b1), F.lit(SPLIT_NAMES[0]))
            .when(self._before(b2), F.lit(SPLIT_NAMES[1]))
            .otherwise(F.lit(SPLIT_NAMES[2]))
        )

    def predicate(self, name: str) -> Column:
        b1, b2 = self.boundaries
        if name == SPLIT_NAMES[0]:
            return self._before(b1)
        if name == SPLIT_NAMES[1]:
            return ~self._before(b1) & self._before(b2)
        if name == SPLIT_NAMES[2]:
            return ~self._before(b2)
        raise ValueError(f"unknown split {name!r}")

    def assign(self, raw: DataFrame, col: str = "split") -> DataFrame:
        return raw.withColumn(col, self.split_column())

    def take(self, raw: DataFrame, name: str) -> DataFrame:
        return raw.where(self.predicate(name))

"""Table-table left join as a changelog: one row per change.

A fare record that is newer than its key's last one gives the new fare with the
trip the key has by then, or without one; a newer trip record gives the held
fare with the new trip, and nothing if there is no fare yet.  So three changes
of one key in one micro-batch give three rows, which an aggregate's ``update``
output would merge into one.

State is each side's last record of a key: its offset and the fields the merged
record reads, as JSON text.  A key has a value state for each side.  With ``ttl``
a side's record that has not changed for so long (processing time) is dropped
from the state store; without it the tables hold every key, as the tables they
stand for do.

A key then takes five calls to the state store and a record some conversions, much
more than its own work.  For micro-batches of many records ``groups`` lets keys
share that many states by hash.  A state is a list of chunks, one for each
micro-batch that changed any of its keys, so a micro-batch reads a group once and
appends its changes.  A list that holds more than twice the records which are
still last is written anew: its size follows the table's.  A checkpoint goes on
with the form and the number that it was begun with.

Within a micro-batch a key's records are taken in offset order on each side, and
the sides are merged by record time, fares first.  Records with an offset at or
below the held one are repeats or strays and change nothing, so the last row of
a key, by (fare_seq, trip_seq), is that of the batch join of the same records.
A key's (or a group's) records of one micro-batch are in memory at once; bound
the micro-batch by ``max_per_trigger``.

The Python part moves offsets and opaque texts only.  Parsing, the shuffle on
the key and the merged record are native.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hackney.operators import merge

_NO_TIME = -1 << 63            # before all times
_HELD = "seq long, rec string"
_CHUNK = "keys array<string>, fare array<boolean>, seqs array<long>, recs array<string>"
_OUT = "key string, changed string, f_seq long, f_rec string, t_seq long, t_rec string"


# Local functions and classes travel to the workers by value: the package need
# not be there.

def _changes():
    def of(fares: list, trips: list, fare: tuple, trip: tuple) -> tuple[list[tuple], tuple, tuple]:
        """The changes (side, f_seq, f_rec, t_seq, t_rec) that a key's records
        (seq, micros, rec) make to what it holds, and what it holds then."""
        if len(fares) > 1:
            fares.sort(key=lambda r: r[0])
        if len(trips) > 1:
            trips.sort(key=lambda r: r[0])
        out = []
        i = j = 0
        while i < len(fares) or j < len(trips):
            if j == len(trips) or (i < len(fares) and fares[i][1] <= trips[j][1]):
                seq, _, rec = fares[i]
                i += 1
                if fare[0] is None or seq > fare[0]:
                    fare = (seq, rec)
                    out.append(("fare", seq, rec, *trip))
            else:
                seq, _, rec = trips[j]
                j += 1
                if trip[0] is None or seq > trip[0]:
                    trip = (seq, rec)
                    if fare[0] is not None:
                        out.append(("trip", *fare, seq, rec))
        return out, fare, trip
    return of


def _by_key(ttl_ms: int | None) -> StatefulProcessor:
    of = _changes()

    class LastPair(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.fare = handle.getValueState("fare", _HELD, ttl_ms)
            self.trip = handle.getValueState("trip", _HELD, ttl_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            sides: dict[str, list] = {"fare": [], "trip": []}
            for r in rows:
                sides[r["side"]].append((r["seq"], r["ts"], r["rec"]))
            old_fare, old_trip = self.fare.get() or (None, None), self.trip.get() or (None, None)
            found, fare, trip = of(sides["fare"], sides["trip"], old_fare, old_trip)
            for changed, f_seq, f_rec, t_seq, t_rec in found:
                yield Row(key=key[0], changed=changed, f_seq=f_seq, f_rec=f_rec, t_seq=t_seq, t_rec=t_rec)
            if fare != old_fare:
                self.fare.update(fare)
            if trip != old_trip:
                self.trip.update(trip)

        def close(self) -> None:
            pass

    return LastPair()


def _by_group() -> StatefulProcessor:
    of, none = _changes(), (None, None)

    class LastPairs(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.held = handle.getListState("held", _CHUNK)

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd
            new: dict[str, tuple[list, list]] = {}
            for part in rows:
                for k, side, *rec in zip(*(part[c].tolist() for c in ("key", "side", "seq", "ts", "rec"))):
                    sides = new.get(k)
                    if sides is None:
                        sides = new[k] = ([], [])
                    sides[side != "fare"].append(rec)
            held: dict[tuple[str, bool], tuple] = {}
            written = 0
            for chunk in self.held.get():
                written += len(chunk[0])
                for k, is_fare, *last in zip(*chunk):
                    held[k, is_fare] = tuple(last)
            now: dict[tuple[str, bool], tuple] = {}
            out = []
            for k, (fares, trips) in new.items():
                old_fare, old_trip = held.get((k, True), none), held.get((k, False), none)
                found, fare, trip = of(fares, trips, old_fare, old_trip)
                for change in found:
                    out.append((k, *change))
                if fare != old_fare:
                    now[k, True] = fare
                if trip != old_trip:
                    now[k, False] = trip
            if out:      # objects: a column of numbers and nulls stays exact
                yield pd.DataFrame(dict(zip(("key", "changed", "f_seq", "f_rec", "t_seq", "t_rec"),
                                            (pd.Series(c, dtype=object) for c in zip(*out)))))
            if now:
                held.update(now)
                anew = written + len(now) > 2 * len(held)
                kept = held if anew else now
                chunk = ([k for k, _ in kept], [f for _, f in kept], *map(list, zip(*kept.values())))
                if anew:
                    self.held.put([chunk])
                else:
                    self.held.appendList([chunk])

        def close(self) -> None:
            pass

    return LastPairs()


def _side(df: DataFrame, name: str, key: str, order: str, time_col: str, cols: list[str]) -> DataFrame:
    return df.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(
        F.col(key).alias("key"), F.lit(name).alias("side"), F.col(order).alias("seq"),
        F.coalesce(F.unix_micros(time_col), F.lit(_NO_TIME)).alias("ts"), F.to_json(F.struct(*cols)).alias("rec"))


def _schema(df: DataFrame, cols: list[str]) -> T.StructType:
    fields = {f.name: f.dataType for f in df.schema.fields}
    return T.StructType([T.StructField(c, fields[c]) for c in cols])


def table_left_join_changes(fares: DataFrame, trips: DataFrame, key: str = "key", order: str = "seq",
                            record_col: str = "ts", ttl_seconds: int | None = None, groups: int | None = None) -> DataFrame:
    """Every change of latest fare LEFT JOIN latest trip, as merged records with
    ``changed`` ("fare" or "trip"), in ``update`` mode.  ``order`` is the offset,
    a number.  Records without a key or an offset change nothing.  ``groups``, not
    with a ttl: keys share that many states; a micro-batch reads those of its
    keys whole, so take it where most of them get many records."""
    if groups is not None and ttl_seconds is not None:
        raise ValueError("a ttl is of single keys: groups have none")
    f_cols, t_cols = list(merge.FARE_MERGE_COLUMNS), list(merge.TRIP_MERGE_COLUMNS)
    both = _side(fares, "fare", key, order, record_col, f_cols).unionByName(
        _side(trips, "trip", key, order, record_col, t_cols))
    if groups is not None:
        shared = both.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups))).groupBy("group")
        pairs = shared.transformWithStateInPandas(_by_group(), _OUT, "Update", "None")
    elif ttl_seconds is None:
        pairs = both.groupBy("key").transformWithState(_by_key(None), _OUT, "Update", "None")
    else:
        pairs = both.groupBy("key").transformWithState(_by_key(ttl_seconds * 1000), _OUT, "Update", "ProcessingTime")
    fare = F.from_json("f_rec", _schema(fares, f_cols))
    trip = F.from_json("t_rec", _schema(trips, t_cols))
    flat = (pairs.withColumns({"_f": fare, "_t": trip})
            .select(F.col("key").alias(key), "changed", "f_seq", "t_seq",
                    *[F.col("_f")[c].alias("f_" + c) for c in f_cols],
                    *[F.col("_t")[c].alias("t_" + c) for c in t_cols]))
    return merge.merge_record(flat, key=key, extra=[F.col("changed")])


@contextmanager
def no_idle_batches(spark: SparkSession) -> Iterator[None]:
    """Queries started inside run no micro-batch without data.  Processing time
    always asks for one more, so a one-shot query with a ``ttl`` would not end;
    expired records then leave the state with the next data."""
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


# The total order of a key's changes: each raises one of the two offsets.
CHANGE_ORDER = ("fare_seq", "trip_seq")

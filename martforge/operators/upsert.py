"""Batch upsert of new incidents (U1): insert-if-absent dimensions, append facts.

The source records one strike per stored-procedure call: look up the airport
and the flight, insert them when missing, then insert the strike.  Here one
call takes a whole batch DataFrame and returns the three updated tables; it
can be applied per micro-batch with ``streaming.upsert_stream``.

Semantics (the evident intent of the procedure):

* airports are matched by state name (null -> ``unknown``); missing states are
  added with ids ``max(aid) + 1..k`` in batch order;
* flights are matched by their natural key (date, origin airport, aircraft);
  missing ones are added with ids ``max(fid) + 1..k``, airline ``Unknown``,
  the batch altitude and heavy = 0;
* every batch row becomes a strike with id ``max(sid) + 1..n`` in batch order,
  impact ``N/A``, damage 0, and its sky condition resolved to the condition id
  (null matches null).

Applying the same batch twice adds no airport or flight (their keys now
exist) but adds the strikes again, as calling the procedure twice would.
All steps are anti-joins, unions and joins on keys; the existing maxima are
scalar subqueries; new ids come from ``keys.dense_ids``.  A caller that keeps an
index of flight keys and the highest ids (``streaming.upsert_stream``) hands
them in, and then neither the flights are scanned nor any maximum taken.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.operators import keys as K

BATCH_FIELDS = ["date", "origin", "aircraft", "altitude", "numbirds", "conditions"]
FLIGHT_KEY = ["date", "origin", "aircraft"]


def _max_plus(df: DataFrame, col: str, rel: str, mark: int | None = None) -> F.Column:
    base = F.coalesce(df.select(F.max(col)).scalar(), F.lit(0)) if mark is None else F.lit(mark)
    return (base + F.col(rel)).cast("long")


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def record_strikes(batch: DataFrame, airports: DataFrame, flights: DataFrame,
                   strikes: DataFrame, conditions: DataFrame,
                   order_cols: Sequence[str], known_flights: Callable[[DataFrame], DataFrame] | None = None,
                   marks: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """-> {"airports", "flights", "strikes"} after adding ``batch``, plus the
    added rows alone as ``new_airports``, ``new_flights``, ``new_strikes``.

    ``known_flights`` maps a frame of natural keys to (key, fid) rows that hold
    at least the known ones of them, by default from ``flights``; ``marks`` has
    the highest id in use by table, by default the tables' maxima.
    """
    marks = marks or {}
    b = batch.withColumn("_bord", F.struct(*[F.col(c) for c in order_cols])) \
             .withColumn("_state", F.coalesce(F.col("origin"), F.lit("unknown")))

    # -- airports: insert missing states
    states = b.groupBy("_state").agg(F.min("_bord").alias("first_order"))
    known = airports.select(F.col("airportState").alias("_state"))
    missing = states.join(known, "_state", "left_anti")
    new_airports = (K.dense_ids(missing, ["first_order"], "_rel", tie_breaker="_state")
                    .select(_max_plus(airports, "aid", "_rel", marks.get("airports")).alias("aid"),
                            F.col("_state").alias("airportState"),
                            F.lit(None).cast("string").alias("airportCode")))
    airports2 = airports.select("aid", "airportState", "airportCode").unionByName(new_airports)

    # -- flights: resolve origin, insert missing natural keys
    aid_of = airports2.groupBy(F.col("airportState").alias("_state")).agg(
        F.min("aid").alias("_aid"))
    bf = b.join(aid_of, "_state", "left").withColumn("origin", F.col("_aid")).drop("_aid")
    fkeys = (bf.groupBy(*FLIGHT_KEY)
             .agg(F.min("_bord").alias("first_order"),
                  F.min_by("altitude", F.col("_bord")).alias("altitude")))
    # Only the flights that the batch can meet take part in what follows.
    wanted = fkeys.select(*FLIGHT_KEY)
    source = flights if known_flights is None else known_flights(wanted)
    met = source.join(wanted, _null_safe_on(source, wanted, FLIGHT_KEY), "left_semi").select(*FLIGHT_KEY, "fid")
    existing = met.select(*FLIGHT_KEY)
    missing_f = fkeys.join(existing, _null_safe_on(fkeys, existing, FLIGHT_KEY), "left_anti")
    new_flights = (K.dense_ids(missing_f, ["first_order"], "_rel")
                   .select(_max_plus(flights, "fid", "_rel", marks.get("flights")).alias("fid"), "date", "origin",
                           F.lit("Unknown").alias("airline"), "aircraft",
                           F.col("altitude").cast("int").alias("altitude"),
                           F.lit(0).alias("heavy")))
    flights2 = flights.select(*new_flights.columns).unionByName(new_flights)

    # -- strikes: one per batch row
    fid_of = met.unionByName(new_flights.select(*FLIGHT_KEY, "fid")).groupBy(*FLIGHT_KEY).agg(F.min("fid").alias("fid"))
    bs = bf.join(fid_of, _null_safe_on(bf, fid_of, FLIGHT_KEY), "left")
    bs = bs.select(*[bf[c] for c in bf.columns], fid_of["fid"])
    cid_of = conditions.groupBy(F.col("sky_condition")).agg(F.min("cid").alias("cid"))
    bs = bs.join(cid_of, bs["conditions"].eqNullSafe(cid_of["sky_condition"]), "left")
    new_strikes = (K.dense_ids(bs.select("_bord", "fid", "numbirds", "altitude", "cid"),
                               ["_bord"], "_rel")
                   .select(_max_plus(strikes, "sid", "_rel", marks.get("strikes")).alias("sid"), "fid",
                           F.col("numbirds").cast("int").alias("numbirds"),
                           F.lit("N/A").alias("impact"), F.lit(0).alias("damage"),
                           F.col("altitude").cast("int").alias("altitude"),
                           F.col("cid").alias("conditions")))
    strikes2 = strikes.select(*new_strikes.columns).unionByName(new_strikes)
    return {"airports": airports2, "flights": flights2, "strikes": strikes2,
            "new_airports": new_airports, "new_flights": new_flights,
            "new_strikes": new_strikes}

"""Incident normalisation (M13): text incident records -> airports, flights,
conditions, strikes.

Each record is one strike on one flight (``rid``).  Steps:

* airports: distinct origins, null included, numbered 1..n by first
  appearance; a null origin is stored as ``unknown`` (P6, D4, D5);
* flights: one row per rid (the first record, D8), date parsed from
  ``m/d/Y`` with any trailing time ignored (P3), origin resolved to the
  airport id by plain equality, so a null origin does NOT find the
  ``unknown`` airport and stays null (J5 / Q3; ``match_unknown=True``
  repairs it), airline / aircraft defaulted to ``Unknown`` (P6), altitude
  with thousands commas (P5), heavy flag 0/1 with null kept (P7);
* conditions: distinct sky conditions, null included, 1..n (D4, D5);
* strikes: sid 1..n in record order (D6), condition id looked up where
  null matches null (J4 / Q5), damage flag (P7).

``sid`` numbers the records; the numbered records are written once (the
staging table) and within one load every table reads them; first appearance
= smallest sid.  Airports, conditions and flights asked for by themselves
only aggregate the records, which are neither numbered nor written; flights and
the airports that they look up take the records' distinct flight fields.
Airports and conditions are written before rows look them up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions import clean as C
from martforge.operators import keys as K
from martforge.session import stored

CSV_FIELDS = ["rid", "flight_date", "origin", "airline", "aircraft", "altitude_ft",
              "heavy_flag", "sky_conditions", "wildlife_struck", "impact", "damage"]
FLIGHT_FIELDS = CSV_FIELDS[:CSV_FIELDS.index("heavy_flag") + 1]


def stage_records(raw: DataFrame, order_cols: Sequence[str], order_source: DataFrame | None = None) -> DataFrame:
    """Number the records 1..n (``sid``) and stage them as a written table;
    ``order_source`` may name a table that they were joined from and that has
    their order columns."""
    extra = [c for c in order_cols if c not in CSV_FIELDS]
    # Order columns that are no fields of a record have done their work.
    number = K.dense_ids_by_range if order_source is None else K.dense_ids_in_place
    return number(raw.select(*extra, *CSV_FIELDS), list(order_cols), "sid", bounds_from=order_source,
                  keep_order_cols=len(extra) < len(order_cols))


def load_airports(records: DataFrame, order: str | Sequence[str] = "sid") -> DataFrame:
    """airports(aid, airportState, airportCode) (+ the raw origin for look-ups)."""
    ids = K.dense_key(records, "origin", order, "aid")
    return ids.select("aid", C.null_default("origin", "unknown").alias("airportState"),
                      C.typed_null("string").alias("airportCode"),
                      F.col("origin").alias("_origin_raw"))


def load_conditions(records: DataFrame, order: str | Sequence[str] = "sid") -> DataFrame:
    """conditions(cid, sky_condition, explanation)."""
    ids = K.dense_key(records, "sky_conditions", order, "cid")
    return ids.select("cid", F.col("sky_conditions").alias("sky_condition"),
                      C.typed_null("string").alias("explanation"))


def load_flights(records: DataFrame, airports: DataFrame, match_unknown: bool = False,
                 order: str | Sequence[str] = "sid") -> DataFrame:
    """flights(fid, date, origin, airline, aircraft, altitude, heavy)."""
    order = [order] if isinstance(order, str) else list(order)
    typed = records.select(
        (F.col(order[0]) if len(order) == 1 else F.struct(*order)).alias("_order"),
        C.lenient_int("rid", "bigint").alias("fid"),
        C.parse_us_date("flight_date").alias("date"),
        F.col("origin").alias("_origin"),
        C.null_default("airline", "Unknown").alias("airline"),
        C.null_default("aircraft", "Unknown").alias("aircraft"),
        C.altitude_parse("altitude_ft").alias("altitude"),
        C.text_flag("heavy_flag", "Yes").alias("heavy"))
    first = K.apply_key_policy(typed, "fid", "keep_first", ["_order"])
    nat = "_origin_raw" if not match_unknown else "airportState"
    src = first if not match_unknown else first.withColumn(
        "_origin", C.null_default("_origin", "unknown"))
    looked = K.lookup_key(src, airports.select("aid", nat), "_origin", nat, "aid",
                          out_col="origin", policy="null")
    return looked.select("fid", "date", "origin", "airline", "aircraft", "altitude", "heavy")


def load_strikes(staged: DataFrame, conditions: DataFrame) -> DataFrame:
    """strikes(sid, fid, numbirds, impact, damage, altitude, conditions)."""
    typed = staged.select(
        "sid",
        C.lenient_int("rid", "bigint").alias("fid"),
        C.lenient_int("wildlife_struck").alias("numbirds"),
        F.col("impact"),
        C.text_flag("damage", "Caused damage").alias("damage"),
        C.altitude_parse("altitude_ft").alias("altitude"),
        F.col("sky_conditions"))
    looked = K.lookup_key(typed, conditions, "sky_conditions", "sky_condition", "cid",
                          out_col="conditions", policy="null", null_safe=True)
    return looked.select("sid", "fid", "numbirds", "impact", "damage", "altitude", "conditions")


def first_strike_per_flight(strikes: DataFrame) -> DataFrame:
    """UNIQUE(fid) "first instance only": the lowest sid per flight."""
    return K.apply_key_policy(strikes, "fid", "keep_first", ["sid"])


class StrikesLoad:
    """The four tables, built on demand from one staging of the records."""

    def __init__(self, raw: DataFrame, order_cols: Sequence[str], match_unknown: bool = False,
                 order_source: DataFrame | None = None):
        self._raw, self._order, self._match, self._order_source = raw, list(order_cols), match_unknown, order_source
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def staged(self):
        return self._get("staged", lambda: stage_records(self._raw, self._order, self._order_source))

    def _source(self):
        """What airports, conditions and flights are taken from: the numbered
        records if this load has made them, else the records as given."""
        return (self.staged, "sid") if "staged" in self._cache else (self._raw, self._order)

    def _flight_source(self):
        """``_source`` for flights: of records that nobody has numbered, the
        distinct flight fields, each with its first record's place."""
        if "staged" in self._cache or set(self._order) & set(FLIGHT_FIELDS):
            return self._source()
        return self._get("firsts", lambda: K.first_of_equal_rows(self._raw.select(*FLIGHT_FIELDS, *self._order), self._order, "_first")), "_first"

    @property
    def airports_full(self):
        return self._get("airports", lambda: load_airports(*self._source()))

    def _looked_up(self, name, build):
        """A dimension that rows are joined to, written."""
        if f"{name} stored" not in self._cache:
            self._cache[name] = self._cache[f"{name} stored"] = stored(self._get(name, build), f"loaded-{name}")
        return self._cache[name]

    @property
    def airports(self):
        return self.airports_full.drop("_origin_raw")

    @property
    def conditions(self):
        return self._get("conditions", lambda: load_conditions(*self._source()))

    @property
    def flights(self):
        records, order = self._flight_source()
        airports = self._looked_up("airports", lambda: load_airports(records, order))
        return self._get("flights", lambda: load_flights(records, airports, self._match, order))

    @property
    def strikes(self):
        staged = self.staged
        conditions = self._looked_up("conditions", lambda: load_conditions(staged, "sid"))
        return self._get("strikes", lambda: load_strikes(staged, conditions))

    def stored(self) -> dict[str, DataFrame]:
        """The four tables for a reader who needs them several times.  The
        records are numbered first, so that all tables come from them, and the
        tables made by aggregates are written once (strikes only look up their
        conditions)."""
        self.staged
        flights = self._looked_up("flights", lambda: self.flights)
        return {"airports": self.airports, "conditions": self._looked_up("conditions", lambda: self.conditions), "flights": flights,
                "strikes": self.strikes}


def load_all(raw: DataFrame, order_cols: Sequence[str],
             match_unknown: bool = False) -> dict[str, DataFrame]:
    s = StrikesLoad(raw, order_cols, match_unknown)
    return {"airports": s.airports, "flights": s.flights,
            "conditions": s.conditions, "strikes": s.strikes}

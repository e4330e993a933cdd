"""Incident normalisation and reports on the FIXTURES.md §3 sample CSV."""
import datetime as dt

import pytest

from martforge.operators import reports as R
from martforge.operators import upsert as U
from martforge.plans import strikes_load as STL
from martforge.sources import csv as CSV

CSV_TEXT = """rid,flight_date,origin,airline,aircraft,altitude_ft,heavy_flag,sky_conditions,wildlife_struck,impact,damage
10,4/11/2000 0:00,Texas,A,Airplane,"1,500",Yes,No Cloud,2,None,Caused damage
11,4/12/2001 0:00,Texas,A,NA,0,No,NA,5,None,No damage
12,5/1/2001 0:00,NA,NA,Airplane,30,NA,Overcast,1,None,NA
13,NA,Ohio,,Airplane,700,No,NA,4,None,No damage
"""


@pytest.fixture()
def load(spark, tmp_path):
    p = tmp_path / "birds.csv"
    p.write_text(CSV_TEXT)
    raw = CSV.read_csv_text(spark, str(p), STL.CSV_FIELDS)
    return STL.StrikesLoad(raw, ["rid"])


def test_csv_missing_rules(spark, tmp_path):
    p = tmp_path / "b.csv"
    p.write_text(CSV_TEXT)
    raw = {r.rid: r for r in CSV.read_csv_text(spark, str(p)).collect()}
    assert raw["13"].airline == ""          # blank stays blank
    assert raw["12"].airline is None        # NA is missing
    assert raw["10"].altitude_ft == "1,500"


def test_dimensions(load):
    assert sorted(tuple(r) for r in load.airports.collect()) == [
        (1, "Texas", None), (2, "unknown", None), (3, "Ohio", None)]
    assert sorted((r.cid, r.sky_condition) for r in load.conditions.collect()) == [
        (1, "No Cloud"), (2, None), (3, "Overcast")]


def test_flights_and_strikes(load):
    f = {r.fid: r for r in load.flights.collect()}
    assert f[10].date == dt.date(2000, 4, 11) and f[10].altitude == 1500 and f[10].heavy == 1
    assert f[11].aircraft == "Unknown" and f[11].altitude == 0
    assert f[12].origin is None            # null origin does not find 'unknown' (Q3)
    assert f[12].airline == "Unknown" and f[12].heavy is None
    assert f[13].date is None and f[13].airline == ""
    s = {r.fid: r for r in load.strikes.collect()}
    assert sorted(r.sid for r in s.values()) == [1, 2, 3, 4]
    assert s[11].conditions == 2 and s[13].conditions == 2   # null matches null (J4)
    assert s[12].damage is None and s[10].damage == 1


def test_reports(load):
    st, fl, ap = load.strikes, load.flights, load.airports
    by_state = sorted(tuple(r) for r in R.strikes_by_state(st, fl, ap, count_col="sid").collect())
    assert by_state == [(1, "Ohio"), (2, "Texas")]
    by_month = {r.month: r.birds for r in R.strikes_by_month(st, fl).collect()}
    assert by_month == {"04": 7, "05": 1, None: 4}
    above = [tuple(r) for r in R.above_avg_airlines(st, fl, count_col="sid").collect()]
    assert above == [(2, "A")]
    avg = R.avg_strikes_per_airline(st, fl, count_col="sid").first()[0]
    assert abs(avg - 4 / 3) < 1e-9


def test_upsert_twice_adds_no_dimension_rows(spark, load):
    batch = spark.createDataFrame(
        [(1, dt.date(2023, 6, 24), "Nevada", "Airplane", 1000, 12, "No Cloud")],
        "bord int, date date, origin string, aircraft string, altitude int, "
        "numbirds int, conditions string")
    one = U.record_strikes(batch, load.airports, load.flights, load.strikes,
                           load.conditions, ["bord"])
    new_air = [tuple(r) for r in one["airports"].where("aid > 3").collect()]
    assert new_air == [(4, "Nevada", None)]
    new_strike = one["strikes"].where("sid > 4").collect()
    assert [(r.sid, r.numbirds, r.impact, r.damage, r.conditions) for r in new_strike] == [
        (5, 12, "N/A", 0, 1)]
    two = U.record_strikes(batch, one["airports"], one["flights"], one["strikes"],
                           load.conditions, ["bord"])
    assert two["airports"].count() == 4
    assert two["flights"].count() == one["flights"].count()
    assert two["strikes"].count() == 6

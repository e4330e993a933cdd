"""The upsert applied per micro-batch of a file stream."""
import datetime as dt

from martforge.plans import strikes_load as STL
from martforge.sources import csv as CSV
from martforge.streaming import upsert_stream as S

from test_strikes_load import CSV_TEXT

SCHEMA = ("bord int, date date, origin string, aircraft string, altitude int, "
          "numbirds int, conditions string")


def test_stream_upsert_is_incremental_and_idempotent(spark, tmp_path):
    p = tmp_path / "birds.csv"
    p.write_text(CSV_TEXT)
    load = STL.StrikesLoad(CSV.read_csv_text(spark, str(p), STL.CSV_FIELDS), ["rid"])
    root = str(tmp_path / "tables")
    S.init_tables({"airports": load.airports, "flights": load.flights,
                   "strikes": load.strikes, "conditions": load.conditions}, root)
    inbox = tmp_path / "inbox"
    spark.createDataFrame(
        [(1, dt.date(2023, 6, 24), "Nevada", "Airplane", 1000, 12, "No Cloud"),
         (2, dt.date(2023, 6, 25), "Texas", "Airplane", 500, 3, None)], SCHEMA
    ).write.parquet(str(inbox / "b1"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(inbox / "*"))
    q = S.upsert_stream(stream, root, ["bord"], checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    t = S.read_tables(spark, root)
    assert sorted(r.airportState for r in t["airports"].collect()) == [
        "Nevada", "Ohio", "Texas", "unknown"]
    strikes = sorted((r.sid, r.numbirds, r.conditions) for r in t["strikes"].where("sid > 4").collect())
    assert strikes == [(5, 12, 1), (6, 3, 2)]
    # Replaying the same epoch replaces its own partition: no duplicates.
    batch = spark.read.parquet(str(inbox / "b1"))
    S.upsert_batch(batch, 0, root, ["bord"])
    t2 = S.read_tables(spark, root)
    assert t2["strikes"].count() == 6 and t2["airports"].count() == 4


def test_a_restart_goes_on_after_the_earlier_epochs(spark, tmp_path):
    p = tmp_path / "birds.csv"
    p.write_text(CSV_TEXT)
    load = STL.StrikesLoad(CSV.read_csv_text(spark, str(p), STL.CSV_FIELDS), ["rid"])
    root = str(tmp_path / "tables")
    S.init_tables({"airports": load.airports, "flights": load.flights,
                   "strikes": load.strikes, "conditions": load.conditions}, root)
    for n, state in enumerate(("Texas", "Utah")):  # another source folder each time, no checkpoint named
        inbox = str(tmp_path / f"inbox{n}")
        spark.createDataFrame([(1, dt.date(2023, 6, 24), state, "Airplane", 1000, 12 + n, "No Cloud")], SCHEMA).write.parquet(f"{inbox}/b")
        S.upsert_stream(spark.readStream.schema(SCHEMA).parquet(f"{inbox}/*"), root, ["bord"]).awaitTermination(300)
    t = S.read_tables(spark, root)
    assert sorted((r.sid, r.numbirds) for r in t["strikes"].where("sid > 4").collect()) == [(5, 12), (6, 13)]
    states = [(r.aid, r.airportState) for r in t["airports"].collect()]
    assert {"Texas", "Utah"} <= {s for _, s in states} and len({a for a, _ in states}) == len(states)

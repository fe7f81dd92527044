from pathlib import Path
import os

from tracklens.operators.filters import exclude_mmsi_prefix
from tracklens.sources.ais_csv import read_ais_csv
from tracklens.sources.store import read_pings, write_pings

HEADER = "# Timestamp,Type of mobile,MMSI,Latitude,Longitude,Navigational status,ROT,SOG,COG,Heading,IMO,Callsign,Name,Ship type,Extra\n"


def _csv(scratch, lines):
    d = os.path.join(scratch, "csv")
    os.makedirs(d)
    with open(os.path.join(d, "aisdk-2021-12-13.csv"), "w") as f:
        f.write(HEADER)
        for line in lines:
            f.write(line + "\n")
    return d


def test_csv_parse_and_bad_rows(spark, scratch):
    d = _csv(
        scratch,
        [
            "13/12/2021 02:27:29,Class A,219021240,55.223079,14.243707,Under way,0,9.5,233.1,230,Unknown,OXRW2,NORTHERN GULL,Cargo,x",
            "bad,Class A,219021241,55.0,14.0,Under way,0,1,1,1,Unknown,X,A,Cargo,x",
            "13/12/2021 02:27:30,Class A,abc,55.0,14.0,Under way,0,1,1,1,Unknown,X,A,Cargo,x",
            "13/12/2021 02:27:31,Class A,219021242,91,14.0,Under way,0,1,1,1,Unknown,X,A,Cargo,x",
            "13/12/2021 02:27:32,Class A,219021243,0,0,Under way,0,1,1,1,Unknown,X,A,Cargo,x",
            "13/12/2021 02:27:33,Class B,219021244,0,5,Under way,0,n/a,,1,Unknown,X,,Cargo,x",
        ],
    )
    rows = read_ais_csv(spark, d).orderBy("ts_unix").collect()
    assert [r.mmsi for r in rows] == [219021240, 219021244]
    first = rows[0]
    assert first.ts_unix == 1639362449
    assert first.name == "NORTHERN GULL" and first.mobile_type == "Class A" and first.ship_type == "Cargo"
    assert abs(first.sog - 9.5) < 1e-12 and abs(first.cog - 233.1) < 1e-12
    last = rows[1]
    assert last.sog is None and last.cog is None and last.name is None


def test_mmsi_prefix_after_long_cast(spark, scratch):
    d = _csv(
        scratch,
        [
            f"13/12/2021 02:27:29,Class A,{m},55.2,14.2,Under way,0,1,1,1,Unknown,X,A,Cargo,x"
            for m in ("111219501", "001110000", "219021240")
        ],
    )
    kept = [r.mmsi for r in exclude_mmsi_prefix(read_ais_csv(spark, d)).collect()]
    assert kept == [219021240]


def test_parquet_store_round_trip(spark, scratch):
    from tests.helpers import pings

    df = pings(spark, [{"t": 0, "lat": 55.0}, {"t": 86400, "lat": 55.1}], with_id=False)
    path = os.path.join(scratch, "store")
    write_pings(df, path)
    back = read_pings(spark, path)
    assert back.count() == 2
    assert "day" in back.columns
    assert sorted(r.lat for r in back.collect()) == [55.0, 55.1]


def test_rejects_and_pings_make_up_the_file(spark, scratch):
    from tracklens.sources.ais_csv import read_ais_csv, split_ais_csv

    header = "# Timestamp,Type of mobile,MMSI,Latitude,Longitude,Navigational status,SOG,COG,Name,Ship type"
    good = "01/12/2021 01:00:00,Class A,{},55.1,14.1,Under way,7.5,90,Boat,Cargo"
    lines = [
        good.format(1),
        good.format(2) + ",surplus",  # malformed, but all that is needed is there
        "01/12/2021 01:00:00,Class A,3,55.1",  # cut off
        good.format(4).replace("01/12", "41/12"),
        good.format("n/a"),
        good.format(6).replace("55.1", "95.1"),
        good.format(7).replace("55.1,14.1", "0,0"),
        good.format(8).replace("7.5", "fast"),
        good.format(9).replace("55.1", ""),
        ",,,,,,,,,",
    ]
    path = Path(scratch) / "in"
    path.mkdir()
    for k in range(2):
        (path / f"{k}.csv").write_text("\n".join([header, *lines[k * 5 : k * 5 + 5]]) + "\n")
    accepted, rejected = split_ais_csv(spark, str(path), f"{scratch}/out")
    assert accepted.columns == read_ais_csv(spark, str(path)).columns
    assert sorted(map(tuple, accepted.collect())) == sorted(map(tuple, read_ais_csv(spark, str(path)).collect()))
    assert sorted(r.mmsi for r in accepted.collect()) == [1, 2, 8]
    got = {(r.mmsi, r.reason) for r in rejected.collect()}
    assert got == {
        ("3", "malformed line"), ("4", "bad time"), ("n/a", "bad number"), ("6", "out of range"),
        ("7", "position (0, 0)"), ("9", "bad number"), (None, "bad time"),
    }
    assert accepted.count() + rejected.count() == len(lines)
    assert [r._line for r in rejected.where("reason = 'malformed line'").collect()] == [lines[2]]


def test_fixture_stays_inside_the_window(spark):
    from pyspark.sql import functions as F

    from tracklens.operators.filters import select_pings, time_window
    from tracklens.sources.fixture import pings_from_events

    share = {}
    for start in (0, 6_000_000, 50_000_000, 416_000_000):
        events = spark.range(start, start + 20_000).select(F.col("id").alias("event_id"), F.lit("click").alias("event_type"), (F.col("id") % 97 / 10.0).alias("value"))
        fixture = pings_from_events(spark, events)
        share[start] = (time_window(fixture).count(), round(select_pings(fixture).count() / 1000))
    assert len(set(share.values())) == 1, share

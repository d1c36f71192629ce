"""Wire codec edge cases: payload mapping, JSON decode, round trip."""

import json

from pyspark.sql import functions as F

from contrail.sources.wire import normalize_states, parse_wire, payload_json, to_wire_json


def _vec(callsign="AB12   ", n=18):
    v = ["abc123", callsign, "France", 1700000000, 1700000001, 2.5, 48.75, 1000.5, False, 200.25,
         90.0, -5.5, None, 1010.0, "1234", False, 0, 3]
    return v[:n]


def test_normalize_states(spark):
    payloads = [
        json.dumps({"time": 1700000005, "states": [_vec(), _vec("", 17), _vec("   ")]}),
        json.dumps({"time": 1700000006, "states": None}),
        json.dumps({"time": 1700000007}),
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "value string")
    rows = normalize_states(df).collect()
    assert len(rows) == 3
    a, b, c = rows
    assert (a.time, a.icao24, a.callsign, a.latitude, a.on_ground, a.category) == \
        (1700000005, "abc123", "AB12", 48.75, False, 3)
    assert a.geo_altitude == 1010.0 and a.squawk == "1234" and a.position_source == 0
    assert b.callsign is None and b.category is None          # empty callsign, 17-field vector
    assert c.callsign == ""                                    # blank callsign stays ''


def test_parse_wire_bad_input(spark):
    good = {"time": 1, "icao24": "x", "velocity": 10.5, "on_ground": True, "extra": "ignored"}
    values = [json.dumps(good), "{not json", json.dumps({"time": "abc", "icao24": "y"}), None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    rows = parse_wire(df).collect()
    assert len(rows) == 4
    assert (rows[0].time, rows[0].icao24, rows[0].velocity, rows[0].on_ground, rows[0].latitude) == \
        (1, "x", 10.5, True, None)
    assert all(v is None for v in rows[1])                     # malformed JSON -> all NULL
    assert rows[2].time is None                                # wrong type -> NULL field
    assert all(v is None for v in rows[3])                     # NULL value


def test_round_trip_keeps_nulls(spark):
    payload = spark.createDataFrame([(json.dumps({"time": 5, "states": [_vec(), _vec(None)]}),)], "value string")
    records = normalize_states(payload)
    text = to_wire_json(records).collect()[0].value
    assert '"callsign":"AB12"' in text and '"vertical_rate":-5.5' in text
    key = lambda r: tuple((v is None, str(v)) for v in r)
    back = parse_wire(to_wire_json(records))
    assert sorted(back.collect(), key=key) == sorted(records.collect(), key=key)
    again = normalize_states(payload_json(records))
    assert sorted(again.collect(), key=key) == sorted(records.collect(), key=key)


def test_binary_value(spark):
    df = spark.createDataFrame([(bytearray(b'{"time": 7, "icao24": "z"}'),)], "value binary")
    r = parse_wire(df).first()
    assert (r.time, r.icao24) == (7, "z")
    assert df.select(F.col("value").cast("string")).first()[0].startswith("{")


def test_airport_csv_reader(spark, tmp_dir):
    import os

    from contrail.sources.tables import read_airports

    path = os.path.join(tmp_dir, "airports.csv")
    with open(path, "w") as fh:
        fh.write("id,ident,type,name,latitude_deg,longitude_deg,iso_country\n")
        fh.write("1,LFPG,large_airport,Paris CDG,49.0097,2.5479,FR\n")
        fh.write("2,XSML,small_airport,Tiny,1.0,2.0,FR\n")
        fh.write("3,LFBD,medium_airport,Bordeaux,not-a-number,-0.7156,FR\n")
    rows = sorted(read_airports(spark, path).collect())
    assert [r.airport_icao for r in rows] == ["LFBD", "LFPG"]
    assert rows[0].airport_lat is None and rows[1].airport_lat == 49.0097 and rows[1].airport_country == "FR"

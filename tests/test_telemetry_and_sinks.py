import pytest
from pyspark.sql import functions as F

from netloom.functions import exprs
from netloom.operators.counters import COUNTERS, counter_deltas, device_rows, interface_rows
from netloom.schemas import DEVICE_COLUMNS, INTERFACE_COLUMNS
from netloom.sources import sinks, telemetry

DDL = "device string, if_index int, if_name string, oper_status string, epoch double, speed_bps long, " + ", ".join(f"{c} decimal(20,0)" for c in COUNTERS)


def samples(spark, values, speed, dt=10.0):
    from decimal import Decimal

    rows = [("d", 1, "e", "up", 100.0 + dt * k, speed, *[None if v is None else Decimal(v)] * 8) for k, v in enumerate(values)]
    return spark.createDataFrame(rows, DDL)


@pytest.mark.parametrize("old,new,dt,speed,delta,reset", [
    (100, 400, 10.0, 0, 300, 0), (2**32 - 1000, 500, 1.0, 10**9, 1500, 0), (900_000_000_000, 5, 1.0, 10**9, 0, 1), (2**32 - 10, 2**31, 1.0, 10**6, 0, 1), (None, 5, 1.0, 0, None, 0), (5, None, 1.0, 0, None, 0),
])
def test_counter_rules(spark, old, new, dt, speed, delta, reset):
    first, second = counter_deltas(samples(spark, [old, new], speed, dt)).orderBy("epoch").collect()
    assert first["first_sample"] and first["in_octets_delta"] is None and first["interval_s"] is None
    assert (second["in_octets_delta"], second["counter_reset"]) == (delta, reset)


def test_interface_and_device_rows(spark):
    s = counter_deltas(samples(spark, [0, 1_250_000], 10_000_000))
    rows = interface_rows(s)
    assert rows.columns == INTERFACE_COLUMNS
    last = rows.orderBy(F.desc("epoch")).first()
    assert (last["in_bytes_per_s"], last["utilisation_in_pct"]) == (125_000.0, 10.0)
    polls = spark.createDataFrame([("d", 100.0, True), ("d", 110.0, True), ("d", 120.0, False)], "device string, epoch double, reachable boolean")
    dev = device_rows(polls, s)
    assert dev.columns == DEVICE_COLUMNS
    a, b, c = dev.orderBy("epoch").collect()
    assert a["in_bytes_per_s"] is None and a["interfaces_up"] == 1
    assert (b["in_bytes_per_s"], b["in_packets_per_s"], b["reachable"]) == (125_000.0, 125_000.0, 1)
    assert c["reachable"] == 0 and c["interfaces_total"] is None and c["counter_resets"] is None


def test_nxapi_object_or_list_and_eapi_memory(spark):
    row = '{"interface":"e1","state":"up","eth_bw":1000,"eth_inbytes":"5"}'
    body = '{"ins_api":{"outputs":{"output":{"body":{"TABLE_interface":{"ROW_interface":%s}}}}}}'
    df = spark.createDataFrame([("d", 1.0, body % row), ("d", 2.0, body % f"[{row},{row}]"), ("d", 3.0, "not json"), ("d", 4.0, None)], "device string, epoch double, body string")
    assert telemetry.nxapi_interfaces(df).groupBy("epoch").count().orderBy("epoch").collect() == [(1.0, 1), (2.0, 2)]
    e = spark.createDataFrame([("d", 1.0, '{"result":[{"memTotal":8,"memFree":2,"uptime":5.04,"modelName":"M"}]}')], df.schema)
    r = telemetry.eapi_devices(e).first()
    assert (r["memory_percent"], r["uptime_s"]) == (75.0, 5.0)


def test_scalar_functions(spark):
    row = spark.range(1).select(
        exprs.octet_text(F.lit(b"abc")).alias("a"), exprs.octet_text(F.lit(b"\x00\xff")).alias("b"), exprs.safe_stem(F.lit("a b/ü.x")).alias("c"), exprs.number_or(F.lit("1,234.5")).alias("d"), exprs.number_or(F.lit("x"), 3.0).alias("e"),
        exprs.whole_or(F.lit("-1.9")).alias("f"), exprs.safe_ratio(F.lit(1), F.lit(0)).alias("g"), exprs.proto_name(F.lit(99)).alias("h"), exprs.parse_timestamp(F.lit("1970-01-01T00:00:10Z")).alias("i"), exprs.floor_bucket(F.lit(-1.5), 60).alias("j"),
    ).first()
    assert tuple(row) == ("abc", "00:ff", "a_b_ü.x", 1234.5, 3.0, -1, 0.0, "99", 10.0, -60)


SCOPES = {"127.0.0.1": "loopback", "10.1.2.3": "private", "172.32.0.1": "public", "255.255.255.255": "broadcast", "240.1.1.1": "reserved", "100.64.0.1": "cgnat", "::": "unspecified", "::1": "loopback", "fe80::1%eth0": "link-local", "fd00::1": "private", "ff02::1": "multicast", "2001:db8::1": "reserved", "2001:4860:4860::8888": "public", "::ffff:1.2.3.4": "reserved", "1.2.3": "invalid", "": "invalid", "::1::2": "invalid", None: None}


def test_address_scopes(spark):
    df = spark.createDataFrame([(k,) for k in SCOPES], "ip string")
    got = {r["ip"]: r["s"] for r in df.select("ip", exprs.address_scope(F.col("ip")).alias("s")).collect()}
    assert got == SCOPES


def test_csv_sink(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("=cmd", 1.5, True), ("ok", float("nan"), False), (None, float("inf"), None)], "a string, b double, c boolean")
    assert sinks.write_csv(df, path) == path and sinks.write_csv(df, path) == path
    got = sinks.read_csv(spark, path, ["a", "b", "c"])
    assert got.count() == 6 and got.where("a = \"'=cmd\" AND b = '1.5' AND c = '1'").count() == 2
    assert got.where("b IS NULL").count() == 4
    assert sinks.read_csv(spark, path, ["a", "b", "c"], limit=2).count() == 2
    other = df.select("a", "b")
    assert sinks.write_csv(other, path) == path + ".1"
    with pytest.raises(sinks.SchemaChanged):
        sinks.write_csv(other, path, on_change="error")
    assert sinks.read_csv(spark, str(tmp_path / "none"), ["a"]).count() == 0


def test_retention(spark):
    files = spark.createDataFrame([("a", 10, 1), ("b", 10, 2), ("c", 10, 3)], "path string, length long, modified long")
    assert [r["path"] for r in sinks.retention(files, 20).collect()] == ["a"]
    assert sorted(r["path"] for r in sinks.retention(files, 100, min_modified=3).collect()) == ["a", "b"]
    assert [r["path"] for r in sinks.retention(files, 10, protect=("a",)).collect()] == ["b"]


def test_running_total_over_ranges(spark, tmp_path):
    """Many ranges, ties in the order's first column, nulls; no exchange brings all rows together."""
    from pyspark.sql import functions as F

    rows = [(f"f{k:04}", k * 7 % 113 if k % 10 else None, k % 17) for k in range(2000)]
    df = spark.createDataFrame(rows, "path string, length long, modified long")
    made = sinks.running_total(df, "length", [F.desc("modified"), F.desc("path")], "newer")
    total, want = 0, {}
    for path, length, _ in sorted(rows, key=lambda r: (r[2], r[0]), reverse=True):
        total += length or 0
        want[path] = total
    assert {r["path"]: r["newer"] for r in made.collect()} == want
    assert "SinglePartition" not in made._jdf.queryExecution().toString()
    for k in range(6):
        (tmp_path / f"f{k}").write_bytes(b"x" * 10)
    assert sinks.apply_retention(spark, str(tmp_path), 25) == 4 and len(list(tmp_path.iterdir())) == 2


def test_networks_of_both_families(spark):
    """One wide IPv6 range is many rows once it is cut, and is counted so before it is sent anywhere."""
    from netloom.operators import enrichment

    v6 = spark.createDataFrame([("2" + "0" * 31, "3" + "f" * 31, 64500, "wide", "NL")], "start string, end string, asn long, org string, country string")
    rows = spark.createDataFrame([("8.8.8.8", "2001:db8::1"), ("8.8.8.8", "2a00::5"), ("8.8.8.8", "fe80::1")], "src_ip string, dst_ip string")
    got = {r["dst_ip"]: r["dst_asn"] for r in enrichment.enricher(None, v6)(rows).collect()}
    assert got["2a00::5"] == "AS64500" and got["fe80::1"] == ""
    first, last = enrichment._prefix_v6("start"), enrichment._prefix_v6("end")
    assert not enrichment._few(v6, first, last) and enrichment._few(v6.where("false"), first, last)

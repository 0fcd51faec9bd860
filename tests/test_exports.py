import random
import socket
import struct

import frames as b
from netloom.operators import netflow, sflow
from netloom.operators.counters import counter_deltas
from netloom.schemas import NETFLOW_COLUMNS, SFLOW_COLUMNS

DDL = "recv_us long, exporter string, dst_port int, payload binary"


def rows(spark, payloads, decode):
    data = [(1_700_000_000_000_000 + k * 1_000_000, e, 2055, bytearray(p)) for k, (e, p) in enumerate(payloads)]
    return [r.asDict() for r in decode(spark.createDataFrame(data, DDL)).collect()]


def v5(records, count=None, sampling=0):
    head = struct.pack("!HHIIIIBBH", 5, len(records) if count is None else count, 10_000, 1_700_000_000, 0, 0, 0, 0, sampling)
    return head + b"".join(socket.inet_aton(s) + socket.inet_aton(d) + b"\0" * 4 + struct.pack("!HHIIIIHHBBBBHHBBH", 1, 2, 7, 900, 2000, 9000, sp, dp, 0, 18, pr, 0, 65001, 65002, 24, 24, 0) for s, d, sp, dp, pr in records)


def test_v5(spark):
    got = rows(spark, [("x", v5([("10.0.0.1", "8.8.8.8", 5000, 53, 17), ("10.0.0.2", "8.8.4.4", 5001, 443, 6)], count=500, sampling=0x4000 | 100))], netflow.flow_exports)
    assert list(got[0]) == NETFLOW_COLUMNS and len(got) == 2
    assert (got[0]["duration_s"], got[0]["sampling_rate"], got[0]["src_asn"], got[0]["protocol_name"]) == (7.0, 100, 65001, "UDP")


FIELDS = [(8, 4), (12, 4), (7, 2), (11, 2), (4, 1), (6, 1), (2, 4), (1, 4)]


def flow_set(number, body):
    return struct.pack("!HH", number, 4 + len(body)) + body


def template(fields, number=256):
    return struct.pack("!HH", number, len(fields)) + b"".join(struct.pack("!HH", *f) for f in fields)


def v9(*sets, domain=1):
    return struct.pack("!HHIIII", 9, len(sets), 10_000, 1_700_000_000, 0, domain) + b"".join(sets)


def ipfix(*sets, domain=1):
    body = b"".join(sets)
    return struct.pack("!HHIII", 10, 16 + len(body), 1_700_000_000, 0, domain) + body


def record(src="10.0.0.1", size=900):
    return socket.inet_aton(src) + socket.inet_aton("8.8.8.8") + struct.pack("!HHBBII", 5000, 53, 17, 0, 7, size)


def test_v9_template_lives_per_exporter_and_padding_is_left_out(spark):
    short = [(8, 4), (12, 4), (1, 8)]
    got = rows(spark, [
        ("early", v9(flow_set(256, record()))), ("a", v9(flow_set(0, template(FIELDS)))), ("b", v9(flow_set(0, template(short)))),
        ("a", v9(flow_set(256, record() + b"\0\0"))), ("b", v9(flow_set(256, socket.inet_aton("10.0.0.9") * 2 + struct.pack("!Q", 5)))),
    ], netflow.flow_exports)
    assert {(r["exporter"], r["src_ip"], r["bytes"]) for r in got} == {("a", "10.0.0.1", 900), ("b", "10.0.0.9", 5)}


def test_template_ttl(spark):
    p = [("a", v9(flow_set(0, template(FIELDS)))), ("a", v9(flow_set(256, record())))]
    assert rows(spark, p, lambda d: netflow.flow_exports(d, ttl_s=0)) == []
    waiting = rows(spark, p, lambda d: netflow.awaiting_template(netflow.export_sets(d), ttl_s=0))
    assert waiting == [{"exporter": "a", "domain": 1, "template_id": 256, "sets": 1}]


def test_ipfix_milliseconds_ipv6_enterprise_and_variable_length(spark):
    fields = struct.pack("!HH", 256, 6) + b"".join(struct.pack("!HH", *f) for f in [(27, 16), (28, 16), (152, 8), (153, 8)]) + struct.pack("!HHI", 0x8001, 0xFFFF, 9) + struct.pack("!HH", 85, 8)
    data = socket.inet_pton(socket.AF_INET6, "2001:db8::1") + socket.inet_pton(socket.AF_INET6, "::2") + struct.pack("!QQ", 1_000_000, 1_012_500) + b"\x03abc" + struct.pack("!Q", 77)
    (r,) = rows(spark, [("x", ipfix(flow_set(2, fields), flow_set(256, data)))], netflow.flow_exports)
    assert (r["src_ip"], r["dst_ip"], r["duration_s"], r["bytes"], r["ip_version"]) == ("2001:db8::1", "::2", 12.5, 77, 6)


def test_options_data_is_no_flow(spark):
    options = struct.pack("!HHHHHHH", 300, 4, 4, 1, 4, 34, 4)
    got = rows(spark, [("x", v9(flow_set(1, options), flow_set(300, struct.pack("!II", 1, 100))))], netflow.flow_exports)
    assert got == []


def test_other_datagrams_are_reported(spark):
    rng = random.Random(2)
    bad = [("x", struct.pack("!H", v) + b"\0" * 30) for v in (1, 7, 8, 99)] + [("x", b"")] + [("x", bytes(rng.randrange(256) for _ in range(rng.randrange(60)))) for _ in range(200)]
    rows(spark, bad, netflow.flow_exports)
    reasons = [r["reason"] for r in rows(spark, bad[:5], netflow.export_errors)]
    assert reasons == ["unsupported version 1", "unsupported version 7", "unsupported version 8", "unknown version 99", "too short"]


def u32(*x):
    return struct.pack(f"!{len(x)}I", *x)


def sample(expanded=False):
    header = b.ether(b.ipv4(b.tcp(b"sixteen and more", 40_001, 8443), 6, "172.20.3.4", "203.0.113.9"))
    raw = u32(1, 1500, 4, len(header)) + header + b"\0" * (-len(header) % 4)
    rec = u32(1, len(raw)) + raw
    ids = u32(0, 1) if expanded else u32(1)
    ports = u32(0, 3, 0, 4) if expanded else u32(3, 4)
    body = u32(9) + ids + u32(1024, 2048, 0) + ports + u32(1) + rec
    return u32(3 if expanded else 1, len(body)) + body


def counter():
    body = u32(11, 6) + struct.pack("!Q", 10**10) + u32(1, 3) + struct.pack("!Q", 2**63 + 5) + u32(*range(6)) + struct.pack("!Q", 7) + u32(*range(6))
    rec = u32(1, len(body) + 4) + body + u32(0)
    whole = u32(1, 1, 1) + rec
    return u32(2, len(whole)) + whole


def datagram(*samples, count=None, version=5):
    return u32(version, 1) + socket.inet_aton("192.0.2.1") + u32(0, 1, 1000, len(samples) if count is None else count) + b"".join(samples)


def test_sflow_samples(spark):
    a, e = rows(spark, [("x", datagram(sample())), ("x", datagram(sample(True)))], sflow.sflow_samples)
    assert list(a) == SFLOW_COLUMNS
    assert {k: v for k, v in a.items() if k not in ("epoch", "timestamp")} == {k: v for k, v in e.items() if k not in ("epoch", "timestamp")}
    assert (a["src_ip"], a["dst_port"], a["sampling_rate"], a["input_if"], a["frame_length"], a["protocol_name"]) == ("172.20.3.4", 8443, 1024, 3, 1500, "TCP")
    assert 0 < a["payload_entropy"] < 8


def test_sflow_counters_feed_the_deltas(spark):
    got = rows(spark, [("x", datagram(counter()))] * 2, lambda d: counter_deltas(sflow.sflow_counters(d)))
    assert {r["if_name"] for r in got} == {"ifIndex11"} and sorted(r["first_sample"] for r in got) == [False, True]
    assert {(r["in_octets"], r["oper_status"], r["admin_status"]) for r in got} == {(2**63 + 5, "up", "up")}
    assert [r["in_octets_delta"] for r in got if not r["first_sample"]] == [0]


def test_sflow_is_total():
    whole = datagram(sample(), counter())
    assert sflow.decode_sflow(datagram(sample(), version=4)) is None
    assert len(sflow.decode_sflow(datagram(sample(), count=2**31))["samples"]) == 1
    for cut in range(0, len(whole), 7):
        sflow.decode_sflow(whole[:cut])


def test_datagrams_of_one_instant_keep_their_order(spark):
    """A template that came first serves the data set behind it, though both have one time and many sets came before."""
    sets = [(5, 0, 0, "e", 9, 1, 0.0, 0.0, 300, [(8, 4)], 0, None), (5, 0, 1 << 20, "e", 9, 1, 0.0, 0.0, 300, None, None, b"a"), (5, 1, 0, "e", 9, 1, 0.0, 0.0, 300, [(12, 4)], 0, None), (5, 1, 1 << 20, "e", 9, 1, 0.0, 0.0, 300, None, None, b"b")]
    df = spark.createDataFrame(sets, netflow.SET)
    got = {bytes(r["body"]): r["template"][0]["element"] for r in netflow.with_template(df).collect()}
    assert got == {b"a": 8, b"b": 12}


def test_one_exporter_is_spread_over_tasks(spark):
    """Data sets of one exporter are joined where they are; templates that are sent again, change or go stale apply as they come."""
    fields = lambda k: [(k, 4)]
    sets = []
    for k in range(3000):
        us = k * 1_000_000
        if k % 50 == 0 and not 1000 < k < 1400:
            sets.append((us, 2 * k, "e", 9, 1, 0.0, 0.0, 256, fields(k // 600), 0, None))
        sets.append((us, 2 * k + 1, "e", 9, 1, 0.0, 0.0, 256, None, 0, bytes([1])))
    df = spark.createDataFrame(sets, netflow.SET.replace("arrival long, ", "")).repartition(6)
    found = netflow.with_template(df, ttl_s=100)
    want, last = {}, None
    for us, seq, *_, template, _, body in sets:
        if template:
            last = us, template[0][0]
        else:
            want[seq] = last[1] if us - last[0] <= 100_000_000 else None
    assert {r["seq"]: r["template"] and r["template"][0]["element"] for r in found.collect()} == want and None in want.values()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan
    assert netflow.template_intervals(df, ttl_s=100).select("starts").distinct().count() <= 8

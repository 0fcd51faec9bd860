"""Queries over frames, captures, datagrams and sinks: bytes are built from the packets, so SQL knows what they must decode to."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom import observe
from netloom.config import FlowParams
from netloom.functions import exprs
from netloom.functions.exprs import sample_variance as sample_variance_of
from netloom.operators import counters, flows, netflow, sflow
from netloom.plans import process
from netloom.plans.queries import CUT_FLOWS_SQL, CUTS, _COUNTER_SQL, _EXPORT_SQL, _INTERFACE, _frames, _hex, _interface_samples, _ip_hex, _unhex, _v9_datagrams, query
from netloom.schemas import INTERFACE_COLUMNS
from netloom.sources import adapters, decode, pcap, sinks, splits, telemetry, write_capture
from netloom.storage import materialize, scratch
from netloom.streaming import carry, jobs

# -- link layers and network headers ----------------------------------------

_MACS = "00" * 12
_SNAP = "AAAA03000000"
_WIFI = "0800" + "00" * 22
#: What stands before an IPv4 header: name, link type, bytes, VLAN id that is read.
LINKS = [
    ("ethernet", 1, _MACS + "0800", 0),
    ("vlan", 1, _MACS + "81002064" + "0800", 100),
    ("two vlans", 1, _MACS + "88A80007" + "81000064" + "0800", 7),
    ("mpls", 1, _MACS + "8847" + "00010040" + "00020140", 0),
    ("pppoe", 1, _MACS + "8864" + "110000010000" + "0021", 0),
    ("backbone", 1, _MACS + "88E7" + "00000001" + _MACS + "81000009" + "0800", 9),
    ("snap", 1, _MACS + "0100" + _SNAP + "0800", 0),
    ("cooked", 113, "00" * 14 + "0800", 0),
    ("cooked 2", 276, "0800" + "00" * 18, 0),
    ("loopback", 0, "02000000", 0),
    ("loopback of another order", 108, "00000002", 0),
    ("ppp", 9, "FF030021", 0),
    ("short ppp", 9, "21", 0),
    ("raw", 101, "", 0),
    ("raw ipv4", 228, "", 0),
    ("wifi", 105, _WIFI + _SNAP + "0800", 0),
    ("wifi with quality of service", 105, "8800" + "00" * 24 + _SNAP + "0800", 0),
    ("radiotap", 127, "00000800" + "00" * 4 + _WIFI + _SNAP + "0800", 0),
    ("unknown", 999, "", 0),
]
_NO_PACKET = [("arp", 1, _MACS + "0806", 0), ("wifi without data", 105, "0000" + "00" * 22 + _SNAP + "0800", 0)]


def _chosen(values: list, at: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (at + 1).cast("int"))


@query("link_layers", f"""
WITH {adapters.packets_sql()}, l(k, before, vlan) AS (VALUES {", ".join(f"({k}, {len(x[2]) // 2}, {x[3]})" for k, x in enumerate(LINKS))}),
n AS (SELECT *, pkt_seq % {len(LINKS) + len(_NO_PACKET)} AS k, payload_len + CASE WHEN proto = 6 THEN 40 ELSE 28 END AS size FROM packets)
SELECT pkt_seq, src_ip, dst_ip, src_port, dst_port, proto, tcp_flags, CAST(size + before AS INTEGER) AS frame_len, CAST(size AS INTEGER) AS ip_len, payload_len, CAST(vlan AS INTEGER) AS vlan_id FROM n JOIN l USING (k)
""")
def link_layers(spark, sf_dir):
    """The packets behind nineteen link layers; two kinds of frames hold no packet and give no row."""
    all_kinds = LINKS + _NO_PACKET
    at = F.col("pkt_seq") % len(all_kinds)
    data = F.concat(F.unhex(_chosen([x[2] for x in all_kinds], at)), F.expr("substring(data, 15)"))
    frames = _frames(spark, sf_dir).withColumns({"data": data, "linktype": _chosen([x[1] for x in all_kinds], at)})
    return adapters.named(decode.decode_frames(frames)).select("pkt_seq", "src_ip", "dst_ip", "src_port", "dst_port", "proto", "tcp_flags", "frame_len", "ip_len", "payload_len", "vlan_id")


@query("frames_without_packets", f"""
WITH {adapters.packets_sql()}, n AS (SELECT *, pkt_seq % {len(LINKS) + len(_NO_PACKET)} >= {len(LINKS)} AS skipped FROM packets)
SELECT capture_file, count(*) AS frames, count(*) FILTER (NOT skipped) AS packets, count(*) FILTER (skipped) AS skipped, round(count(*) FILTER (NOT skipped) / count(*), 6) AS decode_rate FROM n GROUP BY capture_file
""")
def frames_without_packets(spark, sf_dir):
    all_kinds = LINKS + _NO_PACKET
    at = F.col("pkt_seq") % len(all_kinds)
    data = F.concat(F.unhex(_chosen([x[2] for x in all_kinds], at)), F.expr("substring(data, 15)"))
    return decode.decode_report(_frames(spark, sf_dir).withColumns({"data": data, "linktype": _chosen([x[1] for x in all_kinds], at)}))


#: Extension headers before the transport header: the first's number, and their bytes with {} for the transport's number.
_EXTENSIONS = [(None, ""), (0, "{}00000000000000"), (60, "2B00000000000000" + "{}00000000000000"), (44, "{}00000100000001"), (51, "{}0400000000000000000000000000000000000000000000")]
_V6 = "20010DB8000100020003000400000000"


def _v6_text(number: str) -> str:
    return f"'2001:db8:1:2:3:4:' || format('{{:x}}', ({number}) // 65536) || ':' || format('{{:x}}', ({number}) % 65536)"


def _ip_number(ip: str) -> str:
    return " + ".join(f"CAST(split_part({ip}, '.', {k + 1}) AS BIGINT) * {256 ** (3 - k)}" for k in range(4))


@query("ipv6_headers", f"""
WITH {adapters.packets_sql()}, e(k, size) AS (VALUES {", ".join(f"({k}, {len(x[1].replace('{}', '00')) // 2})" for k, x in enumerate(_EXTENSIONS))})
SELECT pkt_seq, {_v6_text(_ip_number("src_ip"))} AS src_ip, {_v6_text(_ip_number("dst_ip"))} AS dst_ip, src_port, dst_port, proto, CAST(6 AS INTEGER) AS ip_version, ttl, tcp_flags,
       CAST(40 + size + payload_len + CASE WHEN proto = 6 THEN 20 ELSE 8 END AS INTEGER) AS ip_len, payload_len, k = 3 AS is_fragment
FROM packets JOIN e ON e.k = pkt_seq % {len(_EXTENSIONS)}
""")
def ipv6_headers(spark, sf_dir):
    """The packets as IPv6, with and without extension headers (options, routing, fragment, authentication)."""
    p = _frames(spark, sf_dir).join(adapters.packets(spark, sf_dir).select("pkt_seq", "src_ip", "dst_ip", "proto", "ttl"), "pkt_seq")
    at = F.col("pkt_seq") % len(_EXTENSIONS)
    proto = _hex(F.col("proto"), 1)
    extension = F.regexp_replace(_chosen([x[1] for x in _EXTENSIONS], at), r"\{\}", proto)
    first = F.coalesce(_hex(_chosen([x[0] for x in _EXTENSIONS], at), 1), proto)
    after = F.expr("substring(data, 35)")
    address = lambda c: F.concat(F.lit(_V6[:24]), _ip_hex(F.col(c)))
    length = (F.length(after) + F.length(extension) / 2).cast("long")
    head = _unhex(F.lit("86DD"), F.lit("60000000"), _hex(length, 2), first, _hex(F.col("ttl"), 1), address("src_ip"), address("dst_ip"), extension)
    frames = p.withColumn("data", F.concat(F.unhex(F.lit(_MACS)), head, after))
    return decode.decode_frames(frames).select("pkt_seq", "src_ip", "dst_ip", "src_port", "dst_port", "proto", "ip_version", "ttl", "tcp_flags", "ip_len", "payload_len", "is_fragment")


#: Transport headers: protocol, and bytes; SCTP has ports, ICMP type and code, GRE and others none.
_TRANSPORTS = [(132, "0BB8" + "0050" + "00" * 8, 3000, 80, 12), (1, "08010000" + "00000000", 8, 1, 8), (47, "00000800", 0, 0, 4), (89, "02010000", 0, 0, 0)]


@query("other_transports", f"""
WITH {adapters.packets_sql()}, t(k, number, sport, dport, header, size) AS (VALUES {", ".join(f"({k}, {x[0]}, {x[2]}, {x[3]}, {x[4]}, {len(x[1]) // 2})" for k, x in enumerate(_TRANSPORTS))})
SELECT pkt_seq, CAST(number AS INTEGER) AS proto, CAST(CASE WHEN later THEN 0 ELSE sport END AS INTEGER) AS src_port, CAST(CASE WHEN later THEN 0 ELSE dport END AS INTEGER) AS dst_port, CAST(pkt_seq % 40 + size - CASE WHEN later THEN 0 ELSE header END AS INTEGER) AS payload_len, later AS is_fragment
FROM (SELECT *, pkt_seq % 7 = 0 AS later FROM packets) p JOIN t ON t.k = pkt_seq % {len(_TRANSPORTS)}
""")
def other_transports(spark, sf_dir):
    """SCTP, ICMP, GRE and an unknown protocol; every seventh packet is a later fragment, which has no transport header."""
    p = adapters.packets(spark, sf_dir)
    at = F.col("pkt_seq") % len(_TRANSPORTS)
    head = _chosen([x[1] for x in _TRANSPORTS], at)
    rest = (F.col("pkt_seq") % 40).cast("int")
    fragment = F.when(F.col("pkt_seq") % 7 == 0, F.lit("0010")).otherwise(F.lit("0000"))
    size = F.length(head) / 2 + rest + 20
    data = _unhex(F.lit(_MACS + "0800" + "4500"), _hex(size, 2), F.lit("0000"), fragment, F.lit("40"), _hex(_chosen([x[0] for x in _TRANSPORTS], at), 1), F.lit("0000"), _ip_hex(F.col("src_ip")), _ip_hex(F.col("dst_ip")), head, F.repeat(F.lit("00"), rest))
    frames = p.select("capture_file", "pkt_seq", "ts_us", F.lit(1).alias("linktype"), data.alias("data"))
    return decode.decode_frames(frames).select("pkt_seq", "proto", "src_port", "dst_port", "payload_len", "is_fragment")


# -- capture files -------------------------------------------------------------

PER_FILE = 400
_FORMATS = write_capture.FORMATS
#: By number of the file: every seventh is cut off in its last frame, every eleventh is no capture.
_CUT, _BROKEN = 7, 11


def _capture_files(spark, sf_dir) -> DataFrame:
    """path, content: the packets' frames as capture files of all formats."""
    import pandas as pd

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pkt_seq")
        number = int(rows["file"].iloc[0])
        content = write_capture.capture(zip(rows["ts_us"].tolist(), rows["data"].tolist()), _FORMATS[number % len(_FORMATS)], cut=number % _CUT == 1)
        return pd.DataFrame({"path": [f"file{number}"], "content": [b"no capture" if number % _BROKEN == 2 else content]})

    frames = _frames(spark, sf_dir).withColumn("file", F.floor(F.col("pkt_seq") / PER_FILE))
    return frames.select("file", "pkt_seq", "ts_us", "data").groupBy("file").applyInPandas(write, "path string, content binary")


_FILES_SQL = f"""
WITH {adapters.packets_sql()}, f AS (SELECT *, CAST(floor(pkt_seq / {PER_FILE}.0) AS BIGINT) AS file, payload_len + CASE WHEN proto = 6 THEN 54 ELSE 42 END AS size FROM packets), n AS (
  SELECT *, row_number() OVER (PARTITION BY file ORDER BY pkt_seq) - 1 AS pos, lead(pkt_seq) OVER (PARTITION BY file ORDER BY pkt_seq) IS NULL AS is_last FROM f
), g AS (SELECT *, file % {_BROKEN} = 2 AS broken, file % {_CUT} = 1 AND is_last AS lost FROM n)"""


@query("capture_formats", _FILES_SQL + " SELECT 'file' || file AS capture_file, pos AS pkt_seq, ts_us, CAST(1 AS INTEGER) AS linktype, CAST(size AS INTEGER) AS cap_len, CAST(size AS INTEGER) AS orig_len FROM g WHERE NOT broken AND NOT lost")
def capture_formats(spark, sf_dir):
    """pcap of both byte orders and time units, pcapng with interface options, gzip and bzip2."""
    return pcap.split_captures(_capture_files(spark, sf_dir)).drop("data")


#: Packets a file, and bytes of a range, where captures are read in ranges.
PER_LARGE, RANGE = 2_500, 30_000
#: What every ninth frame carries: records of a capture, whose headers look like those of the file that holds them.
_NESTED = "00F1536500000000040000000400000041424344" * 6


@query("capture_ranges", f"""
WITH {adapters.packets_sql()}, n AS (SELECT *, CAST(floor(pkt_seq / {PER_LARGE}.0) AS BIGINT) AS file, payload_len + CASE WHEN proto = 6 THEN 54 ELSE 42 END + CASE WHEN pkt_seq % 9 = 0 THEN {len(_NESTED) // 2} ELSE 0 END AS size FROM packets)
SELECT reader, 'file' || file AS capture_file, row_number() OVER (PARTITION BY reader, file ORDER BY pkt_seq) - 1 AS pkt_seq, ts_us, CAST(1 AS INTEGER) AS linktype, CAST(size AS INTEGER) AS cap_len, CAST(size AS INTEGER) AS orig_len
FROM n, (VALUES ('source'), ('ranges')) r(reader)
""")
def capture_ranges(spark, sf_dir):
    """Large captures read in ranges of their bytes, by ``format("pcap")`` and by the job's own reader: captures inside frames do not mislead them."""
    import pandas as pd

    folder = scratch(spark, "captures")
    local = splits.local_path(folder)

    def write(rows: pd.DataFrame) -> pd.DataFrame:
        rows, number = rows.sort_values("pkt_seq"), int(rows["file"].iloc[0])
        os.makedirs(local, exist_ok=True)
        path = f"{local}/file{number}.pcap"
        with open(path, "wb") as out:
            out.write(write_capture.capture(zip(rows["ts_us"].tolist(), rows["data"].tolist()), ("pcap < us", "pcap > ns", "pcapng < us", "pcapng > ns")[number % 4]))
        return pd.DataFrame({"path": [path]})

    nested = F.when(F.col("pkt_seq") % 9 == 0, F.unhex(F.lit(_NESTED))).otherwise(F.unhex(F.lit("")))
    frames = _frames(spark, sf_dir).withColumns({"file": F.floor(F.col("pkt_seq") / PER_LARGE), "data": F.concat("data", nested)})
    paths = [r["path"] for r in frames.select("file", "pkt_seq", "ts_us", "data").groupBy("file").applyInPandas(write, "path string").collect()]
    pcap.register(spark)
    source = spark.read.format("pcap").option("splitBytes", RANGE).load("\n".join(sorted(paths)))
    ranges = pcap.read_captures(spark, folder, mode="FAILFAST", split_bytes=RANGE)
    both = source.withColumn("reader", F.lit("source")).unionByName(ranges.withColumn("reader", F.lit("ranges")))
    return both.withColumn("capture_file", F.regexp_extract("capture_file", r"(file\d+)\.pcap", 1)).drop("data")


@query("capture_reports", _FILES_SQL + f"""
SELECT 'file' || file AS capture_file, CASE WHEN bool_or(broken) THEN NULL ELSE list_extract(['{"', '".join(f.split(" ")[0] for f in _FORMATS)}'], CAST(file % {len(_FORMATS)} AS INTEGER) + 1) END AS format, count(*) FILTER (NOT broken AND NOT lost) AS packets,
       CAST(coalesce(sum(size) FILTER (NOT broken AND NOT lost), 0) AS BIGINT) AS bytes, min(ts_us) FILTER (NOT broken AND NOT lost AND pos = 0) AS first_us, max_by(ts_us, pos) FILTER (NOT broken AND NOT lost) AS last_us,
       bool_or(NOT broken AND lost) AS truncated, bool_or(broken) AS bad FROM g GROUP BY file
""")
def capture_reports(spark, sf_dir):
    """One row per file, broken ones too."""
    r = pcap.capture_reports(_capture_files(spark, sf_dir))
    return r.select("capture_file", "format", "packets", "bytes", "first_us", "last_us", "truncated", F.col("error").isNotNull().alias("bad"))


@query("extraction_results", _FILES_SQL + f"""
, u AS (SELECT *, least(src_ip || ':' || src_port, dst_ip || ':' || dst_port) AS lo, greatest(src_ip || ':' || src_port, dst_ip || ':' || dst_port) AS hi FROM g WHERE NOT broken AND NOT lost), fl AS (
  SELECT file, count(*) FILTER (n >= 2) AS flows, count(*) FILTER (n < 2) AS dropped FROM (SELECT file, lo, hi, proto, count(*) AS n FROM u GROUP BY ALL) GROUP BY file
), fs AS (SELECT file, count(*) FILTER (NOT broken AND NOT lost) AS packets, bool_or(NOT broken AND lost) AS truncated, bool_or(broken) AS bad FROM g GROUP BY file)
SELECT 'file' || file AS capture_file, packets, truncated, bad, CAST(0 AS BIGINT) AS skipped, CASE WHEN packets > 0 THEN 1.0 ELSE 0.0 END AS decode_rate, coalesce(flows, 0) AS flows, coalesce(dropped, 0) AS dropped, CAST(0 AS BIGINT) AS teardown FROM fs LEFT JOIN fl USING (file)
""")
def extraction_results(spark, sf_dir):
    """One row per capture file: read, decoded, assembled (no timeouts, flows of two packets or more)."""
    params = FlowParams(active_timeout_s=1e9, max_packets_per_flow=0, close_on_teardown=False, idle_mode="none", min_packets_per_flow=2)
    rows = process.extraction_results(materialize(_capture_files(spark, sf_dir), "captures"), params)
    return rows.select("capture_file", "packets", "truncated", F.col("error").isNotNull().alias("bad"), "skipped", "decode_rate", "flows", "dropped", "teardown")


def _listing(spark, sf_dir) -> DataFrame:
    e = adapters.events(spark, sf_dir)
    ending = _chosen([".pcap", ".pcapng", ".txt", ".pcap.part", ".pcap.gz"], F.col("event_id") % 5)
    hidden = F.when(F.col("event_id") % 7 == 0, ".").otherwise("")
    return e.select(F.concat(F.lit("/in/"), hidden, F.lit("c"), F.col("event_id").cast("string"), ending).alias("path"), F.floor("value").alias("length"), F.timestamp_micros("us").alias("modificationTime"))


_LISTING_SQL = """
WITH l AS (SELECT event_id, '/in/' || CASE WHEN event_id % 7 = 0 THEN '.' ELSE '' END || 'c' || event_id || list_extract(['.pcap', '.pcapng', '.txt', '.pcap.part', '.pcap.gz'], CAST(event_id % 5 AS INTEGER) + 1) AS path, CAST(floor(value) AS BIGINT) AS length, epoch_us(ts) AS us FROM events)"""


@query("stable_files", _LISTING_SQL + " SELECT path, length FROM l WHERE event_id % 7 <> 0 AND event_id % 5 IN (0, 1, 4) AND length > 0 AND us <= (SELECT max(us) FROM l) - 86400000000")
def stable_files(spark, sf_dir):
    """Of files with different endings, hidden and empty ones too, those unchanged for a day."""
    files = _listing(spark, sf_dir)
    now = files.agg(F.max("modificationTime")).first()[0]
    return pcap.stable_files(files, F.lit(now), 86_400).select("path", "length")


@query("unseen_files", _LISTING_SQL + " SELECT path, length FROM l WHERE event_id % 4 <> 0 OR event_id % 8 = 4")
def unseen_files(spark, sf_dir):
    """Every fourth file was processed, but every second of these has other content now."""
    files, number = _listing(spark, sf_dir), F.regexp_extract("path", r"c(\d+)", 1).cast("long")
    seen = files.where(number % 4 == 0).withColumn("length", F.when(number % 8 == 4, F.col("length") + 1).otherwise(F.col("length")))
    return jobs.unseen(files, seen).select("path", "length")


@query("observed_counts", f"WITH {adapters.packets_sql()} SELECT count(*) AS rows, count(*) FILTER (proto = 6) AS tcp, count(*) FILTER (payload_len = 0) AS empty FROM packets")
def observed_counts(spark, sf_dir):
    """What is counted while packets pass to a sink."""
    rows, seen = observe.counted(adapters.packets(spark, sf_dir), "packets", tcp=F.col("proto") == 6, empty=F.col("payload_len") == 0)
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([seen.get])


@query("sample_variance", "SELECT user_id, count(*) AS n, round(coalesce(var_samp(floor(value)), 0), 4) AS variance FROM events GROUP BY user_id")
def sample_variance(spark, sf_dir):
    return adapters.events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.round(sample_variance_of(F.floor("value")), 4).alias("variance"))


_BY_REASON = ", ".join(f"count(*) FILTER (total_packets >= 2 AND expiry_reason = '{r}') AS {r.replace('-', '_')}" for r in flows.REASONS)


@query("flow_statistics", f"WITH RECURSIVE {CUT_FLOWS_SQL} SELECT capture_file, count(*) FILTER (total_packets >= 2) AS flows, count(*) FILTER (total_packets < 2) AS dropped, CAST(sum(total_packets) AS BIGINT) AS packets, {_BY_REASON} FROM flows GROUP BY capture_file")
def flow_statistics(spark, sf_dir):
    params = FlowParams(CUTS.active_timeout_s, CUTS.idle_timeout_s, max_packets_per_flow=CUTS.max_packets_per_flow, min_packets_per_flow=2)
    return flows.flow_statistics(adapters.packets(spark, sf_dir, jitter=True), params)


# -- datagrams --------------------------------------------------------------------

_IPFIX = [(8, 4), (12, 4), (7, 2), (11, 2), (4, 1), (6, 2), (1, 8), (2, 8), (152, 8), (153, 8), (34, 4)]


@query("ipfix", f"""
WITH {adapters.packets_sql()} SELECT pkt_seq, src_ip, dst_ip, CAST(src_port AS BIGINT) AS src_port, CAST(dst_port AS BIGINT) AS dst_port, CAST(proto AS BIGINT) AS protocol, CAST(tcp_flags AS BIGINT) AS tcp_flags, CAST(frame_len AS BIGINT) AS bytes, CAST(pkt_seq % 90 + 1 AS BIGINT) AS packets,
       round((pkt_seq % 7000) / 1000.0, 3) AS duration_s, CAST(10 AS INTEGER) AS version, CAST(7 AS BIGINT) AS observation_domain FROM packets
""")
def ipfix(spark, sf_dir):
    """Version 10: each datagram brings its template and one record, with times in milliseconds."""
    p, seq = adapters.packets(spark, sf_dir), F.col("pkt_seq")
    template = [_hex(300, 2), _hex(len(_IPFIX), 2), *(_hex(x, 2) for f in _IPFIX for x in f)]
    start = F.lit(1_704_067_200_000)
    record = [_ip_hex(F.col("src_ip")), _ip_hex(F.col("dst_ip")), _hex(F.col("src_port"), 2), _hex(F.col("dst_port"), 2), _hex(F.col("proto"), 1), _hex(F.col("tcp_flags"), 2), _hex(F.col("frame_len"), 8), _hex(seq % 90 + 1, 8), _hex(start, 8), _hex(start + seq % 7000, 8), _hex(seq % 5, 4)]
    sets = 4 + 4 + 4 * len(_IPFIX), 4 + sum(f[1] for f in _IPFIX)
    payload = [_hex(10, 2), _hex(16 + sum(sets), 2), _hex(1_704_067_200, 4), _hex(0, 4), _hex(7, 4), _hex(2, 2), _hex(sets[0], 2), *template, _hex(300, 2), _hex(sets[1], 2), *record]
    rows = netflow.flow_exports(p.select(F.col("ts_us").alias("recv_us"), seq.cast("string").alias("exporter"), _unhex(*payload).alias("payload")))
    return adapters.named(rows).select(F.col("exporter").cast("long").alias("pkt_seq"), "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "tcp_flags", "bytes", "packets", "duration_s", "version", "observation_domain")


@query("streaming_exports", _EXPORT_SQL + "CAST(pkt_seq % 90 + 1 AS BIGINT) AS packets, round((pkt_seq % 7000) / 1000.0, 3) AS duration_s FROM packets")
def streaming_exports(spark, sf_dir):
    """Landed version 9 datagrams as a stream."""
    made = jobs.replay(_v9_datagrams(spark, sf_dir), lambda d: lambda out, state: carry.run_exports(d, out, state, available_now=True), order="recv_us", batches=3, runs=True)
    return adapters.named(made).select(F.col("exporter").cast("long").alias("pkt_seq"), "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "protocol_name", "tcp_flags", "bytes", "packets", "duration_s")


@query("streaming_statistics", _FILES_SQL + """
SELECT count(DISTINCT file) AS files, count(*) FILTER (NOT broken AND NOT lost) AS frames, count(DISTINCT file) FILTER (broken) AS bad_files, count(*) FILTER (NOT broken AND NOT lost) AS packets, CAST(0 AS BIGINT) AS late FROM g
""")
def streaming_statistics(spark, sf_dir):
    """Captures that land in a folder, bad and cut ones too, through the streaming job; its own statistics, added up."""
    root = scratch(spark, "landed")
    local = splits.local_path(root)

    def land(batches):
        for batch in batches:
            os.makedirs(f"{local}/in", exist_ok=True)
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with open(f"{local}/{path}", "wb") as out:
                    out.write(content)
                os.rename(f"{local}/{path}", f"{local}/in/{path}.pcap")
            yield batch.select(["path"])

    _capture_files(spark, sf_dir).mapInArrow(land, "path string").write.format("noop").mode("overwrite").save()
    jobs.run_capture_flows(spark, f"{root}/in", f"{root}/out", f"{root}/state", params=CUTS, available_now=True, files_per_trigger=64, delay="300 days").awaitTermination()
    rows = spark.read.schema(observe.STATISTICS).parquet(f"{root}/out/statistics")
    return rows.agg(F.sum("rows").alias("files"), *(F.sum(c).alias(c) for c in ("frames", "bad_files", "packets", "late")))


@query("export_errors", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'too short' WHEN 1 THEN 'unsupported version 1' WHEN 2 THEN 'unsupported version 8' WHEN 3 THEN 'unknown version 77' END AS reason FROM events WHERE event_id % 6 < 4
""")
def export_errors(spark, sf_dir):
    e = adapters.events(spark, sf_dir)
    payload = F.unhex(_chosen(["05", "0001" + "00" * 30, "0008" + "00" * 30, "004D" + "00" * 30, "0005" + "00" * 30, "000A" + "00" * 30], F.col("event_id") % 6))
    rows = e.select(F.col("us").alias("recv_us"), F.col("event_id").cast("string").alias("exporter"), payload.alias("payload"))
    return netflow.export_errors(rows).select(F.col("exporter").cast("long").alias("event_id"), "reason")


def _sflow_head(agent: str, kind: int, size: Column) -> list[Column]:
    return [_hex(5, 4), _hex(1, 4), F.lit(agent), _hex(0, 4), _hex(1, 4), _hex(1000, 4), _hex(1, 4), _hex(kind, 4), _hex(size, 4)]


@query("sflow_headers", f"""
WITH {adapters.packets_sql()} SELECT pkt_seq AS sequence, src_ip, dst_ip, CAST(src_port AS BIGINT) AS src_port, CAST(dst_port AS BIGINT) AS dst_port, CAST(proto AS BIGINT) AS protocol, CAST(tcp_flags AS BIGINT) AS tcp_flags, ttl,
       CAST(payload_len + CASE WHEN proto = 6 THEN 54 ELSE 42 END AS BIGINT) AS frame_length, CAST(CASE WHEN proto = 6 THEN 54 ELSE 42 END AS INTEGER) AS header_bytes, CAST(2 AS BIGINT) AS input_if, CAST(3 AS BIGINT) AS output_if FROM packets
""")
def sflow_headers(spark, sf_dir):
    """Expanded flow samples with the raw header of the frame."""
    f = _frames(spark, sf_dir)
    size = F.when(F.expr("hex(substring(data, 24, 1)) = '06'"), 54).otherwise(42)
    header = F.hex(F.expr("substring(data, 1, CASE WHEN hex(substring(data, 24, 1)) = '06' THEN 54 ELSE 42 END)"))
    padded = F.concat(header, F.lit("0000"))
    record = [_hex(1, 4), _hex(18 + size, 4), _hex(1, 4), _hex(F.col("orig_len"), 4), _hex(0, 4), _hex(size, 4), padded]
    body = [_hex(F.col("pkt_seq"), 4), _hex(0, 4), _hex(1, 4), _hex(100, 4), _hex(0, 4), _hex(0, 4), _hex(0, 4), _hex(2, 4), _hex(0, 4), _hex(3, 4), _hex(1, 4), *record]
    rows = sflow.sflow_samples(f.select(F.col("ts_us").alias("recv_us"), F.lit("x").alias("exporter"), _unhex(*_sflow_head("C0000201", 3, 44 + 8 + 18 + size), *body).alias("payload")))
    return adapters.named(rows).select("sequence", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "tcp_flags", "ttl", "frame_length", "header_bytes", "input_if", "output_if")


@query("sflow_counters", """
SELECT event_id AS if_index, '198.51.100.' || user_id % 200 AS device, 'ifIndex' || event_id AS if_name, CASE WHEN event_id % 4 IN (1, 3) THEN 'up' ELSE 'down' END AS admin_status, CASE WHEN event_id % 4 >= 2 THEN 'up' ELSE 'down' END AS oper_status,
       CAST(event_id AS BIGINT) * 1000 AS speed_bps, CAST(event_id AS BIGINT) * 1000003 AS in_octets, CAST(event_id % 1000 AS BIGINT) AS in_packets, CAST(event_id AS BIGINT) * 7 AS out_octets, CAST(event_id % 77 AS BIGINT) AS out_packets, CAST(event_id % 5 AS BIGINT) AS in_errors, CAST(event_id % 3 AS BIGINT) AS out_errors FROM events
""")
def sflow_counters(spark, sf_dir):
    e, i = adapters.events(spark, sf_dir), F.col("event_id")
    fields = [(i, 4), (6, 4), (i * 1000, 8), (1, 4), (i % 4, 4), (i * 1000003, 8), (i % 1000, 4), (0, 4), (0, 4), (0, 4), (i % 5, 4), (0, 4), (i * 7, 8), (i % 77, 4), (0, 4), (0, 4), (0, 4), (i % 3, 4), (0, 4)]
    body = [_hex(i, 4), _hex(1, 4), _hex(1, 4), _hex(1, 4), _hex(88, 4), *(_hex(v, n) for v, n in fields)]
    agent = F.concat(F.lit("C63364"), _hex(F.col("user_id") % 200, 1))
    head = [_hex(5, 4), _hex(1, 4), agent, _hex(0, 4), _hex(1, 4), _hex(1000, 4), _hex(1, 4), _hex(2, 4), _hex(12 + 8 + 88, 4)]
    rows = sflow.sflow_counters(e.select(F.col("us").alias("recv_us"), F.lit("x").alias("exporter"), _unhex(*head, *body).alias("payload")))
    numbers = [F.col(c).cast("long").alias(c) for c in ("in_octets", "in_packets", "out_octets", "out_packets", "in_errors", "out_errors")]
    return rows.select("if_index", "device", "if_name", "admin_status", "oper_status", "speed_bps", *numbers)


_SFLOW_SQL = _COUNTER_SQL.replace("'d' || user_id % 10 AS device", "'198.51.100.' || user_id % 10 AS device").replace("'if' || user_id AS if_name", "'ifIndex' || user_id AS if_name").replace("CASE WHEN k <> 7 THEN oc END AS io", "oc AS io")
#: Datagrams carry all counters: those that the table has no value for are 0.
_SFLOW_INTERFACE = _INTERFACE | {"admin_status": "'up'", **{c: "CAST(0 AS BIGINT)" for c in ("out_packets", "out_errors", "in_discards", "out_discards")}}
_SFLOW_INTERFACE_SQL = f"WITH {_SFLOW_SQL} SELECT {', '.join(f'{_SFLOW_INTERFACE[c]} AS {c}' if c in _SFLOW_INTERFACE else c for c in INTERFACE_COLUMNS)} FROM c3"


def _counter_datagrams(spark, sf_dir) -> DataFrame:
    """A datagram for each interface sample, from one of ten agents."""
    s = _interface_samples(spark, sf_dir)
    status = F.when(F.col("oper_status") == "up", 3).otherwise(1)
    octets = F.expr("out_octets div 4")  # the table hides some incoming counts
    fields = [(F.col("if_index"), 4), (6, 4), (F.col("speed_bps"), 8), (1, 4), (status, 4), (octets, 8), (F.col("in_packets"), 4), (0, 4), (0, 4), (0, 4), (F.col("in_errors"), 4), (0, 4), (F.col("out_octets"), 8), *[(0, 4)] * 6]
    body = [_hex(F.col("if_index"), 4), _hex(1, 4), _hex(1, 4), _hex(1, 4), _hex(88, 4), *(_hex(v, n) for v, n in fields)]
    head = [_hex(5, 4), _hex(1, 4), F.concat(F.lit("C63364"), _hex(F.col("device_no"), 1)), _hex(0, 4), _hex(F.col("arrival"), 4), _hex(1000, 4), _hex(1, 4), _hex(2, 4), _hex(12 + 8 + 88, 4)]
    return s.select((F.col("epoch") * 1_000_000).cast("long").alias("recv_us"), F.lit("x").alias("exporter"), _unhex(*head, *body).alias("payload"))


def _longs(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.col(c).cast("long").alias(c) if "decimal" in kind else F.col(c) for c, kind in rows.dtypes))


@query("sflow_interfaces", _SFLOW_INTERFACE_SQL)
def sflow_interfaces(spark, sf_dir):
    """Counter samples of datagrams as interface rows, with deltas, rates and utilisation."""
    return _longs(counters.interface_rows(counters.counter_deltas(sflow.sflow_counters(_counter_datagrams(spark, sf_dir)))))


@query("streaming_sflow_interfaces", _SFLOW_INTERFACE_SQL)
def streaming_sflow_interfaces(spark, sf_dir):
    """The same from a stream of landed datagrams."""
    return _longs(jobs.replay(_counter_datagrams(spark, sf_dir), lambda d: lambda out, state: carry.run_sflow_counters(d, out, state, available_now=True), order="recv_us", batches=3, runs=True).select(*INTERFACE_COLUMNS))


@query("table_counts", "SELECT 'd' || user_id % 10 AS device, event_type AS column, count(*) AS entries FROM events GROUP BY ALL")
def table_counts(spark, sf_dir):
    """Rows of each walked column of each device."""
    walked = adapters.events(spark, sf_dir).select(F.concat(F.lit("d"), (F.col("user_id") % 10).cast("string")).alias("device"), F.lit(0.0).alias("epoch"), F.col("event_type").alias("column"))
    return telemetry.table_counts(walked).drop("epoch")


@query("octet_text", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type || ' ' || event_id ELSE format('00:{:02x}:{:02x}:{:02x}', (event_id >> 16) & 255, (event_id >> 8) & 255, event_id & 255) END AS text,
       regexp_replace(event_type || '/é ' || event_id || ':x.pcap', '[^\\p{L}\\p{N}_.\\-]', '_', 'g') AS stem FROM events
""")
def octet_text(spark, sf_dir):
    """Printable and other octets as text, and names made safe for files."""
    e, i = adapters.events(spark, sf_dir), F.col("event_id")
    raw = F.when(i % 2 == 0, F.encode(F.concat_ws(" ", "event_type", i.cast("string")), "utf-8")).otherwise(_unhex(F.lit("00"), _hex(i, 3)))
    return e.select("event_id", exprs.octet_text(raw).alias("text"), exprs.safe_stem(F.concat("event_type", F.lit("/é "), i.cast("string"), F.lit(":x.pcap"))).alias("stem"))


# -- sinks ---------------------------------------------------------------------------

@query("csv_round_trip", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS length, CASE WHEN event_id % 3 = 0 THEN 'a,\"b\" ' || event_type ELSE '' END AS note FROM events")
def csv_round_trip(spark, sf_dir):
    """Rows appended in two batches to a CSV folder and read back as text."""
    e = adapters.events(spark, sf_dir)
    note = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('a,"b" '), F.col("event_type")))
    rows = e.select("event_id", "event_type", F.floor("value").alias("length"), note.alias("note"))
    path = scratch(spark, "csv")
    for k in range(2):
        sinks.write_csv(rows.where(F.col("event_id") % 2 == k), path)
    return sinks.read_csv(spark, path, rows.columns).withColumn("note", F.coalesce("note", F.lit("")))


@query("parquet_round_trip", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def parquet_round_trip(spark, sf_dir):
    """Rows appended by partition and read back."""
    path = scratch(spark, "rows")
    sinks.write_rows(adapters.events(spark, sf_dir).select("event_id", "event_type"), path, ("event_type",))
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))

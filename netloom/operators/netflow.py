"""NetFlow v5, v9 and IPFIX: datagrams to flow-export records.

Version 5 has fixed offsets and is decoded by expressions alone.  For v9 and
IPFIX an Arrow function cuts datagrams into templates and data sets.  Templates
become intervals in which they hold, few rows as resent templates add none, and
each data set is joined with the interval that it falls into, where it is: bodies
are not brought together by exporter.  A second function cuts the records.
"""

from __future__ import annotations

import socket
from itertools import count

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.functions.exprs import ipv4_text, iso_utc, proto_name, unsigned
from netloom.schemas import NETFLOW_COLUMNS
from netloom.storage import materialize

TEMPLATE_TTL_S = 3600


def export_version(payload: Column) -> Column:
    return unsigned(payload, 1, 2).cast("int")


def export_errors(datagrams: DataFrame) -> DataFrame:
    """Datagrams that no decoder takes, with the reason."""
    v = export_version(F.col("payload"))
    reason = F.when(F.length("payload") < 2, "too short").when(v.isin(1, 7, 8), F.concat(F.lit("unsupported version "), v.cast("string"))).when(~v.isin(5, 9, 10), F.concat(F.lit("unknown version "), v.cast("string")))
    return datagrams.withColumn("reason", reason).where("reason IS NOT NULL")


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.withColumn("timestamp", iso_utc((F.col("epoch") * 1_000_000).cast("long"), millis=False)).select(*NETFLOW_COLUMNS)


def netflow_v5(datagrams: DataFrame) -> DataFrame:
    """Records of all version 5 datagrams: as many as the header says and the datagram holds."""
    p = F.col("payload")
    head = datagrams.where((export_version(p) == 5) & (F.length(p) >= 24))
    count = F.least(unsigned(p, 3, 2), F.floor((F.length(p) - 24) / 48))
    head = head.withColumns({
        "count": count, "uptime": unsigned(p, 5, 4), "unix": unsigned(p, 9, 4), "sampling": F.coalesce(F.nullif(unsigned(p, 23, 2).bitwiseAND(F.lit(0x3FFF)), F.lit(0)), F.lit(1)),
    }).where("count > 0")
    r = head.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("count").cast("int") - 1))).withColumn("rec", F.substring(p, F.col("i") * 48 + 25, F.lit(48)))
    rec = F.col("rec")
    boot = F.col("unix") - F.col("uptime") / F.lit(1000.0)
    start, end = boot + unsigned(rec, 25, 4) / F.lit(1000.0), boot + unsigned(rec, 29, 4) / F.lit(1000.0)
    u = lambda at, n: unsigned(rec, at, n)
    proto = u(39, 1)
    return _in_order(r.select(
        F.round(F.when(F.col("unix") != 0, F.col("unix").cast("double")).otherwise(F.col("recv_us") / F.lit(1e6)), 3).alias("epoch"), "exporter", F.lit(5).alias("version"), F.lit(0).cast("long").alias("observation_domain"), F.lit(0).alias("template_id"), ipv4_text(rec, 1).alias("src_ip"), ipv4_text(rec, 5).alias("dst_ip"),
        u(33, 2).alias("src_port"), u(35, 2).alias("dst_port"), proto.alias("protocol"), proto_name(proto).alias("protocol_name"), u(38, 1).alias("tcp_flags"), F.lit(4).alias("ip_version"), u(17, 4).alias("packets"), u(21, 4).alias("bytes"),
        F.round(start, 3).alias("first_switched"), F.round(end, 3).alias("last_switched"), F.round(F.greatest(F.lit(0.0), end - start), 3).alias("duration_s"), u(13, 2).alias("input_if"), u(15, 2).alias("output_if"),
        F.lit(0).cast("long").alias("src_vlan"), u(40, 1).alias("tos"), u(41, 2).alias("src_asn"), u(43, 2).alias("dst_asn"), F.col("sampling").alias("sampling_rate"),
    ))


SET = "recv_us long, arrival long, seq long, exporter string, version int, domain long, export_s double, boot_s double, template_id int, fields array<struct<element: int, len: int>>, scope_count int, body binary"


def _number(data: bytes, at: int, n: int) -> int:
    return int.from_bytes(data[at : at + n], "big")


def _sets(data: bytes):
    """(set id, body) of each set of a v9 or IPFIX datagram, with the header's facts first."""
    version = _number(data, 0, 2)
    if version == 9 and len(data) >= 20:
        uptime, unix = _number(data, 4, 4), _number(data, 8, 4)
        yield 9, _number(data, 16, 4), float(unix), unix - uptime / 1000.0
        at, end = 20, len(data)
    elif version == 10 and len(data) >= 16:
        yield 10, _number(data, 12, 4), float(_number(data, 4, 4)), 0.0
        at, end = 16, min(len(data), _number(data, 2, 2))
    else:
        return
    while at + 4 <= end:
        size = _number(data, at + 2, 2)
        if size < 4 or at + size > end:
            return
        yield _number(data, at, 2), data[at + 4 : at + size]
        at += size


def _templates(body: bytes, version: int, options: bool):
    """(id, fields, scope count) of each template in a set; enterprise elements count as element 0."""
    at, head = 0, 6 if options else 4
    while at + head <= len(body):
        number, scope = _number(body, at, 2), 0
        if options and version == 9:
            scope, total = _number(body, at + 2, 2) // 4, (_number(body, at + 2, 2) + _number(body, at + 4, 2)) // 4
        else:
            total = _number(body, at + 2, 2)
            scope = _number(body, at + 4, 2) if options else 0
        at += head
        if number < 256 or total == 0:
            return
        fields = []
        for _ in range(total):
            if at + 4 > len(body):
                return
            element, size = _number(body, at, 2), _number(body, at + 2, 2)
            at += 4
            if version == 10 and element & 0x8000:
                element, at = 0, at + 4
            fields.append({"element": element, "len": size})
        yield number, fields, scope


def export_sets(datagrams: DataFrame, bodies: bool = True) -> DataFrame:
    """Templates (``fields`` set) and, with ``bodies``, data sets (``body`` set) of v9 and IPFIX datagrams, in order of recv_us, arrival (datagram), seq (in the datagram)."""

    def run(batches):
        arrivals = count(TaskContext.get().partitionId() << 33)
        for batch in batches:
            out = []
            for recv, arrival, exporter, data in zip(batch.column("recv_us").to_pylist(), arrivals, *(batch.column(c).to_pylist() for c in ("exporter", "payload"))):
                sets = _sets(data or b"")
                facts = next(sets, None)
                if facts is None:
                    continue
                version, domain, export_s, boot_s = facts
                for k, (number, body) in enumerate(sets):
                    head = (recv, arrival, k << 20, exporter, version, domain, export_s, boot_s)
                    if number in ((0, 1) if version == 9 else (2, 3)):
                        for j, (t, fields, scope) in enumerate(_templates(body, version, number in (1, 3))):
                            out.append((recv, arrival, (k << 20) + j, *head[3:], t, fields, scope, None))
                    elif bodies and number >= 256:
                        out.append((*head, number, None, None, body))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.list_(pa.struct([("element", pa.int32()), ("len", pa.int32())])), pa.int32(), pa.binary())
            names = ["recv_us", "arrival", "seq", "exporter", "version", "domain", "export_s", "boot_s", "template_id", "fields", "scope_count", "body"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)

    return datagrams.select("recv_us", "exporter", "payload").mapInArrow(run, SET)


#: Intervals are sent to all tasks only up to this many rows; more are joined by a shuffle, which adaptive execution can split.
BROADCAST_INTERVALS = 100_000


def template_intervals(templates: DataFrame, ttl_s: int = TEMPLATE_TTL_S) -> DataFrame:
    """exporter, domain, template_id, fields, starts, ends (places in order; null if nothing ends it), until, bucket: when each template holds.

    Of templates that follow one another within ``ttl_s`` and say the same, all are
    one interval.  It ends where another template begins, at ``until`` at the latest;
    a row stands for each stretch of ``ttl_s`` (``bucket``) that it reaches into.
    """
    ttl, key = ttl_s * 1_000_000, "PARTITION BY exporter, domain, template_id ORDER BY place"
    rows = templates.where("fields IS NOT NULL").select("exporter", "domain", "template_id", "fields", "recv_us", _place(templates).alias("place"))
    before = rows.withColumns({"b": F.expr(f"lag(recv_us) OVER ({key})"), "same": F.expr(f"fields <=> lag(fields) OVER ({key})")})
    opens = F.col("b").isNull() | ~F.col("same") | (F.col("recv_us") - F.col("b") > ttl)
    runs = before.withColumn("opens", opens.cast("int")).withColumn("run", F.expr(f"sum(opens) OVER ({key} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))
    held = runs.groupBy("exporter", "domain", "template_id", "run").agg(F.first("fields").alias("fields"), F.min("place").alias("starts"), F.max("recv_us").alias("last"))
    held = held.withColumns({"ends": F.expr("lead(starts) OVER (PARTITION BY exporter, domain, template_id ORDER BY run)"), "until": F.col("last") + ttl})
    stop = F.least(F.col("until"), F.coalesce(F.col("ends.recv_us"), F.col("until")))
    width = max(1, ttl)
    buckets = F.sequence(F.floor(F.col("starts.recv_us") / width), F.floor(stop / width))
    return held.select("exporter", "domain", "template_id", "fields", "starts", "ends", "until", F.explode(buckets).alias("bucket"))


def _place(sets: DataFrame) -> Column:
    return F.struct("recv_us", *(c for c in ("arrival",) if c in sets.columns), "seq")


def with_template(sets: DataFrame, ttl_s: int = TEMPLATE_TTL_S, templates: DataFrame | None = None) -> DataFrame:
    """Data sets with ``template``, the latest of their key that came before and is not older than ``ttl_s``; null if there is none.

    ``templates``: the rows of ``sets`` that are templates, where they can be had at less cost.
    """
    holds = materialize(template_intervals(sets if templates is None else templates, ttl_s), "templates")
    if holds.count() <= BROADCAST_INTERVALS:
        holds = F.broadcast(holds)
    data = sets.where("body IS NOT NULL").drop("fields", "scope_count").withColumns({"place": _place(sets), "bucket": F.floor(F.col("recv_us") / max(1, ttl_s * 1_000_000))})
    keys = ["exporter", "domain", "template_id", "bucket"]
    here = holds.select(*(F.col(c).alias(f"t_{c}") for c in keys), F.col("fields").alias("template"), "starts", "ends", "until")
    on = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in keys]
    inside = (F.col("place") > F.col("starts")) & (F.col("ends").isNull() | (F.col("place") < F.col("ends"))) & (F.col("recv_us") <= F.col("until"))
    joined = data.join(here, [*on, inside], "left")
    return joined.select(*(c for c in data.columns if c not in ("place", "bucket")), "template")


def awaiting_template(sets: DataFrame, ttl_s: int = TEMPLATE_TTL_S) -> DataFrame:
    """exporter, domain, template_id and the number of data sets that came without a valid template."""
    return with_template(sets, ttl_s).where("template IS NULL").groupBy("exporter", "domain", "template_id").agg(F.count(F.lit(1)).alias("sets"))


def _records(body: bytes, fields: list[dict]):
    """Element to bytes of each record; the last of a repeated element counts, under four bytes at the end are padding."""
    fixed = sum(f["len"] for f in fields if f["len"] != 0xFFFF)
    at = 0
    while len(body) - at >= max(4, fixed):
        values, start = {}, at
        for f in fields:
            size = f["len"]
            if size == 0xFFFF:
                if at >= len(body):
                    return
                size, at = body[at], at + 1
                if size == 255:
                    size, at = _number(body, at, 2), at + 2
            if at + size > len(body):
                return
            values[f["element"]] = body[at : at + size]
            at += size
        if at == start:
            return
        yield values


def data_records(matched: DataFrame) -> DataFrame:
    """One row per record: the header's facts, ``values`` (a map from element to bytes) and the texts of IPv6 addresses."""

    def text(raw: bytes | None) -> str:
        return socket.inet_ntop(socket.AF_INET6, (raw or b"").ljust(16, b"\0")[:16])

    def run(batches):
        for batch in batches:
            heads = ["recv_us", "exporter", "version", "domain", "export_s", "boot_s", "template_id"]
            rows = []
            for *head, body, fields in zip(*(batch.column(c).to_pylist() for c in [*heads, "body", "template"])):
                rows += [(*head, list(v.items()), text(v.get(27)), text(v.get(28))) for v in _records(body, fields)]
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.map_(pa.int32(), pa.binary()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*heads, "values", "src_v6", "dst_v6"])

    ready = matched.where("template IS NOT NULL")
    return ready.mapInArrow(run, "recv_us long, exporter string, version int, domain long, export_s double, boot_s double, template_id int, values map<int, binary>, src_v6 string, dst_v6 string")


def normalized(records: DataFrame) -> DataFrame:
    """Flow-export rows of data records; records without addresses (options) give none."""
    raw = lambda e: F.try_element_at(F.col("values"), F.lit(e))

    def num(e: int) -> Column:
        v = raw(e)
        return F.coalesce(F.conv(F.hex(v), 16, 10).try_cast("decimal(20,0)").try_cast("long"), F.lit(0).cast("long"))

    some = lambda *es: F.coalesce(*(F.nullif(num(e), F.lit(0)) for e in es), F.lit(0).cast("long"))
    v4 = F.length(raw(8)) == 4
    v6 = F.length(raw(27)) == 16
    zero = F.unhex(F.lit("00" * 4))
    pick = lambda element, six: F.when(v4, ipv4_text(F.coalesce(raw(element), zero), 1)).otherwise(F.col(six))
    has = lambda e: F.map_contains_key("values", F.lit(e))
    boot = F.col("boot_s")
    when = lambda ms, s, us, up: (
        F.when(has(152), num(ms) / F.lit(1e3)).when(has(150), num(s).cast("double")).when(has(154), num(us) / F.lit(1e6)).when(has(22), boot + num(up) / F.lit(1e3)).otherwise(F.col("export_s"))
    )
    start, end, proto = when(152, 150, 154, 22), when(153, 151, 155, 21), num(4)
    return _in_order(records.where(F.coalesce(v4, F.lit(False)) | F.coalesce(v6, F.lit(False))).select(
        F.round(F.when(F.col("export_s") != 0, F.col("export_s")).otherwise(F.col("recv_us") / F.lit(1e6)), 3).alias("epoch"), "exporter", "version", F.col("domain").alias("observation_domain"), "template_id",
        pick(8, "src_v6").alias("src_ip"), pick(12, "dst_v6").alias("dst_ip"), num(7).alias("src_port"), num(11).alias("dst_port"), proto.alias("protocol"), proto_name(proto).alias("protocol_name"), num(6).alias("tcp_flags"),
        F.when(v4, 4).otherwise(6).alias("ip_version"), some(2, 86, 24).alias("packets"), some(1, 85, 23).alias("bytes"), F.round(start, 3).alias("first_switched"), F.round(end, 3).alias("last_switched"),
        F.round(F.greatest(F.lit(0.0), end - start), 3).alias("duration_s"), num(10).alias("input_if"), num(14).alias("output_if"), num(58).alias("src_vlan"), num(5).alias("tos"), num(16).alias("src_asn"), num(17).alias("dst_asn"),
        F.coalesce(F.nullif(some(34, 305), F.lit(0)), F.lit(1)).alias("sampling_rate"),
    ))


def flow_exports(datagrams: DataFrame, ttl_s: int = TEMPLATE_TTL_S) -> DataFrame:
    """Rows of all versions."""
    matched = with_template(export_sets(datagrams), ttl_s, templates=export_sets(datagrams, bodies=False))
    return netflow_v5(datagrams).unionByName(normalized(data_records(matched)))

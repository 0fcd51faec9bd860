"""sFlow version 5: datagrams to flow samples and interface counters."""

from __future__ import annotations

import socket

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netloom.functions.exprs import PROTO_NAMES, iso_utc
from netloom.schemas import SFLOW_COLUMNS
from netloom.sources.decode import byte_entropy, decode_packet

MAX_SAMPLES, MAX_RECORDS = 512, 256
#: Link types of the sampled header by sFlow's header protocol.
HEADER_LINKS = {1: 1, 11: 228, 12: 229}
_SAMPLE = "sequence:long sampling_rate:long sample_pool:long drops:long input_if:long output_if:long frame_length:long stripped:long header_bytes:int payload_entropy:double ip_version:int src_ip:string dst_ip:string src_port:long dst_port:long protocol:long protocol_name:string tcp_flags:long vlan_id:int ttl:int"
_COUNTER = "if_index:long if_type:long speed_bps:decimal(20,0) direction:long status:long in_octets:decimal(20,0) in_packets:long in_multicast:long in_broadcast:long in_discards:long in_errors:long in_unknown_protos:long out_octets:decimal(20,0) out_packets:long out_multicast:long out_broadcast:long out_discards:long out_errors:long"
SAMPLE_FIELDS = [x.split(":") for x in _SAMPLE.split()]
COUNTER_FIELDS = [x.split(":") for x in _COUNTER.split()]


class _Words:
    """Reads big-endian words; reading past the end is an error."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def left(self) -> int:
        return len(self.data) - self.at

    def raw(self, size: int) -> bytes:
        if size > self.left():
            raise EOFError
        self.at += size
        return self.data[self.at - size : self.at]

    def u32(self, words: int = 1) -> int:
        return int.from_bytes(self.raw(4 * words), "big")

    def parts(self, most: int):
        """(format, reader) of each standard (enterprise 0) part that is whole; the count stands in front."""
        for _ in range(min(self.u32(), most)):
            if self.left() < 8:
                return
            kind, size = self.u32(), self.u32()
            if size > self.left():
                return
            body = _Words(self.raw(size))
            if kind >> 12 == 0:
                yield kind & 0xFFF, body


def _header_record(w: _Words) -> dict:
    protocol, length, stripped, size = w.u32(), w.u32(), w.u32(), w.u32()
    header = w.raw(min(size, w.left()))
    out = {"frame_length": length, "stripped": stripped, "header_bytes": len(header), "payload_entropy": round(byte_entropy(header), 6)}
    p = decode_packet(header, HEADER_LINKS[protocol]) if protocol in HEADER_LINKS else None
    if p:
        out |= dict(zip(("src_ip", "dst_ip", "src_port", "dst_port", "protocol", "ip_version", "ttl", "tcp_flags"), p)) | {"vlan_id": p[12], "protocol_name": PROTO_NAMES.get(p[4], str(p[4]))}
    return out


def _address_record(w: _Words, size: int) -> dict:
    family = socket.AF_INET if size == 4 else socket.AF_INET6
    length, proto = w.u32(), w.u32()
    src, dst = (socket.inet_ntop(family, w.raw(size)) for _ in range(2))
    out = {"frame_length": length, "ip_version": 4 if size == 4 else 6, "src_ip": src, "dst_ip": dst, "src_port": w.u32(), "dst_port": w.u32(), "tcp_flags": w.u32()}
    w.u32()  # type of service, or priority
    return out | {"protocol": proto, "protocol_name": PROTO_NAMES.get(proto, str(proto)), "payload_entropy": 0.0, "header_bytes": 0}


RECORDS = {1: _header_record, 3: lambda w: _address_record(w, 4), 4: lambda w: _address_record(w, 16)}


def _flow_sample(w: _Words, wide: bool):
    head = {"sequence": w.u32()}
    w.u32(2 if wide else 1)
    head |= {name: w.u32() for name in ("sampling_rate", "sample_pool", "drops")}
    for name in ("input_if", "output_if"):
        if wide:
            w.u32()
        head[name] = w.u32()
    for kind, body in w.parts(MAX_RECORDS):
        if kind in RECORDS:
            try:
                yield head | RECORDS[kind](body)
            except EOFError:
                continue


def _counter_sample(w: _Words, wide: bool):
    w.u32(3 if wide else 2)
    for kind, body in w.parts(MAX_RECORDS):
        if kind == 1:
            try:
                yield {name: body.u32(2 if "decimal" in t else 1) for name, t in COUNTER_FIELDS}
            except EOFError:
                continue


def decode_sflow(data: bytes | None) -> dict | None:
    """agent_ip, sub_agent_id, datagram_sequence, uptime_ms, samples, counters of a datagram; None if its header can't be read."""
    w = _Words(data or b"")
    try:
        if w.u32() != 5:
            return None
        size = {1: 4, 2: 16}.get(w.u32())
        if size is None:
            return None
        agent = socket.inet_ntop(socket.AF_INET if size == 4 else socket.AF_INET6, w.raw(size))
        out = {"agent_ip": agent, "sub_agent_id": w.u32(), "datagram_sequence": w.u32(), "uptime_ms": w.u32(), "samples": [], "counters": []}
        for kind, body in w.parts(MAX_SAMPLES):
            try:
                if kind in (1, 3):
                    out["samples"] += _flow_sample(body, kind == 3)
                elif kind in (2, 4):
                    out["counters"] += _counter_sample(body, kind == 4)
            except EOFError:
                continue
    except EOFError:
        return out if "out" in locals() else None
    return out


def _arrow(kind: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}.get(kind) or pa.decimal128(20, 0)


def sflow_datagrams(datagrams: DataFrame) -> DataFrame:
    """recv_us, exporter, agent_ip, sub_agent_id, datagram_sequence, uptime_ms, samples, counters; other datagrams give no row."""
    struct = lambda fields: "struct<" + ", ".join(f"{n}: {t}" for n, t in fields) + ">"
    kinds = {"recv_us": pa.int64(), "exporter": pa.string(), "agent_ip": pa.string(), "sub_agent_id": pa.int64(), "datagram_sequence": pa.int64(), "uptime_ms": pa.int64()}
    kinds |= {name: pa.list_(pa.struct([(n, _arrow(t)) for n, t in fields])) for name, fields in (("samples", SAMPLE_FIELDS), ("counters", COUNTER_FIELDS))}

    def run(batches):
        from decimal import Decimal

        for batch in batches:
            rows = []
            for recv, exporter, data in zip(*(batch.column(c).to_pylist() for c in ("recv_us", "exporter", "payload"))):
                if (d := decode_sflow(data)) is not None:
                    d["counters"] = [{n: Decimal(v) if "decimal" in t else v for (n, t), v in zip(COUNTER_FIELDS, c.values())} for c in d["counters"]]
                    rows.append({"recv_us": recv, "exporter": exporter} | d)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds.items()], list(kinds))

    schema = f"recv_us long, exporter string, agent_ip string, sub_agent_id long, datagram_sequence long, uptime_ms long, samples array<{struct(SAMPLE_FIELDS)}>, counters array<{struct(COUNTER_FIELDS)}>"
    return datagrams.select("recv_us", "exporter", "payload").mapInArrow(run, schema)


def sflow_samples(datagrams: DataFrame) -> DataFrame:
    """One row per sampled packet."""
    s = sflow_datagrams(datagrams).select("recv_us", "agent_ip", "sub_agent_id", F.explode("samples").alias("s"))
    rows = s.select(iso_utc(F.col("recv_us"), millis=False).alias("timestamp"), F.round(F.col("recv_us") / F.lit(1e6), 3).alias("epoch"), "agent_ip", "sub_agent_id", "s.*")
    return rows.select(*SFLOW_COLUMNS)


def sflow_counters(datagrams: DataFrame) -> DataFrame:
    """Counter samples as interface samples for :func:`netloom.operators.counters.counter_deltas`; bits 0 and 1 of the status say up.

    Samples of one instant come in the order of their datagrams' numbers.
    """
    c = sflow_datagrams(datagrams).select("recv_us", "agent_ip", "datagram_sequence", F.posexplode("counters").alias("place", "c"))
    arrival = F.col("datagram_sequence") * MAX_SAMPLES * MAX_RECORDS + F.col("place")
    up = lambda bit: F.when(F.col("c.status").bitwiseAND(F.lit(bit)) != 0, "up").otherwise("down")
    number = lambda f: F.col(f"c.{f}").cast("decimal(20,0)").alias(f)
    names = [f"{d}_{k}" for k in ("octets", "packets", "errors", "discards") for d in ("in", "out")]
    return c.select(
        F.col("agent_ip").alias("device"), (F.col("recv_us") / F.lit(1e6)).alias("epoch"), arrival.cast("long").alias("arrival"), F.col("c.if_index").alias("if_index"), F.concat(F.lit("ifIndex"), F.col("c.if_index")).alias("if_name"),
        up(1).alias("admin_status"), up(2).alias("oper_status"), F.col("c.speed_bps").cast("long").alias("speed_bps"), *(number(n) for n in names),
    )

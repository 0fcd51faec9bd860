"""Whole jobs: captures to flow rows, host profiles and the network series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from netloom.config import FlowParams, ProfileParams, SeriesParams
from netloom.operators.enrichment import enricher
from netloom.operators.flows import finished_flows, flow_statistics, open_flows
from netloom.operators.host_profiles import host_profiles
from netloom.operators.network_series import network_series
from netloom.sources.decode import decode_frames, decode_report
from netloom.sources.pcap import capture_reports, read_captures, split_captures
from netloom.storage import discard, materialize


@dataclass
class Tables:
    flows: DataFrame
    profiles: DataFrame
    series: DataFrame


def process(packets: DataFrame, flow: FlowParams = FlowParams(), profile: ProfileParams = ProfileParams(), series: SeriesParams = SeriesParams(), ranges: DataFrame | None = None, ranges_v6: DataFrame | None = None, device: str = "", telemetry=None, sflow=None, netflow=None, flows_path: str | None = None) -> Tables:
    """The three tables of a set of packets.

    Flows feed all three, so they are written once, to ``flows_path`` or the
    shared folder, and read back: the two analyses do not assemble them again.
    """
    held = open_flows(packets, flow)
    flows = finished_flows(held, flow, device, enricher(ranges, ranges_v6))
    if flows_path:
        flows.write.mode("overwrite").parquet(flows_path)
        flows = flows.sparkSession.read.schema(flows.schema).parquet(flows_path)
    else:
        flows = materialize(flows, "flows")
    discard(held)
    return Tables(flows, host_profiles(flows, profile, device), network_series(flows, telemetry, sflow, netflow, series, device))


def process_captures(spark: SparkSession, path: str, split_bytes: int = 64 << 20, **options) -> Tables:
    """The tables of all captures under ``path``."""
    return process(decode_frames(read_captures(spark, path, split_bytes=split_bytes)), **options)


def extraction_results(files: DataFrame, flow: FlowParams = FlowParams()) -> DataFrame:
    """One row per capture of (path, content), bad ones too: what was read, decoded and assembled.

    Columns: those of ``capture_reports``, then skipped (frames without an IP packet), decode_rate, and those of ``flow_statistics``.
    """
    frames = materialize(split_captures(files), "frames")
    packets = decode_frames(frames)
    report = decode_report(frames).select("capture_file", "skipped", "decode_rate")
    flows = flow_statistics(packets, flow).withColumnRenamed("packets", "flow_packets")
    rows = capture_reports(files).join(report, "capture_file", "left").join(flows, "capture_file", "left")
    return rows.fillna(0, ["skipped", "decode_rate", *flows.columns[1:]])

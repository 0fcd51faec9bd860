"""Row layouts.  Instants are microseconds (BIGINT) inside; NULL means not measured."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}


def _row(text: str) -> T.StructType:
    """A schema from "name type" pairs; it needs no session, so workers can import this module."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (x.split() for x in text.split(","))])


PACKET = _row(
    "capture_file string, pkt_seq bigint, ts_us bigint, src_ip string, dst_ip string, src_port int, dst_port int, "
    "proto int, ip_version int, ttl int, tcp_flags int, tcp_window int, frame_len int, ip_len int, payload_len int, "
    "vlan_id int, is_fragment boolean"
)
FRAME = _row("capture_file string, pkt_seq bigint, ts_us bigint, linktype int, cap_len int, orig_len int, data binary")
DATAGRAM = _row("recv_us bigint, exporter string, dst_port int, payload binary")

# Column names and their order in each output.
FLOW_COLUMNS = """
flow_id device capture_file src_ip src_port dst_ip dst_port protocol protocol_name ip_version vlan_id
start_time end_time start_epoch end_epoch duration_s expiry_reason
total_packets fwd_packets bwd_packets total_bytes fwd_bytes bwd_bytes total_frame_bytes fwd_frame_bytes bwd_frame_bytes
packets_per_s bytes_per_s fwd_bytes_per_s bwd_bytes_per_s
pkt_len_mean pkt_len_std pkt_len_min pkt_len_max pkt_len_var
fwd_pkt_len_mean fwd_pkt_len_std fwd_pkt_len_min fwd_pkt_len_max bwd_pkt_len_mean bwd_pkt_len_std bwd_pkt_len_min bwd_pkt_len_max
flow_iat_mean flow_iat_std flow_iat_min flow_iat_max fwd_iat_mean fwd_iat_std fwd_iat_min fwd_iat_max
bwd_iat_mean bwd_iat_std bwd_iat_min bwd_iat_max
active_mean active_std active_max active_count idle_mean idle_std idle_max idle_count
syn_count fin_count rst_count psh_count ack_count urg_count ece_count cwr_count
syn_ratio fin_ratio rst_ratio psh_ratio ack_ratio urg_ratio init_win_fwd init_win_bwd fwd_min_seg_size tcp_handshake_ms tcp_state
ttl_mean ttl_std ttl_min ttl_max fragment_packets
down_up_byte_ratio fwd_bwd_packet_ratio byte_asymmetry
src_scope dst_scope dst_asn dst_asn_org dst_country
""".split()
HOST_COLUMNS = """
window_start window_end device host_ip host_scope flows_out flows_in flows_total packets_sent packets_received
bytes_sent bytes_received bytes_total frame_bytes_sent frame_bytes_received bytes_per_s_sent bytes_per_s_received
unique_dst_ips unique_dst_ports unique_dst_asns unique_dst_countries unique_peer_sources unique_listening_ports
dst_port_entropy dst_ip_entropy fan_out_ratio public_dst_ratio tcp_ratio udp_ratio icmp_ratio other_proto_ratio
syn_ratio rst_ratio fin_ratio failed_handshake_ratio short_flow_ratio mean_flow_duration_s max_flow_duration_s
mean_pkt_len mean_flow_iat_s mean_active_s mean_idle_s mean_ttl down_up_byte_ratio
share_of_window_flows share_of_window_bytes share_of_window_dst_ports cardinality_truncated
""".split()
SERIES_COLUMNS = """
timestamp epoch device bucket_seconds flow_samples flows_per_s packets_per_s bytes_per_s tcp_ratio udp_ratio icmp_ratio
active_src_ips active_dst_ips active_dst_ports dst_port_entropy dst_ip_entropy byte_asymmetry
mean_flow_duration_s mean_flow_iat_s mean_pkt_len syn_no_ack_per_s rst_flows_per_s short_flows_ratio public_dst_ratio
ipv6_ratio new_flows_per_s telemetry_samples iface_in_bytes_per_s iface_out_bytes_per_s iface_errors iface_discards
ifaces_total ifaces_down arp_entries mac_entries route_entries device_cpu_pct device_mem_pct
sflow_samples sflow_frames_per_s sflow_bytes_per_s sflow_payload_entropy netflow_samples netflow_flows_per_s netflow_bytes_per_s
""".split()
DEVICE_COLUMNS = """
timestamp epoch device driver reachable poll_ms error interfaces_total interfaces_up interfaces_down
in_bytes_per_s out_bytes_per_s in_packets_per_s out_packets_per_s in_errors_delta out_errors_delta in_discards_delta out_discards_delta
counter_resets arp_entries mac_entries route_entries cpu_percent memory_percent uptime_s system_name system_description
""".split()
INTERFACE_COLUMNS = """
timestamp epoch device if_index if_name if_alias admin_status oper_status speed_bps
in_octets out_octets in_packets out_packets in_errors out_errors in_discards out_discards
interval_s in_octets_delta out_octets_delta in_bytes_per_s out_bytes_per_s utilisation_in_pct utilisation_out_pct counter_reset
""".split()
SFLOW_COLUMNS = """
timestamp epoch agent_ip sub_agent_id sequence sampling_rate sample_pool drops input_if output_if frame_length stripped
header_bytes payload_entropy ip_version src_ip dst_ip src_port dst_port protocol protocol_name tcp_flags vlan_id ttl
""".split()
NETFLOW_COLUMNS = """
timestamp epoch exporter version observation_domain template_id src_ip dst_ip src_port dst_port protocol protocol_name
tcp_flags ip_version packets bytes first_switched last_switched duration_s input_if output_if src_vlan tos src_asn dst_asn sampling_rate
""".split()

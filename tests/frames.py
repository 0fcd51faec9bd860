"""Frames, captures and datagrams built from the protocol specifications."""

import socket
import struct


def ipv4(payload, proto=17, src="10.0.0.1", dst="10.0.0.2", ttl=64, fragment=0, total=None):
    return struct.pack("!BBHHHBBH4s4s", 0x45, 0, total if total is not None else 20 + len(payload), 1, fragment, ttl, proto, 0, socket.inet_aton(src), socket.inet_aton(dst)) + payload


def ipv6(payload, proto=17, src="2001:db8::1", dst="2001:db8::2"):
    return struct.pack("!IHBB16s16s", 6 << 28, len(payload), proto, 60, socket.inet_pton(socket.AF_INET6, src), socket.inet_pton(socket.AF_INET6, dst)) + payload


def udp(data=b"", sport=5000, dport=53):
    return struct.pack("!HHHH", sport, dport, 8 + len(data), 0) + data


def tcp(data=b"", sport=5000, dport=443, flags=2, window=1000):
    return struct.pack("!HHIIBBHHH", sport, dport, 0, 0, 0x50, flags, window, 0, 0) + data


def ether(payload, kind=0x0800, tags=b""):
    return b"\0" * 12 + tags + struct.pack("!H", kind) + payload


def pcap(frames, order="<", nanos=False, link=1):
    magic = 0xA1B23C4D if nanos else 0xA1B2C3D4
    out = struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 65535, link)
    for us, data in frames:
        out += struct.pack(order + "IIII", us // 10**6, us % 10**6 * (1000 if nanos else 1), len(data), len(data)) + data
    return out


def block(kind, body, order="<"):
    body += b"\0" * (-len(body) % 4)
    return struct.pack(order + "II", kind, len(body) + 12) + body + struct.pack(order + "I", len(body) + 12)


def pcapng(frames, order="<", options=b""):
    out = block(0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1), order) + block(1, struct.pack(order + "HHI", 1, 0, 65535) + options, order)
    for us, data in frames:
        out += block(6, struct.pack(order + "IIIII", 0, us >> 32, us & 0xFFFFFFFF, len(data), len(data)) + data, order)
    return out + block(99, b"unknown", order)

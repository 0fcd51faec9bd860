"""Column expressions shared by the operators; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of IP protocols; others show their number.
PROTO_NAMES = {1: "ICMP", 2: "IGMP", 6: "TCP", 17: "UDP", 47: "GRE", 50: "ESP", 51: "AH", 58: "ICMPv6", 132: "SCTP"}

# IPv4 ranges in order of precedence; the first that holds an address names its scope.
SCOPES_V4 = [
    ("0.0.0.0/32", "unspecified"), ("127.0.0.0/8", "loopback"), ("169.254.0.0/16", "link-local"), ("100.64.0.0/10", "cgnat"),
    ("10.0.0.0/8", "private"), ("172.16.0.0/12", "private"), ("192.168.0.0/16", "private"),
    ("192.0.0.0/24", "reserved"), ("192.0.2.0/24", "reserved"), ("198.51.100.0/24", "reserved"), ("203.0.113.0/24", "reserved"),
    ("198.18.0.0/15", "reserved"), ("192.88.99.0/24", "reserved"),
    ("224.0.0.0/4", "multicast"), ("255.255.255.255/32", "broadcast"), ("240.0.0.0/4", "reserved"),
]
# The same for IPv6.
SCOPES_V6 = [
    ("::/128", "unspecified"), ("::1/128", "loopback"), ("fe80::/10", "link-local"), ("fc00::/7", "private"), ("ff00::/8", "multicast"),
    ("2001:db8::/32", "reserved"), ("2001::/23", "reserved"), ("100::/64", "reserved"), ("::ffff:0:0/96", "reserved"),
]
#: Scopes that count as private.
PRIVATE = ("private", "loopback", "link-local", "cgnat", "unspecified")


def safe_ratio(n: Column, d: Column, digits: int = 6) -> Column:
    """n / d rounded; 0 where d is 0 or null."""
    return F.coalesce(F.round(F.try_divide(n.cast("double"), d.cast("double")), digits), F.lit(0.0))


def rounded(x: Column, digits: int = 6) -> Column:
    """x rounded, null as 0."""
    return F.coalesce(F.round(x.cast("double"), digits), F.lit(0.0))


def seconds(us: Column) -> Column:
    return us / F.lit(1e6)


def iso_utc(us: Column, millis: bool = True) -> Column:
    """ISO-8601 text of microseconds since 1970, cut (not rounded) to milliseconds or seconds."""
    return F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss" + (".SSS" if millis else "") + "'Z'")


def floor_bucket(epoch: Column, size: int) -> Column:
    """The start of the bucket of ``size`` seconds that holds ``epoch``."""
    return (F.floor(epoch / size) * size).cast("long")


def us_bucket(us: Column, size: int) -> Column:
    """As :func:`floor_bucket`, from whole microseconds."""
    width = size * 1_000_000
    return (us - F.pmod(us, F.lit(width))).cast("long") / F.lit(1_000_000)


def parse_timestamp(x: Column) -> Column:
    """Seconds since 1970 of a number, a numeric text or an ISO text (UTC if it names no zone); else null."""
    text = F.trim(x.cast("string"))
    number = text.try_cast("double")
    number = F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)
    return F.coalesce(number, F.unix_micros(F.try_to_timestamp(text)) / F.lit(1e6))


def number_or(x: Column, default: float = 0.0) -> Column:
    """A dirty cell as a number; blank, non-numeric and not finite cells give ``default``."""
    value = F.trim(F.replace(x.cast("string"), F.lit(","), F.lit(""))).try_cast("double")
    return F.coalesce(F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value), F.lit(default))


def whole_or(x: Column, default: int = 0) -> Column:
    """As :func:`number_or`, cut toward zero."""
    return number_or(x, float(default)).cast("long")


def proto_name(proto: Column) -> Column:
    names = F.create_map(*(F.lit(v) for pair in PROTO_NAMES.items() for v in pair))
    return F.coalesce(F.try_element_at(names, proto.cast("int")), proto.cast("string"))


def proto_class(name: Column) -> Column:
    """TCP, UDP, ICMP or OTHER."""
    up = F.upper(name)
    return F.when(up.isin("TCP", "UDP"), up).when(up.isin("ICMP", "ICMPV6"), "ICMP").otherwise("OTHER")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ipv4_number(ip: Column) -> Column:
    """A dotted address as a long; null if it isn't one."""
    octet = r"(0|[1-9]\d?|1\d\d|2[0-4]\d|25[0-5])"
    value = lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda n, x: n * 256 + x.cast("long"))
    return F.when(ip.rlike(rf"^{octet}(\.{octet}){{3}}$"), value(F.split(ip, r"\.")))


def ipv6_hex(ip: Column) -> Column:
    """32 hex digits of an IPv6 text (embedded IPv4 and a zone too); null if it isn't one."""

    def flat(low: Column) -> Column:
        """Without the embedded IPv4; null if that is no address."""
        tail = F.regexp_extract(low, r"(\d+\.\d+\.\d+\.\d+)$", 1)
        digits = let(F.lpad(F.hex(ipv4_number(tail)), 8, "0"), lambda h: F.concat(F.substring(h, 1, 4), F.lit(":"), F.substring(h, 5, 4)))
        return F.when(~low.contains("."), low).otherwise(F.concat(F.substring(low, F.lit(1), F.length(low) - F.length(tail)), digits))

    groups = lambda half: F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":"))

    def digits(s: Column) -> Column:
        left, right, halves = s["left"], s["right"], s["halves"]
        missing = F.lit(8) - F.size(left) - F.size(right)
        filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
        good = F.forall(F.concat(left, right), lambda g: g.rlike("^[0-9a-fA-F]{1,4}$"))
        shape = F.when(halves == 1, missing == 0).otherwise((halves == 2) & (missing >= 1))
        return F.when(shape & good, F.lower(F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), "")))

    parts = lambda h: F.struct(groups(h[0]).alias("left"), groups(F.coalesce(F.get(h, F.lit(1)), F.lit(""))).alias("right"), F.size(h).alias("halves"))
    whole = let(F.split(flat(F.split(ip, "%")[0]), "::"), lambda h: let(parts(h), digits))
    return F.when(ip.contains(":"), whole)


def _cidr_v4(cidr: str) -> tuple[int, int]:
    import ipaddress

    net = ipaddress.ip_network(cidr)
    return int(net[0]), int(net[-1])


def _cidr_v6(cidr: str) -> tuple[str, str]:
    import ipaddress

    net = ipaddress.ip_network(cidr)
    return f"{int(net[0]):032x}", f"{int(net[-1]):032x}"


def address_scope(ip: Column) -> Column:
    """Scope of an address text; ``public`` if no range holds it, ``invalid`` if it is no address, null for null."""
    four = lambda n: _cases([(n.between(*_cidr_v4(c)), s) for c, s in SCOPES_V4])
    six = lambda h: _cases([(h.between(*_cidr_v6(c)), s) for c, s in SCOPES_V6])
    v4 = let(ipv4_number(ip), lambda n: F.when(n.isNotNull(), four(n)))
    v6 = let(ipv6_hex(ip), lambda h: F.when(h.isNotNull(), six(h)))
    return F.when(ip.isNotNull(), F.coalesce(v4, v6, F.lit("invalid")))


def _cases(pairs: list[tuple[Column, str]]) -> Column:
    out = F.when(*pairs[0])
    for condition, value in pairs[1:]:
        out = out.when(condition, value)
    return out.otherwise("public")


def is_private(scope: Column) -> Column:
    return scope.isin(*PRIVATE)


def has_flag(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0


def unsigned(raw: Column, start: int | Column, width: int) -> Column:
    """``width`` big-endian bytes (seven at most) of a binary, from the 1-based ``start``, as a long."""
    start = F.lit(start) if isinstance(start, int) else start
    return F.conv(F.hex(F.substring(raw, start, F.lit(width))), 16, 10).cast("long")


def ipv4_text(raw: Column, start: int | Column) -> Column:
    """Four bytes of a binary as a dotted address."""
    start = F.lit(start) if isinstance(start, int) else start
    return F.concat_ws(".", *(unsigned(raw, start + k, 1) for k in range(4)))


def octet_text(raw: Column) -> Column:
    """Bytes as text where all are printable, else as hex pairs with colons."""
    text = F.decode(raw, "iso-8859-1")
    return F.when(text.rlike(r"^[\x20-\x7e\r\n\t]*$"), text).otherwise(F.regexp_replace(F.lower(F.hex(raw)), "(..)(?!$)", "$1:"))


def safe_stem(name: Column) -> Column:
    """A file name with every sign but letters, digits, ``-``, ``_`` and ``.`` replaced by ``_``."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_.\-]", "_")


def csv_cell(x: Column, is_text: bool) -> Column:
    """A cell safe for spreadsheets: not-finite numbers are empty, texts that begin like a formula get a quote in front."""
    if is_text:
        return F.when((F.length(x) > 1) & x.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), x)).otherwise(x)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def entropy(count: Column) -> Column:
    """Shannon entropy in bits of a distribution given by counts, as an aggregate; 0 for none."""
    c = count.cast("double")
    total = F.sum(c)
    bits = F.log2(total) - F.sum(c * F.log2(c)) / total
    return F.coalesce(F.round(F.greatest(bits, F.lit(0.0)), 6), F.lit(0.0)) + F.lit(0.0)


def sample_variance(x: Column) -> Column:
    """Variance with n - 1 as denominator, as an aggregate; 0 for fewer than two values."""
    return F.coalesce(F.nanvl(F.var_samp(x), F.lit(0.0)), F.lit(0.0))

"""Device telemetry as it lands (SNMP columns, JSON bodies, command output) to interface and device samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.functions.exprs import number_or

#: Counters of an interface sample, in order.
COUNTERS = [f"{d}_{c}" for c in ("octets", "packets", "errors", "discards") for d in ("in", "out")]
# SNMP columns by name (ifTable and ifXTable).
SNMP_COLUMNS = "ifDescr ifName ifAlias ifAdminStatus ifOperStatus ifSpeed ifHighSpeed ifHCInOctets ifHCOutOctets ifInOctets ifOutOctets ifHCInUcastPkts ifHCOutUcastPkts ifInUcastPkts ifOutUcastPkts ifInErrors ifOutErrors ifInDiscards ifOutDiscards".split()
_STATUS = {"1": "up", "2": "down", "3": "testing", "4": "unknown", "5": "dormant", "6": "notPresent", "7": "lowerLayerDown"}


def _status(code: Column) -> Column:
    names = F.create_map(*(F.lit(x) for pair in _STATUS.items() for x in pair))
    return F.coalesce(F.try_element_at(names, code), F.lit("unknown"))


def _whole(x: Column) -> Column:
    return x.cast("string").try_cast("decimal(20,0)")


def snmp_interfaces(walked: DataFrame) -> DataFrame:
    """Interface samples from walked columns (device, epoch, column, row_index, value as text).

    64-bit counters count before 32-bit ones, ifHighSpeed (Mbit/s) before
    ifSpeed; the name is ifName, else ifDescr, else ``if`` and the index.
    Interfaces are those that ifDescr lists.
    """
    wide = walked.groupBy("device", "epoch", F.col("row_index").cast("int").alias("if_index")).pivot("column", SNMP_COLUMNS).agg(F.first("value", ignorenulls=True))
    text = lambda c: F.nullif(F.col(c), F.lit(""))
    high = _whole(F.col("ifHighSpeed"))
    either = lambda a, b: F.coalesce(_whole(F.col(a)), _whole(F.col(b)))
    return wide.where("ifDescr IS NOT NULL").select(
        "device", "epoch", "if_index", F.coalesce(text("ifName"), text("ifDescr"), F.concat(F.lit("if"), F.col("if_index"))).alias("if_name"), F.coalesce(text("ifAlias"), F.lit("")).alias("if_alias"),
        _status(F.col("ifAdminStatus")).alias("admin_status"), _status(F.col("ifOperStatus")).alias("oper_status"),
        F.coalesce(F.when(high > 0, high * 1_000_000), _whole(F.col("ifSpeed")), F.lit(0)).cast("long").alias("speed_bps"),
        either("ifHCInOctets", "ifInOctets").alias("in_octets"), either("ifHCOutOctets", "ifOutOctets").alias("out_octets"), either("ifHCInUcastPkts", "ifInUcastPkts").alias("in_packets"), either("ifHCOutUcastPkts", "ifOutUcastPkts").alias("out_packets"),
        *(_whole(F.col(f"if{d}{c}")).alias(f"{d.lower()}_{c.lower()}") for c in ("Errors", "Discards") for d in ("In", "Out")),
    )


def table_counts(walked: DataFrame) -> DataFrame:
    """Rows of each walked column: device, epoch, column, entries."""
    return walked.groupBy("device", "epoch", "column").agg(F.count(F.lit(1)).alias("entries"))


def _sample(base: list, name: Column, admin: Column, oper: Column, speed: Column, counters: dict[str, Column], index: Column, alias: Column | None = None) -> list[Column]:
    made = [index.cast("int").alias("if_index"), name.alias("if_name"), F.coalesce(alias if alias is not None else F.lit(""), F.lit("")).alias("if_alias"), F.lower(admin).alias("admin_status"), F.lower(oper).alias("oper_status"), F.coalesce(speed, F.lit(0)).cast("long").alias("speed_bps")]
    return [*base, *made, *(_whole(counters[c]).alias(c) if c in counters else F.lit(None).cast("decimal(20,0)").alias(c) for c in COUNTERS)]


_RESTCONF = "struct<`ietf-interfaces:interfaces-state`: struct<interface: array<struct<name: string, `if-index`: string, description: string, `admin-status`: string, `oper-status`: string, speed: string, statistics: struct<`in-octets`: string, `out-octets`: string, `in-unicast-pkts`: string, `out-unicast-pkts`: string, `in-errors`: string, `out-errors`: string, `in-discards`: string, `out-discards`: string>>>>>"


def restconf_interfaces(polls: DataFrame) -> DataFrame:
    """Interface samples from RESTCONF bodies (device, epoch, body)."""
    p = polls.select("device", "epoch", F.posexplode(F.from_json("body", _RESTCONF)["ietf-interfaces:interfaces-state"]["interface"]).alias("at", "i"))
    i, s = F.col("i"), F.col("i.statistics")
    pkts = {"octets": "octets", "packets": "unicast-pkts", "errors": "errors", "discards": "discards"}
    counters = {f"{d}_{c}": s[f"{d}-{n}"] for d in ("in", "out") for c, n in pkts.items()}
    return p.select(*_sample([F.col("device"), F.col("epoch")], i["name"], i["admin-status"], i["oper-status"], _whole(i["speed"]), counters, F.coalesce(i["if-index"].try_cast("int"), F.col("at") + 1), i["description"]))


_EAPI_COUNTERS = "inOctets: string, outOctets: string, inUcastPkts: string, outUcastPkts: string, totalInErrors: string, totalOutErrors: string, inDiscards: string, outDiscards: string"
_EAPI = f"struct<result: array<struct<interfaces: map<string, struct<description: string, lineProtocolStatus: string, interfaceStatus: string, bandwidth: string, interfaceCounters: struct<{_EAPI_COUNTERS}>>>, memTotal: double, memFree: double, uptime: double, modelName: string, version: string>>>"


def eapi_interfaces(polls: DataFrame) -> DataFrame:
    """Interface samples from eAPI bodies, whose interfaces are a map by name; they are numbered in order of name."""
    r = polls.select("device", "epoch", F.explode(F.from_json("body", _EAPI)["result"]).alias("r")).where("r.interfaces IS NOT NULL")
    e = r.select("device", "epoch", F.posexplode(F.array_sort(F.map_entries("r.interfaces"))).alias("at", "i"))
    v, c = F.col("i.value"), F.col("i.value.interfaceCounters")
    names = {"octets": ("inOctets", "outOctets"), "packets": ("inUcastPkts", "outUcastPkts"), "errors": ("totalInErrors", "totalOutErrors"), "discards": ("inDiscards", "outDiscards")}
    counters = {f"{d}_{k}": c[n[j]] for k, n in names.items() for j, d in enumerate(("in", "out"))}
    return e.select(*_sample([F.col("device"), F.col("epoch")], F.col("i.key"), v["interfaceStatus"], v["lineProtocolStatus"], _whole(v["bandwidth"]), counters, F.col("at") + 1, v["description"]))


def eapi_devices(polls: DataFrame) -> DataFrame:
    """memory_percent, uptime_s and description from the version part of eAPI bodies."""
    r = polls.select("device", "epoch", F.explode(F.from_json("body", _EAPI)["result"]).alias("r")).where("r.memTotal IS NOT NULL")
    used = F.when(F.col("r.memTotal") > 0, F.lit(100.0) * (F.col("r.memTotal") - F.col("r.memFree")) / F.col("r.memTotal"))
    return r.select("device", "epoch", F.round(used, 2).alias("memory_percent"), F.round("r.uptime", 1).alias("uptime_s"), F.concat_ws(" ", "r.modelName", "r.version").alias("system_description"))


_NXAPI_ROW = "struct<interface: string, desc: string, admin_state: string, state: string, eth_bw: string, eth_inbytes: string, eth_outbytes: string, eth_inucast: string, eth_outucast: string, eth_inerr: string, eth_outerr: string, eth_indiscard: string, eth_outdiscard: string>"


def nxapi_interfaces(polls: DataFrame) -> DataFrame:
    """Interface samples from NX-API bodies, whose row is an object or a list of objects; bandwidth is in kbit/s."""
    row = F.get_json_object("body", "$.ins_api.outputs.output.body.TABLE_interface.ROW_interface")
    rows = F.coalesce(F.when(F.ltrim(row).startswith("["), F.from_json(row, f"array<{_NXAPI_ROW}>")), F.array(F.from_json(row, _NXAPI_ROW)))
    e = polls.select("device", "epoch", row.alias("row"), F.posexplode(rows).alias("at", "i")).where("row IS NOT NULL")
    i = F.col("i")
    names = {"octets": "bytes", "packets": "ucast", "errors": "err", "discards": "discard"}
    counters = {f"{d}_{c}": i[f"eth_{d}{n}"] for d in ("in", "out") for c, n in names.items()}
    return e.select(*_sample([F.col("device"), F.col("epoch")], i["interface"], i["admin_state"], i["state"], _whole(i["eth_bw"]) * 1000, counters, F.col("at") + 1, i["desc"]))


def cli_fields(outputs: DataFrame, pattern: str, groups: list[str], scope: str = "interface") -> DataFrame:
    """Fields from command output (device, epoch, output) by a regular expression whose groups are ``groups``, in order.

    ``interface``: one row per match, merged by if_name with the last value
    found; ``device``: the first match only.  Fields are text.
    """
    found = [F.regexp_extract_all("output", F.lit(pattern), F.lit(k + 1)).alias(g) for k, g in enumerate(groups)]
    rows = outputs.select("device", "epoch", *found).select("device", "epoch", F.posexplode(F.arrays_zip(*groups)).alias("at", "m")).select("device", "epoch", "at", "m.*")
    if scope == "device":
        return rows.where("at = 0").drop("at")
    rest = [g for g in groups if g != "if_name"]
    latest = [F.max_by(F.nullif(F.col(g), F.lit("")), F.when(F.col(g) != "", F.col("at"))).alias(g) for g in rest]
    return rows.groupBy("device", "epoch", "if_name").agg(*latest)


def cli_number(x: Column) -> Column:
    """A number with thousands separators; null if it isn't one."""
    return F.replace(F.trim(x), F.lit(","), F.lit("")).try_cast("double")


def dirty_number(x: Column) -> Column:
    return number_or(x)

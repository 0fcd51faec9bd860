"""Interface counters: deltas with wrap and reset rules, and the roll-up to devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.functions.exprs import iso_utc
from netloom.schemas import DEVICE_COLUMNS, INTERFACE_COLUMNS

COUNTERS = [f"{d}_{c}" for c in ("octets", "packets", "errors", "discards") for d in ("in", "out")]
WRAP = 1 << 32


def counter_deltas(samples: DataFrame, keys: tuple[str, ...] = ("device", "if_index", "if_name")) -> DataFrame:
    """Adds interval_s, first_sample, counter_reset and ``<counter>_delta`` to reachable samples.

    The sample before is the last of the same key.  A counter that fell has
    wrapped if its old value fits 32 bits and the wrapped difference is
    plausible: at most 1.5 times what the line speed allows, or under 2**31 where
    the speed is unknown.  Otherwise it was reset and its delta is 0.  A null on
    either side gives no delta.
    """
    over = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY epoch, {'arrival' if 'arrival' in samples.columns else 'epoch'})"
    prev = samples.withColumns({f"__{c}": F.expr(f"lag({c}) {over}") for c in COUNTERS} | {"__epoch": F.expr(f"lag(epoch) {over}"), "__seen": F.expr(f"row_number() {over}")})
    first = F.col("__seen") == 1
    interval = F.greatest(F.lit(0.0), F.col("epoch") - F.col("__epoch"))
    speed = F.coalesce(F.col("speed_bps"), F.lit(0))

    def parts(c: str) -> tuple[Column, Column]:
        new, old = F.col(c).cast("decimal(20,0)"), F.col(f"__{c}").cast("decimal(20,0)")
        wrapped = new + F.lit(WRAP) - old
        fits = (old < WRAP) & (((interval > 0) & (speed > 0) & (wrapped <= speed / 8 * interval * 1.5)) | ((speed == 0) & (wrapped < 1 << 31)))
        known = new.isNotNull() & old.isNotNull()
        delta = F.when(known, F.when(new >= old, new - old).when(fits, wrapped).otherwise(0)).cast("long")
        return delta, F.coalesce(known & (new < old) & ~F.coalesce(fits, F.lit(False)), F.lit(False))

    made = {c: parts(c) for c in COUNTERS}
    reset = F.lit(False)
    for _, r in made.values():
        reset = reset | r
    added = {f"{c}_delta": d for c, (d, _) in made.items()} | {"interval_s": F.when(~first, interval), "first_sample": first, "counter_reset": (reset & ~first).cast("int")}
    return prev.withColumns(added).drop("__epoch", "__seen", *(f"__{c}" for c in COUNTERS))


def rate(delta: Column, interval: Column) -> Column:
    """A delta per second, null without an interval."""
    return F.when(interval > 0, F.round(delta / interval, 3))


def utilisation(bytes_per_s: Column, speed_bps: Column) -> Column:
    return F.when(speed_bps > 0, F.round(F.lit(100.0) * bytes_per_s / (speed_bps / 8), 3))


def interface_rows(deltas: DataFrame) -> DataFrame:
    """The interface row of each sample."""
    have = set(deltas.columns)
    text = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    made = {
        "timestamp": iso_utc((F.col("epoch") * 1_000_000).cast("long"), millis=False), "epoch": F.round("epoch", 3), "if_alias": text("if_alias"), "admin_status": text("admin_status"), "oper_status": text("oper_status"),
        "interval_s": F.nullif(F.col("interval_s"), F.lit(0.0)), "in_bytes_per_s": rate(F.col("in_octets_delta"), F.col("interval_s")), "out_bytes_per_s": rate(F.col("out_octets_delta"), F.col("interval_s")),
    }
    made |= {f"utilisation_{d}_pct": utilisation(made[f"{d}_bytes_per_s"], F.col("speed_bps")) for d in ("in", "out")}
    return deltas.select(*(made.get(c, F.col(c)).alias(c) for c in INTERFACE_COLUMNS))


def is_up(status: Column) -> Column:
    return F.lower(F.trim(status.cast("string"))).isin("up", "connected", "1")


def device_rows(polls: DataFrame, deltas: DataFrame) -> DataFrame:
    """One row per poll.  ``polls``: device, epoch, driver, reachable, poll_ms, error and the device's own metrics.

    Rates and deltas are null where no interface has an interval; an
    unreachable poll has no metrics at all.
    """
    s = deltas.groupBy("device", "epoch").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(is_up(F.col("oper_status"))).alias("up"), F.max("interval_s").alias("longest"), F.count_if(F.col("interval_s") > 0).alias("rated"), F.sum("counter_reset").alias("resets"),
        *(F.sum(rate(F.col(f"{d}_octets_delta"), F.col("interval_s"))).alias(f"{d}_rate") for d in ("in", "out")),
        *(F.coalesce(F.sum(f"{c}_delta"), F.lit(0)).alias(c) for c in COUNTERS if "octets" not in c),
    )
    j = polls.join(s, ["device", "epoch"], "left")
    here, rated = F.col("reachable"), F.coalesce(F.col("rated"), F.lit(0)) > 0
    have = set(j.columns)
    own = lambda c, kind, digits=None: (F.round(F.col(c), digits) if digits is not None else F.col(c)) if c in have else F.lit(None).cast(kind)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    cols = {
        "interfaces_total": zero("total"), "interfaces_up": zero("up"), "interfaces_down": zero("total") - zero("up"), "counter_resets": zero("resets"),
        **{f"{d}_bytes_per_s": F.when(rated, F.round(F.coalesce(F.col(f"{d}_rate"), F.lit(0.0)), 3)) for d in ("in", "out")}, **{f"{d}_packets_per_s": F.when(F.col("longest") > 0, F.round(F.col(f"{d}_packets") / F.col("longest"), 3)) for d in ("in", "out")},
        **{f"{d}_{c}_delta": F.when(rated, F.col(f"{d}_{c}")) for d in ("in", "out") for c in ("errors", "discards")},
        **{c: own(c, "long") for c in ("arp_entries", "mac_entries", "route_entries")}, "cpu_percent": own("cpu_percent", "double", 2), "memory_percent": own("memory_percent", "double", 2), "uptime_s": own("uptime_s", "double", 1),
        "system_name": own("system_name", "string"), "system_description": own("system_description", "string"),
    }
    cols = {c: F.when(here, v) for c, v in cols.items()}
    cols |= {"timestamp": iso_utc((F.col("epoch") * 1_000_000).cast("long"), millis=False), "epoch": F.round("epoch", 3), "device": F.col("device"), "driver": own("driver", "string"), "reachable": here.cast("int"), "poll_ms": own("poll_ms", "double", 1), "error": own("error", "string")}
    return j.select(*(cols[c].alias(c) for c in DEVICE_COLUMNS))

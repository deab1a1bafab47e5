"""Text line -> typed row.

``on_error="fail"`` raises on a malformed number or a short line (the
reference job dies on the first bad line); ``"drop"`` discards such lines.
Splitting keeps empty fields as ``''`` (an empty tx id stays ``''``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.time import from_epoch_ms, from_epoch_s

# A field spec: (output name, position, kind).  Kinds: "long", "string",
# "epoch_s", "epoch_ms", "text_time".
_NUMERIC = {"long", "epoch_s", "epoch_ms"}


def _convert(raw: Column, kind: str, time_pattern: str) -> tuple[Column, Column]:
    """(value, ok) for one field."""
    if kind == "string":
        return raw, raw.isNotNull()
    if kind in _NUMERIC:
        v = raw.try_cast("long")
        val = {"long": v, "epoch_s": from_epoch_s(v), "epoch_ms": from_epoch_ms(v)}[kind]
        return val, v.isNotNull()
    if kind == "text_time":
        v = F.try_to_timestamp(raw, F.lit(time_pattern))
        return v, v.isNotNull()
    raise ValueError(kind)


def parse_delimited(df: DataFrame, sep: str, fields: list[tuple[str, int, str]],
                    on_error: str = "fail", value_col: str = "value",
                    time_pattern: str = "dd/MM/yyyy:HH:mm:ss", keep=("seq",)) -> DataFrame:
    """Split ``value_col`` on the regex ``sep``, trim, convert, validate."""
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be 'fail' or 'drop'")
    width = max(p for _, p, _ in fields) + 1

    def parsed(parts: Column) -> Column:
        vals, good = [], F.size(parts) >= width
        for name, pos, kind in fields:
            v, ok = _convert(F.trim(F.get(parts, pos)), kind, time_pattern)
            vals.append(v.alias(name))
            good = good & ok
        return F.struct(*vals, good.alias("_ok"))
    # the fields of a line are bound once, however often they are looked at: a line is split once
    one = F.transform(F.array(F.split(F.col(value_col), sep, -1)), parsed)
    kept = [c for c in keep if c in df.columns]
    out = df.select(*kept, F.col(value_col).alias("_line"), F.explode(one).alias("_f"))
    ok = F.coalesce(F.col("_f._ok"), F.lit(False))
    if on_error == "drop":
        out = out.filter(ok)
    else:
        out = out.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce("_line", F.lit("null"))))))
    return out.select(*(F.col("_f")[n].alias(n) for n, _, _ in fields), *kept)


# R1 user behaviour: user_id, item_id, category_id, behavior, ts (epoch s)
def parse_user_behavior(df: DataFrame, on_error: str = "fail") -> DataFrame:
    return parse_delimited(df, ",", [("user_id", 0, "long"), ("item_id", 1, "long"),
                                     ("category_id", 2, "long"), ("behavior", 3, "string"),
                                     ("ts", 4, "epoch_s")], on_error)


# R2 web log: ip, user_id, -, time dd/MM/yyyy:HH:mm:ss, (zone), method, url
def parse_web_log(df: DataFrame, on_error: str = "fail") -> DataFrame:
    return parse_delimited(df, " ", [("ip", 0, "string"), ("user_id", 1, "string"),
                                     ("ts", 3, "text_time"), ("method", 5, "string"),
                                     ("url", 6, "string")], on_error)


# R3 ad click: user_id, ad_id, province, city, ts (epoch s)
def parse_ad_clicks(df: DataFrame, on_error: str = "fail") -> DataFrame:
    return parse_delimited(df, ",", [("user_id", 0, "long"), ("ad_id", 1, "long"),
                                     ("province", 2, "string"), ("city", 3, "string"),
                                     ("ts", 4, "epoch_s")], on_error)


# R4 login: user_id, ip, event_type, ts (epoch s)
def parse_logins(df: DataFrame, on_error: str = "fail") -> DataFrame:
    return parse_delimited(df, ",", [("user_id", 0, "long"), ("ip", 1, "string"),
                                     ("event_type", 2, "string"), ("ts", 3, "epoch_s")], on_error)


# R5 order: order_id, event_type, tx_id (may be empty), ts (epoch s)
def parse_orders(df: DataFrame, on_error: str = "fail") -> DataFrame:
    return parse_delimited(df, ",", [("order_id", 0, "long"), ("event_type", 1, "string"),
                                     ("tx_id", 2, "string"), ("ts", 3, "epoch_s")], on_error)


# R6 receipt: tx_id, pay_channel, ts (epoch s)
def parse_receipts(df: DataFrame, on_error: str = "fail") -> DataFrame:
    return parse_delimited(df, ",", [("tx_id", 0, "string"), ("pay_channel", 1, "string"),
                                     ("ts", 2, "epoch_s")], on_error)


# Marketing behaviour (typed source in the reference, ts in epoch ms)
def parse_marketing(df: DataFrame, on_error: str = "fail") -> DataFrame:
    return parse_delimited(df, ",", [("user_id", 0, "string"), ("behavior", 1, "string"),
                                     ("channel", 2, "string"), ("ts", 3, "epoch_ms")], on_error)

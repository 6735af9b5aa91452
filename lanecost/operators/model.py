"""Landing, staging, enrichment, cost decomposition and disclosure flags.

Row-preserving operators: projections plus left joins to small reference
dimensions. Dimensions are broadcast only after their size and key uniqueness
are checked, so the fact table is never shuffled for enrichment and the row
count cannot change.
"""

from __future__ import annotations

import logging
from functools import reduce
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.functions.expr import col, text_bool
from lanecost.operators.clean import require_columns

log = logging.getLogger(__name__)

# Fixed landing table: 34 columns, matched to the curated output by name,
# ignoring case.
LANDING_SCHEMA = T.StructType([
    T.StructField("Standard Note", T.StringType()),
    T.StructField("access point", T.StringType()),
    T.StructField("cc_number", T.IntegerType()),
    T.StructField("corridor", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("date_raw", T.StringType()),
    T.StructField("destination_code", T.StringType()),
    T.StructField("destination_income", T.StringType()),
    T.StructField("destination_lending", T.StringType()),
    T.StructField("destination_name", T.StringType()),
    T.StructField("destination_region", T.StringType()),
    T.StructField("firm", T.StringType()),
    T.StructField("firm_type", T.StringType()),
    T.StructField("fx margin", T.DoubleType()),
    T.StructField("id", T.LongType()),
    T.StructField("inter lcu bank fx", T.DoubleType()),
    T.StructField("lcu amount", T.DoubleType()),
    T.StructField("lcu code", T.StringType()),
    T.StructField("lcu fee", T.DoubleType()),
    T.StructField("lcu fx rate", T.DoubleType()),
    T.StructField("payment instrument", T.StringType()),
    T.StructField("period", T.StringType()),
    T.StructField("period_quarter", T.IntegerType()),
    T.StructField("period_year", T.IntegerType()),
    T.StructField("pickup method", T.StringType()),
    T.StructField("receiving network coverage", T.StringType()),
    T.StructField("send_amount", T.DoubleType()),
    T.StructField("source_G8G20", T.StringType()),
    T.StructField("source_code", T.StringType()),
    T.StructField("source_income", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("speed actual", T.StringType()),
    T.StructField("total cost %", T.DoubleType()),
    T.StructField("transparent", T.StringType()),
])

# Staging: (target, source, kind). kind: text = trim, long/int = cast,
# date = cast to date, amount = fixed 6 decimals (held as double, see README).
STAGE_MAPPING: tuple[tuple[str, str, str], ...] = (
    ("raw_id", "id", "long"),
    ("corridor", "corridor", "text"),
    ("firm", "firm", "text"),
    ("firm_type", "firm_type", "text"),
    ("payment_instrument", "payment instrument", "text"),
    ("pickup_method", "pickup method", "text"),
    ("access_point", "access point", "text"),
    ("speed_actual", "speed actual", "text"),
    ("receiving_network_coverage", "receiving network coverage", "text"),
    ("transparent", "transparent", "text"),
    ("source_code", "source_code", "text"),
    ("source_country_name", "source_name", "text"),
    ("source_income_group_as_reported", "source_income", "text"),
    ("source_g8g20", "source_G8G20", "text"),
    ("destination_code", "destination_code", "text"),
    ("destination_country_name", "destination_name", "text"),
    ("destination_region", "destination_region", "text"),
    ("destination_income_group_as_reported", "destination_income", "text"),
    ("destination_lending_category", "destination_lending", "text"),
    ("transaction_date", "date", "date"),
    ("date_raw", "date_raw", "text"),
    ("period_label", "period", "text"),
    ("period_year", "period_year", "int"),
    ("period_quarter", "period_quarter", "int"),
    ("cc_number", "cc_number", "int"),
    ("lcu_code", "lcu code", "text"),
    ("send_amount", "send_amount", "amount"),
    ("lcu_amount", "lcu amount", "amount"),
    ("lcu_fee", "lcu fee", "amount"),
    ("lcu_fx_rate", "lcu fx rate", "amount"),
    ("inter_lcu_bank_fx", "inter lcu bank fx", "amount"),
    ("fx_margin", "fx margin", "amount"),
    ("total_cost_pct", "total cost %", "amount"),
    ("standard_note", "Standard Note", "text"),
)

# Fixed reference values: the one corridor-code remap and the two CFA franc zones
# (sending countries whose 'CFA' resolves to XOF or XAF).
CODE_REMAP = {"KSV": "XKX"}
CFA_MARKER = "CFA"
CFA_ZONES = {
    "XOF": ("CIV", "SEN", "BEN", "BFA", "GNB", "MLI", "NER", "TGO"),
    "XAF": ("CMR", "CAF", "TCD", "COG", "GNQ", "GAB"),
}
MISMATCH_TOLERANCE = 0.01
# Largest dimension, in measured bytes, that is hinted for broadcast.
DIM_MAX_BYTES = 32 << 20


def conform_landing(df: DataFrame, schema: T.StructType = LANDING_SCHEMA) -> DataFrame:
    """Select ``schema``'s columns by case-insensitive name and cast them.

    Extra source columns are dropped (and logged); a missing one becomes a typed
    null; two source columns matching one target is an error.
    """
    by_lower: dict[str, list[str]] = {}
    for c in df.columns:
        by_lower.setdefault(c.lower(), []).append(c)
    out, used = [], set()
    for f in schema.fields:
        matches = by_lower.get(f.name.lower(), [])
        if len(matches) > 1:
            raise ValueError(f"ambiguous columns for {f.name!r}: {matches}")
        if matches:
            used.add(matches[0])
            out.append(col(matches[0]).cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    dropped = [c for c in df.columns if c not in used]
    if dropped:
        log.info("conform_landing drops columns not in the landing schema: %s", dropped)
    return df.select(*out)


def _stage_expr(source: str, kind: str) -> Column:
    c = col(source)
    if kind == "text":
        return F.trim(c)
    if kind == "long":
        return c.cast("long")
    if kind == "int":
        return c.cast("int")
    if kind == "date":
        return c.cast("date")
    if kind == "amount":
        return c.cast(T.DecimalType(18, 6)).cast("double")
    raise ValueError(f"unknown staging kind {kind!r}")


def stage_typed(df: DataFrame, mapping: Sequence[tuple[str, str, str]] = STAGE_MAPPING) -> DataFrame:
    """Landing -> typed, renamed, trimmed staging columns. 1:1, no filter."""
    require_columns(df, [s for _, s, _ in mapping])
    return df.select(*[_stage_expr(s, k).alias(t) for t, s, k in mapping])


def _remapped(code: Column, remap: Mapping[str, str]) -> Column:
    expr = None
    for k, v in remap.items():
        expr = (F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v)))
    return code if expr is None else expr.otherwise(code)


def corridor_codes(df: DataFrame, column: str = "corridor",
                   remap: Mapping[str, str] | None = None,
                   sending: str = "sending_country_code",
                   receiving: str = "receiving_country_code") -> DataFrame:
    """First and last three characters of the corridor, with code remaps applied."""
    remap = CODE_REMAP if remap is None else remap
    c = col(column)
    return df.withColumns({
        sending: _remapped(F.left(c, F.lit(3)), remap),
        receiving: _remapped(F.right(c, F.lit(3)), remap),
    })


def resolve_currency(df: DataFrame, code_column: str = "lcu_code",
                     corridor_column: str = "corridor",
                     zones: Mapping[str, Sequence[str]] | None = None,
                     marker: str = CFA_MARKER,
                     out: str = "lcu_code_resolved") -> DataFrame:
    """A shared-currency marker resolves by the sending country's zone; else unchanged."""
    zones = CFA_ZONES if zones is None else zones
    code, sender = col(code_column), F.left(col(corridor_column), F.lit(3))
    expr = None
    for resolved, senders in zones.items():
        cond = (code == marker) & sender.isin(list(senders))
        expr = F.when(cond, F.lit(resolved)) if expr is None else expr.when(cond, F.lit(resolved))
    return df.withColumn(out, code if expr is None else expr.otherwise(code))


def checked_dim(dim: DataFrame, key: str, max_bytes: int = DIM_MAX_BYTES) -> DataFrame:
    """A dimension whose key is proven unique (enrichment keeps the row count), hinted
    for broadcast only if its values were measured to be under ``max_bytes``; one small
    job. Beyond that the planner joins it by shuffle."""
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(col(c).cast("string")), F.lit(0)) + 16 for c in dim.columns])
    stats = dim.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(col(key)).alias("k"),
                    F.count_if(col(key).isNull()).alias("z"), F.sum(width.cast("long")).alias("bytes")).first()
    if stats["k"] + min(stats["z"], 1) != stats["n"]:
        raise ValueError(f"dimension key {key!r} is not unique")
    return F.broadcast(dim) if (stats["bytes"] or 0) <= max_bytes else dim


def enrich_corridor(df: DataFrame, country_dim: DataFrame, currency_dim: DataFrame,
                    remap: Mapping[str, str] | None = None,
                    zones: Mapping[str, Sequence[str]] | None = None,
                    dim_max_bytes: int = DIM_MAX_BYTES) -> DataFrame:
    """Country codes, resolved currency, and three left joins to reference dims.

    Sending and receiving codes each pick region and income from the country
    dim (role-playing joins); the resolved currency code picks its name. The raw
    ``lcu_code`` is re-emitted as ``lcu_code_raw``.
    """
    base = resolve_currency(corridor_codes(df, remap=remap), zones=zones)
    countries = checked_dim(country_dim, "country_iso3", dim_max_bytes)
    currencies = checked_dim(currency_dim, "currency_code", dim_max_bytes)
    src = countries.select(col("country_iso3").alias("__src"),
                           col("region").alias("source_region"),
                           col("income_group").alias("source_income_group_current"))
    dst = countries.select(col("country_iso3").alias("__dst"),
                           col("region").alias("destination_region_current"),
                           col("income_group").alias("destination_income_group_current"))
    cur = currencies.select(col("currency_code").alias("__cur"),
                            col("currency_name").alias("sending_currency_name"))
    joined = (base.join(src, col("sending_country_code") == col("__src"), "left")
                  .join(dst, col("receiving_country_code") == col("__dst"), "left")
                  .join(cur, col("lcu_code_resolved") == col("__cur"), "left"))
    keep = [c for c in base.columns if c != "lcu_code"]
    return joined.select(*[col(c) for c in keep], col("lcu_code").alias("lcu_code_raw"),
                         "source_region", "source_income_group_current",
                         "destination_region_current", "destination_income_group_current",
                         "sending_currency_name")


def star_except(df: DataFrame, column: str, new_name: str) -> DataFrame:
    """All columns but ``column``, which is re-emitted last as ``new_name``."""
    return df.select(*[col(c) for c in df.columns if c != column], col(column).alias(new_name))


def cost_decompose(df: DataFrame, fee: str = "lcu_fee", amount: str = "lcu_amount",
                   margin: str = "fx_margin") -> DataFrame:
    """Fee as % of the amount (null for a zero/null amount) plus the FX margin."""
    fee_pct = col(fee) / F.nullif(col(amount), F.lit(0.0)) * F.lit(100)
    out = star_except(df, margin, "fx_margin_pct").withColumn("fee_cost_pct", fee_pct)
    return out.withColumn("decomposed_cost_pct", col("fee_cost_pct") + col("fx_margin_pct"))


def flag_transparency(df: DataFrame, tolerance: float = MISMATCH_TOLERANCE,
                      transparent: str = "transparent") -> DataFrame:
    """Three-valued disclosure flags and their count (a null flag counts 0)."""
    total, dec = col("total_cost_pct"), col("decomposed_cost_pct")
    flagged = df.withColumns({
        "is_disclosed_transparent": text_bool(col(transparent)),
        "total_cost_pct_missing": total.isNull(),
        "cost_components_missing": col("fee_cost_pct").isNull() | col("fx_margin_pct").isNull(),
        "cost_mismatch_flag": F.when(dec.isNull() | total.isNull(), F.lit(None).cast("boolean"))
                               .otherwise(F.abs(dec - total) > F.lit(tolerance)),
    })
    one = lambda c: F.when(col(c), 1).otherwise(0)
    return flagged.withColumn(
        "transparency_flag_count",
        one("total_cost_pct_missing") + one("cost_components_missing") + one("cost_mismatch_flag"))

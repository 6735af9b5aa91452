"""The wide quote table and reference dimensions derived from the shared tables.

The benchmark tables are a TPC-H style star; this maps them onto the wide,
side-by-side tier shape the operators expect (lineitem x orders x customer x
supplier, one quote per lineitem), so every operator runs on data whose size
grows with the input. The same derivation is written in SQL in
``lanecost.catalog.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanecost.functions.expr import col

# Parameters of the derived data set.
SPOTLIGHT_COUNTRY = "N07"
CODE_REMAP = {"N24": "X24"}
CFA_ZONES = {"XOF": ("N00", "N04", "N08"), "XAF": ("N12", "N16")}
COUNTRY_GAPS = (5, 17)      # nation keys left out of the country dim
CURRENCY_GAPS = (9,)        # nation keys left out of the currency dim
RESOLVED_CURRENCIES = (("XOF", "West African CFA franc"), ("XAF", "Central African CFA franc"))

WIDE_TIER_FIELDS = ("denomination amount", "lcu amount", "lcu code", "lcu fee",
                    "lcu fx rate", "fx margin", "total cost %")
QUOTE_COLUMNS = ("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_suppkey", "l_returnflag",
                 "l_linestatus", "o_orderdate", "o_orderpriority", "o_orderstatus", "c_custkey", "c_nationkey",
                 "c_mktsegment", "s_name", "s_nationkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def code(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 2, "0"))


def _geo(side: str, k: Column) -> dict[str, Column]:
    s = lambda x: x.cast("string")
    return {
        f"{side}_code": code("N", k),
        f"{side}_name": F.concat(F.lit("NATION_"), s(k)),
        f"{side}_region": F.when(k % 5 == 0, F.lit("..")).otherwise(F.concat(F.lit("R"), s(k % 5))),
        f"{side}_income": F.when(k % 6 == 0, F.lit("..")).otherwise(F.concat(F.lit("I"), s(k % 4))),
        f"{side}_lending": F.when(k % 3 == 0, F.lit("..")).otherwise(F.concat(F.lit("L"), s(k % 3))),
        f"{side}_G8G20": F.when(k % 7 == 0, F.lit("..")).when(k < 12, F.lit("G20")).otherwise(F.lit("Other")),
    }


def wide_quotes(spark: SparkSession, sf_dir: str, dealt: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One wide quote per lineitem: shared columns plus two ``cc1``/``cc2`` tiers. ``dealt``
    filters or deals out the joined rows (``id``, ``period`` and the columns that the quotes
    are made of) before they are made wide, so that a shuffle moves few columns."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer")
    su = table(spark, sf_dir, "supplier")
    # orders meet customer before lineitem does, so that the larger fact is shuffled once
    # also where customer is too large to broadcast. lineitem x orders is a fact-to-fact join
    # that shuffles at any real scale; a merge join spills whatever the size of a side, and
    # the narrow chain after it runs with shuffle-partition parallelism. customer and
    # supplier are left to the planner.
    j = (li.join(od.join(cu, od.o_custkey == cu.c_custkey).hint("merge"), li.l_orderkey == od.o_orderkey)
           .join(su, li.l_suppkey == su.s_suppkey))
    odate = col("o_orderdate")
    j = j.select(*[col(c) for c in QUOTE_COLUMNS], (col("l_orderkey") * 10 + col("l_linenumber")).alias("id"),
                 F.concat(F.year(odate).cast("string"), F.lit("_"), F.quarter(odate).cast("string"), F.lit("Q")).alias("period"))
    if dealt:
        j = dealt(j)
    kc, ks = col("c_nationkey"), col("s_nationkey")
    q, ln = col("l_quantity"), col("l_linenumber")
    disc, tax = col("l_discount"), col("l_tax")
    sdate = col("l_shipdate")
    dbl = lambda v: F.lit(v).cast("double")
    margin1 = tax * 100 - F.when(q == 1, dbl(9.0)).otherwise(dbl(0.0))
    lcu = F.when(kc % 4 == 0, F.lit("CFA")).otherwise(code("C", kc))
    shared = {
        "id": col("id"),
        "period": col("period"),
        "date": F.when(ln == 7, F.lit("not-a-date"))
                 .when(ln % 2 == 0, F.date_format(odate, "dd/MMM/yyyy"))
                 .otherwise(F.date_format(sdate, "yyyy-MM-dd HH:mm:ss")),
        "corridor": F.concat(code("N", kc), code("N", ks)),
        "firm": col("s_name"),
        "firm_type": F.when(col("l_suppkey") % 3 == 0, F.lit("Bank"))
                      .when(col("l_suppkey") % 3 == 1, F.lit("MTO")).otherwise(F.lit("Mobile")),
        "payment instrument": col("o_orderpriority"),
        "pickup method": col("l_returnflag"),
        "access point": F.when(ln == 3, F.concat(col("c_mktsegment"), F.lit(" ")))
                         .otherwise(col("c_mktsegment")),
        "speed actual": col("o_orderstatus"),
        "receiving network coverage": F.when(col("c_custkey") % 2 == 0, F.lit("Nationwide"))
                                       .otherwise(F.lit("Urban")),
        "transparent": F.when(q % 10 == 0, F.lit(" NO ")).when(q % 7 == 0, F.lit(None).cast("string"))
                        .when(col("l_linestatus") == "F", F.lit("yes")).otherwise(F.lit("Yes")),
        "Standard Note": F.when(ln == 1, F.lit("Standard")).otherwise(F.lit(None).cast("string")),
    }
    shared.update(_geo("source", kc))
    shared.update(_geo("destination", ks))
    shared["inter lcu bank fx"] = dbl(1.0) + tax
    tiers = {
        "cc1 denomination amount": dbl(200.0),
        "cc1 lcu amount": F.when(q % 13 == 0, dbl(0.0)).otherwise(dbl(200.0)),
        "cc1 lcu code": lcu,
        "cc1 lcu fee": disc * 200,
        "cc1 lcu fx rate": (dbl(1.0) + disc) * 10,
        "cc1 fx margin": margin1,
        "cc1 total cost %": disc * 100 + margin1 + F.when(q % 17 == 0, dbl(0.5)).otherwise(dbl(0.0)),
        "cc2 denomination amount": F.when(q % 3 == 0, dbl(None)).otherwise(dbl(500.0)),
        "cc2 lcu amount": dbl(500.0),
        "cc2 lcu code": lcu,
        "cc2 lcu fee": disc * 400,
        "cc2 lcu fx rate": (dbl(1.0) + disc) * 10,
        "cc2 fx margin": tax * 100,
        "cc2 total cost %": F.when(q % 19 == 0, dbl(None)).otherwise(disc * 80 + tax * 100),
    }
    exprs = {**shared, **tiers}
    return j.select(*[e.alias(n) for n, e in exprs.items()])


def country_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``country_iso3, country_name, region, income_group`` from nation x region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = col("n_nationkey")
    income = (F.when(k % 4 == 0, F.lit("Low income")).when(k % 4 == 1, F.lit("Lower-middle income"))
               .when(k % 4 == 2, F.lit("Upper-middle income")).otherwise(F.lit("High income")))
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .filter(~k.isin(list(COUNTRY_GAPS)))
             .select(code("N", k).alias("country_iso3"),
                     F.concat(col("n_name"), F.lit(", "), col("r_name")).alias("country_name"),
                     col("r_name").alias("region"), income.alias("income_group")))


def currency_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``currency_code, currency_name``: one code per nation plus the resolved zones."""
    n = table(spark, sf_dir, "nation")
    k = col("n_nationkey")
    per_nation = (n.filter(~k.isin(list(CURRENCY_GAPS)))
                   .select(code("C", k).alias("currency_code"),
                           F.concat(col("n_name"), F.lit(" lcu")).alias("currency_name")))
    schema = T.StructType([T.StructField("currency_code", T.StringType()),
                           T.StructField("currency_name", T.StringType())])
    zones = spark.createDataFrame(list(RESOLVED_CURRENCIES), schema)
    return per_nation.unionByName(zones)

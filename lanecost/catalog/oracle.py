"""DuckDB SQL for the cross-check of every registered query.

The SQL is written independently of the Spark operators (window functions,
UNION ALL, plain joins) over the same parquet tables. Column lists that both
sides must agree on (the wide layout, the tie-break order of the dedup) are
generated from the same constants.
"""

from __future__ import annotations

from lanecost.operators.clean import DATE_FORMATS, GEOGRAPHY_COLUMNS, TIER_PREFIXES
from lanecost.operators.dedup import GRAIN_COLUMNS
from lanecost.operators.marts import CHANNEL_COLUMNS, TREND_KEYS
from lanecost.operators.model import LANDING_SCHEMA, STAGE_MAPPING
from lanecost.sources import fixtures as FX

WIDE_SHARED = [
    "id", "period", "date", "corridor", "firm", "firm_type", "payment instrument",
    "pickup method", "access point", "speed actual", "receiving network coverage",
    "transparent", "Standard Note",
    "source_code", "source_name", "source_region", "source_income", "source_lending", "source_G8G20",
    "destination_code", "destination_name", "destination_region", "destination_income",
    "destination_lending", "destination_G8G20", "inter lcu bank fx",
]
TIER_FIELDS = list(FX.WIDE_TIER_FIELDS)
WIDE_COLUMNS = WIDE_SHARED + [p + f for p in TIER_PREFIXES for f in TIER_FIELDS]
LONG_SHARED = WIDE_SHARED + ["date_raw", "period_year", "period_quarter"]
LONG_COLUMNS = LONG_SHARED + ["send_amount" if f == "denomination amount" else f
                              for f in TIER_FIELDS] + ["cc_number"]
DEDUP_ORDER = ["id"] + [c for c in LONG_COLUMNS if c != "id" and c not in GRAIN_COLUMNS]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def qs(names) -> str:
    return ", ".join(q(n) for n in names)


def lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def _code(prefix: str, key: str) -> str:
    return f"({lit(prefix)} || lpad(CAST({key} AS VARCHAR), 2, '0'))"


def _geo(side: str, k: str) -> str:
    return f""",
  {_code('N', k)} AS {side}_code,
  'NATION_' || CAST({k} AS VARCHAR) AS {side}_name,
  CASE WHEN {k} % 5 = 0 THEN '..' ELSE 'R' || CAST({k} % 5 AS VARCHAR) END AS {side}_region,
  CASE WHEN {k} % 6 = 0 THEN '..' ELSE 'I' || CAST({k} % 4 AS VARCHAR) END AS {side}_income,
  CASE WHEN {k} % 3 = 0 THEN '..' ELSE 'L' || CAST({k} % 3 AS VARCHAR) END AS {side}_lending,
  CASE WHEN {k} % 7 = 0 THEN '..' WHEN {k} < 12 THEN 'G20' ELSE 'Other' END AS {q(side + '_G8G20')}"""


_M1 = "(l.l_tax * 100 - CASE WHEN l.l_quantity = 1 THEN 9.0::DOUBLE ELSE 0.0::DOUBLE END)"
_LCU = f"CASE WHEN c.c_nationkey % 4 = 0 THEN 'CFA' ELSE {_code('C', 'c.c_nationkey')} END"

WIDE_SQL = f"""
SELECT
  l.l_orderkey * 10 + l.l_linenumber AS id,
  CAST(year(o.o_orderdate) AS VARCHAR) || '_' || CAST(quarter(o.o_orderdate) AS VARCHAR) || 'Q' AS period,
  CASE WHEN l.l_linenumber = 7 THEN 'not-a-date'
       WHEN l.l_linenumber % 2 = 0 THEN strftime(o.o_orderdate, '%d/%b/%Y')
       ELSE strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') END AS date,
  {_code('N', 'c.c_nationkey')} || {_code('N', 's.s_nationkey')} AS corridor,
  s.s_name AS firm,
  CASE WHEN l.l_suppkey % 3 = 0 THEN 'Bank' WHEN l.l_suppkey % 3 = 1 THEN 'MTO' ELSE 'Mobile' END AS firm_type,
  o.o_orderpriority AS "payment instrument",
  l.l_returnflag AS "pickup method",
  CASE WHEN l.l_linenumber = 3 THEN c.c_mktsegment || ' ' ELSE c.c_mktsegment END AS "access point",
  o.o_orderstatus AS "speed actual",
  CASE WHEN c.c_custkey % 2 = 0 THEN 'Nationwide' ELSE 'Urban' END AS "receiving network coverage",
  CASE WHEN l.l_quantity % 10 = 0 THEN ' NO ' WHEN l.l_quantity % 7 = 0 THEN NULL
       WHEN l.l_linestatus = 'F' THEN 'yes' ELSE 'Yes' END AS transparent,
  CASE WHEN l.l_linenumber = 1 THEN 'Standard' ELSE NULL END AS "Standard Note"
  {_geo('source', 'c.c_nationkey')}{_geo('destination', 's.s_nationkey')},
  1.0::DOUBLE + l.l_tax AS "inter lcu bank fx",
  200.0::DOUBLE AS "cc1 denomination amount",
  CASE WHEN l.l_quantity % 13 = 0 THEN 0.0::DOUBLE ELSE 200.0::DOUBLE END AS "cc1 lcu amount",
  {_LCU} AS "cc1 lcu code",
  l.l_discount * 200 AS "cc1 lcu fee",
  (1.0::DOUBLE + l.l_discount) * 10 AS "cc1 lcu fx rate",
  {_M1} AS "cc1 fx margin",
  l.l_discount * 100 + {_M1} + CASE WHEN l.l_quantity % 17 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END
    AS "cc1 total cost %",
  CASE WHEN l.l_quantity % 3 = 0 THEN NULL ELSE 500.0::DOUBLE END AS "cc2 denomination amount",
  500.0::DOUBLE AS "cc2 lcu amount",
  {_LCU} AS "cc2 lcu code",
  l.l_discount * 400 AS "cc2 lcu fee",
  (1.0::DOUBLE + l.l_discount) * 10 AS "cc2 lcu fx rate",
  l.l_tax * 100 AS "cc2 fx margin",
  CASE WHEN l.l_quantity % 19 = 0 THEN NULL ELSE l.l_discount * 80 + l.l_tax * 100 END AS "cc2 total cost %"
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

_income = ("CASE WHEN n_nationkey % 4 = 0 THEN 'Low income' WHEN n_nationkey % 4 = 1 THEN "
           "'Lower-middle income' WHEN n_nationkey % 4 = 2 THEN 'Upper-middle income' "
           "ELSE 'High income' END")
COUNTRY_SQL = f"""
SELECT {_code('N', 'n_nationkey')} AS country_iso3, n_name || ', ' || r_name AS country_name,
       r_name AS region, {_income} AS income_group
FROM nation JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey NOT IN ({', '.join(str(k) for k in FX.COUNTRY_GAPS)})
"""
CURRENCY_SQL = (f"""
SELECT {_code('C', 'n_nationkey')} AS currency_code, n_name || ' lcu' AS currency_name
FROM nation WHERE n_nationkey NOT IN ({', '.join(str(k) for k in FX.CURRENCY_GAPS)})
""" + "".join(f" UNION ALL SELECT {lit(c)}, {lit(n)}" for c, n in FX.RESOLVED_CURRENCIES))


def _sentinel_sql() -> str:
    reps = ", ".join(f"nullif({q(c)}, '..') AS {q(c)}" for c in GEOGRAPHY_COLUMNS)
    return f"SELECT * REPLACE ({reps}) FROM wide"


_fmt = {"dd/MMM/yyyy": "%d/%b/%Y", "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S"}
DATED_SQL = ("SELECT * REPLACE (CAST(coalesce("
             + ", ".join(f"try_strptime(date, {lit(_fmt[f])})" for f in DATE_FORMATS)
             + ") AS DATE) AS date), date AS date_raw FROM sent")
PERIODS_SQL = r"""SELECT *,
  try_cast(split_part(period, '_', 1) AS INTEGER) AS period_year,
  try_cast(regexp_extract(period, '_(\d)Q', 1) AS INTEGER) AS period_quarter
FROM dated"""


def _unpivot_sql() -> str:
    sides = []
    for p in TIER_PREFIXES:
        n = int(p.strip()[-1])
        tiers = ", ".join(f"{q(p + f)} AS {q('send_amount' if f == 'denomination amount' else f)}"
                          for f in TIER_FIELDS)
        sides.append(f"SELECT {qs(LONG_SHARED)}, {tiers}, {n} AS cc_number FROM periods "
                     f"WHERE {q(p + 'denomination amount')} IS NOT NULL")
    return "\nUNION ALL\n".join(sides)


def _ranked_sql() -> str:
    part = qs(GRAIN_COLUMNS)
    order = ", ".join(f"{q(c)} ASC NULLS FIRST" for c in DEDUP_ORDER)
    return (f"SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS __rn, "
            f"count(*) OVER (PARTITION BY {part}) AS duplicate_count FROM unp")


_sqltype = {"StringType()": "VARCHAR", "IntegerType()": "INTEGER", "LongType()": "BIGINT",
            "DoubleType()": "DOUBLE", "DateType()": "DATE"}


def _landing_sql() -> str:
    cols = ", ".join(f"CAST({q(f.name)} AS {_sqltype[str(f.dataType)]}) AS {q(f.name)}"
                     for f in LANDING_SCHEMA.fields)
    return f"SELECT {cols} FROM clean"


def _stage_sql() -> str:
    def expr(s, kind):
        return {"text": f"trim({q(s)})", "long": f"CAST({q(s)} AS BIGINT)",
                "int": f"CAST({q(s)} AS INTEGER)", "date": f"CAST({q(s)} AS DATE)",
                "amount": f"CAST(CAST({q(s)} AS DECIMAL(18,6)) AS DOUBLE)"}[kind]
    return "SELECT " + ", ".join(f"{expr(s, k)} AS {q(t)}" for t, s, k in STAGE_MAPPING) + " FROM landing"


def _remap(e: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in FX.CODE_REMAP.items())
    return f"CASE {e} {whens} ELSE {e} END"


def _codes_sql() -> str:
    zones = " ".join(f"WHEN lcu_code = 'CFA' AND left(corridor, 3) IN {in_list(v)} THEN {lit(k)}"
                     for k, v in FX.CFA_ZONES.items())
    return (f"SELECT *, {_remap('left(corridor, 3)')} AS sending_country_code, "
            f"{_remap('right(corridor, 3)')} AS receiving_country_code, "
            f"CASE {zones} ELSE lcu_code END AS lcu_code_resolved FROM staged")


ENRICHED_SQL = """SELECT base.* EXCLUDE (lcu_code), base.lcu_code AS lcu_code_raw,
  src.region AS source_region, src.income_group AS source_income_group_current,
  dst.region AS destination_region_current, dst.income_group AS destination_income_group_current,
  cur.currency_name AS sending_currency_name
FROM codes base
LEFT JOIN country src ON base.sending_country_code = src.country_iso3
LEFT JOIN country dst ON base.receiving_country_code = dst.country_iso3
LEFT JOIN currency cur ON base.lcu_code_resolved = cur.currency_code"""
COMPONENTS_SQL = ("SELECT * EXCLUDE (fx_margin), fx_margin AS fx_margin_pct, "
                  "lcu_fee / nullif(lcu_amount, 0) * 100 AS fee_cost_pct FROM enriched")
DECOMPOSED_SQL = "SELECT *, fee_cost_pct + fx_margin_pct AS decomposed_cost_pct FROM components"
FLAGS_SQL = """SELECT *,
  CASE WHEN lower(trim(transparent)) = 'yes' THEN true
       WHEN lower(trim(transparent)) = 'no' THEN false ELSE NULL END AS is_disclosed_transparent,
  total_cost_pct IS NULL AS total_cost_pct_missing,
  (fee_cost_pct IS NULL OR fx_margin_pct IS NULL) AS cost_components_missing,
  CASE WHEN decomposed_cost_pct IS NULL OR total_cost_pct IS NULL THEN NULL
       ELSE abs(decomposed_cost_pct - total_cost_pct) > 0.01 END AS cost_mismatch_flag
FROM decomposed"""
FLAGGED_SQL = """SELECT *,
  (CASE WHEN total_cost_pct_missing THEN 1 ELSE 0 END)
  + (CASE WHEN cost_components_missing THEN 1 ELSE 0 END)
  + (CASE WHEN cost_mismatch_flag THEN 1 ELSE 0 END) AS transparency_flag_count
FROM flags"""


def _trends_sql() -> str:
    keys = qs(TREND_KEYS)
    return f"""SELECT {keys},
  count(*) AS num_observations, count(DISTINCT firm) AS num_providers,
  avg(total_cost_pct) AS avg_total_cost_pct,
  median(total_cost_pct) AS median_total_cost_pct,
  min(total_cost_pct) AS min_total_cost_pct, max(total_cost_pct) AS max_total_cost_pct,
  avg(fee_cost_pct) AS avg_fee_cost_pct, avg(fx_margin_pct) AS avg_fx_margin_pct,
  avg(decomposed_cost_pct) AS avg_decomposed_cost_pct,
  CAST(sum(CASE WHEN cost_mismatch_flag THEN 1 ELSE 0 END) AS BIGINT) AS num_cost_mismatch_flagged
FROM flagged GROUP BY {keys}"""


SCORECARD_SQL = """SELECT firm, firm_type,
  count(*) AS num_observations,
  count(DISTINCT corridor) AS num_corridors,
  count(DISTINCT CASE WHEN period_year IS NOT NULL AND period_quarter IS NOT NULL
                      THEN CAST(period_year AS VARCHAR) || '_' || CAST(period_quarter AS VARCHAR) END) AS num_periods,
  avg(CASE WHEN is_disclosed_transparent THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_disclosed_transparent,
  avg(CASE WHEN total_cost_pct_missing THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_total_cost_pct_missing,
  avg(CASE WHEN cost_components_missing THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END) AS pct_cost_components_missing,
  CAST(sum(CASE WHEN cost_mismatch_flag THEN 1 ELSE 0 END) AS BIGINT) AS num_cost_mismatch_flagged,
  CAST(sum(CASE WHEN cost_mismatch_flag IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS num_cost_mismatch_evaluable,
  CAST(sum(CASE WHEN cost_mismatch_flag THEN 1 ELSE 0 END) AS DOUBLE)
        / nullif(sum(CASE WHEN cost_mismatch_flag IS NOT NULL THEN 1 ELSE 0 END), 0) * 100
        AS pct_cost_mismatch_flagged,
  avg(transparency_flag_count) AS avg_transparency_flag_count,
  count(*) >= 30 AS has_sufficient_sample
FROM flagged GROUP BY firm, firm_type"""


def _spotlight_sql() -> str:
    c = lit(FX.SPOTLIGHT_COUNTRY)
    cols = list(CHANNEL_COLUMNS)
    at = cols.index("receiving_country_code") + 1
    role = (f"CASE WHEN sending_country_code = {c} THEN 'sending' "
            f"WHEN receiving_country_code = {c} THEN 'receiving' END AS spotlight_role")
    return (f"SELECT {qs(cols[:at])}, {role}, {qs(cols[at:])} FROM flagged "
            f"WHERE sending_country_code = {c} OR receiving_country_code = {c}")


ARROW = " \u2192 "


def _labelled(source: str) -> str:
    """Rows of ``source`` plus corridor label, period label and sort key."""
    return f"""SELECT t.*,
  coalesce(s.country_name, t.sending_country_code) || '{ARROW}'
    || coalesce(r.country_name, t.receiving_country_code) AS corridor_label,
  CAST(t.period_year AS VARCHAR) || ' Q' || CAST(t.period_quarter AS VARCHAR) AS period_label,
  t.period_year * 10 + t.period_quarter AS period_sort_key
FROM {source} t
LEFT JOIN country s ON t.sending_country_code = s.country_iso3
LEFT JOIN country r ON t.receiving_country_code = r.country_iso3"""


WEIGHTED_SQL = """SELECT corridor, corridor_label, period_label, period_sort_key,
  CASE WHEN sum(num_observations) = 0 THEN avg(avg_total_cost_pct)
       ELSE coalesce(sum(avg_total_cost_pct * num_observations), 0) / sum(num_observations)
  END AS avg_total_cost_pct,
  CAST(sum(num_observations) AS BIGINT) AS num_observations
FROM trend_lab
WHERE corridor IS NOT NULL AND corridor_label IS NOT NULL AND period_label IS NOT NULL
  AND period_sort_key IS NOT NULL
GROUP BY corridor, corridor_label, period_label, period_sort_key"""

FIRMS_SQL = """SELECT firm, firm_type, count(total_cost_pct) AS num_observations,
  avg(total_cost_pct) AS avg_total_cost_pct,
  avg(CAST(is_disclosed_transparent AS DOUBLE)) * 100 AS pct_disclosed_transparent
FROM spot WHERE firm IS NOT NULL AND firm_type IS NOT NULL
GROUP BY firm, firm_type"""


# Name -> body of every CTE, in dependency order.
CTES: list[tuple[str, str]] = [
    ("wide", WIDE_SQL),
    ("country", COUNTRY_SQL),
    ("currency", CURRENCY_SQL),
    ("sent", _sentinel_sql()),
    ("dated", DATED_SQL),
    ("periods", PERIODS_SQL),
    ("unp", _unpivot_sql()),
    ("ranked", _ranked_sql()),
    ("clean", "SELECT * EXCLUDE (__rn, duplicate_count) FROM ranked WHERE __rn = 1"),
    ("grain_report", "SELECT * EXCLUDE (__rn) FROM ranked WHERE __rn > 1"),
    ("landing", _landing_sql()),
    ("staged", _stage_sql()),
    ("codes", _codes_sql()),
    ("enriched", ENRICHED_SQL),
    ("components", COMPONENTS_SQL),
    ("decomposed", DECOMPOSED_SQL),
    ("flags", FLAGS_SQL),
    ("flagged", FLAGGED_SQL),
    ("trends", _trends_sql()),
    ("providers", f"SELECT {qs(CHANNEL_COLUMNS)} FROM flagged"),
    ("scorecard", SCORECARD_SQL),
    ("spot", _spotlight_sql()),
    ("trend_lab", _labelled("trends")),
    ("wt", WEIGHTED_SQL),
    ("spot_lab", _labelled("spot")),
    ("firms", FIRMS_SQL),
]


def with_ctes(select_or_extra: str, select: str | None = None) -> str:
    """Prefix a query with the CTE chain (DuckDB evaluates only what is used).

    ``with_ctes(select)`` or ``with_ctes(extra_ctes, select)`` where ``extra_ctes``
    is ``"name AS (...), ..."`` appended to the chain."""
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in CTES)
    if select is None:
        return f"WITH {body}\n{select_or_extra}"
    return f"WITH {body},\n{select_or_extra}\n{select}"

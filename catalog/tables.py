"""Contracts for the shared tables, and a survey table derived from `orders`.

The derivation is plain SQL that Spark and the oracle engine read alike, so both
sides start from the same rows. It has one survey row per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilespark.contract import SURVEY, Contract


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINEITEM = Contract(
    name="lineitem",
    numeric=("l_quantity", "l_discount", "l_tax"),
    categorical=("l_linestatus",),
    target="l_returnflag",
    labels=("A", "N", "R"),
    bounds={"l_quantity": (1, 45), "l_discount": (0, 0.1), "l_tax": (0, 0.08)},
)
LINEITEM_WIDE = LINEITEM.with_(
    name="lineitem_wide", numeric=("l_quantity", "l_discount", "l_tax", "l_extendedprice"), row_id="row_key"
)
CUSTOMER = Contract(
    name="customer",
    numeric=("c_acctbal",),
    categorical=("c_mktsegment",),
    bounds={"c_acctbal": (0, 10000)},
    aliases={"c_mktsegment": {"AUTOMOBILE": "MACHINERY"}},
    row_id="c_custkey",
)
ORDERS = Contract(
    name="orders",
    numeric=("o_totalprice",),
    categorical=("o_orderstatus",),
    target="o_orderpriority",
    labels=("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"),
    aliases={"o_orderstatus": {"P": "O"}},
    row_id="o_orderkey",
)
SURVEY_ROWS = SURVEY.with_(row_id="row_id")

#: one whole number per lineitem row; numbers, not texts, so that min() stays in a hash aggregation
_KEY = (
    "((((cast(l_orderkey as {t}) * 8 + l_linenumber) * 1000000007 + l_partkey) * 1000003 + l_suppkey) * 20000003 "
    "+ cast(round(l_extendedprice * 100) as bigint))"
)
LINEITEM_KEY_SPARK = _KEY.format(t="decimal(38,0)")
LINEITEM_KEY = _KEY.format(t="hugeint")


def lineitem_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("row_key", F.expr(LINEITEM_KEY_SPARK))


BAND = "((o_orderkey * 7 + o_custkey) % 4)"
#: survey column -> SQL over `orders`; holds invalid numbers, junk texts, blanks and aliases on purpose
SURVEY_SQL = {
    "row_id": "o_orderkey",
    "Age": "cast(11 + o_custkey % 72 as double)",
    "Avg_Daily_Usage_Hours": f"1 + cast({BAND} as double) * 1.5 + cast(o_custkey % 20 as double) / 10",
    "Daily_Unlocks": f"cast(60 + {BAND} * 25 + o_orderkey % 90 as double)",
    "Study_Hours": (
        "case when o_orderkey % 50 = 0 then 'unknown' when o_orderkey % 51 = 0 then '1d' "
        "when o_orderkey % 52 = 0 then null "
        "else concat(' ', cast(o_orderkey % 26 as string), '.5\t') end"
    ),
    "Physical_Activity_Hours": (
        f"case when o_custkey % 11 = 0 then -0.4 else 3 - cast({BAND} as double) * 0.5 "
        "+ cast(o_orderkey % 4 as double) / 4 end"
    ),
    "Sleep_Hours_Per_Night": f"8 - cast({BAND} as double) * 0.75 + cast(o_orderkey % 13 as double) / 8",
    "Academic_Level": (
        "case when o_orderstatus = 'F' then 'Undergraduate' when o_orderstatus = 'O' then 'Postgraduate' "
        "else ' Graduate ' end"
    ),
    "Most_Used_Platform": (
        "case when o_custkey % 41 = 0 then '  ' else concat('Platform ', cast(o_custkey % 12 as string)) end"
    ),
    "Purpose_Of_Use": (
        "case when o_orderkey % 5 = 0 then 'Academic' when o_orderkey % 5 = 1 then 'Social' "
        "when o_orderkey % 5 = 2 then 'Browsing' when o_orderkey % 5 = 3 then 'Education' else 'Entertainment' end"
    ),
    "Stress_Level": (
        f"case when o_orderkey % 77 = 0 then '' when ({BAND} + case when o_custkey % 9 = 0 then 1 else 0 end) % 4 = 0 "
        f"then 'Low' when ({BAND} + case when o_custkey % 9 = 0 then 1 else 0 end) % 4 = 1 then 'Medium' "
        f"when ({BAND} + case when o_custkey % 9 = 0 then 1 else 0 end) % 4 = 2 then 'High' else 'Very High' end"
    ),
    "Mental_Health_Score": "cast(o_custkey % 10 as double)",
}


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{sql} as {name}" for name, sql in SURVEY_SQL.items()])


# --------------------------------------------------------------------- oracle text

SURVEY_RAW_CTE = "survey as (select " + ", ".join(f"{s} as {n}" for n, s in SURVEY_SQL.items()) + " from orders)"


def sql_strip(column: str) -> str:
    return f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"


def sql_alias(expression: str, aliases) -> str:
    if not aliases:
        return expression
    whens = " ".join(f"when '{a}' then '{b}'" for a, b in aliases.items())
    return f"(case {expression} {whens} else {expression} end)"


def sql_clean(contract: Contract, column: str) -> str:
    if column in contract.categorical:
        return f"nullif({sql_alias(sql_strip(column), contract.aliases.get(column))}, '')"
    value = column
    if contract.name == "survey" and column == "Study_Hours":
        text = sql_strip(column)
        value = f"(case when regexp_full_match({text}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') then cast({text} as double) end)"
    if column in contract.bounds:
        low, high = contract.bounds[column]
        return f"case when {value} between {low} and {high} then {value} end"
    return value


def sql_clean_cte(contract: Contract, source: str, name: str = "clean", keep: str = "") -> str:
    columns = ", ".join(f"{sql_clean(contract, c)} as {c}" for c in contract.features)
    return f"{name} as (select {keep + ', ' if keep else ''}{columns} from {source})"


def sql_prepared_ctes(contract: Contract, source: str, row_id: str | None = None) -> str:
    """clean, prepared: one row per unambiguous profile, smallest row id."""
    features = ", ".join(contract.features)
    keep = (f"{row_id} as {contract.row_id}, " if row_id else "") + f"nullif({sql_strip(contract.target)}, '') as {contract.target}"
    smallest = f"min({contract.row_id}) as {contract.row_id}, " if row_id else ""
    return (
        sql_clean_cte(contract, source, "clean", keep)
        + f", prepared as (select {smallest}{features}, min({contract.target}) as {contract.target} from clean "
        f"where {contract.target} is not null group by {features} "
        f"having min({contract.target}) = max({contract.target}))"
    )


def sql_label_positions(contract: Contract) -> str:
    rows = ", ".join(f"({i}, '{name}')" for i, name in enumerate(contract.labels))
    return f"labels_in_order as (select * from (values {rows}) v(position, label))"


def sql_split_ctes(contract: Contract, source: str = "prepared") -> str:
    """label sizes, quotas by largest remainder, and `parts`: source plus `split`."""
    t, row_id = contract.target, contract.row_id
    return (
        sql_label_positions(contract)
        + f", sizes as (select position, label, (select count(*) from {source} s where s.{t} = labels_in_order.label) as c from labels_in_order)"
        ", want_test as (select cast(ceil(sum(c) * 0.2) as bigint) as w, sum(c) as n from sizes)"
        ", test_share as (select position, label, c, w * c / n as exact, w from sizes, want_test)"
        ", test_quota as (select position, label, c, cast(floor(exact) as bigint) + case when row_number() over "
        "(order by exact - floor(exact) desc, position) <= w - sum(cast(floor(exact) as bigint)) over () then 1 else 0 end as t from test_share)"
        ", want_val as (select cast(ceil(sum(c - t) * 0.25) as bigint) as w, sum(c - t) as n from test_quota)"
        ", val_share as (select position, label, t, c - t as c, w * (c - t) / n as exact, w from test_quota, want_val)"
        ", quota as (select label, t, cast(floor(exact) as bigint) + case when row_number() over "
        "(order by exact - floor(exact) desc, position) <= w - sum(cast(floor(exact) as bigint)) over () then 1 else 0 end as v from val_share)"
        f", ranked as (select *, row_number() over (partition by {t} order by md5(concat_ws('|', '{contract.seed}', cast({row_id} as varchar)))) as rk from {source})"
        f", parts as (select r.*, case when rk <= t then 'test' when rk <= t + v then 'val' else 'train' end as split "
        f"from ranked r join quota q on r.{t} = q.label)"
    )


SURVEY_PREPARED = f"with {SURVEY_RAW_CTE}, {sql_prepared_ctes(SURVEY_ROWS, 'survey', 'row_id')}"
SURVEY_PARTS = f"{SURVEY_PREPARED}, {sql_split_ctes(SURVEY_ROWS)}"

"""Profiling of training rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.splitting import survey_parts
from catalog.tables import ORDERS, SURVEY_PARTS, SURVEY_ROWS, table
from profilespark.operators import quality, stats

LI = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def rounded(df, digits: int = 6):
    """Doubles rounded on both sides, so that the order of summation does not matter."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _union(columns, template: str) -> str:
    return " union all ".join(template.format(c=c) for c in columns)


@query(
    "describe",
    _union(LI, "select '{c}' as \"column\", count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, "
               "min({c}) as low, round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50, "
               "round(quantile_cont({c}, 0.75), 6) as q75, max({c}) as high from lineitem"),
)
def describe(spark, sf_dir):
    return rounded(stats.describe(table(spark, sf_dir, "lineitem"), LI))


_TRAIN = f"{SURVEY_PARTS}, train as (select * from parts where split = 'train')"
_NUM = SURVEY_ROWS.numeric


@query("label_distribution", f"{_TRAIN} select position, label, (select count(*) from train where Stress_Level = label) as n from labels_in_order")
def label_distribution(spark, sf_dir):
    train = survey_parts(spark, sf_dir).filter("split = 'train'")
    return quality.class_counts(train, SURVEY_ROWS)


@query("medians", f"{_TRAIN} " + _union(_NUM, "select '{c}' as \"column\", round(quantile_cont({c}, 0.5), 6) as median from train"))
def medians(spark, sf_dir):
    return rounded(stats.medians(survey_parts(spark, sf_dir).filter("split = 'train'"), _NUM))


@query("ranges", f"{_TRAIN} " + _union(_NUM, "select '{c}' as \"column\", min({c}) as low, max({c}) as high from train"))
def ranges(spark, sf_dir):
    return stats.ranges(survey_parts(spark, sf_dir).filter("split = 'train'"), _NUM)


# Fixed values, stated here apart from the code's own: column, threshold, quantile.
_THRESHOLDS = (
    ("Sleep_Hours_Per_Night", "very_low", 0.10), ("Sleep_Hours_Per_Night", "low", 0.25), ("Sleep_Hours_Per_Night", "reference", 0.50),
    ("Sleep_Hours_Per_Night", "high", 0.90),
    ("Avg_Daily_Usage_Hours", "reference", 0.50), ("Avg_Daily_Usage_Hours", "high", 0.75), ("Avg_Daily_Usage_Hours", "very_high", 0.90),
    ("Daily_Unlocks", "reference", 0.50), ("Daily_Unlocks", "high", 0.75), ("Daily_Unlocks", "very_high", 0.90),
    ("Physical_Activity_Hours", "very_low", 0.10), ("Physical_Activity_Hours", "low", 0.25), ("Physical_Activity_Hours", "reference", 0.50),
    ("Study_Hours", "reference", 0.50), ("Study_Hours", "high", 0.75), ("Study_Hours", "very_high", 0.90),
)


@query(
    "thresholds",
    f"{_TRAIN} " + " union all ".join(
        f"select '{c}' as \"column\", '{name}' as threshold, round(quantile_cont({c}, {p}), 2) as value from train" for c, name, p in _THRESHOLDS
    ),
)
def thresholds(spark, sf_dir):
    return stats.thresholds(survey_parts(spark, sf_dir).filter("split = 'train'"))


@query(
    "vocabulary",
    f"{_TRAIN} " + _union(
        SURVEY_ROWS.categorical,
        "select '{c}' as \"column\", row_number() over (order by {c}) - 1 as position, {c} as value "
        "from (select distinct {c} from train where {c} is not null)",
    ),
)
def vocabulary(spark, sf_dir):
    return stats.vocabulary(survey_parts(spark, sf_dir).filter("split = 'train'"), SURVEY_ROWS.categorical)


@query(
    "modes",
    _union(("p_brand", "p_type", "p_name"),
           "select '{c}' as \"column\", (select {c} from part group by {c} order by count(*) desc, {c} limit 1) as mode"),
)
def modes(spark, sf_dir):
    return stats.modes(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"])


@query(
    "histogram",
    "with edges as (" + _union(LI, "select '{c}' as \"column\", min({c}) as lo, max({c}) as hi, (max({c}) - min({c})) / 20 as step from lineitem")
    + "), bins as (select *, lo + i * step as a, case when i = 19 then hi else lo + (i + 1) * step end as z from edges cross join range(20) r(i)), "
    "cells as (" + _union(LI, "select '{c}' as \"column\", i, count(*) as n from lineitem join bins on \"column\" = '{c}' "
                              "and {c} >= a and ({c} < z or i = 19) group by 1, 2")
    + ") select b.\"column\", cast(b.i + 1 as integer) as bin, round(a, 6) as lower, round(z, 6) as upper, coalesce(n, 0) as n "
    "from bins b left join cells c on c.\"column\" = b.\"column\" and c.i = b.i",
)
def histogram(spark, sf_dir):
    return rounded(stats.histogram(table(spark, sf_dir, "lineitem"), LI))


@query(
    "correlation",
    " union all ".join(
        f"select '{a}' as \"left\", '{b}' as \"right\", round(corr({a}, {b}), 6) as r from lineitem" for a in LI for b in LI
    ),
)
def correlation(spark, sf_dir):
    return rounded(stats.correlation(table(spark, sf_dir, "lineitem"), LI))


def _box_sql(columns, label: str, source: str) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"select q.label, '{c}' as \"column\", count(x.{c}) as n, round(any_value(q25), 6) as q25, round(any_value(q50), 6) as q50, "
            f"round(any_value(q75), 6) as q75, "
            f"round(least(min(x.{c}) filter (x.{c} >= q25 - 1.5 * (q75 - q25)), any_value(q25)), 6) as whisker_low, "
            f"round(greatest(max(x.{c}) filter (x.{c} <= q75 + 1.5 * (q75 - q25)), any_value(q75)), 6) as whisker_high, "
            f"count(*) filter (x.{c} < q25 - 1.5 * (q75 - q25) or x.{c} > q75 + 1.5 * (q75 - q25)) as outliers "
            f"from {source} x join (select {label} as label, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50, "
            f"quantile_cont({c}, 0.75) as q75 from {source} group by 1) q on x.{label} = q.label group by 1"
        )
    return " union all ".join(parts)


@query("box_stats", _box_sql(("o_totalprice",), "o_orderpriority", "orders"))
def box_stats(spark, sf_dir):
    return rounded(stats.box_stats(table(spark, sf_dir, "orders"), ["o_totalprice"], ORDERS.target))


@query("box_stats_train", f"{_TRAIN} {_box_sql(_NUM, 'Stress_Level', 'train')}")
def box_stats_train(spark, sf_dir):
    train = survey_parts(spark, sf_dir).filter("split = 'train'")
    return rounded(stats.box_stats(train, _NUM, SURVEY_ROWS.target))


@query("preview", "select * from orders order by o_orderkey limit 5")
def preview(spark, sf_dir):
    return stats.preview(table(spark, sf_dir, "orders"), "o_orderkey", 5)

"""Scans, cleaning, validation, duplicates, audit and preparation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import query
from catalog.tables import (
    CUSTOMER,
    LINEITEM,
    LINEITEM_WIDE,
    ORDERS,
    SURVEY_PREPARED,
    SURVEY_RAW_CTE,
    SURVEY_ROWS,
    lineitem_keyed,
    sql_clean,
    sql_clean_cte,
    sql_prepared_ctes,
    sql_strip,
    survey,
    table,
)
from profilespark.contract import AGE_EDGES, AGE_GROUPS
from profilespark.functions.clean import in_bounds, right_closed_group, short_number, to_number
from profilespark.operators import quality, validate
from profilespark.session import ensure_checkpoint_dir
from profilespark.sources.readers import manifest_changes, read_table, source_manifest, table_fingerprint
from profilespark.sources.writers import result_json, write_json, write_table


@query(
    "clean_lenient",
    f"with {SURVEY_RAW_CTE}, {sql_clean_cte(SURVEY_ROWS, 'survey', keep='row_id')} select * from clean",
)
def clean_lenient(spark, sf_dir):
    return quality.clean_features(survey(spark, sf_dir), SURVEY_ROWS, keep=["row_id"])


@query(
    "clean_bounds",
    "select c_custkey, case when c_acctbal between 0 and 10000 then c_acctbal end as c_acctbal, "
    "case c_mktsegment when 'AUTOMOBILE' then 'MACHINERY' else c_mktsegment end as c_mktsegment from customer",
)
def clean_bounds(spark, sf_dir):
    return quality.clean_features(table(spark, sf_dir, "customer"), CUSTOMER, keep=["c_custkey"])


@query(
    "alias_map",
    "select case o_orderstatus when 'P' then 'O' else o_orderstatus end as o_orderstatus, count(*) as n "
    "from orders group by 1",
)
def alias_map(spark, sf_dir):
    cleaned = quality.clean_features(table(spark, sf_dir, "orders"), ORDERS, ["o_orderstatus"])
    return cleaned.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "coerce_json_number",
    "select event_id, try_cast(json_extract_string(props, '$.k') as double) as k, "
    "case when try_cast(json_extract_string(props, '$.k') as double) between 5 and 90 "
    "then try_cast(json_extract_string(props, '$.k') as double) end as k_bounded, "
    "case when event_id % 7 = 0 then null when event_id % 7 = 1 then null "
    "when event_id % 7 = 2 then cast(event_id as double) else event_id + 0.5 end as v from events",
)
def coerce_json_number(spark, sf_dir):
    text = F.get_json_object("props", "$.k")
    # texts that are no numbers, padded numbers and plain numbers
    made = (
        F.when(F.col("event_id") % 7 == 0, F.concat(F.col("event_id").cast("string"), F.lit("d")))
        .when(F.col("event_id") % 7 == 1, F.lit("none"))
        .when(F.col("event_id") % 7 == 2, F.concat(F.lit("\t"), F.col("event_id").cast("string"), F.lit(" ")))
        .otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".5")))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("k_text"), made.alias("v_text"))
    kind = rows.schema["k_text"].dataType
    number = to_number(F.col("k_text"), kind)
    return rows.select(
        "event_id", number.alias("k"), in_bounds(number, (5, 90)).alias("k_bounded"),
        to_number(F.col("v_text"), kind).alias("v"),
    )


@query(
    "strip_and_blank",
    f"select doc_id, length(nullif({sql_strip('text')}, '')) as n_chars, "
    f"nullif({sql_strip('source')}, '') as source from documents",
)
def strip_and_blank(spark, sf_dir):
    from profilespark.functions.clean import canonical_text

    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id", F.char_length(canonical_text(F.col("text"))).cast("long").alias("n_chars"),
        canonical_text(F.col("source")).alias("source"),
    )


@query(
    "short_number_text",
    "select l_orderkey, l_linenumber, l_quantity, l_extendedprice, "
    "cast(cast(l_quantity as bigint) as varchar) as quantity_text, "
    "case when l_extendedprice >= 100000 then cast(cast(round(l_extendedprice) as bigint) as varchar) "
    "else regexp_replace(regexp_replace(cast(cast(case when l_extendedprice >= 10000 then round(l_extendedprice, 1) else l_extendedprice end as decimal(18,2)) as varchar), '0+$', ''), '\\.$', '') end as price_text "
    "from lineitem",
)
def short_number_text(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        short_number(F.col("l_quantity")).alias("quantity_text"),
        short_number(F.col("l_extendedprice")).alias("price_text"),
    )


@query(
    "unknown_labels",
    "select o_orderpriority as label, count(*) as n from orders "
    "where o_orderpriority not in ('5-LOW', '3-MEDIUM', '1-URGENT') group by 1",
)
def unknown_labels(spark, sf_dir):
    narrow = ORDERS.with_(labels=("5-LOW", "3-MEDIUM", "1-URGENT"))
    return quality.unknown_labels(table(spark, sf_dir, "orders"), narrow)


@query(
    "exact_duplicates",
    "select cast(sum(c) as bigint) as raw_rows, count(*) as distinct_rows, "
    "cast(sum(c - 1) as bigint) as exact_duplicates_removed "
    "from (select count(*) as c from documents group by text, lang, source, n_chars)",
)
def exact_duplicates(spark, sf_dir):
    return quality.exact_duplicates(table(spark, sf_dir, "documents"), ["text", "lang", "source", "n_chars"])


@query("drop_exact_duplicates", "select distinct o_custkey, o_orderstatus, o_orderpriority from orders")
def drop_exact_duplicates(spark, sf_dir):
    return quality.drop_exact_duplicates(
        table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    )


_LINEITEM_CLEAN = "select " + ", ".join(f"{sql_clean(LINEITEM, c)} as {c}" for c in LINEITEM.features) + ", l_returnflag from lineitem"


@query(
    "conflicting_profiles",
    f"with clean as ({_LINEITEM_CLEAN}) select l_quantity, l_discount, l_tax, l_linestatus, count(*) as copies, "
    "min(l_returnflag) as first_label, max(l_returnflag) as last_label from clean "
    "group by 1, 2, 3, 4 having min(l_returnflag) <> max(l_returnflag)",
)
def conflicting_profiles(spark, sf_dir):
    return quality.conflicting_profiles(table(spark, sf_dir, "lineitem"), LINEITEM)


@query("prepare", f"with {sql_prepared_ctes(LINEITEM, 'lineitem')} select * from prepared")
def prepare(spark, sf_dir):
    return quality.prepare(table(spark, sf_dir, "lineitem"), LINEITEM)


@query("prepare_survey", f"{SURVEY_PREPARED} select * from prepared")
def prepare_survey(spark, sf_dir):
    return quality.prepare(survey(spark, sf_dir), SURVEY_ROWS)


@query(
    "prepare_model_key",
    "with clean as (select min(row_id) as row_id, {f}, min(Stress_Level) as Stress_Level from ({inner}) "
    "where Stress_Level is not null group by {k} having min(Stress_Level) = max(Stress_Level)) select * from clean".format(
        f=", ".join(["first(Age order by row_id) as Age", *SURVEY_ROWS.model_features]),
        k=", ".join(SURVEY_ROWS.model_features),
        inner="select row_id, " + ", ".join(f"{sql_clean(SURVEY_ROWS, c)} as {c}" for c in SURVEY_ROWS.features)
        + f", nullif({sql_strip('Stress_Level')}, '') as Stress_Level from (select * from survey)",
    ).replace("with clean", f"with {SURVEY_RAW_CTE}, clean"),
)
def prepare_model_key(spark, sf_dir):
    """Profiles that differ only in report-only columns count as one."""
    return quality.prepare(survey(spark, sf_dir), SURVEY_ROWS, key=SURVEY_ROWS.model_features)


def _audit_sql(contract, source: str, raw_columns: list[str], ctes: str = "") -> str:
    """Independent form of the audit: one scalar subquery per counter over shared steps."""
    t = contract.target
    label = f"nullif({sql_strip(t)}, '')"
    cleaned = ", ".join(f"{sql_clean(contract, c)} as _clean_{c}" for c in contract.features)
    keys = ", ".join(f"_clean_{c}" for c in contract.features)
    raw = ", ".join(raw_columns)
    rows = [
        ("raw_rows", None, f"(select count(*) from {source})"),
        ("raw_columns", None, str(len(raw_columns))),
        ("exact_duplicates_removed", None, f"(select count(*) from {source}) - (select count(*) from once)"),
        ("missing_target_rows_removed", None, "(select count(*) from cleaned where _label is null)"),
        ("conflicting_profile_rows_removed", None, "(select coalesce(sum(c), 0) from profiles where a <> z)"),
        ("repeated_profile_rows_removed", None, "(select coalesce(sum(c - 1), 0) from profiles where a = z)"),
        ("prepared_rows", None, "(select count(*) from profiles where a = z)"),
        ("remaining_missing", t, "0"),
    ]
    rows += [("raw_missing", c, f"(select count(*) from {source} where {c} is null)") for c in raw_columns]
    rows += [
        ("invalid_numeric_values", c, f"(select count(*) from cleaned where _label is not null and {c} is not null and _clean_{c} is null)")
        for c in contract.numeric
    ]
    rows += [("class_counts", name, f"(select count(*) from profiles where a = z and a = '{name}')") for name in contract.labels]
    rows += [("remaining_missing", c, f"(select count(*) from profiles where a = z and _clean_{c} is null)") for c in contract.features]
    selects = " union all ".join(
        f"select '{m}' as metric, {'cast(null as varchar)' if c is None else repr(c)} as \"column\", cast({v} as bigint) as value"
        for m, c, v in rows
    )
    return (
        f"with {ctes + ', ' if ctes else ''}once as (select distinct {raw} from {source}), "
        f"cleaned as (select *, {label} as _label, {cleaned} from once), "
        f"profiles as (select {keys}, count(*) as c, min(_label) as a, max(_label) as z from cleaned "
        f"where _label is not null group by {keys}) {selects}"
    )


_LINEITEM_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
_SURVEY_COLUMNS = "row_id {} Stress_Level Mental_Health_Score".format(" ".join(SURVEY_ROWS.features)).split()


@query("audit", _audit_sql(LINEITEM, "lineitem", _LINEITEM_COLUMNS))
def audit(spark, sf_dir):
    return quality.audit(table(spark, sf_dir, "lineitem"), LINEITEM)


@query("audit_survey", _audit_sql(SURVEY_ROWS, "survey", _SURVEY_COLUMNS, SURVEY_RAW_CTE))
def audit_survey(spark, sf_dir):
    return quality.audit(survey(spark, sf_dir), SURVEY_ROWS)


@query(
    "class_counts",
    f"with {sql_prepared_ctes(LINEITEM_WIDE, 'lineitem')}, labels as (select * from (values (0, 'A'), (1, 'N'), (2, 'R')) v(position, label)) "
    "select position, label, (select count(*) from prepared where l_returnflag = label) as n from labels",
)
def class_counts(spark, sf_dir):
    prepared = quality.prepare(lineitem_keyed(spark, sf_dir), LINEITEM_WIDE)
    return quality.class_counts(prepared, LINEITEM_WIDE)


# ------------------------------------------------------------------------ validation


def _strict_sql(contract, source: str, ctes: str) -> str:
    wanted = [*contract.features, contract.target]
    rules, step = [], 3
    rules += [(2, "missing_value", c, f"{c} is null") for c in wanted]
    for c in contract.numeric:
        value = sql_clean(contract.with_(bounds={}), c)
        low, high = contract.bounds.get(c, ("-1e308", "1e308"))
        rules.append((step, "not_numeric", c, f"{c} is not null and ({value}) is null"))
        rules.append((step + 1, "out_of_range", c, f"not (({value}) between {low} and {high})"))
        step += 2
    for c in [*contract.categorical, contract.target]:
        rules.append((step, "blank_text", c, f"{sql_strip(c)} = ''"))
        step += 1
    names = ", ".join(f"'{x}'" for x in contract.labels)
    t = contract.target
    rules.append((step, "unknown_label", t, f"{sql_strip(t)} <> '' and {sql_strip(t)} not in ({names})"))
    selects = " union all ".join(
        f"select {s} as step, '{r}' as rule, '{c}' as \"column\", count(*) as n from {source} where {test} having count(*) > 0"
        for s, r, c, test in rules
    )
    return f"with {ctes} {selects}"


_NARROW_SURVEY = SURVEY_ROWS.with_(labels=("Low", "Medium", "High"))


@query("strict_violations", _strict_sql(_NARROW_SURVEY, "survey", SURVEY_RAW_CTE))
def strict_violations(spark, sf_dir):
    return validate.strict_violations(survey(spark, sf_dir), _NARROW_SURVEY)


@query(
    "strict_accept",
    "select c_custkey, c_mktsegment, cast(c_acctbal as double) as c_acctbal, c_name, c_nationkey from customer",
)
def strict_accept(spark, sf_dir):
    wide = CUSTOMER.with_(bounds={"c_acctbal": (-100000, 100000)})
    return validate.validate_strict(table(spark, sf_dir, "customer"), wide)


def _request_codes_sql() -> str:
    """Codes of typed requests: the survey rows without target and score."""
    parts = []
    for c in SURVEY_ROWS.features:
        if c in SURVEY_ROWS.integers:
            low, high = SURVEY_ROWS.bounds[c]
            parts.append(
                f"case when {c} is null then '{c}:missing' when row_id % 6 = 0 then '{c}:type' "
                f"when {c} not between {low} and {high} then '{c}:range' end"
            )
        elif c in SURVEY_ROWS.numeric:
            value = sql_clean(SURVEY_ROWS.with_(bounds={}), c)
            low, high = SURVEY_ROWS.bounds[c]
            parts.append(
                f"case when {c} is null then '{c}:missing' when ({value}) is null then '{c}:type' "
                f"when not (({value}) between {low} and {high}) then '{c}:range' end"
            )
        else:
            parts.append(
                f"case when {c} is null then '{c}:missing' when {sql_strip(c)} = '' then '{c}:blank' "
                f"when length({c}) > 80 then '{c}:too_long' end"
            )
    parts.append("case when row_id % 8 = 0 then 'Mental_Health_Score:extra' end")
    return f"concat_ws(',', {', '.join(parts)})"


@query(
    "quarantine",
    f"with {SURVEY_RAW_CTE}, checked as (select row_id, {_request_codes_sql()} as codes from survey) "
    "select row_id, codes from checked where codes <> ''",
)
def quarantine(spark, sf_dir):
    """Requests as text columns: fractions in integer fields and the extra score column are refused."""
    rows = survey(spark, sf_dir).drop("Stress_Level")
    as_text = {c: F.format_string("%.0f", F.col(c)) for c in SURVEY_ROWS.integers}
    rows = rows.withColumns({c: F.when(F.col("row_id") % 6 == 0, F.concat(t, F.lit(".0"))).otherwise(t) for c, t in as_text.items()})
    rows = rows.withColumn("Mental_Health_Score", F.when(F.col("row_id") % 8 == 0, F.col("Mental_Health_Score")))
    _, refused = validate.split_valid(validate.check_request_rows(rows, SURVEY_ROWS))
    return refused.select("row_id", F.array_join("error_codes", ",").alias("codes"))


_JSON_CODES = "concat_ws(',', {})".format(", ".join([
    "case when o_orderkey % 10 = 0 then 'Age:missing' when o_orderkey % 10 = 1 then 'Age:type' "
    "when o_orderkey % 10 = 2 then 'Age:type' when 11 + o_custkey % 72 < 13 then 'Age:range' end",
    "case when o_orderkey % 10 = 3 then 'Avg_Daily_Usage_Hours:type' when o_orderkey % 10 = 4 then 'Avg_Daily_Usage_Hours:range' end",
    "case when o_orderkey % 10 = 5 then 'Daily_Unlocks:type' end",
    "case when o_orderkey % 10 = 6 then 'Most_Used_Platform:blank' when o_orderkey % 10 = 7 then 'Most_Used_Platform:too_long' end",
    "case when o_orderkey % 10 = 8 then 'Mental_Health_Score:extra' end",
]))


@query(
    "quarantine_json",
    f"select o_orderkey, case when o_orderkey % 31 = 0 then 'payload:malformed' else {_JSON_CODES} end as codes from orders",
)
def quarantine_json(spark, sf_dir):
    """JSON requests with every kind of fault; accepted rows have an empty code text."""
    case = F.col("o_orderkey") % 10
    age = (11 + F.col("o_custkey") % 72).cast("string")
    fields = [
        F.when(case == 0, F.lit(None).cast("string")).when(case == 1, F.concat(F.lit('"Age": "'), age, F.lit('"')))
        .when(case == 2, F.concat(F.lit('"Age": '), age, F.lit(".0"))).otherwise(F.concat(F.lit('"Age": '), age)),
        F.when(case == 3, F.lit('"Avg_Daily_Usage_Hours": "many"')).when(case == 4, F.lit('"Avg_Daily_Usage_Hours": 24.5'))
        .otherwise(F.lit('"Avg_Daily_Usage_Hours": "4.5"')),
        F.when(case == 5, F.lit('"Daily_Unlocks": 2.5')).otherwise(F.lit('"Daily_Unlocks": 130')),
        F.lit('"Study_Hours": 4, "Physical_Activity_Hours": 1e0, "Sleep_Hours_Per_Night": 6.75'),
        F.lit('"Academic_Level": "Graduate", "Purpose_Of_Use": "News"'),
        F.when(case == 6, F.lit('"Most_Used_Platform": " \\t "'))
        .when(case == 7, F.concat(F.lit('"Most_Used_Platform": "'), F.repeat(F.lit("x"), 81), F.lit('"')))
        .otherwise(F.lit('"Most_Used_Platform": "YouTube"')),
        F.when(case == 8, F.lit('"Mental_Health_Score": 8')),
    ]
    text = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*fields)), ", "), F.lit("}"))
    payload = F.when(F.col("o_orderkey") % 31 == 0, F.lit("{not json")).otherwise(text)
    requests = table(spark, sf_dir, "orders").select("o_orderkey", payload.alias("payload"))
    checked = validate.parse_requests(requests, SURVEY_ROWS)
    return checked.select("o_orderkey", F.array_join("error_codes", ",").alias("codes"))


_AGE_CASE = (
    "case when {x} < 12 then null when {x} <= 17 then '13-17' when {x} <= 24 then '18-24' when {x} <= 34 then '25-34' "
    "when {x} <= 44 then '35-44' when {x} <= 59 then '45-59' when {x} <= 120 then '60-120' end"
)


@query("age_bins", f"select {_AGE_CASE.format(x='p_size')} as size_group, count(*) as n from part group by 1")
def age_bins(spark, sf_dir):
    group = right_closed_group(F.col("p_size"), AGE_EDGES, AGE_GROUPS)
    return table(spark, sf_dir, "part").groupBy(group.alias("size_group")).agg(F.count(F.lit(1)).alias("n"))


# Fixed values, stated here apart from the contract's own: the shown name of each column.
_SHOWN = (
    ("Age", "Age"), ("Avg_Daily_Usage_Hours", "Daily social-media hours"), ("Daily_Unlocks", "Daily phone unlocks"), ("Study_Hours", "Study hours"),
    ("Physical_Activity_Hours", "Physical-activity hours"), ("Sleep_Hours_Per_Night", "Sleep hours per night"), ("Academic_Level", "Academic level"),
    ("Most_Used_Platform", "Main platform"), ("Purpose_Of_Use", "Main purpose"),
)


@query(
    "display_names",
    "select name as \"column\", display from (values " + ", ".join(f"('{c}', '{shown}')" for c, shown in _SHOWN)
    + ") v(name, display) where (select count(*) from orders) > 0",
)
def display_names(spark, sf_dir):
    """Column labels beside the columns that really occur in the table."""
    names = F.create_map(*[F.lit(v) for c in SURVEY_ROWS.features for v in (c, SURVEY_ROWS.display(c))])
    rows = quality.clean_features(survey(spark, sf_dir), SURVEY_ROWS)
    counted = rows.agg(*[F.count(F.lit(1)).alias(c) for c in rows.columns])
    long = counted.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in rows.columns])))
    return long.filter("n > 0").select("column", names[F.col("column")].alias("display"))


# ------------------------------------------------------------------- sources and sinks


@query(
    "source_changes",
    "select 'region=' || r_regionkey || '.csv' as file, case when r_regionkey = 2 then 'changed' when r_regionkey = 3 then 'missing' else 'same' end as status "
    "from region union all select 'region=none.csv', 'new'",
)
def source_changes(spark, sf_dir):
    """One file of customers per region; a row of one file is changed, one file is gone and one is new."""
    base = f"{ensure_checkpoint_dir(spark)}/sources-{uuid.uuid4().hex}"
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("string").alias("region"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(nations), "c_nationkey").select("c_custkey", "c_name", "region")
    changed = rows.filter("region <> '3'").withColumn("c_name", F.when(
        (F.col("region") == "2") & (F.col("c_custkey") == F.lit(rows.filter("region = '2'").agg(F.min("c_custkey")).first()[0])), "changed").otherwise(F.col("c_name")))
    changed = changed.unionByName(rows.limit(1).withColumn("region", F.lit("none")))
    manifests = []
    for name, version in (("then", rows), ("now", changed)):
        path = f"{base}/{name}"
        version.repartition("region").sortWithinPartitions("c_custkey").write.partitionBy("region").csv(path)
        files = source_manifest(spark, path).filter("file like '%.csv'")
        manifests.append(files.withColumn("file", F.concat(F.regexp_extract("file", "(region=[^/]+)/", 1), F.lit(".csv"))))
    return manifest_changes(manifests[1], manifests[0])


@query("table_fingerprint")
def fingerprint(spark, sf_dir):
    return table_fingerprint(table(spark, sf_dir, "lineitem"))


@query(
    "json_rows",
    "select '{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\",\"share\":' || "
    "case when o_orderkey % 3 = 0 then 'null' when o_orderkey % 3 = 1 then 'null' else cast(o_custkey as varchar) || '.5' end || '}' as value from orders",
)
def json_rows(spark, sf_dir):
    """JSON rows: NaN and infinities become null."""
    share = (
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan")))
        .when(F.col("o_orderkey") % 3 == 1, F.lit(float("inf")))
        .otherwise(F.col("o_custkey") + 0.5)
    )
    return result_json(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", share.alias("share")))


@query(
    "csv_round_trip",
    "select cast(c_custkey as varchar) as c_custkey, c_name, c_mktsegment, cast(c_nationkey as varchar) as c_nationkey from customer",
)
def csv_round_trip(spark, sf_dir):
    """A table written as CSV and scanned again: every column is text, and every cell is the same."""
    path = f"{ensure_checkpoint_dir(spark)}/customer-{uuid.uuid4().hex}.csv"
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    write_table(rows, path, fmt="csv")
    return read_table(spark, path)


@query(
    "json_sink_round_trip",
    "select o_orderkey, o_orderstatus, o_orderpriority from orders",
)
def json_sink_round_trip(spark, sf_dir):
    """Rows written by the JSON sink and scanned again."""
    path = f"{ensure_checkpoint_dir(spark)}/orders-{uuid.uuid4().hex}.json"
    write_json(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return read_table(spark, path, "json")


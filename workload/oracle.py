"""The same queries as SQL over the driver's tables, for DuckDB.

`ROWS` derives every layer's rows from the tables alone. Amounts are whole cents, so money is kept
as integer cents and divided at the end. Rounded means and shares are computed in integers (half
away from zero), since averaging in floating point can miss an exact half.
"""

from tierline.schema import GOLD_COMMENT, SILVER_COMMENT, bronze_comment

# A row of any layer: its feed, landed file, period, versions, and raw and conformed columns.
# Files before 2000-01 landed before the first run, the rest before the second.
ROWS = """
with a0 as (
  select *, l_shipdate + to_hours(cast(l_orderkey % 24 as int))
    - to_days(case when l_orderkey % 97 = 0 then 40 else 0 end) as st
  from lineitem
), b0 as (
  select *, o_orderdate + to_hours(cast(o_orderkey % 24 as int)) as st from orders
), raw as (
  select 'a' as feed, l_shipdate as file_date, l_suppkey as entity_id,
    nullif(l_linenumber - 1, 6) as party_size,
    case when l_quantity = 1 then 0 when l_quantity = 2 then null
      when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as total_amount,
    st as start_ts, st + to_hours(cast(l_quantity - 3 as int)) as end_ts,
    case when year(l_shipdate) >= 1997 then l_tax end as surcharge, null as status
  from a0
  union all
  select 'b', o_orderdate, o_custkey, o_custkey % 7,
    case when o_orderstatus = 'P' then -o_totalprice else o_totalprice end,
    st, st + to_hours(cast(o_orderkey % 5 as int)), null,
    case when o_orderkey % 2 = 1 then o_orderstatus end
  from b0
  union all
  select 'c', ts, user_id, user_id % 6,
    case when event_type = 'error' then -value else value end,
    ts, ts + to_minutes(cast(event_id % 60 as int)), null, null
  from events
), versioned as (
  select *, cast(year(file_date) as int) as year, cast(month(file_date) as int) as month,
    feed || '_' || strftime(file_date, '%Y-%m') || '.parquet' as source_file,
    cast(round(total_amount * 100) as bigint) as cents,
    cast(case when feed <> 'c' and year(file_date) >= 2000 then 1 else 0 end as bigint) as bronze_version,
    cast(case feed when 'a' then case when year(file_date) < 2000 then 0 else 2 end
      when 'b' then case when year(file_date) < 2000 then 1 else 3 end
      else 4 end as bigint) as silver_version
  from raw
), rows as (
  select *, cents / 100.0 as amount, coalesce(total_amount >= 0, false) as is_amount_valid,
    cast(hour(start_ts) as int) as start_hour,
    cast(case when silver_version < 2 then 0 else 1 end as bigint) as gold_version,
    -- fixed values: bucket labels and bounds
    case when amount < 0 then 'negative' when amount = 0 then 'zero' when amount < 20 then '0-20'
      when amount < 50 then '20-50' when amount < 100 then '50-100' else '100+' end as bucket
  from versioned
)
"""

SILVER_COLUMNS = """cast(entity_id as int) as entity_id, cast(party_size as int) as party_size,
  cast(amount as double) as amount, start_ts, end_ts, feed, is_amount_valid, year, month"""
GOLD_COLUMNS = """cast(entity_id as int) as entity_id, cast(party_size as int) as party_size,
  cast(amount as double) as amount, start_ts, end_ts, feed, year, month, start_hour"""


def mean(value: str, scale: int) -> str:
    """Mean to two decimals of a column given in units of 1/scale; NULL over no values."""
    total, n = f"sum({value})", f"count({value})"
    unit = 100 // scale  # hundredths per unit
    return (
        f"case when {n} = 0 then null else cast(sign({total}) * "
        f"((2 * abs({total}) * {unit} + {n}) // (2 * {n})) / 100.0 as double) end"
    )


SHARE = (
    "cast((2000 * count(*) + sum(count(*)) over ()) // (2 * sum(count(*)) over ()) / 10.0 as double)"
)
WINDOW = "year = 1998 and month between 1 and 5"
COUNT = "cast(count(*) as bigint)"


def of_rows(select: str) -> str:
    return f"{ROWS} {select}"


def grouped(keys: str, where: str = "true", count: str = "rows") -> str:
    return of_rows(f"select {keys}, {COUNT} as {count} from rows where {where} group by {keys}")


MISMATCHES = {
    "pl4_passing_bronze": "feed, source_file, cast(0 as bigint) as landing_rows, cast(0 as bigint) as bronze_rows",
    "pl5_passing_silver": "feed, cast(0 as bigint) as bronze_rows, cast(0 as bigint) as silver_rows",
    "pl6_passing_gold": "feed, cast(0 as bigint) as silver_rows, cast(0 as bigint) as gold_rows",
}

# the newest commit of every table: what it did, its rows and the highest source version among them
LAST_COMMITS = f"""{ROWS}, commits as (
  select 'bronze_' || feed as "table", bronze_version as version, 'ingest ' || feed as operation,
    {COUNT} as rows, cast(null as bigint) as source_version
  from rows group by feed, bronze_version
  qualify bronze_version = max(bronze_version) over (partition by feed)
  union all
  select 'silver', silver_version, 'conform ' || feed, {COUNT}, max(bronze_version)
  from rows group by feed, silver_version qualify silver_version = max(silver_version) over ()
  union all
  select 'gold', gold_version, 'publish', {COUNT}, max(silver_version)
  from rows group by gold_version qualify gold_version = max(gold_version) over ()
)"""

RECONCILIATION = of_rows(
    f"""select layer, feed, {COUNT} as rows
    from rows cross join (values ('bronze'), ('silver'), ('gold')) as layers(layer)
    group by layer, feed"""
)

ORACLE: dict[str, str] = {
    "src1_read_clean": of_rows(
        """select feed, source_file, entity_id as entity_code, cast(party_size as double) as party_size,
        total_amount from rows"""
    ),
    "src2_read_new_files": of_rows(
        """select feed, source_file, entity_id as entity_code, total_amount, surcharge, status
        from rows"""
    ),
    "src3_landed_files": of_rows("select distinct feed, source_file from rows"),
    "src4_ingested_files": of_rows("select distinct feed, source_file from rows"),
    "src5_read_inserts_since": of_rows(
        f"""select * exclude (start_ts, end_ts) from (select {SILVER_COLUMNS}, silver_version
        as _source_version from rows where silver_version >= 2)"""
    ),
    "src7_table_scan": of_rows(
        f"""select env, source_file, {COUNT} as rows
        from rows cross join (values ('dev'), ('prod')) as envs(env)
        where feed = 'a' group by env, source_file"""
    ),
    "snk1_bronze_append": of_rows(
        f"""select feed, bronze_version as _commit_version, {COUNT} as rows,
        count(surcharge) as with_surcharge, count(status) as with_status,
        cast(sum(entity_id) as bigint) as entity_sum from rows group by feed, bronze_version"""
    ),
    "snk2_silver_insert": of_rows(
        f"select {SILVER_COLUMNS}, bronze_version as _source_version from rows"
    ),
    "snk3_gold_insert": of_rows(
        f"select {GOLD_COLUMNS}, silver_version as _source_version from rows"
    ),
    "snk6_period_layout": of_rows(
        f"""select layer, feed, year, month, {COUNT} as rows
        from rows cross join (values ('silver'), ('gold')) as layers(layer)
        group by layer, feed, year, month"""
    ),
    "ver1_last_version": of_rows(
        """select 'bronze_' || feed as "table", max(bronze_version) as version from rows group by feed
        union all select 'silver', max(silver_version) from rows
        union all select 'gold', max(gold_version) from rows"""
    ),
    "ver2_table_version": of_rows(
        """select 'silver_' || feed as target, max(bronze_version) as version from rows group by feed
        union all select 'silver_none', coalesce(max(bronze_version), -1) from rows where feed = 'none'
        union all select 'gold', max(silver_version) from rows"""
    ),
    "ver3_written_rows": f'{LAST_COMMITS} select "table", version, rows from commits',
    "ver4_load_history": of_rows(
        f"""select silver_version as version, 'conform ' || feed as operation, {COUNT} as rows
        from rows group by silver_version, feed"""
    ),
    "lim1_latest_commit": f"{LAST_COMMITS} select * from commits",
    "prj1_conform_to_table": of_rows(
        """select feed, source_file, entity_id as entity_code, cast(party_size as double) as party_size,
        surcharge, status from rows"""
    ),
    "prj2_silver_projection": of_rows(
        f"select {SILVER_COLUMNS}, bronze_version as _source_version from rows"
    ),
    "prj3_gold_projection": of_rows(
        f"select {GOLD_COLUMNS}, silver_version as _source_version from rows"
    ),
    "prj5_validity_flag": grouped("feed, is_amount_valid"),
    "prj6_identifier_parameter": of_rows(
        """select feed, source_file, min(start_ts) as earliest, max(start_ts) as latest
        from rows group by feed, source_file"""
    ),
    "flt2_period_filter": of_rows(
        f"""select {GOLD_COLUMNS}, silver_version as _source_version
        from rows where feed = 'a' and {WINDOW}"""
    ),
    "flt3_positive_filter": of_rows(
        f"""select feed, cast(party_size as int) as party_size, {COUNT} as rows
        from rows where party_size > 0 group by all"""
    ),
    "flt4_column_comparison": of_rows(
        """select feed, year, month, cast(entity_id as int) as entity_id, start_ts, end_ts
        from rows where end_ts < start_ts"""
    ),
    "flt6_case_bucketing": grouped("feed, bucket"),
    "jn1_new_files": of_rows(
        "select distinct feed, source_file from rows where bronze_version = 1"
    ),
    "jn2_landing_vs_bronze": of_rows(
        f"""select feed, source_file, {COUNT} as landing_rows, cast(0 as bigint) as bronze_rows
        from rows where bronze_version = 1 group by feed, source_file"""
    ),
    "jn3_silver_vs_gold": of_rows(
        """select feed, count(*) filter (silver_version >= 2) as silver_rows,
        count(*) filter (gold_version = 0) as gold_rows from rows group by feed
        having silver_rows <> gold_rows"""
    ),
    "jn4_bronze_vs_silver": of_rows(
        f"""select feed, {COUNT} as bronze_rows, count(*) filter (silver_version <= 1) as silver_rows
        from rows group by feed having count(*) <> count(*) filter (silver_version <= 1)"""
    ),
    "jn5_missing_periods": of_rows(
        """select feed, strftime(m, '%Y-%m') as period
        from (select unnest(generate_series(timestamp '1994-01-01', timestamp '2024-12-01',
          interval 1 month)) as m)
        cross join (select feed, max(file_date) as latest from rows group by feed) as feeds
        where m <= case when feed = 'c' then latest else timestamp '2003-06-01' end
          and not exists (select 1 from rows where rows.feed = feeds.feed
            and rows.year = year(m) and rows.month = month(m))"""
    ),
    "agg1_rows_per_file": grouped("feed, source_file", count="bronze_rows"),
    "agg2_landing_counts": grouped("feed, source_file", count="landing_rows"),
    "agg3_global_count": of_rows(f"select {COUNT} as rows from rows"),
    "agg4_count_per_feed": grouped("feed"),
    "agg5_distinct_files": of_rows(
        f"""select feed, count(distinct source_file) as files, {COUNT} as rows from rows group by feed"""
    ),
    "agg6_month_coverage": grouped("feed, year, month"),
    "agg7_start_range": of_rows(
        """select feed, min(start_ts) as first_start, max(start_ts) as last_start
        from rows group by feed"""
    ),
    "agg8_entity_distribution": of_rows(
        f"select cast(entity_id as int) as entity_id, {COUNT} as rows from rows group by all"
    ),
    "agg9_party_distribution": of_rows(
        f"select cast(party_size as int) as party_size, {COUNT} as rows from rows group by all"
    ),
    "agg10_amount_histogram": grouped("bucket"),
    "agg11_null_audit": of_rows(
        f"""select {COUNT} as rows,
        cast(sum(case when amount is null then 1 else 0 end) as bigint) as null_amount,
        cast(sum(case when start_ts is null then 1 else 0 end) as bigint) as null_start,
        cast(sum(case when end_ts is null then 1 else 0 end) as bigint) as null_end,
        cast(sum(case when party_size is null then 1 else 0 end) as bigint) as null_party
        from rows"""
    ),
    "agg12_validity_split": of_rows(
        f"""select is_amount_valid, {COUNT} as rows, cast(min(cents) / 100.0 as double) as min_amount,
        cast(max(cents) / 100.0 as double) as max_amount from rows group by is_amount_valid"""
    ),
    "agg13_bad_intervals": of_rows(
        f"select {COUNT} as bad_intervals from rows where end_ts < start_ts"
    ),
    "agg14_avg_amount_per_month": of_rows(
        f"""select year, month, {mean("cents", 100)} as avg_amount
        from rows where feed = 'a' and {WINDOW} group by year, month order by year, month"""
    ),
    "agg15_avg_party_per_hour": of_rows(
        f"""select start_hour, {mean("party_size", 1)} as avg_party from rows
        where year = 1998 and month = 5 and party_size > 0 group by start_hour order by start_hour"""
    ),
    "agg16_revenue_per_feed": of_rows(
        f"""select feed, year, month, {COUNT} as trips, cast(sum(cents) / 100.0 as double) as revenue,
        {mean("cents", 100)} as avg_ticket from rows where {WINDOW}
        group by feed, year, month order by feed, year, month"""
    ),
    "agg17_volume_per_hour": of_rows(
        f"""select start_hour, {COUNT} as trips, {SHARE} as pct_of_day from rows
        where year = 1998 and month = 5 group by start_hour order by start_hour"""
    ),
    "agg18_trips_pivot": of_rows(
        """select month, nullif(count(*) filter (feed = 'a'), 0) as a,
        nullif(count(*) filter (feed = 'b'), 0) as b, nullif(count(*) filter (feed = 'c'), 0) as c
        from rows where year = 1998 group by month order by month"""
    ),
    "agg18_revenue_pivot": of_rows(
        f"""select month, cast(sum(cents) filter (feed = 'a') / 100.0 as double) as a,
        cast(sum(cents) filter (feed = 'b') / 100.0 as double) as b,
        cast(sum(cents) filter (feed = 'c') / 100.0 as double) as c
        from rows where {WINDOW} group by month order by month"""
    ),
    "win1_share_per_feed": of_rows(
        f"select feed, {COUNT} as rows, {SHARE} as pct from rows group by feed order by rows desc"
    ),
    "win2_share_per_hour": of_rows(
        f"""select feed, start_hour, {COUNT} as rows, {SHARE} as pct from rows where year = 1998
        group by feed, start_hour"""
    ),
    "srt1_multi_key_sort": f"{RECONCILIATION} order by feed, layer",
    "srt2_descending_by_count": f"{grouped('year, month')} order by rows desc",
    "srt3_sort_by_hidden_aggregate": of_rows(
        """select feed, year, count(amount) as amounts from rows group by feed, year
        order by min(cents)"""
    ),
    "set1_rows_per_bronze_table": grouped("feed"),
    "set2_rows_per_layer": of_rows(
        f"""select 'bronze' as layer, {COUNT} as rows from rows where feed = 'a'
        union all select 'silver', {COUNT} from rows where feed = 'a'
        union all select 'gold', {COUNT} from rows where feed = 'a'"""
    ),
    "set3_files_and_rows": of_rows(
        f"""select feed, count(distinct source_file) as files, {COUNT} as rows
        from rows group by feed"""
    ),
    "set4_environments": of_rows(
        f"""select 'dev' as env, count(distinct source_file) as files, {COUNT} as rows
        from rows where feed = 'a'
        union all select 'prod', count(distinct source_file), {COUNT} from rows where feed = 'a'"""
    ),
    "set5_layer_reconciliation": f"{RECONCILIATION} order by feed, layer",
    "set6_union_by_name": of_rows(
        f"""select source_file, {COUNT} as rows, count(surcharge) as with_surcharge,
        count(status) as with_status from rows group by source_file"""
    ),
    "sc1_cast_to_int": of_rows(
        f"""select feed, cast(trunc(party_size) as int) as party_size, {COUNT} as rows
        from rows group by all"""
    ),
    "sc2_cast_to_decimal": of_rows(
        """select feed, source_file, cast(sum(cents) / 100.0 as double) as total
        from rows group by feed, source_file"""
    ),
    "sc3_cast_to_timestamp": of_rows(
        """select feed, source_file, min(start_ts) as first_start, max(end_ts) as last_end
        from rows group by feed, source_file"""
    ),
    "sc4_coalesce": of_rows(
        """select feed, source_file, cast(sum(cast(coalesce(total_amount >= 0, false) as int)) as bigint)
        as valid_rows from rows group by feed, source_file"""
    ),
    "sc5_regexp_extract": of_rows(
        f"""select feed, source_file,
        cast(regexp_extract(source_file, '([0-9]{{4}})-([0-9]{{2}})', 1) as int) as year,
        cast(regexp_extract(source_file, '([0-9]{{4}})-([0-9]{{2}})', 2) as int) as month,
        {COUNT} as rows from rows group by all"""
    ),
    "sc6_hour": of_rows(
        f"select feed, start_hour as hour, {COUNT} as rows from rows group by feed, start_hour"
    ),
    "sc7_round": of_rows(
        f"""select feed, cast(entity_id as int) as entity_id, year, month,
        {mean("cents", 100)} as avg_amount from rows group by feed, entity_id, year, month"""
    ),
    "sc8_case_when": of_rows(
        """select feed, year,
        cast(sum(case when amount is null then 1 else 0 end) as bigint) as null_amount,
        cast(sum(case when party_size is null then 1 else 0 end) as bigint) as null_party
        from rows group by feed, year"""
    ),
    "sc9_comparisons": grouped(
        "feed, year", "cents between -10000 and 10000 and (party_size is null or party_size >= 2)"
    ),
    "sc10_decimal_arithmetic": of_rows(
        f"select year, month, {COUNT} as rows, {SHARE} as pct from rows group by year, month"
    ),
    "sc11_literal_label": of_rows(
        f"select feed, 'bronze' as layer, {COUNT} as rows from rows group by feed"
    ),
    "sc13_month_index": of_rows(
        f"""select cast(year * 12 + month - 1 as int) as month_index,
        strftime(make_date(year, month, 1), '%Y-%m') as period, {COUNT} as rows
        from rows group by year, month"""
    ),
    "st1_stream_conform": of_rows(
        f"select {SILVER_COLUMNS}, bronze_version as _source_version from rows"
    ),
    "st1_stream_publish": of_rows(f"select {GOLD_COLUMNS} from rows"),
    "pl1_ingest": of_rows(
        f"""select feed, source_file, bronze_version as _commit_version, {COUNT} as rows
        from rows group by all"""
    ),
    "pl2_conform": of_rows(
        f"""select feed, silver_version as _commit_version, bronze_version as _source_version,
        {COUNT} as rows from rows group by all"""
    ),
    "pl3_publish": of_rows(
        f"""select feed, gold_version as _commit_version, silver_version as _source_version,
        {COUNT} as rows from rows group by all"""
    ),
    "pl4_verify_bronze": of_rows(
        f"""select feed, source_file, {COUNT} as landing_rows,
        cast(case when feed = 'c' then 2 * count(*) else 0 end as bigint) as bronze_rows
        from rows where feed = 'c' or bronze_version = 1 group by feed, source_file"""
    ),
    "pl5_verify_silver": of_rows(
        """select feed, cast(case when feed = 'c' then 2 else 1 end * count(*) filter (bronze_version = 0)
          as bigint) as bronze_rows, count(*) filter (silver_version >= 2) as silver_rows
        from rows group by feed having bronze_rows <> silver_rows"""
    ),
    "pl6_verify_gold": of_rows(
        """select feed, count(*) filter (silver_version >= 2) as silver_rows,
        count(*) filter (gold_version = 0) as gold_rows from rows group by feed
        having silver_rows <> gold_rows"""
    ),
    **{name: of_rows(f"select {columns} from rows where false") for name, columns in MISMATCHES.items()},
    "pl7_build": of_rows(
        f"""select feed, month, {COUNT} as rows, cast(sum(cents) / 100.0 as double) as revenue
        from rows where year = 1998 group by feed, month"""
    ),
}

# Questions asked another way have the same answers.
ORACLE |= {
    "src6_avg_amount_sql": ORACLE["agg14_avg_amount_per_month"],
    "src6_avg_party_sql": ORACLE["agg15_avg_party_per_hour"],
    "src6_revenue_sql": ORACLE["agg16_revenue_per_feed"],
    "src6_volume_sql": ORACLE["agg17_volume_per_hour"],
    "snk4_question_by_catalog": ORACLE["agg14_avg_amount_per_month"],
    "src6_changes_sql": of_rows(
        f"""select feed, bronze_version as _source_version, {COUNT} as rows,
        cast(count(*) filter (not is_amount_valid) as bigint) as doubtful
        from rows where silver_version >= 2 group by feed, bronze_version"""
    ),
    "src7_every_feed": of_rows(
        f"""select env, feed, source_file, {COUNT} as rows
        from rows cross join (values ('dev'), ('prod')) as envs(env) group by env, feed, source_file"""
    ),
    "set2_every_feed": of_rows(
        f"""select layer, feed, {COUNT} as rows
        from rows cross join (values ('bronze'), ('silver'), ('gold')) as layers(layer) group by layer, feed"""
    ),
    "set4_every_feed": of_rows(
        f"""select env, feed, count(distinct source_file) as files, {COUNT} as rows
        from rows cross join (values ('dev'), ('prod')) as envs(env) group by env, feed"""
    ),
    "srt1_month_rows_sorted": of_rows(
        f"""select layer, feed, year, month, {COUNT} as rows
        from rows cross join (values ('silver'), ('gold')) as layers(layer)
        group by layer, feed, year, month order by feed, year, month, layer"""
    ),
    "snk6_range_layout": of_rows(
        f"select feed, year, month, {COUNT} as rows, true as in_few_files from rows group by feed, year, month"
    ),
    "st1_feed_added": of_rows(
        f"""select feed, year, month, bronze_version as _source_version, {COUNT} as rows
        from rows group by feed, year, month, bronze_version"""
    ),
    "flt5_empty_batch": of_rows(
        f"""select feed, cast(2 as bigint) as entries, cast(1 as bigint) as empty_entries, {COUNT} as landing_rows,
        cast(1 as bigint) as commits, {COUNT} as bronze_rows
        from rows where (feed, source_file) in (select feed, max(source_file) from rows group by feed) group by feed"""
    ),
}

# The contracts' columns in order: name, type, what fills it (fixed values).
_COLUMNS = {
    "entity_id": ("int", "entity_id"),
    "party_size": ("int", "party_size"),
    "amount": ("decimal(10,2)", "cents"),
    "start_ts": ("timestamp", "start_ts"),
    "end_ts": ("timestamp", "end_ts"),
    "feed": ("string", "feed"),
    "is_amount_valid": ("boolean", "is_amount_valid"),
    "year": ("int", "year"),
    "month": ("int", "month"),
    "start_hour": ("int", "start_hour"),
    "_source_version": ("bigint", "bronze_version"),
    "_commit_version": ("bigint", "bronze_version"),
}
ORACLE["snk4_contract"] = of_rows(
    " union all ".join(
        f"""select '{table}' as "table", '{name}' as col_name, '{kind}' as data_type,
        {str(name != "_commit_version").lower()} as documented, count({value}) as filled from rows"""
        for table, absent in (("silver", "start_hour"), ("gold", "is_amount_valid"))
        for name, (kind, value) in _COLUMNS.items()
        if name != absent
    )
)
_COMMENTS = [("silver", "true", SILVER_COMMENT), ("gold", "true", GOLD_COMMENT)]
_COMMENTS += [(f"bronze_{feed}", f"feed = '{feed}'", bronze_comment(feed)) for feed in ("a", "b", "c")]
ORACLE["snk5_documentation"] = of_rows(
    " union all ".join(
        f"""select '{table}' as "table", '{comment.replace("'", "''")}' as comment, {COUNT} as rows from rows where {scope}"""
        for table, scope, comment in _COMMENTS
    )
)

# What each feed's files call their columns, and what fills them (fixed values).
_RAW = {"entity_code": "entity_id", "party_size": "party_size", "total_amount": "total_amount", "source_file": "source_file"}
_RAW_OF = {
    feed: {**_RAW, f"{feed}_start_ts": "start_ts", f"{feed}_end_ts": "end_ts", **extra}
    for feed, extra in (("a", {"surcharge": "surcharge"}), ("b", {"status": "status"}), ("c", {}))
}
_CANONICAL_OF = {"entity_id": "entity_id", "party_size": "party_size", "total_amount": "amount", "start_ts": "start_ts", "end_ts": "end_ts"}
ORACLE["sc12_lowercase_names"] = of_rows(
    " union all ".join(
        f"""select '{feed}' as feed, '{name}' as column_name, count({value}) as filled from rows where feed = '{feed}'"""
        for feed, columns in _RAW_OF.items()
        for name, value in columns.items()
    )
)
ORACLE["prj4_feed_columns"] = of_rows(
    " union all ".join(
        f"""select '{feed}' as feed, '{_CANONICAL_OF[value]}' as canonical, '{name}' as raw_column, count({value}) as filled
        from rows where feed = '{feed}'"""
        for feed, columns in _RAW_OF.items()
        for name, value in columns.items()
        if value in _CANONICAL_OF
    )
)
ORACLE["flt1_inserts_only"] = of_rows(
    " union all ".join(
        f"""select {table} as "table", {version} as _source_version, {COUNT} as inserted from rows group by all"""
        for table, version in (
            ("'bronze_' || feed", "bronze_version"), ("'silver'", "silver_version"), ("'gold'", "gold_version")
        )
    )
)

"""The same results in plain SQL, over the same tables, for every query SQL can express."""

from __future__ import annotations

from itertools import combinations

from perennia.plans.catalog import MEASURES, WIDE

GAPPY = """
    select event_id, user_id, event_type, value,
           case when event_id % 3 <> 0 then value end as value_gap,
           case when event_id % 4 = 0 then 'NaN'::double else value end as value_nan,
           case when event_type = 'error' then 'NA' else event_type end as type_na,
           case when event_id % 5 < 3 then 'NA' else event_type end as mostly_na,
           case when event_id % 2 = 0 then user_id end as half_null
    from events
"""
# How many values each column of GAPPY lacks.
GAPPY_MISSING = {
    "event_id": "event_id is null",
    "user_id": "user_id is null",
    "event_type": "event_type is null or event_type = 'NA'",
    "value": "value is null or isnan(value)",
    "value_gap": "value_gap is null or isnan(value_gap)",
    "value_nan": "value_nan is null or isnan(value_nan)",
    "type_na": "type_na is null or type_na = 'NA'",
    "mostly_na": "mostly_na is null or mostly_na = 'NA'",
    "half_null": "half_null is null",
}
GAPPY_TYPES = {
    "event_id": "bigint",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "value_gap": "double",
    "value_nan": "double",
    "type_na": "string",
    "mostly_na": "string",
    "half_null": "bigint",
}

RATINGS = """
    select l_orderkey, l_linenumber,
           case l_linenumber % 4
             when 0 then 'NA'
             when 1 then l_quantity::int::varchar || '+' || l_linenumber::varchar
             when 2 then l_quantity::int::varchar || '-' || l_linenumber::varchar
             else l_quantity::int::varchar end as rating
    from lineitem
"""

TEXTS = """
    select l_orderkey::varchar as l_orderkey,
           case when l_linenumber % 3 = 0 then l_quantity::int::varchar || '+3'
                else l_quantity::int::varchar end as rating,
           case when l_linenumber % 5 = 0 then 'NA'
                else l_extendedprice::decimal(20,2)::varchar end as amount,
           case when l_linenumber % 4 = 0 then 'unknown'
                else strftime(l_shipdate, '%Y-%m-%d') end as l_shipdate
    from lineitem
"""

MEASURED = """
    select event_id, user_id, value,
           case when event_id % 3 <> 0 then value * value end as energy,
           case when event_type = 'error' then 1 else 0 end as is_error,
           floor(value)::int as whole
    from events
"""

CHARGES = """
    select l_orderkey, l_linenumber, l_quantity, l_extendedprice / 1000 as price, l_discount, l_tax,
           l_returnflag, l_linestatus,
           l_extendedprice / 1000 * (1 - l_discount) * (1 + l_tax) as charge,
           case when ('0x' || substr(md5(concat_ws(':', l_orderkey::varchar, '66')), 1, 8))::bigint
                     / 4294967296::double < 0.8::double
                then 'train' else 'test' end as split
    from lineitem
"""
FIT = f"""
    charges as ({CHARGES}),
    fit as (select regr_slope(charge, price) as b, regr_intercept(charge, price) as a
            from charges where split = 'train'),
    scored as (select l_orderkey, l_linenumber, split, charge as target, a + b * price as prediction
               from charges, fit)
"""

FEATURES = f"""
    charges as ({CHARGES}),
    flags as (select l_returnflag, row_number() over (order by count(*) desc, l_returnflag) - 1 as f
              from charges where split = 'train' group by 1),
    states as (select l_linestatus, row_number() over (order by count(*) desc, l_linestatus) - 1 as s
               from charges where split = 'train' group by 1),
    rows as (select *, (f = 0)::int as f0, (f = 1)::int as f1, (s = 0)::int as s0
             from charges join flags using (l_returnflag) join states using (l_linestatus))
"""


def _residuals() -> str:
    """Least squares of charge on all features as CTEs; ``y`` of ``r7`` is the residual.

    The features are made orthogonal one after the other, and each takes its share of
    the label; coefficients come from the train part only.
    """
    names = ["l_quantity", "price", "l_discount", "l_tax", "f0", "f1", "s0"]
    means = ", ".join(f"avg({c}) as m{i}" for i, c in enumerate(names))
    centred = ", ".join(f"{c} - m{i} as x{i}" for i, c in enumerate(names))
    steps = [
        f"m as (select {means}, avg(charge) as my from rows where split = 'train')",
        f"r0 as (select split, charge as target, charge - my as y, {centred} from rows, m)",
    ]
    for k in range(len(names)):
        later = range(k + 1, len(names))
        shares = [f"sum(x{k} * x{j}) / sum(x{k} * x{k}) as b{j}" for j in later]
        rest = [f"x{j} - b{j} * x{k} as x{j}" for j in later]
        steps.append(
            f"c{k} as (select {', '.join([*shares, f'sum(x{k} * y) / sum(x{k} * x{k}) as b'])} "
            f"from r{k} where split = 'train')"
        )
        steps.append(f"r{k + 1} as (select {', '.join(['split', 'target', f'y - b * x{k} as y', *rest])} from r{k}, c{k})")
    return FEATURES + ", " + ", ".join(steps)


def _per_column(source: str, measures: dict[str, str]) -> str:
    parts = [f"select '{c}' as column_name, {columns} from src" for c, columns in measures.items()]
    return f"with src as ({source}) " + " union all ".join(parts)


def _number(column: str) -> str:
    return f"round({column}, 6) + 0.0::double"


def _bounds(columns: list[str]) -> str:
    """Quartile bounds of the columns of MEASURED, as CTEs src and bounds."""
    parts = [
        f"""select '{c}' as column_name, count({c}) as n, min({c})::double as minimum,
                   quantile_disc({c}, 0.25)::double as q1, quantile_disc({c}, 0.75)::double as q3,
                   max({c})::double as maximum,
                   count(distinct {c}) <= 2 as two_valued
            from src"""
        for c in columns
    ]
    return f"""src as ({MEASURED}),
        bounds as (select *, q1 - 1.5 * (q3 - q1) as lower_bound, q3 + 1.5 * (q3 - q1) as upper_bound
                   from ({" union all ".join(parts)}))"""


def _flags(columns: list[str], skip_two_valued: bool = True) -> str:
    skip = "and not two_valued" if skip_two_valued else ""
    return " + ".join(
        f"""(case when exists (select 1 from bounds where column_name = '{c}' {skip}
                               and ({c} < lower_bound or {c} > upper_bound)) then 1 else 0 end)"""
        for c in columns
    )


def _correlations(source: str, columns: list[str], digits: int) -> str:
    pairs = [
        f"select '{a}' as a, '{b}' as b, round(corr({b}, {a}), {digits}) + 0.0::double as r from src"
        for a, b in combinations(columns, 2)
    ]
    return f"with src as ({source}) " + " union all ".join(pairs)


SQL: dict[str, str] = {
    "filter_equality": """
        select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders where o_orderstatus = 'F'""",
    "filter_range": """
        select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
        where l_shipdate < timestamp '1998-01-01' and l_quantity >= 10""",
    "group_count": "select event_type, count(*) as n from events group by event_type",
    "group_count_2key": """
        select year(o_orderdate)::int as year, o_orderpriority, count(*) as n from orders group by 1, 2""",
    "group_avg": "select p_brand, round(avg(p_size), 6) as avg_size from part group by p_brand",
    "group_avg_floating": """
        select l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) as avg_price
        from lineitem group by 1, 2""",
    "topk": "select p_brand, count(*) as n from part group by p_brand order by n desc, p_brand limit 5",
    "topk_with_ties": """
        select o_custkey, n from (
          select o_custkey, count(*) as n, rank() over (order by count(*) desc) as r from orders group by 1)
        where r <= 5""",
    "bottomk_with_ties": """
        select o_custkey, n from (
          select o_custkey, count(*) as n, rank() over (order by count(*)) as r from orders group by 1)
        where r <= 5""",
    "extreme_avg_groups": """
        select p_brand, round(avg_size, 6) as avg_size from (
          select p_brand, avg(p_size) as avg_size, rank() over (order by avg(p_size) desc) as r
          from part where p_type = 'ECONOMY' group by p_brand)
        where r <= 5""",
    "extreme_avg_groups_lowest": """
        select p_brand, round(avg_size, 6) as avg_size from (
          select p_brand, avg(p_size) as avg_size, rank() over (order by avg(p_size)) as r
          from part where p_type = 'ECONOMY' group by p_brand)
        where r <= 5""",
    "extreme_avg_groups_floating": """
        with src as (
          select l_suppkey, avg(case when l_suppkey % 50 = 7 then 'infinity'::double
                                     else l_quantity * power(2::double, -40) end) as avg_measure
          from lineitem group by l_suppkey)
        select l_suppkey, avg_measure, true as highest from src
        where avg_measure = (select max(avg_measure) from src)
        union all
        select l_suppkey, avg_measure, false as highest from (
          select *, rank() over (order by avg_measure) as r from src) where r <= 3""",
    "dedup_latest": """
        select l_partkey, l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               strftime(l_shipdate, '%Y-%m-%d') as l_shipdate
        from (select *, row_number() over (
                partition by l_partkey
                order by l_shipdate desc, l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice) as rn
              from lineitem)
        where rn = 1""",
    "rank_in_group": """
        select o_orderpriority, o_custkey, n,
               row_number() over (partition by o_orderpriority order by n desc, o_custkey) as rank
        from (select o_orderpriority, o_custkey, count(*) as n from orders group by 1, 2)""",
    "mode_per_group": """
        select year, o_orderpriority, n from (
          select year(o_orderdate)::int as year, o_orderpriority, count(*) as n,
                 row_number() over (partition by year(o_orderdate)
                                    order by count(*) desc, o_orderpriority) as r
          from orders group by year(o_orderdate), o_orderpriority)
        where r = 1""",
    "mode_per_group_ties": """
        select year, o_custkey, n from (
          select year(o_orderdate)::int as year, o_custkey, count(*) as n,
                 rank() over (partition by year(o_orderdate) order by count(*) desc) as r
          from orders group by year(o_orderdate), o_custkey)
        where r = 1""",
    "topk_per_group": """
        select year, o_custkey, n, r::int as rank from (
          select year(o_orderdate)::int as year, o_custkey, count(*) as n,
                 row_number() over (partition by year(o_orderdate) order by count(*) desc, o_custkey) as r
          from orders group by year(o_orderdate), o_custkey)
        where r <= 5""",
    "union_all": """
        select o_orderkey, o_custkey, o_orderpriority from orders where o_orderstatus = 'F'
        union all by name select o_custkey, o_orderkey from orders where o_orderstatus <> 'F'""",
    "multi_file_scan": """
        select o_orderkey, o_custkey, o_totalprice, o_orderpriority,
               (2000 + year(o_orderdate) % 100)::int as year,
               case when o_orderstatus = 'F' then 'F' else 'M' end as gender
        from orders""",
    "inferred_types": r"""
        with texts as (
          select 'orders_' || lpad((y % 100)::varchar, 2, '0') as snapshot, unnest([
              {'c': 'key', 'v': (case when y = 1995 then o_orderkey * 1000000000 else o_orderkey end)::varchar},
              {'c': 'customer', 'v': case when y = 1996 then 'x' else '' end || o_custkey},
              {'c': 'price', 'v': case when y = 1993 then floor(o_totalprice)::bigint::varchar
                else o_totalprice::decimal(20,2)::varchar end},
              {'c': 'day', 'v': strftime(o_orderdate, '%Y-%m-%d') || case when y = 1994 then ' 10:00:00' else '' end}]) as x
          from (select *, year(o_orderdate) as y from orders)),
        cells as (select snapshot, x.c as column_name, x.v as v from texts union all select 'all', x.c, x.v from texts)
        select snapshot, column_name,
               case when bool_and(regexp_full_match(v, '[0-9]+'))
                      then case when max(try_cast(v as bigint)) < 2147483648 then 'int' else 'bigint' end
                    when bool_and(regexp_full_match(v, '[0-9]+(\.[0-9]+)?')) then 'double'
                    when bool_and(regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}')) then 'date'
                    when bool_and(regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9:]{8})?')) then 'timestamp'
                    else 'string' end as type
        from cells group by snapshot, column_name""",
    "csv_roundtrip": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
               strftime(o_orderdate, '%Y-%m-%d') as o_orderdate
        from orders""",
    "conform_schema": f"""
        with src as ({TEXTS})
        select try_cast(l_orderkey as bigint) as l_orderkey, try_cast(rating as int) as rating,
               try_cast(amount as double) as amount,
               strftime(try_cast(l_shipdate as date), '%Y-%m-%d') as l_shipdate, null::varchar as comment
        from src""",
    "conform_losses": _per_column(
        TEXTS,
        {
            c: f"""count(*) filter (where {c} <> 'NA' and try_cast({c} as {t}) is null) as lost"""
            for c, t in {"l_orderkey": "bigint", "rating": "int", "amount": "double", "l_shipdate": "date"}.items()
        },
    ),
    "safe_cast": f"""
        with src as ({TEXTS})
        select try_cast(l_orderkey as bigint) as l_orderkey, try_cast(rating as int) as rating,
               try_cast(amount as double) as amount
        from src""",
    "non_numeric_counts": _per_column(
        TEXTS,
        {
            c: f"count(*) filter (where {c} is not null and try_cast({c} as double) is null) as non_numeric"
            for c in ("l_orderkey", "rating", "amount", "l_shipdate")
        },
    ),
    "preview_top_rows": """
        select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20""",
    "schema_profile": _per_column(
        GAPPY,
        {
            c: f"""count(*) filter (where {test}) as missing, '{GAPPY_TYPES[c]}' as data_type,
                   true as nullable, {i}::int as position"""
            for i, (c, test) in enumerate(GAPPY_MISSING.items(), 1)
        },
    ),
    "date_parts": """
        select o_orderkey, strftime(try_cast(strftime(o_orderdate, '%Y-%m-%d') as date), '%Y-%m-%d') as joined,
               year(o_orderdate)::int as year
        from orders""",
    "missing_counts": _per_column(
        GAPPY, {c: f"count(*) filter (where {test}) as missing" for c, test in GAPPY_MISSING.items()}
    ),
    "missing_ratio": _per_column(
        GAPPY,
        {
            c: f"""count(*) filter (where {test}) as missing, count(*) as total,
                   round(count(*) filter (where {test}) / count(*)::double, 6) as ratio"""
            for c, test in GAPPY_MISSING.items()
        },
    ),
    "drop_sparse_columns": f"""
        with src as ({GAPPY})
        select event_id, user_id, event_type, value, value_gap, type_na, half_null from src""",
    "select_by_type": "select p_size, p_retailprice from part",
    "mean_impute": f"""
        with src as ({GAPPY}),
        means as (select avg(value_gap) as gap, avg(value_nan) filter (where not isnan(value_nan)) as nan from src)
        select event_id, {_number("coalesce(value_gap, gap)")} as value_gap,
               {_number("case when isnan(value_nan) then nan else value_nan end")} as value_nan
        from src, means""",
    "parse_rating": f"""
        with src as ({RATINGS})
        select l_orderkey, l_linenumber,
               case when regexp_matches(rating, '[+-]') then try_cast(regexp_extract(rating, '^[0-9]+') as int)
                    else try_cast(rating as int) end as rating
        from src""",
    "parse_rating_sum": f"""
        with src as ({RATINGS})
        select l_orderkey, l_linenumber,
               case when contains(rating, '+')
                    then split_part(rating, '+', 1)::int + split_part(rating, '+', 2)::int
                    when contains(rating, '-')
                    then split_part(rating, '-', 1)::int - split_part(rating, '-', 2)::int
                    else try_cast(rating as int) end as rating
        from src""",
    "encode_binary": """
        select l_orderkey, l_linenumber,
               case l_returnflag when 'R' then 1 when 'A' then 0 end::int as l_returnflag,
               case l_linestatus when 'O' then 1 when 'F' then 0 end::int as l_linestatus
        from lineitem""",
    "quantiles": f"with src as ({MEASURED}) "
    + " union all ".join(
        f"""select '{c}' as column_name, {p}::double as prob,
                   {_number(f"quantile_disc({c}, {p})::double")} as value from src"""
        for c in MEASURES
        for p in (0.25, 0.5, 0.75)
    ),
    "outlier_bounds": f"""
        with {_bounds(MEASURES)}
        select column_name, n, two_valued,
               {", ".join(f"{_number(c)} as {c}" for c in ("minimum", "q1", "q3", "maximum", "lower_bound", "upper_bound"))}
        from bounds""",
    "outlier_count": f"""
        with {_bounds(MEASURES)} select event_id, {_flags(MEASURES)} as total_outliers from src""",
    "outlier_count_ints": f"""
        with {_bounds(["is_error", "whole"])}
        select event_id, {_flags(["is_error", "whole"], False)} as total_outliers from src""",
    "outlier_filter": f"""
        with {_bounds(MEASURES)} select event_id, user_id, value from src where {_flags(MEASURES)} <= 1""",
    "outlier_distribution": f"""
        with {_bounds(MEASURES)} select {_flags(MEASURES)} as total_outliers, count(*) as n from src group by 1""",
    "histogram": """
        with ext as (select min(value) as low, max(value) as high from events),
        counts as (
          select least(floor((value - low) * 20 / (high - low)), 19)::int as bin, count(*) as n
          from events, ext group by 1),
        bins as (select unnest(range(20))::int as bin)
        select bin, round(low + bin * ((high - low) / 20), 6) as lower,
               round(low + (bin + 1) * ((high - low) / 20), 6) as upper, coalesce(n, 0) as n
        from bins left join counts using (bin), ext""",
    "correlation_matrix": _correlations(
        "select * from lineitem", ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"], 9
    ),
    "correlation_matrix_wide": _correlations(
        """select *, case when l_linenumber % 3 <> 0 then l_quantity end as quantity_gap,
                  case when l_linenumber % 4 <> 0 then l_extendedprice * l_tax end as price_gap,
                  year(l_shipdate) as ship_year, month(l_shipdate) as ship_month, day(l_shipdate) as ship_day
           from lineitem""",
        WIDE,
        8,
    ),
    "correlation_matrix_odd": """
        with src as (
          select case when l_linenumber % 2 = 0 then l_quantity end as even,
                 case when l_linenumber % 2 = 0 then 1000000.1::double else l_extendedprice end as constant_if_even,
                 case when l_linenumber <> 3 then l_discount end as gap,
                 case when l_linenumber % 2 = 0 then l_tax end as endless_in_gap
          from lineitem),
        r as (
          select 'even' as a, 'constant_if_even' as b, null::double as r
          union all select 'even', 'gap', corr(even, gap) from src
          union all select 'even', 'endless_in_gap', corr(even, endless_in_gap) from src
          union all select 'constant_if_even', 'gap', corr(constant_if_even, gap) from src
          union all select 'constant_if_even', 'endless_in_gap', null
          union all select 'gap', 'endless_in_gap', corr(gap, endless_in_gap) from src)
        select a, b, round(r, 8) + 0.0::double as r from r""",
    "decision_tree_cells": f"""
        with charges as ({CHARGES})
        select l_linenumber, l_returnflag, l_linestatus, count(*) as n, round(avg(charge), 6) as prediction
        from charges where split = 'train' group by all""",
    "hash_split": """
        select o_orderkey,
               case when ('0x' || substr(md5(concat_ws(':', o_orderkey::varchar, '66')), 1, 8))::bigint
                         / 4294967296::double < 0.8::double
                    then 'train' else 'test' end as split
        from orders""",
    "string_index": """
        with idx as (
          select event_type, (row_number() over (order by count(*) desc, event_type) - 1)::double as i
          from events group by event_type)
        select event_id, event_type, i as event_type_index from events join idx using (event_type)""",
    "string_index_table": """
        with idx as (
          select l_partkey, (row_number() over (order by count(*) desc, l_partkey) - 1)::double as i
          from lineitem group by l_partkey)
        select l_orderkey, l_linenumber, l_partkey, i as l_partkey_index from lineitem join idx using (l_partkey)""",
    "one_hot": """
        with idx as (
          select event_type, row_number() over (order by count(*) desc, event_type) - 1 as i
          from events group by event_type)
        select event_id, (i = 0)::int::double as slot_0, (i = 1)::int::double as slot_1,
               (i = 2)::int::double as slot_2, (i = 3)::int::double as slot_3
        from events join idx using (event_type)""",
    "assemble_features": """
        select l_orderkey, l_linenumber, 3::int as width, round(l_quantity, 2) + 0.0::double as x0,
               round(l_extendedprice, 2) + 0.0::double as x1, round(l_discount, 2) + 0.0::double as x2
        from lineitem""",
    "standard_scale": f"""
        with s as (select stddev_samp(l_quantity) as q, stddev_samp(l_discount) as d, stddev_samp(l_tax) as t
                   from lineitem)
        select l_orderkey, l_linenumber, {_number("l_quantity / q")} as x0, {_number("l_discount / d")} as x1,
               {_number("l_tax / t")} as x2
        from lineitem, s""",
    "feature_pipeline": f"""
        with {FEATURES},
        sd as (select stddev_samp(l_quantity) as q, stddev_samp(price) as p, stddev_samp(l_discount) as d,
                      stddev_samp(l_tax) as t, stddev_samp(f0) as a, stddev_samp(f1) as b, stddev_samp(s0) as c
               from rows where split = 'train')
        select l_orderkey, l_linenumber, split, round(charge, 4) + 0.0::double as target,
               round(l_quantity / q, 5) + 0.0::double as x0, round(price / p, 5) + 0.0::double as x1,
               round(l_discount / d, 5) + 0.0::double as x2, round(l_tax / t, 5) + 0.0::double as x3,
               round(f0 / a, 5) + 0.0::double as x4, round(f1 / b, 5) + 0.0::double as x5,
               round(s0 / c, 5) + 0.0::double as x6
        from rows, sd""",
    "linear_regression_wide": f"""
        with {_residuals()}
        select split, count(*) as n, round(avg(y * y), 6) as mse, round(sqrt(avg(y * y)), 6) as rmse,
               round(avg(abs(y)), 6) as mae, round(1 - sum(y * y) / (var_pop(target) * count(*)), 6) as r2
        from r7 group by split""",
    "linear_regression": f"""
        with {FIT}
        select (select count(*) from charges where split = 'train') as n, round(b, 8) + 0.0::double as slope,
               round(a, 6) + 0.0::double as intercept
        from fit""",
    "mlp_linear": f"""
        with {FIT}
        select (select count(*) from charges where split = 'train') as n, round(b, 2) + 0.0::double as slope,
               round(a, 1) + 0.0::double as intercept
        from fit""",
    "mlp_history": """
        select epoch::int as epoch, round(3e-3::double * power(0.99::double, epoch), 9) + 0.0::double as learning_rate,
               1::bigint as steps, count(*) > 0 as has_loss
        from lineitem, (select unnest(range(100)) as epoch) group by epoch""",
    "score_predictions": f"""
        with {FIT}
        select l_orderkey, l_linenumber, split, round(target, 3) + 0.0::double as target,
               round(prediction, 3) + 0.0::double as prediction
        from scored""",
    "regression_metrics": f"""
        with {FIT}
        select split, count(*) as n, round(avg(power(target - prediction, 2)), 6) as mse,
               round(sqrt(avg(power(target - prediction, 2))), 6) as rmse,
               round(avg(abs(target - prediction)), 6) as mae,
               round(1 - sum(power(target - prediction, 2)) / (var_pop(target) * count(*)), 6) as r2
        from scored group by split""",
    "model_roundtrip": f"""
        with {FIT}
        select l_orderkey, l_linenumber, round(prediction, 3) + 0.0::double as prediction from scored""",
}

_CONTRACTS = """
    with qualified as (
      select l_partkey, l_linenumber, l_suppkey, l_shipdate from lineitem
      where l_shipdate < timestamp '1998-01-01' and l_quantity >= 10),
    entities as (
      select l_suppkey, row_number() over (partition by l_partkey, l_linenumber
                                           order by l_shipdate desc, l_suppkey) as rn
      from qualified),
    counts as (select l_suppkey, count(*) as n from entities where rn = 1 group by 1)
"""
SQL["contract_top_groups"] = _CONTRACTS + "select l_suppkey, n from counts order by n desc, l_suppkey limit 5"
SQL["contract_top_groups_ties"] = _CONTRACTS + """
    select l_suppkey, n from (select *, rank() over (order by n desc) as r from counts) where r <= 5"""

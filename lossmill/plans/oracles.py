"""The registered queries once more, as SQL over the star schema."""

from __future__ import annotations


def _text(value: str) -> str:
    rounded = f"round(cast({value} as decimal(28,8)), 4)"
    return f"replace(cast(cast({rounded} as decimal(28,4)) as varchar), '.', ',')"


def _number(text: str) -> str:
    return f"try_cast(replace({text}, ',', '.') as double)"


def _snap(value: str, digits: int) -> str:
    """Rounding of the digits that a double is written with."""
    spelled = f"cast(cast(cast({value} as double) as varchar) as decimal(38,12))"
    return f"cast(round({spelled}, {digits}) as double)"


def _ratio(claims: str, premium: str, digits: int = 4) -> str:
    return f"case when {premium} > 0 then {_snap(f'{claims} / {premium}', digits)} end"


def _sum(column: str) -> str:
    """Exact: doubles as the decimals they spell, so that the order of rows does not matter."""
    return f"cast(sum(cast(cast({column} as varchar) as decimal(30,12))) as double)"


_SUM = {c: _sum(c) for c in ("premium", "claim_amount", "exposure", "avg_insured")}
_TOTALS = ", ".join(
    f"{_snap(_SUM[c], 2)} as total_{c}" for c in ("premium", "claim_amount", "exposure")
)
_RATIO_OF_SUMS = _ratio(_SUM["claim_amount"], _SUM["premium"])

_TIER = """case when loss_ratio > 1.0 then 'HIGH' when loss_ratio > 0.7 then 'WATCH'
    else 'HEALTHY' end"""

_FRAMES = f"""
with order_segments as (
    select o_orderkey, o_totalprice, c_nationkey as nation, c_mktsegment as coverage,
        concat(cast(year(o_orderdate) as varchar),
            case when month(o_orderdate) <= 6 then 'S1' else 'S2' end) as period
    from orders join customer on o_custkey = c_custkey
),
premium_totals as (
    select period, nation, coverage, count(*) as n,
        cast(sum(cast(o_totalprice as decimal(15,2))) as double) as total
    from order_segments group by period, nation, coverage
),
raw_premium as (
    select lpad(cast(nation as varchar), 2, '0') as region_code,
        n_name as region_name, coverage, {_text('n')} as exposure,
        {_text('total')} as premium, {_text('total / n')} as avg_insured, period
    from premium_totals left join nation on nation = n_nationkey
    union all
    select a.*, period from (values
        (null, 'ADDED REGION', 'F_NULL', '1,0000', '10,0000', '10,0000'),
        ('90', 'ADDED REGION', 'F_DIGITS', '1,0000', 'n/d', '10,0000'),
        ('90', 'ADDED REGION', 'F_ZERO', '1,0000', '0,0000', '10,0000'),
        ('90', 'ADDED REGION', 'F_NEGATIVE', '1,0000', '10,0000', '10,0000'),
        ('90', 'ADDED REGION', 'F_ALONE', '2,0000', '1000,5000', '500,2500'),
        ('90', 'ADDED REGION', 'F_TEXT', '1,0000', '10,0000', '10,0000'),
        ('90', 'ADDED REGION', 'F_TWICE', '4,0000', '250,0000', '62,5000'),
        ('99', 'NOT LISTED', 'F_UNLISTED', '1,0000', '10,0000', '10,0000')) a,
        (select distinct period from order_segments)
),
claim_totals as (
    select period, nation, coverage, count(*) as n,
        cast(sum(cast(l_extendedprice as decimal(15,2)) * (1 - cast(l_discount as decimal(15,2))))
            as double) as total
    from lineitem join order_segments on l_orderkey = o_orderkey
    group by period, nation, coverage
),
raw_claim as (
    select lpad(cast(nation as varchar), 2, '0') as region_code, n_name as region_name, coverage,
        cast(n as varchar) as claim_count, {_text('total')} as claim_amount, period
    from claim_totals left join nation on nation = n_nationkey
    union all
    select a.*, period from (values
        ('90', 'ADDED REGION', 'F_ZERO', '1', '5,0000'),
        ('90', 'ADDED REGION', 'F_NEGATIVE', '1', '-5,0000'),
        ('90', 'ADDED REGION', 'F_TEXT', 'x', 'n/d'),
        ('90', 'ADDED REGION', 'F_TWICE', '1', '100,0000'),
        ('90', 'ADDED REGION', 'F_TWICE', '2', '400,2500'),
        ('90', 'ADDED REGION', 'F_ORPHAN', '1', '7,0000'),
        ('99', 'NOT LISTED', 'F_UNLISTED', '1', '3,0000')) a,
        (select distinct period from order_segments)
),
region_dim as (
    select lpad(cast(n_nationkey as varchar), 2, '0') as dim_code, n_name as region_name
    from nation
    union all select '90', 'ADDED REGION'
),
typed_premium as (
    select region_code, region_name as premium_region_name, coverage,
        {_number('exposure')} as exposure, {_number('premium')} as premium,
        {_number('avg_insured')} as avg_insured, period
    from raw_premium
),
typed_claim as (
    select region_code as claim_region_code, coverage as claim_coverage,
        try_cast(claim_count as bigint) as claim_count,
        {_number('claim_amount')} as claim_amount, period as claim_period
    from raw_claim
),
filled as (
    select p.*, coalesce(claim_count, 0) as claim_count,
        coalesce(claim_amount, 0.0) as claim_amount
    from typed_premium p left join typed_claim on period = claim_period
        and region_code = claim_region_code and coverage = claim_coverage
),
joined as (
    select *, {_ratio('claim_amount', 'premium')} as loss_ratio from filled
),
named as (
    select joined.*, region_name from joined left join region_dim on region_code = dim_code
),
tagged as (
    select *,
        case when region_code is null then 'region_null'
            when premium is null then 'premium_null'
            when premium <= 0 then 'premium_not_positive'
            when claim_amount < 0 then 'claim_negative'
            when region_name is null then 'region_unknown' end as failure_reason,
        coalesce(loss_ratio > 2.0, false) as high_ratio_alert
    from named
),
clean as (
    select * exclude (failure_reason) from tagged where failure_reason is null
),
by_region as (
    select *, {_TIER} as risk_tier from (
        select region_code, region_name, period,
            {_TOTALS},
            {_RATIO_OF_SUMS} as loss_ratio,
            count(coverage) as coverage_rows
        from clean group by region_code, region_name, period
    )
),
alerts as (
    select region_code, region_name, coverage, premium, claim_amount, loss_ratio, exposure, period,
        {_snap('claim_amount - premium', 2)} as loss_amount
    from clean where loss_ratio > 1.0
)
"""


def _layer_counts(**layers: str) -> str:
    return " union all ".join(
        f"select '{name}' as layer, period, count(*) as row_count from {source} group by period"
        for name, source in layers.items()
    )


def _profile(*columns: str) -> str:
    def shown(value: str, column: str) -> str:
        if column == "premium":
            return f"cast(cast({value} as decimal(28,4)) as varchar)"
        return f"cast({value} as varchar)"

    return " union all ".join(
        f"""select '{c}' as column_name, count(*) as row_count, count(*) - count({c}) as null_count,
            {shown(f'min({c})', c)} as min_value, {shown(f'max({c})', c)} as max_value,
            {_snap(f'(count(*) - count({c})) / count(*)', 4)} as null_rate from tagged"""
        for c in columns
    )


# Lines of MACHINERY lack their last field, those of BUILDING have one more.
_BROKEN = "coverage in ('MACHINERY', 'BUILDING')"


def _line(*fields: str) -> str:
    given = " || ';' || ".join(f"coalesce({f}, '')" for f in fields[:-1])
    return f"""{given} || case when coverage = 'MACHINERY' then ''
        else ';' || coalesce({fields[-1]}, '') || ';x' end"""


_LINES = {
    "premium": _line("region_code", "region_name", "coverage", "exposure", "premium", "avg_insured"),
    "claim": _line("region_code", "region_name", "coverage", "claim_count", "claim_amount"),
}

_CORRECTED = """select * from raw_premium
    where not (period = '1997S1' and coverage = 'MACHINERY')"""

_BODIES = {
    "src_locale_csv": "select * from raw_premium",
    "src_region_dim": "select * from region_dim",
    "src_period_scan": "select * from typed_premium where period in ('1996S1', '1998S2')",
    "src_period_counts": """
        select source, period, count(row_of) as row_count
        from (values ('premium'), ('claim')) s(source),
            (select distinct period from order_segments union all select '1900S1') p
            left join (select 'premium' as row_of, period as of_period from raw_premium
                union all select 'claim', period from raw_claim)
                on period = of_period and source = row_of
        group by source, period""",
    "sink_roundtrip": "select * from typed_premium",
    "sink_replace_partition": _CORRECTED,
    "ledger_last_n": f"""
        select table_name, period, 'replace' as operation, row_count, version from (
            select 1 as run, 'premium' as table_name, period, count(*) as row_count,
                cast(1 as bigint) as version
            from raw_premium group by period
            union all
            select 2, 'premium', period, count(*), 2 from ({_CORRECTED})
            where period = '1997S1' group by period
            union all
            select 3, 'claim', period, count(*), 1 from raw_claim group by period
        ) order by run desc, table_name, period desc limit 5""",
    "bronze_malformed_lines": f"""
        select 'premium' as source, period, region_code, coverage,
            {_LINES['premium']} as corrupt_line from raw_premium where {_BROKEN}
        union all
        select 'claim', period, region_code, coverage, {_LINES['claim']}
        from raw_claim where {_BROKEN}""",
    "recon_malformed_lines": f"""
        select * from (with premium_lines as (select * from raw_premium where {_BROKEN}),
        claim_lines as (select * from raw_claim where {_BROKEN}),
        silver as (select * from tagged where not ({_BROKEN}))
        select layer, coverage, count(*) as row_count from (
            select 'bronze_premium' as layer, coverage from raw_premium where not ({_BROKEN})
            union all
            select 'bronze_claim', coverage from raw_claim where not ({_BROKEN})
            union all select 'bronze_premium_lines', coverage from premium_lines
            union all select 'bronze_claim_lines', coverage from claim_lines
            union all select 'silver_clean', coverage from silver where failure_reason is null
            union all
            select 'silver_quarantine', coverage from silver where failure_reason is not null
        ) group by layer, coverage)""",
    "recon_layer_counts": _layer_counts(
        source_premium="raw_premium",
        source_claim="raw_claim",
        bronze_premium="raw_premium",
        bronze_claim="raw_claim",
        silver_clean="clean",
        silver_quarantine="(select * from tagged where failure_reason is not null)",
    ),
    "bronze_stamp": "select *, '2020' as ingest_year, period as file_period from raw_claim",
    "cast_comma_decimal": f"""select period, region_code, coverage, premium,
        {_number('premium')} as premium_value from raw_premium""",
    "cast_long": """select period, region_code, coverage,
        try_cast(claim_count as bigint) as claim_count,
        try_cast(coverage as bigint) as no_number from raw_claim""",
    "cast_bulk": f"""select region_code, region_name, coverage,
        try_cast(claim_count as bigint) as claim_count,
        {_number('claim_amount')} as claim_amount, period from raw_claim""",
    "silver_typed_premium": "select * from typed_premium",
    "silver_typed_claim": "select * from typed_claim",
    "silver_null_fill": """select period, region_code, coverage, claim_count, claim_amount
        from filled""",
    "silver_loss_ratio": """select period, region_code, coverage, premium, claim_amount, loss_ratio
        from joined""",
    "ratio_fn_decimals": "select period, region_code, coverage, "
    + ", ".join(f"{_ratio('claim_amount', 'premium', n)} as ratio_{n}" for n in (0, 2, 6))
    + " from joined",
    "risk_tier": f"""select period, region_code, coverage, loss_ratio, {_TIER} as risk_tier
        from clean""",
    "silver_join": "select * from joined",
    "silver_join_hot": f"""
        select *, {_ratio('claim_amount', 'premium')} as loss_ratio from (
            select p.*, coalesce(c.claim_count, 0) as claim_count,
                coalesce(c.claim_amount, 0.0) as claim_amount
            from typed_premium p left join (
                select claim_count, claim_amount,
                    case when claim_count % 3 = 0 then '1996S1' else claim_period end as period,
                    case when claim_count % 3 = 0 then '01' else claim_region_code end as code,
                    case when claim_count % 3 = 0 then 'BUILDING' else claim_coverage end as kind
                from typed_claim) c
                on p.period = c.period and region_code = code and coverage = kind)""",
    "silver_enrich": "select * from named",
    "dq_unknown_region": """select period, region_code, coverage, premium from typed_premium
        where region_code is not null and region_code not in (select dim_code from region_dim)""",
    "dq_tag": """select period, region_code, coverage, premium, claim_amount, failure_reason
        from tagged""",
    "dq_clean": "select * from clean",
    "dq_quarantine": "select * from tagged where failure_reason is not null",
    "dq_alert_flag": """select period, region_code, coverage, loss_ratio, high_ratio_alert
        from tagged""",
    "dq_alert_threshold": """select period, region_code, coverage, loss_ratio,
            coalesce(loss_ratio > 1.5, false) as high_ratio_alert
        from tagged""",
    "dq_claim_malformed": """
        select f.period, f.region_code, f.coverage, f.claim_amount,
            'claim_malformed' as failure_reason
        from filled f join raw_claim c on f.period = c.period and f.region_code = c.region_code
            and f.coverage = c.coverage
        where try_cast(replace(c.claim_amount, ',', '.') as double) is null""",
    "dq_claim_repeated": """
        select period, region_code, coverage, claim_amount, 'claim_repeated' as failure_reason
        from filled join (select period, region_code, coverage from raw_claim
            group by period, region_code, coverage having count(*) > 1)
            using (period, region_code, coverage)""",
    "dq_period_null": """
        select if(coverage = 'FURNITURE', null, period) as period, region_code, coverage, premium,
            if(coverage = 'FURNITURE', 0.0, claim_amount) as claim_amount,
            if(coverage = 'FURNITURE', 'period_null', failure_reason) as failure_reason
        from tagged where coverage = 'FURNITURE' or failure_reason is not null""",
    "dq_report": f"""select count(*) as total_rows,
        count(*) - count(failure_reason) as clean_rows, count(failure_reason) as quarantined_rows,
        coalesce({_snap('(count(*) - count(failure_reason)) * 100.0 / nullif(count(*), 0)', 1)},
            0.0) as pass_rate_pct
        from tagged""",
    "dq_breakdown": """select failure_reason, count(*) as row_count from tagged
        where failure_reason is not null group by failure_reason""",
    "gold_by_region": "select * from by_region",
    "gold_by_coverage": f"""select coverage, period,
            {_TOTALS},
            {_RATIO_OF_SUMS} as loss_ratio,
            count(region_code) as region_rows,
            {_snap(f"{_SUM['avg_insured']} / count(avg_insured)", 2)} as mean_avg_insured
        from clean group by coverage, period""",
    "gold_alerts": "select * from alerts",
    "gold_summary": f"""select period,
            {_TOTALS},
            {_RATIO_OF_SUMS} as portfolio_loss_ratio,
            count(region_code) as segments,
            cast(sum(case when loss_ratio > 1.0 then 1 else 0 end) as bigint)
                as loss_making_segments,
            {_snap('max(loss_ratio)', 4)} as max_loss_ratio,
            {_snap('min(loss_ratio)', 4)} as min_loss_ratio
        from clean group by period""",
    "silver_processed": """select period, region_code, coverage, loss_ratio,
            cast(epoch(timestamp '2021-03-04 05:06:07') as bigint) as processed_second
        from clean""",
    "gold_parameters": """
        select period, loss_making_segments, high, watch, healthy, alerted_rows from (
            select period, count(*) filter (where loss_ratio > 0.8) as loss_making_segments,
                count(*) filter (where loss_ratio > 0.9) as alerted_rows
            from clean group by period)
        join (
            select period, count(*) filter (where loss_ratio > 0.8) as high,
                count(*) filter (where loss_ratio > 0.6 and loss_ratio <= 0.8) as watch,
                count(*) filter (where loss_ratio is null or loss_ratio <= 0.6) as healthy
            from by_region group by period) using (period)
        where period in ('1996S1', '1998S2')""",
    "gold_rollup": f"""
        select case when grouping(region_code) = 0 then 'by_region'
                when grouping(coverage) = 0 then 'by_coverage' else 'summary' end as grain,
            region_code, region_name, coverage, period, {_TOTALS}, {_RATIO_OF_SUMS} as loss_ratio
        from clean group by grouping sets
            ((region_code, region_name, period), (coverage, period), (period))""",
    "distinct_regions": "select distinct region_code, region_name from raw_premium",
    "distinct_coverages": "select distinct coverage from clean",
    "count_distinct_regions": "select count(distinct region_code) as regions from clean",
    "top_regions": """select * from by_region
        order by loss_ratio desc nulls last, region_code, period limit 10""",
    "top_segments": """select period, region_code, coverage, region_name, premium, claim_amount,
            loss_ratio, high_ratio_alert
        from clean order by loss_ratio desc nulls last, period, region_code, coverage limit 10""",
    "top_alerts": """select period, region_code, coverage, region_name, loss_ratio, loss_amount
        from alerts order by loss_ratio desc nulls last, period, region_code, coverage limit 20""",
    "freq_premium_coverage": """select coverage, count(*) as row_count from raw_premium
        group by coverage""",
    "freq_claim_coverage": """select coverage, count(*) as row_count from raw_claim
        group by coverage""",
    "freq_risk_tier": """select risk_tier, count(*) as row_count from by_region
        group by risk_tier""",
    "trend_by_region": f"""
        select *, {_snap('loss_ratio - previous_ratio', 4)} as ratio_change from (
            select region_code, region_name, period, loss_ratio,
                lag(period) over (partition by region_code order by period) as previous_period,
                lag(loss_ratio) over (partition by region_code order by period) as previous_ratio
            from by_region)""",
    "calendar_trend": f"""
        select * from (with kept as (select * from by_region where period <> '1995S2'),
        numbers as (
            select range as number from range(
                (select min(cast(period[1:4] as integer) * 2 + cast(period[6:6] as integer) - 1)
                    from kept),
                (select max(cast(period[1:4] as integer) * 2 + cast(period[6:6] as integer))
                    from kept))
        ), spine as (
            select region_code, region_name,
                cast(number // 2 as varchar) || 'S' || cast(number % 2 + 1 as varchar) as period
            from (select distinct region_code, region_name from kept), numbers
        )
        select *, {_snap('loss_ratio - previous_ratio', 4)} as ratio_change from (
            select s.region_code, s.region_name, s.period, k.period is not null as reported,
                loss_ratio,
                lag(loss_ratio) over (partition by s.region_code order by s.period)
                    as previous_ratio,
                lag(loss_ratio, 2) over (partition by s.region_code order by s.period)
                    as year_before_ratio
            from spine s left join kept k using (region_code, period)))""",
    "sketched_distinct": " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) as n_distinct, true as within_bound from clean"
        for c in ("region_code", "coverage", "premium", "claim_count")
    ),
    "distinct_to_date": """
        select * from (with segments as (select claim_period as period,
            concat_ws('|', claim_region_code, claim_coverage, claim_count) as segment
            from typed_claim)
        select p.period as to_period, count(distinct segment) as n_distinct
        from (select distinct period from segments) p join segments s on s.period <= p.period
        group by p.period)""",
    "exposure_weighted_ratio": f"""select region_code, region_name, period,
            {_snap(_sum('loss_ratio * exposure') + ' / '
                + _sum('case when loss_ratio is not null then exposure end'), 4)} as weighted_ratio
        from clean group by region_code, region_name, period""",
    "column_profile": _profile(
        "region_code", "coverage", "period", "premium", "claim_count", "failure_reason"
    ),
    "orphan_claims": """select * from typed_claim where not exists (
        select 1 from typed_premium where period = claim_period
            and region_code = claim_region_code and coverage = claim_coverage)""",
}

ORACLES: dict[str, str] = {name: _FRAMES + body for name, body in _BODIES.items()}

"""The same blotter as SQL, for checking results against another engine.

Each entry is (names it builds on, query text).
"""

from __future__ import annotations

from ledgerlake.plans.blotter import (
    AMENDMENT_DATE,
    FIRST_BATCH,
    LOAD_DATE,
    SECOND_BATCH,
)

_TIES = "trade_date {0}, security_id {0}, trader_id {0}, trade_type {0}, quantity {0}, price {0}"
_NEWEST = "last_modified_ts desc, " + _TIES.format("desc")
_OLDEST = "last_modified_ts, " + _TIES.format("")
_VALUE = "cast(round(quantity * price, 2) as decimal(18,2))"

_SUPPLIERS = """
    supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "bronze_trades": (
        (),
        """
        select cast(l_orderkey * 10 + l_linenumber as bigint) as trade_id,
               cast(o_orderdate as date) as trade_date,
               l_partkey as security_id, l_suppkey as trader_id,
               case when l_linestatus = 'F' then 'BUY' else 'SELL' end as trade_type,
               cast(case when l_returnflag = 'R' and l_discount >= 0.095
                         then -l_quantity else l_quantity end as decimal(18,2)) as quantity,
               cast(case when l_returnflag = 'A' and l_tax >= 0.075 and l_discount < 0.005
                         then 0 else p_retailprice end as decimal(18,4)) as price,
               l_shipdate as last_modified_ts
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
        """,
    ),
    "newest_trades": (
        ("bronze_trades",),
        f"""
        select * from (select *, row_number() over (partition by trade_id order by {_NEWEST}) as rn
                       from bronze_trades) as ranked
        where rn = 1
        """,
    ),
    "silver_trades": (
        ("newest_trades",),
        f"""
        select trade_id, trade_date, security_id, trader_id, trade_type, quantity, price,
               {_VALUE} as trade_value
        from newest_trades where quantity > 0 and price > 0
        """,
    ),
    "gold_daily": (
        ("silver_trades",),
        """
        select trade_date, trader_id, trade_type,
               sum(trade_value) as total_trade_value, count(*) as trade_count
        from silver_trades group by trade_date, trader_id, trade_type
        """,
    ),
    "dim_security": (
        (),
        """
        select p_partkey as security_id, 'P' || p_partkey as ticker, p_name as security_name,
               p_type as asset_class, p_brand as sector
        from part
        """,
    ),
    "dim_trader": (
        (),
        f"""
        select s_suppkey as trader_id, s_name as trader_name, n_name as desk, r_name as region
        from {_SUPPLIERS}
        """,
    ),
    "logins": (
        (),
        """
        select s_suppkey as trader_id, 'user' || s_suppkey || '@example.com' as login_name
        from supplier
        """,
    ),
    "trader_states": (
        (),
        f"""
        select s_suppkey as trader_id, s_name as trader_name,
               case when s_acctbal >= 1000 and s_acctbal < 1200 then null else n_name end as desk,
               r_name as region, date '{LOAD_DATE}' as snapshot_date
        from {_SUPPLIERS} where s_acctbal < 4000 or s_acctbal >= 5500
        union all
        select s_suppkey, s_name, case when s_acctbal < 0 then 'WORKOUT' else n_name end,
               case when s_acctbal >= 9000 then 'GLOBAL' else r_name end, date '{FIRST_BATCH}'
        from {_SUPPLIERS}
        where (s_acctbal < 5000 or s_acctbal >= 5500) and (s_acctbal < 7000 or s_acctbal >= 7200)
        union all
        select s_suppkey, s_name, case when s_acctbal < -500 then 'WORKOUT' else n_name end,
               case when s_acctbal >= 8000 then 'GLOBAL' else r_name end, date '{SECOND_BATCH}'
        from {_SUPPLIERS}
        """,
    ),
    "trader_history": (
        ("trader_states",),
        """
        select trader_id, trader_name, desk, region, snapshot_date as valid_from,
               coalesce(lead(snapshot_date) over (partition by trader_id order by snapshot_date)
                        - 1, date '9999-12-31') as valid_to,
               lead(snapshot_date) over (partition by trader_id order by snapshot_date) is null
                   as is_current
        from (select *, lag(snapshot_date) over w as was, lag(desk) over w as old_desk,
                     lag(region) over w as old_region
              from trader_states window w as (partition by trader_id order by snapshot_date)) as s
        where was is null or desk is distinct from old_desk or region is distinct from old_region
        """,
    ),
    "trader_history_1": (
        ("trader_states",),
        f"""
        select trader_id, trader_name, desk, region, snapshot_date as valid_from,
               coalesce(lead(snapshot_date) over (partition by trader_id order by snapshot_date)
                        - 1, date '9999-12-31') as valid_to,
               lead(snapshot_date) over (partition by trader_id order by snapshot_date) is null
                   as is_current
        from (select *, lag(snapshot_date) over w as was, lag(desk) over w as old_desk,
                     lag(region) over w as old_region
              from trader_states where snapshot_date <= date '{FIRST_BATCH}'
              window w as (partition by trader_id order by snapshot_date)) as s
        where was is null or desk is distinct from old_desk or region is distinct from old_region
        """,
    ),
    "first_book": (
        ("bronze_trades",),
        f"""
        select trade_id, trade_date, security_id, trader_id, trade_type, quantity, price,
               {_VALUE} as trade_value
        from (select *, row_number() over (partition by trade_id order by {_OLDEST}) as rn
              from bronze_trades) as ranked
        where rn = 1 and quantity > 0 and price > 0
        """,
    ),
    "amendments": (
        ("bronze_trades", "silver_trades"),
        f"""
        select *, 'correction after confirmation' as amendment_reason,
               date '{AMENDMENT_DATE}' as amendment_date
        from silver_trades
        where trade_id in (select trade_id from bronze_trades group by trade_id
                           having count(*) > 1)
        """,
    ),
    "user_days": (
        (),
        """
        select user_id, event_type as state, cast(ts as date) as day
        from (select *, row_number() over (partition by user_id, cast(ts as date)
                                           order by ts desc, event_id desc) as rn
              from events) as ranked
        where rn = 1
        """,
    ),
    "user_history": (
        ("user_days",),
        """
        select user_id, state, day as valid_from,
               coalesce(lead(day) over (partition by user_id order by day) - 1,
                        date '9999-12-31') as valid_to
        from (select *, lag(state) over (partition by user_id order by day) as old_state
              from user_days) as s
        where old_state is null or state <> old_state
        """,
    ),
}


def with_views(names: tuple[str, ...], text: str) -> str:
    """Put the views a query builds on in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for base in VIEWS[name][0]:
            add(base)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return text
    parts = ",\n".join(f"{n} as ({VIEWS[n][1]})" for n in order)
    return f"with {parts}\n{text}"

"""The same queries as SQL for DuckDB, written independently of the Spark plans.

Where there is a choice these take the other road: ASOF joins for the point-in-time lookup,
`arg_max` for the latest row, NOT IN and EXISTS for the set tests.
"""

from __future__ import annotations

ORDER_DAY = "cast(o_orderdate as date)"
SHIP_DAY = "cast(l_shipdate as date)"
BILL_DAY = f"({ORDER_DAY} + cast(o_custkey % 7 + 1 as integer))"
POSITION = "lpad(cast(l_linenumber * 10 as varchar), 6, '0')"
# One order number in seven is one that no order has.
BROKEN_ORDER = "if(l_suppkey % 7 = 0, -l_orderkey, l_orderkey)"
CURRENCY = "if(o_custkey % 2 = 0, 'USD', 'CAD')"


def _pad(expr: str, width: int) -> str:
    return f"lpad(cast({expr} as varchar), {width}, '0')"


def _ymd(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')"


def _money(expr: str) -> str:
    return f"cast(cast({expr} as decimal(18,2)) as varchar)"


def _lineage(table: str, day: str, micros: str) -> str:
    return (
        f"cast({day} as timestamp) + to_microseconds({micros}) as _loaded_at, "
        f"'{table}_' || {_ymd(day)} || '.csv' as _source_file"
    )


def _item_lineage(table: str) -> str:
    return (
        f"cast({SHIP_DAY} as timestamp) as _loaded_at, '{table}_' || {_ymd(SHIP_DAY)} || '_' || "
        f"{_pad('l_partkey', 12)} || '_' || {_pad('l_suppkey', 12)} || '.csv' as _source_file"
    )


def _receivable(amount: str) -> str:
    return f"""'1000' as BUKRS, {_pad("o_orderkey + 1900000000", 10)} as BELNR,
        cast(year({BILL_DAY}) as varchar) as GJAHR, '001' as BUZEI, {_pad("o_custkey", 10)} as KUNNR,
        'RV' as BLART, {_ymd(BILL_DAY)} as BUDAT, {_ymd(f"{BILL_DAY} + 30")} as FAEDT,
        'NT30' as ZTERM, {_money(amount)} as WRBTR, {CURRENCY} as WAERS,
        {_pad("o_orderkey + 90000000", 10)} as ZUONR"""


RAW = {
    "KNA1": f"""select {_pad("o_custkey", 10)} as KUNNR,
        if(o_custkey % 97 = 0, 'Brook, Hale and "Sons"', 'Customer ' || o_custkey) as NAME1,
        ' ' || o_orderpriority || ' ' as ORT01, if(o_orderstatus = 'P', '  ', o_orderstatus) as REGIO,
        if(o_custkey % 2 = 0, 'US', 'CA') as LAND1, {_ymd(ORDER_DAY)} as ERDAT,
        {_lineage("KNA1", ORDER_DAY, "o_orderkey")} from orders""",
    "MARA": f"""select {_pad("p_partkey", 18)} as MATNR, p_type as MTART,
        p_brand || if(v > 0, cast(v as varchar), '') as MATKL, 'EA' as MEINS,
        '2026' || {_pad("p_partkey % 12 + 1", 2)} || '01' as ERSDA,
        if(v = 0, '00000000', '2027' || {_pad("v", 2)} || '15') as LAEDA,
        {_lineage("MARA", "(date '2026-01-09' - v)", "0")}
        from (select *, cast(unnest(range(0, p_size % 3 + 1)) as integer) as v from part)""",
    "MAKT": f"""select {_pad("p_partkey", 18)} as MATNR, SPRAS,
        if(SPRAS = 'D', upper(p_name), p_name) || ' ' || v as MAKTX,
        timestamp '2026-01-09' as _loaded_at,
        'MAKT_' || {_ymd("date '2026-01-01' + v")} || '.csv' as _source_file
        from (select *, cast(unnest([0, 1]) as integer) as v from part)
        join (values ('E'), ('D')) languages(SPRAS) on SPRAS = 'D' or p_partkey % 10 <> 0""",
    "VBAK": f"""select {_pad("o_orderkey", 10)} as VBELN, 'OR' as AUART, {_ymd(ORDER_DAY)} as ERDAT,
        {_ymd(ORDER_DAY)} as AUDAT, {_pad("o_custkey", 10)} as KUNNR, {CURRENCY} as WAERK,
        if(o_orderkey % 101 = 0, 'abc', {_money("cast(o_totalprice as decimal(18,2)) + v")}) as NETWR,
        if(v = 0, '00000000', {_ymd(f"{ORDER_DAY} + v")}) as AEDAT,
        {_lineage("VBAK", f"({ORDER_DAY} + v)", "o_orderkey")}
        from (select *, cast(unnest(range(0, o_orderkey % 3 + 1)) as integer) as v from orders)""",
    "VBAP": f"""select {_pad("l_orderkey", 10)} as VBELN, {POSITION} as POSNR,
        {_pad("l_partkey", 18)} as MATNR, cast(cast(l_quantity as integer) as varchar) as KWMENG,
        'EA' as VRKME, {_money("l_extendedprice")} as NETWR,
        case when l_orderkey % 50 = 0 then 'EUR' when l_orderkey % 2 = 0 then 'USD' else 'CAD' end as WAERK,
        if(l_returnflag = 'R', '02', '') as ABGRU, {_ymd(f"{SHIP_DAY} - 5")} as ERDAT,
        {_ymd(SHIP_DAY)} as AEDAT, {_item_lineage("VBAP")} from lineitem""",
    "VBRK": f"""select {_pad("o_orderkey + 90000000", 10)} as VBELN, 'F2' as FKART,
        {_ymd(BILL_DAY)} as FKDAT, {_pad("o_custkey", 10)} as KUNRG, {CURRENCY} as WAERK,
        {_money("o_totalprice")} as NETWR, if(v = 1, 'X', '') as FKSTO, {_ymd(BILL_DAY)} as ERDAT,
        if(v = 0, '00000000', {_ymd(f"{BILL_DAY} + v * 3")}) as AEDAT,
        {_lineage("VBRK", f"({BILL_DAY} + v * 3)", "o_orderkey")}
        from (select *, cast(unnest(if(o_orderstatus = 'P', [0, 1], [0])) as integer) as v from orders)""",
    "VBRP": f"""select {_pad("l_orderkey + 90000000", 10)} as VBELN, {POSITION} as POSNR,
        case l_suppkey % 40 when 0 then 'X' || {_pad("l_orderkey", 9)} when 1 then ''
             else {_pad("l_orderkey", 10)} end as AUBEL,
        if(l_suppkey % 40 = 2, '000099', {POSITION}) as AUPOS, {_pad("l_partkey", 18)} as MATNR,
        cast(cast(l_quantity as integer) + if(l_partkey % 50 = 0, 100, 0) as varchar) as FKIMG,
        'EA' as VRKME, {_money("l_extendedprice")} as NETWR, {_ymd(SHIP_DAY)} as ERDAT,
        '00000000' as AEDAT, {_item_lineage("VBRP")}
        from lineitem""",
    "LIKP": f"""select {_pad("o_orderkey + 70000000", 10)} as VBELN, 'LF' as LFART,
        {_ymd(ORDER_DAY)} as ERDAT, {_ymd(f"{ORDER_DAY} + cast(o_custkey % 5 as integer)")} as LFDAT,
        {_pad("o_custkey", 10)} as KUNNR, '00000000' as AEDAT,
        {_lineage("LIKP", f"({ORDER_DAY} + cast(o_custkey % 5 as integer))", "o_orderkey")}
        from orders""",
    "LIPS": f"""select {_pad("l_orderkey + 70000000", 10)} as VBELN, {POSITION} as POSNR,
        {_pad("l_orderkey", 10)} as VGBEL, if(l_suppkey % 40 = 3, '000098', {POSITION}) as VGPOS,
        {_pad("l_partkey", 18)} as MATNR,
        cast(cast(case when l_partkey % 50 = 1 then l_quantity + 100 when l_returnflag = 'N' then 0
            else l_quantity / 2 end as decimal(18,3)) as varchar) as LFIMG, 'EA' as VRKME,
        {_ymd(SHIP_DAY)} as ERDAT, '' as AEDAT, {_item_lineage("LIPS")}
        from lineitem""",
    "BSID": f"""select {_receivable("cast(o_totalprice as decimal(18,2)) + if(o_orderkey % 200 = 7, 1, 0)")},
        {_lineage("BSID", BILL_DAY, "o_orderkey")} from orders""",
    "BSAD": f"""select {_receivable("o_totalprice")},
        {_ymd(f"{BILL_DAY} + cast(o_custkey % 40 - 1 as integer)")} as AUGDT,
        {_pad("o_orderkey + 1950000000", 10)} as AUGBL,
        {_lineage("BSAD", f"({BILL_DAY} + cast(o_custkey % 40 - 1 as integer))", "o_orderkey")}
        from orders where o_orderstatus = 'F'""",
}

CLEAN = {
    "text": "nullif(trim({0}), '')",
    "date": "cast(strptime(nullif(nullif(trim({0}), ''), '00000000'), '%Y%m%d') as date)",
    "amount": "try_cast(nullif(trim({0}), '') as decimal(18,2))",
    "quantity": "try_cast(nullif(trim({0}), '') as decimal(18,3))",
    "flag": "(trim({0}) is not distinct from 'X')",
}


# Per staging table its extract, keys, whether a change date ranks versions, and its columns
# as name, cleaner and raw column.
STAGED = {
    "stg_sap__kna1": (
        "KNA1", "customer_id", False,
        """customer_id text KUNNR, customer_name text NAME1, city text ORT01, region text REGIO,
        country_code text LAND1, created_on date ERDAT""",
    ),
    "stg_sap__mara": (
        "MARA", "material_id", True,
        """material_id text MATNR, material_type text MTART, material_group text MATKL, base_unit text MEINS,
        created_on date ERSDA, changed_on date LAEDA""",
    ),
    "stg_sap__makt": (
        "MAKT", "material_id language_key", False,
        """material_id text MATNR, language_key text SPRAS, material_description text MAKTX""",
    ),
    "stg_sap__vbak": (
        "VBAK", "sales_order_id", True,
        """sales_order_id text VBELN, order_type text AUART, customer_id text KUNNR, order_date date AUDAT,
        currency text WAERK, net_value amount NETWR, created_on date ERDAT, changed_on date AEDAT""",
    ),
    "stg_sap__vbap": (
        "VBAP", "sales_order_id item_no", True,
        """sales_order_id text VBELN, item_no text POSNR, material_id text MATNR, ordered_qty quantity KWMENG,
        sales_unit text VRKME, net_value amount NETWR, currency text WAERK, rejection_reason text ABGRU,
        created_on date ERDAT, changed_on date AEDAT""",
    ),
    "stg_sap__vbrk": (
        "VBRK", "billing_id", True,
        """billing_id text VBELN, billing_type text FKART, billing_date date FKDAT, payer_id text KUNRG,
        currency text WAERK, net_value amount NETWR, is_cancelled flag FKSTO, created_on date ERDAT,
        changed_on date AEDAT""",
    ),
    "stg_sap__vbrp": (
        "VBRP", "billing_id item_no", True,
        """billing_id text VBELN, item_no text POSNR, sales_order_id text AUBEL,
        sales_order_item_no text AUPOS, material_id text MATNR, billed_qty quantity FKIMG,
        sales_unit text VRKME, net_value amount NETWR, created_on date ERDAT, changed_on date AEDAT""",
    ),
    "stg_sap__likp": (
        "LIKP", "delivery_id", True,
        """delivery_id text VBELN, delivery_type text LFART, ship_to_customer_id text KUNNR,
        delivery_date date LFDAT, created_on date ERDAT, changed_on date AEDAT""",
    ),
    "stg_sap__lips": (
        "LIPS", "delivery_id item_no", True,
        """delivery_id text VBELN, item_no text POSNR, sales_order_id text VGBEL,
        sales_order_item_no text VGPOS, material_id text MATNR, shipped_qty quantity LFIMG,
        sales_unit text VRKME, created_on date ERDAT, changed_on date AEDAT""",
    ),
    "stg_sap__bsid": (
        "BSID", "company_code accounting_doc_id fiscal_year doc_item", False,
        """company_code text BUKRS, accounting_doc_id text BELNR, fiscal_year text GJAHR, doc_item text BUZEI,
        customer_id text KUNNR, doc_type text BLART, posting_date date BUDAT, due_date date FAEDT,
        payment_terms text ZTERM, amount amount WRBTR, currency text WAERS, billing_id text ZUONR""",
    ),
    "stg_sap__bsad": (
        "BSAD", "company_code accounting_doc_id fiscal_year doc_item", False,
        """company_code text BUKRS, accounting_doc_id text BELNR, fiscal_year text GJAHR, doc_item text BUZEI,
        customer_id text KUNNR, doc_type text BLART, posting_date date BUDAT, due_date date FAEDT,
        payment_terms text ZTERM, amount amount WRBTR, currency text WAERS, billing_id text ZUONR,
        cleared_on date AUGDT, clearing_doc_id text AUGBL""",
    ),
}


def _latest(raw: str, keys: str, has_change_date: bool, columns: str) -> str:
    named = [column.split() for column in columns.split(",")]
    typed = ", ".join(f"{CLEAN[kind].format(source)} as {name}" for name, kind, source in named)
    dated = "coalesce(changed_on, created_on) desc nulls last, " if has_change_date else ""
    return f"""select * exclude (_loaded_at, _source_file)
        from (select {typed}, _loaded_at, _source_file from raw_{raw}) as typed
        qualify row_number() over (partition by {keys.replace(" ", ", ")}
            order by {dated}_loaded_at desc, _source_file desc) = 1"""


PARTS: dict[str, tuple[str, list[str]]] = {f"raw_{name}": (sql, []) for name, sql in RAW.items()}
PARTS |= {name: (_latest(*staged), [f"raw_{staged[0]}"]) for name, staged in STAGED.items()}
PARTS |= {
    "rates": (
        "select currency, cast(rate as decimal(9,6)) as rate_to_usd "
        "from (values ('USD', 1.00), ('CAD', 0.73)) seed(currency, rate)",
        [],
    ),
    "customer_days": (
        """select nullif(trim(KUNNR), '') as customer_id,
        cast(strptime(_source_file[6:13], '%Y%m%d') as date) as valid_from,
        unnest(arg_max({'customer_name': nullif(trim(NAME1), ''), 'city': nullif(trim(ORT01), ''),
            'region': nullif(trim(REGIO), ''), 'country_code': nullif(trim(LAND1), '')}, _loaded_at))
        from raw_KNA1 group by 1, 2""",
        ["raw_KNA1"],
    ),
    "customer_changes": (
        """select * from customer_days
        qualify coalesce((customer_name, coalesce(city, ''), coalesce(region, ''), country_code)
            is distinct from lag((customer_name, coalesce(city, ''), coalesce(region, ''), country_code))
            over (partition by customer_id order by valid_from), true)""",
        ["customer_days"],
    ),
    "customers": (
        """select md5(customer_id || '|' || cast(valid_from as varchar)) as customer_key, customer_id,
        customer_name, city, region, country_code, valid_from,
        cast(ifnull(next_from - 1, date '9999-12-31') as date) as valid_to, next_from is null as is_current
        from (select *, lead(valid_from) over (partition by customer_id order by valid_from) as next_from
              from customer_changes) as changes""",
        ["customer_changes"],
    ),
    "materials": (
        """select material_id, (select any_value(material_description) from stg_sap__makt t
            where t.material_id = m.material_id and language_key = 'E') as material_description,
        material_type, material_group, base_unit, created_on, changed_on from stg_sap__mara m""",
        ["stg_sap__mara", "stg_sap__makt"],
    ),
    "dates": (
        """select day as date_day, cast(extract(year from day) as bigint) as year,
        cast(ceil(extract(month from day) / 3.0) as bigint) as quarter,
        cast(extract(month from day) as bigint) as month_number,
        strftime(day, '%B') as month_name, strftime(day, '%A') as day_name,
        dayofweek(day) in (0, 6) as is_weekend
        from (select cast(unnest(range(cast(min(d) as timestamp), cast(max(d) as timestamp) + interval 1 day,
                interval 1 day)) as date) as day
              from (select order_date as d from stg_sap__vbak
                    union all select billing_date from stg_sap__vbrk) as known) as days""",
        ["stg_sap__vbak", "stg_sap__vbrk"],
    ),
    "sales": (
        """select md5(concat_ws('|', i.sales_order_id, i.item_no)) as sales_order_item_key,
        i.sales_order_id, i.item_no, i.order_date, c.customer_key, i.material_id, i.order_type,
        i.ordered_qty, i.sales_unit, i.currency, i.net_value as net_value_doc_currency,
        cast(round(i.net_value * r.rate_to_usd, 2) as decimal(18,2)) as net_value_usd,
        i.rejection_reason, i.rejection_reason is not null as is_rejected
        from (select p.*, k.order_date, k.order_type, k.customer_id
              from stg_sap__vbap p join stg_sap__vbak k using (sales_order_id)) as i
        asof left join customers c on i.customer_id = c.customer_id and i.order_date >= c.valid_from
        left join rates r on r.currency = i.currency""",
        ["stg_sap__vbap", "stg_sap__vbak", "customers", "rates"],
    ),
    "billing": (
        """select md5(concat_ws('|', i.billing_id, i.item_no)) as billing_item_key, i.billing_id, i.item_no,
        i.billing_date, c.customer_key, i.sales_order_id, i.sales_order_item_no, i.material_id,
        i.billing_type, i.billed_qty, i.sales_unit, i.currency, i.net_value as net_value_doc_currency,
        cast(round(i.net_value * r.rate_to_usd, 2) as decimal(18,2)) as net_value_usd, i.is_cancelled,
        i.order_item is null or i.order_item not in (select sales_order_id || '/' || item_no from stg_sap__vbap)
            as is_orphan_item
        from (select p.*, p.sales_order_id || '/' || p.sales_order_item_no as order_item,
                     k.billing_date, k.billing_type, k.payer_id, k.currency, k.is_cancelled
              from stg_sap__vbrp p join stg_sap__vbrk k using (billing_id)) as i
        asof left join customers c on i.payer_id = c.customer_id and i.billing_date >= c.valid_from
        left join rates r on r.currency = i.currency""",
        ["stg_sap__vbrp", "stg_sap__vbrk", "stg_sap__vbap", "customers", "rates"],
    ),
    "deliveries": (
        """select md5(concat_ws('|', i.delivery_id, i.item_no)) as delivery_item_key, i.delivery_id,
        i.item_no, i.delivery_date, c.customer_key, s.sales_order_item_key, i.sales_order_id,
        i.sales_order_item_no, i.material_id, i.shipped_qty, i.sales_unit, s.order_date,
        i.delivery_date - s.order_date as days_order_to_delivery
        from (select p.*, k.delivery_date, k.ship_to_customer_id
              from stg_sap__lips p join stg_sap__likp k using (delivery_id)) as i
        left join sales s on (s.sales_order_id, s.item_no) = (i.sales_order_id, i.sales_order_item_no)
        asof left join customers c on i.ship_to_customer_id = c.customer_id and i.delivery_date >= c.valid_from""",
        ["stg_sap__lips", "stg_sap__likp", "sales", "customers"],
    ),
    "receivables": (
        """select md5(concat_ws('|', i.company_code, i.accounting_doc_id, i.fiscal_year, i.doc_item)) as receivable_key,
        i.company_code, i.accounting_doc_id, i.fiscal_year, i.doc_item, i.billing_id, c.customer_key,
        i.posting_date, i.due_date, i.amount as amount_doc_currency, i.currency,
        cast(round(i.amount * r.rate_to_usd, 2) as decimal(18,2)) as amount_usd, d.cleared_on, d.clearing_doc_id,
        d.cleared_on is not null as is_cleared, if(d.cleared_on is null, 'open', 'cleared') as status,
        d.cleared_on - i.posting_date as days_to_clear
        from stg_sap__bsid i
        left join stg_sap__bsad d using (company_code, accounting_doc_id, fiscal_year, doc_item)
        asof left join customers c on i.customer_id = c.customer_id and i.posting_date >= c.valid_from
        left join rates r on r.currency = i.currency""",
        ["stg_sap__bsid", "stg_sap__bsad", "customers", "rates"],
    ),
}


def _needed(names: list[str], seen: dict[str, None] | None = None) -> dict[str, None]:
    """The named parts and all they build on, in building order."""
    seen = {} if seen is None else seen
    for name in names:
        if name not in seen:
            _needed(PARTS[name][1], seen)
            seen[name] = None
    return seen


def with_parts(parts: str, select: str) -> str:
    """A SELECT over named parts, as one statement."""
    ctes = ",\n".join(f"{name} as (\n{PARTS[name][0]}\n)" for name in _needed(parts.split()))
    return f"with {ctes}\n{select}"


LATEST_LINES = """lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1"""

EVENT_DAYS = """event_days as (
    select user_id, cast(ts as date) as day,
        unnest(arg_max({'event_type': event_type, 'event_id': event_id}, (ts, event_id)))
    from events group by 1, 2)"""

EVENT_CHANGES = f"""{EVENT_DAYS}, event_changes as (
    select * from event_days
    qualify event_type is distinct from lag(event_type) over (partition by user_id order by day))"""

EVENT_VERSIONS = f"""{EVENT_CHANGES}, event_versions as (
    select md5(user_id || '|' || day) as version_key, user_id, event_type, day as valid_from,
        cast(ifnull(next_day - 1, date '9999-12-31') as date) as valid_to, next_day is null as is_current
    from (select *, lead(day) over (partition by user_id order by day) as next_day from event_changes) as c)"""


def _order_versions(day: str = ORDER_DAY) -> str:
    return f"""order_changes as (
    select * from (select o_custkey, {day} as valid_from,
                       arg_max(o_orderpriority, o_orderkey) as o_orderpriority
                   from orders group by 1, 2) as d
    qualify o_orderpriority is distinct from lag(o_orderpriority)
        over (partition by o_custkey order by valid_from)),
order_versions as (
    select md5(o_custkey || '|' || valid_from) as version_key, o_custkey, o_orderpriority, valid_from,
        cast(ifnull(next_from - 1, date '9999-12-31') as date) as valid_to, next_from is null as is_current
    from (select *, lead(valid_from) over (partition by o_custkey order by valid_from) as next_from
          from order_changes) as c)"""


FCT_ITEMS = f"""{_order_versions(f"{ORDER_DAY} + 20")}, fct as (
    select md5(l.l_orderkey || '|' || l.l_linenumber) as item_key, l.l_orderkey, l.l_linenumber, l.order_date,
        v.version_key as customer_key, l.l_partkey, cast(l.l_quantity as decimal(18,3)) as quantity,
        l.currency, cast(l.l_extendedprice as decimal(18,2)) as net_value,
        cast(round(cast(l.l_extendedprice as decimal(18,2))
            * cast(if(l.currency = 'USD', 1, 0.73) as decimal(9,6)), 2) as decimal(18,2)) as net_value_usd,
        l.l_returnflag = 'R' as is_rejected
    from (select i.*, {ORDER_DAY} as order_date, o_custkey, if(c_nationkey % 2 = 0, 'USD', 'CAD') as currency
          from (select * from {LATEST_LINES}) as i
          join orders on o_orderkey = l_orderkey
          left join customer on c_custkey = o_custkey) as l
    asof left join order_versions v on l.o_custkey = v.o_custkey and l.order_date >= v.valid_from)"""


def _usd(currency: str) -> str:
    return f"""select o_orderkey, currency, cast(round(cast(o_totalprice as decimal(18,2)) * cast(
        case currency when 'USD' then 1 when 'CAD' then 0.73 end as decimal(9,6)), 2) as decimal(18,2)) as value_usd
    from (select o_orderkey, o_totalprice, {currency} as currency
          from orders join customer on c_custkey = o_custkey) as priced"""


def _overlaps(relation: str, key: str, version: str) -> str:
    """One row per version start that lies in an earlier-started period, with the longest one."""
    return f"""select b.{key}, b.{version},
        (select arg_max(a.{version}, (a.valid_to, a.{version})) from {relation} a
         where a.{key} = b.{key} and a.valid_from < b.valid_from) as overlapping_{version}
    from {relation} b
    where exists (select 1 from {relation} a where a.{key} = b.{key}
        and a.valid_from < b.valid_from and a.valid_to >= b.valid_from)"""


def _by_month(fact: str, day: str, where: str) -> str:
    return f"""select customer_id, material_id, cast(date_trunc('month', {day}) as date) as month,
        cast(sum(net_value_usd) as decimal(28,2)) as value_usd, count(*) as n_items
    from {fact} left join customers using (customer_key) where {where} group by all"""


CHECK_COLUMNS = "check_name, table_name, kind, severity, n_violations, status"


def _report(rows: list[tuple[str, str, str, str, str]]) -> str:
    union = " union all ".join(
        f"select '{name}' as check_name, '{table}' as table_name, '{kind}' as kind, "
        f"'{severity}' as severity, cast(({count}) as bigint) as n_violations"
        for name, table, kind, severity, count in rows
    )
    return (
        f"select *, case when n_violations = 0 then 'pass' when severity = 'warn' then 'warn' "
        f"else 'fail' end as status from ({union}) as counted"
    )


# Columns that must not be NULL, by table.
NOT_NULL = """
stg_sap__kna1 customer_id
stg_sap__mara material_id
stg_sap__makt material_id language_key
stg_sap__vbak sales_order_id customer_id net_value
stg_sap__vbap sales_order_id item_no material_id
stg_sap__vbrk billing_id payer_id is_cancelled
stg_sap__vbrp billing_id item_no sales_order_id
stg_sap__likp delivery_id delivery_date
stg_sap__lips delivery_id item_no shipped_qty
stg_sap__bsid accounting_doc_id billing_id amount
stg_sap__bsad accounting_doc_id cleared_on
dim_customer customer_key customer_id valid_from valid_to
dim_material material_id material_description
dim_date date_day
fct_sales_order_items sales_order_item_key order_date customer_key material_id
fct_billing_items billing_item_key billing_date customer_key material_id is_cancelled is_orphan_item
fct_delivery_items delivery_item_key delivery_date sales_order_item_key shipped_qty
fct_receivable_items receivable_key billing_id customer_key
exchange_rates currency rate_to_usd
"""

# Unique columns, by table.
UNIQUE = """
stg_sap__kna1 customer_id
stg_sap__mara material_id
stg_sap__makt material_id language_key
stg_sap__vbak sales_order_id
stg_sap__vbap sales_order_id item_no
stg_sap__vbrk billing_id
stg_sap__vbrp billing_id item_no
stg_sap__likp delivery_id
stg_sap__lips delivery_id item_no
stg_sap__bsid company_code accounting_doc_id fiscal_year doc_item
stg_sap__bsad company_code accounting_doc_id fiscal_year doc_item
dim_customer customer_key
dim_material material_id
dim_date date_day
fct_sales_order_items sales_order_item_key
fct_billing_items billing_item_key
fct_delivery_items delivery_item_key
fct_receivable_items receivable_key
exchange_rates currency
"""

# Child and column, parent and column, severity.
RELATIONSHIPS = """
stg_sap__vbak customer_id stg_sap__kna1 customer_id error
stg_sap__vbap sales_order_id stg_sap__vbak sales_order_id error
stg_sap__vbap material_id stg_sap__mara material_id error
stg_sap__vbrk payer_id stg_sap__kna1 customer_id error
stg_sap__vbrp billing_id stg_sap__vbrk billing_id error
stg_sap__vbrp sales_order_id stg_sap__vbap sales_order_id warn
stg_sap__lips delivery_id stg_sap__likp delivery_id error
fct_sales_order_items customer_key dim_customer customer_key error
fct_sales_order_items material_id dim_material material_id error
fct_billing_items customer_key dim_customer customer_key error
fct_billing_items material_id dim_material material_id error
fct_delivery_items sales_order_item_key fct_sales_order_items sales_order_item_key error
fct_receivable_items customer_key dim_customer customer_key error
"""

# The models that a model reads.
EDGES = """
dim_material stg_sap__mara stg_sap__makt
dim_date stg_sap__vbak stg_sap__vbrk
fct_sales_order_items stg_sap__vbap stg_sap__vbak dim_customer exchange_rates
fct_billing_items stg_sap__vbrp stg_sap__vbrk stg_sap__vbap dim_customer exchange_rates
fct_receivable_items stg_sap__bsid stg_sap__bsad dim_customer exchange_rates
fct_delivery_items stg_sap__lips stg_sap__likp fct_sales_order_items dim_customer
"""

ACCEPTED = [
    *[(table, "currency", "'USD', 'CAD'") for table in (
        "stg_sap__vbak", "stg_sap__vbap", "stg_sap__vbrk", "fct_sales_order_items", "fct_receivable_items"
    )],
    ("fct_receivable_items", "status", "'open', 'cleared'"),
]

# The parts that hold the tables.
PLACES = {
    "dim_customer": "customers",
    "dim_material": "materials",
    "dim_date": "dates",
    "fct_sales_order_items": "sales",
    "fct_billing_items": "billing",
    "fct_delivery_items": "deliveries",
    "fct_receivable_items": "receivables",
    "exchange_rates": "rates",
}


def _rows(text: str) -> list[list[str]]:
    return [line.split() for line in text.split("\n") if line]


def _declared() -> list[tuple[str, str, str, str, str]]:
    """Name, table, kind, severity and count of violations of every check."""
    at = lambda table: PLACES.get(table, table)
    out = [
        (f"not_null_{t}_{c}", t, "not_null", "error", f"select count(*) from {at(t)} where {c} is null")
        for t, *columns in _rows(NOT_NULL)
        for c in columns
    ]
    for t, *keys in _rows(UNIQUE):
        given, names = " and ".join(f"{k} is not null" for k in keys), ", ".join(keys)
        repeated = f"select 1 from {at(t)} where {given} group by {names} having count(*) > 1"
        out.append((f"unique_{t}_{'_'.join(keys)}", t, "unique", "error", f"select count(*) from ({repeated}) as d"))
    for child, column, parent, key, severity in _rows(RELATIONSHIPS):
        count = (
            f"select count(*) from {at(child)} where {column} is not null and {column} not in "
            f"(select {key} from {at(parent)} where {key} is not null)"
        )
        out.append((f"relationships_{child}_{column}__{parent}", child, "relationships", severity, count))
    for t, c, values in ACCEPTED:
        count = f"select count(distinct {c}) from {at(t)} where {c} not in ({values})"
        out.append((f"accepted_values_{t}_{c}", t, "accepted_values", "error", count))
    items = "b.sales_order_id = s.sales_order_id and b.sales_order_item_no = s.item_no"
    rules = [
        ("billed_qty_within_ordered_qty", "fct_billing_items", "error",
         f"select count(*) from billing b, sales s where {items} and billed_qty > ordered_qty"),
        ("no_billing_for_rejected_order_items", "fct_billing_items", "error",
         f"select count(*) from billing b, sales s where {items} and is_rejected"),
        ("cleared_after_posting", "fct_receivable_items", "error",
         "select count(*) from receivables where cleared_on < posting_date"),
        ("customer_versions_do_not_overlap", "dim_customer", "error",
         f"select count(*) from ({_overlaps('customers', 'customer_id', 'customer_key')}) as o"),
        ("receivable_matches_invoice", "fct_receivable_items", "error",
         "select count(*) from receivables r join stg_sap__vbrk i on i.billing_id = r.billing_id "
         "where i.net_value <> r.amount_doc_currency"),
        ("shipped_qty_within_ordered_qty", "fct_delivery_items", "warn",
         "select count(*) from deliveries d join sales s on s.sales_order_item_key = d.sales_order_item_key "
         "where shipped_qty > ordered_qty"),
    ]
    return out + [(name, t, "business_rule", severity, count) for name, t, severity, count in rules]


def _build_report() -> str:
    """Status by table. A failure of a table that is skipped, or on one that is not there, does not count."""
    values = ", ".join(f"('{t}', '{p}')" for t, *parents in _rows(EDGES) for p in parents)
    tables = ", ".join(f"'{t}'" for t, *_ in _rows(NOT_NULL))
    layer = "case when table_name = 'exchange_rates' then 'seeds' when table_name like 'stg%' then 'staging' else 'marts' end"
    return f"""checks as ({_report(_declared())}), tables as (select unnest([{tables}]) as table_name),
    edges(table_name, parent) as (values {values}),
    failing as (select distinct table_name from checks where status = 'fail'),
    first as (select distinct e.table_name from edges e join failing f on f.table_name = e.parent),
    skipped as (select table_name from first union select e.table_name from edges e join first on first.table_name = e.parent)
    select table_name, {layer} as layer, case when table_name in (select table_name from skipped) then 'skipped'
        when table_name in (select table_name from failing) then 'failed' else 'built' end as status from tables"""


def all_oracles() -> dict[str, str]:
    """Query name to SQL giving the same rows."""
    generic = {
        "clean_text": """select l_orderkey, l_linenumber, l_partkey,
            case when l_returnflag = 'A' then 'A' end as cleaned, l_returnflag = 'R' as is_returned from lineitem""",
        "clean_date_amount_qty": f"""select {_pad("o_orderkey", 10)} as order_id,
            if(o_orderpriority in ('5-LOW', '2-HIGH'), null, {ORDER_DAY}) as order_date,
            if(o_orderkey % 11 = 0, null, cast(o_totalprice as decimal(18,2))) as amount,
            if(o_orderkey % 7 = 0, null, cast(o_custkey % 50 as decimal(18,3))) as quantity from orders""",
        "file_name_date": f"""select o_orderkey, 'VBAK_' || {_ymd(ORDER_DAY)} || '.csv' as file_name,
            {ORDER_DAY} as file_date from orders""",
        "bad_dates": with_parts(
            "raw_VBAK",
            """select VBELN, if(cast(VBELN as bigint) % 500 = 3, '20261340', 'soon') as AUDAT, AEDAT
            from raw_VBAK where cast(VBELN as bigint) % 500 in (3, 4)""",
        ),
        "latest_by_change": f"""select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_returnflag,
            cast(l_quantity as decimal(18,3)) as quantity from {LATEST_LINES}""",
        "latest_max_by": f"""select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey,
            cast(l_quantity as decimal(18,3)) as quantity from {LATEST_LINES}""",
        "latest_by_load": """select user_id, event_type, max(ts) as ts, arg_max(event_id, (ts, event_id)) as event_id
            from events group by user_id, event_type""",
        "one_per_day": f"with {EVENT_DAYS} select user_id, day, event_type, event_id from event_days",
        "attribute_changes": f"""with {EVENT_CHANGES}
            select user_id, day, event_type, event_id, event_type as attributes from event_changes""",
        "scd2_events": f"with {EVENT_VERSIONS} select * from event_versions",
        "scd2_orders": f"with {_order_versions()} select * from order_versions",
        "inner_header_item": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderstatus
            from lineitem join orders on o_orderkey = l_orderkey""",
        "pit_join": f"""with {EVENT_VERSIONS} select e.event_id, e.user_id, e.day_before, v.version_key
            from (select event_id, user_id, cast(ts as date) - 1 as day_before from events) as e
            asof left join event_versions v on e.user_id = v.user_id and e.day_before >= v.valid_from""",
        "usd_value": _usd("if(c_nationkey % 2 = 0, 'USD', 'CAD')"),
        "usd_missing_rate": _usd("(['USD', 'CAD', 'EUR'])[c_nationkey % 3 + 1]"),
        "orphan_flag": f"""select {BROKEN_ORDER} as l_orderkey, l_linenumber, l_partkey, l_suppkey,
            {BROKEN_ORDER} not in (select o_orderkey from orders) as is_orphan from lineitem""",
        "left_const_join": """select p_partkey, p_name, s_name from part
            left join (select * from supplier where s_nationkey = 3) as s on s_suppkey = p_partkey""",
        "open_vs_cleared": f"""select o_orderkey, cleared_on, cleared_on is not null as is_cleared,
            if(cleared_on is null, 'open', 'cleared') as status, cleared_on - {ORDER_DAY} as days_to_clear
            from orders left join (select l_orderkey, min({SHIP_DAY}) as cleared_on from lineitem group by all) as c
                on l_orderkey = o_orderkey and o_orderstatus = 'F'""",
        "delivery_lag": f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, {ORDER_DAY} as order_date,
            {SHIP_DAY} - {ORDER_DAY} as days_to_ship from lineitem left join orders on o_orderkey = l_orderkey""",
        "order_calendar": f"""with stg_sap__vbak as (select {ORDER_DAY} as order_date from orders),
            stg_sap__vbrk as (select {SHIP_DAY} as billing_date from lineitem) {PARTS["dates"][0]}""",
        "fct_items": f"with {FCT_ITEMS} select * from fct",
        "billing_fact": f"""with {FCT_ITEMS} select item_key, l_orderkey, l_linenumber, net_value_usd,
            o_orderstatus = 'P' as is_cancelled,
            not exists (select 1 from lineitem k where k.l_orderkey = fct.l_orderkey and
                k.l_linenumber = fct.l_linenumber + if(fct.l_partkey % 9 = 0, 100, 0)) as is_orphan_item
            from fct join orders on o_orderkey = l_orderkey""",
        "check_unique": """select l_orderkey, l_linenumber, count(*) as n_records from lineitem
            group by all having count(*) > 1""",
        "check_not_null": f"""with {FCT_ITEMS} select 'not_null_fct_items_' || c as check_name,
            'fct_items' as table_name, 'not_null' as kind, 'error' as severity, n as n_violations,
            if(n = 0, 'pass', 'fail') as status
            from (select unnest(['item_key', 'customer_key', 'net_value_usd', 'order_date']) as c,
                unnest([count(*) - count(item_key), count(*) - count(customer_key),
                        count(*) - count(net_value_usd), count(*) - count(order_date)]) as n from fct) as counted""",
        "check_relationships": f"""select l_orderkey, count(*) as n_records
            from (select {BROKEN_ORDER} as l_orderkey from lineitem) as l
            where l_orderkey not in (select o_orderkey from orders) group by all""",
        "check_accepted_values": """select o_orderpriority, count(*) as n_records from orders
            where o_orderpriority not in ('1-URGENT', '2-HIGH') group by all""",
        "check_overlap": f"""with {EVENT_DAYS}, periods as (select user_id, day as valid_from,
                day + 1 as valid_to, event_id as version_key from event_days)
            {_overlaps("periods", "user_id", "version_key")}""",
        "check_no_overlap": f"""with {_order_versions()} {_overlaps("order_versions", "o_custkey", "version_key")}""",
        "check_report": _report(
            [
                ("unique_orders", "orders", "unique", "error",
                 "select count(*) - count(distinct o_orderkey) from orders"),
                ("unique_lines", "lineitem", "unique", "error",
                 "select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber "
                 "having count(*) > 1) as d"),
                ("lines_have_placed_order", "lineitem", "relationships", "warn",
                 f"select count(*) from (select {BROKEN_ORDER} as l_orderkey from lineitem) as l "
                 "anti join orders on l_orderkey = o_orderkey"),
                ("accepted_priorities", "orders", "accepted_values", "error",
                 "select count(distinct o_orderpriority) from orders where o_orderpriority <> '1-URGENT'"),
                ("not_null_orders_o_orderkey", "orders", "not_null", "error",
                 "select count(*) from orders where o_orderkey is null"),
                ("not_null_orders_o_custkey", "orders", "not_null", "error",
                 "select count(*) from orders where o_custkey is null"),
            ]
        ),
        "loaded_customers": with_parts(
            "raw_KNA1",
            """select KUNNR, if(cast(KUNNR as bigint) % 89 = 0, NAME1 || chr(10) || 'c/o "Home"', NAME1) as NAME1,
            ORT01, REGIO, LAND1, ERDAT, _source_file[6:11] as month from raw_KNA1""",
        ),
        "load_skip": f"""select distinct 'VBAK_' || {_ymd(ORDER_DAY)} || '.csv' as file_name from orders
            where o_orderdate >= timestamp '1998-01-01'""",
        "file_row_counts": f"""select 'VBAK_' || {_ymd(ORDER_DAY)} || '.csv' as file_name,
            count_if(o_orderstatus = 'O') as row_count from orders group by {ORDER_DAY}""",
    }
    generic["file_row_counts"] = generic["file_row_counts"].replace(
        "count_if(o_orderstatus = 'O')", "cast(count_if(o_orderstatus = 'O') as bigint)"
    )
    every = " ".join([*STAGED, *PLACES.values()])
    generic["declared_checks"] = with_parts(every, _report(_declared()))
    report = _build_report()
    generic["build_report"] = with_parts(every, "").rstrip() + ",\n" + report
    by_month = "select KUNNR, NAME1, ORT01, REGIO, LAND1, ERDAT, _source_file[6:11] as month from raw_KNA1"
    generic["loaded_reordered"] = generic["streamed_customers"] = with_parts("raw_KNA1", by_month)
    generic["load_log_rows"] = with_parts(
        "raw_KNA1",
        "select 'KNA1' as table_name, _source_file[6:11] as month, count(*) as row_count from raw_KNA1 group by all "
        "union all select 'KNA1', '209912', 0",
    )
    generic["load_counts"] = with_parts(
        "raw_VBAK",
        "select cast(1 as integer) as load, count(*) as rows_loaded, true as loads_all_files, "
        "false as skips_all_files from raw_VBAK union all select 2, 0, false, true",
    )
    generic["rejected_files"] = with_parts(
        "raw_KNA1",
        "select 'KNA1' as table_name, false as is_refused, count(*) as n_rows from raw_KNA1 "
        "union all select unnest(['MARA', 'MAKT', 'VBAK']), true, 0",
    )
    generic["rebuilt_mart"] = with_parts("materials", "select * from materials")
    generic["published_view"] = with_parts(
        "customers stg_sap__kna1",
        "select v.customer_id, v.customer_key, v.valid_from, v.valid_to, v.is_current, c.city, "
        "cast(if(c.country_code = 'US', 1, 0.73) as decimal(9,6)) as rate_to_usd from customers v join stg_sap__kna1 c on c.customer_id = v.customer_id",
    )
    generic["pit_join_as_of"] = generic["pit_join"]
    overlapping = f"""with {_order_versions()} select o_orderkey, o.o_custkey, {ORDER_DAY} as day, v.version_key
        from orders o left join order_versions v on o.o_custkey = v.o_custkey and {ORDER_DAY} >= v.valid_from
            and {ORDER_DAY} <= if(v.is_current, v.valid_to, v.valid_to + if(v.is_current, 0, 30))"""
    for name in ("pit_join_overlapping", "pit_join_overlapping_as_of", "pit_join_overlapping_auto"):
        generic[name] = overlapping
    staging = {name: with_parts(name, f"select * from {name}") for name in STAGED}
    models = {
        "dim_customer": with_parts("customers", "select * from customers"),
        "dim_material": with_parts("materials", "select * from materials"),
        "dim_date": with_parts("dates", "select * from dates"),
        "fct_sales_order_items": with_parts("sales", "select * from sales"),
        "fct_billing_items": with_parts("billing", "select * from billing"),
        "fct_delivery_items": with_parts("deliveries", "select * from deliveries"),
        "fct_receivable_items": with_parts("receivables", "select * from receivables"),
    }
    ordered = "select {0} from billing b, sales s where b.sales_order_id = s.sales_order_id and b.sales_order_item_no = s.item_no and {1}"
    rules = {
        "billed_qty_within_ordered_qty": with_parts(
            "billing sales",
            ordered.format("billing_item_key, billed_qty, ordered_qty", "ordered_qty - billed_qty < 0"),
        ),
        "cleared_after_posting": with_parts(
            "receivables",
            "select receivable_key, posting_date, cleared_on from receivables where days_to_clear < 0",
        ),
        "customer_versions_do_not_overlap": with_parts(
            "customers", _overlaps("customers", "customer_id", "customer_key")
        ),
        "no_billing_for_rejected_order_items": with_parts(
            "billing sales",
            ordered.format("billing_item_key, sales_order_item_key", "rejection_reason is not null"),
        ),
        "receivable_matches_invoice": with_parts(
            "receivables stg_sap__vbrk",
            "select receivable_key, amount_doc_currency, net_value from receivables "
            "join stg_sap__vbrk using (billing_id) where amount_doc_currency - net_value <> 0",
        ),
        "shipped_qty_within_ordered_qty": with_parts(
            "deliveries sales",
            "select delivery_item_key, shipped_qty, ordered_qty from deliveries "
            "join sales using (sales_order_item_key) where ordered_qty - shipped_qty < 0",
        ),
    }
    questions = {
        "value_by_customer_month": with_parts("sales customers", _by_month("sales", "order_date", "true")),
        "billed_value": with_parts(
            "billing customers",
            _by_month("billing", "billing_date", "not is_cancelled and not is_orphan_item"),
        ),
        "open_value": with_parts(
            "sales billing",
            """select currency, cast(sum(net_value_doc_currency) as decimal(28,2)) as open_value_doc_currency,
            cast(sum(net_value_usd) as decimal(28,2)) as open_value_usd, count(*) as n_items
            from sales s where not is_rejected and not exists (select 1 from billing b where not b.is_cancelled
                and b.sales_order_id = s.sales_order_id and b.sales_order_item_no = s.item_no) group by currency""",
        ),
        "order_to_invoice_days": with_parts(
            "billing sales",
            """select cast(date_trunc('month', billing_date) as date) as month, count(*) as n_items,
            avg(billing_date - order_date) as avg_days, quantile_cont(billing_date - order_date, 0.5) as median_days,
            min(billing_date - order_date) as min_days, max(billing_date - order_date) as max_days
            from billing b join sales s on b.sales_order_id = s.sales_order_id and b.sales_order_item_no = s.item_no
            where not is_cancelled group by 1""",
        ),
        "shipped_vs_ordered": with_parts(
            "sales deliveries",
            """select sales_order_item_key, s.sales_order_id, s.item_no, ordered_qty,
            cast(ifnull(sum(shipped_qty), 0) as decimal(28,3)) as shipped_qty,
            count(delivery_item_key) as n_deliveries, ifnull(sum(shipped_qty), 0) > ordered_qty as is_over_shipped
            from sales s left join deliveries using (sales_order_item_key) group by 1, 2, 3, 4""",
        ),
        "receivables_by_status": with_parts(
            "receivables",
            """select status, currency, count(*) as n_items,
            cast(sum(amount_doc_currency) as decimal(28,2)) as amount_doc_currency,
            cast(sum(amount_usd) as decimal(28,2)) as amount_usd, avg(days_to_clear) as avg_days_to_clear
            from receivables group by all""",
        ),
    }
    refreshed = {
        "refreshed_orders": staging["stg_sap__vbak"],
        "spliced_customers": models["dim_customer"],
        "refreshed_sales_items": models["fct_sales_order_items"],
        "refreshed_billing_items": models["fct_billing_items"],
        "refreshed_delivery_items": models["fct_delivery_items"],
        "refreshed_receivable_items": models["fct_receivable_items"],
    }
    facts = {"sales": "sales_order", "billing": "billing", "delivery": "delivery", "receivable": "receivable"}
    placed = {f"placed_{name}_items": models[f"fct_{fact}_items"] for name, fact in facts.items()}
    return generic | staging | models | rules | questions | refreshed | placed

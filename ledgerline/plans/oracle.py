"""The same queries as plain SQL over the test tables, in the shape their definitions have.

They share nothing with the Spark code: fan-out joins are written as joins, states as window queries.
"""

from __future__ import annotations

import re

_SUMMARY = """
    select district, crop_name, sum(production_tonnes) as total_production,
           avg(rainfall_mm) as avg_rainfall, avg(ph_level) as avg_ph,
           sum(quantity_used_kg) as fertilizer_used, count(distinct farmer_id) as total_farmers"""

ADAPTERS = {
    "crm_customers": """
        select c_custkey as customer_id, c_mktsegment || ' ' || n_name as name, n_name as city
        from customer join nation on c_nationkey = n_nationkey""",
    "crm_orders": """
        select o_orderkey as order_id, o_custkey as customer_id,
               cast(o_totalprice as decimal(18,2)) as amount, cast(o_orderdate as date) as order_date
        from orders""",
    "spend": """
        select customer_id, name, city, count(order_id) as total_orders,
               sum(amount) as total_spent
        from crm_customers join crm_orders using (customer_id) group by all""",
    "retail_lines": """
        select l_orderkey as order_id, l_partkey as product_id, l_suppkey as store_id,
               cast(l_quantity as int) as qty, cast(l_extendedprice as decimal(18,2)) as sales_amount,
               cast(l_shipdate as date) as order_date
        from lineitem""",
    "fact_sales": """
        select l_orderkey as order_id, o_custkey as customer_id, l_partkey as product_id,
               l_suppkey as store_id, cast(l_quantity as int) as qty,
               cast(l_extendedprice as decimal(18,2)) as sales_amount,
               cast(l_shipdate as date) as order_date
        from lineitem left join orders on l_orderkey = o_orderkey""",
    "order_log": """
        select l_orderkey as order_id, o_custkey as customer_id, l_partkey as product_id,
               l_suppkey as store_id, cast(l_quantity as int) as qty,
               cast(l_extendedprice as decimal(18,2)) as price,
               cast(l_shipdate as date) as order_date,
               case when l_returnflag = 'R' then 'DELETE' when l_returnflag = 'A' then 'UPDATE'
                    else 'INSERT' end as op,
               date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as seq,
               l_shipdate as commit_ts
        from lineitem left join orders on l_orderkey = o_orderkey""",
    "dim_customers": """
        select c_custkey as customer_id, c_name as customer_name,
               lower(c_mktsegment) || '@example.com' as email, n_name as city
        from customer left join nation on c_nationkey = n_nationkey""",
    "dim_products": """
        select p_partkey as product_id, p_name as product_name, p_type as category,
               cast(p_retailprice as decimal(18,2)) as unit_price
        from part""",
    "dim_stores": """
        select s_suppkey as store_id, s_name as store_name, n_name as location
        from supplier left join nation on s_nationkey = n_nationkey""",
    "sales_view": """
        select c.customer_name, p.product_name, s.store_name, f.sales_amount, f.order_date
        from fact_sales f
        join dim_customers c on f.customer_id = c.customer_id
        join dim_products p on f.product_id = p.product_id
        join dim_stores s on f.store_id = s.store_id""",
    "amounts": """
        select l_orderkey * 10 + l_linenumber as transaction_id, cast(l_shipdate as date) as txn_date,
               cast(case when l_returnflag = 'N' then l_extendedprice else -l_extendedprice end
                    as decimal(10,2)) as amount,
               case when l_returnflag = 'N' then 'CREDIT' else 'DEBIT' end as type
        from lineitem""",
    "transactions_raw": """
        select l_orderkey * 10 + l_linenumber as transaction_id, cast(l_shipdate as date) as txn_date,
               upper(p_name) || ' ' || p_brand as description,
               cast(case when l_returnflag = 'N' then l_extendedprice else -l_extendedprice end
                    as decimal(10,2)) as amount,
               case when l_returnflag = 'N' then 'CREDIT' else 'DEBIT' end as type,
               nullif(p_type, 'ECONOMY') as category
        from lineitem left join part on l_partkey = p_partkey""",
    "transactions": """
        select transaction_id, txn_date, description, amount, type,
               case when lower(description) like '%red%' then 'Food'
                    when lower(description) like '%bolt%' then 'Shopping'
                    when lower(description) like '%old%' then 'Travel'
                    when lower(description) like '%gizmo%' then 'Entertainment'
                    when lower(description) like '%ring%' then 'Investment'
                    else category end as category,
               strftime(txn_date, '%b') as month_name, cast(year(txn_date) as int) as year
        from transactions_raw""",
    "flows": """
        select txn_date, case when type = 'CREDIT' then amount else 0 end as income,
               case when type = 'DEBIT' then abs(amount) else 0 end as expense
        from amounts""",
    "balance": """
        select sum(income) as income, sum(expense) as expense, sum(income) - sum(expense) as savings
        from flows""",
    "rate": """
        select cast(income as double) as income, cast(expense as double) as expense,
               cast(savings as double) as savings,
               case when income > 0
                    then round_even(cast(savings as double) / cast(income as double) * 100, 2)
                    else 0 end as savings_rate
        from balance""",
    "crop_data": """
        select o_orderkey as crop_id, c_mktsegment as crop_name, n_name as district,
               year(o_orderdate) as year, cast(o_totalprice as decimal(18,2)) as production_tonnes
        from orders join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey""",
    "rainfall_data": """
        select l_suppkey as record_id, n_name as district, year(l_shipdate) as year,
               cast(max(l_quantity) as decimal(18,2)) as rainfall_mm
        from lineitem join supplier on l_suppkey = s_suppkey
        join nation on s_nationkey = n_nationkey
        group by l_suppkey, n_name, year(l_shipdate)""",
    "soil_data": """
        select s_suppkey as soil_id, lower(n_name) as district,
               cast(s_acctbal as decimal(18,2)) as ph_level
        from supplier join nation on s_nationkey = n_nationkey""",
    "fertilizer_data": """
        select n_name as district, l_returnflag as fertilizer_type,
               cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) as quantity_used_kg
        from lineitem join supplier on l_suppkey = s_suppkey
        join nation on s_nationkey = n_nationkey
        group by n_name, l_returnflag""",
    "farmer_data": """
        select c_custkey as farmer_id, c_name as name, n_name as district
        from customer join nation on c_nationkey = n_nationkey""",
    # One row per combination of matches on every side, by district and year.
    "agro_rows": """
        select c.district, c.crop_name, c.production_tonnes, r.rainfall_mm, s.ph_level,
               f.quantity_used_kg, m.farmer_id
        from crop_data c
        left join rainfall_data r on upper(c.district) = upper(r.district) and c.year = r.year
        left join soil_data s on upper(c.district) = upper(s.district)
        left join fertilizer_data f on upper(c.district) = upper(f.district)
        left join farmer_data m on upper(c.district) = upper(m.district)""",
    "agro_rows_cs": """
        select c.district, c.crop_name, c.production_tonnes, r.rainfall_mm, s.ph_level,
               f.quantity_used_kg, m.farmer_id
        from crop_data c
        left join rainfall_data r on c.district = r.district and c.year = r.year
        left join soil_data s on c.district = s.district
        left join fertilizer_data f on c.district = f.district
        left join farmer_data m on c.district = m.district""",
    "district_summary": f"{_SUMMARY} from agro_rows group by all",
    "district_summary_cs": f"{_SUMMARY} from agro_rows_cs group by all",
    "agri_kpi": """
        select district, sum(total_production) as total_production,
               avg(avg_rainfall) as avg_rainfall, sum(total_farmers) as total_farmers
        from district_summary group by district""",
    "metering_history": """
        select ts as start_time, event_type as warehouse_name,
               cast(value as decimal(18,2)) as credits_used
        from events""",
    "changelog": """
        select user_id as pk, cast(value as decimal(18,2)) as val, event_id as seq, ts as commit_ts,
               case when event_type = 'signup' then 'INSERT' when event_type = 'error' then 'DELETE'
                    else 'UPDATE' end as op
        from events""",
    "positions": """
        select coalesce(max(case when commit_ts < timestamp '2024-01-11' then seq end), -1) as since,
               coalesce(max(case when commit_ts < timestamp '2024-01-21' then seq end), -1) as until
        from changelog""",
    "old_state": """
        select pk, val from (
            select *, row_number() over (partition by pk order by seq desc) as rn
            from changelog cross join positions where seq <= since) where rn = 1 and op <> 'DELETE'""",
    "new_state": """
        select pk, val from (
            select *, row_number() over (partition by pk order by seq desc) as rn
            from changelog cross join positions where seq <= until) where rn = 1 and op <> 'DELETE'""",
    "last_state": """
        select pk, val from (
            select *, row_number() over (partition by pk order by seq desc) as rn
            from changelog) where rn = 1 and op <> 'DELETE'""",
}

_FACT = """order_id, customer_id, product_id, store_id, qty,
    cast(sales_amount as double) as sales_amount, cast(order_date as varchar) as order_date"""
_VIEW = """customer_name, product_name, store_name, cast(sales_amount as double) as sales_amount,
    cast(order_date as varchar) as order_date"""
_RAW = """transaction_id, cast(txn_date as varchar) as txn_date, description,
    cast(amount as double) as amount, type, category"""
_ORDERS = """order_id, customer_id, cast(amount as double) as amount,
    cast(order_date as varchar) as order_date"""
_DISTRICT = """district, crop_name, cast(total_production as double) as total_production,
    round(avg_rainfall, 6) as avg_rainfall, round(avg_ph, 6) as avg_ph,
    cast(fertilizer_used as double) as fertilizer_used, total_farmers"""

_BODIES = {
    # Retail.
    "fact_sales": f"select {_FACT} from fact_sales",
    "dim_stores": "select * from dim_stores",
    "sales_view": f"select {_VIEW} from sales_view",
    "recent_sales": f"select {_VIEW} from sales_view order by order_date desc nulls first",
    "total_sales": """
        select cast(coalesce(sum(sales_amount), 0) as double) as total_sales from retail_lines""",
    "total_orders": "select count(*) as total_orders from retail_lines",
    "retail_kpi_row": """
        select format('{:,}', cast(floor(sum(sales_amount)) as bigint))
                 || right(cast(sum(sales_amount) as varchar), 3) as total_sales,
               count(*) as total_orders
        from retail_lines""",
    "product_sales": """
        select product_name, cast(sum(sales_amount) as double) as total_sales
        from retail_lines join dim_products using (product_id)
        group by all order by total_sales desc nulls first""",
    "store_sales": """
        select store_name, cast(sum(sales_amount) as double) as total_sales
        from retail_lines join dim_stores using (store_id)
        group by all order by total_sales desc nulls first""",
    "customer_orders": """
        select customer_name, count(*) as total_orders from sales_view
        group by customer_name order by total_orders desc nulls first""",
    "sales_on_date": f"select {_FACT} from fact_sales where order_date = '2000-01-01'",
    "dt_sales_summary": """
        select product_id, cast(sum(sales_amount) as double) as total_sales
        from retail_lines group by product_id""",
    "mv_product_sales": """
        select product_id, cast(sum(sales_amount) as double) as total
        from retail_lines group by product_id""",
    "mask_email": """
        select customer_id, customer_name, '*****' as email, city from dim_customers""",
    # Personal finance.
    "categorize_transactions": f"select {_RAW} from transactions",
    "enrich_transactions": f"select {_RAW}, month_name, year from transactions",
    "monthly_expense": """
        select cast(cast(date_trunc('month', txn_date) as date) as varchar) as month,
               cast(sum(abs(amount)) as double) as expense
        from amounts where type = 'DEBIT' group by 1 order by month""",
    "category_expense": """
        select category, cast(sum(abs(amount)) as double) as expense
        from transactions where type = 'DEBIT' group by category""",
    "income_expense": """
        select strftime(txn_date, '%b') as month, cast(sum(income) as double) as income,
               cast(sum(expense) as double) as expense
        from flows group by all order by month""",
    "income_expense_by_year": """
        select cast(year(txn_date) as int) as year, strftime(txn_date, '%b') as month,
               cast(sum(income) as double) as income, cast(sum(expense) as double) as expense
        from flows group by all order by year, month""",
    "merchant_spend": """
        select description, count(*) as transaction_count,
               cast(sum(abs(amount)) as double) as total_spend
        from transactions where type = 'DEBIT' group by description
        order by total_spend desc nulls first""",
    "top_merchants": """
        select description, count(*) as transaction_count,
               cast(sum(abs(amount)) as double) as total_spend
        from transactions where type = 'DEBIT' group by description
        order by total_spend desc nulls first, description limit 10""",
    "savings": "select income, expense, savings from rate",
    "savings_rate": "select income, expense, savings, savings_rate from rate",
    "financial_health": """
        select savings_rate, case when savings_rate >= 40 then 'Excellent'
               when savings_rate >= 20 then 'Good' when savings_rate >= 10 then 'Average'
               else 'High Spending' end as rating from rate""",
    "finance_kpi_row": """
        select format('{:,}', cast(round_even(income, 0) as bigint)) as income,
               format('{:,}', cast(round_even(expense, 0) as bigint)) as expense,
               format('{:,}', cast(round_even(savings, 0) as bigint)) as savings,
               cast(savings_rate as varchar) || '%' as savings_rate from rate""",
    # Customer orders.
    "scan_orders": f"select {_ORDERS} from crm_orders",
    "customer_summary": """
        select customer_id, name, city, total_orders, cast(total_spent as double) as total_spent
        from spend""",
    "mv_customer": "select name, cast(total_spent as double) as total_spent from spend",
    "customer_spend_by_name": """
        select name, cast(sum(total_spent) as double) as total_spent
        from spend group by all order by total_spent desc nulls first""",
    "mask_amount": """
        select order_id, customer_id, cast(0 as double) as amount,
               cast(order_date as varchar) as order_date from crm_orders""",
    "mask_amount_admin": f"select {_ORDERS} from crm_orders",
    "masked_customer_summary": """
        select c.customer_id, c.name, c.city, count(o.order_id) as total_orders,
               cast(sum(o.amount) as double) as total_spent
        from crm_customers c
        join (select order_id, customer_id, 0 as amount from crm_orders) o
          on c.customer_id = o.customer_id
        group by c.customer_id, c.name, c.city""",
    "delete_where": f"""
        select {_ORDERS} from crm_orders where not coalesce(amount < 200000, false)""",
    # Agriculture.
    "crop_rainfall_left": """
        select district, crop_name, cast(year as int) as year, count(*) as joined_rows,
               cast(sum(production_tonnes) as double) as total_production,
               round(avg(rainfall_mm), 6) as avg_rainfall
        from crop_data left join rainfall_data using (district, year)
        group by all""",
    "district_summary": f"select {_DISTRICT} from district_summary",
    "district_summary_cs": f"select {_DISTRICT} from district_summary_cs",
    "district_summary_deduplicated": """
        select g.district, g.crop_name, cast(g.total_production as double) as total_production,
               (select round(avg(r.rainfall_mm), 6) from rainfall_data r
                where upper(r.district) = upper(g.district) and r.year in (
                    select c.year from crop_data c
                    where c.district = g.district and c.crop_name = g.crop_name)) as avg_rainfall,
               (select round(avg(s.ph_level), 6) from soil_data s
                where upper(s.district) = upper(g.district)) as avg_ph,
               (select cast(sum(f.quantity_used_kg) as double) from fertilizer_data f
                where upper(f.district) = upper(g.district)) as fertilizer_used,
               (select count(distinct fm.farmer_id) from farmer_data fm
                where upper(fm.district) = upper(g.district)) as total_farmers
        from (select district, crop_name, sum(production_tonnes) as total_production
              from crop_data group by district, crop_name) g""",
    "agri_kpi": """
        select district, cast(total_production as double) as total_production,
               round(avg_rainfall, 6) as avg_rainfall,
               cast(total_farmers as bigint) as total_farmers from agri_kpi""",
    "agri_kpi_dashboard": """
        select round(cast(sum(total_production) as double), 2) as total_production,
               round(avg(avg_rainfall), 2) as avg_rainfall,
               cast(sum(total_farmers) as bigint) as total_farmers,
               count(distinct district) as total_districts from agri_kpi""",
    "crop_production": """
        select crop_name, cast(sum(total_production) as double) as production
        from district_summary group by crop_name order by production desc nulls first""",
    "rainfall_by_district": """
        select district, round(avg(avg_rainfall), 6) as rainfall
        from district_summary group by district order by rainfall desc nulls first""",
    "soil_ph_by_district": """
        select district, round(avg(avg_ph), 6) as ph_level
        from district_summary group by district order by ph_level desc nulls first""",
    "fertilizer_by_district": """
        select district, cast(sum(fertilizer_used) as double) as fertilizer_used
        from district_summary group by district order by fertilizer_used desc nulls first""",
    "count_crop_data": "select count(*) as row_count from crop_data",
    # Usage metering.
    "usage_total_for_day": """
        select '2024-01-15' as usage_date, cast(sum(credits_used) as double) as total_credits_used
        from metering_history
        where start_time >= date '2024-01-15' and start_time < date '2024-01-16'""",
    "usage_by_warehouse_for_day": """
        select warehouse_name, cast(sum(credits_used) as double) as credits_used
        from metering_history
        where start_time >= date '2024-01-15' and start_time < date '2024-01-16'
        group by warehouse_name order by credits_used desc nulls first""",
    "usage_since_day": """
        select warehouse_name, cast(sum(credits_used) as double) as credits_used_today
        from metering_history where warehouse_name = 'click' and start_time >= date '2024-01-15'
        group by warehouse_name""",
    "usage_by_day": """
        select cast(cast(start_time as date) as varchar) as usage_date, warehouse_name,
               cast(sum(credits_used) as double) as credits_used
        from metering_history where warehouse_name = 'click'
        group by 1, 2 order by usage_date desc nulls first""",
    "usage_by_warehouse": """
        select warehouse_name, cast(sum(credits_used) as double) as total_credits_used
        from metering_history where warehouse_name = 'click' group by warehouse_name""",
    "usage_quota_breach": """
        select cast(d.usage_date as varchar) as usage_date, d.warehouse_name,
               cast(d.credits_used as double) as credits_used,
               cast(sum(h.credits_used) as double) as cumulative_credits,
               sum(h.credits_used) >= 5000 as breached
        from (select cast(start_time as date) as usage_date, warehouse_name,
                     sum(credits_used) as credits_used
              from metering_history group by 1, 2) d
        join (select cast(start_time as date) as usage_date, warehouse_name,
                     sum(credits_used) as credits_used
              from metering_history group by 1, 2) h
          on h.warehouse_name = d.warehouse_name and h.usage_date <= d.usage_date
        group by d.usage_date, d.warehouse_name, d.credits_used""",
    # Change capture.
    "cdc_changes": """
        select pk, cast(val as double) as val, seq, op
        from changelog cross join positions where seq > since""",
    "cdc_net_changes": """
        select o.pk, cast(o.val as double) as val, 'DELETE' as action, n.pk is not null as is_update
        from old_state o left join new_state n on o.pk = n.pk
        where n.pk is null or n.val is distinct from o.val
        union all
        select n.pk, cast(n.val as double) as val, 'INSERT' as action, o.pk is not null as is_update
        from new_state n left join old_state o on o.pk = n.pk
        where o.pk is null or n.val is distinct from o.val""",
    "cdc_net_row_changes": """
        select pk, cast(val as double) as val,
               case when sum(n) > 0 then 'INSERT' else 'DELETE' end as action,
               false as is_update, cast(abs(sum(n)) as bigint) as row_count
        from (select pk, val, -1 as n from old_state union all select pk, val, 1 from last_state)
        group by pk, val having sum(n) <> 0""",
    "mv_logged_sums": """
        select pk % 10 as bucket, cast(sum(val) as double) as total from last_state group by pk % 10""",
    "cdc_apply_changes": "select pk, cast(val as double) as val from last_state",
    "cdc_pending_count": """
        select count(*) as pending_changes from changelog cross join positions where seq > since""",
    "cdc_fact_load": """
        select order_id, customer_id, product_id, store_id, qty,
               cast(price as double) as sales_amount, cast(order_date as varchar) as order_date
        from order_log
        where op <> 'DELETE' and seq > (
            select coalesce(max(seq), -1) from order_log
            where commit_ts < timestamp '1998-07-01')""",
    "time_travel_as_of": """
        select pk, cast(val as double) as val from (
            select *, row_number() over (partition by pk order by seq desc) as rn
            from changelog
            where commit_ts <= timestamp '2024-01-20 00:00:00' - interval 3600 second)
        where rn = 1 and op <> 'DELETE'""",
    # Through files.
    "csv_load_orders": f"select {_ORDERS} from crm_orders",
    "csv_load_rejects": """
        select case when o_orderstatus = 'P' then 'amount is not a decimal(18,2): pending'
                    else 'loaded' end as outcome, count(*) as row_count
        from orders group by 1""",
    "ingest_stream_orders": f"select {_ORDERS} from crm_orders",
    "task_fact_load": """
        select order_id, customer_id, product_id, store_id, qty,
               cast(price as double) as sales_amount, cast(order_date as varchar) as order_date
        from order_log where op <> 'DELETE'""",
    "task_enrich_transactions": f"select {_RAW}, month_name, year from transactions",
    "refresh_sales_summary": """
        select product_id, cast(sum(sales_amount) as double) as total_sales
        from retail_lines group by product_id""",
    "clustered_sales_on_date": f"select {_FACT} from fact_sales where order_date = '2000-01-01'",
    "reconcile_counts": """
        select table_name, raw_rows, staging_rows, raw_rows - staging_rows as diff from (
            select 'raw_orders' as table_name, (select count(*) from order_log) as raw_rows,
                   (select count(*) from order_log where op <> 'DELETE') as staging_rows
            union all
            select 'changelog', (select count(*) from changelog), (select count(*) from last_state))
        """,
    "limit_sample_check": """
        select cast(least(10, count(*)) as bigint) as sampled, cast(0 as bigint) as no_facts
        from retail_lines""",
    # Tables, tasks and files that the others do not reach.
    "csv_null_tokens": """
        select order_id, customer_id, case when order_id % 3 = 0 then null
               else cast(amount as double) end as amount, cast(order_date as varchar) as order_date
        from crm_orders""",
    "csv_named_file": f"select {_ORDERS} from crm_orders where order_id % 2 = 0",
    "csv_listed_files": "select 'day.csv' as drop_name, true as has_bytes union all select 'day.csv.old', true",
    "table_created_like": f"""
        select {_ORDERS} from crm_orders where amount >= 200000
        union all select -1, 7, 250000.5, '2000-01-01'""",
    "table_emptied": "select cast(0 as bigint) as rows_left, count(*) as rows_logged from crm_orders",
    "cloned_tables": """
        select 'crops' as table_name, count(*) as raw_rows, count(*) as staging_rows, 0 as diff from crop_data
        union all select 'soil', count(*), count(*), 0 from soil_data""",
    "masked_table_read": """
        select customer_id, customer_name, '*****' as email, city from dim_customers""",
    "task_run_history": """
        select 'loader' as name, 'SUCCEEDED' as state, 1 as runs
        union all select 'loader', 'SKIPPED', 1""",
    "summary_appended_twice": """
        select name, cast(2 * sum(total_spent) as double) as total_spent from spend group by name""",
    "pipeline_listing": """
        select 'orders' as name, 'TABLE' as kind union all select 'orders_view', 'VIEW'""",
    "report_frame": """
        select product_id, cast(sum(sales_amount) as double) as total_sales
        from retail_lines group by product_id""",
    "agri_kpi_refreshed": """
        select district, cast(total_production as double) as total_production,
               round(avg_rainfall, 6) as avg_rainfall,
               cast(total_farmers as bigint) as total_farmers from agri_kpi""",
    "mv_customer_stored": "select name, cast(total_spent as double) as total_spent from spend",
    "ingest_two_checkpoints": f"select {_ORDERS} from crm_orders",
    "reconcile_stored_copies": """
        select 'crop_data' as table_name, count(*) as raw_rows, count(*) as staging_rows, 0 as diff
        from crop_data
        union all select 'rainfall_data', count(*), count(*), 0 from rainfall_data
        union all select 'soil_data', count(*), count(*), 0 from soil_data
        union all select 'fertilizer_data', count(*), count(*), 0 from fertilizer_data
        union all select 'farmer_data', count(*), count(*), 0 from farmer_data""",
}


def _with_adapters(body: str) -> str:
    """The query with the adapters it names, and those they name, in front as CTEs."""
    needed: dict[str, str] = {}

    def collect(sql: str) -> None:
        for name in re.findall(r"(?:from|join)\s+(\w+)", sql):
            if name in ADAPTERS and name not in needed:
                collect(ADAPTERS[name])
                needed[name] = ADAPTERS[name]

    collect(body)
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in needed.items())
    return f"with {ctes}\n{body}" if ctes else body


_BODIES["cdc_net_changes_from_base"] = _BODIES["cdc_net_changes"]
_BODIES["csv_load_aborted"] = f"select {_ORDERS} from crm_orders where order_date < date '1998-07-01'"
_BODIES["reconcile_content"] = """
    select order_id, customer_id, cast(amount as double) as amount, cast(order_date as varchar) as order_date,
           cast(1 as bigint) as left_rows, cast(0 as bigint) as right_rows from crm_orders where order_id % 997 = 0
    union all select order_id, customer_id, cast(amount + 1 as double), cast(order_date as varchar), 0, 1
    from crm_orders where order_id % 997 = 0"""
_BODIES["count_rows_from_footers"] = "select count(*) as row_count from lineitem"
_BODIES["masked_view_by_role"] = """
    select 'none' as reader, customer_id, customer_name, '*****' as email, city from dim_customers
    union all select 'unmasked', customer_id, customer_name, email, city from dim_customers"""
_BODIES["mask_functions"] = """
    select customer_id, case when role = 'ACCOUNTADMIN' then cast(customer_id as varchar) else '*****' end as shown_id, role,
           cast(sum(case when role = 'ACCOUNTADMIN' then amount else 0 end) as double) as total_spent
    from crm_orders cross join (values ('ACCOUNTADMIN'), ('ANALYST')) as roles(role) group by customer_id, role"""
_BODIES["task_history_function"] = """
    select 'loader' as task, cast(0 as bigint) as run, count(*) as row_count from crm_orders where order_date < date '1998-07-01'
    union all select 'loader', 1, count(*) from crm_orders where not order_date < date '1998-07-01'"""
_BODIES["district_summary_maintained"] = _BODIES["district_summary"]
_BODIES["agri_kpi_maintained"] = _BODIES["agri_kpi"]


def oracle_sql() -> dict[str, str]:
    return {name: _with_adapters(body) for name, body in _BODIES.items()}

"""DuckDB SQL that states what every registered query must return.

``TABLES`` are common table expressions, each naming the ones it builds on; ``ANSWERS``
are the final selects. ``oracle(name)`` puts the needed tables in front of an answer.
Sums of money and ratios add decimals, and every NTILE and LIMIT has a tie-break, so that
the answers do not depend on row order.
"""

from __future__ import annotations

import re

# ------------------------------------------------------------------ raw tables
TABLES = {
    "raw_orders": """
        select o_orderkey as order_id, o_orderkey as customer_id,
               case o_orderkey % 50 when 0 then 'canceled' when 1 then 'unavailable'
                    when 2 then 'shipped' when 3 then 'processing' else 'delivered' end as order_status,
               o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as purchase_ts,
               o_orderdate + interval 1 day as approved_ts,
               o_orderdate + interval 2 day as carrier_ts,
               case when o_orderkey % 50 > 3 and o_orderkey % 97 <> 0
                    then o_orderdate + to_days((4 + (o_orderkey * 7919) % 31
                         + case when o_orderkey % 211 = 0 then 60 else 0 end)::int) end as delivered_ts,
               o_orderdate + to_days((20 + o_orderkey % 10)::int) as estimated_ts
        from orders""",
    "raw_customers": """
        select o_orderkey as customer_id,
               case when o_orderkey % 3 = 0 then o_custkey else 1000000 + o_orderkey end as person,
               (o_custkey % 510)::int as zip, 'CITY_' || (o_orderkey % 40) as city, n_name as state
        from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey""",
    "raw_items": """
        select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
               l_suppkey as seller_id, l_extendedprice as price,
               l_extendedprice * l_tax * l_linenumber as freight_value
        from lineitem""",
    "raw_payments": """
        select l_orderkey as order_id,
               case l_linenumber % 4 when 0 then 'voucher' when 1 then 'credit_card'
                    when 2 then 'boleto' else 'debit_card' end as payment_type,
               ((l_linenumber * 3) % 10 + 1)::int as installments, l_extendedprice as payment_value
        from lineitem""",
    "raw_reviews": """
        select event_id // 2 as order_id, (1 + (event_id * 31 // 7) % 5)::int as score,
               case event_id % 5 when 0 then null when 1 then '' else props end as message
        from events""",
    "raw_sellers": """
        select s_suppkey as seller_id, (s_suppkey % 510)::int as zip,
               'CITY_' || (s_suppkey % 40) as city,
               'NATION_' || (case when s_nationkey < 20 then s_nationkey else s_nationkey - 20 end) as state
        from supplier""",
    "raw_products": """
        select p_partkey as product_id, case when p_partkey % 13 <> 0 then p_type end as category_pt,
               length(p_name)::int as name_length, (p_size * 10 + p_partkey % 7)::int as description_length,
               (p_partkey % 7)::int as photos_qty, (p_size * 100 + p_partkey % 7)::int as weight_g,
               p_size as length_cm, (p_size + p_partkey % 7)::int as height_cm,
               (p_partkey % 7 + 1)::int as width_cm
        from part""",
    "raw_geo": """
        select (c_custkey % 500)::int as zip, ('-' || (29 - c_nationkey) || '.' || lpad((c_custkey * 123456789 % 1000000000000)::varchar, 12, '0'))::double as lat,
               -70.0::double + c_nationkey as lng
        from customer""",
    "raw_translation": """
        select distinct p_type as category_pt, case when p_type <> 'PROMO' then lower(p_type) || '_goods' end as category_en
        from part""",
    # -------------------------------------------------------------- warehouse
    "dim_date": """
        select (year(d) * 10000 + month(d) * 100 + day(d))::int as date_key, d as date,
               year(d)::int as year, month(d)::int as month, day(d)::int as day,
               strftime(d, '%B') as month_name, quarter(d)::int as quarter,
               dayofweek(d)::int as day_of_week, strftime(d, '%A') as day_name,
               dayofweek(d) in (0, 6) as is_weekend
        from (select unnest(range(date '1995-01-01', date '2001-01-01', interval 1 day))::date as d)""",
    "geo_zip_centroid": """
        select zip as zip_code,
               sum(lat::decimal(20,12))::double / count(lat) as lat,
               sum(lng::decimal(20,12))::double / count(lng) as lng
        from raw_geo group by zip""",
    "dim_customers": """
        select person as customer_key, customer_id, c.zip as zip_code, city, state, lat, lng
        from (select *, row_number() over (partition by person order by customer_id desc) as nth
              from raw_customers) c
        left join geo_zip_centroid g on g.zip_code = c.zip
        where nth = 1""",
    "dim_sellers": """
        select seller_id as seller_key, s.zip as zip_code, city, state, lat, lng
        from raw_sellers s left join geo_zip_centroid g on g.zip_code = s.zip""",
    "dim_products": """
        select product_id as product_key, coalesce(category_en, category_pt, 'unknown') as category,
               category_pt, name_length, description_length, photos_qty, weight_g,
               length_cm, height_cm, width_cm, length_cm::bigint * height_cm * width_cm as volume_cm3
        from raw_products left join raw_translation using (category_pt)""",
    "payment_agg": """
        select order_id, sum(payment_value::decimal(18,4))::double as total_payment,
               max(installments) as max_installments,
               string_agg(distinct payment_type, ',' order by payment_type) as payment_types
        from raw_payments group by order_id""",
    "review_agg": """
        select order_id, avg(score)::decimal(3,2) as avg_review_score,
               bool_or(message is not null and message <> '') as has_review_comment
        from raw_reviews group by order_id""",
    "fact_orders": """
        select o.order_id, c.person as customer_key,
               strftime(purchase_ts, '%Y%m%d')::int as purchase_date_key, order_status,
               purchase_ts as purchased_at, approved_ts as approved_at, carrier_ts as shipped_at,
               delivered_ts as delivered_at, estimated_ts as estimated_delivery_at,
               datediff('day', estimated_ts, delivered_ts)::int as delivery_delay_days,
               coalesce(total_payment, 0) as total_payment, max_installments, payment_types,
               avg_review_score, coalesce(has_review_comment, false) as has_review_comment
        from raw_orders o join raw_customers c using (customer_id)
        left join payment_agg using (order_id) left join review_agg using (order_id)""",
    "fact_order_items": """
        select order_id, order_item_id, product_id as product_key, seller_id as seller_key,
               customer_key, purchase_date_key, purchased_at, price, freight_value,
               price + freight_value as total_item_value,
               round(freight_value / nullif(price + freight_value, 0), 4) as freight_ratio,
               avg_review_score, delivery_delay_days, order_status
        from raw_items join fact_orders using (order_id)""",
    "sold": "select * from fact_orders where order_status not in ('canceled', 'unavailable')",
    # -------------------------------------------------------------- marts
    "rfm_snapshot_date": "select max(purchased_at)::date + 1 as ref_date from fact_orders",
    "rfm_customer_orders": """
        select customer_key, city, state, lat, lng, count(distinct order_id) as frequency,
               sum(total_payment::decimal(18,4))::double as monetary,
               max(purchased_at::date) as last_order_date, min(purchased_at::date) as first_order_date,
               ((select ref_date from rfm_snapshot_date) - max(purchased_at::date))::int as recency_days,
               sum(avg_review_score)::double / count(avg_review_score) as avg_review_score,
               sum(delivery_delay_days)::double / count(delivery_delay_days) as avg_delivery_delay,
               count(*) filter (order_status = 'delivered') as delivered_count
        from sold join dim_customers using (customer_key)
        group by all""",
    "rfm_scores": """
        select *, ntile(5) over (order by recency_days, customer_key)::int as r_score,
               ntile(5) over (order by frequency desc, customer_key)::int as f_score,
               ntile(5) over (order by monetary desc, customer_key)::int as m_score
        from rfm_customer_orders""",
    "rfm_segment": """
        select *, round((r_score + f_score + m_score) / 3.0, 2) as rfm_score,
               case when r_score >= 4 and f_score >= 4 then 'Champion'
                    when r_score >= 3 and f_score >= 3 then 'Loyal'
                    when r_score >= 4 and f_score <= 2 then 'Promising'
                    when r_score <= 2 and f_score >= 3 then 'At Risk'
                    when r_score <= 2 and f_score <= 2 and monetary >= 200000 then 'Cant Lose'
                    when r_score <= 1 then 'Lost'
                    else 'Needs Attention' end as segment
        from rfm_scores""",
    "customer_rfm": """
        select *, round(monetary * frequency
                  / nullif(datediff('month', first_order_date, last_order_date) + 1, 0) * 12, 2)
                  as annualised_clv
        from rfm_segment""",
    "monthly_sales": """
        select year, month, month_name, date_trunc('month', purchased_at)::date as month_start,
               count(distinct order_id) as total_orders, count(distinct customer_key) as unique_customers,
               round(sum(total_payment::decimal(18,4))::double, 2) as total_revenue,
               round(sum(total_payment::decimal(18,4))::double / count(total_payment), 2) as avg_order_value,
               round(sum(avg_review_score)::double / count(avg_review_score), 2) as avg_review_score,
               count(*) filter (delivery_delay_days > 0) as late_deliveries,
               count(*) filter (order_status = 'delivered') as delivered_orders
        from sold join dim_date on purchase_date_key = date_key
        where year between 1997 and 1998
        group by 1, 2, 3, 4""",
    "category_performance": """
        select category, count(distinct order_id) as total_orders, count(order_item_id) as units_sold,
               round(sum(price::decimal(18,4))::double, 2) as total_revenue,
               round(sum(price::decimal(18,4))::double / count(price), 2) as avg_price,
               round(sum(freight_ratio::decimal(18,4))::double / count(freight_ratio), 3) as avg_freight_ratio,
               round(sum(avg_review_score)::double / count(avg_review_score), 2) as avg_review_score,
               round(sum(delivery_delay_days)::double / count(delivery_delay_days), 2) as avg_delivery_delay,
               count(distinct seller_key) as seller_count
        from fact_order_items join dim_products using (product_key)
        where order_status not in ('canceled', 'unavailable')
        group by category""",
    "delivery_by_state": """
        select state as customer_state, count(distinct fo.order_id) as total_orders,
               round(sum(fo.delivery_delay_days)::double / count(fo.delivery_delay_days), 2) as avg_delay_days,
               count(*) filter (fo.delivery_delay_days > 0) as late_count,
               round(100.0 * count(*) filter (fo.delivery_delay_days > 0) / count(*), 1) as late_pct,
               round(sum(fo.avg_review_score)::double / count(fo.avg_review_score), 2) as avg_review_score,
               round(sum(freight_ratio::decimal(18,4))::double / count(freight_ratio), 3) as avg_freight_ratio,
               round(sum(freight_value::decimal(18,4))::double / count(freight_value), 2) as avg_freight_value
        from fact_orders fo join dim_customers using (customer_key)
        join fact_order_items fi on fi.order_id = fo.order_id
        where fo.order_status = 'delivered'
        group by state""",
    "satisfaction_vs_delivery": """
        select avg_review_score::int as review_score,
               case when delivery_delay_days <= -14 then 'Very Early (>14d)'
                    when delivery_delay_days <= -7 then 'Early (7-14d)'
                    when delivery_delay_days <= 0 then 'On Time (0-7d early)'
                    when delivery_delay_days <= 7 then 'Late (1-7d)'
                    else 'Very Late (>7d)' end as delivery_bucket,
               count(*) as order_count,
               round(100.0 * count(*) / sum(count(*)) over (partition by avg_review_score::int), 1) as pct_of_score
        from fact_orders
        where order_status = 'delivered' and avg_review_score is not null and delivery_delay_days is not null
        group by 1, 2""",
    "data_quality": """
        select 'fact_orders' as table_name, count(*) as total_rows,
               count(*) filter (order_status in ('canceled', 'unavailable')) as excluded_status,
               count(*) filter (total_payment = 0) as zero_payment,
               count(*) filter (avg_review_score is null) as missing_review,
               count(*) filter (delivery_delay_days is null) as missing_delay,
               count(*) filter (delivered_at is null and order_status = 'delivered') as missing_delivery_ts,
               count(*) filter (order_status = 'delivered') as clean_delivered
        from fact_orders
        union all
        select 'fact_order_items', count(*), count(*) filter (order_status in ('canceled', 'unavailable')),
               count(*) filter (price = 0), 0, 0, 0, count(*) filter (order_status = 'delivered')
        from fact_order_items""",
    "paid": """
        select order_id, total_payment, customer_key, purchased_at from fact_orders
        where order_status = 'delivered' and total_payment > 0""",
    "paid_fences": """
        select *, q3 - q1 as iqr, q1 - 1.5::double * (q3 - q1) as low, q3 + 1.5::double * (q3 - q1) as high
        from (select quantile_cont(total_payment, 0.25) as q1, quantile_cont(total_payment, 0.75) as q3,
                     sum(total_payment::decimal(18,4))::double / count(*) as mean,
                     stddev_samp(total_payment) as std, count(*) as n from paid)""",
    "payment_outliers": """
        select order_id, total_payment, customer_key, purchased_at, round(q1, 2) as q1, round(q3, 2) as q3,
               round(iqr, 2) as iqr, round(low, 2) as lower_fence, round(high, 2) as upper_fence,
               round(mean, 2) as mean_payment, round(std, 2) as std_payment, n as total_orders,
               case when total_payment > high then 'high_outlier' else 'low_outlier' end as outlier_flag,
               round((total_payment - mean) / nullif(std, 0), 2) as z_score
        from paid, paid_fences where total_payment > high or total_payment < low""",
    "arrived": """
        select order_id, delivery_delay_days, customer_key, purchased_at, avg_review_score from fact_orders
        where order_status = 'delivered' and delivery_delay_days is not null""",
    "arrived_fences": """
        select *, q1 - 1.5::double * (q3 - q1) as low, q3 + 1.5::double * (q3 - q1) as high
        from (select quantile_cont(delivery_delay_days, 0.25) as q1, quantile_cont(delivery_delay_days, 0.75) as q3,
                     avg(delivery_delay_days) as mean, stddev_samp(delivery_delay_days) as std from arrived)""",
    "delivery_outliers": """
        select order_id, delivery_delay_days, customer_key, purchased_at, avg_review_score,
               round(low, 2) as lower_fence, round(high, 2) as upper_fence,
               case when delivery_delay_days > high then 'extreme_late' else 'extreme_early' end as outlier_flag,
               round((delivery_delay_days - mean) / nullif(std, 0), 2) as z_score
        from arrived, arrived_fences where delivery_delay_days > high or delivery_delay_days < low""",
    # -------------------------------------------------------------- risks
    "risk_churn": """
        select 'Customer Churn' as risk_category,
               'High proportion of one-time buyers (97%) with valuable at-risk segments' as description,
               count(*) filter (segment in ('At Risk', 'Cant Lose')) as affected_count,
               round(100.0 * count(*) filter (segment in ('At Risk', 'Cant Lose')) / count(*), 1) as affected_pct,
               round((sum(monetary::decimal(18,4)) filter (segment in ('At Risk', 'Cant Lose')))::double, 0)
                   as revenue_at_risk,
               'High' as likelihood, 'High' as impact,
               'Loyalty programme, personalised re-engagement, subscription bundles' as mitigation
        from customer_rfm""",
    "risk_delivery": """
        select 'Delivery Failure' as risk_category,
               'Late deliveries correlated with 1-star reviews; concentrated in non-SP states' as description,
               sum(late_count)::bigint as affected_count,
               round(sum(late_pct::decimal(18,4))::double / count(late_pct), 1) as affected_pct,
               null::double as revenue_at_risk, 'Medium' as likelihood, 'High' as impact,
               'Realistic ETA communication, regional carrier diversification' as mitigation
        from delivery_by_state""",
    "risk_geo": """
        select 'Geographic Concentration' as risk_category,
               'Seller base heavily concentrated in Sao Paulo; underserved states face high freight' as description,
               count(*) filter (customer_state <> 'NATION_0') as affected_count,
               round(100.0 * count(*) filter (customer_state <> 'NATION_0') / count(*), 1) as affected_pct,
               null::double as revenue_at_risk, 'Medium' as likelihood, 'Medium' as impact,
               'Recruit sellers in AM, RR, AP, PA to reduce freight disparity' as mitigation
        from delivery_by_state""",
    "risk_payment": """
        select 'Payment Anomaly' as risk_category,
               'Extreme payment values detected via IQR — potential fraud or data error' as description,
               count(*) as affected_count, null::double as affected_pct,
               round((sum(total_payment::decimal(18,4)) filter (outlier_flag = 'high_outlier'))::double, 0)
                   as revenue_at_risk,
               'Low' as likelihood, 'Medium' as impact,
               'Payment value caps, automated fraud rules, manual review queue' as mitigation
        from payment_outliers""",
    "risk_register": """
        select * from risk_churn union all select * from risk_delivery
        union all select * from risk_geo union all select * from risk_payment""",
    "risk_scored": """
        select *, case when risk_score >= 6 then 'High' when risk_score >= 3 then 'Medium' else 'Low' end as risk_level
        from (select *, (case likelihood when 'High' then 3 when 'Medium' then 2 else 1 end
                         * case impact when 'High' then 3 when 'Medium' then 2 else 1 end)::int as risk_score
              from risk_register)""",
    # -------------------------------------------------------------- reports
    "kpi_summary": """
        select count(distinct order_id) as total_orders, count(distinct customer_key) as unique_customers,
               round(sum(total_payment::decimal(18,4))::double, 0) as total_revenue,
               round(sum(total_payment::decimal(18,4))::double / count(*), 2) as avg_order_value,
               round(sum(avg_review_score)::double / count(avg_review_score), 2) as avg_review_score,
               round(avg(delivery_delay_days), 2) as avg_delivery_delay,
               round(abs(avg(delivery_delay_days)), 2) as avg_days_early,
               count(*) filter (delivery_delay_days > 0) as late_orders
        from sold""",
    "repeat_purchase": """
        select count(*) filter (frequency > 1) as repeat_buyers, count(*) as total_customers,
               round(100.0 * count(*) filter (frequency > 1) / count(*), 1) as repeat_pct,
               round((sum(monetary::decimal(18,4)) filter (frequency = 1))::double
                     / count(*) filter (frequency = 1), 2) as avg_onetime,
               round((sum(monetary::decimal(18,4)) filter (frequency > 1))::double
                     / count(*) filter (frequency > 1), 2) as avg_repeat
        from customer_rfm""",
    "segment_counts": """
        select segment, count(*) as n, sum(monetary::decimal(18,4))::double as revenue from customer_rfm group by segment""",
    "geo_opportunity": """
        select c.state, customers, coalesce(sellers, 0) as sellers,
               round(customers::double / nullif(coalesce(sellers, 0), 0), 1) as customers_per_seller
        from (select state, count(*) as customers from dim_customers group by state) c
        left join (select state, count(*) as sellers from dim_sellers group by state) s on s.state = c.state""",
    "sellers_by_state": "select state, count(distinct seller_key) as seller_count from dim_sellers group by state",
    "state_map": """
        select customer_state as state, total_orders, avg_delay_days, late_count, late_pct, avg_review_score,
               avg_freight_value, coalesce(seller_count, 0) as seller_count,
               round_even(total_orders::double / greatest(coalesce(seller_count, 0), 1) * 10, 0) / 10 as cs_ratio,
               customer_state as state_name, 0.0::double as lat, 0.0::double as lng
        from delivery_by_state left join sellers_by_state on state = customer_state""",
    "delivery_review_pivot": """
        select case delivery_bucket when 'Very Early (>14d)' then 1 when 'Early (7-14d)' then 2
                    when 'On Time (0-7d early)' then 3 when 'Late (1-7d)' then 4 else 5 end as bucket_order,
               delivery_bucket,
               coalesce(sum(order_count) filter (review_score = 1), 0)::bigint as score_1,
               coalesce(sum(order_count) filter (review_score = 2), 0)::bigint as score_2,
               coalesce(sum(order_count) filter (review_score = 3), 0)::bigint as score_3,
               coalesce(sum(order_count) filter (review_score = 4), 0)::bigint as score_4,
               coalesce(sum(order_count) filter (review_score = 5), 0)::bigint as score_5
        from satisfaction_vs_delivery group by delivery_bucket""",
}

# ------------------------------------------------------------------ checks
CHECKS = {
    "no_null_order_id": (
        "select count(*) from fact_orders where order_id is null",
        "fact_orders.order_id must never be null",
    ),
    "no_null_customer_key": (
        "select count(*) from fact_orders where customer_key is null",
        "Every order must link to a customer",
    ),
    "no_null_product_key": (
        "select count(*) from fact_order_items where product_key is null",
        "Every item must link to a product",
    ),
    "no_null_purchase_date": (
        "select count(*) from fact_orders where purchased_at is null",
        "All orders must have a purchase timestamp",
    ),
    "no_duplicate_orders": (
        "select count(*) from (select order_id from fact_orders group by 1 having count(*) > 1)",
        "Each order_id must appear exactly once in fact_orders",
    ),
    "no_duplicate_customers": (
        "select count(*) from (select customer_key from dim_customers group by 1 having count(*) > 1)",
        "Each customer_unique_id must appear once in dim_customers",
    ),
    "no_duplicate_products": (
        "select count(*) from (select product_key from dim_products group by 1 having count(*) > 1)",
        "Each product_id must appear once in dim_products",
    ),
    "items_orders_fk": (
        "select count(*) from fact_order_items i where not exists"
        " (select 1 from fact_orders o where o.order_id = i.order_id)",
        "All order items must reference a valid order",
    ),
    "items_product_fk": (
        "select count(*) from fact_order_items i where not exists"
        " (select 1 from dim_products p where p.product_key = i.product_key)",
        "All order items must reference a valid product",
    ),
    "items_seller_fk": (
        "select count(*) from fact_order_items i where not exists"
        " (select 1 from dim_sellers s where s.seller_key = i.seller_key)",
        "All order items must reference a valid seller",
    ),
    "orders_date_fk": (
        "select count(*) from fact_orders where purchase_date_key is not null"
        " and purchase_date_key not in (select date_key from dim_date)",
        "All purchase dates must exist in dim_date",
    ),
    "no_negative_price": (
        "select count(*) from fact_order_items where price < 0",
        "Item prices must be non-negative",
    ),
    "no_negative_freight": (
        "select count(*) from fact_order_items where freight_value < 0",
        "Freight values must be non-negative",
    ),
    "no_negative_payment": (
        "select count(*) from fact_orders where total_payment < 0",
        "Order payments must be non-negative",
    ),
    "review_score_range": (
        "select count(*) from fact_orders where avg_review_score not between 1 and 5",
        "Review scores must be between 1 and 5",
    ),
    "freight_ratio_range": (
        "select count(*) from fact_order_items where freight_ratio not between 0 and 1",
        "Freight ratio must be between 0 and 1",
    ),
    "delivery_before_purchase": (
        "select count(*) from fact_orders where delivered_at < purchased_at",
        "Delivery date cannot be before purchase date",
    ),
}


def _check_row(name: str) -> str:
    count, description = CHECKS[name]
    return (
        f"select case when violations = 0 then 'PASS' else 'FAIL' end as status, '{name}' as \"check\","
        f" violations, '{description}' as description from (select ({count}) as violations)"
    )


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(f"select '{n}' as table_name, count(*) as n from {t}" for n, t in tables.items())


WAREHOUSE = ["dim_date", "dim_customers", "dim_sellers", "dim_products", "fact_orders", "fact_order_items"]
MARTS = [
    "customer_rfm", "monthly_sales", "category_performance", "delivery_by_state",
    "satisfaction_vs_delivery", "data_quality", "payment_outliers", "delivery_outliers", "risk_register",
]

# ------------------------------------------------------------------ answers
AS_TABLE = [
    "dim_date", "dim_customers", "geo_zip_centroid", "dim_sellers", "dim_products", "payment_agg",
    "rfm_snapshot_date", "rfm_customer_orders", "rfm_scores", "rfm_segment", "customer_rfm", "monthly_sales",
    "category_performance", "delivery_by_state", "satisfaction_vs_delivery", "data_quality",
    "payment_outliers", "risk_register", "risk_churn", "risk_delivery", "risk_geo", "risk_payment",
    "risk_scored", "kpi_summary", "repeat_purchase", "geo_opportunity", "sellers_by_state", "state_map",
    "delivery_review_pivot",
]

MONTH_LABEL = "year || '-' || lpad(month::varchar, 2, '0')"
# Categories have no apostrophes: every letter after a space or underscore is a capital.
TITLE = (
    "array_to_string(list_transform(string_split(replace({0}, '_', ' '), ' '),"
    " lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)
TOP_CATEGORIES = (
    "select category, total_revenue, units_sold, avg_price, avg_freight_ratio, avg_review_score"
    " from category_performance order by total_revenue desc, category limit {0}"
)
FUNNEL = """
    select stage_order::int as stage_order, stage, n, 100.0::double * n / total_rows as pct_of_raw
    from (select total_rows, unnest([1, 2, 3, 4, 5]) as stage_order,
                 unnest(['Raw orders', 'After status exclusion', 'Clean delivered orders',
                         'Excluded by status filter', 'Zero-value payments']) as stage,
                 unnest([total_rows, total_rows - excluded_status, clean_delivered,
                         excluded_status, zero_payment]) as n
          from data_quality where table_name = 'fact_orders')"""

# The payment lines field by field, and what is wrong with the first field that is.
PAYMENT_LINES = """with
    lines as (select list_filter([l_orderkey::varchar, if(l_orderkey % 31 = 0, 'first', l_linenumber::varchar), 'boleto',
                 if(l_orderkey % 37 = 0, null, '1'), if(l_orderkey % 41 = 0, 'n/a', l_partkey::varchar),
                 if(l_orderkey % 43 = 0, 'more', null)], lambda x: x is not null) as f from lineitem),
    judged as (select f, case
        when f[2] is not null and try_cast(f[2] as int) is null then 'payment_sequential: no int: ' || f[2]
        when f[4] is not null and try_cast(f[4] as int) is null then 'payment_installments: no int: ' || f[4]
        when f[5] is not null and try_cast(f[5] as double) is null then 'payment_value: no double: ' || f[5]
        when len(f) <> 5 then 'not 5 fields' end as reason from lines)"""

ANSWERS = {name: f"select * from {name}" for name in AS_TABLE} | {
    "stage_tables": _counts(
        {
            "orders": "raw_orders",
            "order_items": "raw_items",
            "order_payments": "raw_payments",
            "order_reviews": "raw_reviews",
            "customers": "raw_customers",
            "sellers": "raw_sellers",
            "products": "raw_products",
            "geolocation": "raw_geo",
            "category_translation": "raw_translation",
        }
    ),
    "load_multiline_csv": """
        select doc_id::varchar as review_id, (doc_id // 2)::varchar as order_id, (1 + doc_id % 5)::int as review_score,
               source as review_comment_title, length(nullif(text, ''))::int as n_chars, md5(nullif(text, '')) as message_md5,
               strftime(date '2018-01-01' + (doc_id % 365)::int, '%Y-%m-%d') as created
        from documents""",
    "load_accepted": f"{PAYMENT_LINES} select f[1] as order_id, f[2]::int as payment_sequential, f[4]::int as payment_installments, f[5]::double as payment_value from judged where reason is null",
    "load_rejects": f"{PAYMENT_LINES} select 'payments' as table_name, array_to_string(f, ',') as record, reason from judged where reason is not null",
    "load_counts": f"""{PAYMENT_LINES}
        select 'payments' as table_name, count(*) filter (reason is null) as accepted, count(reason) as rejected from judged
        union all select 'reviews', count(*), 0 from documents""",
    "row_counts": _counts({t: t for t in WAREHOUSE}),
    "mart_row_counts": _counts({t: t for t in MARTS}),
    "review_agg": "select * replace (avg_review_score::double as avg_review_score) from review_agg",
    "fact_orders": "select * replace (avg_review_score::double as avg_review_score) from fact_orders",
    "fact_order_items": "select * replace (avg_review_score::double as avg_review_score) from fact_order_items",
    "delivery_outliers": "select * replace (avg_review_score::double as avg_review_score) from delivery_outliers",
    "annualised_clv": "select customer_key, annualised_clv from customer_rfm",
    "quality_report": " union all ".join(_check_row(name) for name in CHECKS),
    "quality_summary": f"""
        select count(*) filter (status = 'PASS') as passed, count(*) filter (status = 'FAIL') as failed,
               count(*) as total, count(*) filter (status = 'FAIL') = 0 as all_passed
        from ({" union all ".join(_check_row(name) for name in CHECKS)})""",
    "repeat_revenue_share": """
        select *, 100.0::double * repeat_revenue / total_revenue as repeat_revenue_pct
        from (select coalesce((sum(monetary::decimal(18,4)) filter (frequency > 1))::double, 0) as repeat_revenue,
                     sum(monetary::decimal(18,4))::double as total_revenue from customer_rfm)""",
    "churn_pct": "select round(100.0::double - repeat_pct, 1) as churn_pct from repeat_purchase",
    "segment_share": "select segment, n, round(100.0 * n / sum(n) over (), 1) as pct from segment_counts",
    "segment_share_spend": """
        select segment, n, round(100.0 * n / sum(n) over (), 1) as pct, round(revenue / n, 2) as avg_spend
        from segment_counts""",
    "segment_summary": """
        select segment, n as count, 100.0::double * n / (sum(n) over ())::double as pct, revenue as total_revenue
        from segment_counts""",
    "monthly_trend": f"""
        select {MONTH_LABEL} as month_label, *, round_even(total_revenue, 0) as revenue_rounded,
               total_revenue / 1000 as revenue_thousands
        from monthly_sales""",
    "peak_month": f"""
        select {MONTH_LABEL} as month_label, year, month, month_name, total_orders, total_revenue
        from monthly_sales order by total_revenue desc, year, month limit 1""",
    "total_revenue_period": "select sum(total_revenue::decimal(18,4))::double as total_revenue from monthly_sales",
    "top_categories": TOP_CATEGORIES.format(15),
    "top_categories_5": TOP_CATEGORIES.format(5),
    "category_label": f"select category, {TITLE.format('category')} as label, total_revenue from category_performance",
    "top_states": """
        select customer_state, avg_review_score, avg_delay_days, total_orders, late_pct
        from delivery_by_state order by total_orders desc, customer_state limit 15""",
    "delivery_review_pct": """
        select bucket_order, delivery_bucket, score_1 / total * 100 as score_1, score_2 / total * 100 as score_2,
               score_3 / total * 100 as score_3, score_4 / total * 100 as score_4, score_5 / total * 100 as score_5
        from (select *, (score_1 + score_2 + score_3 + score_4 + score_5)::double as total
              from delivery_review_pivot)""",
    "underserved_states": """
        select * from geo_opportunity where state <> 'NATION_0' and customers >= 400
        order by customers_per_seller desc nulls last, state limit 12""",
    "state_map_bands": """
        select state,
               case when total_orders / top < 0.10 then 1 when total_orders / top < 0.30 then 2
                    when total_orders / top < 0.60 then 3 else 4 end as orders_band,
               case when late_pct < 4 then 1 when late_pct < 8 then 2 when late_pct < 12 then 3
                    when late_pct < 16 then 4 else 5 end as delivery_band,
               case when avg_review_score >= 4.3 then 1 when avg_review_score >= 4.0 then 2
                    when avg_review_score >= 3.7 then 3 when avg_review_score >= 3.4 then 4 else 5 end as review_band,
               case when cs_ratio / top_ratio < 0.15 then 1 when cs_ratio / top_ratio < 0.35 then 2
                    when cs_ratio / top_ratio < 0.60 then 3 else 4 end as opportunity_band
        from (select *, (max(total_orders) over ())::double as top, max(cs_ratio) over () as top_ratio
              from state_map)""",
    "state_map_radius": """
        select state, 8 + total_orders / (max(total_orders) over ())::double * 26 as orders_radius,
               8 + late_pct / 20 * 22 as delivery_radius, 8 + (5 - avg_review_score) / 2 * 20 as review_radius,
               8 + cs_ratio / max(cs_ratio) over () * 26 as opportunity_radius
        from state_map""",
    "state_filter_scatter": """
        select state, avg_delay_days, avg_review_score, late_pct,
               10 + total_orders / (max(total_orders) over ())::double * 28 as marker_size
        from state_map where state in ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8')""",
    "payment_outlier_summary": """
        select q1, q3, iqr, lower_fence, upper_fence, count(*) as total_outliers,
               count(*) filter (outlier_flag = 'high_outlier') as high_outliers,
               count(*) filter (outlier_flag = 'low_outlier') as low_outliers
        from payment_outliers group by all""",
    "delivery_outlier_summary": """
        select lower_fence, upper_fence, count(*) filter (outlier_flag = 'extreme_late') as extreme_late,
               count(*) filter (outlier_flag = 'extreme_early') as extreme_early,
               round((sum(avg_review_score) filter (outlier_flag = 'extreme_late'))::double
                     / nullif(count(avg_review_score) filter (outlier_flag = 'extreme_late'), 0), 2) as late_review,
               round((sum(avg_review_score) filter (outlier_flag = 'extreme_early'))::double
                     / nullif(count(avg_review_score) filter (outlier_flag = 'extreme_early'), 0), 2) as early_review
        from delivery_outliers group by lower_fence, upper_fence""",
    "top_payment_outliers": """
        select order_id, total_payment, z_score, outlier_flag
        from payment_outliers order by total_payment desc, order_id limit 15""",
    "payment_histogram": """
        with capped as (select least(total_payment, 400000) as payment from paid),
             span as (select min(payment) as low, max(payment) as high from capped),
             binned as (select least(floor((payment - low) * 60.0::double / (high - low)), 59)::int as bin,
                               count(*) as n
                        from capped, span group by 1)
        select (b + 1)::int as bin, low + (high - low) * b / 60.0::double as bin_start,
               low + (high - low) * (b + 1) / 60.0::double as bin_end, coalesce(n, 0) as n
        from span, (select unnest(range(60)) as b) left join binned on bin = b""",
    "risk_matrix": """
        select l::int as likelihood, i::int as impact, (l * i)::int as risk_score,
               case when l * i >= 6 then 'High' when l * i >= 3 then 'Medium' else 'Low' end as risk_level,
               risk_category
        from (select unnest([1, 2, 3]) as l), (select unnest([1, 2, 3]) as i)
        left join (select risk_category,
                          case likelihood when 'High' then 3 when 'Medium' then 2 else 1 end as rl,
                          case impact when 'High' then 3 when 'Medium' then 2 else 1 end as ri
                   from risk_register) on rl = l and ri = i""",
    "data_quality_pct": """
        select table_name, total_rows, 100.0::double * excluded_status / total_rows as pct_excluded,
               100.0::double * clean_delivered / total_rows as pct_clean,
               100.0::double * zero_payment / total_rows as pct_zero_payment
        from data_quality""",
    "cleaning_funnel": FUNNEL,
    "late_order_rate": """
        select late_orders, total_orders, 100.0::double * late_orders / total_orders as late_order_pct
        from kpi_summary""",
    "revenue_scaled": f"""
        select 'millions' as unit, 'all' as label, round(total_revenue / 1e6, 2) as revenue from kpi_summary
        union all
        select 'thousands', {TITLE.format('category')}, round_even(total_revenue / 1000 * 10, 0) / 10
        from ({TOP_CATEGORIES.format(8)})""",
}
ANSWERS["dashboard_payload"] = f"""
    select to_json({{
        'kpi': (select {{'total_orders': total_orders, 'unique_customers': unique_customers,
                        'total_revenue': total_revenue::decimal(18,2), 'avg_order_value': avg_order_value::decimal(18,2),
                        'avg_review_score': avg_review_score::decimal(18,2), 'late_orders': late_orders,
                        'repeat_pct': repeat_pct::decimal(18,1), 'avg_repeat': avg_repeat::decimal(18,2),
                        'avg_onetime': avg_onetime::decimal(18,2)}}
                from kpi_summary, repeat_purchase),
        'byState': (select list({{'state': state, 'name': state_name, 'lat': lat, 'lng': lng,
                        'total_orders': total_orders, 'avg_review_score': avg_review_score::decimal(18,2),
                        'late_pct': late_pct::decimal(18,1),
                        'avg_delay_days': (round_even(avg_delay_days * 10, 0) / 10)::decimal(18,1),
                        'avg_freight_value': avg_freight_value::decimal(18,2), 'seller_count': seller_count,
                        'cs_ratio': cs_ratio::decimal(18,1)}} order by total_orders desc, state)
                    from state_map),
        'monthly': (select list({{'label': {MONTH_LABEL}, 'month_name': month_name,
                        'revenue': total_revenue::decimal(18,2), 'orders': total_orders,
                        'avg_value': avg_order_value::decimal(18,2), 'avg_review': avg_review_score::decimal(18,2),
                        'late': late_deliveries}} order by year, month)
                    from monthly_sales),
        'rfm': (select list({{'segment': segment, 'count': n, 'pct': pct::decimal(18,1),
                        'avg_spend': avg_spend::decimal(18,2)}} order by n desc, segment)
                from ({ANSWERS["segment_share_spend"]})),
        'categories': (select list({{'category': {TITLE.format("category")}, 'revenue': total_revenue::decimal(18,2),
                        'units': units_sold, 'review': avg_review_score::decimal(18,2),
                        'freight_ratio': avg_freight_ratio::decimal(18,3)}} order by total_revenue desc, category)
                       from ({TOP_CATEGORIES.format(10)}))
    }})::varchar as payload"""
ANSWERS |= {
    "sql_headline": """
        select count(distinct order_id) as total_orders, count(distinct customer_key) as unique_customers,
               round(sum(total_payment), 0) as total_revenue, round(avg(total_payment), 2) as avg_order_value,
               count(*) filter (delivery_delay_days > 0) as late_orders
        from fact_orders where order_status not in ('canceled', 'unavailable')""",
    "sql_customers_per_seller": """
        select c.state, customers, coalesce(sellers, 0) as sellers, round(customers::double / nullif(sellers, 0), 1) as customers_per_seller
        from (select state, count(*) as customers from dim_customers group by state) c
        left join (select state, count(*) as sellers from dim_sellers group by state) s on c.state = s.state""",
    "sql_delays": """
        select case when delivery_delay_days <= -14 then 'Very Early (>14d)' when delivery_delay_days <= -7 then 'Early (7-14d)'
                    when delivery_delay_days <= 0 then 'On Time (0-7d early)' when delivery_delay_days <= 7 then 'Late (1-7d)'
                    else 'Very Late (>7d)' end as bucket,
               count(*) as orders, round(100.0::double * count(*) / sum(count(*)) over (), 1) as share
        from fact_orders where delivery_delay_days is not null group by 1""",
    "sql_weekdays": """
        select dayofweek(purchased_at)::int as weekday, strftime(purchased_at, '%Y-%m') as month,
               max(date_diff('month', purchased_at, delivered_at))::int as most_months, count(*) as orders
        from fact_orders group by 1, 2""",
    "sql_high_payments": """
        select order_status, count(*) as orders, round(max(total_payment), 2) as most, round(sum(total_payment), 2) as total
        from fact_orders where total_payment > 0 group by order_status""",
}
ANSWERS |= {f"check_{name}": _check_row(name) for name in CHECKS}


def _needed(sql: str) -> set[str]:
    found = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        fresh = {t for t in TABLES if t in words} - found
        found |= fresh
        pending.extend(TABLES[t] for t in fresh)
    return found


def oracle(name: str) -> str:
    answer = ANSWERS[name]
    needed = _needed(answer)
    tables = ",\n".join(f"{t} as ({sql})" for t, sql in TABLES.items() if t in needed)
    if not tables:
        return answer
    if answer.lstrip().startswith("with "):
        answer = "select * from (" + answer + ")"
    return f"with {tables}\n{answer}"

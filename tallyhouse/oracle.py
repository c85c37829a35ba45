"""Independent DuckDB SQL for the registered queries.

Each text stands alone: the views it names are put in front as CTEs.
"""

from __future__ import annotations

import re

VIEWS = {
    "v_orders": """
select cast(o_orderkey as varchar) order_id, o_orderkey order_number, cast(o_custkey // 3 as varchar) domain_id,
  cast(o_custkey as varchar) company_id, o_orderdate created_at, cast(o_totalprice as decimal(18,2)) total,
  case when o_orderpriority in ('1-URGENT','2-HIGH') then 'PIX'
       when o_orderpriority in ('3-MEDIUM','4-NOT SPECIFIED') then 'CREDIT_CARD' else 'BOLETO' end payment_method,
  case o_orderstatus when 'F' then 'PAID' when 'O' then 'PENDING' end payment_status,
  case o_orderstatus when 'F' then 'DELIVERED' when 'O' then 'WAITING' else 'CANCELED' end order_status,
  o_orderstatus = 'F' is_paid, o_orderstatus = 'P' is_canceled, o_orderstatus <> 'O' is_closed,
  lpad(cast(cast(floor(o_totalprice) as bigint) % 400 as varchar), 11, '0') customer_doc,
  case o_orderpriority when '1-URGENT' then 'Jadlog' when '2-HIGH' then 'Correios' when '3-MEDIUM' then 'Retirada em loja'
       when '4-NOT SPECIFIED' then 'Total Express' else 'Motoboy' end delivery_provider,
  cast(cast(o_totalprice as decimal(18,2)) * 0.01 as decimal(18,2)) quoted,
  case when o_orderstatus = 'F' then 'label/' || o_orderkey end label_url
from orders""",
    "v_clean": """
select * replace (cast(domain_id as bigint) as domain_id) from v_orders where total > 0 and total < 400000""",
    "v_domains": """
select d domain_id, (case when balance < 0 then 'Loja Teste ' else 'Loja ' end) || d domain_name,
  case when balance < 2000 then 'portal' else 'catalogo,vendas' end modules,
  nullif(segment, 'FURNITURE') partner_id, cast(nation as varchar) angel_id,
  case when balance > 15000 then cast(nation % 5 as varchar) end integration_id
from (select c_custkey // 3 d, sum(cast(c_acctbal as decimal(18,2))) balance, min(c_mktsegment) segment, min(c_nationkey) nation
      from customer group by 1)""",
    "v_companies": """
select cast(c_custkey as varchar) company_id, c_custkey // 3 domain_id,
  lpad(cast(c_custkey // 2 as varchar), 8, '0') || lpad(cast(c_custkey % 2 + 1 as varchar), 4, '0') || '00' tax_document,
  c_name social_name, case when c_acctbal >= 0 then c_name end company_name,
  date '2000-01-01' + cast(c_nationkey as integer) created_at, case when c_acctbal < 0 then 2 else 1 end status
from customer""",
    "v_monthly": """
select domain_id, date_trunc('month', created_at) as month, count(*) orders, count(*) filter (is_paid) paid,
  count(*) filter (is_canceled) canceled, count(*) filter (not is_paid and not is_canceled) pending, sum(total) as value,
  sum(case when is_paid then total else 0 end) paid_value, sum(case when is_canceled then total else 0 end) canceled_value,
  sum(case when not is_paid and not is_canceled then total else 0 end) pending_value
from v_clean group by 1, 2""",
    "v_split": """
select domain_id, date_trunc('month', created_at) as month,
  sum(case when payment_method = 'PIX' then total else 0 end) pix_value,
  sum(case when payment_method = 'CREDIT_CARD' then total else 0 end) card_value, sum(total) as value,
  count(*) filter (payment_method = 'PIX') pix_orders, count(*) filter (payment_method = 'CREDIT_CARD') card_orders, count(*) orders
from v_clean group by 1, 2""",
    "v_quarters": """
select domain_id,
  sum(case when month >= timestamp '2001-06-01' then orders else 0 end) last3,
  sum(case when month < timestamp '2001-06-01' then orders else 0 end) prev3,
  sum(case when month = timestamp '2001-08-01' then orders else 0 end) this_month
from v_monthly where month between timestamp '2001-03-01' and timestamp '2001-08-01' group by 1""",
    "v_invoices": """
select l_orderkey || '-' || l_partkey invoice_id, cast(l_linenumber as varchar) item_id, cast(l_partkey as varchar) customer_id,
  l_partkey domain_id,
  case when l_linestatus = 'F' then (case l_returnflag when 'A' then 'paid' when 'R' then 'externally_paid' else 'pending' end)
       else (case l_returnflag when 'A' then 'expired' when 'R' then 'canceled' else 'paid' end) end status,
  l_shipdate due_at, cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) total_cents,
  case when l_returnflag <> 'N' then cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) end item_price_cents,
  cast(l_quantity as integer) % 4 item_quantity, cast(l_quantity as integer) q,
  case l_linenumber when 1 then 'Plano Essencial' when 2 then 'Plano Pro' when 3 then 'Filial Atacado' when 4 then 'Assistente do Vendedor'
       when 5 then 'Plano_Avançado' when 6 then 'Plano Básico' else 'Starter' end plan_name
from lineitem""",
    "v_plans": """
select domain_id, plan_name plan, max(case when status in ('paid','externally_paid') then cast(due_at as date) end) last_paid
from v_invoices group by 1, 2""",
    "v_stops": """
select *, date_trunc('month', last_paid) < timestamp '2001-05-01' stopped from v_plans where last_paid is not null""",
    "v_invoice_lines": """
select * replace (split_part(invoice_id, '-', 1) as invoice_id, case when item_id = '3' and item_quantity = 0 then null else item_id end as item_id) from v_invoices""",
    # The item text is structured for line 1 only: plan 1.0qq,50, integration qq,00, branch 12.5, discount 3,25.
    # max() over repeated ingests of one invoice and item picks the largest text, so the quantity compares as text.
    "v_items": """
select domain_id, invoice_id, item_id, date_trunc('month', max(due_at) - interval 10 day) as month,
  cast(max(item_price_cents) as decimal(18,2)) * 0.01 * greatest(max(item_quantity), 1) as raw_value,
  max(lpad(cast(q as varchar), 3, '0')) q
from v_invoice_lines where status = 'paid' and item_id is not null group by 1, 2, 3""",
    "v_item_parts": """
select domain_id, invoice_id, month,
  cast(case item_id when '1' then 1000 + cast(q as integer) + 0.50 when '2' then v else 0 end as decimal(18,2)) plano,
  cast(case item_id when '1' then cast(q as integer) when '5' then v else 0 end as decimal(18,2)) integracao,
  cast(case item_id when '4' then v else 0 end as decimal(18,2)) assistente,
  cast(case item_id when '1' then 12.50 when '3' then v else 0 end as decimal(18,2)) filial,
  cast(case item_id when '6' then v else 0 end as decimal(18,2)) outros,
  cast(case item_id when '1' then 3.25 else 0 end as decimal(18,2)) desconto
from (select *, cast(raw_value as decimal(18,2)) v from v_items) where v <> 0 and item_id <> '7'""",
    "v_unique_invoices": """
select * from (select *, row_number() over (partition by invoice_id order by item_id, due_at, status, total_cents) rn from v_invoices)
where rn = 1""",
    "v_settings": """
select cast(s_suppkey as varchar) company_id, (s_acctbal < 0) or (s_acctbal > 8000) anticipates, cast(s_nationkey as varchar) workspace_id
from supplier""",
    "v_receivables": """
select cast(l_orderkey as varchar) order_id, cast(l_suppkey as varchar) company_id, cast(l_suppkey as varchar) domain_id,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint)) rec_id,
  l_linenumber installment, l_shipdate due_at,
  case when l_linestatus = 'F' then l_shipdate + to_days(cast(l_quantity as integer)) end rec_paid_at,
  case when l_returnflag <> 'N' then cast(l_shipdate as date) - l_linenumber - 1 end own_paid_on,
  case when l_linestatus = 'F' then 'paid' else 'created' end rec_status,
  case when l_tax = 0 and l_discount = 0 then 0
       else cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2))) as decimal(18,2)) end net,
  cast(l_extendedprice as decimal(18,2)) gross,
  cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(18,2)) as decimal(18,2)) fee,
  case when l_returnflag = 'R' and l_discount >= 0.1 then 1 else 0 end anticipation
from lineitem""",
    "v_paid_through": """
select * from v_receivables where cast(company_id as bigint) % 10 <> 0""",
    # Every test timestamp is a midnight in UTC, which is the day before in the local zone.
    "v_heads": """
select order_id, order_number, customer_doc, total, payment_method, company_id order_company, domain_id order_domain, is_paid, is_canceled, created_at,
  cast(created_at as date) - 1 order_date, case when is_paid then cast(created_at as date) - 1 end head_paid_on
from v_orders where cast(company_id as bigint) % 10 <> 0""",
    "v_lines": """
select l.*, h.order_number, h.order_date,
  case when l.own_row then h.head_paid_on else max(l.own_paid_on) over (partition by l.order_id) end customer_paid_on, coalesce(s.anticipates, false) anticipates,
  cast(l.due_at as date) - 1 due_on, cast(l.rec_paid_at as date) - 1 paid_on
from (
  select *, false own_row from v_paid_through
  union all by name
  select order_id, order_company company_id, order_domain domain_id, case when order_number % 2 = 0 then 'own-' || order_id else '' end rec_id, 1 installment,
    case when is_paid then 'paid' else 'created' end rec_status, case when order_number % 5 <> 0 then created_at + interval 30 day end due_at,
    case when is_paid then created_at + interval 35 day end rec_paid_at, case when is_canceled then 0 else cast(total * 0.97 as decimal(18,2)) end net, total gross,
    cast(total * 0.03 as decimal(18,2)) fee, 0 anticipation, true own_row
  from v_heads where order_id not in (select order_id from v_paid_through)
) l left join v_settings s using (company_id) left join v_heads h using (order_id)
where (l.net <> 0 or coalesce(s.anticipates, false))
  and (coalesce(s.anticipates, false) or l.domain_id in (select cast(domain_id as varchar) from v_active))""",
    "v_rec_orders": """
select order_id, max(order_number) order_number, max(order_date) order_date, count(*) instalments, min(due_on) first_due,
  max(due_on) last_due, min(due_on) filter (paid_on is null) next_due, count(paid_on) paid, count(*) - count(paid_on) as "open",
  sum(net) net, sum(gross) gross, sum(fee) fee, bool_and(paid_on is not null) all_paid, bool_or(anticipates or anticipation > 0) anticipates
from v_lines group by 1""",
    "v_schedule": """
select order_id, rec_id, installment, l.due_on, l.paid_on, gross, fee, net, o.anticipates, paid_on is not null is_paid,
  case when o.anticipates then coalesce(case dayofweek(d) when 6 then d + 2 when 0 then d + 1 else d end, due_on)
       else coalesce(paid_on, due_on) end pay_on
from (select * exclude (anticipates, gross, net, fee), gross, net, fee,
        coalesce(customer_paid_on, paid_on, order_date) + 1 d from v_lines) l
  join (select order_id, anticipates from v_rec_orders) o using (order_id)""",
    "v_purchases": """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint)) transaction_id,
  cast(l_orderkey as varchar) order_id, l_orderkey, l_suppkey, l_partkey, l_linenumber,
  'Brand ' || l_suppkey brand, cast(l_suppkey % 25 as varchar) workspace_id, l_discount >= 0.05 anticipation,
  case when l_linestatus = 'F' then 'paid' when l_returnflag = 'A' then 'created' when l_returnflag = 'N' then 'denied' else 'voided' end status,
  cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) cents,
  case when l_tax = 0 then 0 else cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) end amount, l_shipdate created,
  l_shipdate + to_hours(cast(l_quantity as integer)) + to_minutes(l_linenumber) updated, cast(l_quantity as integer) q
from lineitem""",
    "v_workspace": """
select workspace_id, share, share >= 0.5 anticipates_default from (
  select workspace_id, case when nr >= 3 then hr / nr else ha / na end share from (
    select workspace_id, count(*) filter (created >= timestamp '2001-10-21') nr,
      count(*) filter (created >= timestamp '2001-10-21' and anticipation) hr, count(*) na, count(*) filter (anticipation) ha
    from v_purchases group by 1) where nr >= 3 or na >= 3)""",
    "v_valid": """
select * from v_purchases where status in ('paid','created') and amount <> 0 and (cents // l_linenumber) * l_linenumber <> 0""",
    "v_close": """
select case when l_returnflag = 'R' then l_suppkey else o_custkey // 3 end domain_id, l_orderkey order_number, l_returnflag operator,
  cast(cast(l_extendedprice / 1000 as integer) as decimal(18,2)) + cast(l_quantity as integer) / 100 * 1.00 as posting_raw,
  cast(l_shipdate as date) posted_on, case when l_linestatus = 'F' then 'ENTREGUE' else 'AGUARDANDO RETIRADA' end sheet_status,
  cast(floor(l_extendedprice / 1000) as bigint) * 100 + cast(l_quantity as integer) cents
from lineitem join orders on o_orderkey = l_orderkey""",
    "v_postings": """
select domain_id, order_number, cast(sum(cents) / 100 as decimal(18,2)) posting, max(operator) operator, max(posted_on) posted_on,
  max(sheet_status) sheet_status from v_close group by 1, 2""",
    "v_freight": """
select o.order_id, cast(o.domain_id as bigint) domain_id, o.order_number, cast(created_at as date) as day, delivery_provider, order_status,
  is_canceled, total, quoted, p.posting, p.operator, p.posted_on, p.sheet_status, label_url is not null has_label,
  case when p.posting is null then quoted else greatest(quoted, cast(p.posting * 1.10 as decimal(18,2))) end final, quoted - p.posting margin
from v_orders o left join v_postings p on p.domain_id = cast(o.domain_id as bigint) and p.order_number = o.order_number
where delivery_provider in ('Jadlog','Correios','Total Express')""",
    "v_meetings": """
select event_id meeting_id, user_id % 4 owner_rank, user_id company_id, ts start_at,
  value > 40 closed from events where event_type = 'view'""",
    "v_deal_match": """
select * from (
  select d.event_id deal_id, d.user_id company_id, m.meeting_id, m.owner_rank, m.start_at,
    row_number() over (partition by d.event_id order by m.start_at desc nulls last, m.owner_rank, m.meeting_id) rn
  from (select * from events where event_type = 'purchase') d
  left join v_meetings m on m.company_id = d.user_id and m.start_at <= d.ts) where rn = 1""",
    "v_matrix": """
with c as (
  select owner_rank, week, sum(m) meetings, sum(d) deals from (
    select owner_rank, date_trunc('week', start_at) as week, 1 m, 0 d from v_meetings
    union all select owner_rank, date_trunc('week', start_at), 0, 1 from v_deal_match where meeting_id is not null) group by 1, 2)
select o.owner_rank, w.week, coalesce(c.meetings, 0) meetings, coalesce(c.deals, 0) deals
from (select distinct owner_rank from c) o cross join (select distinct week from c) w left join c on c.owner_rank = o.owner_rank and c.week = w.week""",
    "v_ai_orders": """
select user_id brand, ts, cast(value as decimal(18,2)) total, cast(json_extract_string(props, '$.k') as integer) % 3 kind
from events where event_type = 'purchase'""",
    "v_ai_inter": """
select user_id brand, ts, 100 total, cast(json_extract_string(props, '$.k') as integer) ai from events where event_type in ('click','view')""",
    "v_domain_month": """
select domain_id, date_trunc('month', created_at) as month, count(*) n, sum(total) gmv, count(*) filter (payment_method = 'PIX') p,
  count(*) filter (payment_method = 'CREDIT_CARD') k, count(*) filter (is_canceled) x
from v_orders group by 1, 2""",
    "v_active": """
select * from v_domains where modules like '%vendas%' and (partner_id is null or partner_id <> 'BUILDING') and domain_name not ilike '%teste%'""",
    "v_register": """
select c.company_id, c.domain_id, c.row_num, c.tax_document,
  case when row_num > 1 then coalesce(company_name, domain_name || ' - Filial ' || row_num) else domain_name end as name,
  coalesce(company_name, domain_name) trade_name, case when row_num > 1 then domain_name else '' end hq_name, row_num = 1 is_hq,
  coalesce(n_name, '') angel_name, coalesce(lower(d.partner_id), '') partner_name, coalesce(r_name, '') integration_name, status
from (select *, row_number() over (partition by domain_id order by created_at, company_id) row_num from v_companies) c
  join v_active d on d.domain_id = c.domain_id
  left join nation on cast(n_nationkey as varchar) = d.angel_id left join region on cast(r_regionkey as varchar) = d.integration_id""",
    # Companies k share a tax root by k // 2 and a domain by k // 3, so links chain k to both neighbours of its key.
    "v_groups": """
with recursive c as (select *, substr(tax_document, 1, 8) root from v_companies),
  ok_root as (select root from c group by 1 having count(*) between 2 and 20),
  ok_domain as (select domain_id from c group by 1 having count(*) between 2 and 15),
  e as (select a.company_id a, b.company_id b from c a join c b on a.root = b.root where a.root in (select root from ok_root)
        union select a.company_id, b.company_id from c a join c b on a.domain_id = b.domain_id where a.domain_id in (select domain_id from ok_domain)),
  reach as (select company_id src, company_id dst from c union select src, e.b from reach join e on e.a = reach.dst),
  g as (select src company_id, min(dst) group_id from reach group by 1),
  f as (select g.*, substr(tax_document, 9, 4) = '0001' first, root, length(social_name) len,
          (select count(*) from v_orders o where o.company_id = g.company_id) n from g join c on c.company_id = g.company_id),
  s as (select group_id, count(*) size, count(distinct case when first then root end) roots from f group by 1),
  h as (select f.*, size, row_number() over (partition by f.group_id order by case when roots = 1 and first then 0 else 1 end, n desc, len, company_id) rn
        from f join s using (group_id))
select company_id, group_id, size, first_value(company_id) over (partition by group_id order by rn) hq_id, rn = 1 is_hq from h""",
    "v_named": """
select 'p' || lpad(cast(p_partkey as varchar), 9, '0') company_id, p_name || ' ' || lower(p_type) as name,
  lpad(cast(p_partkey // 2 as varchar), 8, '0') || lpad(cast(p_partkey % 2 + 1 as varchar), 4, '0') || '00' tax_document, p_partkey domain_id
from part
union all select 's' || lpad(cast(s_suppkey as varchar), 9, '0'), s_name, '', null from supplier""",
    "v_plan_lines": """
select case when p_size > 40 then lpad(cast(90000000 + p_partkey as varchar), 14, '9')
    when p_size > 20 then lpad(cast(p_partkey // 2 as varchar), 8, '0') || '000900'
    else lpad(cast(p_partkey // 2 as varchar), 8, '0') || lpad(cast(p_partkey % 2 + 1 as varchar), 4, '0') || '00' end tax_id,
  case when p_size > 45 then p_name else p_name || ' ' || lower(p_type) end brand,
  case when p_size % 3 = 0 then 'Integração' else p_type end plan, p_partkey line_no, cast(p_retailprice as decimal(18,2)) total
from part""",
    "v_plan_main": """
select * from (select *, row_number() over (partition by tax_id order by plan = 'Integração', line_no) rn,
  count(*) over (partition by tax_id) lines from v_plan_lines) where rn = 1""",
    # All test names are plain ASCII without trade words.
    "v_norm_companies": """
select trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) nm, min(company_id) company_id from v_named group by 1""",
    "v_tickets": """
select *, trim(regexp_replace(lower(subject), '[^a-z0-9]+', ' ', 'g')) nm from (
  select 't' || lpad(cast(p_partkey as varchar), 9, '0') ticket_id,
    case when p_size <= 10 then p_name || ' ' || p_type when p_size <= 20 then split_part(p_name, ' ', 2)
      else split_part(p_name, ' ', 2) || ' ' || substr(p_type, 1, 4) || ' ' || p_brand end subject from part
  union all select 'u' || lpad(cast(c_custkey as varchar), 9, '0'), c_name from customer)""",
    "v_months": """
with a as (select company_id, month, sum(l) links, sum(k) clicks from (
    select user_id company_id, date_trunc('month', ts) as month, 1 l, 0 k from events where event_type = 'signup'
    union all select user_id, date_trunc('month', ts), 0, cast(json_extract_string(props, '$.k') as integer) from events where event_type = 'click') group by 1, 2),
  k as (select domain_id, month from v_monthly union select company_id, month from a)
select k.domain_id, k.month, coalesce(m.orders, 0) orders, coalesce(paid, 0) paid, coalesce(canceled, 0) canceled, coalesce(pending, 0) pending,
  coalesce(m.value, 0) as value, coalesce(paid_value, 0) paid_value, coalesce(canceled_value, 0) canceled_value, coalesce(pending_value, 0) pending_value,
  coalesce(card_orders, 0) card_orders, coalesce(pix_orders, 0) pix_orders, coalesce(card_value, 0) card_value, coalesce(pix_value, 0) pix_value,
  coalesce(links, 0) links, coalesce(clicks, 0) clicks
from k left join v_monthly m on m.domain_id = k.domain_id and m.month = k.month
  left join v_split s on s.domain_id = k.domain_id and s.month = k.month left join a on a.company_id = k.domain_id and a.month = k.month""",
    "v_payment_churn": """
select * from (
  select domain_id, max(cast(created_at as date)) filter (payment_method in ('PIX','CREDIT_CARD')) last_payment, max(cast(created_at as date)) last_order,
    count(*) filter (payment_method in ('PIX','CREDIT_CARD')) payment_orders, count(*) orders from v_orders group by 1)
where payment_orders >= 3 and date_trunc('month', last_payment) <= timestamp '2001-06-01' and last_order > last_payment
  and date_trunc('month', last_payment) + interval 1 month between timestamp '1997-01-01' and timestamp '2001-08-01'""",
    "v_new_customers": """
select f.domain_id, f.first_at, t.pix_value, t.card_value, t.value, t.pix_orders, t.card_orders, t.orders, h.company_id hq_id, h.status
from (select domain_id, min(created_at) first_at from v_clean where payment_method <> 'BOLETO' group by 1) f
  join (select domain_id, sum(case when payment_method = 'PIX' then total else 0 end) pix_value,
      sum(case when payment_method = 'CREDIT_CARD' then total else 0 end) card_value, sum(total) as value,
      count(*) filter (payment_method = 'PIX') pix_orders, count(*) filter (payment_method = 'CREDIT_CARD') card_orders, count(*) orders
    from v_clean where payment_method <> 'BOLETO' group by 1) t using (domain_id)
  join (select * from (select *, row_number() over (partition by domain_id order by created_at, company_id) rn from v_companies) where rn = 1) h using (domain_id)
where f.first_at >= timestamp '1995-03-01'""",
    "v_club": """
with w as (select * , date_trunc('month', created_at) as month,
    row_number() over (partition by domain_id, date_trunc('month', created_at) order by created_at) rn
  from v_clean where created_at >= timestamp '1998-01-01' and created_at < timestamp '2001-01-01')
select s.*, w.created_at reached_at, l.n lifetime_orders from v_split s
  join w on w.domain_id = s.domain_id and w.month = s.month and w.rn = 3
  join (select domain_id, count(*) n from v_clean group by 1) l on l.domain_id = s.domain_id""",
    "v_mart": """
with r as (select g.*, q.orders o, q.paid p, q.canceled x, q.value v, q.pix_value pv, q.card_value cv, q.pix_orders po, q.card_orders co, t.last3 l3, t.prev3 p3, t.this_month tm
    from v_register g
    left join (select domain_id, sum(orders) orders, sum(paid) paid, sum(canceled) canceled, sum(value) as value, sum(pix_value) pix_value, sum(card_value) card_value,
        sum(pix_orders) pix_orders, sum(card_orders) card_orders from v_months group by 1) q on q.domain_id = g.domain_id and g.is_hq
    left join v_quarters t on t.domain_id = g.domain_id and g.is_hq),
  z as (select *, coalesce(o, 0) orders, coalesce(p, 0) paid, coalesce(x, 0) canceled, coalesce(v, 0) as value, coalesce(pv, 0) pix_value,
      coalesce(co, 0) card_orders, coalesce(po, 0) pix_orders, coalesce(l3, 0) last3, coalesce(p3, 0) prev3, coalesce(tm, 0) this_month from r),
  k as (select * from z where orders > 0 or tax_document not in (select tax_document from z where orders > 0)),
  b as (select domain_id, sum(case when status in ('paid','externally_paid') then total_cents else 0 end) cents, count(*) bills,
      first(total_cents order by status = 'canceled', due_at desc, invoice_id) last_cents, first(status order by status = 'canceled', due_at desc, invoice_id) bill_status
    from v_unique_invoices group by 1),
  a as (select hq_id, sum(l) links, sum(k) clicks from (select cast(user_id as varchar) company_id, (event_type = 'signup')::int l,
      case when event_type = 'click' then cast(json_extract_string(props, '$.k') as integer) else 0 end k from events where event_type in ('signup', 'click')) e
    join v_groups g on g.company_id = e.company_id group by 1),
  f as (select domain_id, sum(posting) freight_cost from v_postings group by 1),
  y as (select k.*, integration_name <> '' has_integration, pix_orders + card_orders > 0 has_payment, coalesce(cast(b.cents as decimal(18,2)) * 0.01, 0) bill_paid,
      coalesce(b.bills, 0) bills, coalesce(f.freight_cost, 0) freight_cost,
      coalesce(b.bill_status, '') bill_status, coalesce(a.links, 0) links, coalesce(a.clicks, 0) clicks,
      case when b.last_cents > 0 then cast(b.last_cents as decimal(18,2)) * 0.01 when status = 2 then 99 else 77 end fee
    from k left join b on b.domain_id = k.domain_id left join f on f.domain_id = k.domain_id left join a on a.hq_id = k.company_id),
  c as (select *, prev3 > 5 and last3 < prev3 * 0.5 r1, prev3 > 5 and last3 >= prev3 * 0.5 and last3 < prev3 * 0.7 r2, orders > 0 and this_month = 0 r3,
      orders > 10 and canceled > paid * 0.3 r4, not has_integration r5, status = 2 r6 from y)
select *, least(100, 30 * r1::int + 15 * r2::int + 25 * r3::int + 15 * r4::int + 10 * r5::int + 20 * r6::int) score,
  concat_ws('; ', case when r1 then 'orders down >50%' end, case when r2 then 'orders down >30%' end, case when r3 then 'no orders this month' end,
    case when r4 then 'many cancellations' end, case when r5 then 'no integration' end, case when r6 then 'assistant: stopped' end) reasons
from c""",
}

# Text of a day, a month and an instant, as the queries return them.
_FORMATS = {"DAY": "%Y-%m-%d", "TS": "%Y-%m-%d %H:%M:%S.%f"}


def _sql(body: str) -> str:
    """Put the views a query needs in front, in order of use."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_[a-z_]+\b", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    full = ", ".join(f"{n} as ({VIEWS[n]})" for n in needed)
    text = f"with recursive {full} {body}" if needed else body
    for mark, pattern in _FORMATS.items():
        text = re.sub(mark + r"\[([^\[\]]+)\]", lambda m: f"strftime({m.group(1)}, '{pattern}')", text)
    inner = None
    while inner != text:
        inner, text = text, re.sub(r"\bD\[([^\[\]]+)\]", r"cast(\1 as double)", text)
    return text.strip()


_KPI = "orders, paid, canceled, pending, D[value] as value, D[paid_value] paid_value, D[canceled_value] canceled_value"
_SPLIT = "D[pix_value] pix_value, D[card_value] card_value, D[value] as value, pix_orders, card_orders, orders"
_RANGE = "churn_month between timestamp '1997-01-01' and timestamp '2001-08-01'"
_ITEM_SUMS = ", ".join(f"D[sum({c})] {c}" for c in ("plano", "integracao", "assistente", "filial", "outros", "desconto"))
_ITEM_NET = "D[sum(plano + integracao + assistente + filial + outros - desconto)] total"
_NUM = "cast(floor(value) as integer) % 11"
_WEEK = "isoyear(ts) || '-W' || lpad(cast(weekofyear(ts) as varchar), 2, '0')"

_BODIES = {
    "monthly_domain_kpis": f"select domain_id, DAY[month] as month, {_KPI}, D[pending_value] pending_value from v_monthly",
    "monthly_global_and_domain_rollup": """
select coalesce(domain_id, -1) domain_id, coalesce(strftime(month, '%Y-%m'), 'all') as month,
  case when domain_id is null then 'month' else 'domain' end grain, cast(sum(orders) as bigint) orders, cast(sum(paid) as bigint) paid,
  cast(sum(canceled) as bigint) canceled, cast(sum(pending) as bigint) pending, D[sum(value)] as value, D[sum(paid_value)] paid_value,
  D[sum(canceled_value)] canceled_value
from v_monthly group by grouping sets ((domain_id), (month))""",
    "payment_split_by_month": f"select domain_id, DAY[month] as month, {_SPLIT} from v_split",
    "payment_family_totals": """
select case payment_method when 'PIX' then 'pix' when 'CREDIT_CARD' then 'card' else 'other' end family, count(*) orders, D[sum(total)] as value
from v_orders group by 1""",
    "order_report_by_company": """
select company_id, DAY[month] as month, orders,
  case when wv / wn > 300000 or v / orders > 300000 then 0.0 else D[v] end as value from (
  select *, sum(v) over (partition by company_id) wv, sum(orders) over (partition by company_id) wn from (
    select company_id, date_trunc('month', created_at) as month, count(*) orders, sum(total) v from v_orders group by 1, 2))""",
    "order_union_multiset": """
with h as (
  select src, prefix || '-' || o_orderkey record_id, cast(o_custkey // 30 as varchar) company_id, strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') as day,
    floor(o_totalprice / 50000) * 50000.0 as value, o_orderstatus code
  from orders join (values (0, 'o', 'F'), (1, 'q', 'P'), (2, 'a', '')) t(src, prefix, skip) on o_orderstatus <> skip),
r as (select *, row_number() over (partition by src, company_id, day, value order by md5(record_id), record_id) rn from h),
c as (select company_id, day, value, count(*) filter (src = 0 and (split_part(record_id, '-', 2)::bigint % 2 = 0 or split_part(record_id, '-', 2)::bigint % 3 = 0)) n0, count(*) filter (src = 1) n1 from h group by all)
select record_id, r.company_id, r.day, r.value, code from r join c on c.company_id = r.company_id and c.day = r.day and c.value = r.value
where src = 0 or (src = 1 and rn > n0) or (src = 2 and rn > greatest(n0 - n1, 0))""",
    "orders_per_brand": """
with h as (
  select src, prefix || '-' || o_orderkey record_id, o_orderkey k, cast(o_custkey // 30 as varchar) company, cast(o_custkey // 30 * 10 as bigint) domain_id,
    strftime(date_trunc('quarter', o_orderdate), '%Y-%m-%d') as day, floor(o_totalprice / 50000) * 50000.0 as value, o_orderstatus s
  from orders join (values (0, 'o', 'F'), (1, 'q', 'P'), (2, 'a', '')) t(src, prefix, skip) on o_orderstatus <> skip),
d as (select domain_id, min(company_id) owner from v_companies group by 1),
w as (select h.*, case when src > 0 and k % 4 = 0 then owner when company in (select company_id from v_companies) then company when src > 0 then owner end company_id,
    case when src = 0 then (case s when 'O' then 'E' else 'C' end) when src = 2 then 'O' else (case s when 'F' then 'P' else 'E' end) end letter
  from h left join d on d.domain_id = h.domain_id),
r as (select *, row_number() over (partition by src, company_id, day, value order by md5(record_id), record_id) rn from w where company_id is not null),
c as (select company_id, day, value, count(*) filter (src = 0 and (k % 2 = 0 or k % 3 = 0)) n0, count(*) filter (src = 1) n1 from r group by all)
select r.company_id, letter, count(*) records, D[sum(r.value)] as value from r join c on c.company_id = r.company_id and c.day = r.day and c.value = r.value
where src = 0 or (src = 1 and rn > n0) or (src = 2 and rn > greatest(n0 - n1, 0)) group by 1, 2""",
    "owned_receivables": """
select owner_id, count(*) lines, D[sum(gross)] gross from (
  select coalesce(c.company_id, d.company_id) owner_id, gross from v_receivables r left join v_companies c on c.company_id = r.company_id
  left join (select cast(domain_id as varchar) domain_id, min(company_id) company_id from v_companies group by 1) d on d.domain_id = r.domain_id)
where owner_id is not null group by 1""",
    "local_month_shift": """
with e as (select date_trunc('month', ts) u, date_trunc('month', ts - interval 3 hour) l, cast(value as decimal(18,2)) v from events),
a as (select u, count(*) n, sum(v) v, count(*) filter (u <> l) m from e group by 1), b as (select l, count(*) n, sum(v) v, count(*) filter (u <> l) m from e group by 1)
select DAY[coalesce(u, l)] as month, coalesce(a.n, 0) utc_rows, coalesce(D[a.v], 0) utc_value, coalesce(a.m, 0) moved_out,
  coalesce(b.n, 0) local_rows, coalesce(D[b.v], 0) local_value, coalesce(b.m, 0) moved_in from a full join b on a.u = b.l""",
    "three_month_average": """
with b as (select * from v_orders where not is_canceled and is_closed and created_at >= timestamp '2001-05-01' and created_at < timestamp '2001-08-01')
select domain_id, D[sum(total)] / 3.0 gmv_avg, D[sum(total) filter (is_paid and payment_method = 'CREDIT_CARD')] / 3.0 card_avg,
  D[sum(total) filter (is_paid and payment_method = 'PIX')] / 3.0 pix_avg from b group by 1""",
    "three_month_average_card_first": """
with b as (select * from v_orders where not is_canceled and is_closed and created_at >= timestamp '2001-05-01' and created_at < timestamp '2001-08-01'),
a as (select domain_id, D[sum(total)] / 3.0 gmv_avg, D[sum(total) filter (is_paid and payment_method = 'CREDIT_CARD')] / 3.0 card_avg,
  D[sum(total) filter (is_paid and payment_method = 'PIX')] / 3.0 pix_avg from b group by 1)
select domain_id, gmv_avg, card_avg, case when card_avg is not null then pix_avg end pix_avg from a""",
    "order_totals_filtered": """
select count(*) orders, count(*) filter (is_paid) paid, count(*) filter (is_canceled) canceled, count(*) filter (not is_paid and not is_canceled) pending,
  D[sum(total)] as value, D[sum(case when is_paid then total else 0 end)] paid_value, D[sum(case when is_canceled then total else 0 end)] canceled_value,
  count(distinct domain_id) domains
from v_orders where payment_method = 'PIX' and (customer_doc like '%1%' or order_id like '%1%')""",
    "company_last_orders": """
select company_id, position, order_number, TS[created_at] created_at, D[total] total from (
  select *, cast(row_number() over (partition by company_id order by created_at desc, order_number desc) as integer) position from v_orders) where position <= 10""",
    "system_total_differences": """
with a as (select domain_id, sum(total) a from v_orders group by 1),
b as (select domain_id, sum(l.gross) b from v_orders join (select order_id, gross from v_receivables) l using (order_id) group by 1)
select domain_id, D[a] a, D[b] b, D[abs(a - b)] * 100.0 / D[b] diff_pct from a join b using (domain_id)
where D[abs(a - b)] * 100.0 / D[b] > 10 order by diff_pct desc, domain_id limit 5""",
    "drop_down_values": """
select distinct field, value from (
  select 'payment_method' field, payment_method as value from v_orders union all select 'payment_status', payment_status from v_orders
  union all select 'order_status', order_status from v_orders union all select 'delivery_provider', delivery_provider from v_orders) where value <> ''""",
    "order_letters": """
select case when is_paid then 'P' when is_canceled then 'C' else 'E' end letter, payment_method, count(*) orders from v_orders group by 1, 2""",
    "first_full_month_value": f"""
select s.domain_id, TS[first_at] first_at, DAY[s.month] as month, {_SPLIT} from v_split s
join (select domain_id, min(created_at) first_at from v_clean group by 1) f on f.domain_id = s.domain_id
  and s.month = date_trunc('month', first_at) + interval 1 month
where first_at >= timestamp '1995-03-01' and s.month < timestamp '2001-08-01'""",
    "nth_order_club": f"select domain_id, DAY[month] as month, {_SPLIT}, TS[reached_at] reached_at, lifetime_orders from v_club",
    "club_months_reached": """
select domain_id, string_agg(strftime(month, '%Y-%m'), ',' order by month) months_reached, count(*) times from v_club group by 1""",
    "new_payment_cohort": f"select domain_id, TS[first_at] first_at, {_SPLIT}, hq_id, status from v_new_customers",
    "cohort_after_first_month": f"""
select domain_id, TS[first_at] first_at, {_SPLIT}, hq_id, status from v_new_customers where date_trunc('month', first_at) = timestamp '1995-04-01'""",
    "domain_headquarters": """
select company_id, domain_id, row_number() over (partition by domain_id order by created_at, company_id) row_num from v_companies""",
    "plan_churn_detail": f"""
select domain_id, plan, DAY[last_paid] last_paid, DAY[churn_month] churn_month, total_churn, p_brand angel_name from (
  select *, date_trunc('month', last_paid) + interval 1 month churn_month, bool_and(stopped) over (partition by domain_id) total_churn from v_stops)
  join part on p_partkey = domain_id where stopped and {_RANGE}""",
    "plan_churn_pivot": f"""
select DAY[churn_month] churn_month, plan, p_brand angel_name, count(*) plans from (
  select *, date_trunc('month', last_paid) + interval 1 month churn_month from v_stops) join part on p_partkey = domain_id
where stopped and {_RANGE} group by all""",
    "plan_churn_total": f"""
select domain_id, DAY[last_paid] last_paid, DAY[churn_month] churn_month, plans, domain_name from (
  select domain_id, max(last_paid) last_paid, date_trunc('month', max(last_paid)) + interval 1 month churn_month,
    string_agg(plan, ' | ' order by plan) plans, min(p_name) domain_name
  from v_stops join part on p_partkey = domain_id group by 1 having bool_and(stopped)) where {_RANGE}""",
    "plan_churn_tiered": f"""
with l as (select *, case plan when 'Filial Atacado' then 0 when 'Assistente do Vendedor' then 0 when 'Plano Pro' then 2 when 'Plano_Avançado' then 2 else 1 end level from v_stops),
g as (select domain_id, max(last_paid) filter (stopped) last_paid, count(*) filter (stopped) n_stopped, count(*) filter (not stopped) n_kept,
  coalesce(string_agg(plan, ' | ' order by plan) filter (stopped), '') stopped_plans, coalesce(string_agg(plan, ' | ' order by plan) filter (not stopped), '') kept_plans,
  max(level) filter (stopped) sl, coalesce(max(level) filter (not stopped), 0) kl,
  date_trunc('month', max(last_paid) filter (stopped)) + interval 1 month churn_month from l group by 1)
select domain_id, DAY[last_paid] last_paid, n_stopped, n_kept, stopped_plans, kept_plans, DAY[churn_month] churn_month,
  case when kl = 0 then 'total' else 'partial' end kind
from g where n_stopped > 0 and not (sl > 0 and kl >= sl) and {_RANGE}""",
    "payment_churn_value_lost": """
with m as (
  select o.domain_id, date_trunc('month', created_at) as month, sum(case when payment_method = 'PIX' then total else 0 end) pix,
    sum(case when payment_method = 'CREDIT_CARD' then total else 0 end) card
  from v_orders o join v_payment_churn c on c.domain_id = o.domain_id
  where payment_method <> 'BOLETO' and created_at < date_trunc('month', last_payment) group by 1, 2 having sum(total) > 0),
t as (select * from (select *, row_number() over (partition by domain_id order by month desc) rn from m) where rn = 1)
select c.domain_id, DAY[last_payment] last_payment, DAY[last_order] last_order, payment_orders, orders,
  strftime(date_trunc('month', last_payment) + interval 1 month, '%Y-%m-%d') churn_month, D[coalesce(pix, 0)] pix_lost, D[coalesce(card, 0)] card_lost,
  D[coalesce(pix + card, 0)] value_lost,
  case when month is null then 'none' when month = date_trunc('month', last_payment) - interval 1 month then 'previous month' else 'earlier month' end note
from v_payment_churn c left join t on t.domain_id = c.domain_id""",
    "trailing_quarter_drop": """
select domain_id, cast(last3 as bigint) last3, cast(prev3 as bigint) prev3, cast(this_month as bigint) this_month from v_quarters""",
    "observed_quarter_drop": """
select domain_id, cast(sum(case when rn <= 3 then orders else 0 end) as bigint) last3, cast(sum(case when rn > 3 then orders else 0 end) as bigint) prev3
from (select *, row_number() over (partition by domain_id order by month desc) rn from v_monthly) where rn <= 6 group by 1 having count(*) >= 4""",
    "churn_score": """
with f as (select d.domain_id, integration_id is not null has_integration, case cast(angel_id as integer) when 3 then 'Churn' when 4 then 'Parado' else '' end stage,
    coalesce(o.orders, 0) orders, coalesce(o.paid, 0) paid, coalesce(o.canceled, 0) canceled, coalesce(last3, 0) last3, coalesce(prev3, 0) prev3, coalesce(this_month, 0) this_month
  from v_domains d left join (select domain_id, sum(orders) orders, sum(paid) paid, sum(canceled) canceled from v_monthly group by 1) o on o.domain_id = d.domain_id
  left join v_quarters q on q.domain_id = d.domain_id),
r as (select *, prev3 > 5 and last3 < prev3 * 0.5 r1, prev3 > 5 and last3 >= prev3 * 0.5 and last3 < prev3 * 0.7 r2, orders > 0 and this_month = 0 r3,
  orders > 10 and canceled > paid * 0.3 r4, not has_integration r5, stage = 'Churn' r6, stage = 'Parado' r7 from f),
s as (select *, least(100, 30 * r1::int + 15 * r2::int + 25 * r3::int + 15 * r4::int + 10 * r5::int + 30 * r6::int + 20 * r7::int) score from r)
select domain_id, has_integration, stage, cast(orders as bigint) orders, cast(paid as bigint) paid, cast(canceled as bigint) canceled, cast(last3 as bigint) last3,
  cast(prev3 as bigint) prev3, cast(this_month as bigint) this_month, score,
  concat_ws('; ', case when r1 then 'orders down >50%' end, case when r2 then 'orders down >30%' end, case when r3 then 'no orders this month' end,
    case when r4 then 'many cancellations' end, case when r5 then 'no integration' end, case when r6 then 'assistant: churn' end, case when r7 then 'assistant: stopped' end) reasons,
  case when score >= 60 then 'high' when score >= 30 then 'medium' else 'low' end risk from s""",
    "nps_by_domain": f"""
select user_id domain_id, cast(count(*) filter ({_NUM} >= 9) - count(*) filter ({_NUM} <= 6) as double) * 100.0 / count(*) nps, count(*) answers from events group by 1""",
    "mrr_last_month": """
select domain_id, D[sum(v)] mrr from (
  select distinct domain_id, invoice_id, due_at, cast(coalesce(item_price_cents, total_cents) as decimal(18,2)) * 0.01 v from v_invoices
  where status <> 'canceled' and due_at >= timestamp '2001-07-01' and due_at < timestamp '2001-08-01') group by 1""",
    "invoice_item_revenue": f"""
select DAY[month] as month, {_ITEM_SUMS}, count(distinct invoice_id) invoices, count(distinct domain_id) domains, {_ITEM_NET} from v_item_parts group by month""",
    "invoice_item_revenue_by_domain": f"select domain_id, {_ITEM_SUMS}, count(distinct invoice_id) invoices, {_ITEM_NET} from v_item_parts group by 1",
    "recurring_revenue_register": f"""
select r.domain_id, r.company_id, r.name domain_name, r.trade_name, r.partner_name, r.angel_name, {_ITEM_SUMS}, count(distinct invoice_id) invoices, {_ITEM_NET}
from v_register r join v_item_parts p on p.domain_id = r.domain_id where is_hq group by 1, 2, 3, 4, 5, 6""",
    "invoice_item_revenue_by_domain_month": f"select domain_id, DAY[month] as month, {_ITEM_SUMS}, {_ITEM_NET} from v_item_parts group by domain_id, v_item_parts.month",
    "invoice_status_buckets": """
with u as (select *, cast(total_cents as decimal(18,2)) * 0.01 v, row_number() over (partition by customer_id order by due_at, invoice_id) pos from v_unique_invoices)
select customer_id, D[sum(case when status in ('paid','externally_paid') then v else 0 end)] paid, D[sum(case when status = 'pending' then v else 0 end)] pending,
  D[sum(case when status = 'expired' then v else 0 end)] expired, D[sum(case when status = 'canceled' then v else 0 end)] canceled, count(*) invoices,
  max(case when pos = 1 then plan_name end) plan from u group by 1""",
    "invoice_current": """
select customer_id, invoice_id, status, TS[due_at] due_at, total_cents / 100 fee from (
  select * exclude (rn), row_number() over (partition by customer_id order by status = 'canceled', due_at desc, invoice_id) pos from v_unique_invoices) where pos = 1""",
    "invoice_last_twelve": """
select customer_id, cast(position as integer) position, invoice_id, status, total_cents from (
  select * , row_number() over (partition by customer_id order by due_at desc, invoice_id) position from v_unique_invoices) where position <= 12""",
    "latest_subscription_per_domain": """
select customer_id, subscription_id, plan_name, active, TS[due_at] updated_at from (
  select *, row_number() over (partition by customer_id order by active desc, due_at desc, subscription_id) rn from (
    select customer_id, invoice_id || '/' || item_id subscription_id, plan_name, status in ('paid','externally_paid') active, due_at from v_invoices)) where rn = 1""",
    "last_paid_invoice": """
select customer_id, TS[due_at] due_at, invoice_id, total_cents / 100 last_value from (
  select *, row_number() over (partition by customer_id order by due_at desc, invoice_id desc, total_cents desc) rn from v_invoices
  where status in ('paid','externally_paid')) where rn = 1""",
    "recurrence_totals": """
select case status when 'paid' then (case when plan_name = 'Plano Pro' then 'paid_recurring' else 'paid_single' end) when 'pending' then 'waiting' else status end as class,
  count(*) invoices, D[sum(cast(total_cents as decimal(18,2)) * 0.01)] as value from v_unique_invoices group by 1""",
    "domain_kpi_table": f"""
with n as (select user_id domain_id, cast(count(*) filter ({_NUM} >= 9) - count(*) filter ({_NUM} <= 6) as double) * 100.0 / count(*) nps from events group by 1),
m as (select domain_id, D[sum(v)] mrr from (select distinct domain_id, invoice_id, due_at, cast(coalesce(item_price_cents, total_cents) as decimal(18,2)) * 0.01 v from v_invoices
  where status <> 'canceled' and due_at >= timestamp '2001-07-01' and due_at < timestamp '2001-08-01') group by 1),
a as (select cast(domain_id as bigint) domain_id, D[sum(total)] / 3.0 gmv_avg, D[sum(total) filter (is_paid and payment_method = 'CREDIT_CARD')] / 3.0 card_avg,
  D[sum(total) filter (is_paid and payment_method = 'PIX')] / 3.0 pix_avg
  from v_orders where not is_canceled and is_closed and created_at >= timestamp '2001-05-01' and created_at < timestamp '2001-08-01' group by 1)
select d.domain_id, n_name angel_name, coalesce(r_name, '') integration_name, exists (select 1 from v_companies c where c.domain_id = d.domain_id and status = 1 and company_name is not null) payment_on,
  nps, mrr, gmv_avg, card_avg, pix_avg
from v_active d join nation on cast(n_nationkey as varchar) = angel_id left join region on cast(r_regionkey as varchar) = integration_id
  left join n on n.domain_id = d.domain_id left join m on m.domain_id = d.domain_id left join a on a.domain_id = d.domain_id where partner_id is not null""",
    "receivable_tree": """
select order_id, order_number, DAY[order_date] order_date, instalments, DAY[first_due] first_due, DAY[last_due] last_due, DAY[next_due] next_due, paid, "open",
  D[net] net, D[gross] gross, D[fee] fee, all_paid, anticipates from v_rec_orders""",
    "payment_schedule": """
select order_id, rec_id, cast(installment as integer) installment, DAY[pay_on] pay_on, anticipates, is_paid, DAY[due_on] due_on, DAY[paid_on] paid_on,
  D[gross] gross, D[fee] fee, D[net] net from v_schedule""",
    "payment_schedule_by_day": """
select DAY[pay_on] pay_on, anticipates, count(*) instalments, D[sum(net)] net, D[sum(gross)] gross from v_schedule group by v_schedule.pay_on, anticipates""",
    "anticipation_ratio": "select workspace_id, share, anticipates_default from v_workspace",
    "purchase_merge_latest": """
select p.workspace_id, transaction_id, case when status in ('paid','created') then status else 'old' end status, amount,
  anticipation or coalesce(anticipates_default, false) anticipation, TS[updated] updated from v_purchases p left join v_workspace w on w.workspace_id = p.workspace_id""",
    "purchases_missing_now": """
select transaction_id, order_id, status from v_purchases where transaction_id not in (select transaction_id from v_purchases where status = 'paid')""",
    "duplicate_payments": """
select order_id, transaction_id, TS[created] created, amount / 100 as value, cast(l_linenumber as integer) parts, rn = 1 is_first from (
  select *, count(*) over (partition by order_id) n, row_number() over (partition by order_id order by created, transaction_id) rn from v_valid) where n > 1""",
    "duplicate_payment_orders": """
select order_id, count(*) payments, D[sum(cast(amount as decimal(18,2)) * 0.01)] as value, strftime(min(created), '%Y-%m-%d %H:%M:%S.%f') first_at,
  strftime(max(created), '%Y-%m-%d %H:%M:%S.%f') last_at, max(case when rn = 1 then transaction_id end) first_id from (
  select *, row_number() over (partition by order_id order by created, transaction_id) rn from v_valid) group by 1 having count(*) > 1""",
    "duplicate_payment_totals": """
with g as (select order_id, count(*) n, sum(cast(amount as decimal(18,2)) * 0.01) v from v_valid group by 1)
select count(*) orders, count(*) filter (n > 1) duplicate_orders, cast(sum(n) filter (n > 1) as bigint) duplicate_payments, D[sum(v) filter (n > 1)] as value from g""",
    "cancellation_report": """
select transaction_id, p.order_id, brand, o.order_number, D[o.total] order_total, cast(l_linenumber as integer) parts, TS[updated] canceled_at,
  case when q < 1 then cast(q * 60 + l_linenumber as varchar) || 'm' else cast(cast(round(cast(q + l_linenumber / 60 as decimal(18,6)), 1) as decimal(18,1)) as varchar) || 'h' end time_to_cancel
from v_purchases p left join v_orders o on o.order_id = p.order_id where status = 'voided'""",
    "purchase_tag_ids": """
select transaction_id, status, amount, TS[created] created, order_id tag_order, cast(l_suppkey as varchar) tag_company, cast(l_partkey as varchar) tag_customer,
  '["company_' || l_suppkey || '","order_' || l_orderkey || '","customer_' || l_partkey || '"]' tags_json from v_purchases""",
    "instalment_rows": """
select transaction_id, cast(i as integer) as number, strftime(created + to_days(cast(30 * i as integer)), '%Y-%m-%d') due, cents // l_linenumber amount
from v_purchases, unnest(range(1, l_linenumber + 1)) t(i)""",
    "purchase_order_lookup": """
select transaction_id, case when p.status <> 'paid' and o.is_canceled then -1 else l_orderkey end order_number,
  case when p.status = 'paid' then 'transaction' when o.is_canceled then 'none' else 'tag' end found_by,
  anticipation or coalesce(anticipates_default, false) anticipation
from v_purchases p join v_orders o on o.order_id = p.order_id left join v_workspace w on w.workspace_id = p.workspace_id""",
    "workspace_balances": """
with b as (select s_nationkey w, sum(cast(s_acctbal as decimal(18,2))) filter (s_acctbal > 0) b from supplier group by 1)
select D[sum(case when w <> 7 then coalesce(b, 0) else 0 end)] total, D[max(case when w = 7 then b end)] central, count(*) - count(b) as unknown, count(*) workspaces from b""",
    "freight_order_list": """
select order_id, domain_id, order_number, DAY[day] as day, delivery_provider, order_status, is_canceled, D[total] total, D[quoted] quoted, D[posting] posting, operator,
  DAY[posted_on] posted_on, sheet_status, has_label, D[final] as final, D[margin] margin from v_freight""",
    "freight_audits": """
with c as (select f.*, s.posting sp, s.sheet_status ss, cast(s.posting * 1.10 as decimal(18,2)) e from v_freight f
  join v_postings s on s.domain_id = f.domain_id and s.order_number = f.order_number
  where not is_canceled and f.day between (select min(posted_on) from v_postings) and (select max(posted_on) from v_postings))
select domain_id, order_number, 'late status' finding from c where order_status = 'WAITING' and ss not like '%RETIRADA%'
union all select domain_id, order_number, 'no label' from c where not has_label
union all select domain_id, order_number, 'freight off' from c where sp <> 0 and quoted > 0 and D[abs(quoted - e)] / D[e] > 0.05 and abs(quoted - e) > 1""",
    "freight_charge": "select domain_id, count(*) orders, D[sum(posting)] posting, D[sum(cast(posting * 1.10 as decimal(18,2)))] charge from v_postings group by 1",
    "freight_half_months": """
select DAY[f] from_day, DAY[t] to_day, count(*) lines, D[cast(sum(cents) as decimal(18,2)) * 0.01] posting from (
  select cents, case when day(posted_on) <= 15 then date_trunc('month', posted_on) else date_trunc('month', posted_on) + interval 15 day end f,
    case when day(posted_on) <= 15 then date_trunc('month', posted_on) + interval 14 day else last_day(posted_on) end t from v_close) group by f, t""",
    "freight_two_sources": """
select company_id, DAY[m] as month, D[sum(v)] as value from (
  select company_id, date_trunc('month', created_at) m, quoted v from v_orders union all select company_id, date_trunc('month', due_at), fee from v_receivables) group by company_id, m""",
    "client_inferred_brands": """
select doc, domain_id, orders, cast(position as integer) position from (
  select *, row_number() over (partition by doc order by orders desc, domain_id) position from (select customer_doc doc, domain_id, count(*) orders from v_orders group by 1, 2))
where position <= 5""",
    "deal_last_meeting_asof": "select deal_id, company_id, coalesce(meeting_id, -1) meeting_id, coalesce(owner_rank, -1) owner_rank from v_deal_match",
    "weekly_matrix_zero_filled": "select owner_rank, DAY[week] as week, cast(meetings as bigint) meetings, cast(deals as bigint) deals from v_matrix",
    "meeting_deal_conversion": """
select owner_rank, cast(sum(meetings) as bigint) meetings, cast(sum(deals) as bigint) deals,
  case when sum(meetings) > 0 then D[sum(deals)] * 100.0 / D[sum(meetings)] else 0 end conversion from v_matrix group by 1""",
    "closed_meetings_weekly": """
select owner_rank, strftime(date_trunc('week', start_at), '%Y-%m-%d') as week, count(*) meetings, count(*) filter (closed) closed from v_meetings group by 1, 2""",
    "csat_note_lines": """
with n as (select p_partkey note_id, strftime(date '2025-01-01' + to_months(p_size % 12), '%Y-%m') as month, p_size // 5 b, p_name, p_brand, p_type from part)
select note_id, month, b + 0.5 score, p_name brand, lower(p_type) remark from n union all select note_id, month, D[b], p_brand, '' from n""",
    "average_of_weekly_averages": f"""
select DAY[m] as month, D[round(cast(avg(a) as decimal(18,8)), 4)] average, count(*) as weeks from (
  select date_trunc('month', ts) m, date_trunc('week', ts) w, avg({_NUM}) a from events group by 1, 2) group by m""",
    "ai_panel_monthly": """
with o as (select brand, date_trunc('month', ts) m, count(*) orders, sum(total) sales from v_ai_orders group by 1, 2),
i as (select brand, date_trunc('month', ts) m, sum(total) interactions, sum(ai) ai from v_ai_inter group by 1, 2)
select coalesce(o.brand, i.brand) brand, DAY[coalesce(o.m, i.m)] as month, coalesce(orders, 0) orders, coalesce(D[sales], 0) sales,
  cast(coalesce(interactions, 0) as bigint) interactions, cast(coalesce(ai, 0) as bigint) ai,
  case when interactions > 0 then D[round(cast(D[ai] * 100.0 / D[interactions] as decimal(18,6)), 1)] else 0 end ai_pct
from o full join i on o.brand = i.brand and o.m = i.m""",
    "ai_panel_weekly": f"select brand, {_WEEK} as week, cast(sum(ai) as bigint) ai, cast(sum(greatest(0, total - ai)) as bigint) human from v_ai_inter group by 1, 2",
    "ai_sales_by_type": f"""
select brand, {_WEEK} as week, count(*) filter (kind = 0) direct, count(*) filter (kind = 1) influenced, count(*) filter (kind = 2) other,
  D[sum(case when kind = 0 then total else 0 end)] direct_value, D[sum(case when kind = 1 then total else 0 end)] influenced_value,
  D[sum(case when kind = 2 then total else 0 end)] other_value from v_ai_orders group by 1, 2""",
    "event_counts_weekly": f"select user_id brand, {_WEEK} as week, event_type event, count(*) n from events group by 1, 2, 3",
    "feature_flags_month": """
select DAY[month] as month, count(*) domains, D[sum(gmv)] gmv, count(*) filter (n >= 1) has_orders, count(*) filter (n >= 2) over25, count(*) filter (n >= 3) over80,
  count(*) filter (p > 0) integration_on, count(*) filter (k > 0) payment_on, count(*) filter (p > 0 and k > 0) freight_on, count(*) filter (p > 1) assistant_on,
  count(*) filter (x > 0) lost25, count(*) filter (x > 1) lost80, count(*) filter (p > 0 and x > 0) lost_integration, count(*) filter (k > 0 and x > 0) lost_payment,
  count(*) filter (x = n) lost_freight from v_domain_month group by month""",
    "feature_flags_domain": """
select m.*, orders, D[gmv] gmv, payment_orders, freight_orders from (
  select domain_id, bool_or(p > 0) integration_on, bool_or(k > 0) payment_on, bool_or(p > 0 and k > 0) freight_on, bool_or(p > 1) assistant_on from v_domain_month group by 1) m
join (select domain_id, count(*) orders, sum(total) gmv, count(*) filter (payment_method <> 'BOLETO') payment_orders, count(label_url) freight_orders from v_orders group by 1) o
  on o.domain_id = m.domain_id""".replace("select m.*,", "select m.domain_id, integration_on, payment_on, freight_on, assistant_on,"),
    "active_domains_enriched": "select * from v_register",
    "active_domains_strict": """
select domain_id, domain_name, partner_id from v_domains where modules like '%vendas%' and partner_id <> 'BUILDING' and domain_name not ilike '%teste%'""",
    "register_counts": """
select count(*) filter (is_hq) headquarters, count(*) filter (not is_hq) branches, count(*) companies from v_register
where domain_id in (select cast(domain_id as bigint) from v_orders where created_at >= timestamp '2001-01-01')""",
    "inactive_duplicate_removal": """
with c as (select company_id, substr(tax_document, 1, 8) || '000100' tax_document,
  (select count(*) from v_orders o where o.company_id = c.company_id) orders from v_companies c)
select * from c where orders > 0 or tax_document not in (select tax_document from c where orders > 0)""",
    "company_groups": "select * from v_groups",
    "links_clicks_canonical": """
with a as (select cast(user_id as varchar) company_id, date_trunc('month', ts) m, 1 l, 0 k from events where event_type = 'signup'
  union all select cast(user_id as varchar), date_trunc('month', ts), 0, cast(json_extract_string(props, '$.k') as integer) from events where event_type = 'click')
select coalesce(hq_id, a.company_id) hq_id, DAY[m] as month, cast(sum(l) as bigint) links, cast(sum(k) as bigint) clicks
from a left join v_groups g on g.company_id = a.company_id group by coalesce(hq_id, a.company_id), m""",
    "canonical_companies": """
select domain_id, company_id canonical_id from (
  select domain_id, company_id, row_number() over (partition by domain_id order by (select count(*) from v_orders o where o.company_id = c.company_id) desc, company_id) rn
  from v_companies c) where rn = 1""",
    "normalise_names": """
select conv_id, turn, array_to_string([w for w in string_split(regexp_replace(regexp_replace(strip_accents(lower(text)), '(^|[^a-z0-9])s\\.a\\.', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), ' ')
    if w not in ('', 'jeans', 'modas', 'moda', 'confeccoes', 'oficial', 'clothing', 'collection', 'acessorios', 'tricot', 'ltda', 'me', 'eireli', 'sa')], ' ') as name,
  trim(strip_accents(lower(text))) light, regexp_replace(strip_accents(upper(replace(text, 'ß', 'ss'))), '[^A-Z0-9]', '', 'g') as key from conversations""",
    "plan_main_lines": "select tax_id, lines, brand, plan, line_no, D[total] total from v_plan_main",
    "tiered_plan_match": """
with p as (select *, strip_accents(lower(brand)) nm, substr(tax_id, 1, 8) root from v_plan_main),
c as (select company_id, tax_document, case when length(tax_document) >= 8 then substr(tax_document, 1, 8) end root, lower(name) nm from v_named),
n as (select distinct nm from c), b as (select * from (select *, row_number() over (partition by nm order by total desc, tax_id) rk from p) where rk = 1),
r as (select * from (select *, row_number() over (partition by root order by total desc, tax_id) rk from p) where rk = 1),
k as (select n.nm, b.tax_id, b.plan, b.total, row_number() over (partition by n.nm order by b.total desc, b.tax_id) rk from n join b
  on length(n.nm) >= 5 and length(b.nm) >= 5 and (contains(n.nm, b.nm) or contains(b.nm, n.nm)) where n.nm not in (select nm from b))
select company_id, case when t.tax_id is not null then 'tax id' when r.tax_id is not null then 'tax root' when b.tax_id is not null then 'name' else 'part of name' end tier,
  coalesce(t.tax_id, r.tax_id, b.tax_id, k.tax_id) tax_id, coalesce(t.plan, r.plan, b.plan, k.plan) plan, D[coalesce(t.total, r.total, b.total, k.total)] total
from c left join p t on t.tax_id = c.tax_document left join r on r.root = c.root left join b on b.nm = c.nm left join k on k.nm = c.nm and k.rk = 1
where coalesce(t.tax_id, r.tax_id, b.tax_id, k.tax_id) is not null""",
    "tiered_invoice_match": """
with d as (select p_partkey domain_id from part where p_size > 40),
b as (select distinct trim(regexp_replace(lower(case when p_size < 10 then p_name when p_size < 30 then p_name || ' ' || substr(lower(p_type), 1, 3)
  else p_name || ' ' || p_type || ' ' || p_brand end), '[^a-z0-9]+', ' ', 'g')) nm from part),
c as (select *, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) nm from v_named), n as (select distinct nm from c),
k as (select n.nm, b.nm pick, row_number() over (partition by n.nm order by least(length(n.nm), length(b.nm)) desc, b.nm) rk from n join b
  on length(b.nm) >= 4 and (starts_with(n.nm, b.nm) or starts_with(b.nm, n.nm)) where n.nm not in (select nm from b))
select company_id, case when d.domain_id is not null then 'domain' when b.nm is not null then 'brand' else 'prefix' end tier,
  coalesce(cast(d.domain_id as varchar), b.nm, k.pick) invoice_key
from c left join d on d.domain_id = c.domain_id left join b on b.nm = c.nm left join k on k.nm = c.nm and k.rk = 1
where coalesce(cast(d.domain_id as varchar), b.nm, k.pick) is not null""",
    "tiered_panel_match": """
with p as (select distinct case when p_size > 45 then p_name || ' ' || p_type when p_size > 40 then p_name else split_part(p_name, ' ', 2) end panel from part),
e as (select lower(panel) low, min(panel) panel from p group by 1),
o as (select trim(regexp_replace(lower(panel), '[^a-z0-9]+', ' ', 'g')) nm, min(panel) panel from p group by 1),
c as (select *, lower(name) low, case when domain_id >= 10 then lower(split_part(name, ' ', 1) || ' ' || split_part(name, ' ', 2)) end conf,
  trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) nm from v_named), n as (select distinct nm from c),
k as (select n.nm, o.panel, row_number() over (partition by n.nm order by o.nm = n.nm desc, least(length(n.nm), length(o.nm)) desc, o.panel) rk from n join o
  on contains(n.nm, o.nm) or contains(o.nm, n.nm))
select company_id, case when e.panel is not null then 'name' when f.panel is not null then 'config' else 'part of name' end tier, coalesce(e.panel, f.panel, k.panel) panel
from c left join e on e.low = c.low left join e f on f.low = c.conf left join k on k.nm = c.nm and k.rk = 1 and c.conf is not null
where coalesce(e.panel, f.panel, k.panel) is not null""",
    "fuzzy_ticket_match": """
with t as (select distinct nm from v_tickets),
pairs as (select t.nm, c.nm cn, c.company_id, case when t.nm = c.nm then 3 when contains(t.nm, c.nm) or contains(c.nm, t.nm) then 2 else 1 end tier,
  case when contains(t.nm, c.nm) or contains(c.nm, t.nm) then least(length(t.nm), length(c.nm)) else
    list_sum([list_sum([case when a = b then 2 when starts_with(a, b) or starts_with(b, a) then 1 else 0 end
      for b in [w for w in string_split(c.nm, ' ') if length(w) >= 3]]) for a in [w for w in string_split(t.nm, ' ') if length(w) >= 3]]) end score
  from t, v_norm_companies c),
best as (select * from (select *, row_number() over (partition by nm order by tier desc, score desc, company_id) rk from pairs where tier > 1 or score >= 2) where rk = 1)
select ticket_id, case tier when 3 then 'name' when 2 then 'part of name' else 'words' end tier, company_id from v_tickets join best using (nm)""",
    "survey_brand_match": """
with s as (select distinct p_name || case when p_size > 25 then ' ec' else '' end brand from part), c as (select lower(name) nm, min(company_id) company_id from v_named group by 1)
select brand, company_id from (select s.brand, c.company_id, row_number() over (partition by s.brand order by (c.nm = s.brand) desc, least(length(s.brand), length(c.nm)) desc, company_id) rk
  from s join c on c.nm = s.brand or (length(s.brand) >= 4 and length(c.nm) >= 4 and (starts_with(c.nm, s.brand) or starts_with(s.brand, c.nm)))) where rk = 1""",
    "survey_user_match": """
with u as (select c_custkey user_id, c_custkey // 3 domain_id, '119' || lpad(cast(c_custkey // 2 as varchar), 4, '0') || lpad(cast(c_nationkey as varchar), 4, '0') ph from customer),
a as (select c_custkey answer_id, '55119' || lpad(cast(c_custkey as varchar), 4, '0') || lpad(cast(c_nationkey as varchar), 4, '0') phone from customer),
f as (select * from (select *, row_number() over (partition by right(ph, 10) order by user_id) rk from u) where rk = 1)
select answer_id, phone, coalesce(user_id, -1) user_id, coalesce(domain_id, -1) domain_id from a left join f on right(f.ph, 10) = right(a.phone, 10)""",
    "month_table": f"""
select domain_id, DAY[month] as month, {_KPI}, D[pending_value] pending_value, card_orders, pix_orders, D[card_value] card_value, D[pix_value] pix_value,
  cast(links as bigint) links, cast(clicks as bigint) clicks from v_months""",
    "global_month_series": "select DAY[m] as month, "
    + ", ".join(f"cast(sum({c}) as bigint) {c}" for c in ("orders", "paid", "canceled", "pending", "card_orders", "pix_orders", "links", "clicks"))
    + ", "
    + ", ".join(f"D[sum({c})] as {c}" for c in ("value", "paid_value", "canceled_value", "pending_value", "card_value", "pix_value"))
    + " from (select *, month m from v_months) group by m order by m desc limit 18",
    "company_mart": """
select company_id, domain_id, name, is_hq, cast(orders as bigint) orders, cast(paid as bigint) paid, cast(canceled as bigint) canceled, D[value] as value, D[pix_value] pix_value,
  cast(card_orders as bigint) card_orders, cast(last3 as bigint) last3, cast(prev3 as bigint) prev3, D[bill_paid] bill_paid, bills, bill_status, cast(links as bigint) links, cast(clicks as bigint) clicks, D[freight_cost] freight_cost, D[fee] fee,
  has_integration, has_payment, score, case when score >= 60 then 'high' when score >= 30 then 'medium' else 'low' end risk, reasons from v_mart""",
    "company_siblings": """
select domain_id, first_value(company_id) over (partition by domain_id order by row_num) hq_id, company_id, trade_name, is_hq, members from (
  select *, count(*) over (partition by domain_id) members from v_register) where members > 1""",
    "order_quality": """
select count(*) orders, count(distinct date_trunc('month', created_at)) as months, count(*) filter (coalesce(payment_status, '') = '') without_status from v_orders""",
    "unmatched_receivables": """
select count(*) as rows, count(distinct order_id) keys from v_receivables where order_id not in (select order_id from v_orders where is_paid)""",
    "table_profile": " union all ".join(
        f"select '{c}' as column, count(*) as rows, count({c}) filled, count(distinct {c}) as distinct from documents" for c in ("doc_id", "text", "lang", "source", "n_chars")
    ),
    "value_counts": "select source, count(*) n from documents group by 1",
}

_BODIES |= {
    "activity_rollup": """
with a as (select cast(user_id as varchar) company_id, date_trunc('month', ts) m, 1 l, 0 k from events where event_type = 'signup'
  union all select cast(user_id as varchar), date_trunc('month', ts), 0, cast(json_extract_string(props, '$.k') as integer) from events where event_type = 'click'),
j as (select hq_id h, m, l, k from a join v_groups g on g.company_id = a.company_id)
select coalesce(h, 'all') hq_id, coalesce(strftime(m, '%Y-%m'), 'all') as month, cast(sum(l) as bigint) links, cast(sum(k) as bigint) clicks
from j group by grouping sets ((h, m), (h), (m))""",
    "latest_tickets": """
select ticket_id, company_id, DAY[modified] modified, stage from (
  select event_id ticket_id, user_id company_id, cast(ts as date) modified, event_type stage,
    row_number() over (partition by user_id order by cast(ts as date) desc, event_id desc) rn from events) where rn = 1""",
    "group_heads": """
select domain_id, hq_id, marked from (
  select domain_id, first_value(company_id) over w hq_id, first_value(r) over w = 1 marked, row_number() over w rn
  from (select *, row_number() over (partition by domain_id order by created_at, company_id) r from v_companies) where status = 1
  window w as (partition by domain_id order by r)) where rn = 1""",
    "active_brands": """
select company_id, case when (company_name is not null and status = 1) or domain_id < 50 then 'Sim' when company_name is not null and status = 2 then 'Não' else '' end active_brand from v_companies""",
    "active_brands_by_cards": """
select domain_id, cast(sum(card_orders) as bigint) card_orders, case when sum(card_orders) >= 8 then 'Sim' else 'Não' end active_brand from v_split group by 1""",
    "company_freight": """
with m as (select company_id, strftime(due_at, '%Y-%m') m, sum(case when fee > 3000 then fee else 0 end) v from v_receivables group by 1, 2)
select company_id, coalesce(m, 'all') as month, D[sum(v)] as value from m where v > 0 group by grouping sets ((company_id, m), (company_id))""",
    "freight_measures": """
select count(*) orders, count(*) filter (posting > 0) with_freight, D[sum(posting)] total, D[sum(posting)] / count(posting) average, count(distinct domain_id) domains from v_freight""",
    "freight_field_differences": """
with s as (select domain_id, order_number, cast(sum(cents) / 100 as decimal(18,2)) p, max(operator) op from v_close group by 1, 2),
j as (select s.*, o.is_canceled, o.is_paid, case when o.is_paid then o.quoted end q from s join v_orders o on cast(o.domain_id as bigint) = s.domain_id and o.order_number = s.order_number),
t as (select *, 'R$ ' || translate(format('{:,.2f}', cast(p as double)), ',.', '.,') pt, case when q is null then '-' else 'R$ ' || translate(format('{:,.2f}', cast(q as double)), ',.', '.,') end qt from j)
select domain_id, order_number, 'destination' field, 'Rio/SP - x' sheet, 'SAO-PAULO/sp' system from t where op <> 'N'
union all select domain_id, order_number, 'canceled', 'posted', 'canceled' from t where is_canceled
union all select domain_id, order_number, 'posting', pt, qt from t where q is null or abs(p - q) > 0.01""",
    "payment_provider_totals": """
select company_id, D[sum(case when payment_method = 'PIX' then total else 0 end)] pix_value, D[sum(case when payment_method = 'CREDIT_CARD' then total else 0 end)] card_value,
  count(*) filter (payment_method = 'PIX') pix_orders, count(*) filter (payment_method = 'CREDIT_CARD') card_orders, D[sum(total)] as value, count(*) orders,
  count(*) filter (is_paid) paid, D[sum(case when is_paid then total else 0 end)] paid_value
from v_orders where delivery_provider in ('Jadlog', 'Total Express') group by 1""",
    "payment_churn_value_lost_same_month": """
with m as (select o.domain_id, date_trunc('month', created_at) as month, last_payment, sum(total) v from v_orders o join v_payment_churn c on c.domain_id = o.domain_id
  where payment_method <> 'BOLETO' group by 1, 2, 3),
t as (select *, row_number() over (partition by domain_id order by month) rn from m
  where month between date_trunc('month', last_payment) - interval 1 month and date_trunc('month', last_payment))
select c.domain_id, D[coalesce(v, 0)] value_lost, case when month is null then 'none' when month < date_trunc('month', c.last_payment) then 'previous month' else 'same month' end note
from v_payment_churn c left join t on t.domain_id = c.domain_id and rn = 1""",
    "largest_orders": "select order_id, D[total] total from v_orders order by v_orders.total desc, order_id limit 20",
    "configured_assistants": """
select cast(c_custkey as varchar) company_id, c_name url, c_mktsegment in ('BUILDING', 'MACHINERY') retail from customer where c_nationkey > 5""",
}

_RECONCILED = """
with s as (select *, posting sp from v_postings where posted_on between date '1999-03-01' and date '1999-03-15'),
f as (select * from v_freight where day between (select min(posted_on) from s) and (select max(posted_on) from s)),
j as (select coalesce(s.domain_id, f.domain_id) domain_id, coalesce(s.order_number, f.order_number) order_number, s.sp sheet_posting, s.sheet_status, s.posted_on, f.day, f.is_canceled,
    f.order_status, f.quoted, f.has_label, f.posting system_posting, s.order_number is not null in_s, f.order_number is not null in_f,
    concat_ws(',', case when f.is_canceled then 'canceled' end, case when abs(s.sp - f.posting) > 0.01 then 'posting' when s.sp is not null and f.posting is null then 'no posting' end) diff,
    exists (select 1 from v_freight x where x.domain_id = s.domain_id and x.order_number = s.order_number) known
  from s full join f on s.domain_id = f.domain_id and s.order_number = f.order_number),
o as (select *, case when in_s and in_f then (case when diff = '' then 'ok' else 'different' end) when in_s and known then 'ok' when in_s then 'only_sheet'
    when is_canceled or order_status = 'SEPARATED' then 'ignored' else 'only_system' end outcome from j)
"""
_BODIES["freight_reconciliation"] = _RECONCILED + """
select domain_id, order_number, D[sheet_posting] sheet_posting, sheet_status, DAY[posted_on] posted_on, DAY[day] as day, coalesce(cast(is_canceled as varchar), '') is_canceled, order_status, D[quoted] quoted,
  coalesce(cast(has_label as varchar), '') has_label, D[system_posting] system_posting, outcome, case when in_s and in_f then diff else '' end differences from o"""
_BODIES["freight_reconciliation_summary"] = _RECONCILED + "select outcome, count(*) orders, D[sum(coalesce(sheet_posting, 0))] sheet_posting from o group by 1"
_BODIES["freight_sheet_reapplied"] = """
with a as (select domain_id, order_number, cast(sum(cents) / 100 as decimal(18,2)) post, max(posted_on) d, max(sheet_status) st from v_close where operator <> 'N' group by 1, 2),
n as (select domain_id, order_number, cast(sum(cents) / 100 as decimal(18,2)) post from v_close where operator = 'N' group by 1, 2),
j as (select f.order_id, f.day, f.order_status, f.quoted, a.post ap, a.d, a.st, n.post np from v_freight f
  left join a on a.domain_id = f.domain_id and a.order_number = f.order_number left join n on n.domain_id = f.domain_id and n.order_number = f.order_number)
select order_id, D[coalesce(ap, np)] posting, DAY[coalesce(d, day)] as day, coalesce(st, order_status) order_status, D[case when ap is not null then (case when quoted > 0 then quoted - ap end) else quoted - np end] margin,
  D[case when ap is not null then greatest(quoted, cast(ap * 1.10 as decimal(18,2))) when np is not null then greatest(quoted, cast(np * 1.10 as decimal(18,2))) else quoted end] as final,
  case when ap is not null then 'sheet' when np is not null then 'close' else '' end posting_source from j"""

_BODIES |= {
    # Line 5 has no number in its text.
    "money_texts": """
select l_linenumber, count(*) filter (l_linenumber <> 5) as read,
  D[sum(case when l_linenumber <> 5 then cast(floor(l_extendedprice) as bigint) * 100 + cast(l_quantity as integer) end)] / 100 as value
from lineitem group by 1""",
    "date_texts": "select o_orderpriority, DAY[o_orderdate] as day, count(*) orders from orders group by o_orderpriority, o_orderdate",
    "status_labels": """
select o_orderstatus stage, count(*) orders, case o_orderstatus when 'F' then 'Concluído' when 'O' then 'Fila' else o_orderstatus end label from orders group by 1""",
    "register_overlay": """
select company_id, social_name company_name, case when domain_id < 100 then '9' else cast(status as varchar) end status from v_companies""",
    "values_from_previous": "select company_id, coalesce(company_name, lower(social_name)) company_name from v_companies",
    "mart_patched": """
select company_id, domain_id, coalesce(n, 0) links from v_companies left join (
  select cast(user_id as varchar) company_id, count(*) n from events where event_type = 'signup' group by 1) using (company_id)""",
    "monthly_fee_precedence": """
select c_custkey, case when c_nationkey < 5 and c_acctbal > 0 then D[cast(c_acctbal as decimal(18,2))] when cast(c_acctbal as decimal(18,2)) > 3000 then D[cast(c_acctbal as decimal(18,2)) - 3000]
  when c_nationkey > 0 then D[c_nationkey] else 0 end monthly_fee from customer""",
    "invoices_waiting": "select invoice_id, TS[due_at] due_at, total_cents from v_unique_invoices where status = 'pending'",
    "payment_key_register": """
with k as (select upper(p_name) brand, '+55' || min(lpad(cast(p_partkey as varchar), 11, '0')) payment_key from part group by 1),
c as (select *, row_number() over (partition by p_name order by p_size desc, cast(p_partkey as varchar) desc) rn from part)
select brand, payment_key, cast(p_partkey as varchar) company_id, p_size domain_id from k join c on lower(brand) = p_name and rn = 1""",
    "payment_key_lookup": """
with t as (select tax_document, 'tax-' || min(company_id) k from v_companies where status = 2 group by 1),
n as (select lower(company_name) nm, 'name-' || min(company_id) k from v_companies where company_name is not null group by 1)
select company_id, c.tax_document tax_id, social_name, coalesce(t.k, n.k) payment_key from v_companies c left join t on t.tax_document = c.tax_document left join n on n.nm = lower(c.social_name)""",
    "csat_form_answers": """
select case when p_size = 2 then null else p_brand end brand, D[case when p_size < 30 then p_size // 5 + 0.5 else p_size end] score,
  strftime(epoch_ms(1700000000000 + p_partkey * 3600000), '%Y-%m-%d') as day from part where p_size < 45 and p_size <> 1""",
    "nps_survey_rows": """
select c_name as name, case when c_nationkey = 3 then '-' else c_mktsegment end as comment, case when c_nationkey = 4 then -1 else c_custkey end domain_id,
  c_nationkey % 11 score from customer where c_acctbal > 0""",
    "manual_postings": """
with r as (select case when l_quantity > 25 then 'c' || l_orderkey else '' end internal_code, strftime(l_shipdate, '%Y-%m-%d') posted_on, cast(l_suppkey as varchar) invoice_no,
    cast(l_quantity as integer) posting, l_returnflag, case when l_quantity > 25 then 'c' || l_orderkey else concat_ws('_', strftime(l_shipdate, '%Y-%m-%d'), l_suppkey, cast(l_quantity as integer)) end k from lineitem)
select internal_code, posted_on, invoice_no, posting from r where l_returnflag = 'A'
union all select internal_code, posted_on, invoice_no, posting from (
  select *, row_number() over (partition by k order by internal_code, posted_on, invoice_no, posting) rn from r
  where l_returnflag <> 'A' and k not in (select k from r where l_returnflag = 'A')) where rn = 1""",
    "sheet_total_row": "select D[sum(cast(l_quantity as integer))] sheet_total from lineitem",
    "latest_sheet_lines": "select p_partkey, p_name, 'Planos 07-2024' sheet from part where p_size = 50",
    "plan_fallback_source": "select tax_id, plan, case when lines = 1 then D[total] else 0 end total from v_plan_main",
    "export_chunk_map": """
select company_id, cast((row_number() over (order by n desc, company_id) - 1) // 50 as integer) chunk from (select company_id, count(*) n from v_orders group by 1)""",
    "month_vectors": """
select domain_id, strftime(month, '%Y-%m') as month, concat_ws(',', orders * 100, paid * 100, canceled * 100, pending * 100, cast(value * 100 as bigint), cast(paid_value * 100 as bigint),
  cast(canceled_value * 100 as bigint), cast(pending_value * 100 as bigint), card_orders * 100, pix_orders * 100, cast(card_value * 100 as bigint), cast(pix_value * 100 as bigint),
  cast(links * 100 as bigint), cast(clicks * 100 as bigint)) vector from v_months""",
    "panel_vectors": """
select domain_id, strftime(month, '%Y-%m') as month, concat_ws(',', n * 100, cast(gmv * 100 as bigint), 100 * (n >= 2)::int, 100 * (n >= 3)::int, 100 * (p > 0)::int, 100 * (k > 0)::int,
  100 * (p > 0 and k > 0)::int, 100 * (p > 1)::int, 100 * (x > 0)::int, 100 * (x > 1)::int, 100 * (p > 0 and x > 0)::int, 100 * (k > 0 and x > 0)::int, 100 * (x = n)::int) vector
from v_domain_month""",
    "domain_freight_audit": """
with f as (select * from v_freight where day between (select min(posted_on) from v_postings) and (select max(posted_on) from v_postings)),
j as (select coalesce(s.domain_id, f.domain_id) domain_id, coalesce(s.order_number, f.order_number) order_number, s.posting sp, f.posting fp, f.is_canceled, s.order_number is not null in_s,
    f.order_number is not null in_f from v_postings s full join f on s.domain_id = f.domain_id and s.order_number = f.order_number)
select domain_id, order_number, D[sp] sheet_posting, D[fp] system_posting, case when in_s and in_f then (case when is_canceled then 'different' else 'ok' end)
  when in_s then 'only_sheet' when is_canceled then 'ignored' else 'only_system' end outcome from j
where domain_id = (select domain_id from v_postings group by 1 order by count(*) desc, domain_id limit 1)""",
    "panel_stats_kept": """
with a as (select brand, ts >= timestamp '2024-01-15' late, count(*) n, sum(total) s from v_ai_orders group by 1, 2)
select brand, max(n) orders, D[max(s)] sales from a group by 1""",
    "people_of_two_sources": "select n_name as name from nation union select c_mktsegment from customer",
    "local_days": """
with e as (select cast(ts - interval 3 hour as date) d, count(*) events from events group by 1)
select DAY[d] as day, events, (case month(d) when 1 then 'jan' when 12 then 'dez' end) || '/' || strftime(d, '%y') label,
  strftime(d + (case dayofweek(d) when 6 then 2 when 0 then 1 else 0 end), '%Y-%m-%d') business_day from e""",
    "years_scanned": """
select DAY[m] as month, count(*) orders, D[sum(total)] as value from (select date_trunc('month', created_at) m, total from v_orders where year(created_at) in (1999, 2000)) group by m""",
    "assistant_last_months": """
select domain_id, DAY[month] as month, orders from (select *, row_number() over (partition by domain_id order by month desc) rn from v_monthly) where rn <= 3""",
    "weekly_event_maps": f"""
select brand, week, string_agg(event_type || '=' || n, ',' order by event_type) as events from (
  select user_id brand, {_WEEK} as week, event_type, count(*) n from events group by 1, 2, 3) group by 1, 2""",
    "club_month_maps": "select domain_id, string_agg(strftime(month, '%Y-%m') || '=' || orders, ',' order by month) as months from v_club group by 1",
}
_BODIES["risk_counts"] = f"select risk, count(*) companies from ({_BODIES['churn_score']}) group by 1"


_BODIES |= {
    "payment_churn_active": """
with o as (select domain_id, date_trunc('month', created_at) as month, sum(total) v from v_orders where payment_method <> 'BOLETO' group by 1, 2),
m as (select o.*, row_number() over (partition by o.domain_id order by o.month desc) rn from o join v_payment_churn c on c.domain_id = o.domain_id
  where v > 0 and o.month <= date_trunc('month', last_payment) - interval 1 month)
select c.domain_id, domain_name, coalesce(n_name, '') as owner, DAY[last_payment] last_payment, DAY[last_order] last_order, payment_orders,
  DAY[date_trunc('month', last_payment) + interval 1 month] churn_month, D[coalesce(v, 0)] value_lost
from v_payment_churn c join v_active a on cast(a.domain_id as varchar) = c.domain_id left join nation on cast(n_nationkey as varchar) = angel_id
  left join m on m.domain_id = c.domain_id and rn = 1""",
    "payment_churn_pivot": """
select DAY[m] churn_month, owner, count(*) clients from (
  select date_trunc('month', last_payment) + interval 1 month m, coalesce(n_name, '') as owner from v_payment_churn c join v_active a on cast(a.domain_id as varchar) = c.domain_id
  left join nation on cast(n_nationkey as varchar) = angel_id) group by m, owner""",
    "payment_churn_history": """
select domain_id, DAY[m] as month, D[pix] pix, D[card] card from (
  select domain_id, date_trunc('month', created_at) m, sum(case when payment_method = 'PIX' then total else 0 end) pix, sum(case when payment_method = 'CREDIT_CARD' then total else 0 end) card
  from v_orders where payment_method <> 'BOLETO' and domain_id in (select c.domain_id from v_payment_churn c join v_active a on cast(a.domain_id as varchar) = c.domain_id) group by 1, 2)
where pix + card > 0""",
    "sheet_snapshot_merge": """
with a as (select domain_id, order_number, operator = 'A' fresh, cast(sum(cents) / 100 as decimal(18,2)) posting, max(operator) operator from v_close group by 1, 2, 3)
select domain_id, order_number, D[posting] posting, operator from a
where fresh or not exists (select 1 from a b where b.fresh and b.domain_id = a.domain_id and b.order_number = a.order_number)""",
    "csv_read_back": """
select p_partkey note_id, strftime(date '2025-01-01' + to_months(cast(p_size % 12 as integer)), '%Y-%m') as month,
  '"' || (p_size // 5) || ',5 - ' || p_name || ' (' || lower(p_type) || ')' || chr(10) || (p_size // 5) || ' - ' || p_brand || chr(10) || 'sem nota ' || p_name || '"; x' as note from part""",
    "csv_typed_read_back": "select order_id, order_number, D[total] total, is_paid from v_orders",
    "json_read_back": "select cast(s_suppkey as varchar) company_id, s_name company_label, s_acctbal < 0 fee_enabled from supplier",
    "purchase_documents": """
select transaction_id purchase_id, workspace_id, order_id, status purchase_status, amount amount_cents, anticipation, strftime(cast(created as date) - 1, '%Y-%m-%d') created_on,
  '["company_' || l_suppkey || '","order_' || l_orderkey || '","customer_' || l_partkey || '"]' tags from v_purchases""",
    "instalment_documents": """
select cast(k as integer) installment_number, count(*) n, sum(cents // l_linenumber) cents, strftime(min(cast(created as date) + cast(30 * k as integer)), '%Y-%m-%d') first_due
from (select *, unnest(range(1, l_linenumber + 1)) k from v_purchases) group by k""",
    "datasets_read_back": """
select delivery_provider brand, count(*) as rows, false skipped, D[sum(total)] total from v_orders group by 1 union all select 'broken', null, true, null""",
    "datasets_with_damaged_pages": """
select delivery_provider brand, case when delivery_provider <> 'Jadlog' then count(*) end as rows, case when delivery_provider = 'Jadlog' then true end damaged,
  case when delivery_provider <> 'Jadlog' then count(*) end orders, case when delivery_provider <> 'Jadlog' then D[sum(total)] end total
from v_orders group by 1""",
    "checked_purchase_documents": """
select transaction_id, case when kind = 3 then amount end amount_cents, case kind when 0 then 'no JSON' when 1 then 'purchase.amount: x is no value' when 2 then 'another structure' end reason
from (select *, case when l_orderkey % 100 = 0 then l_linenumber % 3 else 3 end kind from v_purchases)""",
    "checked_csv_orders": """
select order_id, case when kind = 3 then D[total] end total, case kind when 0 then 'total: x is no decimal(18,2)' when 1 then 'is_paid: perhaps is no boolean' when 2 then 'more than 4 fields' end reason
from (select *, case when order_number % 100 = 0 then order_number // 100 % 3 else 3 end kind from v_orders)""",
    "catalog_scan": "select order_id, D[total] total from v_orders where is_paid",
    "model_columns": "select domain_id, domain_name as name from v_domains",
    "text_fallbacks": """
select c_custkey, case when c_acctbal > 0 then c_mktsegment else c_name end as name, c_name client, strftime(make_date(2024, cast(c_nationkey % 12 + 1 as integer), 1), '%Y-%m-%d') as month,
  left('["' || c_name || '","' || c_mktsegment || '"]', 20) tags from customer""",
    "stamped_rows": "select distinct c_mktsegment partner_id, lower(c_mktsegment) partner, 'register' as source, 0 as rank from customer",
    "overwritten_table": "select cast(n_nationkey as varchar) angel_id, n_name angel_name from nation",
    "snapshot_days": """
select '2024-01-01' snapshot_date, count(*) as rows from region union all select '2024-01-02', count(distinct c_mktsegment) from customer""",
    "overwritten_orders": "select order_id, company_id, order_status, D[total] total from v_orders",
    "snapshot_orders": """
select order_id, order_status, D[total] total, case order_status when 'DELIVERED' then '2024-01-01' when 'WAITING' then '2024-01-02' else '2024-01-03' end snapshot_date from v_orders""",
    "merged_state": """
select company_id, order_id, order_status from (select *, row_number() over (partition by company_id order by created_at desc, order_id desc) rn from v_orders where year(created_at) between 1992 and 2001) where rn = 1""",
    "merged_state_buckets": """
select order_id, company_id, D[total] total,
  case when cast(order_id as bigint) % 1000 = 0 then 'LOST' when cast(order_id as bigint) % 7 = 0 then 'CLOSED' when cast(order_id as bigint) % 3 = 0 then 'RETURNED'
       when cast(order_id as bigint) % 2 = 0 then 'SENT' else order_status end order_status,
  case when cast(order_id as bigint) % 1000 = 0 then 4 when cast(order_id as bigint) % 7 = 0 then 3 when cast(order_id as bigint) % 3 = 0 then 2
       when cast(order_id as bigint) % 2 = 0 then 1 else 0 end batch
from v_orders""",
    "published_after_audit": """
with o as (select cast(order_id as bigint) k, payment_status, total from v_orders),
half as (select * from o where k % 4 <> 0 and k % 9 <> 0),
t as (select count(*) orders, D[sum(total)] total, avg(case when payment_status is null then 1.0 else 0 end) share from half)
select 'whole' "write", 'v000000001' version, 0 warnings, cast(null as bigint) orders, cast(null as double) total
union all select 'empty', null, 0, null, null union all select 'without status', null, 0, null, null union all select 'shrunken', null, 0, null, null
union all select 'half', 'v000000002', case when share > 0.2 then 1 else 0 end, orders, total from t""",
    "replaced_keys": """
with r as (select *, cast(company_id as bigint) % 2 = 0 even from v_receivables),
k as (select distinct company_id from r where rec_status <> 'paid' and even)
select company_id, rec_status, count(*) lines, D[sum(gross)] gross from r
where (rec_status = 'paid' and company_id not in (select company_id from k)) or (rec_status <> 'paid' and even) group by 1, 2""",
    "guard_outcomes": """
with f as (select avg(case when payment_status is null then 1.0 else 0 end) share from v_orders),
m as (select company_id, sum(total) v, count(*) n from v_orders group by 1),
t as (select count(*) c, sum(v) v, sum(n) n, count(*) filter (cast(company_id as bigint) % 2 = 0) hc, sum(v) filter (cast(company_id as bigint) % 2 = 0) hv, sum(n) filter (cast(company_id as bigint) % 2 = 0) hn from m)
select 'orders' guard, share <= 0.6 passed, cast(case when share between 0.2 and 0.6 then 1 else 0 end as integer) warnings from f
union all select 'orders empty', false, 0 union all select 'orders without status', false, 0 union all select 'mart', true, 0
union all select 'mart shrunken', hc >= 0.8 * c and hv >= 0.5 * v and hn >= 0.5 * n, 0 from t union all select 'rows', true, 0 union all select 'rows lost', hc >= 0.9 * c, 0 from t""",
    "numbered_without_dates": """
select company_id, d domain_id, row_number() over (partition by d order by made_at nulls first, company_id) row_num from (
  select company_id, case when cast(company_id as bigint) % 50 <> 0 then domain_id end d, case when status = 1 then created_at end made_at from v_companies)""",
}

_BODIES["purchase_history_merged"] = _BODIES["purchase_merge_latest"]
_BODIES["mart_refreshed"] = _BODIES["company_mart"]
_BODIES["weekly_counts_streamed"] = """
select user_id brand, event_type event, strftime(date_trunc('week', ts), '%Y-%m-%d') as week, count(*) n from events group by 1, 2, 3"""
_BODIES["profile_of_days"] = " union all ".join(
    f"select '{c}' as column, count(*) as rows, count({v}) filled, true as near from v_orders"
    for c, v in (("order_id", "order_id"), ("company_id", "company_id"), ("domain_id", "domain_id"), ("customer_doc", "customer_doc"), ("total", "total"), ("paid_at", "case when is_paid then 1 end"))
)


def _nested(body: str) -> str:
    """A body that starts with its own CTEs becomes a subquery behind the views."""
    return f"select * from ({body})" if body.lstrip().startswith("with") else body


ORACLES = {name: _sql(_nested(body)) for name, body in _BODIES.items()}

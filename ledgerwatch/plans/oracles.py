"""SQL counterparts of the registered queries, for any ANSI engine.

Each view restates a stand-in table of ``sources.tables``; the statements restate
the rules from their definition and share no code with the operators.
"""

from __future__ import annotations

def _parts(*texts: str) -> str:
    """Text expressions, each with its length before it."""
    return " || ".join(
        f"coalesce(cast(length({t}) as varchar) || ':' || {t}, '-')" for t in texts)


def _uuid(*texts: str) -> str:
    """MD5 of text expressions in UUID form."""
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr(md5({_parts(*texts)}), {a}, {n})" for a, n in cuts)


def _alert_id(*texts: str) -> str:
    return f"sha256({_parts(*texts)})"


VIEWS = {
    "tx": """
        select event_id, event_id as transaction_id, user_id as account_id,
               cast(value as decimal(15,2)) as amount, 'INR' as currency,
               case event_type when 'purchase' then 'DEBIT' when 'signup' then 'CREDIT'
                    when 'click' then 'DEBIT' when 'view' then 'CREDIT'
                    else 'REFUND' end as type,
               event_type as description,
               date_trunc('milliseconds', ts) as occurred_at
        from events""",
    "ord": """
        select o_orderkey as event_id, o_orderkey as transaction_id,
               o_custkey as account_id,
               cast(o_totalprice as decimal(15,2)) as amount,
               o_orderdate as occurred_at
        from orders""",
    "acc": """
        select c_custkey as account_id, c_name as owner_name,
               case c_mktsegment when 'BUILDING' then 'elite'
                    when 'MACHINERY' then 'Premium' when 'HOUSEHOLD' then 'gold'
                    when 'AUTOMOBILE' then 'STANDARD' end as tier
        from customer where c_acctbal >= 0""",
    "raw": """
        select tx.*, d.delivery, event_id * 3 + d.delivery - 1 as "offset"
        from tx join (values (1), (2), (3)) d(delivery)
          on d.delivery <= case description when 'purchase' then 3
                                when 'click' then 2 else 1 end""",
    "done": """
        select distinct event_id from tx
        where occurred_at < timestamp '2024-01-08'""",
    "arr": """
        select event_id, account_id, amount, event_id as "offset",
               account_id % 3 as partition,
               occurred_at - ((event_id * 7919) % 7200) * interval 1 second
                 as occurred_at
        from tx""",
    "box": """
        select '00000000-0000-0000-0000-' || lpad(cast(event_id as varchar), 12, '0') as id,
               case when description = 'error' then '"*"'
                    else '"' || to_base64(encode(description)) || '"' end as payload,
               description = 'purchase' as published,
               case when description = 'purchase'
                    then occurred_at + interval 1 second end as published_at,
               case when description = 'error'
                    then cast(floor(amount / 50) as integer) else 0 end as retry_count,
               occurred_at as created_at
        from tx""",
    "audit": """
        select *, time_bucket(interval 1 hour, occurred_at) + interval 1 hour as window_end,
               max(occurred_at) over (partition by partition order by "offset"
                    rows between unbounded preceding and current row) as stream_time
        from arr""",
    "judged": """
        select raw.*, '00000000-0000-0000-0000-' || lpad(cast(raw.event_id as varchar), 12, '0') as uuid_text,
               cast(cast(amount as double) as varchar) as amount_text,
               case when done.event_id is not null then 'DUPLICATE'
                    when cast(cast(amount as double) as varchar) like '%.99' then 'DLQ'
                    when delivery > 1 then 'DUPLICATE'
                    else 'SENT' end as status
        from raw left join done on raw.event_id = done.event_id""",
    "checked": f"""
        select tx.*, acc.account_id is not null as known,
               {_uuid("cast(event_id as varchar)")} as id
        from tx left join acc on tx.account_id = acc.account_id""",
    "lags": """
        select partition,
               max(event_id) + 1 - coalesce(
                   max(event_id) filter (where occurred_at < timestamp '2024-01-28') + 1, 0)
                 as lag
        from arr group by partition""",
}

USES = {
    "raw": ["tx"], "done": ["tx"], "arr": ["tx"], "box": ["tx"],
    "audit": ["arr"], "judged": ["raw", "done"], "checked": ["tx", "acc"],
    "lags": ["arr"],
}


def _with(names: list[str], body: str) -> str:
    """``body`` preceded by the views it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in USES.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{n} as ({VIEWS[n]})" for n in ordered)
    return f"with {views}\n{body}"


def _limit_of_tier(standard: int, premium: int, elite: int) -> str:
    return (f"case upper(tier) when 'ELITE' then {elite} "
            f"when 'PREMIUM' then {premium} else {standard} end")


def _high_value(source: str, limits: tuple[int, int, int] = (50000, 100000, 500000),
                tag: str = "") -> str:
    txn = f"'{tag}' || cast(s.transaction_id as varchar)"
    return f"""
        select {_alert_id("'HIGH_VALUE'", "cast(s.account_id as varchar)", f"({txn})")} as alert_id,
               s.account_id, {txn} as transaction_id, 'HIGH_VALUE' as alert_type,
               printf('Amount %.2f exceeds tier threshold', cast(s.amount as double)) as reason,
               cast(s.amount as double) as amount, acc.tier as account_tier,
               s.occurred_at as event_time
        from {source} s join acc on s.account_id = acc.account_id
        where s.amount > {_limit_of_tier(*limits)}"""


def _velocity(source: str, window: str, label: str) -> str:
    return f"""
        select {_alert_id("'VELOCITY'", "cast(account_id as varchar)",
                          f"cast(epoch_us(occurred_at - interval {window}) as varchar)")} as alert_id,
               account_id, 'MULTIPLE' as transaction_id, 'VELOCITY' as alert_type,
               cast(n as varchar) || ' transactions in {label} window' as reason,
               cast(0.0 as double) as amount, 'UNKNOWN' as account_tier,
               occurred_at as event_time
        from (select distinct account_id, occurred_at, count(*) over (
                  partition by account_id order by occurred_at
                  range between interval {window} preceding and current row) as n
              from {source})
        where n >= 3"""


def _spend(source: str) -> str:
    return f"""
        select account_id, time_bucket(interval 1 hour, occurred_at) as window_start,
               time_bucket(interval 1 hour, occurred_at) + interval 1 hour as window_end,
               sum(amount) as total
        from {source} group by all"""


def _rapid_large(spend: str, limit: int) -> str:
    return f"""
        select {_alert_id("'RAPID_LARGE'", "cast(account_id as varchar)",
                          "cast(epoch_us(window_start) as varchar)")} as alert_id,
               account_id, 'MULTIPLE' as transaction_id, 'RAPID_LARGE' as alert_type,
               printf('Total spend %.2f exceeds limit', cast(total as double)) as reason,
               cast(total as double) as amount, 'UNKNOWN' as account_tier,
               window_start as event_time
        from ({spend}) where total > {limit}"""


_PAY = """
    select 'E' || cast(event_id as varchar) as transaction_id, account_id, amount,
           occurred_at from tx
    union all
    select 'O' || cast(event_id as varchar), account_id, amount, occurred_at from ord"""

_QUANTILE_COLUMNS = ", ".join(
    f"round(quantile_cont(cast(amount as double), {q}), 4) as {name}"
    for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")))


def _alerts(source: str, spend_limit: int, window: str, label: str) -> str:
    return "\nunion all".join([
        _high_value(source), _velocity(source, window, label),
        _rapid_large(_spend(source), spend_limit)])


ORACLES = {
    "high_value_alerts": _with(["ord", "acc"], _high_value("ord")),
    "high_value_elite": _with(
        ["ord", "acc"], _high_value("ord", (500000, 500000, 450000))),
    "rapid_large_alerts": _with(["tx"], _rapid_large(_spend("tx"), 200)),
    "rapid_large_updates": _with(["raw"], _rapid_large("""
        select account_id, time_bucket(interval 1 hour, occurred_at) as window_start,
               sum(amount) over (
                   partition by account_id, time_bucket(interval 1 hour, occurred_at)
                   order by "offset" rows between unbounded preceding and current row)
                 as total
        from raw""", 200)),
    "velocity_alerts": _with(["tx"], _velocity("tx", "6 hours", "6-hour")),
    "velocity_all_windows": _with(["tx"], """
        select w.account_id, w.s as window_start,
               w.s + interval 6 hours as window_end, count(*) as n
        from (select account_id, occurred_at - interval 6 hours as s from tx
              union
              select account_id, occurred_at + interval 1 millisecond from tx) w
        join tx on tx.account_id = w.account_id
               and tx.occurred_at between w.s and w.s + interval 6 hours
        group by w.account_id, w.s having count(*) >= 3"""),
    "trailing_counts": _with(["tx"], """
        select event_id, account_id, occurred_at, count(*) over (
            partition by account_id order by occurred_at
            range between interval 6 hours preceding and current row) as n
        from tx"""),
    "fraud_alerts": _with(["tx", "ord", "acc"], f"""
        , pay as ({_PAY})
        {_alerts("pay", 100000, "6 hours", "6-hour")}"""),
    "fraud_alerts_on_copies": _with(
        ["raw", "acc"], _alerts("raw", 200, "5 minutes", "5-minute")),
    "fraud_alerts_null_ids": _with(["raw", "acc"], f"""
        , events as (
            select min(occurred_at) as occurred_at, event_id as transaction_id,
                   min(account_id) as account_id, min(amount) as amount
            from raw where description <> 'click' group by event_id
            union all
            select occurred_at, event_id, account_id, amount from raw
            where description = 'click')
        {_alerts("events", 200, "5 minutes", "5-minute")}"""),
    "fraud_alerts_on_events": _with(
        ["tx", "acc"], _alerts("tx", 200, "5 minutes", "5-minute")),
    "hourly_spend": _with(["tx"], f"""
        select account_id, window_start, window_end, cast(total as double) as total
        from ({_spend("tx")})"""),
    "enriched_transactions": _with(["tx", "acc"], """
        select tx.event_id, tx.account_id, cast(tx.amount as double) as amount,
               tx.occurred_at, acc.owner_name, acc.tier
        from tx join acc on tx.account_id = acc.account_id"""),
    "enriched_as_of": _with(["tx"], """
        select paid.event_id, paid.account_id, cast(paid.amount as double) as amount,
               paid.occurred_at, v.since, v.version, v.status
        from tx as paid
        asof join (select account_id, occurred_at as since, max(event_id) as version,
                          arg_max(description, event_id) as status
                   from tx where description not in ('purchase', 'click')
                   group by account_id, occurred_at) as v
          on paid.account_id = v.account_id and paid.occurred_at >= v.since
        where paid.description in ('purchase', 'click') and v.status <> 'error'"""),
    "alert_rows_json": _with(["ord", "acc"], f"""
        select alert_id as id, account_id, alert_type,
               '{{"transaction_id":"' || transaction_id || '","reason":"' || reason ||
               '","amount":' || case
                   when amount >= 10000000 then null else cast(amount as varchar) end ||
               case when account_tier is null then '' else
                   ',"account_tier":"' || account_tier || '"' end || '}}' as details,
               event_time as created_at
        from ({_high_value("ord")})"""),
    "latest_account_state": """
        select o_custkey as account_id, o_orderkey as version, o_orderstatus as status
        from (select *, row_number() over (
                  partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
              from orders)
        where rn = 1 and o_orderstatus <> 'F'""",
    "constraint_violations": _with(["tx"], """
        select event_id, case when type = 'REFUND' then 'type_domain'
                              else 'status_domain' end as violations
        from tx where type = 'REFUND' or description = 'view'"""),
    "orphan_transactions": _with(["tx", "acc"], """
        select event_id, account_id from tx
        where not exists (select 1 from acc where acc.account_id = tx.account_id)"""),
    "duplicate_keys": _with(["raw"], """
        select event_id, count(*) as copies from raw
        group by event_id having count(*) > 1"""),
    "dedupe_first_delivery": _with(["raw"], """
        select event_id, "offset", account_id, description
        from (select *, row_number() over (partition by event_id order by "offset") as rn
              from raw) where rn = 1"""),
    "new_vs_processed": _with(["raw", "done"], """
        select event_id, "offset",
               case when exists (select 1 from done where done.event_id = raw.event_id)
                    then 'processed' else 'new' end as state
        from raw"""),
    "consume_outcomes": _with(["judged"], """
        select uuid_text as event_id, "offset", status,
               case status when 'DLQ' then 3 when 'SENT' then 1 else 0 end as attempts,
               cast(case status when 'DLQ' then 3000 else 0 end as bigint) as backoff_ms,
               case status when 'DLQ' then 'Simulated notification failure for amount: '
                    || amount_text end as reason
        from judged"""),
    "dead_letters": _with(["judged"], """
        select cast(account_id as varchar) as key,
               '{"event_id":"' || uuid_text || '","account_id":' ||
               cast(account_id as varchar) || ',"offset":' ||
               cast("offset" as varchar) || '}' as value,
               'Simulated notification failure for amount: ' || amount_text as reason
        from judged where status = 'DLQ'"""),
    "notification_lines": _with(["judged"], """
        select uuid_text as event_id, account_id,
               'Notification sent: Account ' || cast(account_id as varchar) ||
               ' transaction for amount INR ' || amount_text as line
        from judged where status = 'SENT'"""),
    "ledger_additions": _with(["judged"], """
        select uuid_text as event_id, 'notification-service' as consumer_group
        from judged where status = 'SENT'"""),
    "retry_schedule": _with(["raw"], """
        select event_id, attempt, last_attempt_at, next_attempt_at,
               case when next_attempt_at is null then 'EXHAUSTED'
                    when next_attempt_at <= timestamp '2024-01-20' then 'DUE'
                    else 'WAITING' end as state
        from (select event_id, delivery as attempt, occurred_at as last_attempt_at,
                     case delivery when 1 then occurred_at + interval 1 second
                          when 2 then occurred_at + interval 2 seconds end as next_attempt_at
              from raw where cast(cast(amount as double) as varchar) like '%.99')"""),
    "retry_step": _with(["raw"], """
        select event_id, delivery + cast(due as integer) as attempt,
               case when due then timestamp '2024-01-20' else occurred_at end
                 as last_attempt_at,
               description,
               case when due and description <> 'purchase' then 'SENT'
                    when delivery + cast(due as integer) >= 3 then 'DLQ'
                    else 'RETRY' end as status
        from (select *, delivery < 3 and occurred_at + case delivery
                            when 1 then interval 1 second else interval 2 seconds end
                          <= timestamp '2024-01-20' as due
              from raw where cast(cast(amount as double) as varchar) like '%.99')"""),
    "frame_triage": _with(["tx"], """
        select cast(schema_id as bigint) as schema_id, bad_reason, count(*) as frames
        from (select case when description in ('error', 'signup') then null
                          when type = 'DEBIT' then 1 else 2 end as schema_id,
                     case description when 'error' then 'unknown magic byte'
                          when 'signup' then 'frame too short' end as bad_reason
              from tx)
        group by all"""),
    "frame_bodies": _with(["tx"], """
        select event_id, account_id as schema_id, description as body from tx"""),
    "schema_v1_v2_union": _with(["tx"], """
        select event_id, description,
               case when type = 'DEBIT' then null
                    else 'M' || cast(account_id as varchar) end as merchant_id
        from tx"""),
    "requests_from_json": """
        select event_id, cast(json_extract(props, '$.k') as integer) as k from events""",
    "json_roundtrip": _with(["tx"], """
        select event_id, cast(amount as double) as amount, description from tx"""),
    "payload_roundtrip": _with(["tx"], """
        select event_id, '"' || to_base64(encode(description)) || '"' as payload,
               description as text from tx"""),
    "accept_transactions": _with(["checked"], """
        select id, account_id, cast(amount as double) as amount, currency, type,
               'INITIATED' as status, description, occurred_at as created_at,
               occurred_at as updated_at
        from checked where known and type <> 'REFUND'"""),
    "accept_outbox": _with(["checked"], f"""
        , good as (select *, {_uuid("'event'", "id")} as event_uuid,
                          {_uuid("'outbox'", "id")} as outbox_id
                   from checked where known and type <> 'REFUND')
        select outbox_id as id, 'transaction.initiated' as topic,
               cast(account_id as varchar) as partition_key,
               '"' || to_base64(unhex('0000000001') || encode(
                   '{{"eventId":"' || event_uuid || '","transactionId":"' || id ||
                   '","accountId":"' || cast(account_id as varchar) ||
                   '","amount":' || cast(cast(amount as double) as varchar) ||
                   ',"currency":"INR","type":"' || type || '","description":"' ||
                   description || '","occurredAt":' ||
                   cast(epoch_ms(occurred_at) as varchar) || '}}')) || '"' as payload,
               false as published, 0 as retry_count
        from good"""),
    "rejected_requests": _with(["checked"], """
        select event_id, concat_ws(',',
                   case when type = 'REFUND' then 'type_domain' end,
                   case when not known then 'account_exists' end) as violations
        from checked where not known or type = 'REFUND'"""),
    "outbox_pending": _with(["box"], """
        select id, payload, created_at from box
        where not published order by created_at, id limit 100"""),
    "outbox_apply": _with(["box"], """
        , batch as (select id from box where not published
                    order by created_at, id limit 100),
        tried as (select box.*, batch.id is not null as is_tried,
                         payload = '"*"' as broken
                  from box left join batch on box.id = batch.id),
        applied as (select id, published or (is_tried and not broken) as published,
                           case when is_tried and not broken then timestamp '2024-02-01'
                                else published_at end as published_at,
                           retry_count + case when is_tried and broken then 1 else 0 end
                             as retry_count,
                           case when is_tried and broken then 'payload is not base64' end
                             as last_error
                    from tried)
        select *, not published and retry_count >= 5 as needs_manual from applied"""),
    "outbox_recent": _with(["box"], """
        select id, created_at from box order by created_at desc, id desc limit 10"""),
    "outbox_retention": _with(["box"], """
        select id, published_at from box
        where not published or published_at >= timestamp '2024-01-23'"""),
    "late_drops": _with(["audit"], """
        select event_id, partition, stream_time, window_end,
               window_end <= stream_time - interval 30 seconds as dropped
        from audit"""),
    "hourly_spend_on_time": _with(["audit"], """
        select account_id, window_end - interval 1 hour as window_start, window_end,
               cast(sum(amount) as double) as total
        from audit where not window_end <= stream_time - interval 30 seconds
        group by account_id, window_end"""),
    "delivery_audit": _with(["raw"], """
        select copies, count(*) as events
        from (select event_id, count(*) as copies from raw group by event_id)
        group by copies"""),
    "velocity_inflated": _with(["raw"], f"""
        , on_copies as (select account_id, count(*) as n
                        from ({_velocity("raw", "5 minutes", "5-minute")}) group by account_id),
        on_events as (select account_id, count(*) as n
                      from ({_velocity("tx", "5 minutes", "5-minute")}) group by account_id)
        select c.account_id, c.n as on_copies, coalesce(e.n, 0) as on_events
        from on_copies c left join on_events e on c.account_id = e.account_id"""),
    "event_counters": _with(["tx"], """
        select description, type, count(*) as total from tx group by description, type"""),
    "consumer_counters": _with(["judged"], """
        select case status when 'SENT' then 'sent' when 'DLQ' then 'dlq'
                    else 'duplicates' end as name, count(*) as total
        from judged group by status"""),
    "write_counters": _with(["checked", "box"], """
        select 'initiated' as name, count(*) as total
        from checked where known and type <> 'REFUND'
        union all select 'outbox_published', count(*) from box
        where not published and payload <> '"*"'
        union all select 'outbox_failed', count(*) from box
        where not published and payload = '"*"'"""),
    "rate_per_minute": _with(["tx"], """
        select description, date_trunc('minute', occurred_at) as window_start,
               count(*) / 60.0 as rate
        from tx group by all"""),
    "counter_rate": _with(["tx"], """
        select description, time_bucket(interval 1 hour, occurred_at) as window_start,
               cast(sum(grown) as double) / 3600.0 as rate
        from (select description, occurred_at,
                     case when before is null then 0 when amount >= before
                          then amount - before else amount end as grown
              from (select *, lag(amount) over (
                        partition by description order by occurred_at, amount) as before
                    from tx))
        group by all"""),
    "duration_quantiles": _with(["tx"], f"""
        select date_trunc('day', occurred_at) as day, {_QUANTILE_COLUMNS}
        from tx group by all"""),
    "duration_quantiles_by_type": _with(["tx"], f"""
        select description, {_QUANTILE_COLUMNS} from tx group by description"""),
    "histogram_quantiles": _with(["tx"], """
        , per as (select description, least(ceil(amount / 50) * 50, 350) as edge,
                         count(*) as n from tx group by all),
        cum as (select description, case when edge > 300 then null else edge end as le,
                       edge, sum(n) over (partition by description order by edge) as c,
                       sum(n) over (partition by description) as total from per),
        step as (select *, coalesce(lag(edge) over (
                            partition by description order by edge), 0) as low,
                        coalesce(lag(c) over (
                            partition by description order by edge), 0) as before
                 from cum)
        select description, q.q, round(case when le is null then cast(low as double)
               else low + (edge - low) * ((q.q * total - before) / (c - before)) end, 6)
               as value
        from step cross join (values (cast(0.5 as double)), (0.95), (0.99)) q(q)
        where before < q.q * total and c >= q.q * total"""),
    "consumer_lag": _with(["lags"], "select partition, lag from lags"),
    "total_lag": _with(["lags"], "select cast(sum(lag) as bigint) as lag from lags"),
    "health_status": _with(["judged", "lags", "box"], """
        , m as (select case status when 'SENT' then 'sent' when 'DLQ' then 'dlq'
                            else 'duplicates' end as name, count(*) as value
                from judged group by status
                union all select 'lag', cast(sum(lag) as bigint) from lags
                union all select 'outbox_failed', cast(sum(retry_count) as bigint) from box)
        select name, value, case
               when name = 'dlq' and value >= 1 then 'red'
               when name = 'outbox_failed' and value >= 1 then 'red'
               when name = 'duplicates' and value >= 1 then 'yellow'
               when name = 'lag' and value >= 1000 then 'red'
               when name = 'lag' and value >= 100 then 'yellow'
               else 'green' end as status
        from m"""),
    "pipeline_outcomes": _with(["checked"], """
        select id as transaction_id, cast(account_id as varchar) as account_id,
               case when amount_text like '%.99' then 'DLQ' else 'SENT' end as status,
               case when amount_text like '%.99' then 3 else 1 end as attempts,
               case when amount_text like '%.99' then
                    'Simulated notification failure for amount: ' || amount_text end as reason
        from (select *, cast(cast(amount as double) as varchar) as amount_text from checked)
        where known and type <> 'REFUND'"""),
    "relay_passes": _with(["box"], """
        select id, payload <> '"*"' as published,
               case when payload <> '"*"' then timestamp '2024-02-01' end as published_at,
               case when payload = '"*"' then 'payload is not base64' end as last_error
        from box where not published"""),
    "relay_outbox": _with(["box"], """
        select id, payload <> '"*"' as published,
               case when payload <> '"*"' then timestamp '2024-02-01' end as published_at,
               retry_count + case when payload = '"*"' then 1 else 0 end as retry_count,
               case when payload = '"*"' then 'payload is not base64' end as last_error
        from box where not published"""),
    "stream_consumer": _with(["raw"], """
        select '00000000-0000-0000-0000-' || lpad(cast(event_id as varchar), 12, '0')
                 as event_id, "offset", status,
               case status when 'DLQ' then 3 when 'SENT' then 1 else 0 end as attempts,
               cast(case status when 'DLQ' then 3000 else 0 end as bigint) as backoff_ms,
               case status when 'DLQ' then 'Simulated notification failure for amount: '
                    || amount_text end as reason
        from (select *, cast(cast(amount as double) as varchar) as amount_text,
                     case when cast(cast(amount as double) as varchar) like '%.99'
                          then 'DLQ' when delivery > 1 then 'DUPLICATE' else 'SENT' end
                       as status
              from raw)"""),
    "stream_consumer_retries": _with(["raw"], """
        select '00000000-0000-0000-0000-' || lpad(cast(event_id as varchar), 12, '0')
                 as event_id, "offset", status, attempts,
               cast((pow(2, case status when 'DUPLICATE' then attempts else attempts - 1 end)
                     - 1) * 1000 as bigint) as backoff_ms,
               case status when 'DLQ' then 'attempt 3 failed' end as reason
        from (select *, case when event_id % 4 = 3 then 'DLQ' when delivery = 1 then 'SENT'
                        else 'DUPLICATE' end as status,
                     cast(case event_id % 4 when 3 then 3 when 2 then 4 - delivery
                          else case delivery when 1 then event_id % 4 + 1 else 0 end end
                          as integer) as attempts
              from raw)"""),
}

# A stream that has processed a whole table ends with the batch result.
for _stream, _batch in (
        ("stream_high_value", "high_value_alerts"),
        ("stream_rapid_large", "rapid_large_alerts"),
        ("stream_velocity", "velocity_alerts"),
        ("stream_consumer_batches", "consume_outcomes"),
        ("stream_accept", "accept_transactions")):
    ORACLES[_stream] = ORACLES[_batch]
# Folding and retaining in between changes no row that is still kept.
ORACLES["relay_retained"] = ORACLES["relay_passes"]

"""The same answers in plain SQL, written from the meaning of each query and
not from its Spark plan."""

from __future__ import annotations

from changeguard.views import NOW

ISO = "'%Y-%m-%dT%H:%M:%SZ'"
SINCE = "timestamp '2024-01-08 00:00:00'"


def iso(column: str) -> str:
    return f"strftime({column}, {ISO})"


STAGE = ("case when o_orderstatus = 'F' then 'Closed Won' when o_orderstatus = 'P' "
         "then 'Closed-Lost to Competition' else 'Qualification' end")

VIEWS = {
    "users": """select n_nationkey::varchar id, n_name full_name, lower(n_name) || '@example.com' email,
        case when n_regionkey = 0 then 'inactive' else 'active' end status, n_regionkey <> 1 as confirm,
        'ROLE_' || n_regionkey as role, case when n_regionkey = 2 then 'Administrator' else 'Standard' end profile
        from nation""",
    "deals": f"""select 'Deals' as module, o_orderkey::varchar id, (o_custkey % 25)::varchar owner_id,
        o_custkey::varchar account_id, {STAGE} stage, o_totalprice::decimal(18,2) amount,
        o_orderdate modified_time, (o_orderdate::date + 90) closing_date, o_orderpriority priority, o_orderkey,
        o_orderstatus from orders""",
    "deals_now": """select module, id, owner_id, account_id,
        case when priority in ('1-URGENT', '4-NOT SPECIFIED') and amount > 250000 then 'Closed Won' else stage end stage,
        amount, case when amount > 200000 then modified_time + interval 1 day else modified_time end modified_time,
        closing_date, priority, o_orderkey from deals where amount >= 50000""",
    "leads": """select 'Leads' as module, c_custkey::varchar id, c_nationkey::varchar owner_id, c_name as name,
        case when c_acctbal >= 0 then lower(c_name) || '@example.com' end email,
        timestamp '2001-01-01' + to_days((c_custkey % 360)::int) modified_time, c_custkey from customer""",
    "contacts": """select 'Contacts' as module, s_suppkey::varchar id, s_nationkey::varchar owner_id, s_name as name,
        case when s_acctbal >= 0 then lower(s_name) || '@example.com' end email from supplier""",
    "accounts": """select c_custkey::varchar id, c_nationkey::varchar owner_id, c_name as name,
        case when c_custkey % 7 <> 0 then c_mktsegment end segment,
        case when c_acctbal >= 0 then c_acctbal::decimal(18,2) end balance, c_custkey from customer""",
    "feed": f"""select event_id, case when event_id % 2 = 0 then 'Leads' else 'Contacts' end as module,
        user_id::varchar id, event_type modified_by,
        case when event_id % 97 <> 0 then date_trunc('second', ts) end modified_at,
        case when event_id % 2 = 0 then 'Leads' else 'Contacts' end || ':' || user_id || ':' ||
        case when event_id % 97 <> 0 then {iso("date_trunc('second', ts)")} else 'unreadable:unreadable' end change_ref
        from events""",
    "ledger": """select event_id e, event_id % 10 turn, event_id // 5000 as segment, event_id % 5000 + 1 as seq,
        case when event_id % 10 <= 6 then 'applied' when event_id % 10 = 7 then 'refused'
             when event_id % 10 = 8 then 'unresolved' else 'reconciled' end outcome,
        case when event_id % 2 = 0 then 'Leads' else 'Contacts' end as module, user_id::varchar id,
        'k' || (user_id % 10) plan_key, date_trunc('second', ts) as at,
        case when event_id % 10 <= 5 then date_trunc('second', ts)
             + to_seconds(case when event_id % 4 = 3 then 1 else 0 end) end written,
        lag(user_id::varchar) over (order by event_id) prev_id, event_type, value, ts from events""",
    "governed": "select distinct module, id, written as modified_at from ledger where written is not null",
    "scanned": """select f.*, g.id is not null as governed from feed f left join governed g
        on f.module = g.module and f.id = g.id and f.modified_at = g.modified_at""",
    # (entry, record) pairs of the event ledger; half of the refusals name nobody
    "named": "select * from ledger where turn <> 9 and not (turn = 7 and e % 20 = 17)",
    "judged": """select n.segment, n.seq, n.e, n.id, case when r.e % 20 = 9 then 'landed'
        when r.e is not null then 'unknown' end verdict, r.segment verdict_segment, r.seq verdict_seq
        from named n left join ledger r on r.e = n.e + 1 and r.segment = n.segment and r.turn = 9
        where n.turn = 8""",
    "deal_entries": """select d.*, o_orderkey // 5000 as segment, o_orderkey % 5000 + 1 as seq,
        case priority when '4-NOT SPECIFIED' then 'unresolved' when '5-LOW' then 'refused' else 'applied' end outcome,
        o_orderstatus = 'F' and amount > 400000 as is_merge,
        case when priority = '1-URGENT' then case when amount > 200000 then modified_time + interval 1 day
             else modified_time end when priority = '2-HIGH' then modified_time end written from deals d""",
    "commands": """select *, case when outcome <> 'unresolved' then 'apply_update' when is_merge then 'apply_merge'
        when o_orderstatus = 'F' then 'apply_delete' when o_orderstatus = 'P' then 'apply_upsert'
        else 'apply_update' end command from deal_entries""",
    "doubts": """select segment, seq, command, is_merge, o_orderstatus, stage as before_stage,
        modified_time as before_time, o_orderkey as k, case when is_merge then 'master' end as role, o_orderkey as owner
        from commands where outcome = 'unresolved'
        union all select segment, seq, command, is_merge, o_orderstatus, stage, modified_time, o_orderkey + 1, 'loser',
        o_orderkey from commands where outcome = 'unresolved' and is_merge""",
    "doubted": """select d.*, n.id is not null as present, n.modified_time now_time, n.stage now_stage,
        case d.o_orderstatus when 'O' then 'value' when 'F' then 'existence' else 'modified_time' end basis
        from doubts d left join deals_now n on n.o_orderkey = d.k""",
    "merges": """select segment, seq, case when not bool_or(role = 'master' and present) then 'indeterminate'
        when not bool_or(role = 'loser' and present) then 'losers_absent' else 'masters_present' end merge_state
        from doubted where is_merge group by 1, 2""",
    "verdicts": """select d.segment, d.seq, d.command, d.k::varchar id, d.role, d.basis,
        case when is_merge then 'unknown'
             when basis = 'existence' and not present then 'landed'
             when basis in ('existence', 'modified_time') and present and now_time = before_time then 'not_landed'
             when basis <> 'value' or not present then 'unknown'
             when now_stage = 'Closed Won' and before_stage = 'Closed Won' then 'unknown'
             when now_stage = 'Closed Won' and now_time <> before_time then 'landed'
             when now_stage = before_stage and now_time = before_time then 'not_landed'
             else 'unknown' end verdict, m.merge_state
        from doubted d left join merges m on m.segment = d.segment and m.seq = d.seq""",
    # (deal entry, record): a merge attempt also names the deal after it
    "deal_named": """select segment, seq, outcome, command, id, modified_time as at, written from commands
        union all select segment, seq, outcome, command, (o_orderkey + 1)::varchar, modified_time, null
        from commands where is_merge and outcome = 'unresolved'""",
    "slots": """select id, count(*) filter (outcome = 'applied') governed_changes,
        count(*) filter (outcome = 'refused') refusals, count(*) filter (outcome = 'unresolved') unresolved,
        max(written) last_written from deal_named group by 1""",
    "custody": """select d.id, n.modified_time modified_at, n.owner_id modified_by, last_written,
        coalesce(governed_changes, 0) governed_changes, coalesce(refusals, 0) refusals,
        coalesce(s.unresolved, 0) unresolved,
        case when n.id is null then 'record no longer readable'
             when n.modified_time = last_written then 'produced by a governed write'
             when governed_changes > 0 and last_written is null then 'approvals carry no write time'
             when n.modified_time > last_written then 'newer than the last governed write'
             when last_written is not null then 'older than the last governed write'
             when n.modified_time < (select min(modified_time) from deals) then 'change predates the ledger'
             else 'no ledger entry within coverage' end why
        from deals d left join deals_now n on n.id = d.id left join slots s on s.id = d.id""",
    "custodies": """select *, case when why = 'produced by a governed write' then 'governed'
        when why in ('newer than the last governed write', 'no ledger entry within coverage') then 'diverged'
        else 'unproven' end custody from custody""",
    "upsert_in": """select o_orderkey * 2 + copy as row_id,
        'D-' || (o_orderkey + case when o_orderstatus = 'F' then 0 else 1000000000 end) code,
        case when o_totalprice < 400000 then
          (o_orderkey + case when o_orderstatus = 'F' then 0 else 1000000000 end) || '@example.com' end email,
        o_orderkey, copy, o_orderstatus = 'F' as known, o_orderpriority, o_orderdate, o_totalprice
        from orders, (values (0), (1)) t(copy) where copy = 0 or o_orderpriority = '1-URGENT'""",
    # finished orders exist; low-priority ones only under their e-mail
    "matched": """select *, case when known and o_orderpriority <> '5-LOW' then 'code'
        when known and email is not null then 'email' end hit from upsert_in""",
    "pairs": """select (c_custkey // 2 * 2)::varchar master_id, c_custkey::varchar loser_id from customer
        where c_custkey % 2 = 1""",
    "parties": """select c_custkey::varchar id, c_name "Full_Name", c_mktsegment "Industry",
        case when c_acctbal >= 0 then c_acctbal::decimal(18,2) end "Balance",
        case when c_nationkey >= 5 then c_nationkey::varchar else '' end "Country",
        date '2020-01-01' + (c_custkey % 7)::int "Created_Time" from customer""",
    "cells": """select id, field, value from parties,
        lateral (values ('Full_Name', "Full_Name"), ('Industry', "Industry"), ('Balance', "Balance"::varchar),
                        ('Country', "Country"), ('Created_Time', "Created_Time"::varchar)) t(field, value)""",
    "conflicts": """select p.master_id, p.loser_id, l.field, case
            when l.field = 'Created_Time' then case when m.value is distinct from l.value then 'system' end
            when coalesce(m.value, '') = '' then 'only_on_loser' when m.value <> l.value then 'conflict' end kind,
        nullif(m.value, '') as master, l.value as loser
        from pairs p join cells l on l.id = p.loser_id join cells m on m.id = p.master_id and m.field = l.field
        where coalesce(l.value, '') <> ''""",
    "line_children": """select l_orderkey::varchar parent_id, 'L' || l_linenumber title, l_returnflag flag
        from lineitem""",
    "related": """select d.id, g.list, case when g.list <> 'Calls' then
            (select count(*) from line_children c where c.parent_id = d.id and (g.list = 'Notes' or c.flag = 'R')) end "count"
        from deals d, (values ('Notes'), ('Tasks'), ('Calls')) g(list)""",
    "titles": """select parent_id, 'Notes' as list, array_to_string((list(title order by title))[:5], ',') titles
        from line_children group by 1
        union all select parent_id, 'Tasks', array_to_string((list(title order by title))[:5], ',')
        from line_children where flag = 'R' group by 1""",
    "findings": """select 'stale_leads' as "check", 'Leads' as module, id from leads
          where modified_time < timestamp '2001-07-01' - interval 90 day
        union all select 'leads_no_email', 'Leads', id from leads where email is null
        union all select 'contacts_no_email', 'Contacts', id from contacts where email is null
        union all select 'stale_deals', 'Deals', id from deals
          where modified_time < timestamp '2001-07-01' - interval 90 day and stage not in ('Closed Won', 'Closed Lost')
        union all select 'overdue_deals', 'Deals', id from deals
          where closing_date < date '2001-07-01' and stage not in ('Closed Won', 'Closed Lost')
        union all select 'orphaned_deals', 'Deals', d.id from deals d join users u on u.id = d.owner_id and u.status <> 'active'
        union all select 'orphaned_leads', 'Leads', d.id from leads d join users u on u.id = d.owner_id and u.status <> 'active'
        union all select 'orphaned_contacts', 'Contacts', d.id from contacts d join users u on u.id = d.owner_id and u.status <> 'active'
        union all select 'orphaned_accounts', 'Accounts', d.id from accounts d join users u on u.id = d.owner_id and u.status <> 'active'""",
    "rough": """select (c_custkey // 4 * 4)::varchar master_id, c_custkey::varchar loser_id from customer
        union all select (s_suppkey + 1000000)::varchar, (s_suppkey + 1000001)::varchar from supplier
        union all select (2000000 + p_size)::varchar, (3000000 + p_partkey // 2)::varchar from part""",
    "results": f"""select l_orderkey as batch, l_linenumber as row_id, l_partkey as part,
        case when l_returnflag = 'R' then 'INVALID_DATA' else 'SUCCESS' end code, l_linestatus from lineitem""",
    "bodies": """select segment, seq, turn, value, outcome, module,
        to_json({'at': strftime("at", '%Y-%m-%dT%H:%M:%S.%fZ'),
          'command': case when turn = 9 then 'reconcile_writes' else 'apply_update' end,
          'detail': case
            when turn <= 5 then to_json({'records': 1, 'fields': ['Stage'],
              'written': [{'id': id, 'modified_time': """ + iso("written") + """}],
              'before': [{'id': id, 'before': {'Stage': event_type}}]})::varchar
            when turn = 6 then to_json({'records': 1, 'written': null, 'targets': [id]})::varchar
            when turn = 7 and e % 20 = 7 then to_json({'reason': 'state moved', 'targets': [id]})::varchar
            when turn = 7 then to_json({'reason': 'state moved', 'losers': 2})::varchar
            when turn = 8 then to_json({'verdict_basis': 'value', 'intent': {'Stage': event_type}, 'reason': 'no answer',
              'targets': [{'id': id, 'before': {'Stage': event_type}, 'before_modified_time': """ + iso("ts") + """}]})::varchar
            else to_json({'resolves_seq': (e - 1) % 5000 + 1, 'resolved': e % 20 = 9, 'verdicts': [
              {'id': prev_id, 'verdict': case when e % 20 = 9 then 'landed' else 'unknown' end}]})::varchar end,
          'entry_id': 'e' || e, 'module': module, 'outcome': outcome, 'plan_key': plan_key,
          'segment': segment::varchar, 'seq': seq::varchar})::varchar body from ledger""",
}


def sql(select: str) -> str:
    """The select with the views it uses, in definition order."""
    needed: set[str] = set()

    def need(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and _mentions(text, name):
                needed.add(name)
                need(body)

    need(select)
    parts = ",\n".join(f"{name} as ({body})" for name, body in VIEWS.items() if name in needed)
    return f"with {parts}\n{select}" if parts else select


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(words[i] in ("from", "join") and words[i + 1] == name for i in range(len(words) - 1)) or any(
        f", {name} " in text for _ in (0,))


def lanes(hash_column: str) -> str:
    spots = [(1 + 6 * i, 6) for i in range(10)] + [(61, 4)]
    return " || '|' || ".join(
        f"coalesce(sum(('0x' || substr({hash_column}, {a}, {n}))::bigint), 0)::varchar" for a, n in spots)


def digest(label: str, hash_column: str) -> str:
    return f"'sha256:' || sha256('{label}' || '|' || count(*)::varchar || '|' || {lanes(hash_column)})"


DEAL_HASH = ("select *, sha256(to_json({'amount': amount::varchar, 'id': id, 'modified_time': "
             "strftime(modified_time, '%Y-%m-%dT%H:%M:%S.%fZ'), 'stage': stage})::varchar) h from deals")
TIMELINE_KIND = ("case outcome when 'applied' then 'governed_change' when 'refused' then 'refusal' "
                 "else 'unresolved_write' end")
WINDOWS = f"""select module, {iso("date_trunc('hour', modified_at)")} window_start,
        count(*) filter (governed) governed, count(*) filter (not governed) ungoverned from scanned
        group by 1, 2"""
TOTALS = ("count(*) filter (verdict = 'landed') landed, count(*) filter (verdict = 'not_landed') not_landed, "
          "count(*) filter (verdict = 'unknown') as \"unknown\"")
OUTCOMES = ", ".join(f"count(*) filter (outcome = '{o}') {o}" for o in ("applied", "refused", "unresolved", "reconciled"))
# entries before the first forged one, over the whole ledger
FIRST_FORGED = "(select min(segment * 5000 + seq) from ledger where value > 20)"

ORACLES = {
    "s1_scan_capped": """select module, event_id from (select *, row_number() over (partition by module
        order by modified_at asc nulls first, id, event_id) r from feed) where r <= 500""",
    "s1_scan_truncated": "select module, count(*) > 500 as truncated from feed group by 1",
    "s2_scan_complete": "select id, owner_id, stage, amount::varchar amount from deals",
    "s3_lookup_by_ids": """select id, stage, priority from deals where id in
        (select parent_id from line_children where flag = 'R')""",
    "s4_list_records": """select id, stage, priority, (select count(*) from deals) > 150 as more_records from
        (select * from deals order by modified_time desc, id limit 50 offset 100)""",
    "s5_search": """select id, stage, owner_id from deals where stage <> 'Closed Won' and amount > 1000
        and amount < 400000 and priority in ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')""",
    "s6_records_full": """select id, name, 'found' as state from contacts where id in (select id from feed)
        union all select distinct id, null, 'missing' from feed where id not in (select id from contacts)""",
    "s7_list_users": """select id, full_name, email, role, profile, status, kind from users, (values
        ('AllUsers'), ('ActiveUsers'), ('DeactiveUsers'), ('ConfirmedUsers'), ('NotConfirmedUsers'), ('DeletedUsers'),
        ('ActiveConfirmedUsers'), ('AdminUsers'), ('ActiveConfirmedAdmins'), ('CurrentUser')) k(kind)
        where case kind when 'AllUsers' then true when 'ActiveUsers' then status = 'active'
          when 'DeactiveUsers' then status = 'inactive' when 'ConfirmedUsers' then confirm
          when 'NotConfirmedUsers' then not confirm when 'DeletedUsers' then status = 'deleted'
          when 'ActiveConfirmedUsers' then status = 'active' and confirm when 'AdminUsers' then profile = 'Administrator'
          when 'ActiveConfirmedAdmins' then status = 'active' and confirm and profile = 'Administrator'
          else id = '3' end""",
    "s8_profile_fields": """with cells2 as (select field, value from accounts, lateral (values ('id', id),
          ('owner_id', owner_id), ('name', name), ('segment', segment), ('balance', balance::varchar)) t(field, value)),
        counted as (select field, value, count(*) n from cells2 group by 1, 2),
        top as (select field, string_agg(value, '|' order by r) top_values from (select *, row_number() over
          (partition by field order by n desc, value) r from counted where value is not null) where r <= 50 group by 1)
        select c.field, c.field = 'id' as read_only, sum(n)::bigint as "rows",
          coalesce(sum(n) filter (value is null), 0)::bigint nulls,
          coalesce(sum(n) filter (coalesce(value, '') = ''), 0)::bigint blanks,
          count(value) distinct_values, any_value(top_values) top_values
        from counted c left join top t on t.field = c.field group by c.field""",
    "s4_deep_page": """with p as (select count(*) * 9 // 10 // 50 * 50 as skip from deals),
        r as (select id, stage, priority, row_number() over (order by amount desc nulls last, id) - 1 as place,
          count(*) over () as total from deals)
        select id, stage, priority, total > skip + 50 as more_records from r, p where place >= skip and place < skip + 50""",
    "s9_default_projection": "select id, owner_id, name, segment, balance::varchar balance from accounts",
    "s10_envelopes": f"""select id, stage, amount::varchar amount, {iso('modified_time')} modified_time, closing_date::varchar closing_date
        from deals""",
    "s14_write_report": """select outcome, count(*) as "rows", sum(seq)::bigint as seqs, (select count(*) from ledger) as entries
        from ledger group by outcome""",
    "s12_append_ledger": """with sizes as (select count(*) n from ledger)
        select s::bigint as segment, true as ok, least(5000, n - s * 5000)::bigint as entries
        from sizes, range(1000000) t(s) where s * 5000 < n""",
    "s13_plan_store": """select 'k' || user_id as key, arg_max(event_id, ts) event_id from events
        where ts > timestamp '2024-01-15 12:00:00' - interval 14 day group by 1""",
    "s13_saved_plan": "select id, stage, owner_id from deals where stage <> 'Qualification'",
    "s15_scrub": """with ids as (select id, 'id_' || row_number() over (order by id) place from
          (select c_custkey::varchar id from customer union select n_nationkey::varchar from nation
           where n_nationkey in (select c_nationkey from customer)))
        select i.place id, 'REDACTED' full_name, 'redacted@example.com' email, o.place owner_id, 'REDACTED' owner_name,
          3::bigint tags, o.place last_tag_id, c_mktsegment segment
        from customer join ids i on i.id = c_custkey::varchar join ids o on o.id = c_nationkey::varchar""",
    "p1_owned_by": """select owner_id, id from deals where stage not in
        ('Closed Won', 'Closed Lost', 'Closed-Lost to Competition')
        and owner_id in (select id from users where status = 'active')""",
    "p2_stale_before": f"""select id, stage from deals where modified_time < timestamp '{NOW}' - interval 1000 day
        and stage not in ('Closed Won', 'Closed Lost')""",
    "p3_overdue_open": """select id, stage from deals where closing_date < date '1999-06-01'
        and stage not in ('Closed Won', 'Closed Lost')""",
    "p4_missing_value": "select id, name from leads where email is null",
    "p5_changed_since": f"select event_id, change_ref from feed where modified_at > {SINCE} or modified_at is null",
    "p7_resolve_user": """with people as (select 'u' || id as id, name, email from leads),
        asked as (select distinct who from supplier, lateral (values (right(s_name, 10)), (right(s_name, 4)),
          (right(s_name, 2)), ('u' || s_suppkey), (upper(s_name))) t(who)),
        exact as (select who from asked join people on id = who),
        hits as (select who, count(*) n, min(p.id) id from asked a join people p
          on contains(lower(coalesce(email, '') || ' ' || name), lower(who))
          where who not in (select who from exact) group by 1)
        select a.who, case when e.who is not null then a.who when h.n = 1 then h.id end user_id,
          case when e.who is not null then 1 else coalesce(h.n, 0) end::bigint n_matches
        from asked a left join exact e on e.who = a.who left join hits h on h.who = a.who""",
    "p8_ledger_filter": """select segment, seq from ledger where "at" >= timestamp '2024-01-05'
        and "at" <= timestamp '2024-01-20 12:00:00' and module = 'Leads' and outcome = 'applied'""",
    "p9_open_unresolved": """select u.segment, u.seq from ledger u where u.turn = 8 and not exists
        (select 1 from ledger r where r.e = u.e + 1 and r.e % 20 = 9)""",
    "p10_exclude_delivered": """select event_id, change_ref from feed where change_ref not in
        (select change_ref from feed where modified_by = 'purchase')""",
    "p14_departed_users": "select id, full_name from users where status <> 'active'",
    "p15_check_merge_pairs": """with uses as (select loser_id, count(*) n, count(distinct master_id) m from rough group by 1),
        loads as (select master_id, count(*) n from rough group by 1)
        select r.master_id, r.loser_id, case when r.master_id = r.loser_id then 'record merged into itself'
          when u.m > 1 then 'loser of two masters' when u.n > 1 then 'loser repeated'
          when r.loser_id in (select master_id from rough) then 'loser is itself a master'
          when l.n > 3 then 'too many losers' end reason
        from rough r join uses u on u.loser_id = r.loser_id join loads l on l.master_id = r.master_id""",
    "p16_check_key_fields": "select id, 'code' as missing_keys from deals where priority = '5-LOW'",
    "j1_match_governed": "select event_id, change_ref, governed from scanned",
    "j2_upsert_split": f"""with twice as (select o_orderkey from upsert_in group by 1 having count(*) > 1)
        select row_id, case when hit is not null then 'update' else 'create' end as action,
          case when hit is not null then o_orderkey::varchar end id, hit matched_on,
          case hit when 'code' then code when 'email' then email end matched_value,
          case when hit is not null then {iso("o_orderdate")} end modified_time,
          case when hit is not null then 1::bigint end candidates,
          o_orderkey in (select o_orderkey from twice) as duplicate_in_batch from matched""",
    "j3_merge_conflicts": "select * from conflicts where kind is not null",
    "j4_ledger_by_record": f"select segment, seq, outcome, module, id, {iso('written')} as written from named",
    "j5_attach_reconciled": "select segment, seq, id, verdict, verdict_segment, verdict_seq from judged",
    "j6_orphaned_records": "select owner_id, id from deals where owner_id in (select id from users where status <> 'active')",
    "j7_reconcile_join": f"""select segment, seq, k::varchar id, present, {iso("now_time")} now_time,
        now_stage as stage from doubted""",
    "j8_rollback_join": """select d.id, d.stage restore_to, n.id is null as missing,
        case when n.stage <> 'Closed Won' then 'stage' else '' end changed_again
        from deals d left join deals_now n on n.id = d.id""",
    "j10_related_counts": """select r.id, r.list, r."count", t.titles from related r left join titles t
        on t.parent_id = r.id and t.list = r.list""",
    "j11_verdict_by_id": """select segment, seq, segment resolves_segment, (e - 1) % 5000 + 1 as resolves_seq, prev_id as id,
        case when e % 20 = 9 then 'landed' else 'unknown' end verdict from ledger where turn = 9""",
    "j12_drift_rows": """select d.id, case when n.id is null then 'removed' else 'changed' end drift
        from deals d left join deals_now n on n.id = d.id
        where n.id is null or n.stage <> d.stage or n.modified_time <> d.modified_time""",
    "a1_fingerprint": f"select count(*) records, 0::bigint null_ids, {digest('Deals', 'h')} digest from ({DEAL_HASH})",
    "a1_merkle_tree": f"""with leaf as (select md5(id) || ':' || h as line from ({DEAL_HASH})),
        two as (select line[1:2] as node, count(*) records, sha256(string_agg(line, chr(10) order by line)) as hash
          from leaf group by 1),
        one as (select node[1:1] as node, sum(records)::bigint as records,
          sha256(string_agg(node[2:2] || ':' || records || ':' || hash, chr(10) order by node)) as hash from two group by node[1:1])
        select 2 as level, * from two union all select 1, * from one
        union all select 0, '', sum(records)::bigint,
          sha256(string_agg(node || ':' || records || ':' || hash, chr(10) order by node)) from one""",
    "a1_merkle_drift": """select md5(d.id)[1:3] as bucket, d.id, case when n.id is null then 'removed' else 'changed' end drift
        from deals d left join deals_now n on n.id = d.id
        where n.id is null or n.stage <> d.stage or n.modified_time <> d.modified_time""",
    "a1_fingerprint_by_owner": f"""select owner_id, count(*) records, 0::bigint null_ids, {digest('Deals', 'h')} digest
        from ({DEAL_HASH}) group by owner_id""",
    "a2_ownership_fingerprint": f"""select count(*) records, {digest('ownership', 'h')} digest from
        (select sha256('Deals|' || id) h from deals union all select sha256('Accounts|' || id) from accounts)""",
    "a3_outcome_counts": f"select count(*) entries, {OUTCOMES} from ledger",
    "a4_records_changed": "select count(*) filter (outcome = 'applied') records_changed from ledger",
    "a5_would_change": """select count(*) records, count(*) filter (stage <> 'Closed Won' or priority <> '2-HIGH')
        would_change from deals""",
    "a6_handover_counts": """select owner_id, module, owned, closed_excluded, ceil(owned / 100)::bigint calls_required from (
        select owner_id, 'Deals' as module, count(*) filter (stage = 'Qualification') owned,
          count(*) filter (stage <> 'Qualification') closed_excluded from deals group by 1
        union all select owner_id, 'Accounts', count(*), 0 from accounts group by 1
        union all select owner_id, 'Leads', count(*), 0 from leads group by 1)""",
    "a7_write_summary": """select count(*) filter (code = 'SUCCESS') succeeded, count(*) filter (code <> 'SUCCESS') failed,
        count(*) filter (code = 'SUCCESS' and l_linestatus = 'F') as written, false as refused from results""",
    "a8_a10_coverage": f"""select {iso('min("at")')} covers_from, count(*) filter (turn = 6) unmatchable,
        count(*) filter (turn = 7 and e % 20 = 17) unattributed_refusals from ledger""",
    "a11_governed_keys": f"select module, id, {iso('modified_at')} modified_at from governed",
    "a16_last_applied": """select plan_key, segment, seq, 'e' || e as entry_id from (select *, row_number() over
        (partition by plan_key order by e desc) r from ledger where outcome = 'applied') where r = 1""",
    "a17_last_written": f"""select module, id, {iso('max(written)')} last_written from ledger where written is not null
        group by 1, 2""",
    "a19_merge_totals": """select count(*) filter (kind = 'conflict') conflicting_fields,
        count(*) filter (kind = 'only_on_loser') only_on_loser, count(*) filter (kind = 'system') system_fields_differing,
        (select count(*) from line_children where parent_id in (select loser_id from pairs))
        + (select count(*) from line_children where flag = 'R' and parent_id in (select loser_id from pairs))
        related_records_moving from conflicts""",
    "a20_merge_state": "select segment, seq, merge_state from merges",
    "a21_observed_ids": """select segment, seq, case when is_merge and outcome = 'unresolved'
        then id || ',' || (o_orderkey + 1) else id end ids from commands""",
    "f8_entry_record_ids": """select segment, seq, id, case when written is not null then 'written' else 'targets' end as source
        from deal_named""",
    "f1_iso_utc": f"select event_id, {iso('modified_at')} modified_at from feed",
    "k1_chain_entries": """select segment, start as chain_start, n, list_reduce(list_prepend(start, bodies),
          lambda prev, body: 'sha256:' || sha256(prev || '|' || body)) last_hash
        from (select segment, count(*) n, list(body order by seq) bodies,
          'sha256:' || sha256('sha256:' || repeat('0', 64) || '|' || segment) start from bodies group by segment)""",
    "k2_verify_chain": """select segment, seq, value <= 20 as ok, case when value > 20 then 'entry hash differs' end why
        from ledger""",
    "a18_first_broken": """select segment, min(seq) filter (value > 20) is null as intact,
        coalesce(min(seq) filter (value > 20) - 1, count(*))::bigint verified, min(seq) filter (value > 20) first_broken
        from ledger group by 1""",
    "g11_verify_ledger": f"""select {FIRST_FORGED} is null as intact,
        coalesce({FIRST_FORGED} - 1, (select count(*) from ledger))::bigint verified,
        ({FIRST_FORGED} - 1) // 5000 broken_segment, ({FIRST_FORGED} - 1) % 5000 + 1 as broken_seq, {OUTCOMES} from ledger""",
    "g12_audit_pack": f"""select count(*) entries, {OUTCOMES}, count(*) filter (outcome = 'applied') records_changed,
        true as chain_intact, (select count(*) from ledger) chain_verified from ledger
        where "at" >= timestamp '2024-01-05' and module = 'Leads'""",
    "k3_cap_per_module": """select event_id, module from (select *, row_number() over (partition by module
        order by modified_at asc nulls first, id, change_ref) r from feed) where r <= 2000""",
    "k5_titles_sample": "select parent_id, list, titles from titles where list = 'Notes'",
    "k7_batch_index": "select id, ((row_number() over (order by id) - 1) // 100)::bigint as batch from deals",
    "k8_timeline": f"""select n.module, n.id, {iso('n."at"')} as at, n.segment, n.seq, {TIMELINE_KIND} kind,
        'apply_update' as command, case n.turn when 7 then 'state moved' when 8 then 'no answer' end reason,
        case when n.turn <= 5 then 'Stage' end fields, {iso('n.written')} as written, j.verdict, j.verdict_seq
        from named n left join judged j on j.e = n.e""",
    "l5_first_errors": """select batch, row_id, part, code from results where code <> 'SUCCESS'
        order by batch, row_id, part limit 20""",
    "u1_union_modules": """select module, owner_id, count(*) records, count(stage) staged from (
        select 'Deals' as module, owner_id, stage from deals union all select 'Accounts', owner_id, null from accounts
        union all select 'Leads', owner_id, null from leads) group by 1, 2""",
    "u5_minus": """select id, stage from deals d where not exists (select 1 from deals_now n
        where n.id = d.id and n.stage = d.stage)""",
    "g10_scan_changes": f"""select event_id, change_ref, governed, {iso('modified_at')} modified_at, modified_by
        from scanned where modified_at > {SINCE} or modified_at is null""",
    "g10_scan_summary": f"""with recent as (select *, change_ref in (select change_ref from feed where modified_by = 'purchase')
          as seen from scanned where modified_at > {SINCE} or modified_at is null)
        select count(*) filter (not seen) changes, count(*) filter (not seen and not governed) ungoverned,
          count(*) filter (not seen and modified_at is null) unreadable, count(*) rows_scanned,
          count(*) filter (seen) skipped_already_delivered, false as truncated,
          (select {iso('min("at")')} from ledger) ledger_covers_from,
          (select count(*) from ledger where turn = 6) unmatchable_ledger_entries from recent""",
    "g10_ungoverned_by_day": """select module, modified_at::date::varchar as day, count(*) filter (governed) governed,
        count(*) filter (not governed) ungoverned from scanned group by 1, 2""",
    "k3_large_cap": """with cap as (select greatest(count(*) // 6, 1000) as n from feed),
        r as (select module, change_ref, row_number() over (partition by module order by modified_at nulls first,
          user_id, change_ref) as place, count(*) over (partition by module) as total from (select *, id as user_id from feed))
        select module, change_ref, total > n as truncated from r, cap where place <= n""",
    "x1_stream_changes": """select change_ref, 1 as occurrence, governed from scanned where modified_at is not null
        group by change_ref, governed
        union all select change_ref, row_number() over (partition by change_ref order by event_id)::int, governed
        from scanned where modified_at is null""",
    "x3_dedupe_delivered": """with n as (select change_ref, event_id % 3 > 0 as seen, modified_at is null as bare from feed),
        counts as (select change_ref, count(*) total, count(*) filter (seen) seen, bool_or(bare) bare from n group by 1)
        select change_ref, o::int as occurrence from (
          select change_ref, unnest(case when bare then range(seen + 1, total + 1) when seen = 0 then [1] else [] end) o
          from counts)""",
    "x6_window_counts": WINDOWS,
    "x6_window_stream": WINDOWS,
    "g13_reconcile": "select segment, seq, command, id, role, basis, verdict, merge_state from verdicts",
    "g13_totals": f"select {TOTALS}, 0::bigint unreconcilable, 0::bigint already_committed from verdicts",
    "a14_entry_resolved": """select segment, seq, bool_or(verdict in ('landed', 'not_landed')) resolved,
        count(*) filter (verdict = 'unknown') still_open from verdicts group by 1, 2""",
    "g14_custody": f"""select id, custody, why, {iso('modified_at')} modified_at, modified_by,
        case when custody = 'diverged' then {iso('last_written')} end diverged_from, governed_changes, refusals, unresolved
        from custodies""",
    "g14_totals": """select count(*) records, count(*) filter (custody = 'governed') governed,
        count(*) filter (custody = 'diverged') diverged, count(*) filter (custody = 'unproven') unproven,
        0::bigint unchecked, sum(governed_changes)::bigint governed_changes_total, sum(refusals)::bigint refusals_total,
        sum(unresolved)::bigint unresolved_total from custodies""",
    "g14_timeline": f"""select n.id, {iso('n."at"')} as at, n.segment, n.seq, {TIMELINE_KIND} kind, n.command,
        {iso('n.written')} as written from deal_named n join deals d on d.id = n.id""",
    "g8_hygiene": """select "check", module, count(*) as "count", case when "check" like 'orphaned%' then 'plan_handover'
        else 'plan_update' end fix_with from findings group by 1, 2""",
    "u2_union_checks": """select "check", module, id from findings""",
    "k4_sample_per_check": """select "check", module, id from (select *, row_number() over (partition by "check" order by id) r
        from findings) where r <= 5""",
    "g9_readiness": """select id, false as ready, case when segment is null then 'segment' else '' end missing_required,
        case when balance is null then 'balance: empty,website: not a field' else 'website: not a field' end
        missing_requested from accounts""",
    "g1_update_plan": f"""select count(*) records, {digest('Deals', 'h')} digest, count(*) would_change from
        (select sha256(to_json({{'id': id, 'modified_time': strftime(modified_time, '%Y-%m-%dT%H:%M:%S.%fZ'),
          'stage': stage}})::varchar) h from deals where priority = '1-URGENT' and stage = 'Qualification')""",
    "g6_upsert_totals": """select count(*) total, count(hit) will_update, count(*) - count(hit) will_create,
        0::bigint ambiguous, count(*) filter (o_orderpriority = '1-URGENT') duplicate_in_batch,
        ceil(count(*) / 100)::bigint calls_required from matched""",
    "g7_rollback_plan": """with newest as (select * from (select *, row_number() over (partition by account_id
          order by o_orderkey desc) r from commands where outcome = 'applied') where r = 1)
        select count(*) planned, count(n.id) restorable, count(*) filter (n.stage <> 'Qualification') changed_again
        from newest d left join deals_now n on n.id = d.id""",
    "m1_create": """with judged2 as (select s_suppkey, case when s_acctbal < 0 then 'name' when s_nationkey < 5
          then 'segment' end bad, s_acctbal < 0 as unnamed from supplier),
        made as (select s_suppkey, ((select max(c_custkey) from customer) + row_number() over (order by s_suppkey))::varchar id
          from judged2 where bad is null)
        select j.s_suppkey row_id, m.id, case when bad is null then 'SUCCESS' when unnamed then 'MANDATORY_NOT_FOUND'
          else 'INVALID_DATA' end code, bad as field, case when bad is null then 'BUILDING' end segment
        from judged2 j left join made m on m.s_suppkey = j.s_suppkey""",
    "m2_update": """select d.id, case when n.id is null or n.priority = '5-LOW' then d.stage
          when n.amount < 300000 then n.stage end stage,
        case when n.id is null or n.priority = '5-LOW' or n.amount < 100000 then d.priority else '9-DONE' end priority
        from deals d left join deals_now n on n.id = d.id""",
    "m3_upsert": f"""with firsts as (select * from (select *, row_number() over (partition by o_orderkey order by copy) r
          from matched) where r = 1),
        made as (select ((select max(o_orderkey) from orders) + row_number() over (order by row_id))::varchar id, code, email,
          'Renewed' as stage, null as modified_time from firsts where hit is null),
        kept as (select o.o_orderkey::varchar id,
          case when f.hit is not null then f.code when o.o_orderpriority <> '5-LOW' then 'D-' || o.o_orderkey end code,
          case when f.hit is not null then f.email else o.o_orderkey || '@example.com' end email,
          case when f.hit is not null then 'Renewed' else {STAGE.replace('o_orderstatus', 'o.o_orderstatus')} end stage,
          {iso('o.o_orderdate')} modified_time from orders o left join firsts f on f.o_orderkey = o.o_orderkey)
        select * from kept union all select * from made""",
    "m4_delete": f"""select id, case when id in (select parent_id from line_children where flag = 'R')
        then {iso(f"timestamp '{NOW}' + interval 60 day")} end expires_at from deals""",
    "m5_merge": """select m.id, m."Full_Name", m."Industry", coalesce(m."Balance", l."Balance")::varchar as "Balance",
        case when m."Country" = '' and l."Country" <> '' then l."Country" else m."Country" end as "Country"
        from parties m left join pairs p on p.master_id = m.id left join parties l on l.id = p.loser_id
        where m.id not in (select loser_id from pairs)""",
    "m5_merge_children": """select coalesce(p.master_id, o_custkey::varchar) parent_id, count(*) children
        from orders left join pairs p on p.loser_id = o_custkey::varchar group by 1""",
    "m6_convert": """with best as (select * from (select *, row_number() over (partition by account_id
          order by amount desc, id desc) r from deals) where r = 1),
        asked as (select l.*, b.id as deal_id, case when b.stage <> 'Closed Won' then b.stage end deal_stage
          from leads l left join best b on b.account_id = l.id),
        good as (select *, case when email is null then '0' else owner_id end taker from asked
          where deal_id is null or deal_stage is not null)
        select 'contact-' || id as id, id as lead_id, taker as owner_id, name as label from good
        union all select 'account-' || id, id, taker, name from good
        union all select 'deal-' || id, id, 'account-' || id, deal_stage from good where deal_id is not null
        union all select 'rejected', id, 'MANDATORY_NOT_FOUND', 'deal needs Stage' from asked
          where deal_id is not null and deal_stage is null""",
    "g2_apply_update": f"""select id, case when priority = '1-URGENT' and stage = 'Qualification' then 'Closed Won'
          else stage end stage, {iso(f"case when priority = '1-URGENT' and stage = 'Qualification' then timestamp '{NOW}' else modified_time end")}
        modified_time from deals""",
    "g2_refused_applies": """select 'refused' as outcome, 'apply_update' as command, count(*) planned from deals
          where priority = '1-URGENT' and stage = 'Qualification'
        union all select 'refused', 'apply_delete', count(*) from deals where amount < 50000
        union all select 'refused', 'apply_merge', 2""",
    "g2_ledger_records": f"""select module, id, 'applied' as outcome, {iso(f"timestamp '{NOW}'")} as written from deals
        where priority = '1-URGENT' and stage = 'Qualification'""",
    "g3_apply_delete": "select id, stage from deals where amount >= 50000",
    "g4_apply_handover": """select 'Deals' as module, id, case when owner_id = '7' and stage = 'Qualification' then '8'
          else owner_id end owner_id from deals
        union all select 'Accounts', id, case when owner_id = '7' then '8' else owner_id end from accounts""",
    "g5_apply_merge": """with kids as (select coalesce(p.master_id, o_custkey::varchar) id, count(*) n
          from orders left join pairs p on p.loser_id = o_custkey::varchar group by 1)
        select m.id, m."Full_Name", coalesce(m."Balance", l."Balance")::varchar as "Balance",
          case when m."Country" = '' and l."Country" <> '' then l."Country" else m."Country" end as "Country", k.n as children
        from parties m left join pairs p on p.master_id = m.id left join parties l on l.id = p.loser_id
        left join kids k on k.id = m.id where m.id not in (select loser_id from pairs)""",
    "g7_apply_rollback": "select id, stage from deals",
    "p6_ignorable_field": """select 'id' as field, count(*) cells, 0::bigint blanks, true as ignorable from parties
        union all select 'Created_Time', count(*), 0, true from parties
        union all select 'Full_Name', count(*), 0, false from parties
        union all select 'Industry', count(*), 0, false from parties
        union all select 'Balance', count(*), count(*) filter ("Balance" is null), false from parties
        union all select 'Country', count(*), count(*) filter ("Country" = ''), false from parties""",
    "p11_usable_written": """select batch, row_id, part, case when l_linestatus = 'F' then 1 else 0 end::bigint usable
        from results where code = 'SUCCESS'""",
    "f9_moved": f"""select d.id, n.modified_time <> d.modified_time moved, true as valid,
        'Deals:' || d.id || ':' || coalesce({iso('n.modified_time')}, 'unreadable') change_ref
        from deals d left join deals_now n on n.id = d.id""",
    "m7_notes": """select doc_id::varchar parent_id, -1::bigint turn, length(text) as length, md5(text) as md5 from documents
        union all select parent_id, turn, length(body), md5(body) from (select conv_id::varchar parent_id, turn,
          left(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''), 32000) body from conversations)
        where body <> ''""",
}


# an applied upsert leaves the table that the plain upsert computes
ORACLES["g6_apply_upsert"] = ORACLES["m3_upsert"].replace(
    "select * from kept union all select * from made",
    "select id, code, email, stage from kept union all select id, code, email, stage from made")


def oracle_sql() -> dict[str, str]:
    return {name: _compose(body) for name, body in ORACLES.items()}


def _compose(body: str) -> str:
    """Views first, then the query's own steps."""
    text = body.strip()
    whole = sql(text)
    if not text.startswith("with ") or whole == text:
        return whole
    return sql(text)[: -len(text)].rstrip() + ",\n" + text[len("with "):]

"""Every operator over whole benchmark tables; one function per query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeguard import views as V
from changeguard.errors import PlanMismatch
from changeguard.functions import details, scalars
from changeguard.operators import (chains, changes, custody, fingerprints, ledgers, matching, merkle, mutations, quality,
                                   reconcile, scans)
from changeguard.plans import audit, delete, handover, merge, rollback, update, upsert
from changeguard.session import configure, shared_folder
from changeguard.sources import envelopes, files, plan_store
from changeguard.sources import scrub as scrubbing
from changeguard.sources.ledger_store import LedgerStore
from changeguard.sources.plan_store import live_plans
from changeguard.sources.snapshots import SnapshotTable
from changeguard.streaming import change_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
iso = scalars.iso_text
GUARD = ["stage", "amount", "modified_time"]


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir.rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def joined(column: str, sep: str = ",") -> Column:
    return F.array_join(column, sep)


# --- scans ------------------------------------------------------------------

def _read(s, d):
    return changes.read_changes(V.changes(s, d))


@query
def s1_scan_capped(s, d):
    rows, _ = scans.scan_capped(_read(s, d), [F.col("modified_at").asc_nulls_first(), F.col("id"), F.col("event_id")],
                                500, ["module"])
    return rows.select("module", "event_id")


@query
def s1_scan_truncated(s, d):
    return scans.scan_capped(_read(s, d), [F.col("modified_at").asc_nulls_first(), F.col("id")], 500, ["module"])[1]


@query
def s2_scan_complete(s, d):
    return scans.scan_complete(V.deals(s, d)).select("id", "owner_id", "stage", F.col("amount").cast("string").alias("amount"))


@query
def s3_lookup_by_ids(s, d):
    returned = V.line_children(s, d).where("flag = 'R'").select(F.col("parent_id").alias("id"))
    return scans.lookup_by_ids(V.deals(s, d), returned, ["id", "stage", "priority"])


@query
def s4_list_records(s, d):
    return scans.list_records(V.deals(s, d), ["id", "stage", "priority"], "modified_time", True, 3, 50)


@query
def s4_deep_page(s, d):
    """A page in the last tenth of the table, found by seeking."""
    deals = V.deals(s, d)
    number = deals.count() * 9 // 10 // 50 + 1
    return scans.list_records(deals, ["id", "stage", "priority"], "amount", True, number, 50, seek_from=1000)


@query
def s5_search(s, d):
    return scans.search({"deals": V.deals(s, d)}, """
        select id, stage, owner_id from {deals}
        where stage not in ('Closed Won') and amount > 1000.00 and amount < 400000.00 and priority != '5-LOW'
          and owner_id is not null and priority in ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')""")


@query
def s6_records_full(s, d):
    ids = V.changes(s, d).select("id").distinct()
    found, missing = scans.records_full(V.contacts(s, d), ids)
    return found.select("id", "name", F.lit("found").alias("state")).unionByName(
        missing.select("id", F.lit(None).cast("string").alias("name"), F.lit("missing").alias("state")))


@query
def s7_list_users(s, d):
    whole = None
    for kind in scans.USER_KINDS:
        part = scans.list_users(V.users(s, d), kind, me="3").withColumn("kind", F.lit(kind))
        whole = part if whole is None else whole.unionByName(part)
    return whole


@query
def s8_profile_fields(s, d):
    meta = V.fields_meta(s)
    found = quality.profile_fields(V.accounts(s, d).drop("module", "modified_time"), meta)
    return found.select("field", "read_only", "rows", "nulls", "blanks", "distinct_values",
                        joined("top_values", "|").alias("top_values"))


@query
def s9_default_projection(s, d):
    meta = V.fields_meta(s).withColumn("module", F.lit("Custom"))
    return scans.default_projection(V.accounts(s, d), "Custom", meta=meta).withColumn(
        "balance", F.col("balance").cast("string"))


@query
def s12_append_ledger(s, d):
    """Append the ledger in two batches, read it back, and verify the chain."""
    store = LedgerStore(s, shared_folder(s, "ledger"))
    entries = V.ledger(s, d)
    store.append(entries.where("module = 'Leads'"))
    store.append(entries.where("module = 'Contacts'"))
    segments = store.segments()
    checked = chains.verify_chain(store.read(), segments)
    return chains.verify_segments(checked, store.read(), segments).select("segment", "ok", F.col("found").alias("entries"))


@query
def s13_plan_store(s, d):
    ev = V.table(s, d, "events")
    headers = ev.select(F.concat(F.lit("k"), F.col("user_id").cast("string")).alias("key"),
                        F.col("event_id"), F.col("ts").alias("ts"))
    return live_plans(headers, "2024-01-15 12:00:00", "14 days").select(
        "key", "event_id")


@query
def s13_saved_plan(s, d):
    """A plan's rows, saved twice beside an expired plan of the same key, and loaded by the key."""
    folder, deals = shared_folder(s, "plans"), V.deals(s, d).select("id", "stage", "owner_id")
    key = plan_store.plan_key("update", "Deals", "stage <> 'Qualification'", {"owner_id": "7"})
    for now, rows in (("2024-01-10 08:00:00", deals), ("2024-01-15 11:10:00", deals.limit(0)),
                      ("2024-01-15 11:40:00", deals.where("stage <> 'Qualification'"))):
        plan_store.save_plan(plan_store.Plan("update", "Deals", key, "", 0, {}, rows, {"owners": deals.select("owner_id").distinct()}),
                             folder, now)
    plan = plan_store.load_plan(s, folder, key, "2024-01-15 12:00:00")
    return plan.rows.join(plan.extra["owners"], "owner_id")


@query
def s15_scrub(s, d):
    c, n = V.table(s, d, "customer"), V.table(s, d, "nation")
    rows = c.join(n, c.c_nationkey == n.n_nationkey).select(
        V.text("c_custkey").alias("id"), F.col("c_name").alias("full_name"), F.lower("c_name").alias("email"),
        F.struct(V.text("n_nationkey").alias("id"), F.col("n_name").alias("name")).alias("owner"),
        F.array(*[F.struct(V.text("c_nationkey").alias("id"), F.lit(i).alias("place")) for i in range(4)]).alias("tags"),
        F.col("c_mktsegment").alias("segment"))
    out = scrubbing.scrub(rows)
    return out.select("id", "full_name", "email", F.col("owner.id").alias("owner_id"),
                      F.col("owner.name").alias("owner_name"), F.size("tags").cast("bigint").alias("tags"),
                      F.element_at("tags", -1)["id"].alias("last_tag_id"), "segment")


# --- predicates -------------------------------------------------------------

@query
def p1_owned_by(s, d):
    owners = V.users(s, d).where("status = 'active'").select(F.col("id").alias("owner_id"))
    return scans.owned_by(V.deals(s, d), owners, scans.HANDOVER_CLOSED).select("owner_id", "id")


@query
def p2_stale_before(s, d):
    return scans.stale_before(V.deals(s, d), V.NOW, 1000, scans.HYGIENE_CLOSED).select("id", "stage")


@query
def p3_overdue_open(s, d):
    return scans.overdue_open(V.deals(s, d), "1999-06-01 00:00:00").select("id", "stage")


@query
def p4_missing_value(s, d):
    return scans.missing_value(V.leads(s, d), "email").select("id", "name")


@query
def p5_changed_since(s, d):
    return scans.changed_since(_read(s, d), V.FEED_SINCE).select("event_id", "change_ref")


@query
def p7_resolve_user(s, d):
    people = V.leads(s, d).select(F.concat(F.lit("u"), "id").alias("id"), F.col("name").alias("full_name"), "email")
    name = F.col("s_name")
    asked = V.table(s, d, "supplier").select(F.explode(F.array(
        F.substring(name, -10, 10), F.substring(name, -4, 4), F.substring(name, -2, 2),
        F.concat(F.lit("u"), V.text("s_suppkey")), F.upper(name))).alias("who"))
    return scans.resolve_user(people, asked)


@query
def p8_ledger_filter(s, d):
    return ledgers.ledger_filter(V.ledger(s, d), "2024-01-05", "2024-01-20T12:00:00", "Leads", "applied").select(
        "segment", "seq")


@query
def p9_open_unresolved(s, d):
    return ledgers.open_unresolved(V.ledger(s, d)).select("segment", "seq")


@query
def p10_exclude_delivered(s, d):
    rows = _read(s, d)
    return scans.exclude_delivered(rows, rows.where("modified_by = 'purchase'"))[0].select("event_id", "change_ref")


@query
def p14_departed_users(s, d):
    return scans.departed_users(V.users(s, d)).select("id", "full_name")


def _rough_pairs(s, d):
    c = V.table(s, d, "customer").select(
        V.text(F.floor(F.col("c_custkey") / 4) * 4).alias("master_id"), V.text("c_custkey").alias("loser_id"))
    n = V.table(s, d, "supplier").select(
        V.text(F.col("s_suppkey") + 1000000).alias("master_id"), V.text(F.col("s_suppkey") + 1000001).alias("loser_id"))
    b = V.table(s, d, "part").select(
        V.text(2000000 + F.col("p_size")).alias("master_id"),
        V.text(3000000 + F.floor(F.col("p_partkey") / 2)).alias("loser_id"))
    return c.unionByName(n).unionByName(b)


@query
def p15_check_merge_pairs(s, d):
    return matching.check_merge_pairs(_rough_pairs(s, d))


@query
def p16_check_key_fields(s, d):
    _, rejected = matching.check_key_fields(V.upsert_existing(s, d), ["code", "email"])
    return rejected.select("id", joined("missing_keys").alias("missing_keys"))


# --- joins ------------------------------------------------------------------

@query
def j1_match_governed(s, d):
    return changes.match_governed(_read(s, d), ledgers.governed_keys(V.ledger(s, d))).select(
        "event_id", "change_ref", "governed")


@query
def j2_upsert_split(s, d):
    out = matching.upsert_match(V.upsert_in(s, d), V.upsert_existing(s, d), ["code", "email"])
    return out.withColumn("modified_time", iso("modified_time"))


def _parties(s, d):
    """Customers as mergeable records: some values missing, some system stamps."""
    c = V.table(s, d, "customer")
    return c.select(
        V.text("c_custkey").alias("id"), F.col("c_name").alias("Full_Name"), F.col("c_mktsegment").alias("Industry"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(18,2)")).alias("Balance"),
        F.when(F.col("c_nationkey") >= 5, V.text("c_nationkey")).otherwise("").alias("Country"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 7).cast("int")).alias("Created_Time"))


@query
def j3_merge_conflicts(s, d):
    return matching.merge_conflicts(V.merge_pairs(s, d), _parties(s, d))


@query
def j4_ledger_by_record(s, d):
    return ledgers.ledger_by_record(V.ledger(s, d)).select(
        "segment", "seq", "outcome", "module", "id", iso("written_time").alias("written"))


@query
def j5_attach_reconciled(s, d):
    ledger = V.ledger(s, d)
    return ledgers.attach_reconciled(ledgers.ledger_by_record(ledger), ledger).select(
        "segment", "seq", "id", "verdict", "verdict_segment", "verdict_seq")


@query
def j6_orphaned_records(s, d):
    return scans.orphaned_records(V.deals(s, d), scans.departed_users(V.users(s, d))).select("owner_id", "id")


@query
def j7_reconcile_join(s, d):
    targets = reconcile.unresolved_targets(V.deal_ledger(s, d).where("outcome = 'unresolved'"))
    found = reconcile.reconcile_join(targets, reconcile.current_state(V.deals_now(s, d), ["stage"]))
    return found.select("segment", "seq", "id", "present", iso("now_time").alias("now_time"),
                        F.try_element_at("state", F.lit("stage")).alias("stage"))


@query
def j8_rollback_join(s, d):
    before = V.deals(s, d).select("id", F.create_map(F.lit("stage"), F.col("stage")).alias("before"))
    out = matching.rollback_join(before, V.deals_now(s, d), ["stage"], {"stage": "Closed Won"})
    return out.select("id", F.col("restore_to")["stage"].alias("restore_to"), "missing",
                      joined("changed_again").alias("changed_again"))


def _lists(s, d):
    lines = V.line_children(s, d)
    return {"Notes": lines, "Tasks": lines.where("flag = 'R'"), "Calls": None}


@query
def j10_related_counts(s, d):
    ids = V.deals(s, d).select("id")
    return matching.related_counts(ids, _lists(s, d)).withColumn("titles", joined("titles"))


@query
def j11_verdict_by_id(s, d):
    return ledgers.verdict_by_id(V.ledger(s, d))


@query
def j12_drift_rows(s, d):
    return fingerprints.drift_rows(V.deals(s, d), V.deals_now(s, d), GUARD)


# --- aggregates -------------------------------------------------------------

@query
def a1_fingerprint(s, d):
    return fingerprints.state_fingerprint(V.deals(s, d), "Deals", GUARD)


@query
def a1_merkle_tree(s, d):
    return merkle.merkle_tree(V.deals(s, d), GUARD, depth=2)


@query
def a1_merkle_drift(s, d):
    """Changed buckets and the ids behind them, found from the roots of two trees down."""
    return merkle.located_drift(V.deals(s, d), V.deals_now(s, d), GUARD, depth=3)


@query
def a1_fingerprint_by_owner(s, d):
    return fingerprints.state_fingerprint(V.deals(s, d), "Deals", GUARD, by=["owner_id"])


@query
def a2_ownership_fingerprint(s, d):
    return fingerprints.ownership_fingerprint(scans.union_modules(
        {"Deals": V.deals(s, d).select("id"), "Accounts": V.accounts(s, d).select("id")}))


@query
def a3_outcome_counts(s, d):
    return ledgers.outcome_counts(V.ledger(s, d))


@query
def a4_records_changed(s, d):
    return ledgers.records_changed(V.ledger(s, d))


@query
def a5_would_change(s, d):
    return fingerprints.would_change(V.deals(s, d), {"stage": "Closed Won", "priority": "2-HIGH"})


@query
def a6_handover_counts(s, d):
    owners = V.users(s, d).select(F.col("id").alias("owner_id"))
    return handover.handover_counts({"Deals": V.deals(s, d), "Accounts": V.accounts(s, d), "Leads": V.leads(s, d)}, owners)


def _results(s, d):
    """Answers of a write of every line: returned ones failed."""
    li = V.table(s, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("row_id"), F.col("l_partkey").alias("part"),
        F.when(F.col("l_returnflag") == "R", "INVALID_DATA").otherwise("SUCCESS").alias("code"),
        F.when(F.col("l_linestatus") == "F", V.text("l_orderkey")).alias("id"),
        iso("l_shipdate").alias("modified_time"))


@query
def a7_write_summary(s, d):
    return mutations.write_summary(_results(s, d))


@query
def a8_a10_coverage(s, d):
    ledger = V.ledger(s, d)
    return ledgers.covers_from(ledger).select(
        iso("covers_from").alias("covers_from"), ledgers.unmatchable_count(ledger).scalar().alias("unmatchable"),
        ledgers.unattributed_refusals(ledger).scalar().alias("unattributed_refusals"))


@query
def a11_governed_keys(s, d):
    return ledgers.governed_keys(V.ledger(s, d)).withColumn("modified_at", iso("modified_at"))


@query
def a16_last_applied(s, d):
    return ledgers.last_applied(V.ledger(s, d)).select("plan_key", "segment", "seq", "entry_id")


@query
def a17_last_written(s, d):
    return ledgers.last_written(ledgers.ledger_by_record(V.ledger(s, d))).withColumn("last_written", iso("last_written"))


@query
def a19_merge_totals(s, d):
    pairs = V.merge_pairs(s, d)
    related = matching.related_counts(pairs.select(F.col("loser_id").alias("id")), _lists(s, d))
    return matching.merge_totals(matching.merge_conflicts(pairs, _parties(s, d)), related)


@query
def a20_merge_state(s, d):
    targets = reconcile.unresolved_targets(V.deal_ledger(s, d).where("outcome = 'unresolved'"))
    return reconcile.merge_state(reconcile.reconcile_join(targets, reconcile.current_state(V.deals_now(s, d), ["stage"])))


@query
def a21_observed_ids(s, d):
    return details.parsed(V.deal_ledger(s, d)).select(
        "segment", "seq", joined(details.observed_ids(F.col("d"))).alias("ids"))


@query
def f8_entry_record_ids(s, d):
    return details.entry_record_ids(V.deal_ledger(s, d)).select("segment", "seq", "id", "source")


@query
def f1_iso_utc(s, d):
    return V.changes(s, d).select("event_id", iso(scalars.iso_utc("modified_raw")).alias("modified_at"))


# --- chains -----------------------------------------------------------------

@query
def k1_chain_entries(s, d):
    return chains.segment_table(chains.chain_entries(V.ledger(s, d)))


def _tampered(s, d):
    """The chained ledger with the command of every costly entry rewritten."""
    chained = chains.chain_entries(V.ledger(s, d))
    forged = chained.withColumn("command", F.when(F.col("_value") > 20, "forged").otherwise(F.col("command")))
    return forged, chains.segment_table(chained)


@query
def k2_verify_chain(s, d):
    return chains.verify_chain(*_tampered(s, d))


@query
def a18_first_broken(s, d):
    return chains.first_broken_by_segment(chains.verify_chain(*_tampered(s, d)))


@query
def g11_verify_ledger(s, d):
    return chains.verify_ledger(*_tampered(s, d))


@query
def g12_audit_pack(s, d):
    chained = chains.chain_entries(V.ledger(s, d))
    return audit.audit_pack(chained, chains.segment_table(chained), since="2024-01-05", module="Leads")[0]


@query
def k3_cap_per_module(s, d):
    return changes.cap_per_module(_read(s, d), 2000)[0].select("event_id", "module")


@query
def k5_titles_sample(s, d):
    tagged = V.line_children(s, d).withColumn("list", F.lit("Notes"))
    return matching.titles_sample(tagged, 5).withColumn("titles", joined("titles"))


@query
def k7_batch_index(s, d):
    return matching.batch_index(V.deals(s, d).select("id"), ["id"], 100)


@query
def k8_timeline(s, d):
    ledger = V.ledger(s, d)
    events = ledgers.union_events(ledgers.ledger_by_record(ledger), ledger)
    return ledgers.timeline(events).select(
        "module", "id", iso("at").alias("at"), "segment", "seq", "kind", "command", "reason",
        joined("fields").alias("fields"), iso("written_time").alias("written"), "verdict", "verdict_seq")


@query
def l5_first_errors(s, d):
    return mutations.first_errors(_results(s, d), 20, ("batch", "row_id", "part")).select("batch", "row_id", "part", "code")


@query
def u1_union_modules(s, d):
    whole = scans.union_modules({"Deals": V.deals(s, d), "Accounts": V.accounts(s, d), "Leads": V.leads(s, d)})
    return whole.groupBy("module", "owner_id").agg(F.count("*").alias("records"), F.count("stage").alias("staged"))


@query
def u5_minus(s, d):
    return scans.minus(V.deals(s, d), V.deals_now(s, d), ["id", "stage"]).select("id", "stage")


# --- files ------------------------------------------------------------------

@query
def s10_envelopes(s, d):
    """All deals written as pages of responses, and read back."""
    deals, folder = V.deals(s, d).select("id", "stage", "amount", "modified_time", "closing_date"), shared_folder(s, "envelopes")
    envelopes.write_envelopes(deals, folder, page_rows=2000)
    return envelopes.load_envelopes(s, folder, deals.schema).withColumn("modified_time", iso("modified_time")).withColumn(
        "closing_date", F.col("closing_date").cast("string")).withColumn("amount", F.col("amount").cast("string"))


@query
def s14_write_report(s, d):
    """A report of the whole ledger, counts beside their rows."""
    book, folder = V.ledger(s, d), shared_folder(s, "reports")
    rows = book.select("segment", "seq", "outcome")
    found = files.write_report("ledger", ledgers.outcome_counts(book), rows, folder, "2024-01-31")
    summary, detail = files.read_report(s, found)
    return detail.groupBy("outcome").agg(F.count("*").alias("rows"), F.sum("seq").alias("seqs")).crossJoin(
        summary.select("entries"))


# --- change scan ------------------------------------------------------------

@query
def g10_scan_changes(s, d):
    _, found = changes.scan_changes(V.changes(s, d), V.ledger(s, d), V.FEED_SINCE)
    return found.select("event_id", "change_ref", "governed", iso("modified_at").alias("modified_at"), "modified_by")


@query
def g10_scan_summary(s, d):
    delivered = _read(s, d).where("modified_by = 'purchase'")
    summary, _ = changes.scan_changes(V.changes(s, d), V.ledger(s, d), V.FEED_SINCE, delivered=delivered)
    return summary.withColumn("ledger_covers_from", iso("ledger_covers_from"))


@query
def g10_ungoverned_by_day(s, d):
    _, found = changes.scan_changes(V.changes(s, d), V.ledger(s, d))
    return changes.changes_by_day(found).withColumn("day", F.col("day").cast("string"))


def _event_stream(s, d):
    raw = s.read.parquet(f"{d}/events.parquet").schema
    stream = change_stream.with_poll(s.readStream.schema(raw).parquet(f"{d}/events*.parquet"))
    return V.changes_of(stream.withColumn("ts", F.col("ts").cast("timestamp")))


@query
def k3_large_cap(s, d):
    """The oldest third of the feed of each module, by counted ranges of time."""
    feed = changes.read_changes(V.changes(s, d))
    found, truncated = changes.cap_per_module(feed, max(feed.count() // 6, 1000))
    return found.select("module", "change_ref").join(truncated, "module")


@query
def x1_stream_changes(s, d):
    """The scan as a stream run to its end; a change is delivered once, equal unreadable ones each."""
    folder = shared_folder(s, "stream")
    run = change_stream.stream_changes(_event_stream(s, d), lambda spark: (V.ledger(spark, d), None), f"{folder}/sink",
                                       f"{folder}/position")
    run.awaitTermination()
    return change_stream.delivered_changes(s, f"{folder}/sink").select("change_ref", "occurrence", "governed")


@query
def x3_dedupe_delivered(s, d):
    """The whole feed against an earlier poll that returned two events in three."""
    feed = changes.read_changes(V.changes(s, d))
    before = change_stream.numbered(feed.where("event_id % 3 > 0")).select("change_ref", "occurrence")
    fresh = change_stream.dedupe_delivered(feed, before.distinct())
    return fresh.select("change_ref", "occurrence")


@query
def x6_window_stream(s, d):
    """The window counts as a stream run to its end; the rows of x6_window_counts."""
    folder = shared_folder(s, "windows")
    run = change_stream.stream_window_counts(_event_stream(s, d), lambda spark: (V.ledger(spark, d), None),
                                             f"{folder}/sink", f"{folder}/position")
    run.awaitTermination()
    return change_stream.counted_windows(s, f"{folder}/sink").withColumn("window_start", iso("window_start"))


@query
def x6_window_counts(s, d):
    _, found = changes.scan_changes(V.changes(s, d), V.ledger(s, d))
    return change_stream.window_counts(found).withColumn("window_start", iso("window_start"))


# --- reconcile and custody --------------------------------------------------

def _doubts(s, d):
    return reconcile.reconcile(V.deal_ledger(s, d), reconcile.current_state(V.deals_now(s, d), ["stage"]))


@query
def g13_reconcile(s, d):
    return _doubts(s, d)[1].select("segment", "seq", "command", "id", "role", "basis", "verdict", "merge_state")


@query
def g13_totals(s, d):
    return _doubts(s, d)[0]


@query
def a14_entry_resolved(s, d):
    return reconcile.entry_resolved(_doubts(s, d)[1])


def _custody(s, d):
    current = V.deals_now(s, d).select("module", "id", F.col("modified_time").alias("modified_at"),
                                       F.col("owner_id").alias("modified_by"))
    return custody.custody_report(V.deals(s, d), V.deal_ledger(s, d), current)


@query
def g14_custody(s, d):
    return _custody(s, d)[1].select("id", "custody", "why", iso("modified_at").alias("modified_at"), "modified_by",
                                    iso("diverged_from").alias("diverged_from"), "governed_changes", "refusals",
                                    "unresolved")


@query
def g14_totals(s, d):
    return _custody(s, d)[0]


@query
def g14_timeline(s, d):
    return _custody(s, d)[2].select("id", iso("at").alias("at"), "segment", "seq", "kind", "command",
                                    iso("written_time").alias("written"))


# --- quality ----------------------------------------------------------------

def _hygiene(s, d):
    tables = {"Leads": V.leads(s, d), "Deals": V.deals(s, d), "Contacts": V.contacts(s, d), "Accounts": V.accounts(s, d)}
    return quality.hygiene_scan(tables, V.users(s, d), "2001-07-01 00:00:00")


@query
def g8_hygiene(s, d):
    return _hygiene(s, d)[0]


@query
def u2_union_checks(s, d):
    return _hygiene(s, d)[1]


@query
def k4_sample_per_check(s, d):
    return _hygiene(s, d)[2]


@query
def g9_readiness(s, d):
    out = quality.readiness(V.accounts(s, d), V.fields_meta(s), "Accounts", ["balance", "website"])
    return out.select("id", "ready", joined("missing_required").alias("missing_required"),
                      joined("missing_requested").alias("missing_requested"))


# --- plans ------------------------------------------------------------------

@query
def g1_update_plan(s, d):
    rows = V.deals(s, d).where("priority = '1-URGENT' and stage = 'Qualification'")
    state = fingerprints.state_fingerprint(rows, "Deals", ["modified_time", "stage"])
    return state.select("records", "digest", fingerprints.would_change(rows, {"stage": "Closed Won"})
                        .select("would_change").scalar().alias("would_change"))


@query
def g6_upsert_totals(s, d):
    return upsert.upsert_totals(matching.upsert_match(V.upsert_in(s, d), V.upsert_existing(s, d), ["code", "email"]))


@query
def g7_rollback_plan(s, d):
    """Undo the newest apply of every plan on deals: what comes back."""
    last = ledgers.last_applied(V.deal_ledger(s, d))
    before = last.select(F.substring("entry_id", 2, 20).alias("id")).join(V.deals(s, d), "id").select(
        "id", F.create_map(F.lit("stage"), F.col("stage")).alias("before"))
    out = matching.rollback_join(before, V.deals_now(s, d), ["stage"], {"stage": "Qualification"})
    return out.agg(F.count("*").alias("planned"), F.count_if(~F.col("missing")).alias("restorable"),
                   F.count_if(F.size("changed_again") > 0).alias("changed_again"))


# --- mutations --------------------------------------------------------------

@query
def m1_create(s, d):
    rows = V.table(s, d, "supplier").select(
        F.col("s_suppkey").alias("row_id"), F.lit("Accounts").alias("module"), V.text("s_nationkey").alias("owner_id"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("name"),
        F.when(F.col("s_nationkey") >= 5, "BUILDING").otherwise("MINING").alias("segment"))
    new, results = mutations.create_rows(V.accounts(s, d), rows, V.fields_meta(s), "Accounts")
    return results.join(new.select("id", "segment"), "id", "left").select("row_id", "id", "code", "field", "segment")


@query
def m2_update(s, d):
    updates = V.deals_now(s, d).select(
        F.when(F.col("priority") != "5-LOW", F.col("id")).alias("id"),
        F.when(F.col("amount") < 300000, F.col("stage")).alias("stage"), F.lit("9-DONE").alias("priority"),
        F.when(F.col("amount") < 100000, F.array(F.lit("stage"))).otherwise(
            F.array(F.lit("stage"), F.lit("priority"))).alias("given"))
    new, _ = mutations.update_rows(V.deals(s, d), updates, ["stage", "priority"], "given")
    return new.select("id", "stage", "priority")


@query
def m3_upsert(s, d):
    existing = V.upsert_existing(s, d)
    new, _ = mutations.upsert_rows(existing, V.upsert_in(s, d), ["code", "email"], ["code", "email", "stage"])
    return new.select("id", "code", "email", "stage", iso("modified_time").alias("modified_time"))


@query
def m4_delete(s, d):
    gone = V.line_children(s, d).where("flag = 'R'").select(F.col("parent_id").alias("id")).distinct()
    rest, binned = mutations.delete_rows(V.deals(s, d), gone, V.NOW)
    return rest.select("id", F.lit(None).cast("string").alias("expires_at")).unionByName(
        binned.select("id", iso("expires_at").alias("expires_at")))


@query
def m5_merge(s, d):
    kids = V.table(s, d, "orders").select(V.text("o_custkey").alias("parent_id"))
    records, _, _ = mutations.merge_rows(_parties(s, d), kids, V.merge_pairs(s, d), keep=("id", "Created_Time"))
    return records.select("id", "Full_Name", "Industry", F.col("Balance").cast("string").alias("Balance"), "Country")


@query
def m5_merge_children(s, d):
    kids = V.table(s, d, "orders").select(V.text("o_custkey").alias("parent_id"))
    _, moved, _ = mutations.merge_rows(_parties(s, d), kids, V.merge_pairs(s, d))
    return moved.groupBy("parent_id").agg(F.count("*").alias("children"))


@query
def m6_convert(s, d):
    """Every lead is asked for; those with orders get a deal from the largest."""
    best = V.deals(s, d).groupBy("account_id").agg(F.max_by(F.struct("id", "stage", "closing_date"),
                                                            F.struct("amount", "id")).alias("b"))
    leads = V.leads(s, d)
    deal = F.when(F.col("b").isNotNull(), F.struct(
        F.col("b.id").alias("Deal_Name"), F.col("b.closing_date").alias("Closing_Date"),
        F.when(F.col("b.stage") != "Closed Won", F.col("b.stage")).alias("Stage")))
    asked = leads.join(best, leads.id == best.account_id, "left").select(
        leads.id.alias("lead_id"), F.when(F.col("email").isNull(), "0").alias("assign_to"), deal.alias("deal"))
    mapping = {"contact": {"Full_Name": "name", "Email": "email"}, "account": {"Account_Name": "name"}}
    made, homes, deals, results = mutations.convert_leads(leads, asked, mapping)
    rows = made.select("id", "lead_id", "owner_id", F.col("Full_Name").alias("label")).unionByName(
        homes.select("id", "lead_id", "owner_id", F.col("Account_Name").alias("label"))).unionByName(
        deals.select("id", "lead_id", F.col("account_id").alias("owner_id"), F.col("Stage").alias("label")))
    return rows.unionByName(results.where("code <> 'SUCCESS'").select(
        F.lit("rejected").alias("id"), "lead_id", F.col("code").alias("owner_id"), F.col("message").alias("label")))


@query
def m7_notes(s, d):
    talk = V.table(s, d, "conversations")
    notes = V.table(s, d, "documents").select(V.text("doc_id").alias("parent_id"), F.lit(-1).cast("bigint").alias("turn"),
                                              F.col("text").alias("content"))
    fresh = talk.select(V.text("conv_id").alias("parent_id"), "turn", F.col("text").alias("content"))
    out = mutations.add_notes(notes, fresh)
    return out.select("parent_id", "turn", F.length("content").cast("bigint").alias("length"), F.md5("content").alias("md5"))


# --- plan to apply ----------------------------------------------------------

def _world(s, **tables: DataFrame):
    """Snapshot tables and an empty ledger in a new shared folder."""
    folder = shared_folder(s, "world")
    made = {m: SnapshotTable.create(df, f"{folder}/{m}", m) for m, df in tables.items()}
    return made, LedgerStore(s, f"{folder}/ledger")


def _updated(s, d):
    tables, ledger = _world(s, Deals=V.deals(s, d))
    where, change = "priority = '1-URGENT' and stage = 'Qualification'", {"stage": "Closed Won"}
    plan = update.plan_update(tables["Deals"].read(), "Deals", where, change)
    update.apply_update(plan, tables["Deals"], ledger, where, change, V.NOW)
    return plan, tables["Deals"], ledger


@query
def g2_apply_update(s, d):
    _, table, _ = _updated(s, d)
    return table.read().select("id", "stage", iso("modified_time").alias("modified_time"))


@query
def g2_refused_applies(s, d):
    """Applies that differ from their plan are refused and logged, and write nothing."""
    tables, ledger = _world(s, Deals=V.deals(s, d))
    deals = tables["Deals"]
    where, change = "priority = '1-URGENT' and stage = 'Qualification'", {"stage": "Closed Won"}
    pairs = deals.read().agg(F.min("id").alias("master_id"), F.max("id").alias("loser_id"))
    swapped = pairs.select(F.col("loser_id").alias("master_id"), F.col("master_id").alias("loser_id"))
    made = update.plan_update(deals.read(), "Deals", where, change)
    gone = delete.plan_delete(deals.read(), "Deals", "amount < 50000")
    one = merge.plan_merge(deals.read(), "Deals", {}, pairs)
    for attempt in (lambda: update.apply_update(made, deals, ledger, where, {"stage": "Other"}, V.NOW),
                    lambda: delete.apply_delete(gone, deals, ledger, "amount < 60000", V.NOW),
                    lambda: merge.apply_merge(one, deals, {}, swapped, ledger, V.NOW)):
        try:
            attempt()
        except PlanMismatch:
            pass
    planned = F.get_json_object("detail", "$.records").cast("bigint")
    return ledger.read().select("outcome", "command", planned.alias("planned"))


@query
def g2_ledger_records(s, d):
    """What the ledger holds about every record an update wrote."""
    _, _, ledger = _updated(s, d)
    return ledgers.ledger_by_record(ledger.read(), ledger.records()).select(
        "module", "id", "outcome", iso("written_time").alias("written"))


@query
def g3_apply_delete(s, d):
    tables, ledger = _world(s, Deals=V.deals(s, d))
    plan = delete.plan_delete(tables["Deals"].read(), "Deals", "amount < 50000")
    delete.apply_delete(plan, tables["Deals"], ledger, "amount < 50000", V.NOW)
    return tables["Deals"].read().select("id", "stage")


@query
def g4_apply_handover(s, d):
    tables, ledger = _world(s, Deals=V.deals(s, d), Accounts=V.accounts(s, d))
    plan = handover.plan_handover({m: t.read() for m, t in tables.items()}, V.users(s, d), "7", "8")
    handover.apply_handover(plan, tables, ledger, V.NOW)
    return scans.union_modules({m: t.read().select("id", "owner_id") for m, t in tables.items()})


@query
def g5_apply_merge(s, d):
    notes = V.table(s, d, "orders").select(V.text("o_orderkey").alias("id"), V.text("o_custkey").alias("parent_id"))
    people = _parties(s, d).withColumn("modified_time", F.lit("1999-01-01").cast("timestamp"))
    tables, ledger = _world(s, Contacts=people, Notes=notes)
    pairs = V.merge_pairs(s, d)
    kids = {"Notes": tables["Notes"]}
    shown = {"Notes": tables["Notes"].read().withColumn("title", F.col("id"))}
    plan = merge.plan_merge(tables["Contacts"].read(), "Contacts", shown, pairs)
    merge.apply_merge(plan, tables["Contacts"], kids, pairs, ledger, V.NOW)
    children = tables["Notes"].read().groupBy(F.col("parent_id").alias("id")).agg(F.count("*").alias("children"))
    return tables["Contacts"].read().join(children, "id", "left").select(
        "id", "Full_Name", F.col("Balance").cast("string").alias("Balance"), "Country", "children")


@query
def g6_apply_upsert(s, d):
    tables, ledger = _world(s, Deals=V.upsert_existing(s, d))
    incoming, fields = V.upsert_in(s, d), ["code", "email"]
    plan = upsert.plan_upsert(tables["Deals"].read(), "Deals", incoming, fields)
    upsert.apply_upsert(plan, tables["Deals"], ledger, incoming, fields, [*fields, "stage"], V.NOW)
    return tables["Deals"].read().select("id", "code", "email", "stage")


@query
def g7_apply_rollback(s, d):
    plan, table, ledger = _updated(s, d)
    back = rollback.plan_rollback(ledger.read(), ledger.records(), table.read(), "Deals", plan.key)
    rollback.apply_rollback(back, table, ledger, V.NOW)
    return table.read().select("id", "stage")


# --- scalar rules over whole tables -----------------------------------------

@query
def p6_ignorable_field(s, d):
    people = _parties(s, d)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), scalars.is_blank(people, c).alias("blank"))
                                for c in people.columns]))
    return (people.select(cells.alias("c")).select("c.*").groupBy("field")
            .agg(F.count("*").alias("cells"), F.count_if("blank").alias("blanks"))
            .withColumn("ignorable", scalars.ignorable_field("field")))


@query
def p11_usable_written(s, d):
    """Rows of each write batch that a later scan can match."""
    rows = _results(s, d).where("code = 'SUCCESS'")
    kept = scalars.usable_written(F.array(F.struct("id", "modified_time")))
    return rows.select("batch", "row_id", "part", F.size(F.coalesce(kept, F.array().cast(
        "array<struct<id:string,modified_time:string>>"))).cast("bigint").alias("usable"))


@query
def f9_moved(s, d):
    now = V.deals_now(s, d).select("id", F.col("modified_time").alias("now"))
    return V.deals(s, d).join(now, "id", "left").select(
        "id", scalars.moved("modified_time", "now").alias("moved"), scalars.valid_id("id").alias("valid"),
        scalars.change_ref("module", "id", "now").alias("change_ref"))

"""Record tables, change feeds and ledgers derived from the benchmark tables.

Each function reads whole tables and derives every row from them; the work of
a query on these views grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeguard.functions.scalars import iso_text

NOW = "2002-01-01 00:00:00"
FEED_SINCE = "2024-01-08T05:30:00+05:30"
SEGMENT = 5000
OFFSET = "interval 5 hours 30 minutes"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.col("n_regionkey")
    return table(spark, sf_dir, "nation").select(
        text("n_nationkey").alias("id"), F.col("n_name").alias("full_name"),
        F.concat(F.lower("n_name"), F.lit("@example.com")).alias("email"),
        F.when(region == 0, "inactive").otherwise("active").alias("status"),
        (region != 1).alias("confirm"),
        F.struct(text(region).alias("id"), F.concat(F.lit("ROLE_"), text(region)).alias("name")).alias("role"),
        F.struct(text(region).alias("id"),
                 F.when(region == 2, "Administrator").otherwise("Standard").alias("name")).alias("profile"))


def _stage(status: str) -> Column:
    return (F.when(F.col(status) == "F", "Closed Won").when(F.col(status) == "P", "Closed-Lost to Competition")
            .otherwise("Qualification"))


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("Deals").alias("module"), text("o_orderkey").alias("id"),
        text(F.col("o_custkey") % 25).alias("owner_id"), text("o_custkey").alias("account_id"),
        _stage("o_orderstatus").alias("stage"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderdate").alias("modified_time"), F.date_add(F.to_date("o_orderdate"), 90).alias("closing_date"),
        F.col("o_orderpriority").alias("priority"))


def deals_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later state: big urgent deals were won, big ones were touched a day
    later, the smallest were deleted."""
    won = F.col("priority").isin("1-URGENT", "4-NOT SPECIFIED") & (F.col("amount") > 250000)
    return (deals(spark, sf_dir).where(F.col("amount") >= 50000)
            .withColumn("modified_time", F.when(F.col("amount") > 200000, F.expr("modified_time + interval 1 day"))
                        .otherwise(F.col("modified_time")))
            .withColumn("stage", F.when(won, "Closed Won").otherwise(F.col("stage"))))


def _people(df: DataFrame, module: str, prefix: str) -> DataFrame:
    key = f"{prefix}_{'custkey' if prefix == 'c' else 'suppkey'}"
    name = F.col(f"{prefix}_name")
    return df.select(
        F.lit(module).alias("module"), text(key).alias("id"), text(f"{prefix}_nationkey").alias("owner_id"),
        name.alias("name"),
        F.when(F.col(f"{prefix}_acctbal") >= 0, F.concat(F.lower(name), F.lit("@example.com"))).alias("email"),
        (F.lit("2001-01-01").cast("timestamp")
         + F.make_dt_interval(days=(F.col(key) % 360).cast("int"))).alias("modified_time"))


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(table(spark, sf_dir, "customer"), "Leads", "c")


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _people(table(spark, sf_dir, "supplier"), "Contacts", "s")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.lit("Accounts").alias("module"), text("c_custkey").alias("id"), text("c_nationkey").alias("owner_id"),
        F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"),
        F.lit("1999-01-01").cast("timestamp").alias("modified_time"))


def line_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("parent_id"), F.concat(F.lit("L"), text("l_linenumber")).alias("title"),
        F.col("l_returnflag").alias("flag"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed: every event changes one record; some times carry an
    offset and some cannot be read."""
    return changes_of(table(spark, sf_dir, "events"))


def changes_of(events: DataFrame) -> DataFrame:
    second = F.date_trunc("second", "ts")
    shifted = F.concat(F.date_format(second + F.expr(OFFSET), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30"))
    raw = (F.when(F.col("event_id") % 97 == 0, "unreadable").when(F.col("event_id") % 5 == 0, shifted)
           .otherwise(iso_text(second)))
    return events.select(
        "event_id", _event_module().alias("module"), text("user_id").alias("id"), raw.alias("modified_raw"),
        F.col("event_type").alias("modified_by"), *[c for c in ("poll",) if c in events.columns])


def _event_module() -> Column:
    return F.when(F.col("event_id") % 2 == 0, "Leads").otherwise("Contacts")


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per event.  Two applied entries in three match a change
    exactly, the others missed it by a second or carry no time at all."""
    ev = table(spark, sf_dir, "events")
    before = ev.select((F.col("event_id") + 1).alias("event_id"), text("user_id").alias("prev_id"))
    e, uid = F.col("event_id"), text("user_id")
    turn = e % 10
    wrote = iso_text(F.date_trunc("second", "ts") + F.make_dt_interval(
        secs=F.when(e % 4 == 3, F.lit(1)).otherwise(0).cast("decimal(18,6)")))
    fields = F.array(F.lit("Stage"))
    prior = F.struct(F.col("event_type").alias("Stage"))
    detail = (
        F.when(turn <= 5, _json(
            records=F.lit(1), fields=fields,
            written=F.array(F.struct(uid.alias("id"), wrote.alias("modified_time"))),
            before=F.array(F.struct(uid.alias("id"), prior.alias("before")))))
        .when(turn == 6, _json(records=F.lit(1), written=F.lit(None).cast("string"), targets=F.array(uid)))
        .when((turn == 7) & (e % 20 == 7), _json(reason=F.lit("state moved"), targets=F.array(uid)))
        .when(turn == 7, _json(reason=F.lit("state moved"), losers=F.lit(2)))
        .when(turn == 8, _json(
            verdict_basis=F.lit("value"), intent=prior, reason=F.lit("no answer"),
            targets=F.array(F.struct(uid.alias("id"), prior.alias("before"),
                                     iso_text("ts").alias("before_modified_time")))))
        .otherwise(_json(
            resolves_seq=(e - 1) % SEGMENT + 1, resolved=e % 20 == 9,
            verdicts=F.array(F.struct(F.col("prev_id").alias("id"),
                                      F.when(e % 20 == 9, "landed").otherwise("unknown").alias("verdict"))))))
    outcome = (F.when(turn <= 6, "applied").when(turn == 7, "refused").when(turn == 8, "unresolved")
               .otherwise("reconciled"))
    return ev.join(before, "event_id", "left").select(
        F.floor(e / SEGMENT).cast("bigint").alias("segment"), (e % SEGMENT + 1).alias("seq"),
        F.concat(F.lit("e"), text(e)).alias("entry_id"), outcome.alias("outcome"),
        F.when(turn == 9, "reconcile_writes").otherwise("apply_update").alias("command"),
        _event_module().alias("module"), F.concat(F.lit("k"), text(F.col("user_id") % 10)).alias("plan_key"),
        F.date_trunc("second", "ts").alias("at"), detail.alias("detail"), F.col("value").alias("_value"))


def deal_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per deal; the order priority decides what happened to it."""
    o = table(spark, sf_dir, "orders")
    key, price, day = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderdate")
    kind, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    later = F.when(price > 200000, F.expr("o_orderdate + interval 1 day")).otherwise(day)
    prior = F.struct(_stage("o_orderstatus").alias("stage"))
    merge = (status == "F") & (price > 400000)
    target = F.struct(text(key).alias("id"), prior.alias("before"), iso_text(day).alias("before_modified_time"),
                      F.when(merge, "master").alias("role"))
    loser = F.struct(text(key + 1).alias("id"), prior.alias("before"), iso_text(day).alias("before_modified_time"),
                     F.lit("loser").alias("role"))
    basis = F.when(status == "O", "value").when(status == "F", "existence").otherwise("modified_time")
    doubt = _json(verdict_basis=basis, reason=F.lit("no answer"), fields=F.array(F.lit("stage")),
                  intent=F.when(status == "O", F.struct(F.lit("Closed Won").alias("stage"))),
                  targets=F.when(merge, F.array(target, loser)).otherwise(F.array(target)))
    timed = lambda at: _json(records=F.lit(1), fields=F.array(F.lit("stage")), written=F.array(
        F.struct(text(key).alias("id"), iso_text(at).alias("modified_time"))))
    detail = (F.when(kind == "1-URGENT", timed(later)).when(kind == "2-HIGH", timed(day))
              .when(kind == "3-MEDIUM", _json(records=F.lit(1), targets=F.array(text(key))))
              .when(kind == "4-NOT SPECIFIED", doubt)
              .otherwise(_json(reason=F.lit("state moved"), targets=F.array(text(key)))))
    outcome = (F.when(kind == "4-NOT SPECIFIED", "unresolved").when(kind == "5-LOW", "refused")
               .otherwise("applied"))
    command = (F.when(outcome != "unresolved", "apply_update").when(merge, "apply_merge")
               .when(status == "F", "apply_delete").when(status == "P", "apply_upsert").otherwise("apply_update"))
    return o.select(
        F.floor(key / SEGMENT).cast("bigint").alias("segment"), (key % SEGMENT + 1).alias("seq"),
        F.concat(F.lit("d"), text(key)).alias("entry_id"), outcome.alias("outcome"), command.alias("command"),
        F.lit("Deals").alias("module"), F.concat(F.lit("k"), text(F.col("o_custkey"))).alias("plan_key"),
        day.alias("at"), detail.alias("detail"))


def upsert_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming rows: finished orders keep their key, others come with a new
    one; urgent rows come twice."""
    o = table(spark, sf_dir, "orders")
    fresh = F.when(F.col("o_orderstatus") == "F", F.lit(0)).otherwise(F.lit(10 ** 9))
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return o.select("*", F.explode(copies).alias("copy")).select(
        (F.col("o_orderkey") * 2 + F.col("copy")).alias("row_id"),
        F.concat(F.lit("D-"), text(F.col("o_orderkey") + fresh)).alias("code"),
        F.when(F.col("o_totalprice") < 400000, F.concat(text(F.col("o_orderkey") + fresh), F.lit("@example.com")))
        .alias("email"),
        F.lit("Renewed").alias("stage"))


def upsert_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing deals with two natural keys; low-priority ones lack the code."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        text("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("D-"), text("o_orderkey"))).alias("code"),
        F.concat(text("o_orderkey"), F.lit("@example.com")).alias("email"),
        _stage("o_orderstatus").alias("stage"), F.col("o_orderdate").alias("modified_time"))


def merge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each even customer absorbs the odd one after it."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    pair = F.floor(F.col("c_custkey") / 2) * 2
    return (c.groupBy(pair.alias("m")).agg(F.max("c_custkey").alias("l")).where("l > m")
            .select(text(F.col("m").cast("bigint")).alias("master_id"), text("l").alias("loser_id")))


def fields_meta(spark: SparkSession) -> DataFrame:
    """Field metadata: one row per (module, field)."""
    rows = [("Accounts", 1, "id", True, False, True, None),
            ("Accounts", 2, "owner_id", True, False, False, None),
            ("Accounts", 3, "name", True, False, False, None),
            ("Accounts", 4, "segment", False, True, False,
             ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]),
            ("Accounts", 5, "balance", False, False, False, None)]
    return spark.createDataFrame(
        rows, "module string, position int, field string, system_mandatory boolean, required boolean, "
              "read_only boolean, pick_list_values array<string>")

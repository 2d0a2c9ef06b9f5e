"""The corpus operators over whole tables, with the columns that their contracts name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeguard.llm import decontaminate, divergence, exactdup, html_text, language_model, neardup, ngram_join, packing, paragraphs, secret_scan, toxicity, turns, warc
from changeguard.llm.text import table


def captures(pages: DataFrame) -> DataFrame:
    """Web archive records from ``pages``: each page as a response, and a revisit of it some hundred captures later.

    Record ids are twice the page id, and one more for the revisit.  The
    revisit asks with the page's own entity tag, so it resolves only if its
    URL has not been captured with other content in between.
    """
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.encode("html", "utf-8")), 1, 16), F.lit('"'))
    at = lambda seconds: F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60 + seconds)
    kind = "map<string,string>"
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        at(0).alias("date"),
        F.lit(True).alias("is_full"),
        F.lit(200).alias("status"),
        F.create_map(
            F.lit("content-type"), F.lit("text/html"), F.lit("etag"), tag,
            F.lit("content-length"), F.octet_length("html").cast("string"),
        ).cast(kind).alias("headers"),
        F.md5(F.encode("html", "utf-8")).alias("payload_digest"),
    )
    revisit = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        "url",
        at(30_030).alias("date"),
        F.lit(False).alias("is_full"),
        F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("content-length"), F.lit("0"), F.lit("expires"), F.lit("0"),
        ).cast(kind).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    return full.unionByName(revisit)


def op1_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda h: F.concat(h["key"], F.lit("="), h["value"]))
    return warc.resolve_revisits(captures(table(spark, folder, "pages"))).select(
        F.floor((F.col("record_id") - 1) / 2).cast("long").alias("page_id"),
        "canonical_url",
        F.floor(F.col("refers_to") / 2).cast("long").alias("refers_to"),
        "outcome",
        F.coalesce("status", F.lit(304)).alias("status"),
        "payload_digest",
        F.array_join(lines, "|").alias("headers"),
    )


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.concat_ws(",", "items"), "utf-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_groups(table(spark, folder, "documents")).drop("digest")


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.repeats(table(spark, folder, "documents")).drop("digest")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdup.exact_copies(table(spark, folder, "documents")).withColumnRenamed("digest", "text_sha256")


def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return secret_scan.find_secrets(table(spark, folder, "documents")).select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(F.encode(secret_scan.span_text(F.col("base")), "utf-8"), 256).alias("base_sha256"),
        secret_scan.span_text(F.concat("base", "bare")).alias("spans"),
        "n_live",
        "n_shared",
    )


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score_texts(table(spark, folder, "documents"))


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages")).select(
        "page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars")
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    score = F.col("__toxic")
    return toxicity.with_scores(docs, table(spark, folder, "labels")).select(
        "doc_id",
        F.coalesce(toxicity.fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),  # a null key is in no fold
        score.alias("score"),
        F.when(score >= toxicity.REJECT, 1).otherwise(0).alias("predicted"),
    )


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with some rows dropped, emptied, cut, repeated or given to the user, by a checksum of their place."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "utf-8")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), draw.alias("draw")).filter("draw <> 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return turns.repair(damaged(rows), rows.select("conv_id"))


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_components(table(spark, folder, "documents"))


QUERIES = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_decontaminate": op2_decontaminate,
    "op7_language_model": op7_language_model,
    "op8_html_text": op8_html_text,
    "op9_toxicity": op9_toxicity,
    "op10_secret_scan": op10_secret_scan,
    "op3_near_dedup": op3_near_dedup,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op11_divergence": op11_divergence,
    "op12_turn_repair": op12_turn_repair,
    "op13_ngram_join": op13_ngram_join,
}

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_warc_revisits": r"""
        with cut as (
            select page_id, html,
                regexp_replace(regexp_replace(trim(url), '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as rest
            from pages
        ), parts as (
            select page_id, html,
                regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '') as host,
                regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/$', '') as path,
                list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1, 's'), '&'),
                    lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=]*|gclid|fbclid|ref)(=.*)?$'))) as pairs
            from cut
        ), named as (
            select page_id, html, md5(html) as digest,
                host || path || case when len(pairs) > 0 then '?' || array_to_string(pairs, '&') else '' end as canonical_url
            from parts
        ), last as (
            select v.page_id, v.canonical_url, v.digest, v.html,
                max(f.page_id) as refers_to
            from named v left join named f on f.canonical_url = v.canonical_url and f.page_id * 60 < v.page_id * 60 + 30030
            group by all
        )
        select l.page_id, l.canonical_url, l.refers_to,
            case when l.refers_to is null then 'missing'
                when substr(l.digest, 1, 16) = substr(f.digest, 1, 16) then 'resolved' else 'changed' end as outcome,
            case when substr(l.digest, 1, 16) = substr(f.digest, 1, 16) then 200 else 304 end as status,
            case when substr(l.digest, 1, 16) = substr(f.digest, 1, 16) then f.digest end as payload_digest,
            case when substr(l.digest, 1, 16) = substr(f.digest, 1, 16) then
                'content-length=' || octet_length(encode(f.html)) || '|content-type=text/html|etag=W/"'
                || substr(l.digest, 1, 16) || '"|expires=0' end as headers
        from last l left join named f on f.page_id = l.refers_to
    """,
    "op6_exact_dedup": f"""
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
            doc_id = max(doc_id) over g as kept, sha256(norm) as text_sha256
        from (select doc_id, {_NORM} as norm from documents) window g as (partition by norm)
    """,
    "op11_divergence": r"""
        with docs as (
            select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
            from documents
        ), uses as (
            select row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
        ), kept as (
            select lang, term, count(*) as c from uses group by all having count(distinct row) >= 30
        ), sizes as (
            select lang, count(*) as v, sum(c) as n from kept group by all
        ), counts as (
            select lang, source, term, count(*) as c from uses semi join kept using (lang, term) group by all
        ), totals as (
            select lang, source, sum(c) as n from counts group by all
        ), groups as (
            select g.lang, g.source, coalesce(t.n, 0) as n, coalesce(s.v, 0) as v, coalesce(s.n, 0) as ln
            from (select distinct lang, source from docs) g
            left join totals t using (lang, source) left join sizes s using (lang)
        ), dense as (
            select g.lang, g.source, k.term, coalesce(c.c, 0) as c,
                1 + (1000000000::hugeint * (coalesce(c.c, 0) + 5)) // (g.n + 5 * g.v) as p,
                1 + (1000000000::hugeint * (k.c + 5)) // (g.ln + 5 * g.v) as q
            from groups g join kept k using (lang) left join counts c using (lang, source, term)
        ), sums as (
            select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
            from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
        ), found as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
            from groups a join groups b on a.lang = b.lang and a.source <> b.source
            left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
            union all
            select lang, source, 'term', term, (p - q)::bigint from dense where c > 0 and p > q
        ), ranked as (
            select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from found
        )
        select * from ranked where part = 'pair' or rank <= 50
    """,
    "op12_turn_repair": r"""
        with recursive keyed as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
            from conversations
        ), drawn as (
            select *, xor(4294967295, list_reduce(
                list_prepend(4294967295::bigint, list_transform(string_split(key, ''), lambda x: ascii(x)::bigint)),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                    lambda c, z: xor(c >> 1, 3988292384 * (c & 1)) + z))) % 20 as draw
            from keyed
        ), rows as (
            select conv_id, turn, case when draw = 4 then 'user' else role end as role,
                case draw when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                unnest(range(case when draw = 3 then 2 else 1 end)) as copy
            from drawn where draw <> 0
        ), placed as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || text)) as pos,
                rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as cut
            from rows
        ), faults as (
            select *, left(role, 1) as initial, coalesce(lead(pos) over c > 0, false) as more,
                case when cut = '' then 'blank'
                    when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'duplicate'
                    when right(cut, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
                coalesce(lag(left(role, 1)) over c || left(role, 1) not in ('su', 'ua', 'au'), false) as illegal
            from placed window c as (partition by conv_id order by pos)
        ), way as (
            -- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
            select conv_id, 0 as pos, 0 as state, 0 as cost, '' as audit, '' as lines from faults where pos = 1
            union all
            select conv_id, pos, state, best.cost, best.audit, best.lines from (
                select w.conv_id, f.pos, e.state, min({cost: w.cost + e.cost, audit: w.audit || e.audit, lines: w.lines || e.lines}) as best
                from way w join faults f on f.conv_id is not distinct from w.conv_id and f.pos = w.pos + 1,
                lateral (
                    -- turns put in before the row lead from w.state to i.state
                    select i.state, i.cost + 4 as cost, i.audit || 'D' as audit, i.lines as lines
                    from (values (0, 0, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                        (1, 1, 0, '', ''), (1, 2, 3, 'I', chr(10) || 'user:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                        (2, 2, 0, '', ''), (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 3, 0, '', ''), (3, 2, 3, 'I', chr(10) || 'user:')
                    ) i(from_state, state, cost, audit, lines) where i.from_state = w.state
                    union all
                    select case when t.edit = 'K' then case f.initial when 's' then 1 when 'u' then 2 else 3 end when i.state = 2 then 3 else 2 end,
                        i.cost + t.cost + case when f.fault = 'truncated' then 3 else 0 end, i.audit || t.edit,
                        i.lines || chr(10) || case when t.edit = 'K' then f.role when i.state = 2 then 'assistant' else 'user' end || ':' || f.text
                    from (values (0, 0, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'), (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                        (1, 1, 0, '', ''), (1, 2, 3, 'I', chr(10) || 'user:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                        (2, 2, 0, '', ''), (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 3, 0, '', ''), (3, 2, 3, 'I', chr(10) || 'user:')
                    ) i(from_state, state, cost, audit, lines), (values ('K', 0), ('R', 3)) t(edit, cost)
                    where i.from_state = w.state and f.fault not in ('blank', 'duplicate')
                        and (t.edit = 'R' or (f.initial = 's' and i.state = 0) or (f.initial = 'u' and i.state <> 2) or (f.initial = 'a' and i.state = 2))
                ) e
                group by w.conv_id, f.pos, e.state
            )
        ), ends as (
            select w.conv_id, min({cost: w.cost + e.cost, audit: w.audit || e.audit, lines: w.lines || e.lines}) as best
            from way w join faults f on f.conv_id is not distinct from w.conv_id and f.pos = w.pos and not f.more
            join (values (0, 0, '', ''), (1, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 3, 'I', chr(10) || 'assistant:'), (3, 0, '', '')
            ) e(state, cost, audit, lines) on e.state = w.state
            group by w.conv_id
        ), counts as (
            select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
                count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated, count(*) filter (illegal) as illegal
            from faults group by conv_id
        )
        select k.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
            coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(e.best.cost, 0)::bigint as cost,
            coalesce(e.best.audit, '') as audit, sha256(coalesce(substr(e.best.lines, 2), '')) as repaired_sha256
        from (select distinct conv_id from conversations) k
        left join counts c on c.conv_id is not distinct from k.conv_id
        left join ends e on e.conv_id is not distinct from k.conv_id
    """,
    "op13_ngram_join": r"""
        with recursive docs as (
            select row_number() over () as row, doc_id,
                list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
            from documents
        ), sets as (
            select row, doc_id, case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
                else list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))) end as grams
            from docs
        ), classes as (
            select min(row) as cid, min(doc_id) as least, list_sort(grams) as grams, len(grams) as n from sets where len(grams) > 0 group by list_sort(grams), len(grams)
        ), each as (
            select cid, n, unnest(grams) as gram from classes
        ), links as (
            select a.cid as one, b.cid as two from each a join each b on a.gram = b.gram and a.cid <> b.cid
            group by a.cid, b.cid, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reached as (
            select cid, cid as other from classes union select r.cid, l.two from reached r join links l on l.one = r.other
        ), named as (
            select r.cid, min(c.least) as component_id from reached r join classes c on c.cid = r.other group by r.cid
        )
        select s.doc_id, len(s.grams)::bigint as n_shingles, coalesce(n.component_id, s.doc_id) as component_id
        from sets s left join classes c on c.grams = list_sort(s.grams) left join named n on n.cid = c.cid
    """,
}

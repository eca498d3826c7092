"""Queries for the operators on records, links, pages and streams, with SQL.

Arrays are joined into strings and doubles rounded, so that results compare by value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kedge import scratch
from kedge.functions import similarity as sim
from kedge.functions import text as tx
from kedge.functions.identity import content_fingerprint, is_uuid, match_fingerprint, revision_fingerprint, short_id, stable_key
from kedge.operators import compare, layout, linkage, metrics, pages, quality, rollups
from kedge.plans import duck
from kedge.plans.links import signature_numbers, signature_words
from kedge.sources import store
from kedge.streaming import ingest

_Q: dict = {}
_S: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def keep(f):
        _Q[name] = f
        if sql:
            _S[name] = sql
        return f

    return keep


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- comparison of snapshots simulated from orders

_A = "SELECT o_orderkey AS k, o_totalprice AS price, o_orderpriority AS priority, o_custkey AS pos FROM orders WHERE o_orderkey % 10 <> 0"
_B = """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 13 = 0 THEN o_custkey + 1 ELSE o_custkey END AS pos
  FROM orders WHERE o_orderkey % 10 <> 1"""
_B2 = f"{_B} UNION ALL SELECT * FROM ({_B}) z WHERE k % 97 = 0"


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("pos"))
    a = o.where("k % 10 <> 0")
    b = o.where("k % 10 <> 1").select("k", F.expr("CASE WHEN k % 7 = 0 THEN price + 1 ELSE price END").alias("price"), F.expr("CASE WHEN k % 11 = 0 THEN 'X' ELSE priority END").alias("priority"), F.expr("CASE WHEN k % 13 = 0 THEN pos + 1 ELSE pos END").alias("pos"))
    return a, b.unionByName(b.where("k % 97 = 0"))


_DIFF = f"""WITH a AS (SELECT k, count(*) n, min(price) price, min(priority) priority, min(pos) pos FROM ({_A}) GROUP BY k),
 b AS (SELECT k, count(*) n, min(price) price, min(priority) priority, min(pos) pos FROM ({_B2}) GROUP BY k),
 j AS (SELECT coalesce(a.k, b.k) AS key, coalesce(a.n, 0) AS an, coalesce(b.n, 0) AS bn, a.price IS DISTINCT FROM b.price AS p, a.priority IS DISTINCT FROM b.priority AS q, a.pos IS DISTINCT FROM b.pos AS m FROM a FULL OUTER JOIN b ON a.k = b.k),
 s AS (SELECT key, an AS before, bn AS after, CASE WHEN an > 1 OR bn > 1 THEN 'ambiguous' WHEN an = 0 THEN 'added' WHEN bn = 0 THEN 'removed' WHEN p OR q THEN 'changed' ELSE 'same' END AS status,
   CASE WHEN an = 1 AND bn = 1 THEN concat_ws(',', CASE WHEN p THEN 'price' END, CASE WHEN q THEN 'priority' END) ELSE '' END AS changed, an = 1 AND bn = 1 AND m AS moved FROM j)"""


def _diff(spark: SparkSession, d: str) -> DataFrame:
    a, b = _sides(spark, d)
    return compare.record_diff(a, b, key="k", fields=["price", "priority"], position="pos")


@_query("diff_records", _DIFF + " SELECT key, status, changed, moved, before, after FROM s WHERE status <> 'same' OR moved")
def _(spark, d):
    return _diff(spark, d).where("status <> 'same' or moved").select("key", "status", F.array_join("changed", ",").alias("changed"), "moved", "before", "after")


@_query("diff_totals", _DIFF + """ SELECT sum(before)::BIGINT AS previous, sum(after)::BIGINT AS current, sum(after - before)::BIGINT AS delta,
 sum(CASE WHEN status IN ('added', 'ambiguous') THEN after ELSE 0 END)::BIGINT AS added, sum(CASE WHEN status IN ('removed', 'ambiguous') THEN before ELSE 0 END)::BIGINT AS removed,
 count(*) FILTER (status = 'changed') AS changed, count(*) FILTER (moved) AS moved, count(*) FILTER (status = 'ambiguous') AS ambiguous_keys, count(*) FILTER (status = 'same' AND NOT moved) AS unchanged FROM s""")
def _(spark, d):
    return compare.diff_totals(_diff(spark, d))


_LAST = """lv AS (SELECT * FROM (SELECT lower(trim(url)) AS url, sha256, bytes, content_type, run_id, row_number() OVER (PARTITION BY lower(trim(url)) ORDER BY run_id DESC, sha256 DESC NULLS LAST, bytes DESC NULLS LAST, content_type DESC NULLS LAST) AS rn FROM media_records WHERE trim(url) <> '') WHERE rn = 1)"""


@_query("map_diff", """WITH h AS (SELECT url, lower(sha256) AS v, delivered_at >= TIMESTAMP '2024-07-01' AS late FROM media_records WHERE url IS NOT NULL),
 a AS (SELECT url, max(v) AS v FROM h WHERE NOT late GROUP BY url), b AS (SELECT url, max(v) AS v FROM h WHERE late GROUP BY url)
 SELECT coalesce(a.url, b.url) AS key, CASE WHEN a.url IS NULL THEN 'added' WHEN b.url IS NULL THEN 'removed' WHEN a.v IS DISTINCT FROM b.v THEN 'changed' ELSE 'same' END AS status FROM a FULL OUTER JOIN b ON a.url = b.url""")
def _(spark, d):
    m = _t(spark, d, "media_records").select("url", F.lower("sha256").alias("v"), (F.col("delivered_at") >= F.lit("2024-07-01").cast("timestamp_ntz")).alias("late"))
    return compare.map_diff(m.where("not late"), m.where("late"), key="url", value="v")


# ---- identity, summaries, constraints


@_query("stable_keys", """SELECT DISTINCT stable_key AS given, CASE WHEN official_id IS NOT NULL THEN 'official:' || official_id ELSE 'fallback:' || match_fingerprint END AS derived FROM questions WHERE match_fingerprint IS NOT NULL OR official_id IS NOT NULL""")
def _(spark, d):
    q = _t(spark, d, "questions").where("match_fingerprint is not null or official_id is not null")
    return q.select(F.col("stable_key").alias("given"), stable_key(F.col("official_id"), F.col("match_fingerprint")).alias("derived")).distinct()


_JSON_RES = "list_transform({0}, lambda r: '\"' || r.url || '\"')"


@_query("match_fingerprints", """SELECT DISTINCT sha256('{"algorithm":"match-fingerprint-v1","answers":[' ||
 coalesce(array_to_string(list_transform(answers, lambda a: '{"id":"' || a.id || '","resources":[' || coalesce(array_to_string(list_transform(a.resources, lambda r: '"' || r.url || '"'), ','), '') || '],"text":"' || a.text || '"}'), ','), '') ||
 '],"resources":[' || coalesce(array_to_string(list_transform(resources, lambda r: '"' || r.url || '"'), ','), '') || '],"text":"' || text || '"}') AS fingerprint FROM questions""")
def _(spark, d):
    q = _t(spark, d, "questions")
    return q.select(match_fingerprint(F.col("text"), F.col("resources"), F.col("answers")).alias("fingerprint")).distinct()


def _json_list(items: str) -> str:
    return f"'[' || coalesce(array_to_string({items}, ','), '') || ']'"


_URLS = lambda c: _json_list(f"list_transform({c}, lambda r: to_json(r.url)::VARCHAR)")
_ANSWERS = lambda ids: _json_list("list_transform(answers, lambda a: '{' || " + ("'\"id\":' || to_json(a.id)::VARCHAR || ',' || " if ids else "") + "'\"resources\":' || " + _URLS("a.resources") + " || ',\"text\":' || to_json(a.text)::VARCHAR || '}')")


@_query("content_fingerprints", f"""WITH q AS (SELECT *, sha256('{{"algorithm":"match-fingerprint-v1","answers":' || {_ANSWERS(True)} || ',"resources":' || {_URLS("resources")} || ',"text":' || to_json(text)::VARCHAR || '}}') AS m FROM questions)
 SELECT snapshot_id, stable_key, sha256('{{"answers":' || {_ANSWERS(False)} || ',"resources":' || {_URLS("resources")} || ',"text":' || to_json(text)::VARCHAR || '}}') AS content,
  sha256('{{"algorithm":"revision-fingerprint-v2","correct_answer_ids":' || {_json_list("list_transform(list_sort(correct_answer_ids), lambda x: to_json(x)::VARCHAR)")} || ',"correct_flags":' || {_json_list("list_transform(answers, lambda a: to_json(a.correct)::VARCHAR)")} || ',"is_additional":' || coalesce(to_json(is_additional)::VARCHAR, 'null')
   || ',"match":"' || m || '","multiple":' || to_json(multiple)::VARCHAR || ',"type":' || to_json(question_type)::VARCHAR || '}}') AS revision FROM q""")
def _(spark, d):
    q = _t(spark, d, "questions")
    return q.select("snapshot_id", "stable_key", content_fingerprint(F.col("text"), F.col("resources"), F.col("answers")).alias("content"), revision_fingerprint(match_fingerprint(F.col("text"), F.col("resources"), F.col("answers")), F.col("question_type"), F.col("multiple"), F.col("is_additional"), F.col("correct_answer_ids"), F.col("answers")).alias("revision"))


@_query("record_summary", """SELECT snapshot_id, count(*) AS positions, count(official_id) AS with_official_id, count(*) FILTER (official_id IS NULL) AS without_official_id, count(DISTINCT official_id) AS unique_official_ids, count(DISTINCT stable_key) AS unique_keys,
 count(*) FILTER (question_type = 'single') AS single, count(*) FILTER (question_type = 'multiple') AS multiple, count(*) FILTER (len(resources) > 0) AS question_media,
 count(*) FILTER (len(list_filter(answers, lambda a: len(a.resources) > 0)) > 0) AS answer_media,
 coalesce(max(position_no) = count(*), false) AND min(position_no) = 1 AND count(DISTINCT position_no) = count(*) AS consecutive FROM questions GROUP BY snapshot_id""")
def _(spark, d):
    return quality.record_summary(_t(spark, d, "questions"), by=["snapshot_id"])


#: Positions with a gap after every fifty, since the supplied ones have none.
_GAPPED = "position_no + CAST(floor(position_no / 50) AS INT)"


@_query("position_gaps", f"""WITH s AS (SELECT DISTINCT snapshot_id, {_GAPPED} AS position_no FROM questions WHERE position_no IS NOT NULL), g AS (SELECT snapshot_id, coalesce(lag(position_no) OVER (PARTITION BY snapshot_id ORDER BY position_no), 0) AS before, position_no AS after FROM s)
 SELECT snapshot_id, before, after FROM g WHERE after <> before + 1""")
def _(spark, d):
    return quality.position_gaps(_t(spark, d, "questions").withColumn("position_no", F.expr(_GAPPED)), by=["snapshot_id"], position="position_no")


def _broken(n: int, new: str, old: str) -> str:
    return f"CASE WHEN position_no % 11 = {n} THEN {new} ELSE {old} END"


#: The supplied questions break no rule; each of these changes breaks one or two in an eleventh of the rows.
_BROKEN = {
    "text": _broken(0, "''", "text"), "multiple": _broken(4, "NOT multiple", "multiple"), "position_no": _broken(6, "-position_no", "position_no"), "id_status": _broken(7, "'unresolved'", "id_status"),
}


@_query("question_violations", f"""WITH q AS (SELECT snapshot_id, stable_key, position_no AS place, official_id, question_type, {_BROKEN["text"]} AS text, {_broken(0, "[]", "resources")} AS resources, {_broken(5, "answers[1:1]", "answers")} AS answers,
   CASE position_no % 11 WHEN 1 THEN list_concat(correct_answer_ids, correct_answer_ids) WHEN 2 THEN ['zz'] WHEN 3 THEN [] ELSE correct_answer_ids END AS given, {_BROKEN["multiple"]} AS multiple, {_BROKEN["position_no"]} AS position_no, {_BROKEN["id_status"]} AS id_status FROM questions),
 x AS (SELECT *, list_transform(answers, lambda a: a.id) AS ids, list_transform(list_filter(answers, lambda a: a.correct), lambda a: a.id) AS rights FROM q),
 b AS (SELECT snapshot_id, stable_key, place, unnest([CASE WHEN (length(text) > 0 OR len(resources) > 0) IS NOT TRUE THEN 'content' END,
  CASE WHEN (CASE WHEN official_id IS NULL THEN position_no = 1 AND id_status = 'unresolved_initial_html' ELSE id_status = 'official' END) IS NOT TRUE THEN 'official_id' END,
  CASE WHEN (len(list_distinct(ids)) = len(ids)) IS NOT TRUE THEN 'answer_ids_unique' END, CASE WHEN (len(answers) >= 2) IS NOT TRUE THEN 'at_least_two_answers' END,
  CASE WHEN (len(list_distinct(given)) = len(given)) IS NOT TRUE THEN 'correct_ids_unique' END, CASE WHEN (len(list_filter(given, lambda g: NOT list_contains(ids, g))) = 0) IS NOT TRUE THEN 'correct_ids_known' END,
  CASE WHEN (list_sort(rights) = list_sort(given)) IS NOT TRUE THEN 'correct_flags' END, CASE WHEN (multiple = (question_type = 'multiple')) IS NOT TRUE THEN 'multiple_flag' END,
  CASE WHEN (CASE WHEN question_type = 'multiple' THEN len(given) >= 2 ELSE len(given) = 1 END) IS NOT TRUE THEN 'correct_count' END, CASE WHEN (position_no > 0) IS NOT TRUE THEN 'position' END]) AS rule FROM x)
 SELECT snapshot_id, coalesce(stable_key, '') AS stable_key, place, rule, count(*) AS n FROM b WHERE rule IS NOT NULL GROUP BY 1, 2, 3, 4""")
def _(spark, d):
    q = _t(spark, d, "questions").withColumn("row_key", F.to_json(F.struct("snapshot_id", F.coalesce("stable_key", F.lit("")).alias("stable_key"), F.col("position_no").alias("place"))))
    r = F.pmod("position_no", F.lit(11))
    given = F.when(r == 1, F.concat("correct_answer_ids", "correct_answer_ids")).when(r == 2, F.array(F.lit("zz"))).when(r == 3, F.array().cast("array<string>")).otherwise(F.col("correct_answer_ids"))
    resources = F.when(r == 0, F.filter("resources", lambda x: F.lit(False))).otherwise(F.col("resources"))
    q = q.withColumns({**{k: F.expr(v) for k, v in _BROKEN.items()}, "resources": resources, "answers": F.when(r == 5, F.slice("answers", 1, 1)).otherwise(F.col("answers")), "correct_answer_ids": given})
    broken = quality.violations(q, id="row_key", rules=quality.question_rules()).groupBy("row_key", "rule").agg(F.count("*").alias("n"))
    return broken.select(F.from_json("row_key", "snapshot_id string, stable_key string, place int").alias("k"), "rule", "n").select("k.*", "rule", "n")


@_query("published_violations", """WITH p AS (SELECT reference_id, document_id, source_pdf_sha256, order_no, CASE WHEN page % 5 = 0 THEN 0 ELSE page END AS page, memberships, correctness_known, published_answers, published_correct_answer,
   CASE page % 5 WHEN 1 THEN CASE WHEN published_correct_answer_indexes IS NOT NULL THEN list_concat(published_correct_answer_indexes, published_correct_answer_indexes) END WHEN 2 THEN list_transform(published_correct_answer_indexes, lambda i: i + 1) ELSE published_correct_answer_indexes END AS idx FROM published_questions)
 SELECT reference_id, rule, count(*) AS n FROM (SELECT reference_id, unnest([CASE WHEN (document_id = source_pdf_sha256) IS NOT TRUE THEN 'document_is_source' END, CASE WHEN (reference_id = document_id || ':' || order_no) IS NOT TRUE THEN 'reference_id' END,
  CASE WHEN (page >= 1 AND order_no >= 1) IS NOT TRUE THEN 'positions' END, CASE WHEN (len(memberships) >= 1) IS NOT TRUE THEN 'memberships' END, CASE WHEN (correctness_known = (idx IS NOT NULL)) IS NOT TRUE THEN 'known_has_indexes' END,
  CASE WHEN idx IS NOT NULL AND (len(idx) > 0 AND len(list_distinct(idx)) = len(idx) AND len(list_filter(idx, lambda i: i >= 0 AND i < len(published_answers))) = len(idx)) IS NOT TRUE THEN 'indexes' END,
  CASE WHEN len(idx) = 1 AND (published_answers[idx[1] + 1] = published_correct_answer) IS NOT TRUE THEN 'single_index' END]) AS rule FROM p) WHERE rule IS NOT NULL GROUP BY 1, 2""")
def _(spark, d):
    # pages and positions of correct answers are changed in a part of the rows, which break few rules as supplied
    r, at = F.pmod("page", F.lit(5)), F.col("published_correct_answer_indexes")
    p = _t(spark, d, "published_questions").withColumns({"published_correct_answer_indexes": F.when(r == 1, F.concat(at, at)).when(r == 2, F.transform(at, lambda i: i + 1)).otherwise(at), "page": F.when(r == 0, 0).otherwise(F.col("page"))})
    return quality.violations(p, id="reference_id", rules=quality.published_rules()).groupBy("reference_id", "rule").agg(F.count("*").alias("n"))


#: Each fifth of the urls is spoilt in its way, since the supplied ones are sound.
_SPOILT = "CASE bytes % 7 WHEN 0 THEN replace(url, 'https', 'http') WHEN 1 THEN concat(url, '#top') WHEN 2 THEN replace(url, '/testing_bucket/', '/testing_bucket/../') WHEN 3 THEN replace(url, ':85', '') WHEN 4 THEN concat(url, '%2e%2e') ELSE url END"


@_query("url_violations", f"""WITH m AS (SELECT {_SPOILT} AS url FROM media_records WHERE url IS NOT NULL) SELECT url, count(*) AS n FROM m
 WHERE NOT regexp_matches(url, '^https://media\\.simulator\\.example:85/testing_bucket/[^#\\\\]+$') OR regexp_matches(url, '(^|/)\\.{{1,2}}(/|$)') OR regexp_matches(url, '(?i)/(\\.|%2e){{1,2}}(/|$)') GROUP BY url""")
def _(spark, d):
    ok = quality.url_rule(F.col("url"), host="media.simulator.example", port=85, prefix="/testing_bucket/")
    m = _t(spark, d, "media_records").where("url is not null").select(F.expr(_SPOILT).alias("url"))
    return m.where(~ok).groupBy("url").agg(F.count("*").alias("n"))


@_query("uuid_ids", "SELECT count(*) AS rows, count(*) FILTER (regexp_matches(official_id, '^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$')) AS valid FROM questions")
def _(spark, d):
    return _t(spark, d, "questions").agg(F.count("*").alias("rows"), F.count_if(is_uuid(F.col("official_id"))).alias("valid"))


@_query("duplicate_profile", """WITH s AS (SELECT count(*) AS n FROM published_questions GROUP BY normalized_question_text)
 SELECT sum(n)::BIGINT AS rows, count(*) AS "unique", count(*) FILTER (n > 1) AS duplicate_groups, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS in_groups, coalesce(sum(n - 1) FILTER (n > 1), 0)::BIGINT AS excess FROM s""")
def _(spark, d):
    return quality.duplicate_profile(_t(spark, d, "published_questions"), key=["normalized_question_text"])


@_query("repeated_ids", "SELECT official_id, count(*) AS n FROM questions WHERE official_id IS NOT NULL GROUP BY official_id HAVING count(*) > 1")
def _(spark, d):
    return quality.repeated_keys(_t(spark, d, "questions"), key="official_id")


@_query("referential_integrity", """WITH p AS (SELECT reference_id, CASE WHEN page % 9 = 0 THEN 'gone:' || document_id ELSE document_id END AS document_id FROM published_questions)
 SELECT p.document_id, count(*) AS n FROM p WHERE p.document_id IS NOT NULL AND p.document_id NOT IN (SELECT document_id FROM memberships WHERE document_id IS NOT NULL) GROUP BY 1""")
def _(spark, d):
    # documents of some pages are renamed: as supplied none is missing
    child = _t(spark, d, "published_questions").withColumn("document_id", F.expr("CASE WHEN page % 9 = 0 THEN concat('gone:', document_id) ELSE document_id END"))
    return quality.orphans(child, _t(spark, d, "memberships"), on={"document_id": "document_id"}).groupBy("document_id").agg(F.count("*").alias("n"))


# ---- media, store, manifest


@_query("latest_versions", """SELECT url, run_id, lower(sha256) AS sha256 FROM (SELECT url, run_id, sha256, row_number() OVER (PARTITION BY url ORDER BY run_id DESC NULLS LAST, lower(sha256) DESC NULLS LAST) AS rn FROM media_records WHERE url IS NOT NULL) WHERE rn = 1""")
def _(spark, d):
    m = _t(spark, d, "media_records").select("url", "run_id", F.lower("sha256").alias("sha256"))
    return store.latest_versions(m, key="url", at="run_id")


@_query("distinct_objects", "SELECT count(*) AS objects, sum(b)::BIGINT AS bytes FROM (SELECT lower(sha256), max(bytes) AS b FROM media_records WHERE sha256 IS NOT NULL GROUP BY 1)")
def _(spark, d):
    return store.distinct_bytes(_t(spark, d, "media_records"))


@_query("resource_uses", """WITH r AS (SELECT stable_key, unnest(list_concat(coalesce(resources, []), flatten(list_transform(answers, lambda a: a.resources)))).url AS url FROM questions WHERE stable_key IS NOT NULL)
 SELECT url, count(*) AS uses, count(DISTINCT stable_key) AS questions, bool_or(url IN (SELECT url FROM media_records WHERE url IS NOT NULL)) AS known FROM r GROUP BY url""")
def _(spark, d):
    uses = compare.all_resources(_t(spark, d, "questions").where("stable_key is not null"), id="stable_key")
    media = _t(spark, d, "media_records").where("url is not null").select("url").distinct().withColumn("known", F.lit(True))
    return uses.groupBy("url").agg(F.count("*").alias("uses"), F.countDistinct("stable_key").alias("questions")).join(media, "url", "left").withColumn("known", F.coalesce("known", F.lit(False)))


@_query("link_occurrences", "SELECT pdf_url, min_by(membership_id, membership_id) AS membership_id, count(*) AS occurrences FROM memberships GROUP BY pdf_url")
def _(spark, d):
    return rollups.first_links(_t(spark, d, "memberships").select("pdf_url", "membership_id"), key="pdf_url", order="membership_id")


@_query("membership_ids", "SELECT membership_id, 'm:' || substr(sha256(coalesce(landing_page_url, '') || chr(10) || coalesce(pdf_url, '') || chr(10) || coalesce(link_text, '')), 1, 24) AS derived FROM memberships")
def _(spark, d):
    return _t(spark, d, "memberships").select("membership_id", short_id("m:", F.col("landing_page_url"), F.col("pdf_url"), F.col("link_text")).alias("derived"))


@_query("topic_codes", "SELECT membership_id, nullif(regexp_extract(trim(link_text), '^(\\d+(?:\\.\\d+)+)\\.?\\s*(\\D.+)', 1), '') AS code, nullif(trim(regexp_extract(trim(link_text), '^(\\d+(?:\\.\\d+)+)\\.?\\s*(\\D.+)', 2)), '') AS title FROM memberships")
def _(spark, d):
    code, title = tx.topic_of(F.col("link_text"))
    return _t(spark, d, "memberships").select("membership_id", code.alias("code"), title.alias("title"))


# ---- roll-ups


@_query("membership_rollup", """WITH m AS (SELECT document_id AS id, unnest(memberships) AS m FROM published_questions), x AS (SELECT DISTINCT id, m.dimension AS dimension, m.category AS category, m.topic_title AS topic, m.membership_id AS link FROM m)
 SELECT id, dimension, array_to_string(list_sort(list_distinct(list(category))), '|') AS categories, array_to_string(list_sort(list_distinct(list(topic))), '|') AS topics, count(DISTINCT link) AS links FROM x GROUP BY id, dimension""")
def _(spark, d):
    p = _t(spark, d, "published_questions").select(F.col("document_id").alias("id"), "memberships").distinct()
    return rollups.membership_rollup(p, id="id", memberships="memberships").select("id", "dimension", F.array_join("categories", "|").alias("categories"), F.array_join("topics", "|").alias("topics"), "links")


@_query("taxonomy_tree", """WITH p AS (SELECT string_split(topic_code, '.') AS p FROM documents WHERE topic_code IS NOT NULL), n AS (SELECT p, unnest(range(1, len(p) + 1)) AS depth FROM p)
 SELECT array_to_string(p[1:depth], '.') AS node, CASE WHEN depth > 1 THEN array_to_string(p[1:depth - 1], '.') END AS parent, depth::INT AS depth, count(*) AS rows FROM n GROUP BY 1, 2, 3""")
def _(spark, d):
    return rollups.code_tree(_t(spark, d, "documents"), code="topic_code")


_TITLE_KEY = f"coalesce(nullif({duck.topic("coalesce(topic_title, '')")}, ''), '[untitled section] ' || {duck.topic("coalesce(topic_code, '')")})"


@_query("canonical_titles", f"""WITH n AS (SELECT {_TITLE_KEY} AS title_key, coalesce(topic_title, '') AS title, count(*) AS n FROM memberships GROUP BY 1, 2)
 SELECT 'topic_' || substr(sha256(title_key), 1, 16) AS topic_id, title_key, arg_min(title, (-n, title)) AS title, count(*) AS spellings, sum(n)::BIGINT AS rows FROM n GROUP BY title_key""")
def _(spark, d):
    m = _t(spark, d, "memberships").select(F.coalesce("topic_title", F.lit("")).alias("title"), tx.topic_text(F.coalesce("topic_title", F.lit(""))).alias("_t"), tx.topic_text(F.coalesce("topic_code", F.lit(""))).alias("_c"))
    return rollups.canonical_titles(m, title="title", key=F.when(F.col("_t") != "", F.col("_t")).otherwise(F.concat(F.lit("[untitled section] "), F.col("_c"))))


@_query("usable_sets", """WITH l AS (SELECT DISTINCT stable_key AS key FROM questions WHERE stable_key IS NOT NULL AND question_type = 'single'), r AS (SELECT DISTINCT stable_key AS key FROM questions WHERE stable_key IS NOT NULL AND len(resources) > 0),
 u AS (SELECT DISTINCT stable_key AS key FROM questions WHERE stable_key IS NOT NULL)
 SELECT CASE WHEN l.key IS NOT NULL AND r.key IS NOT NULL THEN 'both' WHEN l.key IS NOT NULL THEN 'only_left' WHEN r.key IS NOT NULL THEN 'only_right' ELSE 'neither' END AS relation, count(*) AS n FROM u LEFT JOIN l ON u.key = l.key LEFT JOIN r ON u.key = r.key GROUP BY 1""")
def _(spark, d):
    q = _t(spark, d, "questions")
    return compare.set_relation(q.where("question_type = 'single'"), q.where("size(resources) > 0"), key="stable_key", universe=q).groupBy("relation").agg(F.count("*").alias("n"))


# ---- text profiles and evidence


@_query("comparison_texts", f"""SELECT reference_id, {duck.folded("question_text")} AS folded, {duck.compared("question_text")} AS compared, array_to_string({duck.variants("raw_question_text")}, '|') AS variants, {duck.words("question_text")} AS words, {duck.cased("question_text")} AS cased,
 {duck.topic("question_text")} AS topic, {duck.squeeze("nfc_normalize(question_text)")} AS nfc FROM published_questions""")
def _(spark, d):
    p = _t(spark, d, "published_questions")
    return p.select("reference_id", tx.folded_text(F.col("question_text")).alias("folded"), tx.comparison_text(F.col("question_text")).alias("compared"), F.array_join(tx.text_variants(F.col("raw_question_text")), "|").alias("variants"), tx.words_text(F.col("question_text")).alias("words"), tx.cased_text(F.col("question_text")).alias("cased"), tx.topic_text(F.col("question_text")).alias("topic"), tx.nfc_text(F.col("question_text")).alias("nfc"))


@_query("critical_tokens", f"SELECT reference_id, array_to_string({duck.critical(duck.folded('question_text'))}, '|') AS tokens, array_to_string({duck.critical(duck.compared('question_text'), tx.WIDE_LEXICON, '%°')}, '|') AS wide FROM published_questions")
def _(spark, d):
    p = _t(spark, d, "published_questions")
    return p.select("reference_id", F.array_join(tx.critical_tokens(tx.folded_text(F.col("question_text"))), "|").alias("tokens"), F.array_join(tx.wide_tokens(F.col("question_text")), "|").alias("wide"))


@_query("critical_signatures", f"WITH t AS (SELECT reference_id, {duck.topic('question_text')} AS t FROM published_questions) SELECT reference_id, array_to_string({signature_numbers('t')}, '|') AS numbers, array_to_string({signature_words('t')}, '|') AS words FROM t")
def _(spark, d):
    s = _t(spark, d, "published_questions").select("reference_id", tx.critical_signature(tx.topic_text(F.col("question_text"))).alias("s"))
    after = lambda x: F.substring_index(x, ":", -1)
    return s.select("reference_id", F.array_join(F.transform(F.filter("s", lambda x: x.startswith("number:")), after), "|").alias("numbers"), F.array_join(F.transform("s", lambda x: F.when(x.startswith("number:"), "#").otherwise(after(x))), "|").alias("words"))


@_query("picture_dependence", """SELECT reference_id, coalesce(regexp_matches(normalized_question_text, 'рисунк|иллюстрац|изображ|показан|на схем|обозначен|этих судов'), false)
 OR (coalesce(len(published_answers), 0) > 0 AND coalesce(len(list_filter(published_answers, lambda a: regexp_matches(lower(a), '^[а-яa-z0-9)()., /-]{1,12}$'))) = len(published_answers), false)) AS needs_picture FROM published_questions""")
def _(spark, d):
    p = _t(spark, d, "published_questions")
    return p.select("reference_id", tx.needs_picture(F.col("normalized_question_text"), F.transform("published_answers", F.lower)).alias("needs_picture"))


@_query("visual_evidence", """WITH e AS (SELECT vec_id, label, embedding, list_transform(embedding, lambda x: CAST(floor(x * 40) AS INT)) AS thumb, (vec_id * 2654435761) % 64 AS dhash, (vec_id % 3)::VARCHAR AS sha FROM embeddings),
 p AS (SELECT a.*, lead(thumb) OVER w AS thumb2, lead(dhash) OVER w AS dhash2, lead(sha) OVER w AS sha2, lead(vec_id) OVER w AS vec2 FROM e a WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
 v AS (SELECT vec_id, sha = sha2 AS same, list_sum(list_transform(list_zip(thumb, thumb2), lambda z: abs(z[1] - z[2])))::DOUBLE / len(thumb) AS error, bit_count(xor(dhash, dhash2))::INT AS bits, round(abs((1.0 + vec_id % 4) / (1.0 + vec2 % 4) - 1), 6) AS aspect FROM p WHERE vec2 IS NOT NULL)
 SELECT vec_id, CASE WHEN same THEN 'pixels_equal' ELSE 'visual_comparison' END AS kind, same OR (error <= 8 AND bits <= 6) AS support, same OR (error <= 2 AND bits <= 2) AS strict, CASE WHEN NOT same THEN round(error, 4) END AS error, CASE WHEN NOT same THEN bits END AS bits, CASE WHEN NOT same THEN aspect END AS aspect FROM v""")
def _(spark, d):
    look = F.struct(F.expr("CAST(vec_id % 3 AS STRING)").alias("pixel_sha256"), F.expr("CAST(1.0 + vec_id % 4 AS DOUBLE)").alias("aspect"), F.transform("embedding", lambda x: F.floor(x * 40).cast("int")).alias("thumbnail"), F.expr("(vec_id * 2654435761) % 64").alias("dhash"))
    e = _t(spark, d, "embeddings").select("vec_id", "label", look.alias("a"))
    w = Window.partitionBy("label").orderBy("vec_id")
    e = e.withColumn("b", F.lead("a").over(w)).withColumn("other", F.lead("vec_id").over(w)).where("other is not null")
    one = lambda c: F.array(F.col(c).cast("string"))
    return e.select("vec_id", sim.visual_evidence(one("vec_id"), one("other"), F.col("a"), F.col("b")).alias("v")).select("vec_id", "v.kind", "v.support", "v.strict", "v.error", "v.bits", "v.aspect")


@_query("bag_differences", """WITH s AS (SELECT stable_key, snapshot_id, list_sort(list_transform(answers, lambda a: a.text)) AS t FROM questions WHERE stable_key IS NOT NULL AND len(answers) > 0),
 x AS (SELECT stable_key, min(snapshot_id) AS lo, max(snapshot_id) AS hi FROM s GROUP BY 1 HAVING min(snapshot_id) < max(snapshot_id)),
 p AS (SELECT x.stable_key, min(a.t) AS ta, min(b.t) AS tb FROM x JOIN s a ON a.stable_key = x.stable_key AND a.snapshot_id = x.lo JOIN s b ON b.stable_key = x.stable_key AND b.snapshot_id = x.hi GROUP BY 1)
 SELECT stable_key, ta = tb AS equal, len(list_filter(list_distinct(ta), lambda v: len(list_filter(ta, lambda w: w = v)) > len(list_filter(tb, lambda w: w = v)))) AS fewer FROM p""")
def _(spark, d):
    s = _t(spark, d, "questions").where("stable_key is not null and size(answers) > 0").select("stable_key", "snapshot_id", F.array_sort(F.transform("answers", lambda a: a["text"])).alias("t"))
    x = s.groupBy("stable_key").agg(F.min(F.struct("snapshot_id", "t")).alias("a"), F.max("snapshot_id").alias("hi"))
    last = s.join(x.select("stable_key", "hi"), "stable_key").where("snapshot_id = hi").groupBy("stable_key").agg(F.min("t").alias("tb"))
    p = x.where("a.snapshot_id < hi").select("stable_key", F.col("a.t").alias("ta")).join(last, "stable_key")
    return p.select("stable_key", sim.bag_equal(F.col("ta"), F.col("tb")).alias("equal"), F.size(F.array_distinct(sim.bag_difference(F.col("ta"), F.col("tb")))).alias("fewer"))


# ---- candidate pairs and decisions


@_query("answer_bag_pairs", """WITH l AS (SELECT DISTINCT stable_key AS l, list_sort(list_transform(answers, lambda a: a.text)) AS k FROM questions WHERE stable_key IS NOT NULL AND len(answers) > 0),
 r AS (SELECT DISTINCT reference_id AS r, list_sort(published_answers) AS k FROM published_questions WHERE len(published_answers) > 0) SELECT DISTINCT l, r FROM l JOIN r USING (k)""")
def _(spark, d):
    live = _t(spark, d, "questions").where("stable_key is not null").select("stable_key", F.transform("answers", lambda a: a["text"]).alias("a"))
    return linkage.bag_pairs(live, _t(spark, d, "published_questions"), id=("stable_key", "reference_id"), bag=("a", "published_answers")).select("l", "r")


@_query("topic_consensus", """WITH e AS (SELECT source AS l, split_part(topic_code, '.', 1) AS topic, count(DISTINCT document_id) AS prefixes, count(DISTINCT doc_id) AS positions FROM documents WHERE source IS NOT NULL AND topic_code IS NOT NULL GROUP BY 1, 2),
 p AS (SELECT l, count(*) AS topics, count(*) FILTER (prefixes >= 2) AS backed, count(*) FILTER (prefixes = 1 AND positions = 1) AS lone, list(topic ORDER BY -prefixes, -positions, topic) AS t FROM e GROUP BY l)
 SELECT l, CASE WHEN topics = 1 THEN 'single' WHEN backed = 1 AND lone = topics - 1 THEN 'conflict' ELSE 'several' END AS kind, CASE WHEN topics = 1 OR backed = 1 THEN t[1] END AS "primary", array_to_string(t, '|') AS topics FROM p""")
def _(spark, d):
    x = _t(spark, d, "documents").where("source is not null and topic_code is not null").select(F.col("source").alias("l"), F.split_part("topic_code", F.lit("."), F.lit(1)).alias("topic"), "document_id", "doc_id")
    return linkage.topic_consensus(x, topic="topic", prefix="document_id", position="doc_id").select("l", "kind", "primary", F.array_join("topics", "|").alias("topics"))


_SIDE = lambda op, way: f"coalesce((SELECT list(x.topic ORDER BY x.o) FROM (SELECT a.topic, a.o FROM a WHERE a.g = t.g AND a.o {op} t.o ORDER BY a.o {way} LIMIT 2) x), [])"


@_query("order_audit", f"""WITH e AS (SELECT document_id AS g, doc_id AS o, split_part(topic_code, '.', 1) AS topic FROM documents WHERE document_id IS NOT NULL), a AS (SELECT * FROM e WHERE topic IS NOT NULL), t AS (SELECT g, o FROM e WHERE topic IS NULL),
 s AS (SELECT t.g, t.o, {_SIDE('<', 'DESC')} AS b, {_SIDE('>', 'ASC')} AS f FROM t), u AS (SELECT *, len(b) = 2 AND len(list_distinct(b)) = 1 AS sb, len(f) = 2 AND len(list_distinct(f)) = 1 AS sf FROM s)
 SELECT g AS document_id, o AS doc_id, array_to_string(b, ',') AS before, array_to_string(f, ',') AS after, sb AS same_before, sf AS same_after, sb AND sf AND b[1] = f[1] AS same_both, sb AND sf AND b[1] <> f[1] AS transition FROM u""")
def _(spark, d):
    x = _t(spark, d, "documents").where("document_id is not null").select("document_id", "doc_id", F.split_part("topic_code", F.lit("."), F.lit(1)).alias("topic"), F.when(F.col("topic_code").isNull(), "unmatched").otherwise("exact").alias("tier"))
    got = rollups.order_audit(x, by=["document_id"], order="doc_id", topic="topic", tier="tier", anchors=["exact", "strong"], targets=["unmatched"], k=2)
    return got.withColumns({"before": F.array_join("before", ","), "after": F.array_join("after", ",")})


# ---- layout-like operators


@_query("heading_asof", """SELECT e.event_id, coalesce((SELECT max(h.event_id) FROM events h WHERE h.user_id = e.user_id AND h.event_type = 'signup' AND h.ts < e.ts), -1) AS heading FROM events e WHERE e.event_type = 'purchase'""")
def _(spark, d):
    e = _t(spark, d, "events")
    heads = e.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("heading"))
    return layout.preceding(e.where("event_type = 'purchase'").select("user_id", "ts", "event_id"), heads, by=["user_id"], order=["ts"], carry=["heading"]).select("event_id", F.coalesce("heading", F.lit(-1).cast("bigint")).alias("heading"))


@_query("row_islands", """SELECT user_id, island, count(*) AS n FROM (SELECT user_id, sum(CASE WHEN event_type = 'login' OR event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS island FROM events) GROUP BY 1, 2""")
def _(spark, d):
    return layout.islands(_t(spark, d, "events"), by=["user_id"], order=["ts", "event_id"], starts="event_type in ('login', 'signup')").groupBy("user_id", "island").agg(F.count("*").alias("n"))


@_query("value_runs", """WITH s AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events), f AS (SELECT * FROM s WHERE event_type IS DISTINCT FROM b)
 SELECT user_id, event_type, event_id AS run_start, coalesce(lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id), -1) AS run_end FROM f""")
def _(spark, d):
    from kedge.operators.runs import value_runs

    return value_runs(_t(spark, d, "events"), keys=["user_id"], order=["event_id"], value="event_type").withColumn("run_end", F.coalesce("run_end", F.lit(-1).cast("bigint")))


@_query("adjacent_bands", """WITH s AS (SELECT DISTINCT document_id, page, round(unnest(row_refs).top) AS top FROM published_questions), b AS (SELECT *, lead(top) OVER (PARTITION BY document_id, page ORDER BY top) AS bottom FROM s)
 SELECT document_id, page, top, bottom, row_number() OVER (PARTITION BY document_id, page ORDER BY top)::INT AS nth FROM b WHERE bottom - top >= 18""")
def _(spark, d):
    rules = _t(spark, d, "published_questions").select("document_id", "page", F.explode("row_refs").alias("r")).select("document_id", "page", F.col("r.top").alias("y"))
    return layout.adjacent_bands(rules, page=["document_id", "page"], y="y", least=18.0)


@_query("cell_assignment", """WITH c AS (SELECT document_id, page, reference_id, order_no, unnest(row_refs) AS r FROM published_questions), g AS (SELECT DISTINCT document_id, page, reference_id AS cell, r.top AS top, r.bottom AS bottom, (order_no % 3)::DOUBLE AS lft FROM c WHERE r.page = page),
 i AS (SELECT DISTINCT document_id, page, reference_id AS item, (r.top + r.bottom) / 2 AS y, order_no % 4 + 0.5 AS x FROM c WHERE r.page = page) SELECT i.item, g.cell, i.y, i.x::DOUBLE AS x FROM i JOIN g ON i.document_id = g.document_id AND i.page = g.page AND i.y >= g.top - 1 AND i.y < g.bottom AND i.x >= g.lft AND i.x < g.lft + 1.25""")
def _(spark, d):
    c = _t(spark, d, "published_questions").select("document_id", "page", "reference_id", "order_no", F.explode("row_refs").alias("r")).where("r.page = page")
    left = (F.col("order_no") % 3).cast("double")
    cells = c.select("document_id", "page", F.col("reference_id").alias("cell"), F.col("r.top").alias("top"), F.col("r.bottom").alias("bottom"), left.alias("left"), (left + 1.25).alias("right")).distinct()
    items = c.select("document_id", "page", F.col("reference_id").alias("item"), ((F.col("r.top") + F.col("r.bottom")) / 2).alias("y"), (F.col("order_no") % 4 + 0.5).cast("double").alias("x")).distinct()
    return layout.in_cells(items, cells, page=["document_id", "page"], x="x", y="y", slack=1.0).select("item", "cell", "y", "x")


#: Rows a page, height of a row, and words of a line when published questions are set as pages.
_ROWS, _HEIGHT, _WORDS = 4, 130, 6


@_query("parsed_questions", f"""WITH p AS (SELECT DISTINCT ON (reference_id) reference_id, document_id, order_no, {duck.squeeze("question_text")} AS q, coalesce(published_answers, []) AS a, coalesce(published_correct_answer_indexes, []) AS at0 FROM published_questions ORDER BY reference_id),
 n AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY order_no, reference_id) AS r, list_transform(a, lambda x: {duck.squeeze("x")}) AS texts FROM p), m AS (SELECT *, CASE WHEN len(at0) = 1 AND at0[1] < len(a) THEN at0[1] END AS known FROM n)
 SELECT document_id AS document, r::INT AS order_no, q AS question_text, array_to_string(texts, '|') AS answers, known, CASE WHEN len(texts) = 1 THEN 'published_answer_only' WHEN len(texts) = 4 AND known IS NOT NULL THEN 'full_options' ELSE 'unknown' END AS structure FROM m""")
def _(spark, d):
    # the published rows set as table pages, and read back from the geometry
    p = _t(spark, d, "published_questions").dropDuplicates(["reference_id"])
    w = Window.partitionBy("document_id").orderBy("order_no", "reference_id")
    p = p.select(F.col("document_id").alias("document"), tx.squeeze(F.col("question_text")).alias("q"), F.coalesce("published_answers", F.array().cast("array<string>")).alias("a"), F.coalesce("published_correct_answer_indexes", F.array().cast("array<int>")).alias("at"), (F.row_number().over(w) - 1).alias("r"))
    p = scratch.table(p.withColumns({"page": (F.floor(F.col("r") / _ROWS) + 1).cast("int"), "top": (50.0 + F.pmod("r", F.lit(_ROWS)) * _HEIGHT)}), "set")
    words = F.split("q", " ")
    def span(x: float, down: Column, text: Column, bold: Column) -> Column:
        return F.struct(F.lit(x).alias("x0"), down.cast("double").alias("y0"), F.lit(x + 10).alias("x1"), (down + 10).cast("double").alias("y1"), text.alias("text"), bold.alias("bold"))

    no = F.lit(False)
    question = [span(90.0, F.col("top") + 5, F.array_join(F.slice(words, 1, _WORDS), " "), no), span(90.0, F.col("top") + 17, F.array_join(F.slice(words, F.lit(_WORDS + 1), F.greatest(F.size(words) - _WORDS, F.lit(0))), " "), no)]
    answers = F.transform("a", lambda t, i: span(510.0, F.col("top") + 5 + 12 * i, F.concat(F.lit("• "), t), F.array_contains("at", i)))
    spans = p.select("document", "page", F.explode(F.concat(F.array(span(40.0, F.col("top") + 5, F.concat((F.col("r") + 1).cast("string"), F.lit(".")), no), *question), answers)).alias("s")).select("document", "page", "s.*")
    xs = (30.0, 80.0, 300.0, 500.0, 800.0)
    box = lambda x0, y0, x1, y1: F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))
    across = [box(F.lit(xs[0]), y, F.lit(xs[1]), y + 0.5) for y in (F.col("top"), F.col("top") + _HEIGHT)]
    down = [box(F.lit(x), F.col("top"), F.lit(x + 0.5), F.col("top") + _HEIGHT) for x in xs]
    drawings = p.select("document", "page", F.explode(F.array(*across, *down)).alias("b")).select("document", "page", "b.*").distinct()
    records, _ = pages.numbered_questions(spans, drawings, legend=p.select("document", F.lit(True).alias("legend")).distinct())
    return records.select("document", "order_no", "question_text", F.array_join("published_answers", "|").alias("answers"), F.get("published_correct_answer_indexes", F.lit(0)).alias("known"), F.col("answer_structure").alias("structure"))


# ---- metrics of parsed corpora and of crosswalks


@_query("parse_metrics", """WITH p AS (SELECT DISTINCT ON (reference_id) * FROM published_questions ORDER BY reference_id), m AS (SELECT normalized_question_text AS t, x.category AS c, x.dimension AS d, x.topic_code AS tc FROM (SELECT normalized_question_text, unnest(memberships) AS x FROM p)),
 g AS (SELECT normalized_question_text AS t, count(*) AS n FROM p GROUP BY 1), k AS (SELECT t, count(DISTINCT c) AS cs, count(DISTINCT (d, c, coalesce(tc, ''))) AS ts FROM m GROUP BY 1),
 e AS (SELECT count(*) AS n FROM p GROUP BY question_text, published_answers, list_sort(list_transform(coalesce(illustration_refs, []), lambda r: r.sha256)))
 SELECT 'questions' AS metric, (SELECT count(*) FROM p) AS value UNION ALL SELECT 'documents', (SELECT count(DISTINCT document_id) FROM p) UNION ALL SELECT 'unique_texts', (SELECT count(*) FROM g) UNION ALL SELECT 'repeated_text_groups', (SELECT count(*) FROM g WHERE n > 1)
 UNION ALL SELECT 'excess_texts', (SELECT sum(n - 1) FROM g)::BIGINT UNION ALL SELECT 'texts_in_several_categories', (SELECT count(*) FROM k WHERE cs > 1) UNION ALL SELECT 'texts_in_several_topics', (SELECT count(*) FROM k WHERE ts > 1)
 UNION ALL SELECT 'exact_duplicates', (SELECT sum(n - 1) FROM e)::BIGINT UNION ALL SELECT 'unique_pictures', (SELECT count(DISTINCT x.sha256) FROM (SELECT unnest(illustration_refs) AS x FROM p))
 UNION ALL SELECT 'correctness_known', (SELECT count(*) FROM p WHERE correctness_known) UNION ALL SELECT 'structure:' || answer_structure, count(*) FROM p GROUP BY answer_structure UNION ALL SELECT 'issue:' || i, count(*) FROM (SELECT unnest(issues) AS i FROM p) GROUP BY i
 UNION ALL SELECT 'answers:' || coalesce(len(published_answers), 0), count(*) FROM p GROUP BY coalesce(len(published_answers), 0)""")
def _(spark, d):
    p = _t(spark, d, "published_questions").dropDuplicates(["reference_id"])
    return metrics.parse_metrics(p)


@_query("inventory_metrics", """SELECT 'memberships' AS metric, count(*)::BIGINT AS value FROM memberships UNION ALL SELECT 'urls', count(DISTINCT pdf_url) FROM memberships UNION ALL SELECT 'documents', count(DISTINCT source_pdf_sha256) FROM memberships
 UNION ALL SELECT 'memberships_of_repeated_urls', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM memberships GROUP BY pdf_url HAVING count(*) > 1) UNION ALL SELECT 'documents_of_several_urls', count(*) FROM (SELECT 1 FROM memberships GROUP BY source_pdf_sha256 HAVING count(DISTINCT pdf_url) > 1)
 UNION ALL SELECT 'repeated_links', coalesce(sum(link_occurrences - 1), 0)::BIGINT FROM memberships UNION ALL SELECT 'category:' || dimension || '/' || category, count(*) FROM memberships GROUP BY dimension, category""")
def _(spark, d):
    return metrics.inventory_metrics(_t(spark, d, "memberships"))


# ---- streaming


@_query("streaming_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    root = f"{scratch.folder(spark)}/stream-{uuid.uuid4().hex}"
    source = _t(spark, d, "events")
    stream = ingest.file_stream(spark, f"{d}/events.parquet", source.schema).groupBy("event_type").agg(F.count("*").alias("n"))
    q = stream.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def queries() -> dict:
    return dict(_Q)


def sql() -> dict[str, str]:
    return dict(_S)

"""Every registered query of the advert engine, with its oracle."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vacantia.functions import rules as R
from vacantia.functions import skills as S
from vacantia.functions import text as T
from vacantia.operators import board, dedupe, enrich, extract, history, postings, quality, screen, search
from vacantia.sources import cards, feeds, listing, quarantine, sinks
from vacantia.streaming import live_board

from .job_ads import TODAY, adverts
from .oracles import BOARD, LIVE_BOARD, NORM, SKILLS, q
from .pipeline import labelled, materialised, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


_made: dict[tuple[str, str], DataFrame] = {}


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled stage, made once for each session and input, as the daily run makes it once a day."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _made:
        _made[key] = materialised(labelled(adverts(spark, sf)))
    return _made[key]


def _screened(spark: SparkSession, sf: str) -> DataFrame:
    return screen.screened(_labelled(spark, sf))


def query(oracle: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\\([-+*_`#\[\]{}()!.>|~])', '\1', 'g'), '\s+', ' ', 'g')) AS cleaned FROM documents")
def clean_text_documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@query(q("SELECT doc_id, kt AS title_key, kc AS company_key, kp AS city_key, CASE WHEN length(fp) >= 200 THEN fp ELSE '' END AS fingerprint FROM n"))
def normalise_keys(spark, sf):
    key = dedupe.duplicate_key()
    return adverts(spark, sf).select("doc_id", key["t"].alias("title_key"), key["c"].alias("company_key"), key["p"].alias("city_key"), T.fingerprint(F.col("description_snippet")).alias("fingerprint"))


@query(q("SELECT _seq, doc_id, job_url FROM d1"))
def dedupe_url(spark, sf):
    return dedupe.first_by_url(adverts(spark, sf)).select("_seq", "doc_id", "job_url")


@query(q("SELECT _seq, doc_id, CAST(dup AS BIGINT) AS duplicate_count FROM d2"))
def dedupe_key_survivors(spark, sf):
    return dedupe.by_key(dedupe.first_by_url(adverts(spark, sf))).select("_seq", "doc_id", "duplicate_count")


@query(q("SELECT _seq, doc_id, CAST(duplicate_count AS BIGINT) AS duplicate_count FROM d3"))
def dedupe_advert_text(spark, sf):
    return dedupe.deduplicate(adverts(spark, sf)).select("_seq", "doc_id", "duplicate_count")


@query(q("SELECT _seq, doc_id, CAST(duplicate_count AS BIGINT) AS duplicate_count FROM d3"))
def dedupe_days(spark, sf):
    """Three days fed one behind the other, each against what is kept of those before: as one run over all of them."""
    ads = adverts(spark, sf)
    last = ads.agg(F.max("_seq")).first()[0] or 0
    kept = None
    for day in range(3):
        kept = history.fed(kept, ads.where(f"_seq > {last * day // 3 if day else -1} and _seq <= {last * (day + 1) // 3}"))
        kept = history.History(*map(materialised, kept))
    return dedupe.whole_rows(ads, history.left(kept)).select("_seq", "doc_id", "duplicate_count")


@query(q("SELECT a AS input, a - b AS by_url, b - c AS by_title_company_city, c - d AS by_same_advert_text, d AS output, a - d AS removed FROM (SELECT (SELECT count(*) FROM n) AS a, (SELECT count(*) FROM d1) AS b, (SELECT count(*) FROM d2) AS c, (SELECT count(*) FROM d3) AS d)"))
def dedupe_counts(spark, sf):
    return dedupe.counts(adverts(spark, sf))


@query("SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def documents_posted_again(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("h")


@query(q("SELECT doc_id, CAST(years AS INT) AS experience_years, years_source FROM lab"))
def years_extracted(spark, sf):
    return extract.with_years(dedupe.deduplicate(adverts(spark, sf))).select("doc_id", "experience_years", "years_source")


@query(q("SELECT doc_id, experience_years AS raw, CAST(CASE experience_years WHEN '3' THEN 3 WHEN '3-5' THEN 3 WHEN '2 years' THEN 2 END AS INT) AS coerced FROM n"))
def years_coerced(spark, sf):
    return adverts(spark, sf).select("doc_id", F.col("experience_years").alias("raw"), extract.coerce_years(F.col("experience_years")).alias("coerced"))


@query(q("SELECT doc_id, tl AS level, tw AS evidence FROM lab"))
def level_title(spark, sf):
    found = extract.first_rule_match(F.col("title"), R.TITLE_LEVELS)
    return dedupe.deduplicate(adverts(spark, sf)).select("doc_id", F.coalesce(found["label"], F.lit("")).alias("level"), F.coalesce(found["evidence"], F.lit("")).alias("evidence"))


@query("SELECT o_orderkey, CAST(o_orderkey % 12 AS INT) AS years, CASE WHEN o_orderkey % 12 = 0 THEN 'entry level' WHEN o_orderkey % 12 < 3 THEN 'junior' WHEN o_orderkey % 12 < 5 THEN 'mid' WHEN o_orderkey % 12 < 8 THEN 'senior' ELSE 'lead' END AS level FROM orders")
def level_years(spark, sf):
    years = (F.col("o_orderkey") % 12).cast("int")
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", years.alias("years"), extract.level_from_years(years).alias("level"))


@query(q("SELECT _seq, doc_id, title, must_have_skills, CAST(years AS INT) AS experience_years, job_level, role_type FROM v"))
def labelled_stage(spark, sf):
    """What the other queries on labels read; made here anew, so that its time is its own."""
    _made.pop((spark.sparkContext.applicationId, sf), None)
    return _labelled(spark, sf).select("_seq", "doc_id", "title", "must_have_skills", "experience_years", "job_level", "role_type")


@query(q("SELECT doc_id, ai_job_level, job_level, level_source, level_evidence, level_confidence FROM lab"))
def level_final(spark, sf):
    return _labelled(spark, sf).select("doc_id", "ai_job_level", "job_level", "level_source", "level_evidence", "level_confidence")


@query(q("SELECT job_level AS value, count(*) AS n FROM lab GROUP BY ALL"))
def level_counts(spark, sf):
    return quality.level_counts(_labelled(spark, sf))


@query(q("SELECT doc_id, role_type, role_source FROM lab"))
def role_classified(spark, sf):
    return extract.with_roles(dedupe.deduplicate(adverts(spark, sf))).select("doc_id", "role_type", "role_source")


@query(q("SELECT CASE WHEN role_type = '' THEN '(none)' ELSE role_type END AS value, count(*) AS n FROM lab GROUP BY ALL"))
def role_counts(spark, sf):
    return quality.role_counts(_labelled(spark, sf))


@query(q("SELECT doc_id, atl AS by_title, al AS by_label FROM v"))
def accept_rule(spark, sf):
    return dedupe.deduplicate(adverts(spark, sf)).select("doc_id", extract.accepted_rule(F.col("title")).alias("by_title"), extract.accepted_rule(F.col("primary_role")).alias("by_label"))


@query(q("SELECT doc_id, b AS blocked FROM v"))
def blocked_title(spark, sf):
    return dedupe.deduplicate(adverts(spark, sf)).select("doc_id", extract.blocked_title(F.col("title")).alias("blocked"))


@query(q("SELECT doc_id, kept, tier, excluded_stage, excluded_rule, needs_review, CASE WHEN excluded_stage IN ('F1 non-tech', 'scope off track') THEN reason ELSE '' END AS early_reason FROM fin"))
def screen_all(spark, sf):
    early = F.when(F.col("excluded_stage").isin(R.STAGE_NON_TECH, R.STAGE_OFF_TRACK), F.col("excluded_reason")).otherwise("")
    return _screened(spark, sf).select("doc_id", "kept", "tier", "excluded_stage", "excluded_rule", "needs_review", early.alias("early_reason"))


@query(q("SELECT count(*) AS input, count(*) FILTER (kept) AS kept, count(*) FILTER (excluded_stage = 'F1 non-tech') AS non_tech, count(*) FILTER (excluded_stage = 'scope off track') AS off_track, count(*) FILTER (excluded_stage = 'F4 above cohort') AS above_cohort, count(*) FILTER (needs_review) AS to_review FROM fin"))
def screen_counts(spark, sf):
    return screen.screen_counts(_screened(spark, sf))


@query(q("SELECT excluded_stage AS value, count(*) AS n FROM fin WHERE NOT kept GROUP BY ALL"))
def excluded_by_stage(spark, sf):
    return quality.stage_counts(_screened(spark, sf).where("not kept"))


@query(q("SELECT tier, job_level, count(*) AS n FROM fin WHERE kept GROUP BY ALL"))
def tier_counts(spark, sf):
    return _screened(spark, sf).where("kept").groupBy("tier", "job_level").agg(F.count(F.lit(1)).alias("n"))


@query(q("SELECT doc_id, must_have_skills, CASE WHEN must_have_skills <> '' THEN 'keyword' ELSE '' END AS skills_source, len(skills) < 3 AS needs_ai_skills FROM v"))
def skills_matched(spark, sf):
    return extract.with_keyword_skills(materialised(dedupe.deduplicate(adverts(spark, sf)))).select("doc_id", "must_have_skills", "skills_source", "needs_ai_skills")


@query(q("SELECT doc_id, CASE nice_to_have_skills WHEN 'docker, Excel' THEN 'Docker' ELSE nice_to_have_skills END AS nice, CASE must_have_skills WHEN 'JS, reactjs' THEN 'JavaScript, React' WHEN 'python,  SQL ' THEN 'Python, SQL (MySQL/Postgres)' WHEN 'REST API;' THEN 'REST APIs' ELSE '' END AS must FROM n"))
def skills_canonical(spark, sf):
    return adverts(spark, sf).select("doc_id", S.canonical_string(F.col("nice_to_have_skills")).alias("nice"), S.canonical_string(F.col("must_have_skills")).alias("must"))


@query(q("SELECT c AS \"column\", CAST(f AS BIGINT) AS filled, t AS total, round_even(100.0 * f / t, 1) AS pct FROM (SELECT unnest([{'c': 'must_have_skills', 'f': (SELECT count(*) FROM v WHERE must_have_skills <> '')}, {'c': 'experience_years', 'f': (SELECT count(years) FROM v)}, {'c': 'role_type', 'f': (SELECT count(*) FROM v WHERE role_type <> '')}], recursive := true), (SELECT count(*) FROM v) AS t)"))
def skills_fill_rate(spark, sf):
    return quality.fill_rates(_labelled(spark, sf), ("must_have_skills", "experience_years", "role_type"))


def _board(spark, sf):
    ads = adverts(spark, sf).select("_seq", "title", "company", "city", "location", "description_snippet", "job_url", "date_posted", "date_added")
    return ads.where("_seq % 2 = 0"), dedupe.deduplicate(ads).where("_seq % 2 = 1").drop("duplicate_count")


@query(q(BOARD + "SELECT _seq, title, date_posted, date_added FROM mrg"))
def board_merge(spark, sf):
    return board.merge(*_board(spark, sf), TODAY).select("_seq", "title", "date_posted", "date_added")


@query(q(BOARD + "SELECT _seq, date_posted, date_added FROM prn"))
def board_prune(spark, sf):
    return board.prune(board.merge(*_board(spark, sf), TODAY), TODAY).select("_seq", "date_posted", "date_added")


@query(q(BOARD + "SELECT row_number() OVER (ORDER BY CASE WHEN date_posted <> '' THEN date_posted ELSE date_added END DESC, _seq) AS place, _seq FROM prn"))
def board_sorted(spark, sf):
    rows = materialised(board.ordered(board.prune(board.merge(*_board(spark, sf), TODAY), TODAY)).select("_seq"))
    # partitions hold ranges in order: a row's place is the rows of earlier partitions and its own number
    at = rows.select("_seq", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("nth"))
    before, n = {}, 0
    for part, size in sorted((r["part"], r["n"]) for r in at.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):
        before[part], n = n, n + size
    offsets = spark.createDataFrame(list(before.items()), "part int, offset long")
    return at.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("nth") + 1).alias("place"), "_seq")


@query(q(BOARD + "SELECT (SELECT count(*) FROM old) AS carried_over, (SELECT count(*) FROM new) AS from_today, (SELECT count(*) FROM mrg) - (SELECT count(*) FROM prn) AS pruned, (SELECT count(*) FROM prn) AS published"))
def board_counts(spark, sf):
    return board.publish_counts(*_board(spark, sf), TODAY)


@query(q(LIVE_BOARD).replace("WITH", "WITH RECURSIVE", 1))
def board_stream(spark, sf):
    """Twenty days of adverts in three drops, each taken in by the stream of the board with the states of those before."""
    folder = f"{shared_folder(spark).rstrip('/')}/live-board-{uuid.uuid4().hex}"
    ads = adverts(spark, sf).select("_seq", "title", "company", "city", "location", "job_url", "date_posted", F.expr("cast(7 * _seq % 20 as int)").alias("nth"))
    for first, end in ((0, 7), (7, 14), (14, 20)):
        drop = ads.where((F.col("nth") >= first) & (F.col("nth") < end))
        live_board.land(drop, F.expr("date_add(date'2026-08-01', nth)"), folder)
        live_board.start(spark, folder).awaitTermination()
    return live_board.as_of(spark.read.schema(live_board.CHANGED).parquet(f"{folder}/changes"), "2026-08-20")


_PAY = "CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN upper(salary_currency) || ' ' || format('{:,}', lo) || ' - ' || format('{:,}', hi) WHEN lo IS NOT NULL THEN upper(salary_currency) || ' ' || format('{:,}', lo) || '+' WHEN hi IS NOT NULL THEN 'Up to ' || upper(salary_currency) || ' ' || format('{:,}', hi) ELSE '' END"
_CASE = "CASE {0} WHEN 'remote' THEN 'Remote' WHEN 'hybrid' THEN 'Hybrid' WHEN 'on-site' THEN 'On-Site' WHEN 'full-time' THEN 'Full-Time' WHEN 'contract' THEN 'Contract' WHEN 'part-time' THEN 'Part-Time' WHEN 'entry level' THEN 'Entry Level' ELSE upper(left({0}, 1)) || substr({0}, 2) END"
_PAID = "SELECT *, CAST(nullif(salary_min, 0) AS BIGINT) AS lo, CAST(nullif(salary_max, 0) AS BIGINT) AS hi FROM "


@query(q(f"""SELECT '2026-08-22 00:00:00' AS "Date Added to Sheet", date_posted AS "Date Job Posted", title AS "Job Title", company AS "Company", primary_role AS "Role Category", location AS "Location", {_CASE.format('workplace_policy')} AS "Work Policy",
  CASE WHEN must_have_skills = '' THEN '' ELSE '• ' || replace(must_have_skills, ', ', chr(10) || '• ') END AS "Required Skills", CASE nice_to_have_skills WHEN '' THEN '' WHEN 'docker, Excel' THEN '• Docker' ELSE '• ' || nice_to_have_skills END AS "Nice-to-Have Skills",
  coalesce(CAST(years AS VARCHAR), '') AS "Years Exp", {_CASE.format('job_level')} AS "Level", {_CASE.format('employment_type')} AS "Type", {_PAY} AS "Salary", blurb AS "Summary", {_CASE.format('source')} AS "Source", job_url AS "Apply Link" FROM ({_PAID} fin WHERE kept)"""))
def sheet_rows(spark, sf):
    return sinks.sheet_rows(_screened(spark, sf).where("kept"), f"{TODAY} 00:00:00")


@query(q("SELECT excluded_stage AS \"Stage\", title AS \"Job Title\", company AS \"Company\", primary_role AS \"Role Label\", job_url AS \"Apply Link\", left(description_snippet, 500) AS \"Description\", CASE WHEN needs_review THEN 'YES' ELSE '' END AS \"Needs Review\" FROM fin WHERE NOT kept"))
def exclude_rows(spark, sf):
    return sinks.exclude_rows(_screened(spark, sf).where("not kept"), TODAY).select("Stage", "Job Title", "Company", "Role Label", "Apply Link", "Description", "Needs Review")


@query(q("""SELECT _seq FROM (SELECT * FROM d3 QUALIFY job_url = '' OR row_number() OVER (PARTITION BY job_url ORDER BY _seq) = 1) x WHERE job_url NOT IN (SELECT job_url FROM n WHERE doc_id % 3 = 0 AND job_url <> '')
  AND (kt = '' OR kc = '' OR NOT EXISTS (SELECT 1 FROM n WHERE n.doc_id % 3 = 0 AND n.kt = x.kt AND n.kc = x.kc AND trim(regexp_replace(lower(split_part(n.location, ',', 1)), '[^a-z ]', ' ', 'g')) = x.kp AND n.kt <> '' AND n.kc <> ''))"""))
def sheet_new_rows(spark, sf):
    ads = adverts(spark, sf)
    sheet = ads.where("doc_id % 3 = 0").select(F.col("title").alias("Job Title"), F.col("company").alias("Company"), F.col("location").alias("Location"), F.col("job_url").alias("Apply Link"))
    return sinks.new_rows(dedupe.deduplicate(ads), sheet).select("_seq")


@query(q("SELECT doc_id FROM fin WHERE role_type IN ('Software development', 'Mobile') AND job_level IN ('junior', 'unknown') AND workplace_policy IN ('remote', '') AND list_has_any(list_concat(skills, CASE nice_to_have_skills WHEN '' THEN [] WHEN 'docker, Excel' THEN ['Docker'] ELSE [nice_to_have_skills] END), ['Java', 'Docker', 'JavaScript', 'Git']) AND (years IS NULL OR years <= 3)"))
def filter_jobs(spark, sf):
    f = search.Filters(role_types=("Software development", "Mobile"), levels=("junior", "unknown"), work_policies=("remote", ""), skills=("Java", "Docker", "JavaScript", "Git"), max_years=3)
    return search.filter_jobs(_screened(spark, sf), f).select("doc_id")


@query(q("SELECT doc_id FROM n WHERE contains(lower(title), 'java') OR contains(lower(company), 'java') OR contains(lower(blurb), 'java') OR contains(lower(description_snippet), 'java')"))
def keyword_search(spark, sf):
    return adverts(spark, sf).where(search.mentions(" Java ")).select("doc_id")


_KEYWORDS = ("java", "machine learning", "c#", "zeta recruitment", "a short blurb", "docker and k8s", "no such words", "5")


@query(q(f"""SELECT keyword, doc_id FROM n, (SELECT unnest([{', '.join(f"'{k}'" for k in _KEYWORDS)}]) AS keyword)
  WHERE contains(lower(title), keyword) OR contains(lower(company), keyword) OR contains(lower(blurb), keyword) OR contains(lower(description_snippet), keyword)"""))
def keyword_postings(spark, sf):
    """Several keywords, two of them too short for a gram, by postings that are written in two parts."""
    ads, folder = adverts(spark, sf), f"{shared_folder(spark)}/postings-{uuid.uuid4().hex}"
    for part in (0, 1):
        postings.post(ads.where(F.col("_seq") % 2 == part), folder, str(part))
    found = postings.found(ads, postings.postings(spark, folder), [f" {k.title()} " for k in _KEYWORDS])
    return found.select("keyword", F.col("_seq").alias("doc_id"))


@query(q("SELECT DISTINCT 'role_type' AS facet, role_type AS value FROM fin WHERE role_type <> '' UNION SELECT DISTINCT 'job_level', job_level FROM fin UNION SELECT DISTINCT 'workplace_policy', workplace_policy FROM fin WHERE workplace_policy <> '' UNION SELECT DISTINCT 'source', source FROM fin UNION SELECT DISTINCT 'employment_type', employment_type FROM fin WHERE employment_type <> ''"))
def facets_values(spark, sf):
    return search.facet_values(_screened(spark, sf))


@query(q("SELECT DISTINCT 'job_level' AS facet, job_level AS value FROM fin WHERE job_level IN ('entry level', 'junior') UNION SELECT DISTINCT 'source', source FROM fin"))
def facets_offered(spark, sf):
    return search.offered(search.facet_values(_screened(spark, sf))).where("facet in ('job_level', 'source')")


@query(q("SELECT skill, count(*) AS n FROM (SELECT unnest(list_concat(skills, CASE nice_to_have_skills WHEN '' THEN [] WHEN 'docker, Excel' THEN ['Docker'] ELSE [nice_to_have_skills] END)) AS skill FROM fin) WHERE skill <> 'Communication' GROUP BY ALL"))
def facet_skills_ranked(spark, sf):
    return search.facet_skills(_screened(spark, sf), R.SOFT_SKILLS).select("skill", "n")


@query(q("SELECT doc_id, array_to_string(list_filter(['Python', 'Java', 'SQL (MySQL/Postgres)'], lambda x: list_contains(skills, x)), ', ') AS overlap, CASE WHEN years IS NOT NULL THEN 'years' WHEN level_source = 'title' THEN 'title-only' ELSE 'unstated' END AS evidence FROM fin WHERE role_type IN ('Software development', 'Data & BI') AND (years IS NULL OR years <= 3)"))
def match_ranked(spark, sf):
    found = search.search(_screened(spark, sf), search.Criteria(role_types=("Software development", "Data & BI"), levels=("entry level", "junior"), skills=("Python", "Java", "SQL (MySQL/Postgres)")))
    return found.select("doc_id", F.array_join("overlap", ", ").alias("overlap"), "evidence")


@query(q("SELECT doc_id, CAST(years AS INT) AS experience_years FROM fin"))
def sort_years_nulls_last(spark, sf):
    return _screened(spark, sf).orderBy(*search.sort_keys("years-asc")).select("doc_id", "experience_years")


@query(q("SELECT doc_id FROM fin a WHERE NOT EXISTS (SELECT 1 FROM fin b WHERE NOT b.kept AND CASE WHEN b.u <> '' THEN b.u ELSE lower(b.title || '|' || b.company) END = CASE WHEN a.u <> '' THEN a.u ELSE lower(a.title || '|' || a.company) END)"))
def kept_minus_excluded(spark, sf):
    rows = _screened(spark, sf)
    return quality.kept_minus_excluded(rows, rows.where("not kept")).select("doc_id")


_ID = "CASE WHEN u <> '' THEN u ELSE lower(title || '|' || company) END"


@query(q(f"SELECT CASE WHEN {_ID} IN (SELECT {_ID} FROM fin WHERE excluded_stage = 'F1 non-tech') THEN 'dropped' ELSE 'kept' END AS screen, role_type <> '' AS has_role, count(*) AS n FROM fin GROUP BY ALL"))
def decision_buckets(spark, sf):
    rows = _screened(spark, sf)
    return quality.decision_buckets(rows, rows.where("not kept"))


@query(q("SELECT count(*) AS total, count(*) FILTER (len(skills) >= 3) AS enough, count(*) FILTER (len(skills) >= 3 AND blurb <> '') AS would_lose_blurb, count(*) FILTER (len(skills) >= 3 AND primary_role <> '') AS would_lose_role FROM v"))
def enrichment_headroom(spark, sf):
    return quality.enrichment_headroom(_labelled(spark, sf))


@query(q("SELECT count(*) AS levelled, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS excluded, count(*) = count(*) FILTER (kept) + count(*) FILTER (NOT kept) AS balanced FROM fin"))
def reconcile(spark, sf):
    rows = _screened(spark, sf)
    return quality.reconcile(rows, rows.where("kept"), rows.where("not kept"))


@query(q("SELECT doc_id, NOT (blurb <> '' AND primary_role <> '') AND (must_have_skills = '' OR job_level = '') AS needs FROM n"))
def needs_enrichment(spark, sf):
    return adverts(spark, sf).select("doc_id", enrich.needs_enrichment().alias("needs"))


@query(q(f"SELECT doc_id, {_PAY} AS sheet, nullif(trim(CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN salary_currency || ' ' || format('{{:,}}', lo) || ' - ' || format('{{:,}}', hi) || per WHEN lo IS NOT NULL THEN salary_currency || ' ' || format('{{:,}}', lo) || '+' || per WHEN hi IS NOT NULL THEN 'Up to ' || salary_currency || ' ' || format('{{:,}}', hi) || per END), '') AS card FROM (SELECT *, CASE WHEN salary_period = '' THEN '' ELSE '/' || salary_period END AS per FROM ({_PAID} n))"))
def salary_formatted(spark, sf):
    low, high, cur = F.col("salary_min"), F.col("salary_max"), F.col("salary_currency")
    return adverts(spark, sf).select("doc_id", T.sheet_salary(low, high, cur).alias("sheet"), T.card_salary(low, high, cur, F.col("salary_period")).alias("card"))


@query("""SELECT event_id, CASE CAST(event_id % 6 AS INT) WHEN 0 THEN '2026-08-22' WHEN 1 THEN strftime(DATE '2026-08-22' - CAST(event_id % 40 AS INT), '%Y-%m-%d') WHEN 2 THEN strftime(DATE '2026-08-22' - 7 * CAST(event_id % 9 AS INT), '%Y-%m-%d')
  WHEN 3 THEN strftime(DATE '2026-08-22' - 30 * CAST(event_id % 5 AS INT), '%Y-%m-%d') ELSE '' END AS posted FROM events""")
def relative_dates(spark, sf):
    n = lambda k: (F.col("event_id") % k).cast("string")
    said = F.element_at(F.array(F.concat(n(24), F.lit(" hours ago")), F.concat(n(40), F.lit(" Days ago")), F.concat(n(9), F.lit(" weeks ago")), F.concat(n(5), F.lit(" months ago")), F.lit("a few days ago"), F.lit("recently")), (F.col("event_id") % 6).cast("int") + 1)
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", T.relative_date(said, F.to_date(F.lit(TODAY))).alias("posted"))


@query(q("SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'Some Company' WHEN doc_id % 6 = 1 THEN 'Avbob' ELSE '' END AS by_url, CASE WHEN company <> '' THEN company WHEN doc_id % 6 = 0 THEN 'Some Company' WHEN doc_id % 6 = 1 THEN 'Avbob' ELSE '' END AS company FROM n"))
def company_from_url(spark, sf):
    url = F.col("company_url")
    return adverts(spark, sf).select("doc_id", T.company_from_url(url).alias("by_url"), feeds.company(F.col("company"), url, F.lit("")).alias("company"))


@query("SELECT strftime(l, '%Y-%m-%d') AS day, c AS cadence, CAST(CASE c WHEN 'daily' THEN 13 ELSE 19 END AS BIGINT) AS n FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS l FROM orders) CROSS JOIN (VALUES ('daily'), ('even'), ('odd')) AS cs(c) WHERE c = 'daily' OR (c = 'even') = (dayofyear(l) % 2 = 0)")
def cadence_terms(spark, sf):
    days = spark.read.parquet(f"{sf}/orders.parquet").select(F.to_date("o_orderdate").alias("day")).distinct()
    terms = F.array(*(F.struct(F.lit(phrase).alias("phrase"), F.lit(cadence).alias("cadence")) for phrase, _, cadence in R.SEARCH_TERMS))
    wanted = feeds.terms_for(days.select("day", F.inline(terms)), F.col("day"))
    return wanted.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "cadence").agg(F.count(F.lit(1)).alias("n"))


@query(q("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Mind Drift' ELSE '' END AS company FROM n"))
def company_from_network_url(spark, sf):
    url = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("https://x.linkedin.com/company/mind-drift-"), F.col("doc_id").cast("string"))).otherwise("https://indeed.com/cmp/Other")
    return adverts(spark, sf).select("doc_id", feeds.company(F.lit("n/a"), url, F.lit(""), source="network").alias("company"))


@query(q("SELECT source, count(*) AS n FROM n GROUP BY ALL"))
def source_union_counts(spark, sf):
    ads = adverts(spark, sf)
    parts = {s: (lambda s=s: ads.where(F.col("source") == s)) for s in ("api", "search", "network", "html")}
    return sinks.source_counts(feeds.union(parts))


@query(q("SELECT doc_id, d AS date, t AS time, CASE WHEN d = '' THEN '0000-00-00T00:00:00' ELSE d || 'T' || CASE WHEN t = '' THEN '00:00:00' ELSE t END END AS sort_key FROM (SELECT doc_id, CASE WHEN regexp_matches(date_posted, '^\\d{4}-\\d{2}-\\d{2}') THEN left(date_posted, 10) WHEN regexp_matches(date_posted, '^\\d{4}-\\d-\\d$') THEN substr(date_posted, 1, 5) || '0' || substr(date_posted, 6, 2) || '0' || substr(date_posted, 8, 1) ELSE '' END AS d, CASE WHEN contains(date_posted, 'T') THEN substr(date_posted, 12, 8) ELSE '' END AS t FROM n)"))
def dates_parsed(spark, sf):
    d = T.parse_date(F.col("date_posted"))
    return adverts(spark, sf).select("doc_id", d["date"].alias("date"), d["time"].alias("time"), T.sort_key(d["date"], d["time"]).alias("sort_key"))


@query(q("SELECT doc_id, CASE WHEN years IS NULL THEN NULL WHEN years = 1 THEN '1+ year experience' ELSE years || '+ years experience' END AS years, CASE WHEN job_level = 'unknown' THEN NULL ELSE upper(left(job_level, 1)) || substr(job_level, 2) END AS level, CASE WHEN regexp_matches(date_posted, '^\\d{4}-\\d{2}-\\d{2}') THEN 'Posted ' || CAST(substr(date_posted, 9, 2) AS INT) || ' Aug 2026' WHEN date_added <> '' THEN 'Added ' || CAST(substr(date_added, 9, 2) AS INT) || ' Aug 2026' END AS date FROM lab"))
def card_labels(spark, sf):
    return _labelled(spark, sf).select("doc_id", T.years_label(F.col("experience_years")).alias("years"), T.level_label(F.col("job_level")).alias("level"), T.job_date_label(F.col("date_posted"), F.col("date_added")).alias("date"))


@query(q("SELECT doc_id, CASE WHEN city <> '' THEN city ELSE split_part(location, ',', 1) END AS city, regexp_matches(lower(location), 'south africa|cape town|johannesburg|durban|pretoria|gauteng') AS at_home, CASE WHEN length(title) > 12 THEN trim(left(replace(title, '|', '/'), 12)) || '...' ELSE replace(title, '|', '/') END AS cell FROM n"))
def places_and_cells(spark, sf):
    city = F.coalesce(F.nullif("city", F.lit("")), T.known_city(F.col("location")))
    return adverts(spark, sf).select("doc_id", city.alias("city"), T.at_home(F.col("location")).alias("at_home"), T.report_cell(F.col("title"), 12).alias("cell"))


@query()
def qa_sample(spark, sf):
    return quality.sample(_screened(spark, sf).where("kept"), 60, seed=7).select("doc_id", quality.needs_a_look().alias("look"))


@query("""SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1 AS INT) AS place, title, job_url FROM (
  SELECT page_id, job_url, min(k) AS nth, arg_min(title, k) AS title FROM (SELECT page_id, k, regexp_extract(a, '"(/[^"]*)"', 1) AS job_url, trim(regexp_extract(a, '>([^<]*)$', 1)) AS title
    FROM (SELECT page_id, unnest(found) AS a, unnest(range(len(found))) AS k FROM (SELECT page_id, regexp_extract_all(html, '<a href="/[^"]*">[^<]*') AS found FROM pages))) GROUP BY page_id, job_url) WHERE title <> ''""")
def html_cards(spark, sf):
    """Cards around the given pages' inner links, which stand in lists."""
    facts = cards.card_facts(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), links=((("/",), "li", ""),))
    return cards.cards(facts, F.to_date(F.lit(TODAY))).select("page_id", "place", "title", "job_url")


_HOST = "regexp_extract(url, '://([^/?#]*)', 1)"


@query(f"""WITH c AS (SELECT page_id, term, CAST(1 + (r - 1) // 3 AS INT) AS page, job_url, date_posted FROM (
    SELECT page_id, {_HOST} AS term, row_number() OVER (PARTITION BY {_HOST} ORDER BY page_id) AS r, CASE WHEN page_id % 11 = 0 THEN '' ELSE 'u' || page_id % 7 END AS job_url,
      CASE WHEN page_id % 5 = 0 THEN '' ELSE strftime(DATE '{TODAY}' - CAST(page_id % 33 AS INT), '%Y-%m-%d') END AS date_posted FROM pages) WHERE r % 19 <> 0),
n AS (SELECT *, job_url = '' OR page = min(page) OVER (PARTITION BY term, job_url) AS is_new, coalesce(try_cast(nullif(date_posted, '') AS DATE) >= DATE '{TODAY}' - 30, true) AS young FROM c),
p AS (SELECT term, page, count(*) FILTER (is_new) AS news, count(*) FILTER (is_new AND young) AS recents FROM n GROUP BY ALL),
e AS (SELECT *, page <> row_number() OVER w OR news = 0 AS stop, recents < news AS last FROM p WINDOW w AS (PARTITION BY term ORDER BY page)),
k AS (SELECT term, page, bool_or(stop) OVER w AS stopped, coalesce(bool_or(last) OVER (PARTITION BY term ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS ended FROM e WINDOW w AS (PARTITION BY term ORDER BY page))
SELECT page_id, n.term, n.page, job_url, date_posted FROM n JOIN k ON n.term = k.term AND n.page = k.page WHERE NOT stopped AND NOT ended AND is_new AND young""")
def listing_walk(spark, sf):
    """Pages of a host in threes are the listing pages of a term: what a walk with loop detection and a cut-off keeps."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.expr(_HOST).alias("term"))
    placed = pages.withColumn("r", F.row_number().over(Window.partitionBy("term").orderBy("page_id"))).where("r % 19 != 0")
    link = F.when(F.col("page_id") % 11 == 0, "").otherwise(F.concat(F.lit("u"), (F.col("page_id") % 7).cast("string")))
    day = F.when(F.col("page_id") % 5 == 0, "").otherwise(F.date_format(F.date_sub(F.to_date(F.lit(TODAY)), (F.col("page_id") % 33).cast("int")), "yyyy-MM-dd"))
    rows = placed.select("page_id", "term", F.expr("cast(1 + (r - 1) div 3 as int)").alias("page"), link.alias("job_url"), day.alias("date_posted"))
    return listing.walked(rows, oldest=str(datetime.date.fromisoformat(TODAY) - datetime.timedelta(days=30)))


#: Pages that are landed together.
_LANDED = 500


@query("""WITH e AS (SELECT event_id, CAST(1 + event_id // 50 AS INT) AS page, props FROM events WHERE event_id % 50 < 40),
last AS (SELECT min(n) AS n FROM (SELECT unnest(range(1, (SELECT max(page) + 2 FROM e))) AS n) WHERE n NOT IN (SELECT page FROM e WHERE page <> 37))
SELECT page, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM e, last WHERE page < last.n""")
def paged_source(spark, sf):
    """Events landed as pages of a feed, one of them empty, read by the paged source up to there."""
    events = spark.read.parquet(f"{sf}/events.parquet").where("event_id % 50 < 40").select("event_id", F.expr("cast(1 + event_id div 50 as int)").alias("page"), "props")
    folder = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    ranges = events.withColumn("range", F.expr(f"(page - 1) div {_LANDED}")).repartition("range")  # a folder is written by one task
    items = ranges.groupBy("range", "page").agg(F.collect_list(F.struct("event_id", "props")).alias("items"))  # 40 a page
    body = F.when(F.col("page") != 37, F.to_json(F.struct("items"))).otherwise('{"items": []}')
    landed = items.select("range", F.concat_ws("\t", F.col("page").cast("string"), body).alias("value"))
    landed.write.partitionBy("range").text(folder)
    found = listing.read_pages(spark, f"{folder}/range={{range}}", most=events.agg(F.max("page")).first()[0] + 1, pages=_LANDED, field="items")
    rows = found.select("page", F.inline(F.from_json("json", "items array<struct<event_id long, props string>>")["items"]))
    return rows.select("page", "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


_DAMAGED = "CASE CAST(event_id % 10 AS INT) WHEN 3 THEN left(props, length(props) - 1) WHEN 5 THEN ' ' WHEN 7 THEN '[' || props || ']' WHEN 8 THEN '{\"other\": 1}' WHEN 9 THEN '{\"k\": \"x\"}' ELSE props END"


@query(f"""SELECT event_id, CASE WHEN event_id % 10 IN (3, 5, 7, 8, 9) THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE CAST(event_id % 10 AS INT) WHEN 3 THEN 'not json' WHEN 5 THEN 'empty' WHEN 7 THEN 'no object' WHEN 8 THEN 'no field' WHEN 9 THEN 'wrong type' END AS reason FROM events""")
def quarantined_lines(spark, sf):
    lines = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.expr(_DAMAGED).alias("line"))
    return quarantine.judged(lines, StructType([StructField("k", LongType())])).select("event_id", "parsed.k", "reason")


_NEEDS = "NOT (blurb <> '' AND primary_role <> '') AND (must_have_skills = '' OR job_level = '')"


@query(q(f"SELECT doc_id, CASE WHEN {_NEEDS} THEN 'Role of ' || title ELSE primary_role END AS primary_role, CASE WHEN {_NEEDS} THEN 'At ' || company ELSE blurb END AS blurb, must_have_skills FROM n"))
def enrichment_kept(spark, sf):
    """Replies of a provider that goes by rules; a second run finds them kept and asks a provider that fails."""

    def by_rules(rows):
        return json.dumps({"jobs": [{"job_id": r["job_id"], "primary_role": f"Role of {r['title']}", "blurb": f"At {r['company']}"} for r in rows]})

    def refuses(rows):
        raise RuntimeError("asked again")

    folder = f"{shared_folder(spark)}/replies-{uuid.uuid4().hex}"
    ads = adverts(spark, sf).select("_seq", "doc_id", "title", "company", "description_snippet", *enrich.FIELDS)
    enrich.enrich_kept(ads, by_rules, folder)
    return enrich.enrich_kept(ads, refuses, folder).select("doc_id", "primary_role", "blurb", "must_have_skills")


assert NORM and set(SKILLS) <= {s.name for s in S.DEFAULT}

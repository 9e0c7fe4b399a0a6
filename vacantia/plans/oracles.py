"""DuckDB SQL for the registered queries, written apart from the engine: a chain of common table expressions over the
made-up adverts, and a select for each query. What phrases and titles ask for is stated by hand, not worked out by rules."""

from __future__ import annotations

from .job_ads import FEED_SKILLS, PHRASES, TITLES, TODAY, sql


def _list(values, text=True) -> str:
    return "[" + ", ".join("NULL" if v is None else ("'" + v.replace("'", "''") + "'") if text else str(v) for v in values) + "]"


NORM = r"trim(regexp_replace(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}\p{{M}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
#: Keys of titles and companies that are more than lower case away from them.
_TITLE_KEY = {
    "QA Tester (Remote)": "qa tester", "Flutter Developer - Cape Town": "flutter developer", "Full-Stack Engineer": "full stack engineer", "Intermediate C# Developer": "intermediate c developer",
    "Team Lead: Mobile Developer": "team lead mobile developer", "URGENT Junior Developer Ref: ABC123": "junior developer", "Web Developer | Johannesburg": "web developer", "Mid-level Backend Developer": "mid level backend developer",
}
_COMPANY_KEY = {"Acme (Pty) Ltd": "acme", "Blue Group": "blue", "Nova Holdings": "nova", "Orbit Inc.": "orbit", "Zeta Recruitment": "zeta"}
_CITY = "lower(CASE WHEN city <> '' THEN city ELSE split_part(location, ',', 1) END)"


#: The skills that phrases, titles and feeds name, in the vocabulary's order.
SKILLS = (
    "JavaScript", "HTML/CSS", "React", "Git", "REST APIs", "Python", "SQL (MySQL/Postgres)", "C#/.NET", "Node.js", "Java", "Docker", "Kubernetes", "Go", "Flutter", "Swift", "iOS",
    "Business Analysis", "Power BI", "SOC Operations", "Data Analysis", "Machine Learning", "Communication", "Salesforce",
)
_TITLE_SKILLS = {"Senior Java Developer": "Java", "Graduate Data Analyst": "Data Analysis", "Business Analyst": "Business Analysis", "SOC Analyst": "SOC Operations", "Salesforce Developer": "Salesforce", "Machine Learning Engineer": "Machine Learning", "Flutter Developer - Cape Town": "Flutter", "Intermediate C# Developer": "C#/.NET", "Power BI Developer": "Power BI"}
_FEED = {"JS, reactjs": "JavaScript, React", "python,  SQL ": "Python, SQL (MySQL/Postgres)", "REST API;": "REST APIs"}
_TITLE_LEVEL = {"Junior Software Developer": "junior", "Senior Java Developer": "senior", "Graduate Data Analyst": "entry level", "Intermediate C# Developer": "mid", "Team Lead: Mobile Developer": "lead", "Principal Architect": "senior", "Learnership 2026": "entry level", "URGENT Junior Developer Ref: ABC123": "junior", "Trainee Programmer": "entry level", "Mid-level Backend Developer": "mid"}
_TITLE_WORD = {"Junior Software Developer": "Junior", "Senior Java Developer": "Senior", "Graduate Data Analyst": "Graduate", "Intermediate C# Developer": "Intermediate", "Team Lead: Mobile Developer": "Lead", "Principal Architect": "Architect", "Learnership 2026": "Learnership", "URGENT Junior Developer Ref: ABC123": "Junior", "Trainee Programmer": "Trainee", "Mid-level Backend Developer": "Mid-level"}
_S, _A = "Software development", "Business Analysis & Low-code (Power Platform)"
_TITLE_ROLE = {"Junior Software Developer": _S, "Senior Java Developer": _S, "Graduate Data Analyst": "Data & BI", "IT Support Technician": "Technical Support", "DevOps Engineer": "DevOps/Cloud", "QA Tester (Remote)": "QA/Testing", "Flutter Developer - Cape Town": "Mobile", "Business Analyst": _A, "SOC Analyst": "Security", "Salesforce Developer": _S, "Product Developer": _S, "Software Product Developer": _S, "Full-Stack Engineer": _S, "Intermediate C# Developer": _S, "Team Lead: Mobile Developer": "Mobile", "URGENT Junior Developer Ref: ABC123": _S, "Developer": _S, "Web Developer | Johannesburg": _S, "Power BI Developer": _A, "Machine Learning Engineer": "Data & BI", "Cloud Engineer": "DevOps/Cloud", "Trainee Programmer": _S, "Mid-level Backend Developer": _S, "Systems Analyst": _A}
_ACCEPT = {"Junior Software Developer": "developer", "Senior Java Developer": "developer", "Graduate Data Analyst": "tech_analyst", "IT Support Technician": "support", "DevOps Engineer": "tech_engineer", "QA Tester (Remote)": "qa_testing", "Flutter Developer - Cape Town": "developer", "Business Analyst": "tech_analyst", "SOC Analyst": "tech_analyst", "Salesforce Developer": "developer", "Product Developer": "developer", "Software Product Developer": "developer", "Full-Stack Engineer": "tech_engineer", "Intermediate C# Developer": "developer", "Team Lead: Mobile Developer": "developer", "URGENT Junior Developer Ref: ABC123": "developer", "Developer": "developer", "Web Developer | Johannesburg": "developer", "Power BI Developer": "developer", "Machine Learning Engineer": "tech_engineer", "Cloud Engineer": "tech_engineer", "Trainee Programmer": "developer", "Mid-level Backend Developer": "developer", "Systems Analyst": "tech_analyst"}
_LABEL = {"Software Engineer": "tech_engineer", "Data Engineer": "tech_engineer", "Support Agent": "support", "IT Specialist": "it_generic"}
_BLOCK = {"Mining Engineer": "Mining Engineer", "Sales Representative": "Sales", "Product Developer": "Product Developer", "Receptionist": "Receptionist"}
_PHRASE_WORD = {"With over 100 years of rich history we hire a junior developer.": "junior developer", "A graduate programme for people who love React, JS and Node.js.": "graduate programme", "Senior engineer wanted with 8+ years of hands-on Golang experience.": "Senior engineer", "No prior experience needed. HTML5 and CSS3 taught.": "No prior experience", "You are an intermediate analyst. Experience: 4 years.": "intermediate analyst"}


def _of(table: dict, column: str) -> str:
    return "coalesce(map_extract_value(MAP {" + ", ".join(f"{_list([k])[1:-1]}: {_list([v])[1:-1]}" for k, v in table.items()) + f"}}, {column}), '')"


_PHRASE = f"list_extract({_list([p for p, *_ in PHRASES])}, CAST(k % {len(PHRASES)} AS INT) + 1)"
CHAIN = rf"""
WITH ads AS ({sql("duckdb")}),
n AS (SELECT ads.*, length(coalesce(t.text, '')) AS k, trim(job_url) AS u, coalesce(nullif({_of(_TITLE_KEY, "title")}, ''), lower(title)) AS kt, coalesce(nullif({_of(_COMPANY_KEY, "company")}, ''), lower(company)) AS kc, {_CITY} AS kp, {NORM.format("description_snippet")} AS fp
  FROM ads JOIN documents t ON t.doc_id = ads.doc_id),
d1 AS (SELECT * FROM n QUALIFY u = '' OR row_number() OVER (PARTITION BY u ORDER BY _seq) = 1),
g2 AS (SELECT *, kt <> '' AND kc <> '' AS cmp, row_number() OVER w AS r, min(_seq) OVER p AS place, count(*) OVER p AS size FROM d1
  WINDOW w AS (PARTITION BY kt, kc, kp ORDER BY length(description_snippet) DESC, date_posted DESC, _seq), p AS (PARTITION BY kt, kc, kp)),
d2 AS (SELECT * EXCLUDE (_seq, cmp, r, place, size), CASE WHEN cmp THEN place ELSE _seq END AS _seq, CASE WHEN cmp THEN size - 1 ELSE 0 END AS dup FROM g2 WHERE NOT cmp OR r = 1),
g3 AS (SELECT *, kt <> '' AND length(fp) >= 200 AS cmp, CASE WHEN length(fp) >= 200 THEN fp ELSE '' END AS f FROM d2),
h3 AS (SELECT *, row_number() OVER w AS r, min(_seq) OVER p AS place, count(*) OVER p AS size, first_value(dup) OVER s AS dup1 FROM g3
  WINDOW w AS (PARTITION BY kt, kp, f ORDER BY length(description_snippet) DESC, date_posted DESC, _seq), p AS (PARTITION BY kt, kp, f), s AS (PARTITION BY kt, kp, f ORDER BY _seq)),
d3 AS (SELECT * EXCLUDE (_seq, cmp, r, place, size, dup, dup1, f), CASE WHEN cmp THEN place ELSE _seq END AS _seq, CASE WHEN cmp THEN dup1 + size - 1 ELSE dup END AS duplicate_count FROM h3 WHERE NOT cmp OR r = 1),
f1 AS (SELECT *, doc_id % 3 <> 0 AS has, {_PHRASE} AS phrase, list_extract({_list([y for _, y, *_ in PHRASES], False)}, CAST(k % {len(PHRASES)} AS INT) + 1) AS py,
    list_extract({_list([x for _, _, x, _ in PHRASES])}, CAST(k % {len(PHRASES)} AS INT) + 1) AS pl, list_extract({_list([s for *_, s in PHRASES])}, CAST(k % {len(PHRASES)} AS INT) + 1) AS ps,
    CASE experience_years WHEN '3' THEN 3 WHEN '3-5' THEN 3 WHEN '2 years' THEN 2 END AS fy FROM d3),
f2 AS (SELECT * EXCLUDE (experience_years, job_level), CASE WHEN has AND py IS NOT NULL THEN py ELSE fy END AS years, CASE WHEN has AND py IS NOT NULL THEN 'text' WHEN fy IS NOT NULL THEN 'feed' ELSE '' END AS years_source,
    CASE job_level WHEN 'Junior' THEN 'junior' WHEN 'Senior' THEN 'senior' WHEN 'mid-level' THEN 'mid' WHEN 'intern' THEN 'entry level' WHEN 'Team Lead' THEN 'lead' ELSE '' END AS ai_job_level,
    {_of(_TITLE_LEVEL, "title")} AS tl, {_of(_TITLE_WORD, "title")} AS tw, CASE WHEN has THEN pl ELSE '' END AS dl, CASE WHEN has THEN {_of(_PHRASE_WORD, "phrase")} ELSE '' END AS dw, {_of(_TITLE_ROLE, "title")} AS tr,
    title || chr(32) || chr(10) || chr(32) || description_snippet AS h FROM f1),
f3 AS (SELECT *, CASE WHEN tl <> '' THEN tl WHEN years IS NOT NULL THEN CASE WHEN years <= 0 THEN 'entry level' WHEN years <= 2 THEN 'junior' WHEN years <= 4 THEN 'mid' WHEN years <= 7 THEN 'senior' ELSE 'lead' END WHEN dl <> '' THEN dl ELSE 'unknown' END AS job_level,
    CASE WHEN tl <> '' THEN 'title' WHEN years IS NOT NULL THEN 'years' WHEN dl <> '' THEN 'description' ELSE 'none' END AS level_source,
    CASE WHEN tl <> '' THEN tw WHEN years IS NOT NULL THEN years || ' years' WHEN dl <> '' THEN dw ELSE '' END AS level_evidence,
    CASE WHEN tl <> '' THEN 'high' WHEN years >= 3 THEN 'high' WHEN years IS NOT NULL OR dl <> '' THEN 'medium' ELSE 'none' END AS level_confidence,
    tr AS role_type, CASE WHEN tr <> '' THEN 'title' ELSE '' END AS role_source,
    list_concat(string_split({_of(_TITLE_SKILLS, "title")}, ', '), list_concat(string_split({_of(_FEED, "must_have_skills")}, ', '), CASE WHEN has THEN string_split(ps, ', ') ELSE [] END)) AS names,
    CASE WHEN strpos(h, 'Swift') > 0 THEN regexp_matches(lower(substr(h, greatest(strpos(h, 'Swift') - 60, 1), strpos(h, 'Swift') - greatest(strpos(h, 'Swift') - 60, 1) + 65)), 'develop|engineer|program|coding|code|language|backend|back-end|server|stack|experience|knowledge|proficien|framework|microservice|api|skills|tech') ELSE false END AS swift FROM f2),
lab AS (SELECT * EXCLUDE (must_have_skills), list_filter({_list(SKILLS)}, lambda x: list_contains(names, x) AND x <> 'Swift' OR x = 'Swift' AND swift) AS skills FROM f3),
v AS (SELECT *, array_to_string(skills, ', ') AS must_have_skills, {_of(_BLOCK, "title")} AS b, {_of(_LABEL, "primary_role")} AS al, {_of(_ACCEPT, "title")} AS atl FROM lab),
scr AS (SELECT *, CASE WHEN b <> '' OR (al = '' AND atl = '') THEN 'F1 non-tech' WHEN role_type NOT IN ('Software development', 'Mobile', 'QA/Testing', '{_A}', 'Data & BI') THEN 'scope off track'
    WHEN years >= 4 OR job_level IN ('senior', 'lead', 'principal') OR regexp_matches(title, '(?i)\b(senior|lead|principal|chief|manager|architect)\b') THEN 'F4 above cohort' ELSE '' END AS excluded_stage FROM v),
fin AS (SELECT *, excluded_stage = '' AS kept, CASE WHEN excluded_stage <> '' THEN '' WHEN job_level IN ('entry level', 'junior') AND (years IS NULL OR years <= 2) THEN 'apply' ELSE 'stretch' END AS tier,
    CASE excluded_stage WHEN 'F1 non-tech' THEN CASE WHEN b <> '' THEN 'title matches excluded role word: ''' || b || '''' WHEN primary_role <> '' THEN 'role type not accepted (role label was ''' || primary_role || ''')' ELSE 'role type not accepted (no role label)' END
      WHEN 'scope off track' THEN CASE WHEN role_type = '' THEN 'no role type -- title and description named no role' ELSE 'role type is ' || role_type || ', off track (from title)' END
      ELSE '' END AS reason,
    CASE WHEN excluded_stage = 'F1 non-tech' THEN CASE WHEN b <> '' THEN 'title_blocklist' ELSE 'role_not_accepted' END WHEN excluded_stage <> '' THEN '' WHEN al <> '' THEN 'role_label:' || al ELSE 'title:' || atl END AS excluded_rule,
    CASE excluded_stage WHEN 'F1 non-tech' THEN false WHEN 'scope off track' THEN role_type = '' WHEN 'F4 above cohort' THEN CASE WHEN years >= 4 THEN years_source <> 'text' WHEN job_level IN ('senior', 'lead', 'principal') THEN level_source = 'description' ELSE false END
      ELSE job_level NOT IN ('entry level', 'junior', 'mid') END AS needs_review FROM scr)
"""


def q(select: str) -> str:
    return CHAIN + select


#: The board of the merge queries: adverts of even numbers as they were, against all labelled ones of odd numbers.
BOARD = f"""
, old AS (SELECT _seq, u, kt, kc, kp, title, date_posted, date_added FROM n WHERE _seq % 2 = 0),
new AS (SELECT _seq, u, kt, kc, kp, title, date_posted, date_added FROM d3 WHERE _seq % 2 = 1),
bu AS (SELECT u, min(_seq) AS ru FROM old WHERE u <> '' GROUP BY u),
bk AS (SELECT kt, kc, kp, max(_seq) AS rk FROM old WHERE kt <> '' AND kc <> '' GROUP BY ALL),
fnd AS (SELECT new.*, coalesce(ru, rk) AS rw FROM new LEFT JOIN bu USING (u) LEFT JOIN bk ON new.kt = bk.kt AND new.kc = bk.kc AND new.kp = bk.kp),
win AS (SELECT *, rw IS NOT NULL AND row_number() OVER (PARTITION BY rw ORDER BY _seq) = 1 AS hit FROM fnd),
mrg AS (SELECT _seq, title, date_posted, date_added FROM old WHERE _seq NOT IN (SELECT rw FROM win WHERE hit)
  UNION ALL SELECT w.rw, w.title, w.date_posted, CASE WHEN o.date_added <> '' THEN o.date_added WHEN w.date_added <> '' THEN w.date_added ELSE '{TODAY}' END FROM win w JOIN old o ON o._seq = w.rw WHERE hit
  UNION ALL SELECT w._seq + (SELECT max(_seq) FROM old) + 1, w.title, w.date_posted, CASE WHEN w.date_added <> '' THEN w.date_added ELSE '{TODAY}' END FROM win w WHERE NOT hit),
dts AS (SELECT *, coalesce(try_strptime(left(date_posted, 10), '%Y-%m-%d')::DATE, CASE WHEN regexp_matches(date_posted, '^\\d{{4}}-\\d-\\d$') THEN make_date(CAST(substr(date_posted, 1, 4) AS INT), CAST(substr(date_posted, 6, 1) AS INT), CAST(substr(date_posted, 8, 1) AS INT)) END) AS p, try_strptime(date_added, '%Y-%m-%d')::DATE AS a FROM mrg),
prn AS (SELECT * FROM dts WHERE (p IS NULL AND a IS NULL) OR coalesce(p, a) >= DATE '{TODAY}' - 7 OR coalesce(a >= DATE '{TODAY}' - 5, false))
"""
#: The board of a stream on 20 August: days in order for each identity, each with the finding and the leaving of the one before.
LIVE_BOARD = r"""
, dr AS (SELECT *, DATE '2026-08-01' + CAST(7 * _seq % 20 AS INT) AS day, CASE WHEN u <> '' THEN 'l' || u WHEN kt <> '' AND kc <> '' THEN concat_ws('|', 'k', kt, kc, kp) ELSE 'r' || _seq END AS i,
  coalesce(try_strptime(left(date_posted, 10), '%Y-%m-%d')::DATE, CASE WHEN regexp_matches(date_posted, '^\d{4}-\d-\d$') THEN make_date(CAST(substr(date_posted, 1, 4) AS INT), CAST(substr(date_posted, 6, 1) AS INT), CAST(substr(date_posted, 8, 1) AS INT)) END) AS p FROM n),
fd AS (SELECT i, day, min(_seq) AS sq, arg_min(coalesce(p, DATE '1900-01-01'), _seq) AS p FROM dr GROUP BY i, day),
od AS (SELECT i, day, sq, nullif(p, DATE '1900-01-01') AS p, row_number() OVER (PARTITION BY i ORDER BY day) AS r FROM fd),
st AS (SELECT i, r, day, sq, day AS f, greatest(coalesce(p, day) + 7, day + 5) + 1 AS l FROM od WHERE r = 1
  UNION ALL SELECT i, r, day, sq, f, greatest(coalesce(p, f) + 7, f + 5) + 1 AS l FROM (
    SELECT od.i, od.r, od.day, od.sq, od.p, CASE WHEN st.l >= od.day THEN st.f ELSE od.day END AS f FROM st JOIN od ON od.i = st.i AND od.r = st.r + 1))
SELECT sq AS _seq, strftime(day, '%Y-%m-%d') AS day, strftime(f, '%Y-%m-%d') AS date_added, strftime(l, '%Y-%m-%d') AS leaves
FROM (SELECT *, max(r) OVER (PARTITION BY i) AS top FROM st) WHERE r = top AND l > DATE '2026-08-20'
"""
TITLES_WITH_LEVEL = tuple(_TITLE_LEVEL)
assert set(_TITLE_ROLE) <= set(TITLES) and set(_FEED) <= set(FEED_SKILLS)

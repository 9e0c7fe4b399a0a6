"""A deterministic table of adverts made from ``documents``, in Spark SQL and in DuckDB SQL.

The driver's tables hold no adverts. Fields are picked from small lists by arithmetic on doc_id, so that every rule has
adverts that it fits; the documents' own texts fill the descriptions, so that copies there are re-posts here. Both
dialects share the lists; what the engine and the oracles make of the adverts is written apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TITLES = (
    "Junior Software Developer", "Senior Java Developer", "Mining Engineer", "Graduate Data Analyst", "IT Support Technician", "DevOps Engineer", "QA Tester (Remote)", "Flutter Developer - Cape Town", "Business Analyst", "SOC Analyst",
    "Sales Representative", "Salesforce Developer", "Product Developer", "Software Product Developer", "Full-Stack Engineer", "Intermediate C# Developer", "Team Lead: Mobile Developer", "Principal Architect", "Learnership 2026", "URGENT Junior Developer Ref: ABC123",
    "Developer", "Web Developer | Johannesburg", "Power BI Developer", "Machine Learning Engineer", "Cloud Engineer", "Receptionist", "Trainee Programmer", "Mid-level Backend Developer", "Systems Analyst", "",
)
COMPANIES = ("Acme (Pty) Ltd", "Acme", "Blue Group", "Blue", "Nova Holdings", "", "Orbit Inc.", "Zeta Recruitment")
CITIES = ("Cape Town", "Johannesburg", "", "Durban", "Pretoria")
LOCATIONS = ("Cape Town, Western Cape, South Africa", "Johannesburg, Gauteng", "Remote", "Durban, South Africa")
ROLE_LABELS = ("", "Software Engineer", "Accountant", "Data Engineer", "", "Support Agent", "IT Specialist")
AI_LEVELS = ("", "Junior", "Senior", "mid-level", "intern", "wizard", "Team Lead")
#: (phrase, years that it asks for, level that it names, skills in it)
PHRASES = (
    ("We need at least 3 years' experience in Java.", 3, "", "Java"),
    ("2-4 years of experience required with Python and SQL.", 2, "", "Python, SQL (MySQL/Postgres)"),
    ("Join us on a 3 year contract.", None, "", ""),
    ("With over 100 years of rich history we hire a junior developer.", None, "junior", ""),
    ("Minimum of five years working with C# and .NET.", 5, "", "C#/.NET"),
    ("A graduate programme for people who love React, JS and Node.js.", None, "entry level", "JavaScript, React, Node.js"),
    ("Three (3) years commercial experience; Docker and K8s a plus.", 3, "", "Docker, Kubernetes"),
    ("1 year experience. You will rest and it will go well.", 1, "", ""),
    ("In the past 10 years we have grown. Swift responses expected.", None, "", ""),
    ("Senior engineer wanted with 8+ years of hands-on Golang experience.", 8, "senior", "Go"),
    ("No prior experience needed. HTML5 and CSS3 taught.", None, "entry level", "HTML/CSS"),
    ("You are an intermediate analyst. Experience: 4 years.", 4, "mid", ""),
    ("Swift development on iOS. Less than zero drama.", None, "", "Swift, iOS"),
)
FEED_YEARS = (None, "3", "3-5", "25", "", "2 years", "none")
FEED_SKILLS = ("", "JS, reactjs", "Underwater Basket Weaving", "python,  SQL ", "REST API;", "Excel")
NICE_SKILLS = ("", "Git", "docker, Excel", "Communication")
POLICIES, TYPES = ("remote", "hybrid", "on-site", ""), ("full-time", "contract", "part-time", "")
SOURCES, CURRENCIES, PERIODS = ("api", "search", "network", "html"), ("zar", "ZAR", "usd", ""), ("year", "month", "")
TODAY = "2026-08-22"


def _pick(values: tuple, index: str, dialect: str) -> str:
    quoted = ", ".join("cast(null as string)" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''" if dialect == "duckdb" else "\\'") + "'" for v in values)
    return f"element_at(array({quoted}), cast(({index}) % {len(values)} as int) + 1)" if dialect == "spark" else f"list_extract([{quoted}], cast(({index}) % {len(values)} as int) + 1)"


def sql(dialect: str) -> str:
    """The table as a query on a view documents; ``dialect`` is spark or duckdb."""
    pick = lambda values, index: _pick(values, index, dialect)
    day = "lpad(cast(1 + d % 28 as string), 2, '0')"
    # copies of a document share what depends on the text's length, so that they are posted again
    return f"""
    SELECT d AS _seq, d AS doc_id, {pick(SOURCES, 'd')} AS source, {pick(TITLES, 'k')} AS title, {pick(COMPANIES, 'd')} AS company,
      {pick(CITIES, 'k')} AS city, {pick(LOCATIONS, 'k')} AS location, {pick(ROLE_LABELS, 'd')} AS primary_role, {pick(AI_LEVELS, 'd')} AS job_level,
      CASE WHEN d % 3 = 0 THEN body ELSE {pick(tuple(p for p, *_ in PHRASES), 'k')} || ' ' || body END AS description_snippet,
      {pick(FEED_YEARS, 'd')} AS experience_years, {pick(FEED_SKILLS, 'd')} AS must_have_skills, {pick(NICE_SKILLS, 'd')} AS nice_to_have_skills,
      {pick(POLICIES, 'd')} AS workplace_policy, {pick(TYPES, 'd')} AS employment_type, {pick(CURRENCIES, 'd')} AS salary_currency, {pick(PERIODS, 'd')} AS salary_period,
      CASE WHEN d % 4 = 0 THEN NULL WHEN d % 4 = 1 THEN cast(0 as double) ELSE cast(20000 + 1250 * (d % 37) as double) END AS salary_min,
      CASE WHEN d % 5 = 0 THEN cast(NULL as double) ELSE cast(60000 + 500 * (d % 41) as double) END AS salary_max,
      CASE WHEN d % 11 = 0 THEN '' WHEN d % 13 = 0 THEN 'soon' WHEN d % 17 = 0 THEN '2026-8-' || cast(1 + d % 9 as string) ELSE '2026-08-' || {day} || CASE WHEN d % 7 = 0 THEN 'T09:30:00' ELSE '' END END AS date_posted,
      CASE WHEN d % 19 = 0 THEN '' ELSE '2026-08-' || lpad(cast(10 + d % 13 as string), 2, '0') END AS date_added,
      CASE WHEN d % 9 = 0 THEN '' ELSE ' https://jobs.example/ad/' || cast(d - (CASE WHEN d % 7 = 3 THEN 1 ELSE 0 END) as string) END AS job_url,
      CASE WHEN d % 6 = 0 THEN 'https://indeed.com/cmp/Some-Company-' || cast(d % 50 as string) WHEN d % 6 = 1 THEN 'https://indeed.com/cmp/Avbob?x=1' ELSE '' END AS company_url,
      CASE WHEN d % 2 = 0 THEN 'A short blurb' ELSE '' END AS blurb
    FROM (SELECT cast(doc_id as bigint) AS d, cast(length(coalesce(text, '')) as bigint) AS k, coalesce(text, '') AS body FROM documents) AS base
    """


def adverts(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/documents.parquet").createOrReplaceTempView("_documents_of_adverts")
    return spark.sql(sql("spark").replace("FROM documents)", "FROM _documents_of_adverts)"))

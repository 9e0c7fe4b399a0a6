"""The advert engine: tables of cases, invariants of stages, and sources and sinks on small data."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from vacantia.functions import rules as R
from vacantia.functions import skills as S
from vacantia.functions import text as T
from vacantia.operators import board, dedupe, enrich, extract, history, postings, quality, screen, search
from vacantia.plans import pipeline, registry
from vacantia.sources import cards, feeds, html, listing, quarantine, sinks
from vacantia.streaming import daily, live_board

AD = "_seq long, title string, company string, city string, location string, job_url string, description_snippet string, date_posted string, date_added string"


def one(spark, expression, **values):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())).select(expression.alias("x")).first()["x"]


def each(spark, rows, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text(spark):
    assert each(spark, [r"2\-4  years" + "\n\t x ", None, r"a\\b \d"], "string", T.clean_text) == ["2-4 years x", "", r"a\\b \d"]
    assert each(spark, ["Zoë  Café (Pty)!", None, "A_b-C"], "string", T.normalise) == ["zoë café pty", "", "a_b c"]
    assert each(spark, ["URGENT Java Developer (Remote) Ref: AB12", "Developer - Cape Town", "New York Chef"], "string", T.normalise_title) == ["java developer", "developer", "york chef"]
    assert each(spark, ["Acme (Pty) Ltd", "Blue Group Holdings", "SA Media"], "string", T.normalise_company) == ["acme", "blue", "media"]
    assert each(spark, ["on-site", "full-time", "ENTRY level", None, "o'neil"], "string", T.title_case) == ["On-Site", "Full-Time", "Entry Level", "", "O'Neil"]
    assert each(spark, ["2026-08-01T09:05:00Z", "2026-8-1 9:05:00", "2026-13-40", "2026-8-1", "soon", None], "string", lambda c: F.concat_ws("|", T.parse_date(c)["date"], T.parse_date(c)["time"])) == ["2026-08-01|09:05:00", "2026-08-01|09:05:00", "2026-13-40|", "2026-08-01|", "|", "|"]
    assert each(spark, ["3 days ago", "5 hours ago", "2 weeks ago", "1 month ago", "a day ago", "now"], "string", lambda c: T.relative_date(c, F.to_date(F.lit("2026-08-22")))) == ["2026-08-19", "2026-08-22", "2026-08-08", "2026-07-23", "", ""]
    assert each(spark, ["https://za.indeed.com/cmp/Some-Company-123?x", "https://indeed.com/x", None], "string", T.company_from_url) == ["Some Company", "", ""]
    assert each(spark, ["intro.\nAvbob Group is a leader", "We is a", "nothing"], "string", T.company_from_description) == ["Avbob Group", "", ""]
    assert each(spark, ["14", "2026-08-14T", "2026-13-01", None], "string", T.date_label) == [None, "14 Aug 2026", None, None]
    assert each(spark, ["0", "1", "2.5", "x", None], "string", T.years_label) == ["No experience required", "1+ year experience", "2.5+ years experience", None, None]
    got = each(spark, ["a **b** c", "**x**", "plain", r"\*\*y\*\*", None], "string", T.description_segments)
    assert [[(s.text, s.bold) for s in g] for g in got] == [[("a ", False), ("b", True), (" c", False)], [("x", True)], [("plain", False)], [("y", True)], []]
    assert [one(spark, T.sheet_salary(F.col("a"), F.col("b"), F.lit("zar")), a=a, b=b) for a, b in ((50000.0, 80000.0), (50000.0, 0.0), (0.0, 80000.5), (0.0, 0.0))] == ["ZAR 50,000 - 80,000", "ZAR 50,000+", "Up to ZAR 80,000", ""]
    assert [one(spark, T.percent(F.col("a"), F.col("b")), a=a, b=b) for a, b in ((1, 8), (1, 16), (0, 0))] == [12.5, 6.2, 0.0]


def test_years(spark):
    cases = {
        "at least 3 years' experience": 3, "2-4 years of experience": 2, "2 to 4 years experience": 2, "five years working with Java": 5, "three (3) years commercial experience": 3, "5+ yrs experience": 5, "minimum of 2 years in a similar role, experience": 2,
        "a 3 year contract": None, "over 300 years of combined gaming experience": None, "100 years of rich history": None, "in the past 10 years of experience": None, "25 years experience": None, "20 years experience": 20, "3 year degree": None, "10 years in business": None,
        "2 years experience or 5+ years experience": 2, "": None,
    }
    assert each(spark, list(cases), "string", lambda c: F.array_min(F.transform(extract.year_mentions(c), lambda m: m["years"]))) == list(cases.values())
    assert each(spark, ["3-5", "3", "25", "", None, "about 7", "-1", "2.9", "none"], "string", extract.coerce_years) == [3, 3, None, None, None, 7, None, 2, None]
    emoji = each(spark, ["\U0001f600 é 4 years experience"], "string", extract.year_mentions)[0]
    assert [(m.years, m.pattern, m.start) for m in emoji] == [(4, "plain", 4)]


def test_levels_and_roles(spark):
    titles = ["Junior to Senior Developer", "Internal Auditor", "Intern", "Sr. Engineer", "Head of Data", "Chief", "Leadership coach", None]
    df = spark.createDataFrame([(i, t, None, "", "Team Lead") for i, t in enumerate(titles)], "_seq int, title string, experience_years int, description_snippet string, job_level string")
    rows = extract.with_levels(df).orderBy("_seq").collect()
    assert [r.job_level for r in rows] == ["junior", "unknown", "entry level", "senior", "lead", "principal", "unknown", "unknown"]
    assert {r.ai_job_level for r in rows} == {"lead"}
    twice = extract.with_levels(extract.with_levels(df)).orderBy("_seq").collect()
    assert [(r.job_level, r.ai_job_level) for r in twice] == [(r.job_level, r.ai_job_level) for r in rows]
    assert each(spark, [None, 0, 2, 3, 5, 8], "int", extract.level_from_years) == [None, "entry level", "junior", "mid", "senior", "lead"]
    assert each(spark, ["Software Test Engineer", "Support Engineer", "Power BI Developer", "C# Engineer", "C# Developer", "ASP.NET", "Chef"], "string", lambda c: extract.first_rule(c, R.TITLE_ROLES)) == [R.QA, R.SUPPORT, R.ANALYSIS, None, R.SOFTWARE, R.SOFTWARE, None]
    assert each(spark, ["we use Python", "a data analyst who also does it support analyst work"], "string", lambda c: extract.first_rule(c, R.DESCRIPTION_ROLES)) == [None, R.SUPPORT]


def test_screens(spark):
    assert each(spark, ["Mining Engineer", "Application Support (Mining)", "Salesforce Developer", "Software Product Developer", "Product Developer", "Actuarial Systems Developer"], "string", extract.blocked_title) == ["Mining Engineer", "", "", "", "Product Developer", ""]
    tiers = [("entry level", None, "apply"), ("junior", 2, "apply"), ("junior", 3, "stretch"), ("mid", 3, "stretch"), ("mid", None, "stretch"), ("unknown", None, "stretch"), ("junior", 4, ""), ("senior", None, ""), ("lead", 1, "")]
    df = spark.createDataFrame([(i, level, years, "Developer", "Developer", R.SOFTWARE, "title", "feed", "", "title", "x") for i, (level, years, _) in enumerate(tiers)], "_seq int, job_level string, experience_years int, title string, primary_role string, role_type string, role_source string, years_source string, years_evidence string, level_source string, level_evidence string")
    rows = screen.screened(df).orderBy("_seq").collect()
    assert [r.tier for r in rows] == [t for *_, t in tiers] and [r.kept for r in rows] == [t != "" for *_, t in tiers]
    assert rows[6].needs_review and rows[5].needs_review and not rows[7].needs_review
    assert rows[6].excluded_reason == "asks for 4+ years (from feed: '4 years')" and rows[0].excluded_rule == "role_label:developer"


def matches(spark, texts):
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "i int, text string, word string")
    return [r.skills for r in S.with_matches(df, F.col("text")).orderBy("i").collect()]


def test_skills(spark):
    hay = {
        "Junior JS Developer \n React and Node experience, REST APIs, Postgres": ["JavaScript", "React", "REST APIs", "SQL (MySQL/Postgres)", "Node.js"],
        "We are hiring across the rest of the team this quarter": [], "You'll go the extra mile": [], "We use go-getters who close deals fast": [],
        "Strong JS skills required": ["JavaScript"], "js is sometimes used informally": [], "C# / .NET Developer": ["C#/.NET"], "CI/CD pipelines": ["CI/CD"], "Built with Node.js": ["Node.js"],
        "Strong JavaScript skills required": ["JavaScript"], "We build our API in Go for the backend": [], "Golang Developer": ["Go"], "Taylor Swift is playing this weekend": [],
        "You will build apps in Swift with UIKit experience": ["Swift"], "react-native react \u00a0- native": ["React", "React Native"], ".NET": ["C#/.NET"], "x.NET C++11 Java2": [], "T-SQL": ["SQL (MySQL/Postgres)"],
        "T - SQL": ["SQL (MySQL/Postgres)"], "Objective-C code": ["Swift"], "Objective C code": [], "": [], "A" * 500 + " Java": ["Java"],
    }
    want = {t: sorted(n, key=[s.name for s in S.DEFAULT].index) for t, n in hay.items()}
    assert dict(zip(hay, matches(spark, list(hay)))) == want
    assert matches(spark, [None, "Java", "Java"]) == [[], ["Java"], ["Java"]] and matches(spark, []) == []
    assert each(spark, ["JS, reactjs, Node, Underwater Basket Weaving", "python.; ,PYTHON", None, "Node.js.", " , "], "string", S.canonical_string) == ["JavaScript, React, Node.js", "Python", "", "Node.js", ""]
    assert each(spark, ["Python, Django, PostgreSQL", "Mongo, GCP, Advanced Excel, SQL (MySQL/Postgres)"], "string", S.canonical_string) == ["Python, SQL (MySQL/Postgres), Django", "SQL (MySQL/Postgres), MongoDB/NoSQL, Google Cloud (GCP), Excel (Advanced)"]


def test_vocabulary_is_a_parameter(spark):
    own = (S.Skill("Rock - n - Roll", requires_context=True), S.Skill("Ox", aliases=("..ox yoke",)), S.Skill("Odd (x)"))
    df = spark.createDataFrame([(0, "rock - n - roll code"), (1, "rock-n-roll, the music"), (2, "an ..OX-yoke"), (3, "a..ox yoke"), (4, "ox")], "i int, t string")
    assert [r.found for r in S.with_matches(df, F.col("t"), "found", own).orderBy("i").collect()] == [["Rock - n - Roll"], [], ["Ox"], ["Ox"], ["Ox"]]
    assert [r.found for r in S.with_matches(df, F.col("t"), "found", ()).orderBy("i").collect()] == [[]] * 5


def test_plan_does_not_grow_with_the_vocabulary(spark):
    df = spark.createDataFrame([("x",)], "t string")
    size = lambda n: len(S.with_matches(df, F.col("t"), vocabulary=tuple(S.Skill(f"s{i}") for i in range(n)))._jdf.queryExecution().analyzed().toString())
    assert size(900) <= size(10) + 50


def ads(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], AD)


LONG = "the same long advert text " * 10


def test_dedupe(spark):
    df = ads(spark, [
        ("Developer", "Acme", "Durban", "", "u1", "short", "2026-08-01", ""), ("Developer", "Acme", "Durban", "", " u1 ", "x", "", ""), ("Developer", "Acme (Pty) Ltd", "Durban", "", "u2", "a longer text", "2026-08-02", ""),
        ("Tester", "", "Durban", "", "", LONG, "", ""), ("Tester", "", "Durban", "", "", LONG, "2026-08-03", ""), ("", "B", "", "", "", LONG, "", ""), ("Tester", "Other", "Durban", "", "u3", LONG.upper(), "", ""),
    ])
    out = dedupe.deduplicate(df)
    assert [(r._seq, r.company, r.duplicate_count) for r in out.orderBy("_seq").collect()] == [(0, "Acme (Pty) Ltd", 1), (3, "", 2), (5, "B", 0)]
    again = dedupe.deduplicate(out.drop("duplicate_count"))
    assert again.count() == 3 and dedupe.counts(df).first().asDict() == {"input": 7, "by_url": 1, "by_title_company_city": 1, "by_same_advert_text": 2, "output": 3, "removed": 4}
    assert dedupe.first_by_url(df, drop_blank=True).count() == 3 and quality.duplicates_left(out).first()["duplicates_left"] == 0


def test_keyword_postings(spark, tmp_path):
    """Postings find what a scan finds: nulls, line ends, short and blank keywords, characters of any kind, a part run again."""
    words = ["Java", "C#", None, "", "a\nb", "naïve ÉCOLE", "日本語の仕事", "50% \\d+ [x]", "x" * 5000 + "java", "\U0001f600\U0001f601\U0001f602", "jav a"]
    rows = [(i, w, words[-i], None if i % 3 else "Blurb", f"{w} and {words[i // 2]}", "k", "g") for i, w in enumerate(words)]
    jobs = spark.createDataFrame(rows, "_seq long, title string, company string, blurb string, description_snippet string, keyword string, gram string")
    folder = f"{tmp_path}/postings"
    for part, wanted in (("0", "_seq < 4"), ("1", "_seq >= 4"), ("1", "_seq >= 4")):
        postings.post(jobs.where(wanted), folder, part)
    index = postings.postings(spark, folder)
    asked = ["Java", " java ", "JAV", "C#", "", None, "naïve école", "日本語", "\\d+ [", "a\nb", "\U0001f600\U0001f601\U0001f602", "absent", "and", "xxxxjava", "None and Java"]
    got = {(r.keyword, r._seq) for r in postings.found(jobs, index, asked).collect()}
    assert got == {((k or "").strip().lower(), r._seq) for k in asked for r in jobs.where(search.mentions(k)).collect()} and ("java", 8) in got
    plan = postings.candidates(index, ["java"])._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "In(gram, [ava,jav])" in plan and "PartitionFilters: [bucket" in plan
    assert postings.found(jobs.limit(0), index, ["java", "5"]).count() == 0 and postings.found(jobs, index, []).count() == 0


def test_board(spark):
    old = ads(spark, [("A", "X", "", "", "l1", "old", "2026-08-01", "2026-08-01"), ("B", "Y", "", "", "", "old", "", "2026-08-20"), ("C", "Z", "", "", "l3", "old", "", "")])
    new = ads(spark, [("A2", "X", "", "", "l1", "new", "2026-08-21", ""), ("b", "Y Ltd", "", "", "l9", "new", "", ""), ("B", "Y", "", "", "", "second", "", ""), ("D", "W", "", "", "l4", "new", "2026-08-22", "")])
    rows = board.merge(old, new, "2026-08-22").orderBy("_seq").collect()
    assert [(r._seq, r.title, r.description_snippet, r.date_added) for r in rows] == [(0, "A2", "new", "2026-08-01"), (1, "b", "new", "2026-08-20"), (2, "C", "old", ""), (5, "B", "second", "2026-08-22"), (6, "D", "new", "2026-08-22")]
    aged = ads(spark, [("a", "", "", "", "", "", "2026-08-15", ""), ("b", "", "", "", "", "", "2026-08-14", "2026-08-17"), ("c", "", "", "", "", "", "2026-08-14", "2026-08-16"), ("d", "", "", "", "", "", "bad", ""), ("e", "", "", "", "", "", "2026-8-1", "")])
    assert sorted(r.title for r in board.prune(aged, "2026-08-22").collect()) == ["a", "b", "d"]


def test_search(spark):
    cols = "_seq long, title string, company string, blurb string, description_snippet string, role_type string, job_level string, level_source string, experience_years int, must_have_skills string, nice_to_have_skills string, workplace_policy string, source string, employment_type string, date_posted string, date_added string"
    rows = [(0, "Dev", "A", "", "", "r1", "junior", "title", None, "Java, SQL", "", "remote", "s", "t", "2026-08-01", ""), (1, "Dev", "B", "java!", "", "r1", None, "", 1, "SQL", "Java", "", "s", "t", "", "2026-08-03"), (2, "Ops", "C", "", "", "r2", "mid", "", 5, "", "", "", "s", "", "2026-08-02", "")]
    jobs = spark.createDataFrame(rows, cols)
    assert [r._seq for r in search.search(jobs, search.Criteria(("r1",), (R.JUNIOR,), ("SQL", "Java"))).collect()] == [1, 0]
    assert [r._seq for r in search.search(jobs, search.Criteria(levels=(R.ENTRY,)), order="newest").collect()] == [1, 0]
    assert [r._seq for r in search.search(jobs, search.Criteria(("r1",)), keyword="JAVA").collect()] == [1]
    assert [r._seq for r in search.filter_jobs(jobs, search.Filters(levels=("unknown",))).collect()] == [1]
    assert [r._seq for r in search.filter_jobs(jobs, search.Filters(max_years=2)).orderBy("_seq").collect()] == [0, 1]
    assert [(r.skill, r.n) for r in search.facet_skills(jobs).collect()] == [("Java", 2), ("SQL", 2)]
    assert not search.Criteria(skills=("x",)).can_search() and search.Filters(search="x").active()


def test_feeds(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"jobs": [{"title": "A", "job_url": "u"}]}))
    (tmp_path / "b.json").write_text(json.dumps([{"title": "B"}, {"title": "C"}]))
    (tmp_path / "c.json").write_text("{broken")
    assert sorted(r.title for r in feeds.read_adverts(spark, f"{tmp_path}/*.json").collect()) == ["A", "B", "C"]
    assert feeds.read_adverts(spark, f"{tmp_path}/none.json").count() == 0 and feeds.read_if_there(spark, f"{tmp_path}/none.json") is None and feeds.read_if_there(spark, f"{tmp_path}/a.json").count() == 1
    page = json.dumps({"jobListings": [
        {"name": "Dev", "id": "7", "published_at": "2026-08-01T10:00:00Z", "company_profile": {"name": "Acme", "id": "c1", "tech_stack": [{"title": "Go"}]}, "locations": [{"city": "Cape Town", "country": "South Africa"}], "must_have_skill_experiences": [{"skill": "Java"}, {"skill": "SQL"}], "years_experience": 3},
        {"name": "Abroad", "id": "8", "locations": [{"city": "Berlin", "country": "Germany"}]}]})
    got = feeds.api_pages(spark.createDataFrame([(page,), ('{"jobListings": []}',), ("nope",)], "json string")).collect()
    assert [(r.title, r.company, r.location, r.must_have_skills, r.experience_years, r.date_posted, r.time_posted, r.job_url) for r in got] == [("Dev", "Acme", "Cape Town, South Africa", "Java, SQL", "3", "2026-08-01", "10:00:00", "https://jobs.example/job/7")]
    rows = spark.createDataFrame([("Dev", "not listed", "https://indeed.com/cmp/Big-Co-9", ("Durban", None, None), (0.0, 10.0, "ZAR", "year"), "x", "nan"), ("Dev", None, None, ("", "", ""), None, "Zed Labs is a company", None)], "title string, company_name string, company_url string, location struct<city string, state string, country string>, compensation struct<min_amount double, max_amount double, currency string, interval string>, description string, job_level string")
    got = feeds.search_frame(rows, "search").collect()
    assert [(r.company, r.location, r.city, r.salary_min, r.salary_max, r.salary_currency, r.job_level) for r in got] == [("Big Co", "Durban, South Africa", "Durban", None, 10.0, "ZAR", ""), ("Zed Labs", "South Africa", "", None, None, "", "")]
    parts = {"a": lambda: feeds.conform(rows), "b": lambda: 1 / 0}
    assert feeds.union(parts).count() == 2 and feeds.union(parts, {"a"}) is None
    terms = feeds.search_terms(spark)
    assert [feeds.terms_for(terms, F.to_date(F.lit(d))).count() for d in ("2026-01-01", "2026-01-02")] == [32, 32] and feeds.terms_for(terms, F.current_date(), spread=False).count() == 51
    assert feeds.role_for_term("it support") == R.SUPPORT and feeds.role_for_term("it internship") is None
    assert [len(p) for p in feeds.land_pages(lambda p: [1] * p if p < 4 else None)] == [1, 2, 3]
    calls = []
    with pytest.raises(KeyError):
        feeds.retry(lambda: calls.append(1) or {}["x"], tries=3, sleep=lambda s: calls.append(s))
    assert calls == [1, 2.0, 1, 4.0, 1] and feeds.fetch("http://x.invalid", opener=lambda *a, **k: (_ for _ in ()).throw(OSError())) is None
    old = spark.createDataFrame([("2026-08-01",), ("",), ("2026-08-20",)], "date_posted string")
    assert feeds.within_days(old, dt.date(2026, 8, 22), 10).count() == 2
    ids = [r._seq for r in feeds.numbered(spark.range(50).withColumnRenamed("id", "k"), "k").orderBy("k").collect()]
    assert ids == sorted(set(ids))


LISTING = """<html><body>
<div class="listing"><a href="/jobs--Software-Engineer-CapeTown--123-inline.html">Software Engineer</a><div class="job-details"><img alt="Acme Corp" src="logo.png"/>
 <div class="location">Cape Town, South Africa</div><div>We are looking for a software engineer...</div><div class="posted">2 days ago</div><div>Full time, Permanent</div><div>fully remote</div></div></div>
<div class="listing"><a href="/jobs--Data-Scientist-Johannesburg--456-inline.html">Data Scientist</a><div class="job-details"><img alt="DataCorp" src="logo2.png"/>
 <div>Johannesburg, Gauteng</div><div>Data science role with Python...</div><div>1 week ago</div><div>Contract</div><div>hybrid</div></div></div></body></html>"""


def test_cards(spark):
    long = "long text " * 60
    pages = {
        1: LISTING, 2: None, 3: "", 4: "<div>No results found</div>",
        5: f'<article class="jobs"><a href="/jobs--x--9">More</a><img alt=" Acme "><h2>Junior <b>Dev</b></h2><p>{long}</p>Work from home, part-time<script>contract</script></article>',
        6: '<section><a href="https://a.example/jobs--y--7-inline.html">Tester<br>Easy apply<br>Blue Ltd<br>fixed term</a></b></section><a href="https://a.example/jobs--y--7-inline.html">again</a>',
        7: '<div class="my listing"><p><a href="/jobs--z">Only<br>this</a></p>Outside</div><div><a href="/jobs--no">no</a></div>',
        8: '<a href="/jobs--q--1-inline.html"><img alt=""></a>',
    }
    facts = cards.card_facts(spark.createDataFrame(list(pages.items()), "page_id long, html string"))
    got = {(r.page_id, r.place): r for r in cards.cards(facts, F.to_date(F.lit("2026-08-22")), "https://b.example").collect()}
    show = {k: (r.title, r.company, r.city, r.date_posted, r.workplace_policy, r.employment_type, r.job_url) for k, r in got.items()}
    assert show == {
        (1, 0): ("Software Engineer", "Acme Corp", "Cape Town", "2026-08-20", "remote", "fulltime", "https://b.example/jobs--Software-Engineer-CapeTown--123-inline.html"),
        (1, 1): ("Data Scientist", "DataCorp", "Johannesburg", "2026-08-15", "hybrid", "contract", "https://b.example/jobs--Data-Scientist-Johannesburg--456-inline.html"),
        (5, 0): ("JuniorDev", "Acme", "", "", "remote", "parttime", "https://b.example/jobs--x--9"),
        (6, 0): ("Tester", "Blue Ltd", "", "", "", "contract", "https://a.example/jobs--y--7-inline.html"),
        (7, 0): ("Only", "this", "", "", "", "", "https://b.example/jobs--z"),
    }
    assert got[5, 0].description_snippet == long[:500].strip() and got[1, 0].is_remote and not got[1, 1].is_remote
    assert cards.card_facts(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_trees_take_time_in_proportion():
    import time

    for html_ in ("<div>" * 60_000 + "x", "<a href='/jobs--a--1-inline.html'>" * 20_000 + "</b>" * 20_000 + "x", "<b>" * 30_000 + "</i>" * 30_000):
        began = time.time()
        list(cards.facts_of(html_))
        assert time.time() - began < 5


def walk(rows, oldest=None):
    """Page by page, as someone who reads a term's pages one behind the other."""
    by, kept = {}, []
    for r in rows:
        by.setdefault(r[0], {}).setdefault(r[1], []).append(r)
    for pages in by.values():
        seen, page = set(), 1
        while page in pages:
            new = [r for r in pages[page] if not r[2] or r[2] not in seen]
            seen |= {r[2] for r in pages[page]}
            if not new:
                break
            young = [r for r in new if not oldest or not r[3] or r[3] >= oldest]
            kept += young
            if len(young) < len(new):
                break
            page += 1
    return kept


def test_walks_stop(spark):
    import random

    r = random.Random(4)
    rows = []
    for term in range(60):
        for page in range(1, r.randint(2, 9)):
            if r.random() < 0.9:
                urls = r.sample(range(20), r.randint(0, 3))
                rows += [(f"t{term}", page, f"u{u}", r.choice(["", "2026-08-20", "2026-08-20", "2026-07-01"])) for u in urls] + ([(f"t{term}", page, "", "2026-08-20")] if r.random() < 0.2 else [])
    df = spark.createDataFrame(rows, "term string, page int, job_url string, date_posted string")
    for oldest in (None, "2026-08-01"):
        assert sorted(tuple(x) for x in listing.walked(df, oldest=oldest).collect()) == sorted(walk(rows, oldest))
    assert listing.walked(df.where("false")).count() == 0


def test_paged_source(spark, tmp_path):
    for page, body in {1: '{"items": [1]}', 2: '{"items": [2]}', 3: '{"items": [3]}', 4: '{"items": []}', 5: '{"items": [5]}', 6: "no json"}.items():
        (tmp_path / f"{page}.json").write_text(body)
    read = lambda **o: sorted(r.page for r in listing.read_pages(spark, f"file://{tmp_path}/{{page}}.json", **o).collect())
    assert read(field="items", pages=2) == [1, 2, 3] and read(pages=1) == [1, 2, 3, 4, 5] and read(field="items", most=2) == [1, 2]
    assert listing.read_pages(spark, f"file://{tmp_path}/none{{page}}.json").count() == 0


def test_pages_landed_together(spark, tmp_path):
    """Ranges of pages in folders of their own, parts in any order, up to the first page that is missing or empty in any range."""
    for name, lines in {"0/a": ["2\t[2]", "1\t[1]"], "0/b": ["3\t[3]"], "1/a": ["4\t[4]", "6\t[]", "5\t[5]"], "2/a": ["7\t[7]"]}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    read = lambda **o: sorted((r.page, r.json) for r in listing.read_pages(spark, f"file://{tmp_path}/{{range}}", **o).collect())
    assert read(pages=3) == [(n, f"[{n}]") for n in (1, 2, 3, 4, 5)]
    assert [n for n, _ in read(pages=3, most=3)] == [1, 2, 3] and [n for n, _ in read(pages=3, most=4)] == [1, 2, 3, 4]


def test_paged_source_lands_few_folders(spark, tmp_path):
    """2500 pages are landed in five folders of a file each, not in a folder of several files a page."""
    import glob

    spark.range(125_000).select(F.col("id").alias("event_id"), F.format_string('{"k": %d}', F.col("id")).alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    old = set(glob.glob(f"{pipeline.shared_folder(spark).removeprefix('file:')}/pages-*"))
    assert registry.QUERIES["paged_source"](spark, str(tmp_path)).count() == 36 * 40
    (new,) = set(glob.glob(f"{pipeline.shared_folder(spark).removeprefix('file:')}/pages-*")) - old
    assert len(glob.glob(f"{new}/range=*/*.txt")) == len(glob.glob(f"{new}/range=*")) == 5


def test_quarantine(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("k", LongType()), StructField("s", StringType())])
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n{"k": 2, "s": "x", "more": 1}\n')
    (tmp_path / "b.jsonl").write_text('{"k": 3}\n{"k"\n \n[1]\n{"z": 1}\n{"k": "x"}\nnull\n')
    (tmp_path / "c.jsonl").write_text("<html>\n")
    (tmp_path / "d.jsonl").write_text("\n\n")
    judged = quarantine.judged(quarantine.read_lines(spark, f"{tmp_path}/*.jsonl"), schema)
    good, bad = quarantine.apart(judged)
    assert sorted((r.k, r.s) for r in good.collect()) == [(1, None), (2, "x"), (3, None)]
    assert sorted((r.file[-7], r.reason, r.line) for r in bad.collect()) == [("b", "empty", " "), ("b", "no field", '{"z": 1}'), ("b", "no object", "[1]"), ("b", "no object", "null"), ("b", "not json", '{"k"'), ("b", "wrong type", '{"k": "x"}'), ("c", "not json", "<html>"), ("d", "empty", ""), ("d", "empty", "")]
    assert {r.file[-7]: r.state for r in quarantine.files(judged).collect()} == {"a": "read", "b": "partly read", "c": "corrupt", "d": "empty"}
    for _ in range(2):
        quarantine.write_apart(judged, f"{tmp_path}/out", "1")
    assert spark.read.json(f"{tmp_path}/out/good").count() == 3 and spark.read.json(f"{tmp_path}/out/quarantined").count() == 9


def test_details(spark):
    details = html.parse_details(spark.createDataFrame([("u", '<div class="company-name">Big</div><img class="logo" src="l.png"><div class="job-description"><p>All of it</p></div><dt>Industry</dt><dd>Tech</dd>')], "job_url string, html string"))
    out = html.with_details(spark.createDataFrame([("u", "Old"), ("v", "Kept")], "job_url string, company string"), details).orderBy("job_url").collect()
    assert [(r.company, r.company_logo, r.description_snippet, r.company_industry) for r in out] == [("Big", "l.png", "All of it", "Tech"), ("Kept", "", "", "")]


def test_enrich(spark):
    df = spark.createDataFrame([(i, "T", "C", "d", "", "old", "", "", None, "") for i in range(7)], "_seq long, title string, company string, description_snippet string, primary_role string, must_have_skills string, nice_to_have_skills string, job_level string, experience_years string, blurb string")

    def provider(rows):
        if rows[0]["_seq"] >= 5:
            raise RuntimeError
        return "```json\n" + json.dumps([{"_seq": r["_seq"], "blurb": "b", "must_have_skills": ["X", "Y"]} for r in rows[:-1]] + [{"_seq": 99, "blurb": "?"}]) + "\n```"

    got = {r._seq: (r.blurb, r.must_have_skills) for r in enrich.enrich(df.coalesce(1), provider).collect()}
    assert got == {**{i: ("b", "X, Y") for i in range(4)}, 4: ("", "old"), 5: ("", "old"), 6: ("", "old")}
    assert enrich.enrich(df).count() == 7 and enrich.parse_reply("no") == []


def test_daily_run_is_idempotent(spark, tmp_path):
    from vacantia.plans.job_ads import TODAY, adverts

    rows = adverts(spark, "/root/testdata/sf0.001").where("doc_id < 60")
    assert pipeline.run(rows, TODAY, str(tmp_path)) == 0
    size = lambda n: (pipeline.current_board(spark, str(tmp_path)) if n == "board" else spark.read.parquet(f"{tmp_path}/{n}")).count()
    first = {n: size(n) for n in ("sheet", "excluded", "board")}
    assert pipeline.run(rows, TODAY, str(tmp_path)) == 0
    again = {n: size(n) for n in ("sheet", "excluded", "board")}
    assert again == first  # the same part of the day, rows without a link included
    (tmp_path / "board" / "99999999999999999999").mkdir()  # a version that was never finished
    assert size("board") == again["board"]
    assert first["sheet"] > 0 and again["board"] >= first["board"] and again["sheet"] >= first["sheet"]
    done = spark.read.parquet(f"{tmp_path}/screened/{TODAY}")
    assert done.where("kept").count() + done.where("not kept").count() == spark.read.parquet(f"{tmp_path}/labelled/{TODAY}").count()
    assert "| # |" in quality.tech_sheet(done.where("kept"), 5) and "Target" in quality.level_sheet(done, 5)
    assert {r.column: r.present for r in quality.fingerprints(done, ["tier", "nothing"]).collect()} == {"tier": True, "nothing": False}
    assert [r.n for r in quality.funnel({"a": done, "b": None}).orderBy("place").collect()] == [done.count(), None]


def test_a_failed_sink_is_made_good(spark, tmp_path, monkeypatch):
    """A run that breaks off between the sinks, and is run again, leaves what one whole run leaves."""
    from vacantia.plans.job_ads import TODAY, adverts

    rows = pipeline.materialised(adverts(spark, "/root/testdata/sf0.001").where("doc_id < 60"))
    halves = [(rows.where("_seq < 30"), "0"), (rows.where("_seq >= 30"), "1")]
    out = lambda n: sorted(map(str, (pipeline.current_board(spark, f"{tmp_path}/b").drop("_seq") if n == "board" else spark.read.parquet(f"{tmp_path}/b/{n}")).collect()))
    for part, name in halves:
        assert pipeline.failures(part, TODAY, f"{tmp_path}/b", part=name)[0] == []
    whole = {n: out(n) for n in ("sheet", "excluded", "board")}
    with monkeypatch.context() as m:
        m.setattr(sinks, "new_excluded", lambda *_: 1 / 0)
        assert pipeline.failures(halves[1][0], TODAY, f"{tmp_path}/b", part="1")[0] == ["excluded"]
    assert pipeline.failures(halves[1][0], TODAY, f"{tmp_path}/b", part="1")[0] == []
    assert {n: out(n) for n in whole} == whole


def test_a_part_that_keeps_nothing_still_excludes(spark, tmp_path):
    row = spark.createDataFrame([(0, "Mining Engineer", "C", "u", "d", "")], "_seq long, title string, company string, job_url string, description_snippet string, date_added string")
    full = feeds.conform(row).withColumn("date_added", F.lit(""))
    failed, some = pipeline.failures(full, "2026-08-22", str(tmp_path))
    assert (failed, some) == ([], False) and spark.read.parquet(f"{tmp_path}/excluded").count() == 1
    assert pipeline.run(full, "2026-08-22", str(tmp_path)) == 1


def test_a_stream_batch_with_a_failed_sink_fails(spark, tmp_path, monkeypatch):
    from pyspark.errors import StreamingQueryException

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text(json.dumps({"title": "Junior Java Developer", "company": "C", "job_url": "https://x.example/0", "description_snippet": "d"}) + "\n")
    go = lambda: daily.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2026-08-22", str(tmp_path / "at"), files=1).awaitTermination()
    with monkeypatch.context() as m:
        m.setattr(sinks, "append", lambda *_: 1 / 0)
        with pytest.raises(StreamingQueryException):
            go()
    go()
    assert spark.read.parquet(f"{tmp_path}/out/sheet").count() == 1 and pipeline.current_board(spark, f"{tmp_path}/out").count() == 1


@pytest.mark.parametrize("bits", [8, 1 << 16, 1 << 24])
def test_keys_that_a_table_has(spark, monkeypatch, bits):
    """Whatever the filter passes by, what is left is what an anti-join leaves."""
    monkeypatch.setattr(sinks, "FILTER_BITS", bits)
    rows = spark.createDataFrame([(i, None if i % 10 == 0 else "" if i % 10 == 1 else f"k{i % 400}") for i in range(600)], "i int, key string")
    keys = spark.createDataFrame([(f"k{i}",) for i in range(0, 500, 3)] * 2 + [("",), (None,)], "_k string")
    want = {i for i in range(600) if i % 10 < 2 or not (i % 400) % 3 == 0}
    got = [r.i for r in sinks.without_keys(rows, F.col("key"), keys).collect()]
    assert sorted(got) == sorted(want)
    assert sinks.without_keys(rows, F.col("key"), keys.where("false")).count() == 600


def test_kept_replies(spark, tmp_path):
    cols = "_seq long, title string, company string, description_snippet string, primary_role string, must_have_skills string, nice_to_have_skills string, job_level string, experience_years string, blurb string"
    rows = [(0, "A", "C", "d", "", "", "", "", None, ""), (1, "A", "C", "d", "", "", "", "", None, ""), (2, "B", None, None, "", "", "", "", None, ""), (3, "E", "C", "d", "", "old", "", "", None, ""), (4, "Done", "C", "d", "r", "s", "", "mid", None, "b")]
    df = spark.createDataFrame(rows, cols).coalesce(1)
    log = tmp_path / "asked"

    def provider(rows):
        with log.open("a") as f:
            f.write("".join(r["title"] for r in rows))
        found = [{"job_id": r["job_id"], "blurb": "about " + r["title"], "must_have_skills": ["X", "Y"]} for r in rows if r["title"] != "E"]
        return "```json\n" + json.dumps({"jobs": [*found, {"job_id": 77, "blurb": "?"}]}) + "\n```"

    for asked in ("ABE", "ABEE", "ABEEE"):
        got = {r._seq: (r.blurb, r.must_have_skills) for r in enrich.enrich_kept(df, provider, f"{tmp_path}/replies").collect()}
        assert got == {0: ("about A", "X, Y"), 1: ("about A", "X, Y"), 2: ("about B", "X, Y"), 3: ("", "old"), 4: ("b", "s")}
        assert sorted(log.read_text()) == sorted(asked)
    assert enrich.parse_reply('{"jobs": [{"job_id": 1}]}') == [{"job_id": 1}] and enrich.parse_reply('{"jobs": 3}') == []
    told = enrich.prompt([{"job_id": 1, "title": "Dev", "company": "Acme", "snippet": "text"}])
    assert "[1] Dev at Acme" in told and "job_id" in told and "none" in told


def test_small_helpers(spark):
    """First by identity, newest first, level labels from elsewhere, clean descriptions, the board as a file."""
    rows = ads(spark, [("A", "X", "", "", "l1", "d", "2026-08-01", ""), ("B", "X", "", "", "l1", "d", "2026-08-03", ""), ("A", "X", "", "", "", "d", "2026-08-02", ""), ("A", "X", "", "", "", "d", "", "")])
    assert sorted(r._seq for r in dedupe.first_by_identity(rows).collect()) == [0, 2]
    assert [r._seq for r in feeds.newest_first(rows.withColumn("time_posted", F.lit(""))).collect()] == [1, 2, 0, 3]
    levels = spark.createDataFrame([("ai",), ("title",), ("ai",)], "level_source string")
    assert quality.bad_level_sources(levels).first()[0] == 2


def test_stream_keeps_every_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for day in range(3):
        (tmp_path / "in" / f"{day}.json").write_text(json.dumps({"title": f"Junior Java Developer {day}", "company": f"C{day}", "job_url": f"https://x.example/{day}", "description_snippet": "d"}) + "\n")
    daily.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2026-08-22", str(tmp_path / "at"), files=1).awaitTermination()
    for name in ("labelled", "screened"):
        assert sorted(r.company for r in spark.read.parquet(f"{tmp_path}/out/{name}/2026-08-22").collect()) == ["C0", "C1", "C2"]
    assert pipeline.current_board(spark, f"{tmp_path}/out").count() == 3


def test_sinks(spark, tmp_path):
    assert sinks.isolated({"a": lambda: None, "b": lambda: 1 / 0}, {"b": lambda: (tmp_path / "saved").write_text("x")}) == ["b"] and (tmp_path / "saved").exists()
    old = spark.createDataFrame([("d", "T")], "`Date Job Posted` string, `Job Title` string")
    assert sinks.migrated(old, R.SHEET_COLUMNS).columns == list(R.SHEET_COLUMNS)
    df = ads(spark, [("A", "X", "", "", "l1", "d", "", "")])
    sinks.save_json(df, f"{tmp_path}/out", f"{tmp_path}/csv")
    assert spark.read.json(f"{tmp_path}/out").first().title == "A" and spark.read.option("header", True).csv(f"{tmp_path}/csv").first().title == "A"
    assert sinks.wrapped(df).first()["count"] == 1
    many = df.crossJoin(spark.range(25)).withColumn("_seq", F.col("id")).drop("id")
    assert sorted((r.page, r["count"], [j._seq for j in r.jobs]) for r in sinks.wrapped(many, 10).collect()) == [(0, 10, [*range(10)]), (1, 10, [*range(10, 20)]), (2, 5, [*range(20, 25)])]
    sinks.save_wrapped(many, f"{tmp_path}/wrapped", source=F.lit("x"))
    assert feeds.read_adverts(spark, f"{tmp_path}/wrapped/*.json").count() == 25
    assert [r[0] for r in sinks.latest_first(spark.createDataFrame([("1",), ("3",), ("2",)], "`Date Added to Sheet` string")).collect()] == ["3", "2", "1"]


def test_unreadable_tables_are_not_taken_for_missing_ones(spark, tmp_path):
    (tmp_path / "sheet").mkdir()
    (tmp_path / "sheet" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        sinks.existing(spark, f"{tmp_path}/sheet", R.SHEET_COLUMNS).count()
    assert sinks.existing(spark, f"{tmp_path}/none", R.SHEET_COLUMNS).count() == 0 and pipeline.current_board(spark, f"{tmp_path}/none") is None


def test_command_line(spark, tmp_path, capsys):
    ad = lambda n: {"title": "Junior Java Developer", "company": f"C{n}", "job_url": f"https://x.example/{n}", "description_snippet": "d"}
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(json.dumps({"jobs": [ad(f"{name}1"), ad(f"{name}2")]}))
    feed = [f"--feed={name}={tmp_path}/{name}.json" for name in "ab"]
    main = __import__("vacantia.__main__", fromlist=["main"]).main
    assert main(["--today", "2026-08-22", "run", *feed, "--skip", "b", "--folder", f"{tmp_path}/out"]) == 0
    assert spark.read.parquet(f"{tmp_path}/out/screened/2026-08-22").count() == 2
    assert main(["--today", "2026-08-22", "report", "--folder", f"{tmp_path}/out"]) == 0
    said = capsys.readouterr().out
    assert "# Level review" in said and "# Non-tech review" in said and "# Drops review" in said


def test_company_pages(spark):
    url = "https://za.linkedin.com/company/mind_drift-ai-77?x=1"
    assert one(spark, feeds.company(F.lit("n/a"), F.col("u"), F.lit(""), source="network"), u=url) == "Mind Drift Ai"
    assert one(spark, feeds.company(F.lit(""), F.col("u"), F.lit(""), source="search"), u=url) == ""
    frame = spark.createDataFrame([("T", None, url)], "title string, company_name string, company_url string")
    assert feeds.search_frame(frame, "network").first().company == "Mind Drift Ai"


def test_skill_words_do_not_hide_matches(spark):
    """Every spelling of every skill is found by itself, in any case that its pattern allows, as by its pattern alone."""
    rows = [(i, s.name, t) for i, s in enumerate(S.DEFAULT) for t in S._terms(s)]
    texts = spark.createDataFrame([(i, n, f"We code with {t}, and more") for i, n, t in rows] + [(i, n, f"code ({t.upper()})") for i, n, t in rows], "i int, name string, text string")
    got = {(r.i, r.text): set(r.found) for r in S.with_matches(texts.select("i", "text"), F.col("text"), "found").collect()}
    missed = [(n, t) for i, n, t in rows if n not in got[i, f"We code with {t}, and more"]]
    alone = texts.select("i", "text", *(F.col("text").rlike("(?iU)" + S.pattern(s)).alias(str(k)) for k, s in enumerate(S.DEFAULT) if S.pattern(s) and not s.requires_context)).collect()
    for row in alone:
        want = {S.DEFAULT[int(k)].name for k, hit in row.asDict().items() if k.isdigit() and hit}
        free = {s.name for s in S.DEFAULT if not s.requires_context}
        assert got[row.i, row.text] & free == want
    assert not missed


def test_days_of_duplicates(spark):
    """Days one behind the other leave what one run over all of them leaves, whatever comes again on which day."""
    import random

    r = random.Random(5)
    rows = [(r.choice(["Dev", "Dev ", "QA", ""]), r.choice(["Acme", "Acme Ltd", "Blue", ""]), r.choice(["Cape Town", "Durban"]), (LONG * r.choice([0, 1, 1, 2])) + r.choice(["", "x", "y"]), r.choice(["", "", "u1", "u2", "u3", "u4 "]), r.choice(["2026-08-01", "2026-08-02", ""])) for _ in range(160)]
    cols = "_seq long, title string, company string, city string, location string, description_snippet string, job_url string, date_posted string"
    df = spark.createDataFrame([(i, t, c, p, p, d, u, day) for i, (t, c, p, d, u, day) in enumerate(rows)], cols)
    whole = {tuple(x) for x in dedupe.left_of(df).select("_from", "_seq", "again").collect()}
    for cuts in ((0, 50, 50, 160), (0, 1, 159, 160)):
        kept = None
        for low, high in zip(cuts, cuts[1:]):
            kept = history.fed(kept, df.where(f"_seq >= {low} and _seq < {high}"))
        assert {tuple(x) for x in history.left(kept).collect()} == whole
    n = dedupe.counts(df).first()
    assert n.input == 160 and n.output == len(whole) == n.input - n.by_url - n.by_title_company_city - n.by_same_advert_text
    assert n.input - n.by_url == dedupe.first_by_url(df).count()


def test_spans(spark):
    from vacantia.functions.patterns import spans

    found = lambda t: [(s.start, s.end, s.match) for s in one(spark, spans(F.col("t"), r"\d+"), t=t)]
    assert found("a1 22b333") == [(1, 2, "1"), (3, 5, "22"), (6, 9, "333")] and found("none") == [] and found("") == [] and found("7") == [(0, 1, "7")]


def test_entry_and_registry(spark):
    assert set(registry.ORACLES) <= set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns == ["tier", "job_level", "n"]


def test_adverts_hold_whole_texts(spark, tmp_path):
    texts = ["word " * 300 + "Java", "word " * 300 + "Cobol", "short", None, "é" * 500]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    bodies = {r.doc_id: r.description_snippet for r in registry.adverts(spark, str(tmp_path)).collect()}
    assert all(bodies[i].endswith(t or "") and (i % 3 or bodies[i] == (t or "")) for i, t in enumerate(texts))
    keys = {r.doc_id: r.fingerprint for r in registry.QUERIES["normalise_keys"](spark, str(tmp_path)).collect()}
    assert keys[0] == ("word " * 300 + "java") and keys[1].endswith("cobol")
    found = {r.doc_id for r in registry.QUERIES["keyword_search"](spark, str(tmp_path)).collect()}
    assert 0 in found


def test_sorts_return_all_rows(spark, monkeypatch):
    rows = spark.createDataFrame([(i, i, f"2026-08-{16 + i % 7}", "", None if i % 3 == 0 else i % 8) for i in range(120)], "_seq long, doc_id long, date_posted string, date_added string, experience_years int")
    monkeypatch.setattr(registry, "_board", lambda *_: (rows, rows))
    monkeypatch.setattr(registry.board, "merge", lambda old, *_: old)
    monkeypatch.setattr(registry, "_screened", lambda *_: rows)
    got = sorted((r.place, r._seq) for r in registry.QUERIES["board_sorted"](spark, "").collect())
    assert got == list(enumerate(sorted(range(120), key=lambda i: (-(i % 7), i)), 1))
    years = [(r.doc_id, r.experience_years) for r in registry.QUERIES["sort_years_nulls_last"](spark, "").collect()]
    assert years == sorted(((i, None if i % 3 == 0 else i % 8) for i in range(120)), key=lambda r: (r[1] is None, r[1] or 0, r[0]))


def test_stream_of_the_board_equals_daily_merges(spark, tmp_path):
    """Drops of some days, links with and without stated dates: the stream's board is the one of merge and prune, day by day."""
    r, columns, folder = random.Random(5), "_seq long, title string, company string, city string, location string, job_url string, date_posted string, date_added string", str(tmp_path / "live")
    day = lambda n: f"2026-08-{1 + n:02d}"
    kept, all_ads, totals = spark.createDataFrame([], columns), {}, []
    for nth, at in enumerate((0, 2, 4, 5, 8, 9)):
        rows = [(100 * nth + k, f"t{nth}-{k}", "", "", "", f" https://x/{link} ", r.choice(("", None, day(max(0, at - r.randint(0, 6))))), "") for k, link in enumerate(r.sample(range(30), 9))]
        all_ads |= {row[0]: row[1] for row in rows}
        ads = spark.createDataFrame(rows, columns)
        kept = board.prune(kept, day(at - 1), 3, 2) if at else kept
        kept = pipeline.materialised(board.prune(board.merge(kept, ads, day(at)), day(at), 3, 2))
        copies = ads.withColumn("_seq", F.explode(F.sequence(F.col("_seq"), F.col("_seq") + 5000, F.lit(1000))))
        live_board.land(copies if nth % 2 else ads, F.lit(day(at)).cast("date"), folder)  # copies of a day's adverts change nothing
        if nth == 3:
            live_board.land(ads, F.lit(day(at)).cast("date"), folder)  # nor does a drop that lands twice
            live_board.land(ads.limit(0), F.lit(day(at)).cast("date"), folder)
        run = live_board.start(spark, folder, 3, 2)
        run.awaitTermination()
        totals.append(run.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        now = live_board.as_of(spark.read.schema(live_board.CHANGED).parquet(f"{folder}/changes"), day(at))
        assert sorted((all_ads[x._seq], x.date_added) for x in now.collect()) == sorted((x.title, x.date_added) for x in kept.collect()), at
    seen = spark.read.parquet(f"{folder}/drops").select("identity").distinct().count()
    assert totals[-1] < seen  # timers have freed the states of adverts that left


def test_stream_of_the_board_knows_adverts_without_links(spark, tmp_path):
    """Blank links: title, company and city; where these are blank too, each advert is one of its own. Late days replace nothing."""
    columns, folder = "_seq long, title string, company string, city string, location string, job_url string, date_posted string", str(tmp_path)
    rows = [(0, "Dev", "Acme", "Durban", "", "", None), (1, "dev", "ACME", "durban", "", None, "soon"), (2, "", "", "", "", "", ""), (3, None, None, None, None, None, None), (4, "Dev", "Acme", "Durban", "", "https://x/1", "")]
    for at, ads in (("2026-08-03", rows), ("2026-08-04", [(10, "Dev", "Acme", "Durban", "", " ", "")]), ("2026-08-03", [(20, "Dev", "Acme", "Durban", "", " ", "")])):
        live_board.land(spark.createDataFrame(ads, columns), F.lit(at).cast("date"), folder)
        live_board.start(spark, folder).awaitTermination()
    changes = spark.read.schema(live_board.CHANGED).parquet(f"{folder}/changes")
    got = lambda today: sorted(tuple(x) for x in live_board.as_of(changes, today).select("_seq", "day", "date_added").collect())
    assert got("2026-08-03") == [(s, "2026-08-03", "2026-08-03") for s in (0, 2, 3, 4)]
    assert got("2026-08-04") == [(s, "2026-08-03", "2026-08-03") for s in (2, 3, 4)] + [(10, "2026-08-04", "2026-08-03")]
    assert got("2026-08-10") == got("2026-08-04") and got("2026-08-11") == []


def test_only_words_that_begin_a_spelling_become_rows(spark):
    """Other words of a text are no rows of the join; a vocabulary too large for a pattern finds the same."""
    words = spark.createDataFrame([("plain words of a text " * 50 + "restful Javascript, C++ and c#; .NET REST C",)], "t string")
    seen = words.select(S._surroundings(F.col("t"), S.Spellings.of(S.DEFAULT)).alias("x")).first().x
    assert len(seen) == 7  # restful, Javascript, C++, c#, NET, REST, and C, which "C Sharp" begins with
    many = (*S.DEFAULT, *(S.Skill(f"Skill{i}") for i in range(S.PATTERN_SPELLINGS)))
    few, all_of_them = (S.with_matches(words, F.col("t"), "found", v).first().found for v in (S.DEFAULT, many))
    assert few == all_of_them == ["JavaScript", "REST APIs", "C#/.NET", "C++"]


def test_years_are_looked_for_up_to_their_last_word(spark):
    """What stands behind the last word for years, but for what is looked at there, changes nothing; cutting makes no new word."""
    tail = " word" * 20_000
    texts = ["At least 3 years' experience in Java." + tail, "3 yrs" + " " * 56 + "7 yearlings experience" + tail, "2 years of experience. " + "x" * 500 + " 5-7 YEARS working" + tail, "3 years" + tail + " experience"]
    got = each(spark, texts, "string", lambda c: F.transform(extract.year_mentions(c), lambda m: F.concat_ws("|", m["years"], m["pattern"], m["start"], m["end"])))
    assert got == [["3|at_least|0|16"], [], ["5|range|524|533", "2|plain|0|7"], []]
    cut = each(spark, texts, "string", lambda c: F.length(F.regexp_extract(c, extract.UP_TO_YEARS, 0)))
    assert all(n < 700 for n in cut)


def test_postings_are_the_runs_of_three_characters(spark, tmp_path):
    """Of any characters, once each, lower-cased as columns are; made a batch of texts at a time, not an array of strings a text."""
    texts = ["aAaAa \u00df\u0130x", "\U0001f600\U0001f600y?", "ab", None, "caf\u00e9\n\u65e5\u672c\u8a9e" * 3]
    jobs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_seq long, title string").selectExpr("_seq", "title", "'' as company", "cast(null as string) as blurb", "'' as description_snippet")
    postings.post(jobs, str(tmp_path), "0")
    want = set()
    for row in jobs.select("_seq", postings._fields().alias("t")).collect():
        want |= {(row.t[k : k + 3], row._seq) for k in range(len(row.t) - 2)}
    got = [(r.gram, r._seq) for r in postings.postings(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_capitals_in_a_text_name_skills(spark):
    """As in the reference, a short name in capitals counts wherever it stands between edges, also in a text all in capitals."""
    texts = spark.createDataFrame([(0, "THIN!! WAS!! REST.\nONESEN!!"), (1, "the rest of it"), (2, "RESTS. ARREST")], "i int, t string")
    assert [r.found for r in S.with_matches(texts, F.col("t"), "found").orderBy("i").collect()] == [["REST APIs"], [], []]

"""Scalar functions of advert fields. All are column expressions; a null field counts as an empty one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import ANY_CASE, strip, text

# Noise in titles, suffixes of companies, cities, keywords of the home country.
TITLE_NOISE = (
    r"\((?:remote|hybrid|on[\s\-]?site|contract|temp|perm)[^)]*\)",
    r"\b(?:ref|reference|job id|req)\.?\s*[:#\-]?\s*[A-Za-z0-9\-/]+",
    r"\b(?:urgent|hot job|new|apply now|hiring)\b",
    r"[\-–—|,]\s*(?:cape town|johannesburg|durban|pretoria|centurion|sandton|midrand|port elizabeth|gqeberha|bloemfontein|east london|stellenbosch|gauteng|western cape|kwazulu[\s\-]?natal|south africa|remote|hybrid)\s*$",
)
COMPANY_SUFFIX = r"\b(?:pty\.?\s*ltd\.?|pty\.?|proprietary limited|ltd\.?|limited|inc\.?|incorporated|group|holdings|sa|south africa|recruitment|recruiters)\b"
HOME_KEYWORDS = ("south africa", "cape town", "johannesburg", "durban", "pretoria", "gauteng")
CITIES = ("johannesburg", "cape town", "pretoria", "durban", "sandton", "centurion", "midrand", "stellenbosch", "bryanston", "rosebank", "port elizabeth", "gqeberha", "randburg", "century city", "bellville", "wynberg", "brackenfell", "northern suburbs", "southern suburbs", "somerset west", "parktown", "gauteng", "western cape", "kwazulu-natal")
GENERIC_OPENERS = ("we", "our company", "the company", "this role")
NOT_LISTED = ("", "nan", "none", "nat")
MATCHABLE_DESCRIPTION = 200


def clean_text(c: Column, longest: int | None = None) -> Column:
    """Stripped, Markdown's backslashes undone, white space collapsed, cut and stripped again."""
    out = F.regexp_replace(F.regexp_replace(strip(text(c)), r"\\([-+*_`#\[\]{}()!.>|~])", "$1"), r"(?U)\s+", " ")
    return out if longest is None else F.when(F.length(out) > longest, strip(F.substring(out, 1, longest))).otherwise(out)


def parse_date(c: Column) -> Column:
    """struct<date, time>: an ISO prefix as it stands, else a few formats without leading zeros, else empty strings."""
    s = text(c)
    both, day = r"^(\d{4}-\d{2}-\d{2})[T\s](\d{2}:\d{2}:\d{2})", r"^(\d{4}-\d{2}-\d{2})"
    loose = F.coalesce(*(F.try_to_timestamp(s, F.lit(f)) for f in ("y-M-d H:m:s", "y-M-d'T'H:m:s'Z'", "y-M-d'T'H:m:s.SSSSSS'Z'")))
    plain = F.try_to_timestamp(s, F.lit("y-M-d"))
    pair = lambda a, b: F.struct(a.alias("date"), b.alias("time"))
    return (
        F.when(s.rlike(both), pair(F.regexp_extract(s, both, 1), F.regexp_extract(s, both, 2)))
        .when(s.rlike(day), pair(F.regexp_extract(s, day, 1), F.lit("")))
        .when(loose.isNotNull(), pair(F.date_format(loose, "yyyy-MM-dd"), F.date_format(loose, "HH:mm:ss")))
        .when(plain.isNotNull(), pair(F.date_format(plain, "yyyy-MM-dd"), F.lit("")))
        .otherwise(pair(F.lit(""), F.lit("")))
    )


def sort_key(date: Column, time: Column) -> Column:
    return F.when(text(date) == "", F.lit("0000-00-00T00:00:00")).otherwise(F.concat(F.substring(date, 1, 10), F.lit("T"), F.when(text(time) == "", F.lit("00:00:00")).otherwise(F.substring(time, 1, 8))))


def relative_date(c: Column, today: Column) -> Column:
    """'3 days ago' and the like as a date, hours and minutes as today; '' if it has no number or no unit. Months have 30 days."""
    s = F.lower(text(c))
    n = F.regexp_extract(s, r"(\d+)", 1).try_cast("int")
    back = F.when(s.rlike("hour|minute"), F.lit(0)).when(s.contains("day"), n).when(s.contains("week"), n * 7).when(s.contains("month"), n * 30)
    return F.coalesce(F.date_format(F.date_sub(today, back), "yyyy-MM-dd"), F.lit(""))


def as_date(c: Column) -> Column:
    """The first ten characters as a date, leading zeros or not; else null."""
    return F.try_to_date(F.substring(text(c), 1, 10), "y-M-d")


def normalise(c: Column) -> Column:
    """Lower case; whatever is no letter, digit or underscore becomes one space, and none stands at an end."""
    return F.trim(F.regexp_replace(F.lower(text(c)), r"(?U)\W+", " "))


def normalise_title(c: Column) -> Column:
    out = text(c)
    for noise in TITLE_NOISE:
        out = F.regexp_replace(out, ANY_CASE + noise, " ")
    return normalise(out)


def normalise_company(c: Column) -> Column:
    return normalise(F.regexp_replace(text(c), ANY_CASE + COMPANY_SUFFIX, " "))


def normalise_city(city: Column, location: Column) -> Column:
    return normalise(F.coalesce(F.nullif(text(city), F.lit("")), F.split(text(location), ",")[0]))


def fingerprint(c: Column) -> Column:
    """The normalised text where it is long enough to tell adverts apart, else ''."""
    s = normalise(c)
    return F.when(F.length(s) >= MATCHABLE_DESCRIPTION, s).otherwise("")


def company_from_url(c: Column, host: str = "indeed.com/cmp/", title: bool = False) -> Column:
    """The company's slug as a name, without a number at its end."""
    slug = F.regexp_replace(strip(F.regexp_extract(text(c), host.replace(".", r"\.") + r"([^/?#]+)", 1)), r"-\d+$", "")
    name = strip(F.regexp_replace(slug, "[-_]", " "))
    return title_case(name) if title else name


def company_from_description(c: Column) -> Column:
    """Who 'X is a ...' at the start of a line of the first 800 characters names."""
    name = strip(F.regexp_extract(F.substring(text(c), 1, 800), r"(?m)^([A-Z][A-Za-z0-9&\s\-\.]{1,49}?)\s+is\s+(?:a|an|the)\b", 1))
    return F.when(F.lower(name).isin(*GENERIC_OPENERS), F.lit("")).otherwise(name)


def title_case(c: Column) -> Column:
    """Each run of letters starts upper-case and goes on lower-case, also after a hyphen."""
    runs = F.regexp_extract_all(text(c), F.lit(r"(?U)\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))), "")


def sheet_salary(low: Column, high: Column, currency: Column) -> Column:
    a, b, cur = F.nullif(low, F.lit(0.0)), F.nullif(high, F.lit(0.0)), F.upper(text(currency))
    show = lambda x: F.format_number(x, 0)
    return F.when(a.isNotNull() & b.isNotNull(), F.concat(cur, F.lit(" "), show(a), F.lit(" - "), show(b))).when(a.isNotNull(), F.concat(cur, F.lit(" "), show(a), F.lit("+"))).when(b.isNotNull(), F.concat(F.lit("Up to "), cur, F.lit(" "), show(b))).otherwise("")


def card_salary(low: Column, high: Column, currency: Column, period: Column) -> Column:
    """As on a card: up to three decimals, the period, null where nothing is known."""
    a, b, cur = F.nullif(low, F.lit(0.0)), F.nullif(high, F.lit(0.0)), text(currency)
    per = F.when(text(period) == "", F.lit("")).otherwise(F.concat(F.lit("/"), period))
    show = lambda x: F.regexp_replace(F.format_number(x, 3), r"\.?0+$", "")
    return F.trim(F.when(a.isNotNull() & b.isNotNull(), F.concat(cur, F.lit(" "), show(a), F.lit(" - "), show(b), per)).when(a.isNotNull(), F.concat(cur, F.lit(" "), show(a), F.lit("+"), per)).when(b.isNotNull(), F.concat(F.lit("Up to "), cur, F.lit(" "), show(b), per)))


def bullets(c: Column) -> Column:
    return F.when(text(c) == "", F.lit("")).otherwise(F.concat(F.lit("• "), F.replace(text(c), F.lit(", "), F.lit("\n• "))))


def years_label(c: Column) -> Column:
    n = text(c.cast("string")).try_cast("double")
    shown = F.regexp_replace(n.cast("string"), r"\.0$", "")
    return F.when(n == 0, "No experience required").when(n == 1, F.concat(shown, F.lit("+ year experience"))).otherwise(F.concat(shown, F.lit("+ years experience")))


def level_label(c: Column) -> Column:
    return F.when((text(c) != "") & (c != "unknown"), F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2))))


def date_label(c: Column) -> Column:
    """'14 Aug 2026', by the digits alone; null without them."""
    s = text(c)
    month = F.regexp_extract(s, r"^\d{4}-(\d{2})-\d{2}", 1).try_cast("int")
    names = F.array(*map(F.lit, "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()))
    return F.when(month.between(1, 12), F.concat_ws(" ", F.regexp_extract(s, r"^\d{4}-\d{2}-(\d{2})", 1).try_cast("int").cast("string"), F.try_element_at(names, month), F.substring(s, 1, 4)))


def job_date_label(posted: Column, added: Column) -> Column:
    return F.coalesce(F.concat(F.lit("Posted "), date_label(posted)), F.concat(F.lit("Added "), date_label(added)))


def clean_description(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text(c), r"\\([&+\-*_#.])", "$1"), r"\*{3,}", "**"))


def description_segments(c: Column) -> Column:
    """array<struct<text, bold>> of runs between and within **bold** marks; nothing is lost."""
    s = clean_description(c)
    bold = r"\*\*([\s\S]+?)\*\*"
    gaps, marks = F.split(s, bold, -1), F.regexp_extract_all(s, F.lit(bold), F.lit(1))
    run = lambda t, b: F.struct(t.alias("text"), F.lit(b).alias("bold"))
    both = F.flatten(F.transform(gaps, lambda g, i: F.when(i < F.size(marks), F.array(run(g, False), run(F.get(marks, i), True))).otherwise(F.array(run(g, False)))))
    return F.filter(both, lambda r: r["text"] != "")


def report_cell(c: Column, longest: int = 60) -> Column:
    s = strip(F.replace(F.replace(text(c), F.lit("|"), F.lit("/")), F.lit("\n"), F.lit(" ")))
    return F.when(F.length(s) > longest, F.concat(strip(F.substring(s, 1, longest)), F.lit("..."))).otherwise(s)


def split_list(c: Column) -> Column:
    """A comma-separated field as an array, blanks dropped."""
    return F.filter(F.transform(F.split(text(c), ","), strip), lambda x: x != "")


def known_city(location: Column, cities: tuple[str, ...] = CITIES) -> Column:
    """The first city of the list that the location names, else its first part."""
    s = text(location)
    return F.coalesce(*(F.when(F.lower(s).contains(x), F.lit(x.title())) for x in cities), strip(F.split(s, ",")[0]))


def at_home(location: Column) -> Column:
    s = F.lower(text(location))
    return F.exists(F.array(*map(F.lit, HOME_KEYWORDS)), lambda k: s.contains(k))


def job_url(company_id: Column, job_id: Column, base: str = "https://jobs.example") -> Column:
    """The advert's own page if it has an id, else the company's, else ''."""
    return F.when(text(job_id) != "", F.concat(F.lit(f"{base}/job/"), job_id)).when(text(company_id) != "", F.concat(F.lit(f"{base}/company/"), company_id)).otherwise("")


def identity(url: Column, title: Column, company: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text(url)), F.lit("")), F.lower(F.concat(text(title), F.lit("|"), text(company))))


def percent(part: Column, whole: Column) -> Column:
    """One decimal, halves to even; 0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.bround(100.0 * part / whole, 1))


def known_cell(c: Column) -> Column:
    """A feed's cell, null where it says nan, none or the like."""
    s = c.cast("string")
    return F.when(~F.lower(F.trim(s)).isin(*NOT_LISTED), s)

"""Who a headline is about and when it appeared: subjects, company keys, source names, dates with confidence."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions import dates
from tidewater.functions.text import first_text, normalized, strip_publisher

# Fixed values.
ENTITY_STOPWORDS = (
    "inc", "corp", "corporation", "company", "co", "ltd", "limited", "group",
    "holdings", "holding", "technologies", "technology", "tech", "systems",
    "platform", "platforms", "analytics", "computing", "apps", "app", "software",
    "ai", "digital", "global", "online", "the", "amazon", "fulfillment",
    "competitor", "more", "than", "korea", "regional", "local", "studio",
    "busan", "cloud", "hands", "training", "startups",
)
COMPANY_SUFFIXES = ("inc", "incorporated", "limited", "ltd", "corporation", "corp", "holdings", "technologies", "technology", "plc", "ag")
SOURCE_SUFFIXES = (" Developer Changelog", " Changelog", " Newsroom", " IR News", " IR", " Press", " News")
FINANCIAL_NEGATIVES = ("down", "drop", "falls", "fall", "fell", "loss", "losses", "miss", "misses", "decline", "declines", "plunge", "plunges", "slump", "下滑", "下降", "亏损")
#: Verb groups that follow a subject, in the order in which they are tried.
RAISED = "raises?|raised|secures?|secured|closes?|closed"
VALUED = "doubles?|doubled|hits?|hit|reaches?|reached|is\\s+valued|was\\s+valued|valued"
OBTAINED = "lands?|landed|bags?|bagged|gets?|got|receives?|received|attracts?|attracted|wins?|won"
BOUGHT = "acquires?|acquired|buys?|bought|purchases?|purchased|merges?|merged"
ANNOUNCED = "announces?|announced|reports?|reported|posts?|posted|files?|filed|plans?|planned|launches?|launched|expands?|expanded|partners?|partnered"

_WORD = "\\b([A-Z][A-Za-z0-9.\\-]{2,})"
_NAME = "^([A-Z][A-Za-z0-9\\s&.,'\\-’]+?)"
#: One word before a verb, then whole names at the start of the headline.
SUBJECT_PATTERNS = tuple(f"(?i){who}\\s+(?:{verbs})\\b" for who, verbs in ((_WORD, RAISED), (_WORD, VALUED), (_NAME, f"{RAISED}|{OBTAINED}"), (_NAME, VALUED), (_NAME, BOUGHT), (_NAME, ANNOUNCED)))
HEADLINE_PREFIX = "^[^A-Za-z0-9\\u4e00-\\u9fff]{0,3}[^:]{2,36}:\\s*"
QUESTION_PREFIX = "(?i)^(?:why|how|what|when|where|inside|after)\\s+"
MONTH_DAY = "(?i)\\b(jan|feb|mar|apr|may|jun|jul|aug|sept|sep|oct|nov|dec)(?:uary|ruary|ch|il|e|y|ust|tember|ober|ember)?\\.?\\s+([0-9]{1,2})(?:st|nd|rd|th)?\\b"


def subject_words(subject: Column, stop: Iterable[str] = ENTITY_STOPWORDS, most: int = 4) -> Column:
    """The first ``most`` words of a normalised subject that are no stop words and longer than one letter; '' if none."""
    words = F.split(normalized(subject), " ")
    kept = F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*stop))
    return F.array_join(F.slice(kept, 1, most), " ")


def title_subject(title: Column) -> Column:
    """The acting subject of a headline by ``SUBJECT_PATTERNS``: the first that leaves a key; '' if none does.

    Make it a column of its own where several others use it.
    """
    clean = F.regexp_replace(F.trim(strip_publisher(title)), HEADLINE_PREFIX, "")

    def key(found: Column) -> Column:
        subject = F.regexp_replace(F.regexp_replace(F.trim(found), "^[,;:\\-]+|[,;:\\-]+$", ""), QUESTION_PREFIX, "")
        return F.when(F.length(subject).between(2, 60), F.nullif(subject_words(subject), F.lit("")))

    # An array of one binds the cleaned headline, so that it is made once for all patterns.
    keys = F.flatten(F.transform(F.array(clean), lambda c: F.transform(F.array(*(F.regexp_extract(c, p, 1) for p in SUBJECT_PATTERNS)), key)))
    return F.coalesce(F.try_element_at(F.array_compact(keys), F.lit(1)), F.lit(""))


def event_subject(company: Column, companies: Column, subject: Column) -> Column:
    """Key of the company, else of the first listed company, else ``subject`` (see ``title_subject``)."""
    first = F.try_element_at(companies, F.lit(1))
    return F.coalesce(F.nullif(subject_words(company), F.lit("")), F.nullif(subject_words(first), F.lit("")), subject)


def display_subject(company: Column, companies: Column, subject: Column) -> Column:
    """As ``event_subject``, but the headline's subject decides first."""
    first = F.try_element_at(companies, F.lit(1))
    return F.coalesce(F.nullif(subject, F.lit("")), F.nullif(subject_words(company), F.lit("")), subject_words(first))


def company_key(name: Column) -> Column:
    """Normalised name without legal suffixes at its end, at most four words; a name of suffixes alone keeps its first word."""
    plain = normalized(name)
    bare = F.trim(F.regexp_replace(plain, f"(?:(?:^| )(?:{'|'.join(COMPANY_SUFFIXES)}))+$", ""))
    kept = F.coalesce(F.nullif(bare, F.lit("")), F.substring_index(plain, " ", 1))
    return F.substring_index(kept, " ", 4)


def source_entity(source: Column) -> Column:
    """A source's name without the first of ``SOURCE_SUFFIXES`` that ends it."""
    name = F.trim(F.coalesce(source, F.lit("")))
    return F.coalesce(*(F.when(name.endswith(s), F.trim(F.regexp_replace(name, f"{s}$", ""))) for s in SOURCE_SUFFIXES), name)


def source_metric_key(*columns: Column) -> Column:
    """The first name that is not blank, else '未知来源'."""
    return F.coalesce(first_text(*columns), F.lit("未知来源"))


def reports_loss(title: Column) -> Column:
    """Whether a headline holds a word of financial decline, anywhere."""
    return F.coalesce(F.lower(title).rlike("|".join(FINANCIAL_NEGATIVES)), F.lit(False))


def recent_month_day(text: Column, as_of: Column) -> Column:
    """The first 'Month d' of a text in the latest year, this or the last, that is not after ``as_of``; else null."""
    month = F.position(F.lower(F.substring(F.regexp_extract(text, MONTH_DAY, 1), 1, 3)), F.lit("jan feb mar apr may jun jul aug sep oct nov dec"))
    day = F.regexp_extract(text, MONTH_DAY, 2)
    found = []
    for back in (0, 1):
        date = dates.strict_date(F.concat_ws("-", (F.year(as_of) - back).cast("string"), F.lpad(((month + 3) / 4).cast("int").cast("string"), 2, "0"), F.lpad(day, 2, "0")))
        found.append(F.when(date <= as_of, date))
    return F.when(F.coalesce(text, F.lit("")).rlike(MONTH_DAY), F.coalesce(*found))


def article_date(url: Column, title: Column, body: Column, observed: Column, slack_days: int = 1) -> Column:
    """struct(published_at, scheduled_at, basis, confidence) of an official article.

    Candidates in order: the URL (high), the title (medium), a full date in the
    body (low), 'Month d' in a body without one (low).  The first that is not
    later than ``observed`` plus the slack is the publication; if all are later
    the first is the schedule; without any the basis is 'observed_at'.
    """
    full = dates.date_in_text(body)
    options = [(dates.date_in_url(url), "url_path", "high"), (dates.date_in_text(title), "title_text", "medium"), (full, "body_text", "low"), (F.when(full.isNull(), recent_month_day(body, observed)), "body_month_day", "low")]
    found = F.array_compact(F.array(*(F.when(day.isNotNull(), F.struct(day.alias("day"), F.lit(basis).alias("basis"), F.lit(sure).alias("confidence"))) for day, basis, sure in options)))
    latest = F.date_add(observed, slack_days)

    def decided(candidates: Column) -> Column:
        good = F.try_element_at(F.filter(candidates, lambda c: c["day"] <= latest), F.lit(1))
        either = F.coalesce(good, F.try_element_at(candidates, F.lit(1)))
        return F.struct(
            good["day"].alias("published_at"),
            F.when(good.isNull(), either["day"]).alias("scheduled_at"),
            F.coalesce(either["basis"], F.lit("observed_at")).alias("basis"),
            F.coalesce(either["confidence"], F.lit("observed")).alias("confidence"),
        )

    # An array of one binds the candidates, so that each date is read once and not once a field.
    return F.element_at(F.transform(F.array(found), decided), 1)

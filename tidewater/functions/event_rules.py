"""Rules on single reports that dedupe and intake decide by: similarity tokens, anchors, polarity, noise."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.subjects import company_key
from tidewater.functions.text import found_terms, has_any, has_substring, strip_publisher

# Fixed values.
TITLE_STOPWORDS = (
    "the", "and", "for", "with", "from", "into", "over", "under", "amid", "after",
    "before", "across", "through", "about", "says", "report", "reports", "reported",
    "launch", "launches", "launched", "announces", "announced", "latest",
    "today", "week", "news", "update", "live", "analysis", "opinion",
)
SHORT_TOKENS = ("q1", "q2", "q3", "q4", "ai", "ipo")
FACT_STOPWORDS = (
    "the", "a", "an", "to", "for", "of", "in", "on", "and", "with", "from",
    "raises", "raised", "funding", "acquires", "acquire", "acquisition",
    "launches", "launch", "announces", "new", "company", "startup", "report",
)
HARD_TYPES = ("funding", "ma", "earnings")
TYPE_PRIORITY = ("funding", "ma", "earnings", "industry_report", "model_release", "regional_policy", "strategy", "other")
GENERIC_ALIASES = ("line", "sea", "noon", "grab", "stc", "jd", "mo", "tab", "tabby", "allegro")
EARNINGS_ANCHORS = (
    "revenue", "earnings", "profit", "quarter", "quarterly", "result",
    "financial", "fiscal", "income", "operating", "net income",
    "财报", "营收", "净利", "净亏", "決算", "営業利益", "純利益", "増収", "減益",
)
FUNDING_ANCHORS = (
    "raise", "raises", "raised", "funding", "seed", "valuation", "valued",
    "investment", "secures", "secured", "closes", "closed", "bags", "landed",
    "$", "€", "£", "series ", "unicorn", "融资", "調達", "出資", "億円",
    "ipo", "listing", "filing", "registration", "上市", "上場",
)
MA_ANCHORS = (
    "acquires", "acquired", "acquisition", "merger", "merges", "merging",
    "buys", "buying", "purchase", "takeover", "收购", "并购", "買収", "合併",
)
LOW_SIGNAL_PATTERNS = (
    "earnings call highlights", "earnings snapshot", "transcript :",
    "stock is trending", "price prediction", "shares bought by",
    "live score", "predictions", "gift (nasdaq", "simplywall.st",
    "marketbeat", "benzinga", "seeking alpha", "openpr.com",
    "upgraded points", "sofascore",
    "analyst target", "analyst ratings", "target price", "price target",
    "valuation check", "stock focus", "stock analysis", "stock forecast",
    "stock to buy", "brokerages set", "short interest", "dividend yield",
    "institutional investors", "etf inflows", "options trading",
    "ticker report", "defense world", "american banking news",
    "zacks", "motley fool", "investing.com", "insider monkey",
    "yahoo finance", "tipranks", "simply wall st", "ad hoc news",
    "indexbox", "phishing", "password", "urgent alert",
    "promo:", "bonus", "points", "earn up to", "stock price",
    "shares fall", "shares jump", "shares slide", "stock price forecast",
    "gf score", "strong investment opportunity", "xrp", "crypto",
    "token", "stablecoin", "crypto exchange", "trial", "arrested",
    "prison", "graft", "corruption", "local elections",
    "social media traffic", "comparison", "tech times",
)


def _folded(title: Column) -> Column:
    return F.lower(F.coalesce(title, F.lit("")))


def plain_title(title: Column) -> Column:
    """Without publisher, in lower case, '&' as 'and', all but ASCII letters, digits and CJK as single blanks."""
    words = F.replace(F.lower(strip_publisher(title)), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(words, "[^a-z0-9\\u4e00-\\u9fff]+", " "))


def event_tokens(title: Column, plain: Column | None = None) -> Column:
    """The distinct tokens by which reports are compared: no stop words, no numbers, no short ones but a few.

    ``plain`` is a column of the plain title, where there is one.
    """
    kept = F.filter(F.split(plain_title(title) if plain is None else plain, " "), lambda t: ~t.isin(*TITLE_STOPWORDS) & ((F.length(t) > 2) | t.isin(*SHORT_TOKENS)) & ~t.rlike("^[0-9]+$"))
    return F.array_distinct(kept)


def fact_tokens(title: Column) -> Column:
    """The distinct tokens by which facts are compared: words with inner dots, plus and hyphens, and runs of CJK."""
    found = F.regexp_extract_all(_folded(title), F.lit("[a-z0-9][a-z0-9.+-]*|[\\u4e00-\\u9fff]{2,}"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda t: ~t.isin(*FACT_STOPWORDS) & (F.length(t) > 1)))


def primary_type(types: Column) -> Column:
    """The type of highest priority, else the first; 'other' without any."""
    known = F.coalesce(*(F.when(F.array_contains(types, t), F.lit(t)) for t in TYPE_PRIORITY), F.try_element_at(types, F.lit(1)))
    return F.coalesce(known, F.lit("other"))


def anchored(kind: Column, title: Column) -> Column:
    """Whether a title carries the anchor of its type; types without anchors do."""
    title = _folded(title)
    earnings = title.rlike("\\bq[1-4]\\b") | has_substring(title, EARNINGS_ANCHORS)
    funding = title.rlike("\\bseries\\s+[a-e]\\b") | has_substring(title, FUNDING_ANCHORS)
    return F.when(kind == "earnings", earnings).when(kind == "funding", funding).when(kind == "ma", has_substring(title, MA_ANCHORS)).otherwise(True)


def low_signal_title(title: Column) -> Column:
    """Whether a company's headline is about quotes, ratings, promotions or courts."""
    return has_substring(_folded(title), LOW_SIGNAL_PATTERNS)


def mentions_alias(title: Column, aliases: Column, plain: Column | None = None) -> Column:
    """Whether a title holds one of an array of aliases, as whole words or with all blanks left out.

    ``plain`` is a column of the plain title, where there is one.
    """
    plain = plain_title(title) if plain is None else plain

    def said(words: Column) -> Column:
        tight = F.replace(words, F.lit(" "), F.lit(""))
        return (words != "") & (F.concat(F.lit(" "), plain, F.lit(" ")).contains(F.concat(F.lit(" "), words, F.lit(" "))) | F.replace(plain, F.lit(" "), F.lit("")).contains(tight))

    return F.coalesce(F.exists(F.transform(aliases, plain_title), said), F.lit(False))


def alias_in_title(title: Column, aliases: Iterable[str]) -> Column:
    """The longest alias (equal lengths: the first in the alphabet) in a title; short and generic ones do not count."""
    terms = [a for a in aliases if len(a) >= 3 and a.lower() not in GENERIC_ALIASES]
    if not terms:
        return F.lit(None).cast("string")
    ranked = F.transform(found_terms(_folded(title), terms), lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))
    return F.array_min(ranked)["t"]


def entity_key(company: Column, alias: Column, subject: Column) -> Column:
    """struct(key, source): by the company's name, else an alias of the title, else the title's subject."""
    by_company, by_alias = F.nullif(company_key(F.coalesce(company, F.lit(""))), F.lit("")), F.nullif(company_key(F.coalesce(alias, F.lit(""))), F.lit(""))
    key = F.coalesce(by_company, by_alias, subject, F.lit(""))
    source = F.when(by_company.isNotNull(), "company").when(by_alias.isNotNull(), "alias").when(F.coalesce(subject, F.lit("")) != "", "title").otherwise("none")
    return F.struct(key.alias("key"), source.alias("source"))


def names_excluded(title: Column, names: Iterable[str], domains: Iterable[str], official: Column) -> Column:
    """Whether a title names an excluded company (at word boundaries) or domain; official sources are exempt."""
    title = _folded(title)
    return ~F.coalesce(official, F.lit(False)) & (has_any(title, names) | has_substring(title, domains))


def bank_report(title: Column, company: Column, publisher: Column, own: Column, banks: Iterable[str], exempt: Iterable[str]) -> Column:
    """Whether a report is about one of ``banks`` and none of ``exempt``; a company's own reports are not."""
    text = F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in (title, company, publisher))))
    return ~F.coalesce(own, F.lit(False)) & has_substring(text, banks) & ~has_substring(text, exempt)

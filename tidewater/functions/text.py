"""Text functions over columns: term matching, normalised keys, token sets, escapes."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A title and its publisher are parted by one of these, tried in order.
TITLE_SEPARATORS = (" - ", " | ", " – ", " — ")
_HTML = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))


def _quoted(term: str) -> str:
    return re.sub(r"([\\.+*?()|\[\]{}^$])", r"\\\1", term.lower())


def has_any(text: Column, terms: Iterable[str]) -> Column:
    """Whether a term occurs: terms with ASCII letters or digits at word boundaries, others anywhere.

    ``text`` must be lower case.  One alternation is matched per call; null text
    and an empty term list give false.
    """
    words = [t for t in terms if re.search("[a-zA-Z0-9]", t)]
    plain = [t for t in terms if not re.search("[a-zA-Z0-9]", t)]
    found = F.lit(False)
    if words:
        found = found | F.coalesce(text, F.lit("")).rlike("(^|[^a-z0-9])(" + "|".join(map(_quoted, words)) + ")([^a-z0-9]|$)")
    for term in plain:
        found = found | F.coalesce(text, F.lit("")).contains(term.lower())
    return found


def found_terms(text: Column, terms: Iterable[str]) -> Column:
    """The distinct terms that occur in lower-case ``text``, by the rule of ``has_any``.

    Single words are looked up in a hash set, phrases are one alternation tried
    at word starts.  Of phrases that begin at one place the longest is listed;
    ``any_found`` knows the shorter ones that it implies.
    """
    terms = sorted({t.lower() for t in terms}, key=lambda t: (-len(t), t))
    text = F.coalesce(text, F.lit(""))
    words = [t for t in terms if re.fullmatch("[a-z0-9]+", t)]
    phrases = [t for t in terms if re.search("[a-z0-9]", t) and t not in words]
    found = []
    if words:
        found.append(F.filter(F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0)), lambda w: w.isin(*words)))
    if phrases:
        found.append(F.regexp_extract_all(text, F.lit(f"(?<![a-z0-9])(?=({'|'.join(map(_quoted, phrases))})(?![a-z0-9]))"), F.lit(1)))
    found += [F.array_compact(F.array(F.when(text.contains(t), F.lit(t)))) for t in terms if not re.search("[a-z0-9]", t)]
    return F.array_distinct(F.concat(*found)) if found else F.array().cast("array<string>")


def any_found(found: Column, terms: Iterable[str], among: Iterable[str]) -> Column:
    """Whether one of ``terms`` occurs, from what ``found_terms`` over the terms ``among`` lists."""
    terms = [t.lower() for t in terms]
    implied = sorted({a for a in map(str.lower, among) for t in terms if a == t or (a.startswith(t) and not (re.search("[a-z0-9]", t) and re.match("[a-z0-9]", a[len(t) :])))})
    return F.arrays_overlap(found, F.array(*map(F.lit, implied))) if implied else F.lit(False)


def has_substring(text: Column, terms: Iterable[str]) -> Column:
    """Whether any term occurs anywhere in lower-case ``text``.

    One pattern for all terms, grouped by their first sign: a search for each makes code
    that is too long to be compiled and reads ``text`` anew for each.
    """
    terms = sorted({t.lower() for t in terms})
    if not terms or "" in terms:
        return F.lit(bool(terms))
    groups = [f"{_quoted(sign)}(?:{'|'.join(_quoted(t[1:]) for t in group)})" for sign, group in groupby(terms, key=lambda t: t[0])]
    return F.coalesce(text, F.lit("")).rlike("|".join(groups))


def substring_count(text: Column, terms: Iterable[str]) -> Column:
    """How many of the terms occur in lower-case ``text``."""
    return sum((F.coalesce(text, F.lit("")).contains(t.lower()).cast("int") for t in terms), F.lit(0))


def joined(*columns: Column) -> Column:
    """Lower-case text of several columns; nulls are left out."""
    return F.lower(F.concat_ws(" ", *columns))


def first_text(*columns: Column) -> Column:
    """The first column that is not blank, trimmed; null if all are."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in columns))


def normalized(text: Column) -> Column:
    """Lower case, '&' as 'and', quotes gone, other signs as single blanks; CJK letters stay."""
    plain = F.regexp_replace(F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("&"), F.lit(" and ")), "['\"’“”]", "")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9\\u4e00-\\u9fff]+", " "))


def title_key(text: Column) -> Column:
    """Only the ASCII letters and digits of a title, lower case."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "")


def tokens(text: Column, stop: Iterable[str] = (), shortest: int = 3) -> Column:
    """Distinct ASCII tokens of at least ``shortest`` characters without the stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    kept = F.array_distinct(F.filter(found, lambda t: F.length(t) >= shortest))
    stop = list(stop)
    return F.array_except(kept, F.array(*map(F.lit, stop))) if stop else kept


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token sets; two empty sets have similarity 0."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def strip_publisher(title: Column, longest: int = 40) -> Column:
    """The title without a trailing publisher of up to ``longest`` characters."""
    out = F.coalesce(title, F.lit(""))
    done = F.lit(False)
    for separator in TITLE_SEPARATORS:
        pattern = f"^(.+){_quoted(separator)}(.{{1,{longest}}})$"
        hit = ~done & F.coalesce(title, F.lit("")).rlike(pattern)
        out = F.when(hit, F.trim(F.regexp_extract(title, pattern, 1))).otherwise(out)
        done = done | hit
    return out


def publisher_of(title: Column, longest: int = 40) -> Column:
    """The trailing publisher of a title, or null."""
    found = [F.when(title.rlike(p), F.trim(F.regexp_extract(title, p, 2))) for p in (f"^(.+){_quoted(s)}(.{{2,{longest}}})$" for s in TITLE_SEPARATORS)]
    return F.coalesce(*found)


def normalized_url(url: Column) -> Column:
    """Scheme and host in lower case without www., path without its last slash; no query or fragment."""
    scheme, host, path = (F.try_parse_url(url, F.lit(part)) for part in ("PROTOCOL", "HOST", "PATH"))
    host = F.regexp_replace(F.lower(host), "^www\\.", "")
    return F.concat(F.lower(scheme), F.lit("://"), host, F.regexp_replace(F.coalesce(path, F.lit("")), "/+$", ""))


def job_id(url: Column) -> Column:
    """The UUID or number of six digits or more in a URL's path, else its last segment."""
    path = F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/+$", "")
    uuid = F.regexp_extract(path, "([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})", 1)
    number = F.regexp_extract(path, "([0-9]{6,})", 1)
    return F.coalesce(F.nullif(uuid, F.lit("")), F.nullif(number, F.lit("")), F.element_at(F.split(path, "/"), -1))


def shortened(text: Column, longest: int, mark: str = "...") -> Column:
    """White space squeezed, cut to ``longest`` characters with a mark."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "\\s+", " "))
    return F.when(F.length(plain) > longest, F.concat(F.substring(plain, 1, longest), F.lit(mark))).otherwise(plain)


def has_cjk(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike("[\\u4e00-\\u9fff]")


def html_escaped(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for raw, safe in _HTML:
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def xml_decoded(text: Column) -> Column:
    """The five named entities of XML and the numeric apostrophe as signs; the ampersand last, so nothing is decoded twice."""
    out = text
    for safe, raw in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(safe), F.lit(raw))
    return out


def amount_millions(title: Column) -> Column:
    """The first money amount of a title in millions: $ or € with a B/M unit, else null."""
    pattern = "(?i)[$€]\\s?([0-9][0-9,]*(?:\\.[0-9]+)?)\\s?(billion|bn|b|million|mn|m)\\b"
    value = F.regexp_replace(F.regexp_extract(title, pattern, 1), ",", "").try_cast("double")
    unit = F.lower(F.substring(F.regexp_extract(title, pattern, 2), 1, 1))
    return F.when(unit == "b", value * 1000).when(unit == "m", value)

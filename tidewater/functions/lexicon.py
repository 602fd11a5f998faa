"""Lexicons are data: named classes of terms, in the order in which they are tried.

A deployment passes its own (``Lexicon.of`` reads them from a table); the
fixture classes below hold frequent words of the driver's invented texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import any_found, found_terms, has_any, has_substring, substring_count


@dataclass(frozen=True)
class Lexicon:
    classes: tuple[tuple[str, tuple[str, ...]], ...]

    @classmethod
    def of(cls, table: DataFrame, most: int = 20_000) -> Lexicon:
        """From a small table (class, ord, term); more than ``most`` terms are an error."""
        found: dict[str, list[str]] = {}
        rows = table.orderBy("ord", "class", "term").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"a lexicon of more than {most} terms")
        for r in rows:
            found.setdefault(r["class"], []).append(r["term"])
        return cls(tuple((k, tuple(v)) for k, v in found.items()))

    def terms(self, name: str) -> tuple[str, ...]:
        return dict(self.classes).get(name, ())

    def hit(self, text: Column, name: str) -> Column:
        """Whether a term of one class occurs at word boundaries."""
        return has_any(text, self.terms(name))

    def every_term(self) -> list[str]:
        return [t for _, terms in self.classes for t in terms]

    def found(self, text: Column, *others: Lexicon) -> Column:
        """The terms of this and other lexicons that occur; make it a column of its own before asking it."""
        return found_terms(text, [t for x in (self, *others) for t in x.every_term()])

    def in_found(self, found: Column, name: str, *others: Lexicon) -> Column:
        """``hit`` of one class, from the column that ``found`` made with the same lexicons."""
        return any_found(found, self.terms(name), [t for x in (self, *others) for t in x.every_term()])

    def found_labels(self, found: Column, *others: Lexicon) -> Column:
        """``labels`` from the column that ``found`` made with the same lexicons."""
        return F.array_compact(F.array(*(F.when(self.in_found(found, name, *others), F.lit(name)) for name, _ in self.classes)))

    def labels(self, text: Column) -> Column:
        """All classes that occur at word boundaries, in order."""
        return F.array_compact(F.array(*(F.when(has_any(text, terms), F.lit(name)) for name, terms in self.classes)))

    def substring_labels(self, text: Column) -> Column:
        return F.array_compact(F.array(*(F.when(has_substring(text, terms), F.lit(name)) for name, terms in self.classes)))

    def first(self, text: Column, default: Column) -> Column:
        """The first class that occurs, else the default."""
        return F.coalesce(*(F.when(has_any(text, terms), F.lit(name)) for name, terms in self.classes), default)

    def most(self, text: Column, default: str) -> Column:
        """The class with most terms occurring as substrings; of ties the first, without hits the default."""
        counts = F.array(*(F.struct(substring_count(text, terms).alias("n"), F.lit(-i).alias("at"), F.lit(name).alias("name")) for i, (name, terms) in enumerate(self.classes)))
        best = F.array_max(counts)
        return F.when(best["n"] > 0, best["name"]).otherwise(default)


#: Words that are frequent in the invented texts, grouped as a product lexicon would be.
FIXTURE = Lexicon(
    (
        ("core", ("ai", "thou")),
        ("adjacent", ("the", "und", "les")),
        ("edge", ("que",)),
        ("out", ("anre", "enst")),
        ("hard_out", ("anea",)),
        ("policy", ("that",)),
        ("structural", ("onth",)),
        ("digital", ("in", "der")),
        ("industry_change", ("thon", "de")),
        ("action", ("for", "with")),
        ("quantified", ("by",)),
        ("editorial", ("or",)),
        ("capital", ("is", "las")),
        ("product", ("it",)),
    )
)
INDUSTRIES = Lexicon((("retail", ("and", "les")), ("mobility", ("thth", "die")), ("health", ("ering", "que"))))
EVENT_TYPES = Lexicon((("funding", ("and", "der")), ("ma", ("that", "les")), ("earnings", ("for",)), ("report", ("with", "que")), ("model", ("this",)), ("strategy", ("the", "de"))))
DOMAINS = Lexicon((("commerce", ("ering", "ung", "que")), ("finance", ("tion", "ment")), ("cloud", ("anth", "chen", "ado")), ("media", ("hes", "ver", "ción"))))
REGIONS = Lexicon((("north", ("is", "las")), ("east", ("it", "der")), ("south", ("of", "les")), ("west", ("the", "que"))))

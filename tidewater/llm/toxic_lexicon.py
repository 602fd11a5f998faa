"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first: case, accents, look-alike letters of other scripts, and
digits or signs that stand for letters.  Lexicon entries are whole words or
word stems, induced from a bounded labelled sample by greedy cover: an entry
must be far more frequent in toxic than in clean texts and reach toxic texts
that earlier entries do not.  Phrases of two words in which an entry occurs in
clean texts become exceptions.  The summed weights, and the same normalised by
length, give the score through a logistic curve fitted on the sample.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.sampling import labelled_sample, remainder

# Letters of Greek and Cyrillic that look like Latin ones.
HOMOGLYPHS = dict(zip("авеікмнорстухѕјԁԛԝҏӏαβεικνορτυχγ", "abeikmhopctyxsjdqwpiabeiknoptuxy", strict=True))
# Digits that stand for letters.
DIGITS = dict(zip("013457", "oieast", strict=True))
# Signs that stand for letters inside a word.
SIGNS = {"@": "a", "$": "s", "!": "i"}


def _fold_table() -> dict[int, str]:
    table = {ord(k): v for k, v in (HOMOGLYPHS | DIGITS).items()}
    for code in range(0xC0, 0x250):  # accented Latin letters lose their marks
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha():
            table[code] = base.lower()
    for code in range(0xFF01, 0xFF5F):  # full-width forms
        table[code] = chr(code - 0xFEE0).lower()
    table |= {code: None for code in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370))}
    return table


_FOLD = _fold_table()
_INNER_SIGN = re.compile(r"(?<=[a-z])[@$!](?=[a-z])|(?<![a-z@$!])[@$](?=[a-z])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    folded = text.lower().translate(_FOLD)
    if "@" in folded or "$" in folded or "!" in folded:
        folded = _INNER_SIGN.sub(lambda m: SIGNS[m[0]], folded)
    return folded


@dataclass
class Lexicon:
    """Entries start at a word start; one that ends in a blank is a whole word, else a stem."""

    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] = (-4.0, 2.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(" " + term, (len(term), weight))
        found.make_automaton()
        return found


def _spaced(folded: str) -> str:
    return " " + " ".join(_WORD.findall(folded)) + " "


def hits(automaton: ahocorasick.Automaton, spaced: str) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the words that are hit, each once with its longest entry."""
    found: dict[int, tuple[int, float]] = {}
    for end, (size, weight) in automaton.iter(spaced):
        start = end - size + 1
        if start not in found or size > found[start][0]:
            found[start] = (size, weight)
    return [(start, spaced.index(" ", start), weight) for start, (_, weight) in sorted(found.items())]


def _phrases(spaced: str, start: int, end: int) -> tuple[str, str]:
    before = spaced.rfind(" ", 0, start - 1) + 1
    after = spaced.find(" ", end + 1)
    return spaced[before:end], spaced[start : after if after > 0 else end]


def features(automaton: ahocorasick.Automaton, exceptions: set[str], text: str) -> tuple[float, float]:
    """(log of the summed weights, log of the same per hundred words); zeros without hits."""
    spaced = _spaced(fold(text))
    total = 0.0
    for start, end, weight in hits(automaton, spaced):
        if not exceptions or not exceptions.intersection(_phrases(spaced, start, end)):
            total += weight
    return math.log1p(total), math.log1p(100 * total / (spaced.count(" ") + 9))


def _terms(text: str, stems: range) -> set[str]:
    words = set(_WORD.findall(fold(text)))
    found = {w + " " for w in words if len(w) > 2}
    for k in stems:
        found.update(w[:k] for w in words if len(w) > k)
    return found


def induce(texts: list[str], labels: list[int], *, stems: range = range(4, 8), cover: int = 3, least_ratio: float = 20.0, max_terms: int = 600) -> Lexicon:
    """Fit a lexicon; equal texts count once.  Without toxic or clean texts it is empty."""
    unique = dict(zip(texts, labels, strict=True))
    toxic, clean = [t for t, y in unique.items() if y], [t for t, y in unique.items() if not y]
    if not toxic or not clean:
        return Lexicon({})
    holders: dict[str, list[int]] = defaultdict(list)
    for i, text in enumerate(toxic):
        for term in _terms(text, stems):
            holders[term].append(i)
    least = max(3, math.ceil(0.003 * len(toxic)))
    holders = {t: np.array(v) for t, v in holders.items() if len(v) >= least}
    in_clean: Counter = Counter()
    for text in clean:
        in_clean.update(t for t in _terms(text, stems) if t in holders)

    def ratio(term: str) -> float:
        return (len(holders[term]) / len(toxic)) / ((in_clean[term] + 0.5) / (len(clean) + 1))

    open_terms = {t: len(v) for t, v in holders.items() if ratio(t) >= least_ratio}
    reached, chosen = np.zeros(len(toxic), int), {}
    while open_terms and len(chosen) < max_terms:
        # Of equal gains the longer, then the first entry: it says more and hits less.
        bound, term = max((g, (len(t), t)) for t, g in open_terms.items())
        term = term[1]
        gain = int((reached[holders[term]] < cover).sum())
        if gain < bound:
            open_terms[term] = gain
            if gain < least:
                del open_terms[term]
            continue
        chosen[term] = math.log(ratio(term))
        reached[holders[term]] += 1
        del open_terms[term]
    lexicon = Lexicon(chosen)
    automaton = lexicon.automaton() if chosen else None
    if automaton:
        seen: Counter = Counter()
        for text in clean:
            spaced = _spaced(fold(text))
            seen.update({p for start, end, _ in hits(automaton, spaced) for p in _phrases(spaced, start, end)})
        kept = {p for p, n in seen.items() if n >= 3 and " " in p}
        for text in toxic if kept else []:
            spaced = _spaced(fold(text))
            kept -= {p for start, end, _ in hits(automaton, spaced) for p in _phrases(spaced, start, end)}
        lexicon.exceptions = kept
        x = np.array([[1.0, *features(automaton, kept, t)] for t in toxic + clean])
        y = np.array([1.0] * len(toxic) + [0.0] * len(clean))
        lexicon.curve = tuple(logistic(x, y))
    return lexicon


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Class-balanced ridge logistic regression by Newton's method."""
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (share * (p - y)) + ridge * beta
        curvature = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _fit(table: pa.Table) -> pa.Table:
    table = table.sort_by([("label", "ascending"), ("text", "ascending")])
    made = induce(table.column("text").to_pylist(), table.column("label").to_pylist())
    kinds = [("term", t, w) for t, w in made.weights.items()] + [("exception", p, 0.0) for p in sorted(made.exceptions)] + [("curve", str(i), c) for i, c in enumerate(made.curve)]
    return pa.table({"kind": [k for k, _, _ in kinds], "item": [i for _, i, _ in kinds], "weight": [float(w) for _, _, w in kinds]})


def fit_lexicon(sample: DataFrame) -> Lexicon:
    """Fit on a bounded sample of (label, text) in one task; the lexicon comes back."""
    rows = sample.groupBy(F.lit(0).alias("one")).applyInArrow(_fit, "kind string, item string, weight double").collect()
    curve = {int(r["item"]): r["weight"] for r in rows if r["kind"] == "curve"}
    return Lexicon({r["item"]: r["weight"] for r in rows if r["kind"] == "term"}, {r["item"] for r in rows if r["kind"] == "exception"}, tuple(curve[i] for i in range(3)) if curve else Lexicon({}).curve)


def _scorer(lexicon: Lexicon) -> Callable[[pa.Array], np.ndarray]:
    """Scores of texts; builds the automaton once, so a task makes one."""
    automaton = lexicon.automaton() if lexicon.weights else None
    a, b, c = lexicon.curve

    def scores(texts: pa.Array) -> np.ndarray:
        found = np.zeros(len(texts))
        for i, text in enumerate(texts):
            x, y = features(automaton, lexicon.exceptions, text.as_py() or "") if automaton else (0.0, 0.0)
            found[i] = 1 / (1 + math.exp(-min(30.0, max(-30.0, a + b * x + c * y))))
        return found

    return scores


def _score(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1)))], names=["id", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, folds: int = 5, rows_per_class: int = 6000, threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    The lexicon is fitted on at most ``rows_per_class`` labelled rows of either
    class whose crc32(id) mod ``folds`` is not 0; whole texts of all rows are
    scored.  Null and empty texts have no hits and get the score of a clean
    text; without labels of both classes the lexicon is empty and all scores
    are that of a clean text.  Repeated rows are scored alike; an empty table
    gives an empty result.
    """
    sample = labelled_sample(docs, labels.filter(remainder(id_col, folds) != 0), id_col, text_col, label_col, rows_per_class)
    lexicon = fit_lexicon(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("content"))
    scored = rows.mapInArrow(_score(lexicon), "id long, score double")
    return scored.select(F.col("id").alias(id_col), (remainder("id", folds) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns, whatever their names.

    Whole texts are scored in place, very long ones too, so repeated ids need no
    join and repeated rows share their fate.  Null and empty texts score as a
    clean text and stay, as do all rows where no labels of both classes are
    given; null ids are scored like others.  An empty table gives an empty result.
    """
    lexicon = fit_lexicon(labelled_sample(docs, labels.filter(remainder(id_col, 5) != 0), id_col, text_col, "toxic", 6000))
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scorer(lexicon)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at)) < threshold))

    return docs.mapInArrow(keep, docs.schema)

"""Language identification by cross-parsing entropy.

A suffix automaton is built over labelled text of each language.  A text is
parsed into phrases, each the longest match in the automaton from where the
last one ended; the fewer phrases a letter needs, the closer the language.
Texts are parsed in segments of bounded length, all segments of a batch and all
languages at once: the automata are tables, and one numpy step moves every
segment on by one symbol.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.sampling import remainder

#: Letters, and some signs such as fractions that the class takes for them.
_LIKE_LETTER = re.compile(r"[^\W\d_]")
_SPACE = 1
#: ASCII letters (of lower-case text) and all bytes of other characters have symbols of their own.
_LETTER_BYTES = np.array([b for b in range(256) if b >= 128 or chr(b).islower()])


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LIKE_LETTER.finditer(text))


def suffix_automaton(symbols: np.ndarray, alphabet: int) -> np.ndarray:
    """Transition table (state, symbol) -> state, -1 where the extended match does not occur.

    State 0 is the empty match; the walk from it accepts exactly the substrings.
    """
    most = 2 * len(symbols) + 2
    step = np.full((most, alphabet), -1, dtype=np.int32)
    link, length = np.full(most, -1, dtype=np.int64), np.zeros(most, dtype=np.int64)
    states, last = 1, 0
    for symbol in symbols.tolist():
        new, states = states, states + 1
        length[new] = length[last] + 1
        at = last
        while at >= 0 and step[at, symbol] < 0:
            step[at, symbol] = new
            at = link[at]
        if at < 0:
            link[new] = 0
        else:
            target = step[at, symbol]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                clone, states = states, states + 1
                length[clone] = length[at] + 1
                step[clone], link[clone] = step[target], link[target]
                link[target] = link[new] = clone
                while at >= 0 and step[at, symbol] == target:
                    step[at, symbol] = clone
                    at = link[at]
        last = new
    return step[:states]


@dataclass
class Languages:
    """names, the symbol of each byte, and one flat table of all automata.

    The table has a row per state; a missing transition is stored as the state
    after a new phrase began with that symbol, with its sign flipped.
    """

    names: list[str]
    symbol: np.ndarray
    table: np.ndarray
    roots: np.ndarray

    def costs(self, texts: list[str], segment: int = 1024) -> np.ndarray:
        """Phrases per symbol of each text (rows) in each language (columns)."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            codes = squeeze(self.symbol[np.frombuffer(text.lower().encode(), np.uint8)])
            for at in range(0, len(codes), segment):
                parts.append(codes[at : at + segment])
                owner.append(i)
        phrases = np.zeros((len(texts), len(self.names)))
        length = np.zeros(len(texts))
        if not parts:
            return phrases
        sizes = np.array([len(p) for p in parts])
        order = np.argsort(-sizes, kind="stable")
        sizes, owner = sizes[order], np.array(owner)[order]
        grid = np.zeros((sizes[0], len(parts)), dtype=np.int32)
        for column, k in enumerate(order):
            grid[: sizes[column], column] = parts[k]
        width = self.table.shape[1]
        flat = self.table.ravel()
        state = np.repeat(self.roots[None, :], len(parts), axis=0).astype(np.int64)
        count = np.zeros(state.shape, dtype=np.int32)
        alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
        for at, n in enumerate(alive.tolist()):
            moved = flat[state[:n] * width + grid[at, :n, None]]
            count[:n] += moved < 0
            state[:n] = np.abs(moved)
        np.add.at(phrases, owner, count + 1)
        np.add.at(length, owner, sizes)
        return phrases / np.maximum(length, 1)[:, None]


def squeeze(codes: np.ndarray) -> np.ndarray:
    """Runs of the space symbol (all that is no letter) become one."""
    blank = codes == _SPACE
    return codes[~(blank & np.concatenate([[False], blank[:-1]]))]


def equal_shares(texts: list[str], most: int) -> str:
    """The beginnings of the texts, each up to one length, that together have ``most`` characters or are all there is."""
    if not texts:
        return ""
    sizes = np.sort([len(t) for t in texts])
    before = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    fits = before + sizes * np.arange(len(sizes), 0, -1) <= most
    cap = sizes[-1] if fits.all() else (most - before[~fits][0]) // (len(sizes) - fits.sum())
    return " ".join(t[:cap] for t in texts)


def trained(text: str) -> tuple[bytes, np.ndarray]:
    """(letter bytes in use, automaton over them) of one language; symbols 0 and 1 are unknown and space."""
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    letters = np.intersect1d(raw, _LETTER_BYTES)
    symbol = np.full(256, _SPACE, np.int64)
    symbol[letters] = np.arange(2, 2 + len(letters))
    return letters.astype(np.uint8).tobytes(), suffix_automaton(squeeze(symbol[raw]), 2 + len(letters))


def merged(parts: dict[str, tuple[bytes, np.ndarray]], table_bytes: int = 1 << 30) -> Languages:
    """One table of all languages over all their letter bytes; beyond ``table_bytes`` it is an error."""
    names = sorted(parts)
    letters = sorted(set(b"".join(parts[k][0] for k in names)))
    symbol = np.zeros(256, dtype=np.int32)  # 0: a letter byte that no labelled text has
    symbol[np.setdiff1d(np.arange(256), _LETTER_BYTES)] = _SPACE
    symbol[letters] = np.arange(2, 2 + len(letters))
    width = 2 + len(letters)
    size = 4 * width * (1 + sum(len(step) for _, step in parts.values()))
    if size > table_bytes:
        raise ValueError(f"the automata need {size} bytes, more than {table_bytes}; lower sample_chars")
    tables, roots, base = [np.zeros((1, width), np.int32)], [], 1  # state 0 is left out, so that every state has a sign
    for name in names:
        own, step = parts[name]
        wide = np.full((len(step), width), -1, np.int64)
        wide[:, [0, _SPACE, *symbol[list(own)]]] = step
        wide[:, 0] = -1
        first = np.where(wide[0] >= 0, wide[0], 0)
        tables.append(np.where(wide >= 0, wide + base, -(first[None, :] + base)).astype(np.int32))
        roots.append(base)
        base += len(step)
    return Languages(names, symbol, np.concatenate(tables), np.array(roots, dtype=np.int64))


def learn(texts: dict[str, str]) -> Languages:
    return merged({k: trained(v) for k, v in texts.items()})


def _train(most: int):
    def run(table: pa.Table) -> pa.Table:
        """The automaton of one language from its sample."""
        table = table.sort_by("id")
        letters, step = trained(equal_shares(table.column("text").to_pylist(), most))
        return pa.table({"lang": [table.column("lang")[0].as_py()], "letters": pa.array([letters], pa.binary()), "step": pa.array([step.astype("<i4").tobytes()], pa.binary())})

    return run


def _label(model: Languages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            guesses, scores = [], []
            for at in range(0, batch.num_rows, 512):
                texts = [t.as_py() or "" for t in batch.column(1).slice(at, 512)]
                costs = model.costs(texts)
                for text, cost in zip(texts, costs, strict=True):
                    if not model.names or not has_letter(text):
                        guesses.append("und")
                        scores.append(0.0)
                        continue
                    best = int(np.argmin(cost))
                    other = np.delete(cost, best).min() if len(cost) > 1 else 1.0
                    guesses.append(model.names[best])
                    scores.append(float(np.clip(1 - cost[best] / other, 0, 1)) if other > 0 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(guesses, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    return run


def identify_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, folds: int = 5, sample_docs: int = 60, sample_chars: int = 20_000, max_languages: int = 200, table_bytes: int = 1 << 30
) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    Each language is learned from up to ``sample_docs`` of its rows with
    crc32(id) mod ``folds`` other than 0, taken in hash order of the id, which
    share ``sample_chars`` characters: every one gives its beginning up to the one
    length at which they are used up.  More than ``max_languages`` languages, or
    automata beyond ``table_bytes``, are an error; all letter bytes of the samples
    have symbols.  Whole texts are parsed.  Null texts, empty texts and texts
    without a letter give ``und`` with score 0, as does a table without labelled
    rows; the score is the relative lead over the second language (ties: 0, and
    the first name wins).  Repeated rows are labelled alike (one of them is
    learned from); an empty table gives an empty result.
    """
    train = docs.filter((remainder(id_col, folds) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = Window.partitionBy("lang").orderBy("order", "id")
    ids = train.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col).cast("long")).alias("order"))
    chosen = ids.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= sample_docs).select("id", "lang").distinct()
    texts = train.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.substring(F.col(text_col).cast("string"), 1, sample_chars).alias("text"))
    sample = texts.join(F.broadcast(chosen), ["id", "lang"]).groupBy("lang", "id").agg(F.min("text").alias("text"))
    # One row per language, each bounded by sample_chars; one more than is allowed shows the excess.
    fitted = sample.groupBy("lang").applyInArrow(_train(sample_chars), "lang string, letters binary, step binary").limit(max_languages + 1).collect()
    if len(fitted) > max_languages:
        raise ValueError(f"more than {max_languages} languages are not learned at once")
    model = merged({r["lang"]: (bytes(r["letters"]), np.frombuffer(r["step"], "<i4").reshape(-1, 2 + len(r["letters"]))) for r in fitted}, table_bytes)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("content"))
    labelled = rows.mapInArrow(_label(model), "id long, lang_pred string, score double")
    return labelled.select(F.col("id").alias(id_col), (remainder("id", folds) == 0).alias("held_out"), "lang_pred", "score")

"""Language-model scores from a log-frequency Bloom filter.

Tokens are words (ASCII case folded) and one end a document.  Tasks hash the
words of their documents with numpy, sort what they hold, and send counted runs
of 64-bit words and of bigrams, packed by piece of the hash space, to reducers,
which add the counts up.  A count c is quantised to the level 1 + floor(log2 c),
and a word or bigram of level q enters the filter of its piece q times, once a
level.  The pieces are gathered and broadcast, and the scoring tasks find a
level by asking for level 1, 2, ... until one is absent.  A filter too large to
be broadcast at once is broadcast in groups of pieces; the tokens are then
written once by the group that their first word asks, so that each is scored once.

A bigram (v, w) that the filter holds has the probability c2 / (c1 + T); for
others the mass T / (c1 + T) is left, shared by the exact add-one probability of
the word.  T, the number of different followers of v, is c1 to a power chosen so
that the sum over all words equals the number of different bigrams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.sampling import remainder
from tidewater.llm.store import written

PROBES = 8  # bits of an entry, so that one absent entry in 256 is taken for present
PARTS = 16  # pieces of a segment, so that the followers of one word are dealt out too
_BLOCK, _FLUSH, _SLICE = 1 << 20, 1 << 21, 1 << 18  # bytes of text, tokens counted at once, tokens scored at once
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_RANDOM = np.random.default_rng(20_240_117).integers(1, 1 << 63, 260, np.uint64)
_BYTES, _STEP, _LENGTH, START, END = _RANDOM[:256], _RANDOM[256] | np.uint64(3), _RANDOM[257], _RANDOM[258], _RANDOM[259]
_LOW32, _U = np.uint64(0xFFFFFFFF), np.uint64
_COUNTED = "kind int, piece int, keys binary, counts binary"
_REDUCED = "kind int, piece int, types long, bits binary, size long, hash long, count long"
_SCORED = "row long, id long, n_tokens long, n_known long, base double, lm double, hash long, n long, backs long"
_DEALT = f"{_SCORED}, part int, first long, texts binary, words binary, befores binary, tokens binary"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    powers = np.full(max(n, 1), _STEP)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


def word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after another in ``data``, cut at ``cuts``, and how many each text has."""
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    inner = cuts[1:-1][cuts[1:-1] < len(data)]
    first[inner] = ~space[inner]
    at = np.flatnonzero(~space)
    starts = np.flatnonzero(first[at])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(cuts) - 1, np.int64)
    lengths = np.diff(starts, append=len(at))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    terms = _BYTES[_LOWER[data[at]]] * _powers(int(lengths.max()))[place]
    hashes = mixed(np.add.reduceat(terms, starts) + lengths.astype(np.uint64) * _LENGTH)
    return hashes, np.diff(np.searchsorted(at[starts], cuts))


def _long_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of one long text, some at a time; a part ends at white space."""
    found, at = [], 0
    while at < len(data):
        stop = at + _BLOCK
        while stop < len(data) and not _SPACE[data[stop]]:
            near = np.flatnonzero(_SPACE[data[stop : stop + _BLOCK]])
            stop += int(near[0]) if len(near) else _BLOCK
        part = data[at:stop]
        found.append(word_hashes(part, np.array([0, len(part)]))[0])
        at = stop
    return np.concatenate(found)


def _hashed_blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, after the last, hashes, words of each) of runs of texts of about ``_BLOCK`` bytes."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(cuts, cuts[first] + _BLOCK, "right")) - 1)
        part = data[cuts[first] : cuts[stop]]
        if len(part) > 2 * _BLOCK:  # one long text
            hashes = _long_hashes(part)
            yield first, stop, hashes, np.array([len(hashes)])
        else:
            yield first, stop, *word_hashes(part, cuts[first : stop + 1] - cuts[first])
        first = stop


def positions(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, the one before it, number of its text): each text's words and its end."""
    ends = np.cumsum(counts + 1) - 1
    token = np.empty(len(hashes) + len(counts), np.uint64)
    inside = np.ones(len(token), bool)
    inside[ends] = False
    token[inside], token[ends] = hashes, END
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[ends - counts] = START
    return token, before, np.repeat(np.arange(len(counts)), counts + 1)


def _place(hashes: np.ndarray, pieces: int) -> np.ndarray:
    """The piece of a word; rises with the hash."""
    return ((hashes >> _U(32)) * _U(pieces) >> _U(32)).astype(np.int64)


def bigram_place(before: np.ndarray, token: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """The piece of a bigram, in the segment of its first word, and its 48-bit key there."""
    piece = _place(before, pieces) // PARTS * PARTS + (token & _U(PARTS - 1)).astype(np.int64)
    return piece, mixed(before * _U(0x9E3779B97F4A7C15) + token) & _U((1 << 48) - 1)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return ordered[starts], np.diff(starts, append=len(ordered))


def _packed(kind: int, piece: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each piece, in whose order the keys are."""
    pieces, sizes = _runs(piece)
    cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    keys, counts = keys.astype("<u8"), counts.astype("<u4")
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    columns = [pa.array([kind] * len(pieces), pa.int32()), pa.array(pieces, pa.int32()), pa.array([keys[i:j].tobytes() for i, j in spans], pa.binary()), pa.array([counts[i:j].tobytes() for i, j in spans], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "piece", "keys", "counts"])


def _count(pieces: int):
    def emit(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        token, before = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        words, counts = _runs(np.sort(np.concatenate([token, before[before == START]])))
        yield _packed(1, _place(words, pieces), words, counts)
        piece, key = bigram_place(before, token, pieces)
        keys, counts = _runs(np.sort(piece.astype(np.uint64) << _U(48) | key))
        yield _packed(2, (keys >> _U(48)).astype(np.int64), keys & _U((1 << 48) - 1), counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, hashes, counts in _hashed_blocks(batch.column(0)):
                token, before, _ = positions(hashes, counts)
                held.append((token, before))
                size += len(token)
                if size >= _FLUSH:
                    yield from emit(held)
                    held, size = [], 0
        if held:
            yield from emit(held)

    return run


def level_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 of the count); 0 for 0."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The geometric middle of the counts of a level."""
    return np.where(levels > 0, np.sqrt(2.0 ** (levels - 1) * (2.0**levels - 1)), 0.0)


def _bit(key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    entry = mixed(key + _U(level) * _U(0xD1B54A32D192ED03))
    return entry >> _U(32), entry & _LOW32 | _U(1)


def bloom(keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, int]:
    """The packed bits, and their number, of a filter that holds every key once for each of its levels."""
    size = max(64, int(np.ceil(levels.sum() * PROBES / np.log(2))))
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        at, step = _bit(keys, level)
        for _ in range(PROBES):
            bits[(at & _LOW32) * _U(size) >> _U(32)] = True
            at = at + step
    return np.packbits(bits, bitorder="little"), size


class Filter:
    """Pieces of the filter; asks for many keys at once."""

    def __init__(self, bits: np.ndarray, base: np.ndarray, size: np.ndarray) -> None:
        self.bits, self.base, self.size = bits, base, size  # base and size by kind and piece; size 0: no key is held

    def _held(self, base: np.ndarray, size: np.ndarray, key: np.ndarray, level: int) -> np.ndarray:
        """Places of the keys that are held at a level."""
        alive = np.flatnonzero(size)
        at, step = _bit(key, level)
        at, step, base, size = (x[alive] for x in (at, step, base, size))
        kept = np.ones(len(alive), bool)
        for _ in range(PROBES):
            place = base + ((at & _LOW32) * size >> _U(32)).view(np.int64)
            kept &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1) != 0
            at += step
            if 4 * np.count_nonzero(kept) < 3 * len(kept):  # copied once a quarter is gone
                alive, at, step, base, size = (x[kept] for x in (alive, at, step, base, size))
                kept = np.ones(len(alive), bool)
        return alive[kept]

    def levels(self, kind: int, piece: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The largest level up to which every level of a key is held."""
        found = np.zeros(len(key), np.int64)
        base, size, alive, level = self.base[kind, piece], self.size[kind, piece], np.arange(len(key)), 1
        while len(alive):
            held = self._held(base, size, key, level)
            alive, base, size, key = alive[held], base[held], size[held], key[held]
            found[alive] = level
            level += 1
        return found


def _reduce(table: pa.Table) -> pa.Table:
    """Sums of one piece: its filter, and for words a row each."""
    kind, piece = table.column("kind")[0].as_py(), table.column("piece")[0].as_py()
    keys, counts = (np.concatenate([np.frombuffer(x, d) for x in table.column(c).to_pylist()]) for c, d in (("keys", "<u8"), ("counts", "<u4")))
    order = np.argsort(keys, kind="stable")
    keys, sizes = _runs(keys[order])
    counts = np.add.reduceat(counts[order].astype(np.int64), np.cumsum(sizes) - sizes)
    bits, size = bloom(keys, level_of(counts))
    word = np.flatnonzero(keys != START) if kind == 1 else np.zeros(0, np.int64)
    n = len(word)
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    columns = [[kind] * (n + 1), [piece] * (n + 1), [len(keys)] + [None] * n, [bits.tobytes()] + [None] * n, [size] + [None] * n, pa.array([None], pa.int64()), pa.array([None], pa.int64())]
    made = [pa.array(c, t) for c, t in zip(columns[:5], types, strict=False)]
    made += [pa.concat_arrays([none, pa.array(x[word].astype(np.int64))]) for none, x in zip(columns[5:], (keys.view(np.int64), counts), strict=True)]
    return pa.table(made, names=["kind", "piece", "types", "bits", "size", "hash", "count"])


def _text_rows(batches: Iterator[pa.RecordBatch]):
    """(row numbers, ids, hashes, words of each) of blocks of (id, text) rows."""
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        ids = batch.column(0)
        for i, j, hashes, counts in _hashed_blocks(batch.column(1)):
            yield np.arange(row + i, row + j), ids.slice(i, j - i), hashes, counts
        row += batch.num_rows


def _coded(token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words, and the places among them of what stands before each token and of the token."""
    words, place = np.unique(np.concatenate([[START, before[0]], token]), return_inverse=True)
    return words, np.where(before == START, place[0], place[1:-1]), place[2:]


def _tally(text: np.ndarray, token: np.ndarray, words: np.ndarray, *weights: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(text, hash, sum of each weight) of the different words of each text."""
    pairs, back = np.unique(text * len(words) + token, return_inverse=True)
    return pairs // len(words), words[pairs % len(words)], *(np.bincount(back, x, len(pairs)).astype(np.int64) for x in weights)


class _Unigrams:
    """Log probabilities of the words that are broadcast."""

    def __init__(self, held: dict) -> None:
        self.words, self.logs = held["words"], held["logs"]

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are broadcast, and their log10 (0 for others)."""
        if not len(self.words):
            return np.zeros(len(words), bool), np.zeros(len(words))
        near = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        shared = self.words[near] == words
        return shared, np.where(shared, self.logs[near], 0.0)


class _Bigrams:
    """Log probabilities by the filter, or by a group of its pieces."""

    def __init__(self, held: dict) -> None:
        self.filter, self.pieces, self.power = Filter(held["bits"], held["base"], held["size"]), held["pieces"], held["power"]

    def of(self, words: np.ndarray, before: np.ndarray, token: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of each token after the one before, without the word's own share if that is not in ``logs``; which are left to the base."""
        asked = np.zeros(len(words), bool)
        asked[before] = True
        c1, c2 = np.zeros(len(words)), np.zeros(len(token))
        c1[asked] = count_of(self.filter.levels(1, _place(words[asked], self.pieces), words[asked]))
        followers = np.where(c1 > 0, c1, 1.0) ** self.power
        known = np.flatnonzero(c1[before] > 0)
        piece, key = bigram_place(words[before[known]], words[token[known]], self.pieces)
        # Each different bigram is looked up once, and those of a piece after each other.
        asked, back = np.unique(piece.astype(np.uint64) << _U(48) | key, return_inverse=True)
        c2[known] = count_of(self.filter.levels(2, (asked >> _U(48)).astype(np.int64), asked & _U((1 << 48) - 1)))[back]
        total, backs = (c1 + followers)[before], c2 == 0
        left = np.where(c1 > 0, np.log10(followers / (c1 + followers)), 0.0)[before]
        return np.where(backs, left + logs[token], np.log10(np.minimum(1.0, np.where(backs, total, c2) / total))), backs


def _slices(hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, texts, number of each token's text from there, words, places of those before, places of the tokens) of some tokens at a time."""
    token, before, text = positions(hashes, counts)
    for at in range(0, len(token), _SLICE):
        part = text[at : at + _SLICE]
        yield int(part[0]), int(part[-1] - part[0]) + 1, part - part[0], *_coded(token[at : at + _SLICE], before[at : at + _SLICE])


def _sums(rows: np.ndarray, ids: pa.Array | None, tokens: np.ndarray, known: np.ndarray, base: np.ndarray, model: np.ndarray) -> list[pa.Array]:
    ids = ids.cast(pa.int64()) if ids is not None else pa.nulls(len(rows), pa.int64())
    empty = pa.nulls(len(rows), pa.int64())
    return [pa.array(rows), ids, *(pa.array(x.astype(np.int64)) for x in (tokens, known)), pa.array(base), pa.array(model), empty, empty, empty]


def _left(rows: np.ndarray, words: np.ndarray, times: np.ndarray, backs: np.ndarray) -> list[pa.Array]:
    """Rows of words that are not broadcast: how often a text has each, and leaves it to the base."""
    none, zero = np.zeros(len(rows), np.int64), np.zeros(len(rows))
    return [pa.array(rows), pa.nulls(len(rows), pa.int64()), pa.array(none), pa.array(none), pa.array(zero), pa.array(zero), pa.array(words.view(np.int64)), pa.array(times), pa.array(backs)]


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(columns: list[pa.Array], schema: str) -> pa.RecordBatch:
    """A batch of the schema's first columns and nulls in the others."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    kind = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(columns[0]), kind[k]) for k in kinds[len(columns) :])], names=list(names))


def _score(held: Broadcast):
    """Score whole texts with all of the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigrams, bigrams = _Unigrams(held.value), _Bigrams(held.value)
        for rows, ids, hashes, counts in _text_rows(batches):
            known, base, model = np.zeros((3, len(rows)))
            for first, n, text, words, before, token in _slices(hashes, counts):
                shared, logs = unigrams.of(words)
                scores, backs = bigrams.of(words, before, token, logs)
                for total, part in ((known, shared[token]), (base, logs[token]), (model, scores)):
                    total[first : first + n] += np.bincount(text, part, n)
                odd = np.flatnonzero(~shared[token])
                of, *rare = _tally(text[odd], token[odd], words, None, backs[odd])
                yield _batch(_left(rows[first + of], *rare), _SCORED)
            yield _batch(_sums(rows, ids, counts + 1, known, base, model), _SCORED)

    return run


def _narrow(places: np.ndarray, n: int) -> bytes:
    return places.astype("<u2" if n <= 1 << 16 else "<u4").tobytes()


def _deal(held: Broadcast, cuts: list[int], pieces: int):
    """Score whole texts by words alone (part -1), and deal out their tokens by the group of segments, from ``cuts`` on, of the word before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigrams = _Unigrams(held.value)
        for rows, ids, hashes, counts in _text_rows(batches):
            known, base = np.zeros((2, len(rows)))
            for first, n, text, words, before, token in _slices(hashes, counts):
                shared, logs = unigrams.of(words)
                known[first : first + n] += np.bincount(text, shared[token], n)
                base[first : first + n] += np.bincount(text, logs[token], n)
                odd = np.flatnonzero(~shared[token])
                of, *rare = _tally(text[odd], token[odd], words, None)
                left = _left(rows[first + of], *rare, np.zeros(len(of), np.int64))
                yield _batch([*left, pa.array(np.full(len(of), -1, np.int32))], _DEALT)
                part = (np.searchsorted(cuts, _place(words, pieces) // PARTS, "right") - 1)[before]
                order = np.argsort(part.astype(np.int16 if len(cuts) < 1 << 15 else np.int64), kind="stable")
                parts, sizes = _runs(part[order])
                packed = []
                for stop, size in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True):
                    some = order[stop - size : stop]
                    used = np.zeros(len(words), bool)
                    used[before[some]] = used[token[some]] = True
                    place, m = np.cumsum(used) - 1, int(used.sum())
                    packed.append((np.bincount(text[some], minlength=n).astype("<u4").tobytes(), words[used].tobytes(), _narrow(place[before[some]], m), _narrow(place[token[some]], m)))
                empty = [pa.nulls(len(parts), pa.float64() if c.endswith("double") else pa.int64()) for c in _SCORED.split(", ")]
                asked = [pa.array(parts.astype(np.int32)), pa.array(np.full(len(parts), rows[first])), *(pa.array(x, pa.binary()) for x in zip(*packed, strict=True))]
                yield _batch([*empty, *asked], _DEALT)
            done = _sums(rows, ids, counts + 1, known, base, np.zeros(len(rows)))
            yield _batch([*done, pa.array(np.full(len(rows), -1, np.int32))], _DEALT)

    return run


def _score_part(held: Broadcast):
    """Score the tokens (first, texts, words, befores, tokens) of one group of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigrams, bigrams = _Unigrams(held.value), _Bigrams(held.value)
        for batch in batches:
            for k in range(batch.num_rows):
                first, texts, words, *places = (c[k].as_py() for c in batch.columns)
                words, sizes = np.frombuffer(words, np.uint64), np.frombuffer(texts, "<u4")
                before, token = (np.frombuffer(x, "<u2" if len(words) <= 1 << 16 else "<u4").astype(np.int64) for x in places)
                shared, logs = unigrams.of(words)
                scores, backs = bigrams.of(words, before, token, logs)
                text = np.repeat(np.arange(len(sizes)), sizes)
                odd = np.flatnonzero(~shared[token] & backs)
                of, hashes, back = _tally(text[odd], token[odd], words, backs[odd])
                yield _batch(_left(first + of, hashes, np.zeros(len(of), np.int64), back), _SCORED)
                some, zero = np.flatnonzero(sizes), np.zeros(np.count_nonzero(sizes))
                yield _batch(_sums(first + some, None, zero, zero, zero, np.bincount(text, scores, len(sizes))[some]), _SCORED)

    return run


def followers_power(levels: list[tuple[int, int, int]], types: int) -> float:
    """The power to which the words' counts add up to ``types``; levels: (level, words, tokens)."""
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        made = sum(n * (tokens / n) ** middle for _, n, tokens in levels)
        low, high = (middle, high) if made < types else (low, middle)
    return low


def _groups(sizes: dict[int, int], segments: int, most: int) -> list[tuple[int, int]]:
    """Runs of segments of at most ``most`` bytes, or of one segment."""
    groups, first, held = [], 0, 0
    for segment in range(segments):
        if held and held + sizes.get(segment, 0) > most:
            groups.append((first, segment))
            first, held = segment, 0
        held += sizes.get(segment, 0)
    return [*groups, (first, segments)]


def score_texts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, folds: int = 7, held_fold: int = 2, filter_bytes: int = 1 << 27, broadcast_words: int = 1 << 19
) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from all whole texts whose crc32(id) mod ``folds`` is not
    ``held_fold``.  base_score is the exact add-one unigram log10 probability,
    score that of the bigram filter; neither is cut off for very long texts.
    Null and empty texts are one end token; null ids learn and are
    scored; repeated rows learn and are scored each.  Without rows to learn from
    every probability is 1.  An empty table gives an empty result, and other
    columns are not read.

    At most ``filter_bytes`` of the filter are broadcast at once: of a larger
    one, groups of segments are, one after another, and each reads and scores
    only the bigrams of its first words (a segment that is larger goes alone).  The exact
    counts of at most ``broadcast_words`` words, the most frequent,
    are broadcast; other words, none of them frequent, are joined with their counts.
    Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("content"))
    train = rows.filter(remainder("id", folds) != held_fold)
    octets = train.agg(F.sum(F.octet_length("content").cast("long"))).first()[0] or 0
    # A filter has a third of the text's bytes at most; eight segments or more fill what is broadcast at once.
    segments = min(4096, max(1, -(-octets // (3 * filter_bytes // 8))))
    pieces = segments * PARTS
    counted = train.select("content").mapInArrow(_count(pieces), _COUNTED)
    made = written(counted.groupBy("kind", "piece").applyInArrow(_reduce, _REDUCED), "counts")
    words = made.filter("hash is not null").select("hash", "count", F.floor(F.log2("count")).cast("int").alias("level"))
    # Some forty levels at most.
    levels = [tuple(r) for r in words.groupBy("level").agg(F.count("*").alias("words"), F.sum("count").alias("tokens")).orderBy(F.desc("level")).collect()]
    n, v = sum(t for _, _, t in levels), sum(w for _, w, _ in levels)
    sizes = made.filter("bits is not null").groupBy("kind", F.expr(f"piece div {PARTS}").cast("int").alias("segment")).agg(F.sum("types").alias("types"), F.sum(F.length("bits")).alias("bytes")).collect()  # two rows a segment
    power = followers_power(levels, sum(r["types"] for r in sizes if r["kind"] == 2)) if n else 0.5
    frequent, least = 0, 64
    for level, many, _ in levels:
        if frequent + many > broadcast_words:
            break
        frequent, least = frequent + many, level
    table = words.filter(F.col("level") >= least).select("hash", "count").toArrow()
    keys = table.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    logs = np.log10((table.column("count").to_numpy()[order] + 1) / (n + v + 1))
    by_segment: dict[int, int] = {}
    for r in sizes:
        by_segment[r["segment"]] = by_segment.get(r["segment"], 0) + r["bytes"]
    groups = _groups(by_segment, segments, filter_bytes)
    unigrams = {"words": keys[order], "logs": logs}
    parts, dealt = [], None
    if len(groups) > 1:
        shared = spark.sparkContext.broadcast(unigrams)
        dealt = written(rows.mapInArrow(_deal(shared, [low for low, _ in groups], pieces), _DEALT), "dealt", "zstd", by="part")
        shared.destroy()
        parts.append(dealt.filter("part = -1").select(*_columns(_SCORED)))
    for part, (low, high) in enumerate(groups):
        base, size, held, filled = np.zeros((3, pieces), np.int64), np.zeros((3, pieces), np.uint64), [], 0
        for r in made.filter(f"bits is not null and piece >= {low * PARTS} and piece < {high * PARTS}").select("kind", "piece", "size", "bits").toLocalIterator():
            base[r["kind"], r["piece"]], size[r["kind"], r["piece"]] = filled * 8, r["size"]
            held.append(np.frombuffer(bytes(r["bits"]), np.uint8))
            filled += len(held[-1])
        bits = np.concatenate(held) if held else np.zeros(1, np.uint8)
        shared = spark.sparkContext.broadcast({"bits": bits, "base": base, "size": size, "pieces": pieces, "power": power, **unigrams})
        del held, bits
        if dealt is None:
            found = rows.mapInArrow(_score(shared), _SCORED)
        else:
            found = dealt.filter(F.col("part") == part).select("first", "texts", "words", "befores", "tokens").mapInArrow(_score_part(shared), _SCORED)
        parts.append(written(found, "scored"))
        shared.destroy()
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    p = F.log10((F.coalesce("count", F.lit(0)) + 1) / F.lit(float(n + v + 1)))
    rest = found.filter("hash is not null").join(words.filter(F.col("level") < least).select("hash", "count"), "hash", "left")
    rest = rest.select("row", "id", F.lit(0).cast("long").alias("n_tokens"), F.when(F.col("count") > 0, F.col("n")).otherwise(0).alias("n_known"), (F.col("n") * p).alias("base"), (F.col("backs") * p).alias("lm"))
    every = found.filter("hash is null").select(*rest.columns).unionByName(rest)
    total = every.groupBy("row").agg(F.max("id").alias("id"), *(F.sum(c).alias(c) for c in rest.columns[2:]))
    return total.select(
        F.col("id").alias(id_col), (remainder("id", folds) == held_fold).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("lm").alias("score")
    )

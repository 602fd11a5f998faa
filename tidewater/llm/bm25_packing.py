"""Packing documents into windows by lexical retrieval.

Texts are tokenised once.  Every full window of a long document is a sequence
of its own; the tails are packed together.  Tails are dealt to index shards of a
bounded number of tokens by a min-hash of their terms, so that related texts
tend to meet; a shard that copies of one text overfill is split by hash.  In a
shard a BM25 inverted index (with document frequencies and mean length of all
pieces, windows and tails) returns for each seed the unused neighbours in order of relevance, which fill
the seed's window; the last one is cut to fit and its rest seeds the next window.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from copy import copy
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.store import written

#: Terms are pairs of neighbouring token ids, hashed to so many values.
TERMS = 1 << 16
_K1, _B = 1.2, 0.75
_TOKENISED = "uid long, doc_id long, doc_tokens long, start long, sequence_id long, key long, ids binary"
_PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _latin(kind: str) -> str:
    """The plain Latin characters of a Unicode category, for a character class."""
    return "".join(f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


_LETTERS, _NUMBERS = _latin("L"), _latin("N")
#: Plain characters whose lower case is one plain character too; some capitals (such as U+018F) leave the range.
_STEADY = "".join(f"\\u{c:04x}" for c in range(0x250) if len(chr(c).lower()) == 1 and ord(chr(c).lower()) < 0x250)
_BLANK, _LETTER, _NUMBER, _SIGN = range(4)
#: The kind of each character of Latin-1.
_KINDS = np.array([_BLANK if 9 <= c <= 13 or c in (0x20, 0x85, 0xA0) else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _SIGN) for c in range(256)], np.uint8)
_LOWER = bytes(range(256)).decode("latin-1").lower().encode("latin-1")


def _is(x: np.ndarray, signs: bytes) -> np.ndarray:
    """Which values are one of a few characters."""
    return np.isin(x, np.frombuffer(signs, np.uint8))


def latin_words(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of lower-case Latin-1 texts, one after the other, and how many each text has.

    These are the matches of ``Encoder.WORDS``: runs of letters and of other signs, single numbers, and an
    apostrophe that begins a run of signs together with the ending after it.
    """
    signs = np.frombuffer(b"\n".join([*texts, b"\n\n"]), np.uint8)  # three blanks at least at the end
    kind = _KINDS[signs]
    begins = kind == _NUMBER
    begins[0] = True
    begins[1:] |= kind[1:] != kind[:-1]
    quotes = np.flatnonzero(signs == ord("'"))
    quotes = quotes[begins[quotes]]
    first, second = signs[quotes + 1], signs[quotes + 2]
    short = _is(first, b"stmd")
    long = _is(first, b"rv") & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    begins[quotes[short | long] + 1] = False
    begins[quotes[short] + 2] = True
    begins[quotes[long] + 3] = True
    starts = np.flatnonzero(begins)
    sizes = np.diff(starts, append=len(signs))
    said = kind[starts] != _BLANK
    stops = np.concatenate([[0], np.cumsum(sizes[said])]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(stops) - 1, [None, pa.py_buffer(stops), pa.py_buffer(signs[kind != _BLANK])])
    ends = np.searchsorted(starts[said], np.cumsum([len(t) + 1 for t in texts]))
    return words.dictionary_encode(), np.diff(ends, prepend=0)


class Encoder:
    """Token ids of texts, put together from remembered words.

    The tokenizer drops white space and merges only inside words, so words can
    be encoded apart.  They are found here only in plain Latin text, whose lower
    case and normal form are beyond doubt; where that is Latin-1, the words of many
    texts are found and told apart at once.  Of other texts, each chunk between
    ASCII white space that is not plain goes to the tokenizer as it is.
    Of more words than ``remember`` those that occurred in one call only are forgotten.
    """

    #: How the tokenizer parts plain lower-case text into words.
    WORDS = re.compile(rf"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+")
    ODD = re.compile(rf"[^{_STEADY}]|<\|")
    #: Marks a chunk that is kept whole; no word holds white space.
    WHOLE = " "

    def __init__(self, path: str, remember: int = 400_000, remember_chars: int = 16_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # A plain word is in normal form and in one part; blanks between words are all that is left to find.
        self.merger = Tokenizer.from_file(path)
        self.merger.normalizer = None
        self.merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = "<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4"
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.remember, self.remember_chars = remember, remember_chars
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.binary())
        self.ids = np.zeros(0, self.dtype)
        self.stops = np.zeros(1, np.int64)  # word k has ids[stops[k]:stops[k + 1]]
        self.calls = np.zeros(0, np.int32)  # in which word k occurred

    def _full(self) -> bool:
        return len(self.known) > self.remember or self.known.nbytes > self.remember_chars

    def _forget_rare(self) -> None:
        """Keep the words of two calls or more, if these are few enough; calls are counted anew."""
        kept = self.calls > 1
        if 2 * np.count_nonzero(kept) > self.remember:
            self._forget()
            return
        sizes = np.diff(self.stops)
        self.known = self.known.filter(pa.array(kept))
        self.ids = self.ids[np.repeat(kept, sizes)]
        self.stops = np.concatenate([[0], np.cumsum(sizes[kept])])
        self.calls = np.zeros(len(self.known), np.int32)
        if self._full():
            self._forget()

    def _plain(self, text: str) -> bool:
        return (text.isascii() and "<|" not in text) or not self.ODD.search(text)

    def _parts(self, text: str) -> list[str]:
        if self._plain(text):
            return self.WORDS.findall(text.lower())
        found: list[str] = []
        for chunk in text.encode().split():
            part = chunk.decode()
            if self._plain(part):
                found += self.WORDS.findall(part.lower())
            else:
                found.append(self.WHOLE + part)
        return found

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _numbers(self, words: pa.DictionaryArray) -> np.ndarray:
        """Numbers of words; the next numbers are given to new ones."""
        at = pc.index_in(words.dictionary, value_set=self.known)
        new = words.dictionary.filter(pc.is_null(at))
        numbers = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers[numbers < 0] = len(self.known) + np.arange(len(new))
        if len(new):
            self._learn([self._spelt(w) for w in new.to_pylist()])
            self.known = pa.concat_arrays([self.known, new])
            self.calls = np.concatenate([self.calls, np.zeros(len(new), np.int32)])
        self.calls[numbers] += 1
        return numbers[words.indices.to_numpy()]

    @staticmethod
    def _spelt(word: bytes) -> str:
        """Words of Latin-1 texts are kept as such, others in UTF-8 after a blank."""
        return word[1:].decode() if word[:1] == b" " else word.decode("latin-1")

    def _learn(self, new: list[str]) -> None:
        """Encode new words, many at once; each ends with the one token that ends a word."""
        ids, stops = [self.ids], [self.stops]
        at = int(self.stops[-1])
        for first in range(0, len(new), 400):
            part = new[first : first + 400]
            # A whole chunk may hold several words or none, and is encoded apart.
            plain = [w for w in part if w[0] != self.WHOLE]
            joined = np.array(self.merger.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, dtype=self.dtype)
            ends = np.flatnonzero(self.ends[joined]) + 1
            if len(plain) == len(part) == len(ends):
                ids.append(joined)
                stops.append(at + ends)
                at += len(joined)
                continue
            cuts = iter(np.split(joined, ends[:-1])) if len(plain) == len(ends) else None
            for word in part:
                made = next(cuts) if cuts and word[0] != self.WHOLE else self._encoded(word.removeprefix(self.WHOLE))
                at += len(made)
                ids.append(made)
                stops.append(np.array([at]))
        self.ids, self.stops = np.concatenate(ids), np.concatenate(stops)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        if self._full():
            self._forget_rare()
        latin, others = {}, {}
        for at, text in enumerate(texts):
            if not text:
                continue
            try:
                lower = text.encode("latin-1").translate(_LOWER)
            except UnicodeEncodeError:
                lower = b"<|"
            if b"<|" not in lower:
                latin[at] = lower
                continue
            others[at] = self._parts(text)
        said, many = latin_words(list(latin.values()))
        counts = np.zeros(len(texts), np.int64)
        counts[list(latin)] = many
        words = self._numbers(said)
        if others:
            counts[list(others)] = [len(x) for x in others.values()]
            apart = np.zeros(len(texts), bool)
            apart[list(others)] = True
            apart = np.repeat(apart, counts)
            more = self._numbers(pa.array([b" " + w.encode() for x in others.values() for w in x], pa.binary()).dictionary_encode())
            numbers, words = words, np.empty(len(apart), np.int64)
            # Words stand in the order of the texts again.
            words[~apart], words[apart] = numbers, more
        first = self.stops[words]
        sizes = self.stops[words + 1] - first
        before = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(first - before[:-1], sizes) + np.arange(before[-1])]
        cuts = before[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [ids[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of a Python worker; what it remembers serves the tasks that follow."""
    return Encoder(path)


def _every_term(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of many texts one after the other, their number of ids, and which terms count; no text is empty.

    The last id of a text begins no pair, but where it is the only one.
    """
    sizes = np.array([len(x) for x in ids])
    x = np.concatenate(ids).astype(np.uint32)
    last = np.cumsum(sizes) - 1
    pairs = x * np.uint32(2654435761)
    pairs[:-1] += x[1:] * np.uint32(40503)
    pairs[last] = x[last] * np.uint32(2654435761)
    paired = np.ones(len(x), bool)
    paired[last[sizes > 1]] = False
    return (pairs ^ (pairs >> np.uint32(15))) & np.uint32(TERMS - 1), sizes, paired


def terms(ids: np.ndarray) -> np.ndarray:
    """Hashed pairs of neighbouring ids; a single id pairs with nothing."""
    found, _, paired = _every_term([ids])
    return found[paired]


def bags(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, term, how often) of the different terms of many texts, by place and term."""
    found, sizes, paired = _every_term(ids)
    kind = np.uint32 if len(ids) < 1 << 16 else np.uint64
    found = np.sort((np.repeat(np.arange(len(ids), dtype=kind) << kind(16), sizes) | found)[paired])
    stops = np.append(np.flatnonzero(found[1:] != found[:-1]) + 1, len(found))
    found = found[stops - 1]
    return (found >> kind(16)).astype(np.int64), (found & kind(TERMS - 1)).astype(np.int64), np.diff(stops, prepend=0)


def lexical_keys(ids: list[np.ndarray]) -> list[int]:
    """A hash of each text's min-hash over its terms, 0 to 2**32 - 1."""
    if not ids:
        return []
    found, sizes, paired = _every_term(ids)
    mixed = found * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(16)
    mixed[~paired] = 0xFFFFFFFF
    least = np.minimum.reduceat(mixed, np.cumsum(sizes) - sizes).astype(np.uint64)
    keys = (least * np.uint64(0x85EBCA6B) ^ least >> np.uint64(13)) * np.uint64(0xC2B2AE35)
    return (keys & np.uint64(0xFFFFFFFF)).tolist()


def _slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(first, rows) of runs of about ``most`` bytes of text, so that long texts do not pile up."""
    first, held = 0, 0
    for at, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held > most:
            yield first, at - first
            first, held = at, 0
        held += size or 0
    if len(texts) > first:
        yield first, len(texts) - first


def _tokenise(path: str | None, window: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path or tokenizer_path())
        end = np.array([end_id], encoder.dtype)
        base = TaskContext.get().partitionId() << 36
        count = 0
        for batch in batches:
            for at, size in _slices(batch.column(1)):
                part = batch.slice(at, size)
                rows, tails = [], []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist()), strict=True):
                    n = len(ids) + 1
                    ids = np.concatenate([ids, end])
                    for start in range(0, n - window + 1, window):
                        count += 1
                        rows.append((base + count, doc_id, n, start, base + count, None, ids[start : start + window].tobytes()))
                    if rest := n % window:
                        count += 1
                        tails.append(ids[n - rest :])
                        rows.append((base + count, doc_id, n, n - rest, None, len(tails) - 1, tails[-1].tobytes()))
                types = [pa.int64()] * 6 + [pa.binary()]
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                columns[5] = pa.array(lexical_keys(tails), pa.int64()).take(columns[5])
                yield pa.RecordBatch.from_arrays(columns, names=["uid", "doc_id", "doc_tokens", "start", "sequence_id", "key", "ids"])

    return run


def _frequencies(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(TERMS, np.int64)
        for batch in batches:
            for at, size in _slices(batch.column(0), 2 << 20):
                texts = [np.frombuffer(x, dtype) for x in batch.column(0).slice(at, size).to_pylist()]
                counts += np.bincount(bags(texts)[1], minlength=TERMS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["term", "docs"])

    return run


class Index:
    """BM25 postings of one shard: for each term the documents and their weights."""

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        self.sizes = np.array([len(x) for x in ids])
        doc, term, tf = bags(ids)
        weight = idf[term] * tf * (_K1 + 1) / (tf + _K1 * (1 - _B + _B * self.sizes[doc] / mean))
        order = np.argsort(term.astype(np.uint16), kind="stable")
        self.term, self.doc, self.weight = term[order], doc[order], weight[order]
        many = np.bincount(term, minlength=TERMS)
        self.at = np.concatenate([[0], np.cumsum(many)])
        # A term that no other document has scores the seed alone, which is never asked for.
        shared = many[term] > 1
        self.own = np.split(term[shared], np.cumsum(np.bincount(doc[shared], minlength=len(ids)))[:-1])

    def of(self, docs: np.ndarray) -> Index:
        """The index in which only these documents are scored; any may still be a seed."""
        kept = np.zeros(len(self.sizes), bool)
        kept[docs] = True
        kept = kept[self.doc]
        index = copy(self)
        index.term, index.doc, index.weight = self.term[kept], self.doc[kept], self.weight[kept]
        index.at = np.concatenate([[0], np.cumsum(np.bincount(index.term, minlength=TERMS))])
        return index

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every other document for all different terms of the seed."""
        terms_ = self.own[seed]
        first = self.at[terms_]
        sizes = self.at[terms_ + 1] - first
        # The places of all postings, run after run.
        place = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.bincount(self.doc[place], self.weight[place], len(self.sizes))


def _greedy(sizes: np.ndarray, room: int, slack: int) -> tuple[list[int], int]:
    """Places of the documents that one pass in order puts into ``room``, and the room left; ends at ``slack``.

    Room only shrinks, so a document that did not fit never fits later, and one pass finds what asking for
    the first that fits again and again would.
    """
    picks, at = [], 0
    while at < len(sizes) and room > slack:
        part = sizes[at : at + 4096]
        start = int(np.argmax(part <= room))
        if part[start] > room:
            at += len(part)
            continue
        total = np.cumsum(part[start:])
        n = min(int(np.searchsorted(total, room, "right")), int(np.searchsorted(total, room - slack, "left")) + 1)
        picks += range(at + start, at + start + n)
        room -= int(total[n - 1])
        at += start + n
    return picks, room


def fill(index: Index, window: int, slack: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) pieces; every document lies whole in them.

    A seed asks with all of its different terms; unrelated documents follow in lexical order.
    Windows but the last are filled up to ``slack``.  The neighbour that no
    longer fits is cut, and its rest begins the next window.  A window costs time
    in proportion to the documents left, however short they are.
    """
    sizes = index.sizes
    unused = np.arange(len(sizes))
    held = len(unused)  # documents with postings
    windows, rest = [], None
    while rest or len(unused):
        # Postings of used documents go, again and again after a share of the rest, so their moving is linear in all.
        if len(unused) < 0.85 * held:
            index = index.of(unused)
            held = len(unused)
        if rest is None:
            rest, unused = (int(unused[0]), 0), unused[1:]
        seed, start = rest
        pieces, room, rest = [(seed, start, int(sizes[seed]) - start)], window - int(sizes[seed]) + start, None
        if room > slack and len(unused):
            scores = index.scores(seed)[unused]
            related = np.flatnonzero(scores)
            ranked = np.concatenate([related[np.argsort(-scores[related], kind="stable")], np.flatnonzero(scores == 0)])
            picks, room = _greedy(sizes[unused[ranked]], room, slack)
            pieces += [(d, 0, n) for d, n in zip(unused[ranked[picks]].tolist(), sizes[unused[ranked[picks]]].tolist(), strict=True)]
            gone = np.zeros(len(unused), bool)
            gone[ranked[picks]] = True
            if room > slack and len(picks) < len(ranked):
                cut = ranked[next((n for n, p in enumerate(picks) if n != p), len(picks))]
                pieces.append((int(unused[cut]), 0, room))
                rest, gone[cut] = (int(unused[cut]), room), True
            unused = unused[~gone]
        windows.append(pieces)
    return windows


def _pack(dtype: str, idf: np.ndarray, mean: float, window: int, slack: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("uid", "ascending")])
        ids = [np.frombuffer(x, dtype) for x in table.column("ids").to_pylist()]
        doc_ids, starts, totals = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        base = 1 << 62 | table.column("shard")[0].as_py() << 38 | table.column("sub")[0].as_py() << 14
        rows = []
        for n, pieces in enumerate(fill(Index(ids, idf, mean), window, slack)):
            offset = 0
            for doc, start, length in pieces:
                rows.append((doc_ids[doc], starts[doc] + start, length, totals[doc], base + n, offset, ids[doc][start : start + length].astype("<u4").tobytes()))
                offset += length
        types = [pa.int64()] * 6 + [pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.table({name: pa.array([r[i] for r in rows], t) for i, (name, t) in enumerate(zip(names, types, strict=True))})

    return run


def _widened(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x.as_py(), dtype).astype("<u4").tobytes() for x in batch.column("ids")]
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))

    return run


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, path: str | None = None, window: int = 2048, end_id: int = 1, shard_tokens: int = 1 << 20, slack: int = 16
) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit integers;
    a document's ids end with ``end_id``, and each lies in exactly one piece.
    Null and empty texts consist of ``end_id`` alone.  Repeated rows and rows
    with a null id are documents of their own; an empty table gives an empty result.
    Sequences are full up to ``slack`` ids, but for the last of each index shard.
    """
    dtype = encoder_of(path or tokenizer_path()).dtype
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("content"))
    tokens = written(rows.mapInArrow(_tokenise(path, window, end_id), _TOKENISED), "tokens", compression="zstd")
    whole = tokens.filter("sequence_id is not null").select(
        "doc_id", "start", F.lit(window).cast("long").alias("length"), "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"), "ids"
    )
    whole = whole.mapInArrow(_widened(dtype), _PIECES)
    tails = tokens.filter("sequence_id is null").withColumn("size", F.col("doc_tokens") - F.col("start"))
    tail = F.col("sequence_id").isNull()
    sums = [F.count("*").alias("rows"), F.count(F.when(tail, 1)).alias("tails"), F.sum(F.when(tail, F.col("doc_tokens") - F.col("start"))).alias("tokens")]
    size = tokens.agg(*sums).first()
    in_tails = size["tokens"] or 0
    mean = max(1.0, (in_tails + window * (size["rows"] - size["tails"])) / max(1, size["rows"]))
    shards = min(1 << 24, max(1, -(-in_tails // shard_tokens)))
    # One count per hashed term: bounded by TERMS.
    counted = tokens.select("ids").mapInArrow(_frequencies(dtype), "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).collect()
    frequency = np.zeros(TERMS)
    for r in counted:
        frequency[r["term"]] = r["docs"]
    idf = np.log1p((size["rows"] - frequency + 0.5) / (frequency + 0.5))

    tails = tails.withColumn("shard", F.shiftrightunsigned(F.col("key") * F.lit(shards), 32))
    load = tails.groupBy("shard").agg(F.sum("size").alias("tokens"))
    # Written, so that Spark knows its size and broadcasts it only if small.
    overfull = written(load.filter(F.col("tokens") > 2 * shard_tokens).select("shard", F.ceil(F.col("tokens") / shard_tokens).alias("parts")), "overfull")
    dealt = tails.join(overfull, "shard", "left").withColumn("sub", F.pmod(F.xxhash64("uid"), F.coalesce("parts", F.lit(1))))
    packed = dealt.drop("parts", "size", "sequence_id").groupBy("shard", "sub").applyInArrow(_pack(dtype, idf, mean, window, slack), _PIECES)
    return whole.unionByName(packed).withColumnRenamed("doc_id", id_col)

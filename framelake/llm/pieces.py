"""SentencePiece encoding and decoding of byte-pair models, by vectorised merge rounds.

A text gets a space in front and its spaces become U+2581; a word is a run of those and what follows up to the next, as no piece has
one after another character. The words of many documents lie in one flat array of symbols. A round finds in every word the
pair of the smallest rank, merges its places from the left and closes the gaps; words without a pair leave. The order is the library's:
best score first, from the left. A merge may make a pair that comes before the rest (a few pieces are learned before their
parts): its word merges no further in that round, so the next round sees that pair.

Characters that no piece has become bytes. `encode` gives ids as little-endian unsigned 32-bit integers, as token files hold them;
`decode` gives the text back as the library's decode does: begin and end are invisible, a leading space goes, bytes that are
no UTF-8 become U+FFFD each.

Null texts are empty: begin and end only. Repeated rows each come back, ids of documents may be null, an empty table gives no rows. Other
columns are not carried. Texts are cut at spaces into parts, so memory follows the longest word, and the words seen are kept up to a bound.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.common import query, read

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Characters of a part; words kept from one part to the next.
PART, KEPT = 1 << 21, 200_000
NONE = np.iinfo(np.int32).max
#: Symbols of characters that no piece has.
OTHER = 1 << 24

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class Vocabulary:
    """The tables of a model: symbols of characters, and rank and piece of every pair. Its size is that of the vocabulary."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        if any(map(model.is_unused, ids)) or model.encode("\U000e0100")[-1:] == [self.unknown]:
            raise ValueError("a model with unused pieces, or without bytes for unknown characters, is not supported")
        self.pieces = [model.id_to_piece(i) for i in ids]
        self.hidden = np.array([model.is_control(i) for i in ids])
        self.shown = ["" if self.hidden[i] else " ⁇ " if i == self.unknown else p for i, p in enumerate(self.pieces)]
        self.bytes = np.array([int(p[3:5], 16) if model.is_byte(i) else -1 for i, p in enumerate(self.pieces)], np.int64)
        self.byte_ids = np.zeros(256, np.int64)
        self.byte_ids[self.bytes[self.bytes >= 0]] = np.flatnonzero(self.bytes >= 0)
        special = self.hidden | (self.bytes >= 0) | (np.arange(len(self.pieces)) == self.unknown)
        symbols = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        ranked = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in symbols.values()}, reverse=True))}
        self.words = not any(SPACE in p.lstrip(SPACE) for p in symbols)
        for char in {c for p in symbols for c in p} - symbols.keys():
            symbols[char] = len(self.pieces) + ord(char)
        self.chars = {ord(p): i for p, i in symbols.items() if len(p) == 1}
        pairs = {(symbols[p[:k]], symbols[p[k:]]): i for p, i in symbols.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.made = keys[order], np.array(list(pairs.values()), np.int32)[order]
        self.ranks = np.array([ranked[model.get_score(int(i))] for i in self.made], np.int32)
        self._table()

    def _table(self) -> None:
        """Pairs by a hash, eight places for each on average: nearly all are found by one look."""
        bits = max(4, (8 * len(self.keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(self.keys))
        at = self._slot(self.keys)
        while len(left):  # the first of each place stays, the others move on by one
            first = np.unique(at, return_index=True)[1]
            free = first[self.slots[at[first]] < 0]
            self.slots[at[free]] = left[free]
            rest = np.setdiff1d(np.arange(len(left)), free)
            left, at = left[rest], (at[rest] + 1) & (len(self.slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, symbol made) of each pair; NONE where there is no such piece."""
        rank, made = np.full(len(a), NONE, np.int32), np.zeros(len(a), np.int32)
        keys = a.astype(np.int64) << 32 | b
        todo, at = np.arange(len(a)), self._slot(keys)
        while len(todo):
            slot = self.slots[at]
            hit = slot >= 0
            todo, at, slot = todo[hit], at[hit], slot[hit]
            same = self.keys[slot] == keys[todo]
            rank[todo[same]], made[todo[same]] = self.ranks[slot[same]], self.made[slot[same]]
            todo, at = todo[~same], (at[~same] + 1) & (len(self.slots) - 1)
        return rank, made

    def points(self) -> np.ndarray:
        """The symbol of every code point."""
        out = np.arange(0x110000, dtype=np.int32) + OTHER
        out[list(self.chars)] = list(self.chars.values())
        return out


def _selected(least: np.ndarray) -> np.ndarray:
    """Of neighbouring places, which share a symbol, every second one, beginning with the first."""
    at = np.flatnonzero(least)
    run = np.concatenate(([True], np.diff(at) > 1))
    return at[(at - at[run][np.cumsum(run) - 1]) % 2 == 0]


def merged(v: Vocabulary, points: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the words, one after the other, and how many each has."""
    s = points[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
    word = np.repeat(np.arange(len(words), dtype=np.int32), np.fromiter(map(len, words), np.int64, len(words)))
    last = np.append(word[1:] != word[:-1], True)[:len(s)]
    rank, made = v.pair(s, np.append(s[1:], 0)[:len(s)])
    rank[last] = NONE  # of each symbol with the next
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(s):
        starts = np.flatnonzero(last)[:-1] + 1
        starts = np.concatenate(([0], starts))
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(s)))
        if (least == NONE).any():
            over = np.repeat(least == NONE, sizes)
            done.append((word[over], s[over]))
            s, word, rank, made, last = s[~over], word[~over], rank[~over], made[~over], last[~over]
            sizes, least = sizes[least != NONE], least[least != NONE]
            if not len(s):
                break
        at = _selected(rank == np.repeat(least, sizes))
        at = at[~_behind(v, s, word, rank, made, at)]
        s[at] = made[at]
        last[at] = last[at + 1]
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s, word, rank, made, last = s[keep], word[keep], rank[keep], made[keep], last[keep]
        at -= np.arange(len(at))
        at = np.concatenate((at[at > 0] - 1, at))  # only pairs with a new symbol have changed
        new, piece = v.pair(s[at], s[np.minimum(at + 1, len(s) - 1)])
        new[last[at]] = NONE
        rank[at], made[at] = new, piece
    word, s = np.concatenate([w for w, _ in done] or [word]), np.concatenate([x for _, x in done] or [s])
    order = np.argsort(word, kind="stable")
    return _bytes_of_others(v, s[order], word[order], len(words))


def _behind(v: Vocabulary, s: np.ndarray, word: np.ndarray, rank: np.ndarray, made: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places behind one of the same word whose merge makes a pair that comes before (or level with) the rest."""
    again = np.flatnonzero(word[at[1:]] == word[at[:-1]])  # words with several places
    if not len(again):
        return np.zeros(len(at), bool)
    several = np.isin(word[at], word[at[again]])
    some = at[several]
    new, size = made[some], len(s)
    before = np.where(np.isin(some - 2, some), made[some - 2], s[some - 1])  # what is on the left has been merged by then
    has_left = (some > 0) & (word[some - 1] == word[some])
    right = np.minimum(some + 2, size - 1)
    has_right = (some + 2 < size) & (word[right] == word[some])
    early = has_left & (v.pair(before, new)[0] <= rank[some]) | has_right & (v.pair(new, s[right])[0] <= rank[some])
    out = np.zeros(len(at), bool)
    if early.any():
        first = np.full(word[-1] + 1, size)
        np.minimum.at(first, word[some[early]], some[early])
        out[several] = some > first[word[some]]
    return out


def _bytes_of_others(v: Vocabulary, s: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    other = np.flatnonzero(s >= len(v.pieces))
    if len(other):
        points = np.where(s[other] >= OTHER, s[other] - OTHER, s[other] - len(v.pieces))
        coded = [chr(p).encode("utf-8", "surrogatepass") for p in points.tolist()]
        times = np.ones(len(s), np.int64)
        times[other] = [len(c) for c in coded]
        place = np.repeat(np.isin(np.arange(len(s)), other), times)
        s, word = np.repeat(s, times), np.repeat(word, times)
        s[place] = v.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
    return s, np.bincount(word, minlength=n)


_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def _parts(v: Vocabulary, text: str | None) -> Iterator[str]:
    """The text as the model sees it, cut before spaces."""
    text = f" {text}".replace(" ", SPACE) if text else ""
    begin = 0
    while begin < len(text):
        end = text.find(SPACE, begin + PART) if v.words else -1
        while 0 < end < len(text) and text[end - 1] == SPACE:  # spaces stay together
            end = text.find(SPACE, end + 1)
        end = end if end > 0 else len(text)
        yield text[begin:end]
        begin = end


class _Numbers(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Ids of texts. Keeps the ids of words it has seen."""

    def __init__(self, v: Vocabulary):
        self.v, self.points = v, v.points()
        self.clear()

    def clear(self) -> None:
        self.number = _Numbers()
        self.ids, self.first, self.count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > KEPT:
            self.clear()
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if self.number.new:
            ids, count = merged(self.v, self.points, self.number.new)
            self.number.new = []
            self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(count) - count))
            self.ids, self.count = np.concatenate((self.ids, ids)), np.concatenate((self.count, count))
        return at

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the parts of texts, and how many each has."""
        lists = [_WORD.findall(t) if self.v.words else [t] for t in texts]
        at = self._numbers([w for ws in lists for w in ws])
        count = self.count[at]
        ends = np.concatenate(([0], np.cumsum(count)))
        inner = np.arange(ends[-1]) - np.repeat(ends[:-1], count)
        bounds = ends[np.cumsum([0, *map(len, lists)])]
        return self.ids[np.repeat(self.first[at], count) + inner], np.diff(bounds)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Begin, ids and end of each text as bytes; small texts go through together."""
        waiting: list[list[bytes]] = []
        parts: list[str] = []
        owner: list[list[bytes]] = []
        size = 0
        edge = [np.array([i], "<u4").tobytes() for i in (self.v.begin, self.v.end)]

        def settle() -> None:
            ids, counts = self.flat(parts)
            data, at = ids.astype("<u4").tobytes(), 0
            for own, n in zip(owner, counts.tolist()):
                own.append(data[at:at + 4 * n])
                at += 4 * n
            parts.clear(), owner.clear()

        for text in texts:
            waiting.append([edge[0]])
            for part in _parts(self.v, text):
                parts.append(part)
                owner.append(waiting[-1])
                size += len(part)
                if size >= PART:
                    settle()
                    size = 0
                    yield from (b"".join([*w, edge[1]]) for w in waiting[:-1])
                    del waiting[:-1]
        settle()
        yield from (b"".join([*w, edge[1]]) for w in waiting)


def decoded(v: Vocabulary, data: bytes | None) -> str:
    """The text of ids."""
    ids = np.frombuffer(data or b"", "<u4").astype(np.int64)
    raw = v.bytes[ids] >= 0
    out: list[str] = []
    edges = np.flatnonzero(np.diff(np.concatenate(([False], raw, [False])).astype(np.int8)))
    at = 0
    for begin, end in [*zip(edges[::2].tolist(), edges[1::2].tolist()), (len(ids), len(ids))]:
        out += map(v.shown.__getitem__, ids[at:begin].tolist())
        out.append(v.bytes[ids[begin:end]].astype(np.uint8).tobytes().decode("utf-8", "each-byte"))
        at = end
    text = "".join(out)
    return text[text.startswith(SPACE):].replace(SPACE, " ")


def _small(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The rows in small batches, as texts, ids and words lie side by side."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Vocabulary(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary) of every text with the model at `path`, begin and end included."""
    shared = _shared(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in _small(batches):
            ids = pa.array(encoder.encode(batch.column("text").to_pylist()), pa.large_binary()).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, text: the text of every row's `ids`; null ids give an empty text."""
    shared = _shared(coded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            texts = pa.array((decoded(shared.value, d) for d in batch.column("ids").to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), texts], ["doc_id", "ids", "text"])
    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


@query("op11_sentence_pieces")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path(MODEL)
    out = decode(encode(read(spark, sf, "documents"), path), path)
    n = F.floor(F.coalesce(F.length("ids"), F.lit(0)) / 4).cast("long")
    return out.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))

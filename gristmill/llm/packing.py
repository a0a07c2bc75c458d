"""Packing of tokenised documents into sequences by swap-based local search.

A document's token ids, then the separator id 0, are cut into pieces of at most `CAPACITY` tokens (only
longer documents are cut). Within a group of pieces, best fit on falling lengths gives a first packing.
Then documents move between underfull bins: from the emptiest bins, one piece moves into a gap, or is
exchanged for a shorter one, or two pieces are exchanged for one, whenever this increases the sum of
squared fills, until bins become empty or no such step is left within the budget. Groups keep their
well-filled bins; pieces of the other bins of many groups meet in a second round of the same kind.

Null text counts as empty: one piece that holds the separator alone. Repeated rows and repeated ids are
packed row by row. An empty table gives an empty result. Extra columns are ignored. Every piece is
placed; nothing is dropped.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import give_back, stored, text_chunks

CAPACITY = 2048
GROUP_PIECES = 8000  #: pieces of a group, about, in the first round
MEET = 32  #: groups whose underfull bins meet in the second round
FILLED = 0.995  #: bins filled to this share are left alone in the second round
STEPS = 20_000  #: exchanges that the local search of one group makes at most
TOKENIZER = "word_bpe_49k.json"

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, slot bigint"
_PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, group bigint, bin bigint, offset bigint, fill bigint"
#: The kinds of bytes of a lowered text by which the tokenizer parts it. Bytes from 0xC4 on, and most after
#: 0xC3, belong to letters; 0xC2 begins signs but for three letters, and 0xC3 two signs.
_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_KIND = np.array([_BLANK if c in b" \t\n\r\x0b\x0c" else _DIGIT if 48 <= c <= 57 else _LETTER if 97 <= c <= 122 or c >= 128 else _SIGN for c in range(256)], np.uint8)
_C2_LETTERS, _C3_SIGNS = (0xAA, 0xB5, 0xBA), (0x97, 0xB7)
#: Endings that an apostrophe takes along.
_ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")
#: Characters that the kinds do not cover: those whose classes differ between regular expression libraries, and all beyond U+024F.
_ODD = re.compile("[^\x01-\x1b\x20-\x84\x86-\x9f\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")


def is_odd(lowered: str) -> bool:
    """Whether a lowered text holds an odd character; ASCII has five of them, which plain searches find fastest."""
    if lowered.isascii():
        return any(c in lowered for c in "\x00\x1c\x1d\x1e\x1f")
    return _ODD.search(lowered) is not None


def segments(data: np.ndarray) -> np.ndarray:
    """Where the parts of a lowered text without odd characters begin (blank runs between them count as parts), and its end.

    A part is a run of letters, a digit, a run of signs, or a lone apostrophe with an ending that follows it.
    """
    kind = _KIND[data]
    if data.max(initial=0) >= 128:
        for lead, ends, other in ((0xC2, _C2_LETTERS, _SIGN), (0xC3, _C3_SIGNS, _LETTER)):
            at = np.flatnonzero(data[:-1] == lead)
            kind[at] = kind[at + 1] = np.where(np.isin(data[at + 1], ends), _LETTER + _SIGN - other, other)
    first = np.empty(len(data), bool)
    first[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first |= kind == _DIGIT
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    quote = np.flatnonzero((data == 39) & first)
    quote = quote[(padded[quote + 1] >= 97) & (padded[quote + 1] <= 122)]
    if len(quote):
        x, y = padded[quote + 1], padded[quote + 2]
        for ending in _ENDINGS:
            own = quote[(x == ending[0]) & ((y == ending[1]) if len(ending) == 2 else True)]
            first[own + 1] = False
            after = own + 1 + len(ending)
            after = after[after < len(data)]
            first[after[kind[after] == _LETTER]] = True
    return np.append(np.flatnonzero(first), len(data)).astype(np.int32)


def _slices(a: pa.BinaryArray) -> list[bytes]:
    """The values of a binary array, many times faster than by its own conversion."""
    edges = np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + len(a) + 1].tolist()
    data = a.buffers()[2].to_pybytes()
    return list(map(data.__getitem__, map(slice, edges, edges[1:])))


class TokenIds:
    """Ids of texts, as little-endian unsigned 32-bit integers; those of words are remembered within bounds.

    The tokenizer lower-cases, parts a text by one expression and encodes each part on its own, with an end mark
    in the last token of each. So a text's ids are those of its parts in turn. The parts of a chunk are found and
    told apart side by side; new ones go through the tokenizer many at a time, parted by blanks, and the end marks
    tell them apart. A text whose lowered form has an odd character, or one with a special token's name, goes
    through the tokenizer as it is.
    """

    def __init__(self, path: str, words: int = 400_000, chars: int = 8_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.words, self.chars, self.size = words, chars, 0
        self.known: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        lowered = [t.lower() for t in texts]
        plain = [i for i, t in enumerate(lowered) if not is_odd(t) and "<|" not in t]
        out: list[bytes | None] = [None] * len(texts)
        if plain:
            for i, ids in zip(plain, self._parted([lowered[i] for i in plain]), strict=True):
                out[i] = ids
        return [self._whole(t) if ids is None else ids for t, ids in zip(texts, out, strict=True)]

    def _parted(self, texts: list[str]) -> list[bytes | None]:
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        at = segments(data)
        every = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        parts = _slices(every.dictionary)
        own = self._ids(parts)
        size = np.fromiter(map(len, own), np.int64, len(own)) // 4
        number = every.indices.to_numpy()
        count = size[number]
        ends = np.cumsum(count)
        joined = np.frombuffer(b"".join(own), "<u4")
        joined = joined[np.repeat((np.cumsum(size) - size)[number] - (ends - count), count) + np.arange(ends[-1])].tobytes()
        # A text's parts are those that begin before its end; a blank run at the end may reach into the next text.
        text_ends = np.cumsum([len(r) + 1 for r in raw])
        cuts = [0, *(4 * np.append(0, ends)[np.searchsorted(at[:-1], text_ends)]).tolist()]
        return [joined[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part, none for blanks; new ones are remembered."""
        if len(self.known) > self.words or self.size > self.chars:
            self.known = {w: self.known[w] for w in parts if w in self.known}
            self.size = sum(map(len, self.known))
        own = list(map(self.known.get, parts))
        missing = [k for k, ids in enumerate(own) if ids is None]
        new = [parts[k] for k in missing]
        self.known.update((w, b"") for w in new if w.isspace())
        words = [w for w in new if not w.isspace()]
        for i in range(0, len(words), 2_000):
            part = words[i : i + 2_000]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(part):  # a part that is not one word to the tokenizer: each on its own
                self.known.update((w, self._whole(w.decode())) for w in part)
                continue
            data, ends = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.known.update(zip(part, map(data.__getitem__, map(slice, ends, ends[1:])), strict=False))
        self.size += sum(map(len, new))
        for k, w in zip(missing, new, strict=True):
            own[k] = self.known[w]
        return own

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def token_ids(path: str) -> TokenIds:
    """The tokenizer of this process: a worker's later tasks find its words remembered (its bounds hold throughout)."""
    return TokenIds(path)


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of every row, each with a `slot` that spreads rows evenly whatever their ids.

    A slot comes from a row's place, so the pieces are to be written before anything is dealt by it: a task that runs
    again may number its rows anew.
    """
    out = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("slot", pa.int64())])

    def run(batches):
        tokens = token_ids(path)
        salt, count = TaskContext.get().partitionId(), 0
        for cols, texts in text_chunks(batches, 1_000_000):
            rows: list[list] = [[] for _ in out]
            for doc, ids in zip(cols["doc_id"], tokens.encode(texts), strict=True):
                ids += b"\x00\x00\x00\x00"
                for k in range(0, len(ids) // 4, CAPACITY):
                    own = ids[4 * k : 4 * (k + CAPACITY)]
                    slot = zlib.crc32(b"%d.%d" % (salt, count))
                    count += 1
                    for into, v in zip(rows, (doc, k // CAPACITY, k, len(own) // 4, zlib.crc32(own), slot), strict=True):
                        into.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, out, strict=True)], schema=out)
        give_back()

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, _PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions, longest pieces first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has exactly r tokens of room
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = (fits & -fits).bit_length() - 1 + n
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        by_room[room - n].append(b)
        if room > n:
            rooms |= 1 << (room - n)
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, steps: int | None = STEPS) -> list[list[int]]:
    """Moves and exchanges between underfull bins that increase the sum of squared fills; empty bins go. Without ``steps`` it runs to a local optimum."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    work = sorted((k for k, f in enumerate(fill) if f < capacity), key=lambda k: fill[k])
    closed = [b for b, f in zip(bins, fill, strict=True) if f >= capacity]
    own = {k: list(bins[k]) for k in work}
    left = float("inf") if steps is None else steps

    def try_step(d: int) -> bool:
        """One step that takes tokens from bin d and adds them to a fuller one."""
        nonlocal left
        for a in sorted((k for k in own if k != d and fill[k] < capacity and fill[k] >= fill[d]), key=lambda k: -fill[k]):
            room = capacity - fill[a]
            left -= 1
            if left <= 0:
                return False
            given = sorted(own[d], key=lambda i: -lengths[i])
            for y in given:  # move
                if lengths[y] <= room:
                    own[d].remove(y)
                    own[a].append(y)
                    fill[a] += lengths[y]
                    fill[d] -= lengths[y]
                    return True
            best = None
            for y in given:  # one for one: a longer piece for a shorter one
                for x in own[a]:
                    gain = lengths[y] - lengths[x]
                    if 0 < gain <= room and (best is None or gain > best[0]):
                        best = gain, [y], [x]
            if best is None or best[0] < room:
                for p in range(len(given)):  # two for one, either way
                    for q in range(p + 1, len(given)):
                        both = lengths[given[p]] + lengths[given[q]]
                        for x in own[a]:
                            gain = both - lengths[x]
                            if 0 < gain <= room and (best is None or gain > best[0]):
                                best = gain, [given[p], given[q]], [x]
                mine = own[a]
                for p in range(len(mine)):
                    for q in range(p + 1, len(mine)):
                        both = lengths[mine[p]] + lengths[mine[q]]
                        for y in given:
                            gain = lengths[y] - both
                            if 0 < gain <= room and (best is None or gain > best[0]):
                                best = gain, [y], [mine[p], mine[q]]
            if best:
                gain, ys, xs = best
                own[d] = [i for i in own[d] if i not in ys] + xs
                own[a] = [i for i in own[a] if i not in xs] + ys
                fill[a] += gain
                fill[d] -= gain
                return True
        return False

    waiting = list(reversed(work))  # the emptiest bin last
    while waiting and left > 0:
        d = waiting[-1]
        if not own.get(d):
            own.pop(d, None)
            waiting.pop()
        elif not try_step(d):
            waiting.pop()
    return closed + [b for b in own.values() if b]


def place(rows: dict[str, np.ndarray], group: int, steps: int | None = STEPS) -> dict[str, np.ndarray]:
    lengths = rows["length"].tolist()
    bins = local_search(best_fit(lengths, CAPACITY), lengths, CAPACITY, steps)
    at = np.array([i for b in bins for i in b], np.int64)
    number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    offset = [o for b in bins for o in accumulate((lengths[i] for i in b[:-1]), initial=0)]
    fill = np.repeat([sum(lengths[i] for i in b) for b in bins], [len(b) for b in bins])
    return {k: rows[k][at] for k in ("doc_id", "piece", "start", "length", "ids_crc32")} | {"group": np.full(len(at), group), "bin": number, "offset": np.array(offset, np.int64), "fill": fill}


def _pack(df: DataFrame, steps: int | None) -> DataFrame:
    """Packs each `group` on its own."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        g = key[0].as_py()
        # The order within a group decides ties only; it is made independent of how the rows came.
        table = table.sort_by([("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        ids = table.column("doc_id")
        rows = {k: table.column(k).to_numpy() for k in ("piece", "start", "length", "ids_crc32")} | {"doc_id": np.arange(len(table))}
        out = place(rows, g, steps)
        at = out.pop("doc_id")
        return pa.table({"doc_id": ids.take(pa.array(at)), **out}).select(["doc_id", "piece", "start", "length", "ids_crc32", "group", "bin", "offset", "fill"]).cast(
            pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "group", "bin", "offset", "fill"))])
        )

    return df.groupBy("group").applyInArrow(run, _PLACED)


def pack(docs: DataFrame, tokenizer: str | None = None, group_pieces: int = GROUP_PIECES, steps: int | None = STEPS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece; ``steps`` bounds each group's local search (None: to a local optimum)."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    every = stored(pieces(docs, tokenizer))
    groups = max(1, -(-every.count() // group_pieces))
    first = stored(_pack(every.withColumn("group", F.col("slot") % groups), steps))
    under = F.col("fill") < FILLED * CAPACITY
    again = _pack(first.filter(under).withColumn("group", F.floor(F.col("group") / MEET)), steps)
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32"]
    number = lambda even: (F.col("group") * (1 << 24) + F.col("bin")) * 2 + even
    return first.filter(~under).select(*wanted, number(0).alias("sequence_id"), "offset").unionByName(again.select(*wanted, number(1).alias("sequence_id"), "offset"))

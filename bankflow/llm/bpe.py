"""Byte-level BPE with vectorised pre-tokenisation (operator 7).

The split pattern of the rank files is run without a regular expression engine. Every code point gets a class from
a table; classes and one or two characters of look-ahead give each position a symbol; a symbol is a function from
the state before it to the state after it. Functions compose associatively, so the states of all positions come
from a blocked prefix scan over the (finite) monoid of these functions, with numpy look-ups only. A piece starts
where (state before, symbol) says so. Pieces then go through a cache to rank merging, and the byte offset of each
token is kept, by which ``decode`` puts the tokens back.

Defined cases: a null or empty text has no tokens and decodes to no bytes; repeated rows give repeated results; an
empty table gives an empty table; input columns with the names of added ones are replaced; any other column
passes through, nulls included.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bankflow.llm.arrow_text import append_columns, gather, packed, utf8_buffer

LETTER, NUMBER, OTHER, WHITE, SPACE = range(5)

# White_Space code points of Unicode (what \s matches).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000]

# Symbols: what a position does to the state.
S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_GLUE, S_LONE, S_SHORT, S_LONG = range(8)
N_SYMBOLS = 8  # symbol + N_SYMBOLS is the same symbol as the first of a text
# States: the piece that the position before belongs to.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, GLUED, CLOSED, ONE_MORE, TWO_MORE = range(8)
N_STATES = 8

CACHE_PIECES = 1 << 19   # pieces remembered by a worker; beyond it the cache starts anew
SCAN_COLUMNS = 256
RUN_BYTES = 1 << 20      # bytes of text that a worker goes through at a time (about 100 bytes of arrays for each)


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for code in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(code))[0])
        if kind is not None:
            table[code] = kind
    table[WHITE_SPACE] = WHITE
    table[0x20] = SPACE
    return table


def step(state: int, symbol: int) -> tuple[int, bool]:
    """One position: the state after it, and whether a piece starts at it."""
    if symbol >= N_SYMBOLS:
        state, symbol = CLOSED, symbol - N_SYMBOLS
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return CLOSED, False
    if symbol == S_GLUE:        # the last space of a run joins what follows it
        return GLUED, True
    if symbol == S_LONE:        # the last white space of a run, if it is no space, is a piece
        return CLOSED, True
    if symbol in (S_SHORT, S_LONG) and state not in (IN_OTHERS, GLUED):
        return (ONE_MORE if symbol == S_SHORT else TWO_MORE), True
    after = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_WHITE: IN_WHITE}.get(symbol, IN_OTHERS)
    return after, not (state == after or state == GLUED)


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' functions: (composition table, state table, element of symbol, starts)."""
    functions = [tuple(step(s, c)[0] for s in range(N_STATES)) for c in range(2 * N_SYMBOLS)]
    identity = tuple(range(N_STATES))
    elements = {identity: 0}
    queue = [identity]
    for f in queue:
        for g in functions:
            h = tuple(g[s] for s in f)
            if h not in elements:
                elements[h] = len(elements)
                queue.append(h)
    compose = np.empty((len(queue), len(queue)), np.uint16)
    for i, f in enumerate(queue):
        for j, g in enumerate(queue):
            compose[i, j] = elements[tuple(g[s] for s in f)]
    of_symbol = np.array([elements[f] for f in functions], np.uint16)
    starts = np.array([[step(s, c)[1] for c in range(2 * N_SYMBOLS)] for s in range(N_STATES)])
    return compose, np.array(queue, np.uint8), of_symbol, starts


def scan(elements: np.ndarray) -> np.ndarray:
    """Composition of all elements before each position (exclusive prefix scan), block by block."""
    compose = monoid()[0]
    n = len(elements)
    if n <= SCAN_COLUMNS:
        out = np.zeros(n, np.uint16)
        acc = 0
        for i in range(n):
            out[i] = acc
            acc = compose[acc, elements[i]]
        return out
    width = SCAN_COLUMNS
    blocks = -(-n // width)
    padded = np.zeros(blocks * width, np.uint16)
    padded[:n] = elements
    columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
    before = np.empty_like(columns)
    acc = np.zeros(blocks, np.uint16)
    for t in range(width):
        before[t] = acc
        acc = compose[acc, columns[t]]
    carried = scan(acc)
    return compose[carried[None, :], before].T.reshape(-1)[:n]


def symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of each position; ``first`` marks the first character of each text."""
    n = len(codes)
    kind = class_table()[codes]
    last = np.empty(n, bool)
    last[:-1], last[-1:] = first[1:], True
    white = kind >= WHITE
    next_white = np.empty(n, bool)
    next_white[:-1], next_white[-1:] = white[1:], True
    runs_on = next_white | last           # a white character before the end of its run, or of the text
    symbol = np.where(white, S_WHITE, kind).astype(np.uint8)
    symbol[white & ~runs_on & (kind == SPACE)] = S_GLUE
    symbol[white & ~runs_on & (kind == WHITE)] = S_LONE
    quotes = np.flatnonzero(codes == ord("'"))
    quotes = quotes[~last[quotes]]
    one = codes[quotes + 1]
    symbol[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
    two = ~last[quotes + 1]
    quotes, one = quotes[two], one[two]
    after = codes[quotes + 2]
    pair = np.zeros(len(quotes), bool)
    for a, b in ("re", "ve", "ll"):
        pair |= (one == ord(a)) & (after == ord(b))
    symbol[quotes[pair]] = S_LONG
    return symbol + N_SYMBOLS * first.astype(np.uint8)


def piece_starts(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions at which the pieces of the split pattern start."""
    if not len(codes):
        return np.empty(0, np.int64)
    _, states, of_symbol, starts = monoid()
    symbol = symbols(codes, first)
    before = states[scan(of_symbol[symbol]), CLOSED]
    return np.flatnonzero(starts[before, symbol])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """Rank merging on token ids: which token two adjacent ones make, and with what rank, is one look-up."""

    NONE = 1 << 40
    SHORT = 64           # pieces of up to so many bytes keep the ranks of their pairs in a list, longer ones in a heap

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 20 | right] = rank
        self.single = [ranks.get(bytes([b])) for b in range(256)]

    def merge(self, piece: bytes) -> list[int]:
        """Tokens of one piece: merge the adjacent pair of least rank, the leftmost first, as long as there is one."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        ids = [self.single[b] for b in piece]
        if None in ids:
            raise ValueError("the rank file lacks a single byte")
        return self._short(ids) if len(ids) <= self.SHORT else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        get, none = self.pairs.get, self.NONE
        found = [get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while found and (least := min(found)) != none:
            i = found.index(least)
            ids[i:i + 2] = [least]
            del found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << 20 | least, none)
            if i < len(found):
                found[i] = get(least << 20 | ids[i + 1], none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := get(a << 20 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue                      # one of the two has changed meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(rank << 20 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[k]))
            if (h := before[i]) >= 0 and (r := get(ids[h] << 20 | rank)) is not None:
                heapq.heappush(heap, (r, h, ids[h], rank))
        return [t for t in ids if t >= 0]


class Pieces(dict):
    """Cache from a piece to its slot; the slots' tokens lie in one flat array."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merge, self.flat, self.start, self.length = merges.merge, array("I"), array("q"), array("i")

    def __missing__(self, piece: bytes) -> int:
        tokens = self.merge(piece)
        slot = self[piece] = len(self.start)
        self.start.append(len(self.flat))
        self.length.append(len(tokens))
        self.flat.extend(tokens)
        return slot


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str):
        self.path, self.pieces = path, None
        ranks = load_ranks(path)
        tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts as UTF-8 bytes and offsets -> (ids of all texts, ids per text, byte offset of each id in its text)."""
        if self.pieces is None or len(self.pieces) > CACHE_PIECES:
            self.pieces = Pieces(_merges(self.path))
        raw = data.tobytes()
        codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))   # byte offset of each character
        char_offsets = np.searchsorted(at, offsets)
        first = np.zeros(len(codes) + 1, bool)
        first[char_offsets[:-1][np.diff(offsets) > 0]] = True
        begin = at[piece_starts(codes, first[:len(codes)])]
        bounds = np.append(begin, len(data)).tolist()
        slots = np.fromiter(map(self.pieces.__getitem__, [raw[a:b] for a, b in zip(bounds, bounds[1:])]),
                            np.int64, len(bounds) - 1)
        count = np.frombuffer(self.pieces.length, np.int32)[slots].astype(np.int64) if len(slots) else slots
        start = np.frombuffer(self.pieces.start, np.int64)[slots] if len(slots) else slots
        flat = np.frombuffer(self.pieces.flat, np.uint32) if len(slots) else np.empty(0, np.uint32)
        ids = gather(flat, start, count)
        upto = np.concatenate([[0], np.cumsum(count)])
        per_text = np.diff(upto[np.searchsorted(begin, offsets)])
        size = self.lengths[ids]
        token_at = np.cumsum(size) - size - np.repeat(offsets[:-1], per_text)
        return ids, per_text, token_at.astype(np.uint32)

    def decode(self, ids: np.ndarray, token_at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their byte offsets -> (bytes of all texts, bytes per text). Each token goes to its own offset."""
        ends = np.cumsum(counts)
        size = np.zeros(len(counts), np.int64)
        some = counts > 0
        size[some] = token_at[ends[some] - 1].astype(np.int64) + self.lengths[ids[ends[some] - 1]]
        base = np.cumsum(size) - size
        length = self.lengths[ids]
        target = np.repeat(np.repeat(base, counts) + token_at, length)
        within = np.arange(len(target)) - np.repeat(np.cumsum(length) - length, length)
        out = np.zeros(int(size.sum()), np.uint8)
        out[target + within] = self.bytes[np.repeat(self.starts[ids], length) + within]
        return out, size


@lru_cache(1)
def _merges(path: str) -> Merges:
    return Merges(load_ranks(path))


@lru_cache(4)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def encode(df: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """Add ``bpe_ids`` and ``bpe_starts`` (packed little-endian unsigned 32-bit: token ids and the byte offset of
    each token in the text) and ``n_tokens``. ``ranks_path`` is a file that every worker can open."""
    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, counts, at = codec(ranks_path).encode(*utf8_buffer(batch.column(batch.schema.get_field_index(text))))
        return [packed(ids, counts), packed(at, counts), pa.array(counts, pa.int64())]

    return append_columns(df, text, "bpe_ids binary, bpe_starts binary, n_tokens bigint", fn, run_bytes=RUN_BYTES)


def decode(df: DataFrame, ranks_path: str, keep: list[str] | None = None) -> DataFrame:
    """Add ``decoded`` (binary): the bytes that ``bpe_ids`` and ``bpe_starts`` stand for."""
    kept = list(dict.fromkeys([*(keep if keep is not None else df.columns), "bpe_ids", "bpe_starts"]))

    def fn(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, offsets = utf8_buffer(batch.column(batch.schema.get_field_index("bpe_ids")))
        at, _ = utf8_buffer(batch.column(batch.schema.get_field_index("bpe_starts")))
        out, size = codec(ranks_path).decode(np.frombuffer(ids.tobytes(), "<u4"), np.frombuffer(at.tobytes(), "<u4"),
                                             np.diff(offsets) // 4)
        return [packed(out, size)]

    return append_columns(df, "bpe_ids", "decoded binary", fn, keep=kept, run_bytes=RUN_BYTES)

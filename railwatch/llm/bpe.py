"""A byte-level BPE vocabulary compiled to finite-state transducers.

Two machines run one after the other.

*Splitter.*  A deterministic automaton of eight states over nine character classes marks where a
piece (word with its space, number, symbols, white space, contraction) begins.  A text is cut into
chunks of equal length; the chunks are stepped side by side, each giving its map of entry to exit
states (the maps form a small monoid, so a map is one number); the maps compose in a parallel prefix scan; a second walk from the now known
entry states emits the marks.

*Counter.*  Inside a piece, the state after a prefix is the prefix's own encoding, of which only the
last token, the state before that token and the number of tokens are kept.  Reading a byte appends
the longest token that ends here and that may follow the last token of the state before it; this
is the one encoding that the ordered merges give.  The transition is annotated with the change of
the number of tokens, so a piece's tokens are the sum along its path, and walking back over the last
tokens gives the ids.  States are shared by common prefixes and compiled level by level for all
pieces that a slab brings for the first time; finished pieces stay in a table of bounded size.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from functools import lru_cache

import numpy as np

from railwatch.llm.blocks import Slab, mix, same_spans, span_hashes

# Classes of the splitter.
SPACE_WORD, SPACE_RUN, WHITE_WORD, WHITE_RUN, LETTER, NUMBER, OTHER, SHORT_FORM, LONG_FORM = range(9)
START, IN_LETTERS, IN_NUMBER, IN_OTHER, AFTER_SPACE, IN_WHITE, TWO_LEFT, ONE_LEFT = range(8)
CHUNK = 128
LONG_PIECE = 96
TABLE_BITS = 20
TABLE_BYTES = 32 << 20


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and begin mark for (symbol, state); symbols 9 to 17 are the classes at a segment's head."""
    to, begins = np.zeros((18, 8), np.uint8), np.ones((18, 8), bool)
    for state in range(8):
        for kind, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBER), (OTHER, IN_OTHER)):
            to[kind, state] = run
            begins[kind, state] = state not in (run, AFTER_SPACE)
        for kind, left in ((SHORT_FORM, ONE_LEFT), (LONG_FORM, TWO_LEFT)):
            inside = state in (IN_OTHER, AFTER_SPACE)
            to[kind, state], begins[kind, state] = (IN_OTHER if inside else left), not inside
        for kind in (SPACE_RUN, WHITE_RUN):
            to[kind, state], begins[kind, state] = IN_WHITE, state != IN_WHITE
        to[SPACE_WORD, state], to[WHITE_WORD, state] = AFTER_SPACE, START
    to[LETTER, TWO_LEFT], begins[LETTER, TWO_LEFT] = ONE_LEFT, False
    to[LETTER, ONE_LEFT], begins[LETTER, ONE_LEFT] = START, False
    to[9:] = to[:9, START][:, None]
    return to, begins


_TO, _BEGINS = _splitter()


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All state maps that texts can have, closed under composition.

    Gives the number of each symbol's map, the table ``first then second`` of map numbers, and
    the state that each map leads to from the start.
    """
    maps = [tuple(range(8))]
    known = {maps[0]: 0}
    for m in maps:
        for row in _TO.tolist():
            grown = tuple(row[state] for state in m)
            if grown not in known:
                known[grown] = len(maps)
                maps.append(grown)
    if len(maps) > 255:
        raise AssertionError("state maps no longer fit in a byte")
    table = np.array([[known[tuple(two[state] for state in one)] for two in maps] for one in maps], np.uint8)
    return np.array([known[tuple(row)] for row in _TO.tolist()], np.uint8), table, np.array([m[START] for m in maps], np.uint8)


_MAP_OF, _THEN, _FROM_START = _monoid()


class Table:
    """Fixed 64-bit keys with values, looked up many at a time; absent keys give -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(4, int(len(keys) * 3).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask, self.keys, self.values = size - 1, np.zeros(size, np.uint64), np.full(size, -1, np.int64)
        self.full = np.zeros(size, bool)
        rows, slot = np.arange(len(keys)), self._home(keys)
        while len(rows):
            free = ~self.full[slot]
            self.keys[slot[free]] = keys[rows[free]]
            won = free & (self.keys[slot] == keys[rows])
            self.full[slot[won]] = True
            self.values[slot[won]] = values[rows[won]]
            rows, slot = rows[~won], (slot[~won] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._home(keys)
        same = self.keys[slot] == keys
        out = np.where(same, self.values[slot], -1)
        rows = np.flatnonzero(~same & self.full[slot])
        while len(rows):
            slot[rows] = (slot[rows] + 1) & self.mask
            at = slot[rows]
            same = (self.keys[at] == keys[rows]) & self.full[at]
            out[rows[same]] = self.values[at[same]]
            rows = rows[~same & self.full[at]]
        return out


@lru_cache(1)
def _classes() -> np.ndarray:
    """Letter, number, white space (as ``WHITE_RUN``) or other for every code point."""
    names = {"L": LETTER, "N": NUMBER}
    kinds = bytes(names.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000))
    out = np.frombuffer(kinds, np.uint8).copy()
    # The code points with the White_Space property.
    white = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    out[white] = WHITE_RUN
    return out


def _symbols(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Class of every code point; ``heads`` marks the first one of each segment."""
    kind = _classes()[points]
    white = kind == WHITE_RUN
    ends = np.append(heads[1:], True)
    before_word = ~np.append(white[1:], True) & ~ends
    space = points == 32
    kind[white & before_word] = WHITE_WORD
    kind[space] = np.where(before_word[space], SPACE_WORD, SPACE_RUN)
    marks = np.flatnonzero(points == 39)
    if len(marks):
        padded = np.append(points, [0, 0])
        fence = np.append(heads, [True, True])
        one, two = padded[marks + 1], padded[marks + 2]
        near = ~fence[marks + 1]
        short = near & np.isin(one, np.frombuffer(b"stmd", np.uint8))
        far = near & ~fence[marks + 2]
        long = far & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        kind[marks[short]] = SHORT_FORM
        kind[marks[long]] = LONG_FORM
    return kind


def piece_starts(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Marks where pieces begin, by chunk maps and their prefix scan."""
    n = len(points)
    symbol = _symbols(points, heads)
    symbol[heads] += 9
    rows = -(-n // CHUNK)
    grid = np.zeros(rows * CHUNK, np.uint8)
    grid[:n] = symbol
    by_column = np.ascontiguousarray(grid.reshape(rows, CHUNK).T).astype(np.int64)
    width = _THEN.shape[1]
    grow = _THEN[:, _MAP_OF].T.ravel()  # (symbol, map so far) to the longer map
    maps = np.zeros(rows, np.uint8)
    for column in by_column:
        maps = grow[column * width + maps]
    # Inclusive scan: after a step of width d, row i holds the composition of the 2d maps that end at i.
    step = 1
    while step < rows:
        maps = np.concatenate([maps[:step], _THEN[maps[:-step], maps[step:]]])
        step *= 2
    state = np.empty(rows, np.uint8)
    state[0], state[1:] = START, _FROM_START[maps[:-1]]
    marks = np.empty((CHUNK, rows), bool)
    flat_to, flat_begins = _TO.ravel(), _BEGINS.ravel()
    for j, column in enumerate(by_column):
        at = (column << 3) | state
        marks[j] = flat_begins[at]
        state = flat_to[at]
    return marks.T.reshape(-1)[:n]


class Vocabulary:
    """The merges of a byte-level BPE file as lookup arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        if model["model"]["type"] != "BPE" or model.get("normalizer") or not model["pre_tokenizer"].get("use_regex", True):
            raise ValueError("a byte-level BPE file without normaliser is needed")
        vocabulary = model["model"]["vocab"]
        byte_of = {symbol: value for value, symbol in enumerate(_byte_symbols())}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        size = len(vocabulary)
        # Rank ids: single bytes first, then merges in order; the order decides which merge comes first.
        singles = sorted((s for s in vocabulary if len(s) == 1), key=vocabulary.get)
        rank = {s: i for i, s in enumerate(singles)} | {a + b: len(singles) + i for i, (a, b) in enumerate(merges)}
        if len(rank) != size:
            raise ValueError("every token must be a byte or a merge")
        self.ids = np.zeros(size, np.uint32)
        self.left, self.right = np.arange(size, dtype=np.int64), np.arange(size, dtype=np.int64)
        self.length = np.zeros(size, np.int64)
        self.byte_rank = np.zeros(256, np.int64)
        self.singles = len(singles)
        pairs, merged, suffixes = [], [], {}
        for symbol, r in rank.items():
            self.ids[r] = vocabulary[symbol]
            raw = bytes(byte_of[c] for c in symbol)
            self.length[r] = len(raw)
            if len(raw) == 1:
                self.byte_rank[raw[0]] = r
            value = 0
            for k in range(1, len(raw) + 1):
                value = self._longer(value, raw[-k])
                suffixes.setdefault(value, -1)
            suffixes[value] = r
        for (a, b) in merges:
            whole = rank[a + b]
            self.left[whole], self.right[whole] = rank[a], rank[b]
            pairs.append(rank[a] * size + rank[b])
            merged.append(whole)
        self.merges = Table(np.array(pairs, np.uint64), np.array(merged, np.int64))
        self.size = size
        # The end of some token: 0 if it is no token itself, else the token's rank plus one.
        self.suffixes = Table(np.array(list(suffixes), np.uint64), np.array(list(suffixes.values()), np.int64) + 1)
        self.special = [t["content"].encode() for t in model.get("added_tokens", []) if t.get("special")]
        self.special_ids = [t["id"] for t in model.get("added_tokens", []) if t.get("special")]

    @staticmethod
    def _longer(value: int, byte: int) -> int:
        """Hash of a suffix that grows to the left by ``byte``."""
        return ((value * 0x100000001B3) ^ (byte + 1) * 0x9E3779B97F4A7C15) % (1 << 64)

    def may_follow(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the merges leave the border between the two tokens of each pair alone.

        The merges that made both tokens are undone from the last one on; a pair that meets at
        the border and merges earlier than the merge just undone would have been joined.
        """
        good = np.ones(len(one), bool)
        at, limit = np.arange(len(one)), np.full(len(one), np.iinfo(np.int64).max)
        one, two = one.copy(), two.copy()
        while len(at):
            merged = self.merges.find((one * self.size + two).astype(np.uint64))
            joined = (merged >= 0) & (merged < limit)
            good[at[joined]] = False
            from_left = one > two
            limit = np.where(from_left, one, two + 1)
            ended = np.where(from_left, one, two) < self.singles
            one, two = np.where(from_left, self.right[one], one), np.where(from_left, two, self.left[two])
            on = ~joined & ~ended
            at, limit, one, two = at[on], limit[on], one[on], two[on]
        return good

    def encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and flat rank ids of the pieces ``data[start:end]``."""
        length = end - start
        pieces = len(start)
        # State 0 is the empty prefix; the others are appended level by level.
        parent, byte, last, before, count = (np.zeros(1, np.int64) for _ in range(5))
        at = np.zeros(pieces, np.int64)
        alive = np.arange(pieces)
        depth = 0
        while len(alive):
            alive = alive[length[alive] > depth]
            if not len(alive):
                break
            step = at[alive] * 256 + data[start[alive] + depth]
            fresh, inverse = np.unique(step, return_inverse=True)
            base = len(parent)
            above, read = fresh >> 8, fresh & 255
            token, rest = self._last_token(above, read, parent, byte, last)
            parent, byte = np.concatenate([parent, above]), np.concatenate([byte, read])
            last, before = np.concatenate([last, token]), np.concatenate([before, rest])
            count = np.concatenate([count, count[rest] + 1])
            at[alive] = base + inverse
            depth += 1
        counts = count[at]
        offsets = np.zeros(pieces + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        flat = np.zeros(offsets[-1], np.int64)
        place, walk, rows = offsets[1:] - 1, at.copy(), np.flatnonzero(counts)
        while len(rows):
            flat[place[rows]] = last[walk[rows]]
            walk[rows] = before[walk[rows]]
            place[rows] -= 1
            rows = rows[walk[rows] > 0]
        return counts, flat

    def _last_token(self, above, read, parent, byte, last) -> tuple[np.ndarray, np.ndarray]:
        """The last token after reading a byte in each state, and the state before that token."""
        n = len(above)
        token, rest = self.byte_rank[read].copy(), above.copy()
        rows, walk, value = np.arange(n), above, np.zeros(n, np.uint64)
        added = read
        found_rows, found_token, found_rest = [], [], []
        while len(rows):
            value = (value * np.uint64(0x100000001B3)) ^ ((added + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            known = self.suffixes.find(value)
            on = known >= 0
            rows, walk, value, known = rows[on], walk[on], value[on], known[on]
            hit = known > 0
            found_rows.append(rows[hit])
            found_token.append(known[hit] - 1)
            found_rest.append(walk[hit])
            on = walk > 0
            rows, value = rows[on], value[on]
            added, walk = byte[walk[on]], parent[walk[on]]
        rows, tokens, rests = np.concatenate(found_rows), np.concatenate(found_token), np.concatenate(found_rest)
        good = rests == 0
        good[~good] = self.may_follow(last[rests[~good]], tokens[~good])
        rows, tokens, rests = rows[good], tokens[good], rests[good]
        # Later entries are longer tokens: the last assignment of a row stays.
        token[rows], rest[rows] = tokens, rests
        return token, rest

    def encode_long(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encode`, for long pieces: in chunks side by side, encoded anew around borders that do not hold.

        A sequence of tokens is the one encoding of its bytes if every token may follow the one before it.  So
        chunks that meet in such a pair stay as they are; where they do not, the tokens around the border are
        encoded together, in windows that double until both their ends hold.
        """
        chunks = -(-(end - start) // CHUNK)
        piece = np.repeat(np.arange(len(start)), chunks)
        place = np.arange(len(piece)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        begin = start[piece] + place * CHUNK
        counts, token = self.encode(data, begin, np.minimum(begin + CHUNK, end[piece]))
        of = np.repeat(piece, counts)
        borders = (np.cumsum(counts) - counts)[place > 0]
        width = 2
        while len(borders):
            borders = borders[~self.may_follow(token[borders - 1], token[borders])]
            if not len(borders):
                break
            inside = of[borders]
            low = np.maximum(borders - width, np.searchsorted(of, inside))
            high = np.minimum(borders + width, np.searchsorted(of, inside, side="right"))
            # Windows that touch become one.
            heads = np.flatnonzero(np.r_[True, (low[1:] > high[:-1]) | (inside[1:] != inside[:-1])])
            low, high = low[heads], np.maximum.reduceat(high, heads)
            inside = of[low]
            stops = np.cumsum(self.length[token])
            # Bytes count from the first one of the piece on, whatever lies between pieces.
            base = start[inside] - np.where(inside > 0, stops[np.searchsorted(of, inside) - 1], 0)
            counts, inner = self.encode(data, base + stops[low] - self.length[token[low]], base + stops[high - 1])
            kept = np.ones(len(token), bool)
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                kept[a:b] = False
            key = np.concatenate([np.flatnonzero(kept), np.repeat(low, counts)])
            order = np.argsort(key, kind="stable")
            token = np.concatenate([token[kept], inner])[order]
            of = np.concatenate([of[kept], np.repeat(inside, counts)])[order]
            ends = np.unique(np.concatenate([np.searchsorted(key[order], low), np.searchsorted(key[order], low, side="right")]))
            ends = ends[(ends > 0) & (ends < len(token))]
            borders = ends[of[ends - 1] == of[ends]]
            width *= 2
        return np.bincount(of, minlength=len(start)), token


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for value in range(256):
        out.append(chr(value if value in shown else extra))
        extra += value not in shown
    return out


class Encoder:
    """Counts or ids of whole texts, with a table of the pieces seen so far.

    The table holds at most half of ``2 ** TABLE_BITS`` pieces and ``TABLE_BYTES`` of text and is emptied when full,
    so its memory does not grow with the data; a single slab with more than that gets a larger one.  A
    piece is found by its hash and taken only if its bytes are the same; a piece whose hash another one
    holds goes by a further hash.
    """

    def __init__(self, path: str, keep_ids: bool) -> None:
        self.vocabulary, self.keep_ids = Vocabulary(path), keep_ids
        self._clear()

    def _clear(self, pieces: int = 0) -> None:
        self.bits = max(TABLE_BITS, (2 * pieces).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.counts, self.places, self.texts, self.lengths = (np.zeros(1 << self.bits, np.int32) for _ in range(4))
        self.flat, self.bytes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint8)
        self.used = self.flat_used = self.bytes_used = 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        mask = np.uint64((1 << self.bits) - 1)
        out = np.full(len(keys), -1, np.int64)
        rows, slot = np.arange(len(keys)), (keys & mask).astype(np.int64)
        while len(rows):
            held = self.keys[slot]
            hit = held == keys[rows]
            out[rows[hit]] = slot[hit]
            on = ~hit & (held != 0)
            rows, slot = rows[on], (slot[on] + 1) & int(mask)
        return out

    def _insert(self, keys: np.ndarray) -> np.ndarray:
        """New distinct keys; gives their slots."""
        mask = (1 << self.bits) - 1
        out = np.zeros(len(keys), np.int64)
        rows, slot = np.arange(len(keys)), (keys & np.uint64(mask)).astype(np.int64)
        while len(rows):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[rows[free]]
            won = free & (self.keys[slot] == keys[rows])
            out[rows[won]] = slot[won]
            rows, slot = rows[~won], (slot[~won] + 1) & mask
        self.used += len(keys)
        return out

    @staticmethod
    def _room(held: np.ndarray, need: int) -> np.ndarray:
        if need <= len(held):
            return held
        return np.concatenate([held, np.zeros(max(need, 2 * len(held)) - len(held), held.dtype)])

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray) -> None:
        slots = self._insert(keys)
        length = end - start
        need = self.bytes_used + int(length.sum())
        self.bytes = self._room(self.bytes, need)
        at = self.bytes_used + np.cumsum(length) - length
        self.bytes[self.bytes_used:need] = data[np.repeat(start - at, length) + np.arange(self.bytes_used, need)]
        self.texts[slots], self.lengths[slots], self.bytes_used = at, length, need
        long = length > LONG_PIECE
        for some, encode in ((~long, self.vocabulary.encode), (long, self.vocabulary.encode_long)):
            if not some.any():
                continue
            counts, ranks = encode(data, start[some], end[some])
            self.counts[slots[some]] = counts
            if self.keep_ids:
                self.places[slots[some]] = self.flat_used + np.cumsum(counts) - counts
                need = self.flat_used + len(ranks)
                self.flat = self._room(self.flat, need)
                self.flat[self.flat_used:need] = self.vocabulary.ids[ranks]
                self.flat_used = need

    def pieces(self, slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of every piece of a slab, and the special token it is (or -1)."""
        segments, rows, special = [], [], []
        raw = slab.data.tobytes() if any(s in slab.data.tobytes() for s in self.vocabulary.special) else None
        for row in range(slab.rows):
            at, end = int(slab.offsets[row]), int(slab.offsets[row + 1])
            while raw is not None:
                found = min(((p, k) for k, s in enumerate(self.vocabulary.special) if (p := raw.find(s, at, end)) >= 0), default=None)
                if found is None:
                    break
                place, k = found
                stop = place + len(self.vocabulary.special[k])
                segments += [(at, place), (place, stop)]
                rows += [row, row]
                special += [-1, k]
                at = stop
            segments.append((at, end))
            rows.append(row)
            special.append(-1)
        bounds, rows, special = np.array(segments, np.int64), np.array(rows), np.array(special)
        full = bounds[:, 1] > bounds[:, 0]
        bounds, rows, special = bounds[full], rows[full], special[full]
        if not len(bounds):
            return (np.zeros(0, np.int64),) * 4
        points = np.frombuffer(slab.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        if len(points) == len(slab.data):
            at_byte = None
            heads_at = bounds[:, 0]
        else:
            at_byte = np.flatnonzero((slab.data & 0xC0) != 0x80)
            heads_at = np.searchsorted(at_byte, bounds[:, 0])
        heads = np.zeros(len(points), bool)
        heads[heads_at] = True
        begin = np.flatnonzero(piece_starts(points, heads))
        if at_byte is not None:
            begin = at_byte[begin]
        segment = np.searchsorted(bounds[:, 0], begin, side="right") - 1
        kind = special[segment]
        keep = (kind < 0) | (begin == bounds[segment, 0])
        begin, segment, kind = begin[keep], segment[keep], kind[keep]
        end = np.minimum(np.append(begin[1:], len(slab.data)), bounds[segment, 1])
        return begin, end, rows[segment], kind

    def slots(self, slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Table slot, row and special mark of every piece, after new pieces were compiled."""
        start, end, row, special = self.pieces(slab)
        slot = np.full(len(start), -1, np.int64)
        plain = np.flatnonzero(special < 0)
        own = mix(span_hashes(slab.data, start, end)) | np.uint64(1)
        rows, keys, emptied = plain, own.copy(), False
        while len(rows):
            found = self._find(keys[rows])
            new = rows[found < 0]
            if len(new):
                distinct, first = np.unique(keys[new], return_index=True)
                chosen = new[first]
                over = self.bytes_used + int((end - start)[chosen].sum()) > TABLE_BYTES
                if self.used + len(distinct) > 1 << (self.bits - 1) or (over and self.used and not emptied):
                    # Begin again with an empty table that has room for all of this slab.
                    self._clear(len(plain))
                    rows, keys, emptied = plain, own.copy(), True
                    continue
                self._learn(slab.data, start[chosen], end[chosen], distinct)
                found = self._find(keys[rows])
            length = (end - start)[rows]
            same = np.flatnonzero(self.lengths[found] == length)
            same = same[same_spans(slab.data, start[rows[same]], self.bytes, self.texts[found[same]].astype(np.int64), length[same])]
            slot[rows[same]] = found[same]
            apart = np.ones(len(rows), bool)
            apart[same] = False
            rows = rows[apart]
            keys[rows] = mix(keys[rows] + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return slot, row, special

    def count(self, slab: Slab) -> np.ndarray:
        """Tokens of every row."""
        slot, row, special = self.slots(slab)
        each = np.where(special < 0, self.counts[slot], 1)
        return np.bincount(row, weights=each, minlength=slab.rows).astype(np.int64)

    def ids(self, slab: Slab) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of every row, and all ids in order."""
        slot, row, special = self.slots(slab)
        plain = special < 0
        each = np.where(plain, self.counts[slot], 1).astype(np.int64)
        offsets = np.zeros(len(each) + 1, np.int64)
        np.cumsum(each, out=offsets[1:])
        source = np.repeat(np.where(plain, self.places[slot].astype(np.int64), 0) - offsets[:-1], each) + np.arange(offsets[-1])
        flat = self.flat[source]
        for i in np.flatnonzero(~plain):
            flat[offsets[i]] = self.vocabulary.special_ids[special[i]]
        return np.bincount(row, weights=each, minlength=slab.rows).astype(np.int64), flat


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, keep_ids: bool) -> Encoder:
    """One encoder a file in each Python worker, kept between batches and tasks."""
    if (path, keep_ids) not in _encoders:
        _encoders[path, keep_ids] = Encoder(path, keep_ids)
    return _encoders[path, keep_ids]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())

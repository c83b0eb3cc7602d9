"""Finite-state compilation of a word-ended byte-pair tokenizer that counts tokens.

Two deterministic transducers read a text.  The first splits it into pre-tokens (letter runs, single
digits, runs of other signs, the English contractions); the second reads one pre-token's bytes and
every transition is annotated with the number of tokens it adds to (or takes from) the output, so
that the sum of annotations along a path is the token count.  Nothing is ever merged at run time.

The first machine has seven states: a chunk of text is a map from states to states, chunk maps are
composed by a parallel prefix scan, and all chunks then run side by side from their true start state.
The second machine is determinised on demand: a transition is compiled from the merge table the first
time a text needs it, and all pre-tokens of a batch step through the compiled table side by side.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

from pricelens.llm import unicode_classes
from pricelens.llm.unicode_classes import code_point_classes, is_latin, young_code_points

#: The pre-token pattern these machines implement (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Code points of white space (fixed values).
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# input classes of the splitting machine
SPACE, DIGIT, OTHER, QUOTE, LETTER, L_END, L_R, L_V, L_L, L_E = range(10)
# its states: fresh, in a letter run, in a run of other signs, quote pending, quote + r / v / l pending
FRESH, WORD, SIGNS, Q, Q_R, Q_V, Q_L = range(7)
_LETTERS = (LETTER, L_END, L_R, L_V, L_L, L_E)


def _split_machine() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next state; whether a pre-token starts at this character; whether one starts at the character before."""
    nxt = np.zeros((7, 10), np.uint8)
    here = np.zeros((7, 10), bool)
    before = np.zeros((7, 10), bool)
    for s in range(7):
        for c in range(10):
            letter = c in _LETTERS
            if s == Q and (c in (L_END, L_R, L_V, L_L)):      # contraction ends, or may end
                nxt[s, c] = {L_END: FRESH, L_R: Q_R, L_V: Q_V, L_L: Q_L}[c]
                continue
            if (s, c) in ((Q_R, L_E), (Q_V, L_E), (Q_L, L_L)):
                nxt[s, c] = FRESH
                continue
            if s in (Q_R, Q_V, Q_L):                          # no contraction: its letter began a word
                before[s, c] = True
                run = WORD
            else:
                run = SIGNS if s == Q else s                  # a lone quote begins a run of signs
            if c in (SPACE, DIGIT):
                nxt[s, c], here[s, c] = FRESH, c == DIGIT
            elif letter:
                nxt[s, c], here[s, c] = WORD, run != WORD
            elif run == SIGNS:
                nxt[s, c] = SIGNS
            else:
                nxt[s, c], here[s, c] = (Q if c == QUOTE else SIGNS), True
    return nxt, here, before


_NEXT, _HERE, _BEFORE = _split_machine()
_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Input class of every code point (built once per process)."""
    if not _classes:
        classes = code_point_classes()[0]
        kind = np.full(0x110000, OTHER, np.uint8)
        kind[classes == unicode_classes.LETTER] = LETTER
        kind[classes == unicode_classes.DIGIT] = DIGIT
        kind[WHITE] = SPACE
        kind[ord("'")] = QUOTE
        for letters, c in (("stmd", L_END), ("r", L_R), ("v", L_V), ("l", L_L), ("e", L_E)):
            for x in letters:
                kind[ord(x)] = c
        _classes.append(kind)
    return _classes[0]


def scan_states(cls: np.ndarray, chunk: int = 256) -> np.ndarray:
    """State before every character, by chunk state maps and a parallel prefix scan.

    Returns ``len(cls) + 1`` states, the last one after the whole input.
    """
    n = len(cls)
    lanes = max(1, -(-n // chunk))
    grid = np.full(lanes * chunk, SPACE, np.uint8)
    grid[:n] = cls
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)      # step x lane
    flat = _NEXT.ravel()
    # map of each chunk: for every start state the end state; lanes whose states met run on as one
    ends = np.tile(np.arange(7, dtype=np.uint8), (lanes, 1))
    open_lanes = np.arange(lanes)
    one = np.zeros(lanes, np.uint8)
    met_at = np.full(lanes, chunk)
    t = 0
    while t < chunk and len(open_lanes):
        part = ends[open_lanes]
        for t in range(t, min(chunk, t + 8)):
            part = flat[part.astype(np.intp) * 10 + grid[t, open_lanes][:, None]]
        t += 1
        ends[open_lanes] = part
        same = (part == part[:, :1]).all(axis=1)
        met = open_lanes[same]
        met_at[met], one[met] = t, part[same, 0]
        open_lanes = open_lanes[~same]
    if t < chunk:
        first = int(met_at.min(initial=chunk))
        for step in range(first, chunk):
            live = met_at <= step
            moved = flat[one.astype(np.intp) * 10 + grid[step]]
            one = np.where(live, moved, one)
        done = met_at < chunk
        ends[done] = one[done][:, None]
    # inclusive scan: after it, ends[i] maps a state before chunk 0 to the state after chunk i
    reach = 1
    while reach < lanes:
        ends[reach:] = np.take_along_axis(ends[reach:], ends[:-reach].astype(np.intp), axis=1)
        reach *= 2
    state = np.empty(lanes, np.uint8)
    state[0], state[1:] = FRESH, ends[:-1, FRESH]
    out = np.empty((chunk, lanes), np.uint8)
    for step in range(chunk):
        out[step] = state
        state = flat[state.astype(np.intp) * 10 + grid[step]]
    before = np.empty(n + 1, np.uint8)
    before[:n] = out.T.ravel()[:n]
    last = int(before[n - 1]) if n else FRESH
    before[n] = _NEXT[last, cls[n - 1]] if n else FRESH
    return before


def pretoken_starts(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of every pre-token and the character after its last one.

    The input must end in white space.
    """
    before = scan_states(cls)
    idx = before[:-1].astype(np.intp) * 10 + cls
    start = _HERE.ravel()[idx]
    start[:-1] |= _BEFORE.ravel()[idx][1:]
    starts = np.flatnonzero(start)
    filled = cls != SPACE
    # a pre-token ends where the next one starts or where white space begins
    stop = start | ~filled
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, "right")]
    return starts, ends


_KIND = np.array([0, 1, 2, 2, *[3] * len(_LETTERS)], np.uint8)      # white space, digit, other sign, letter


def pretoken_spans(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``pretoken_starts`` returns, by comparing neighbours: pre-tokens are runs but for contractions.

    A quote that begins a run of signs may begin a contraction, which only the next two characters decide.
    """
    n, kind = len(cls), _KIND[cls]
    stop = np.ones(n, bool)                                       # a run begins, or it is white space or a digit
    np.not_equal(kind[1:], kind[:-1], out=stop[1:])
    stop |= kind < 2
    quote = np.flatnonzero(cls == QUOTE)
    quote = quote[(quote == 0) | (kind[quote - 1] != 2)]
    one, two = cls[quote + 1], cls[np.minimum(quote + 2, n - 1)]
    short = one == L_END
    long = (((one == L_R) | (one == L_V)) & (two == L_E)) | ((one == L_L) & (two == L_L))
    stop[quote[short | long] + 1] = False
    stop[np.concatenate([quote[short] + 2, quote[long] + 3])] = True        # whatever follows, white space too
    stops = np.flatnonzero(stop)
    first = np.flatnonzero(kind[stops])
    return stops[first], stops[first + 1]


class TokenCounter:
    """Compiled tokenizer: counts the tokens of whole texts exactly as the library does."""

    MAX_STATES = 1 << 18          # the lazy table is dropped and rebuilt beyond this many states

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model["byte_fallback"]
                or model["ignore_merges"] or steps[0]["pattern"]["Regex"] != PATTERN):
            raise ValueError("only word-ended byte-level BPE with the known pre-token pattern is compiled")
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(
            spec["added_tokens"], key=lambda t: -len(t["content"]))) or r"(?!)")
        self.young, self.normalizer = young_code_points().search, Tokenizer.from_file(path).normalizer
        self._load(model)
        self._reset()

    # -- compilation of the merge table -------------------------------------------------------
    def _load(self, model: dict) -> None:
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in printable}
        shown.update({b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in shown)})
        symbol = {}
        for b, ch in shown.items():
            symbol[ch], symbol[ch + "</w>"] = b, 256 + b          # a final byte is a letter of its own
        ids = dict(symbol)
        self.spell: list[tuple[int, ...]] = [(i,) for i in range(512)]
        self.rank = [-1] * 512
        self.children: list[tuple[int, int] | None] = [None] * 512
        self.merge: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = ids[a], ids[b]
            if a + b in ids:
                raise ValueError("two merges make the same token")
            ids[a + b] = len(self.spell)
            self.merge[left, right] = r
            self.spell.append(self.spell[left] + self.spell[right])
            self.rank.append(r)
            self.children.append((left, right))
        # edge pieces with the rank of the merge that swallows them
        top = 1 << 60
        self.right_edge: list[list[tuple[int, int]]] = [[(i, top)] for i in range(512)]
        self.left_edge: list[list[tuple[int, int]]] = [[(i, top)] for i in range(512)]
        for t in range(512, len(self.spell)):
            left, right = self.children[t]
            r = self.rank[t]
            self.right_edge.append([(t, top)] + [(x, min(p, r)) for x, p in self.right_edge[right]])
            self.left_edge.append([(t, top)] + [(x, min(p, r)) for x, p in self.left_edge[left]])
        self._meets: dict[tuple[int, int], bool] = {}
        # tokens that the merges really produce, by spelling; their prefixes make the trie
        self.token: dict[tuple[int, ...], int] = {(i,): i for i in range(512)}
        sound = [True] * 512
        for t in range(512, len(self.spell)):
            left, right = self.children[t]
            ok = sound[left] and sound[right] and self._stable(left, right, self.rank[t])
            sound.append(ok)
            if ok:
                self.token[self.spell[t]] = t
        self.prefix: set[tuple[int, ...]] = {()}
        for s in self.token:
            for k in range(1, len(s)):
                self.prefix.add(s[:k])
        self.longest = max(map(len, self.token))

    def _stable(self, left: int, right: int, until: int) -> bool:
        """No merge across the boundary comes before ``until`` while both edge pieces stand."""
        merge = self.merge
        for x, px in self.right_edge[left]:
            for y, py in self.left_edge[right]:
                m = merge.get((x, y))
                if m is not None and m < until and m < px and m <= py:
                    return False
        return True

    def _fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are the encoding of their bytes."""
        key = (left, right)
        ok = self._meets.get(key)
        if ok is None:
            ok = self._meets[key] = self._stable(left, right, 1 << 60)
        return ok

    # -- lazily determinised counting machine -------------------------------------------------
    # A state holds the bytes that may still belong to a longer token, and for every place in them
    # where a token may start: the token that ends there and how many tokens more (or fewer) end
    # there than at the last byte.
    def _reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.column = np.full(256, -1, np.int64)
        self.width = 64
        self.n_columns = 0
        self.next = np.full((1024, self.width), -1, np.int32)
        self.step = np.zeros((1024, self.width), np.int8)
        self.final = np.zeros((1024, self.width), np.int8)
        self._state(((), ((0, -1, 0),)))

    def _state(self, key: tuple) -> int:
        s = self.states.get(key)
        if s is None:
            s = self.states[key] = len(self.keys)
            self.keys.append(key)
            if s >= len(self.next):
                grow = lambda a, v: np.concatenate([a, np.full_like(a, v)])
                self.next, self.step, self.final = grow(self.next, -1), grow(self.step, 0), grow(self.final, 0)
        return s

    def _last(self, tail: tuple, places: tuple, symbol: int) -> tuple[int, int]:
        """Last token and count (against the state's) once ``symbol`` is read."""
        for at, token, more in places:                      # longest candidate first; only one fits
            t = self.token.get(tail[at:] + (symbol,))
            if t is not None and (token < 0 or self._fits(token, t)):
                return t, more + 1
        raise AssertionError("every byte is a token")

    def _compile(self, state: int, byte: int) -> None:
        tail, places = self.keys[state]
        col = int(self.column[byte])
        self.final[state, col] = self._last(tail, places, 256 + byte)[1]
        token, more = self._last(tail, places, byte)
        spelled = tail + (byte,)
        kept = [(at, t, m - more) for at, t, m in places if spelled[at:] in self.prefix]
        kept.append((len(spelled), token, 0))
        cut = kept[0][0]
        key = (spelled[cut:], tuple((at - cut, t, m) for at, t, m in kept))
        s = self._state(key)
        self.next[state, col] = s
        self.step[state, col] = more

    def _columns(self, data: np.ndarray) -> None:
        for b in np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self.column < 0)).tolist():
            if self.n_columns == self.width:
                wider = lambda a, v: np.hstack([a, np.full((len(a), 16), v, a.dtype)])
                self.next, self.step, self.final = wider(self.next, -1), wider(self.step, 0), wider(self.final, 0)
                self.width += 16
            self.column[b] = self.n_columns
            self.n_columns += 1

    def pretoken_counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token ``data[start:end]``."""
        if len(self.keys) > self.MAX_STATES:
            self._reset()
        self._columns(data)
        cols = self.column[data]
        length = ends - starts
        order = np.argsort(-np.minimum(length, 30000).astype(np.int16), kind="stable") \
            if length.max(initial=0) < 30000 else np.argsort(-length, kind="stable")
        pos, left = starts[order], length[order]
        state = np.zeros(len(order), np.int64)
        count = np.zeros(len(order), np.int64)
        alive = np.searchsorted(-left, -np.arange(1, int(left[0]) + 2 if len(left) else 1), "right")
        for t, n in enumerate(alive.tolist()):
            if n == 0:
                break
            c = cols[pos[:n] + t]
            s = state[:n]
            idx = s * self.width + c
            to = self.next.ravel()[idx]
            if (to < 0).any():
                for k in np.unique(idx[to < 0]).tolist():
                    self._compile(k // self.width, int(np.flatnonzero(self.column == k % self.width)[0]))
                to = self.next.ravel()[idx]
            m = int(alive[t + 1])                       # the words that go on after this byte
            count[:m] += self.step.ravel()[idx[:m]]
            count[m:n] += self.final.ravel()[idx[m:]]
            state[:m] = to[:m]
        out = np.empty_like(count)
        out[order] = count
        return out

    # -- texts ---------------------------------------------------------------------------------
    def normalise(self, text: str) -> tuple[str, int]:
        """The text as the splitting machine reads it, and the special strings in it."""
        found = 0
        if "<|" in text:
            text, found = self.special.subn(" ", text)
        if not text.isascii():
            if not is_latin(text) and self.young(text):                           # the library's Unicode tables are of other versions
                return self.normalizer.normalize_str(text), found
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower(), found

    def pretokens(self, texts: list[str], split=pretoken_starts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the normalised texts; start, end and text of every pre-token; special strings per text."""
        clean, special, sizes = [], np.zeros(len(texts), np.int64), np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            t, special[i] = self.normalise(text)
            clean.append(t)
            sizes[i + 1] = len(t) + 1
        joined = " ".join(clean) + " "
        first = np.cumsum(sizes)
        if joined.isascii():
            data = np.frombuffer(joined.encode("ascii"), np.uint8)
            starts, ends = split(char_classes()[:128][data])
        else:
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
            starts, ends = split(char_classes()[points])
        owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, first)))
        if joined.isascii():
            return data, starts, ends, owner, special
        at = np.flatnonzero((data & 0xC0) != 0x80)                # first byte of every character
        return data, at[starts], at[ends], owner, special

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        data, starts, ends, owner, special = self.pretokens(texts)
        counts = self.pretoken_counts(data, starts, ends)
        return special + np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)

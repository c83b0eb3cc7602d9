"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

Two tokens may stand side by side exactly if the merges leave their common bytes as these two; a token
sequence is the encoding of its bytes exactly if all its neighbours may.  So the machine that guesses
token ends has one accepting path for every beginning of a text.  Its determinisation is built on demand:
a state is the set of places where a token may have started, each with the trie node of the bytes read
since and the last token before it, and says which token ends at the last byte if one does.  The paths
of the live places share all tokens but the last few, so tokens leave after a lookahead bounded by the
merges: at the end of a piece, and before it up to the last place where all live paths meet.
Decoding runs a UTF-8 state machine whose steps are compiled for whole tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.textbatch import byte_slices
from pricelens.llm.unicode_classes import is_latin, regex_stand_ins

_NEVER = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, one ``base64 rank`` a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class MergeTable:
    """The merges that a rank file stands for: two neighbours merge if their bytes are a token, lowest rank first."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes((b,)) not in ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        size = max(ranks.values()) + 1
        self.merge: dict[tuple[int, int], int] = {}
        self.left, self.right = [-1] * size, [-1] * size     # the two tokens that a token is merged from
        self.length = [0] * size
        self.made = made = {}                                # tokens that merges produce
        for spell, rank in sorted(ranks.items(), key=lambda x: (len(x[0]) > 1, x[1])):
            self.length[rank] = len(spell)
            if len(spell) == 1 or self._made_of(spell, rank, made):
                made[spell] = rank
        self.merges: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for (x, y), m in self.merge.items():
            self.merges[x].append((y, m))
        self.spell = [b""] * size
        for spell, rank in ranks.items():
            self.spell[rank] = spell
        self.forget()
        # trie of those: (node << 8 | byte) -> node; the token of a node, and whether longer ones follow
        self.child: dict[int, int] = {}
        self.token, self.depth, self.inner = [-1], [0], [True]
        for spell, rank in made.items():
            node = 0
            for byte in spell:
                self.inner[node] = True
                after = self.child.get(node << 8 | byte)
                if after is None:
                    after = self.child[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.inner.append(False)
                node = after
            self.token[node] = rank

    def _made_of(self, spell: bytes, rank: int, made: dict[bytes, int]) -> bool:
        """Finds the two tokens that the merges before ``rank`` leave of the token's bytes."""
        for k in range(1, len(spell)):
            left, right = made.get(spell[:k]), made.get(spell[k:])
            if left is not None and right is not None and self._stands(left, right, rank):
                self.merge[left, right] = rank
                self.left[rank], self.right[rank] = left, right
                return True
        return False

    def _stands(self, left: int, right: int, until: int) -> bool:
        """No merge across the boundary comes before rank ``until`` while the two pieces at it stand.

        The pieces at an edge are the token, its outer part, that one's outer part and so on; each stands
        until it is merged into the one before.  Of equal ranks the left one is merged first.
        """
        merge = self.merge
        x, px = left, _NEVER
        while x >= 0:
            y, py = right, _NEVER
            while y >= 0:
                m = merge.get((x, y))
                if m is not None and m < until and m < px and m <= py:
                    return False
                y, py = self.left[y], min(py, y)
            x, px = self.right[x], min(px, x)
        return True

    # What a token forbids of the next one: the left-edge pieces that would merge with it, and at which rank.
    # Once some bytes are read, pieces that do not agree with them no longer matter, and tokens that then
    # forbid the same are one constraint; 0 forbids nothing.

    def _forbids(self, pieces: dict[int, int]) -> int:
        key = frozenset(pieces.items())
        c = self.constraints.get(key)
        if c is None:
            c = self.constraints[key] = len(self.pieces)
            self.pieces.append(pieces)
        return c

    def after(self, token: int) -> int:
        """Constraint on the token after this one."""
        c = self._after.get(token)
        if c is None:
            pieces: dict[int, int] = {}
            x, px = token, _NEVER
            while x >= 0:
                for y, m in self.merges[x]:
                    if m < px:
                        pieces[y] = min(m, pieces.get(y, m))
                x, px = self.right[x], min(px, x)
            c = self._after[token] = self._forbids(pieces)
        return c

    def narrowed(self, constraint: int, node: int, byte: int) -> int:
        """What is left of a constraint when the next token begins with the bytes of ``node``, the last of them ``byte``."""
        if not constraint:
            return 0
        key = constraint << 24 | node
        c = self._narrowed.get(key)
        if c is None:
            k = self.depth[node] - 1
            c = self._narrowed[key] = self._forbids({y: m for y, m in self.pieces[constraint].items()
                                                     if self.length[y] <= k or self.spell[y][k] == byte})
        return c

    def fits(self, constraint: int, token: int) -> bool:
        """Whether the token may stand after one that forbids ``constraint``."""
        pieces = self.pieces[constraint]
        y, py = token, _NEVER
        while y >= 0:
            if pieces.get(y, _NEVER) <= py and y in pieces:
                return False
            y, py = self.left[y], min(py, y)
        return True

    def forget(self) -> None:
        """Drop the constraints; states that name them must be dropped too."""
        self.pieces: list[dict[int, int]] = [{}]
        self.constraints: dict[frozenset, int] = {frozenset(): 0}
        self._after: dict[int, int] = {}
        self._narrowed: dict[int, int] = {}


class Transducer:
    """Encodes texts; states and steps are compiled when first met and dropped beyond ``MAX_STATES``.

    The pieces of many texts are read side by side, a byte of each at a time; pieces of more than ``LONG``
    bytes are read one by one, and their tokens leave every ``WINDOW`` bytes as far as all paths agree.
    """

    MAX_STATES = 1 << 16
    LONG = 256
    WINDOW = 1 << 12

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.table = MergeTable(ranks)
        self.length = np.array(self.table.length, np.int64)
        self.pieces = regex.compile(pattern).findall
        # pieces are cut by lengths alone, so code points that ``regex`` classes otherwise are stood in for
        odd, self.stand_ins = regex_stand_ins()
        self.odd = odd.search
        self.unmade = {s: r for s, r in ranks.items() if s not in self.table.made}
        self._reset()

    def _reset(self) -> None:
        # A state is the node and the constraint of every live place, earliest first (the last place is the last
        # byte); ``next`` has the steps by column, ``ends`` the token that ends at the byte read.
        self.table.forget()
        self.states: dict[tuple[int, ...], int] = {(0, 0): 0}
        self.keys: list[tuple[int, ...]] = [(0, 0)]
        self.next = np.full((1 << 10, 32), -1, np.int32)
        self.ends = np.full((1 << 10, 32), -1, np.int32)
        self.bytes: list[int] = []                          # byte of each column
        self.column = np.full(256, -1, np.int16)

    def _columns(self, data: np.ndarray) -> None:
        """A column for every byte of ``data``."""
        for b in np.flatnonzero((np.bincount(data, minlength=256) > 0) & (self.column < 0)).tolist():
            if len(self.bytes) == self.next.shape[1]:
                more = np.full((len(self.next), 32), -1, np.int32)
                self.next, self.ends = np.hstack([self.next, more]), np.hstack([self.ends, more])
            self.column[b] = len(self.bytes)
            self.bytes.append(b)

    def _compile(self, state: int, column: int) -> None:
        table, places, live, found = self.table, iter(self.keys[state]), [], -1
        child, token, inner, byte = table.child, table.token, table.inner, self.bytes[column]
        for node, constraint in zip(places, places, strict=True):
            node = child.get(node << 8 | byte, -1)
            if node < 0:
                continue
            constraint = table.narrowed(constraint, node, byte)
            if found < 0 and token[node] >= 0 and table.fits(constraint, token[node]):
                found = token[node]                        # exactly one path ends here
            if inner[node]:
                live += (node, constraint)
        if found < 0:
            raise ValueError("the ranks are not those of a merge table")
        key = (*live, 0, table.after(found))
        after = self.states.get(key)
        if after is None:
            after = self.states[key] = len(self.keys)
            self.keys.append(key)
            if after == len(self.next):
                more = np.full_like(self.next, -1)
                self.next, self.ends = np.concatenate([self.next, more]), np.concatenate([self.ends, more])
        self.next[state, column], self.ends[state, column] = after, found

    def _agreed(self, passed: list[int], state: int) -> int:
        """The last place through which the paths of all live places go; ``passed`` are the tokens that end at each byte."""
        depth, length, n = self.table.depth, self.table.length, len(passed)
        places = {n - depth[node] for node in self.keys[state][::2]}
        while len(places) > 1:
            last = max(places)
            places.remove(last)
            places.add(last - length[passed[last - 1]])
        return places.pop()

    def _read_long(self, columns: np.ndarray, start: int, end: int, found: np.ndarray) -> None:
        """Tokens of one piece into ``found``, each at its last byte."""
        passed: list[int] = []
        state, base = 0, start
        for at in range(start, end, self.WINDOW):
            for column in columns[at:min(at + self.WINDOW, end)].tolist():
                if self.next[state, column] < 0:
                    self._compile(state, column)
                passed.append(int(self.ends[state, column]))
                state = int(self.next[state, column])
            k = agreed = len(passed) if at + self.WINDOW >= end else self._agreed(passed, state)
            while k > 0:
                token = found[base + k - 1] = passed[k - 1]
                k -= self.table.length[token]
            del passed[:agreed]
            base += agreed

    def _read_short(self, columns: np.ndarray, starts: np.ndarray, ends: np.ndarray, found: np.ndarray) -> None:
        """Tokens of many pieces into ``found``, each at its last byte."""
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        first, size = starts[order], length[order]
        passed = np.zeros(len(columns), np.int32)
        state = np.zeros(len(order), np.int64)
        alive = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), "right") if len(size) else []
        for t, n in enumerate(map(int, alive)):
            at = first[:n] + t
            slot = state[:n] * self.next.shape[1] + columns[at]
            after = self.next.ravel()[slot]
            if (after < 0).any():
                for k in np.unique(slot[after < 0]).tolist():
                    self._compile(*divmod(k, self.next.shape[1]))
                after = self.next.ravel()[slot]
            passed[at] = self.ends.ravel()[slot]
            state[:n] = after
        at, start = ends, starts
        while len(at):
            token = passed[at - 1]
            found[at - 1] = token
            at = at - self.length[token]
            more = at > start
            at, start = at[more], start[more]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all texts in order, and the number of tokens of each text."""
        if len(self.keys) >= self.MAX_STATES:
            self._reset()
        cut = [self.pieces(t if is_latin(t) or not self.odd(t) else t.translate(self.stand_ins)) for t in texts]
        raw = "".join(texts).encode("utf-8", "surrogatepass")
        data = np.frombuffer(raw, np.uint8)
        # places of pieces and texts in characters, then in bytes
        ends = np.cumsum(np.fromiter(map(len, chain.from_iterable(cut)), np.int64))
        bounds = np.cumsum([0, *map(len, texts)])
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        ends, bounds = place[ends], place[bounds]
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        self._columns(data)
        columns = self.column.astype(np.uint8)[data]
        found = np.full(len(data), -1, np.int32)
        short = ends - starts <= self.LONG
        self._read_short(columns, starts[short], ends[short], found)
        for a, b in zip(starts[~short].tolist(), ends[~short].tolist(), strict=True):
            self._read_long(columns, a, b, found)
        if self.unmade:                                    # a piece that is a token is that token, merged or not
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                token = self.unmade.get(raw[a:b])
                if token is not None:
                    found[a:b] = -1
                    found[b - 1] = token
        ends_here = found >= 0
        total = np.concatenate(([0], np.cumsum(ends_here)))
        return found[ends_here], np.diff(total[bounds])


class StreamDecoder:
    """Text of a token stream: whole characters leave as soon as their last byte has come.

    The state is the unfinished character's bytes, of which there are at most three.  Bytes that no
    character continues give U+FFFD, one for each longest beginning of a character, as text decoders do.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        self.closed: dict[int, str] = {}                    # steps from the state without unfinished bytes back to it
        for i, token in tokens.items():
            text, held = self.feed(b"", token)
            if not held:
                self.closed[i] = text

    @staticmethod
    def _allowed(held: bytes) -> tuple[int, int, int]:
        """Bytes the unfinished character still needs and the range of the next."""
        lead = held[0]
        size = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        low, high = 0x80, 0xBF
        if len(held) == 1:
            low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
            high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
        return size - len(held), low, high

    def feed(self, held: bytes, data: bytes) -> tuple[str, bytes]:
        """What leaves when ``data`` follows the unfinished ``held``, and what is unfinished then."""
        out = []
        for byte in data:
            if held:
                need, low, high = self._allowed(held)
                if low <= byte <= high:
                    held += bytes((byte,))
                    if need == 1:
                        out.append(held.decode("utf-8"))
                        held = b""
                    continue
                out.append("�")
                held = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                held = bytes((byte,))
            else:
                out.append("�")
        return "".join(out), held

    def decode(self, ids: list[int]) -> str:
        """The whole text of ``ids``; an id that is no token raises."""
        try:                                               # every token begins and ends with a whole character
            return "".join(map(self.closed.__getitem__, ids))
        except KeyError:
            pass
        out, held = [], b""
        steps = self.steps.setdefault(held, {})
        for i in ids:
            step = steps.get(i)
            if step is None:
                step = self.feed(held, self.tokens[i])
                if len(self.steps) > 1 << 10:
                    self.steps = {held: steps}
                steps[i] = step
            text, after = step
            out.append(text)
            if after is not held and after != held:
                held, steps = after, self.steps.setdefault(after, {})
        return "".join(out) + "�" * bool(held)


@lru_cache(maxsize=2)
def transducer(path: str, pattern: str) -> Transducer:
    """One machine per worker process, kept across tasks; its tables are bounded."""
    return Transducer(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> StreamDecoder:
    return StreamDecoder({rank: token for token, rank in read_ranks(path).items()})


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 decoded: bool = False) -> DataFrame:
    """``id_col, ids``: the token ids of every row's whole text; with ``decoded`` also the text that they decode to.

    ``pattern`` cuts a text into pieces that are encoded separately; strings that look like special
    tokens are ordinary text.  Null and empty texts have no ids; a null id and repeated rows are kept;
    other columns are not read.  A narrow pass without a shuffle: a slice of about half a MB of texts (or one
    longer text) is held at a time, and the machine's tables are bounded.  Ranks that no merge table
    has, or that lack a byte, raise.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(ranks_path, pattern)
        for batch in batches:
            for i, j, _, _ in byte_slices(batch.column(1), 1 << 19):
                ids, sizes = machine.encode([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()])
                ends = np.concatenate(([0], np.cumsum(sizes)))
                columns = [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))]
                if decoded:
                    columns.append(_texts(decoder(ranks_path), ids, ends))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    names = [f.name for f in fields]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, T.StructType(fields)).withColumnRenamed("id", id_col)


def _texts(machine: StreamDecoder, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.array([machine.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string())


def decode_ids(rows: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of their token ids as ``out_col``, which replaces a column of that name.

    Null ids give null, an empty list the empty text; nulls inside a list are left out.  Bytes that are
    no UTF-8 give U+FFFD.  Ids without a token raise.
    """

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        texts = _texts(decoder(ranks_path), ids.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes))))
        return pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string()))

    return rows.withColumn(out_col, decode(F.filter(ids_col, lambda x: x.isNotNull())))

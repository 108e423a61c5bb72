"""Token counts through a finite-state form of a byte-level BPE tokenizer.

The tokenizer is compiled into a deterministic transducer over bytes whose transitions carry the change
in the number of emitted tokens. A state is what decides every later step: the longest suffix read that
begins some token, with the last token and the relative count of each prefix that ends inside it. A
prefix's encoding is the encoding of a shorter prefix and one more token, and a token sequence is an
encoding if and only if each neighbouring pair is one; so exactly one token can end a prefix, and the
step is a function of the state. States are built when first reached and kept in a bounded table.

White space after another character always starts a new pre-token, whatever stands to the left. A text
longer than CHUNK is cut anywhere into chunks. A chunk's state map says what it makes of the fragment that
is open on entry: where it closes it, the tokens emitted behind it, and the fragment left open. Maps compose
associatively, in a parallel prefix scan that sweeps up a binary tree and down again; the whole text's map is the
tree's root, so count() needs the sweep up only. Fragments are ropes: composition ties two together and copies
no text, and a closed one is read once, leaf by leaf. A pre-token that goes on over leaves, as in a text without white
space, is passed from leaf to leaf as the transducer's state and count, so memory does not grow with it.

Words between spaces are macro transitions: a space before another character that is not white space
always starts a pre-token, so what stands between two such spaces leads from the start state to itself
with a fixed count, which is computed once and kept in a table of bounded size in two generations.

Null text counts as empty; an empty text has 0 tokens, an empty table no rows. Rows are counted one by one,
so ties and repeats do not matter. The result has the key column and the counts only; no other column of
the input is read, so none clashes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame, functions as F

#: Characters in a chunk.
CHUNK = 1 << 14
#: Words of one generation and states kept in a worker; characters of a word that is kept.
MOST_WORDS, MOST_STATES, LONGEST = 400_000, 250_000, 64

#: Up to here Unicode's letters, numbers and spaces have not changed since long, so that they can be listed.
OLD = "\u0557"

# Fixed value: the pattern by which the tokenizer splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes: Latin-1's own where printable, else code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _listed(pattern: str) -> str:
    """The pattern with its classes spelled out up to OLD, which the plainer and faster engine reads."""
    of = lambda name: re.escape("".join(filter(regex.compile(name).match, map(chr, range(ord(OLD) + 1)))))
    letter, number, space = map(of, (r"\p{L}", r"\p{N}", r"\s"))
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
    for name, chars in ((r"\p{L}", letter), (r"\p{N}", number), (r"\S", "^" + space), (r"\s", space)):
        pattern = pattern.replace(name, f"[{chars}]")
    return pattern


class Transducer:
    """The compiled tokenizer. count(word) runs it over one pre-token's bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        to_byte = _byte_alphabet()
        raw = lambda token: bytes(to_byte[c] for c in token)
        #: The rank of a merge; the first merge that makes a token, with its parts.
        self.rank = {}
        self.made = {bytes((b,)): (-1, None, None) for b in range(256)}
        for k, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            a, b = raw(a), raw(b)
            self.rank[a, b] = k
            self.made.setdefault(a + b, (k, a, b))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        special = set(self.special)
        tokens = [raw(t) for t in model["vocab"] if t not in special]
        self.prefixes = {t[:k] for t in tokens for k in range(1, len(t) + 1)}
        self._known: dict[bytes, bool] = {}
        #: Strings that the merges turn into one token, and of two of them whether they stay apart.
        self.valid = {t for t in self.made if self._token(t)}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = self._state(b"", (None,), (0,))

    def _apart(self, a: bytes, b: bytes, top: bool = True) -> bool:
        """Whether neighbours a and b stay apart while both are formed.

        Undoes their merges from the latest back; the parts that then face each other must not merge
        before the undone merge. Without top the pair itself may merge at the end.
        """
        rank, made = self.rank, self.made
        limit = 1 << 60
        while True:
            if top and rank.get((a, b), limit) < limit:
                return False
            top = True
            ra, rb = made[a][0], made[b][0]
            if ra > rb:
                limit, a = ra, made[a][2]
            elif rb < 0:
                return True
            else:
                limit, b = rb + 1, made[b][1]

    def _token(self, t: bytes) -> bool:
        """Whether the merges turn t's bytes into t."""
        if (known := self._known.get(t)) is None:
            known = t in self.made
            if known and len(t) > 1:
                _, a, b = self.made[t]
                known = self._token(a) and self._token(b) and self._apart(a, b, top=False)
            self._known[t] = known
        return known

    def _state(self, suffix: bytes, last: tuple, rel: tuple) -> State:
        key = suffix, last, rel
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = State(self, suffix, last, rel)
        return state

    def step(self, state: State, byte: int) -> tuple[State, int]:
        """The transition: the token that ends here follows from the last tokens of the earlier prefixes."""
        last, rel = state.last, state.rel
        read = state.suffix + bytes((byte,))
        valid, pairs, prefixes = self.valid, self.pairs, self.prefixes
        n = len(read)
        for at in range(n):  # the longest token first
            token = read[at:]
            if token in valid:
                before = last[at]
                if before is None:
                    break
                apart = pairs.get((before, token))
                if apart is None:
                    if len(pairs) > MOST_STATES:
                        pairs.clear()
                    apart = pairs[before, token] = self._apart(before, token)
                if apart:
                    break
        else:
            raise ValueError("no token ends at this byte")
        delta = rel[at] + 1
        first = 0
        while first < n and read[first:] not in prefixes:
            first += 1
        return self._state(read[first:], (*last[first:], token), (*[r - delta for r in rel[first:]], 0)), delta

    def run(self, state: State, n: int, word: str | bytes) -> tuple[State, int]:
        """The state and count behind a part of a pre-token that is entered with the given ones."""
        if len(self.states) > MOST_STATES:
            self.reset()  # states in use stay as they are
        for byte in word if isinstance(word, bytes) else word.encode():
            state, delta = state[byte]
            n += delta
        return state, n

    def count(self, word: str | bytes) -> int:
        if len(self.states) > MOST_STATES:
            self.reset()
        return self.run(self.start, 0, word)[1]


class State(dict):
    """A state is the table of its transitions; those not taken yet are computed."""

    __slots__ = ("machine", "suffix", "last", "rel")

    def __init__(self, machine: Transducer, suffix: bytes, last: tuple, rel: tuple):
        self.machine, self.suffix, self.last, self.rel = machine, suffix, last, rel

    def __missing__(self, byte: int):
        self[byte] = out = self.machine.step(self, byte)
        return out


class Words(dict):
    """Counts of strings that lead from the start state to itself. A full table becomes the older generation, whose
    entries come back when they are met again."""

    def __init__(self, count):
        self.of, self.older = count, {}

    def __missing__(self, word: str) -> int:
        n = self.older.get(word)
        if n is None:
            n = self.of(word)
        if len(word) <= LONGEST:
            if len(self) >= MOST_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = n
        return n


class Rope:
    """Neighbouring strings tied together, with their first and last characters."""

    __slots__ = ("first", "last", "parts")

    def __init__(self, first: str, last: str, parts: tuple):
        self.first, self.last, self.parts = first, last, parts

    @classmethod
    def of(cls, text: str) -> Rope:
        return cls(text[:1], text[-1:], (text,))

    def __add__(self, other: Rope) -> Rope:
        if not self.first or not other.first:
            return other if not self.first else self
        return Rope(self.first, other.last, (self, other))

    def leaves(self) -> Iterator[str]:
        todo: list = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
            else:
                todo += x.parts[::-1]


#: A chunk's state map: the text that joins the fragment open on entry, the tokens after it, and the
#: fragment left open; tail is None while nothing in the chunk closes the entry fragment.
Map = tuple[Rope, int, Rope | None]


class Counter:
    def __init__(self, path: str):
        self.path, self.library, self.classes = path, None, {}
        self.machine = Transducer(path)
        self.words = Words(self.machine.count)
        #: By what follows the space that starts it.
        self.spaced = Words(self._after_space)
        self.split = regex.compile(SPLIT).findall
        self.old_split = re.compile(_listed(SPLIT)).findall
        #: What goes on in a pre-token of letters, of numbers, or of neither.
        self.same = [regex.compile(x) for x in (r"\p{L}*", r"\p{N}*", r"[^\s\p{L}\p{N}]*")]
        self.beyond = re.compile(f"[^\0-{OLD}]").search
        self.special = regex.compile("|".join(map(regex.escape, self.machine.special)) or r"(?!)")
        self.cut = regex.compile(r"(?<=\S)(?=\s)")
        self.last_cut = regex.compile(r"(?r)(?<=\S)(?=\s)")
        #: Spaces at which a text can be cut, and whether it has others.
        self.space, self.other_space = re.compile(r" (?=\S)").split, re.compile(r" (?!\S)").search

    def newer(self, c: str) -> str:
        """The character, or a plain one of the class that the tokenizer's own tables give it.

        Only characters that are unassigned in Python's tables can be classed otherwise there.
        """
        if (known := self.classes.get(c)) is None:
            known = c
            if unicodedata.category(c) == "Cn":
                if self.library is None:
                    self.library = tokenizers.Tokenizer.from_file(self.path).pre_tokenizer
                known = next((x for x in "a1!" if len(self.library.pre_tokenize_str(x + c)) == 1), c)
            self.classes[c] = known
        return known

    def pieces(self, text: str) -> list[str]:
        if self.beyond(text) is None:
            return self.old_split(text)
        at = [0, *accumulate(map(len, self.split("".join(map(self.newer, text)))))]
        return [text[i:j] for i, j in zip(at, at[1:])]

    def _after_space(self, word: str) -> int:
        first, *rest = self.pieces(" " + word)
        if not rest:
            return self.machine.count(first)
        return self.spaced[first[1:]] + sum(map(self.words.__getitem__, rest))

    def plain(self, text: str) -> int:
        """Tokens of a text that starts at a pre-token's start and holds no special string."""
        first, *rest = text.split(" ") if self.other_space(text) is None else self.space(text)
        return sum(map(self.words.__getitem__, self.pieces(first))) + sum(map(self.spaced.__getitem__, rest))

    def fragment(self, rope: Rope) -> int:
        """plain() of a rope. What no later leaf can change is counted; the last pre-token is kept for the next leaf, as
        text while it is short, then as the transducer's state."""
        n, kept, going = 0, "", None
        for leaf in rope.leaves():
            if going is not None:
                state, tokens, same = going
                plain = leaf if self.beyond(leaf) is None else "".join(map(self.newer, leaf))
                end = same.match(plain).end()
                state, tokens = self.machine.run(state, tokens, leaf[:end])
                if end == len(leaf):
                    going = state, tokens, same
                    continue
                n, going, leaf = n + tokens, None, leaf[end:]
            *done, kept = self.pieces(kept + leaf)
            if done and done[-1] == "'":  # may be a contraction's start
                kept = done.pop() + kept
            n += sum(map(self.words.__getitem__, done))
            if len(kept) > LONGEST:
                same = next((x for x in self.same if x.match(self.newer(kept[-1])).end()), None)
                if same is not None:
                    going, kept = (*self.machine.run(self.machine.start, 0, kept), same), ""
        return n + (going[1] if going else 0) + (self.plain(kept) if kept else 0)

    def chunk_map(self, chunk: str) -> Map:
        first = self.cut.search(chunk)
        if first is None:
            return Rope.of(chunk), 0, None
        last = self.last_cut.search(chunk).start()
        return Rope.of(chunk[: first.start()]), self.plain(chunk[first.start() : last]), Rope.of(chunk[last:])

    def compose(self, a: Map, b: Map) -> Map:
        """What two neighbouring chunks do together. White space at the seam may close the fragment there."""
        left = a[0] if a[2] is None else a[2]
        opens = self.cut.match(left.last + b[0].first, 1) is not None
        if a[2] is None:
            if not opens:
                return a[0] + b[0], b[1], b[2]
            return (a[0], 0, b[0]) if b[2] is None else (a[0], self.fragment(b[0]) + b[1], b[2])
        if b[2] is None:
            return (a[0], a[1] + self.fragment(left), b[0]) if opens else (a[0], a[1], left + b[0])
        seam = self.fragment(left) + self.fragment(b[0]) if opens else self.fragment(left + b[0])
        return a[0], a[1] + seam + b[1], b[2]

    def swept(self, maps: list[Map]) -> list[list[Map]]:
        """The levels of the tree over maps, each of independent compositions of neighbours; the last one is the root."""
        levels = [maps]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
            levels.append(maps)
        return levels

    def scan(self, maps: list[Map]) -> list[Map]:
        """The maps of all prefixes: the tree's levels, then from the root down what stands before each node."""
        levels = self.swept(maps)
        before: list[Map | None] = [None]
        for below in levels[-2::-1]:
            before = [before[i // 2] if i % 2 == 0 else self._after(before[i // 2], below[i - 1]) for i in range(len(below))]
        return [self._after(b, m) for b, m in zip(before, maps)]

    def _after(self, before: Map | None, m: Map) -> Map:
        return m if before is None else self.compose(before, m)

    def applied(self, m: Map) -> int:
        """The tokens of a map's text, entered with no fragment open and with the end of text behind it."""
        head, n, tail = m
        return self.fragment(head) + n + (self.fragment(tail) if tail else 0)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        n, at = 0, 0
        for m in [*self.special.finditer(text), None]:
            part = text[at : m.start() if m else len(text)]
            if len(part) <= chunk:
                n += self.plain(part)
            else:
                n += self.applied(self.swept([self.chunk_map(part[i : i + chunk]) for i in range(0, len(part), chunk)])[-1][0])
            if m:
                n, at = n + 1, m.end()
        return n


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One for each worker process and file."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of each row. No shuffle; the file at path must be on every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            tokens = [count(t) for t in texts]
            cols = [b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=[key, "n_bytes", "n_tokens", "over_limit"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def op1(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sitefold.llm.common import documents

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))

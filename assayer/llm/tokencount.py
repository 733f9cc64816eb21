"""Token counts by a finite-state transducer compiled from a byte-fallback BPE piece vocabulary.

The transducer reads characters. Its state after a prefix is what can still matter of the
tokenization of that prefix: for every suffix that begins some piece, the last token before
the suffix and how many tokens more the whole prefix has. A token may follow another exactly
when encoding the two together gives the two again, so one of the suffixes can be extended to
the last token of the longer prefix, and its count is the transition's output. A pair of
characters that occurs in no piece resets the state, so words and lines start anew.

Transitions are made when they are first used and kept while the process lives. A chunk of a
text is summarised as a state map: the characters before its first reset, and the state and
count from there on. State maps compose associatively; a prefix scan over the chunks of a
stretch gives the counts at all their ends. Texts are cut into stretches where a space resets
the state; what a short stretch adds is then a constant, which is kept too.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple, TypeVar

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from assayer.llm.frames import pick, text_bytes

CHUNK = 1 << 16
MOST_STATES = 150_000
MOST_STRETCHES = 500_000
_NORMAL = 1
_SPACE = "▁"
_SHORT = 64
_RESET = re.compile(f"(?<=[^ {_SPACE}]) ")
T = TypeVar("T")


class State(dict):
    """Transitions by character: ``(next state, tokens added)``. Made on first use."""

    __slots__ = ("machine", "suffix", "before")

    def __missing__(self, character: str) -> tuple[State, int]:
        step = self.machine.step(self, character)
        self[character] = step
        return step


class StateMap(NamedTuple):
    """What a stretch of text does to any state: ``head`` is still to be read from the entry state,
    then the state is ``exit`` with ``count`` more tokens. ``exit`` is None when all is head."""

    head: str
    exit: State | None
    count: int


class Transducer:
    def __init__(self, pieces: dict[str, float], most_states: int = MOST_STATES) -> None:
        self._rank = {piece: -score for piece, score in pieces.items()}
        self._most = most_states
        self._pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self._fits = functools.lru_cache(1 << 18)(self._stay_apart)
        self._merged = functools.lru_cache(1 << 16)(self._merges)
        self._tokens = {p for p in pieces if len(p) > 1 and self._merges(p)[0] == [p]}
        self._begins = {p[:i] for p in self._tokens for i in range(1, len(p))}
        self._clear()

    def _clear(self) -> None:
        self._states: dict[tuple, State] = {}
        self.start = self._state("", ((0, None, 0),))

    def _merges(self, text: str) -> tuple[list[str], list[tuple], list[tuple]]:
        """Plain BPE on a short text: always the best-ranked pair, the leftmost of equals. Returns the
        tokens, and each merge's rank with the first, or the last, symbol if the merge changed it."""
        parts, first, last, rank = list(text), [], [], self._rank
        while True:
            ranked = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
            if not ranked:
                return parts, first, last
            best, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            first.append((best, parts[0] if i == 0 else None))
            last.append((best, parts[-1] if i == len(parts) - 1 else None))

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge crosses from one token into the other when both are encoded together."""
        rank, never = self._rank, (math.inf, None)
        lefts, rights = iter(self._merged(left)[2]), iter(self._merged(right)[1])
        (a, x), (b, y) = next(lefts, never), next(rights, never)
        end, begin = left[-1], right[0]
        crossing = rank.get(end + begin, math.inf)
        while True:
            if crossing < a and crossing <= b and crossing < math.inf:
                return False
            if a == b == math.inf:
                return True
            if a <= b:
                if x:
                    end = x
                    crossing = rank.get(end + begin, math.inf)
                a, x = next(lefts, never)
            else:
                if y:
                    begin = y
                    crossing = rank.get(end + begin, math.inf)
                b, y = next(rights, never)

    def _state(self, suffix: str, before: tuple) -> State:
        state = self._states.get((suffix, before))
        if state is None:
            state = State()
            state.machine, state.suffix, state.before = self, suffix, before
            self._states[suffix, before] = state
        return state

    def cost(self, character: str) -> int:
        return 1 if character in self._rank else len(character.encode("utf-8", "surrogatepass"))

    def resets(self, last: str, character: str) -> bool:
        return last + character not in self._pairs

    def step(self, state: State, character: str) -> tuple[State, int]:
        """``before`` holds ``(length, token, tokens)`` of each suffix: the last token before it, and
        how many tokens fewer the text before it has than all."""
        if state.suffix and self.resets(state.suffix[-1], character):
            state = self.start
        text, begins, tokens = state.suffix + character, self._begins, self._tokens
        kept, last, added = [], None, 0
        for length, token, fewer in state.before:
            piece = text[-1 - length :]
            if last is None and (length == 0 or piece in tokens) and (token is None or self._fits(token, piece)):
                last, added = piece, (1 if length else self.cost(character)) - fewer
            if piece in begins:
                kept.append((length + 1, token, fewer))
        if last is None:
            raise RuntimeError(f"no token ends after {text!r}")
        before = [(length, token, fewer + added) for length, token, fewer in kept]
        longest = before[0][0] if before else 1
        if len(self._states) >= self._most:
            self._clear()
        return self._state(text[-longest:], (*before, (0, last, 0))), added

    def read(self, state: State, text: str) -> tuple[State, int]:
        count = 0
        for character in text:
            state, added = state[character]
            count += added
        return state, count

    def state_map(self, chunk: str) -> StateMap:
        pairs = self._pairs
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in pairs:
                return StateMap(chunk[:i], *self.read(self.start, chunk[i:]))
        return StateMap(chunk, None, 0)

    def compose(self, first: StateMap, second: StateMap) -> StateMap:
        if first.exit is None:
            return StateMap(first.head + second.head, second.exit, second.count)
        state, count = self.read(first.exit, second.head)
        if second.exit is None:
            return StateMap(first.head, state, first.count + count)
        return StateMap(first.head, second.exit, first.count + count + second.count)

    def counts(self, text: str, chunk: int = CHUNK) -> list[int]:
        """The number of tokens up to the end of each chunk."""
        if len(text) <= chunk:
            return [self.read(self.start, text)[1]]
        maps = [self.state_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        return [self.read(self.start, m.head)[1] + m.count for m in prefix_scan(maps, self.compose)]


def prefix_scan(items: list[T], compose: Callable[[T, T], T]) -> list[T]:
    """All prefixes composed, by pairs: the pairs of one level do not depend on each other."""
    if len(items) < 2:
        return items
    pairs = [compose(a, b) for a, b in zip(items[::2], items[1::2])]
    scanned = prefix_scan(pairs, compose)
    out = [items[0]]
    for i in range(1, len(items)):
        out.append(scanned[i // 2] if i % 2 else compose(scanned[i // 2 - 1], items[i]))
    return out


def read_pieces(model: bytes) -> dict[str, float]:
    """The scores of the normal pieces; raises for models that this transducer does not stand for."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    spec, trained = proto.normalizer_spec, proto.trainer_spec
    if (
        trained.model_type != 2
        or not trained.byte_fallback
        or trained.treat_whitespace_as_suffix
        or spec.precompiled_charsmap
        or not spec.add_dummy_prefix
        or spec.remove_extra_whitespaces
        or any(p.type in (4, 5) for p in proto.pieces)
    ):
        raise ValueError("needs a byte-fallback BPE model without normalization or user-defined pieces")
    return {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}


@functools.lru_cache(2)
def compiled(model: bytes) -> Transducer:
    """One transducer a process, kept for later tasks."""
    return Transducer(read_pieces(model))


@functools.lru_cache(2)
def counter(model: bytes, chunk: int = CHUNK) -> Counts:
    return Counts(compiled(model), chunk)


def stretches(text: str) -> list[str]:
    """``text`` cut at each space that follows another character than a space: there the state is reset."""
    if "  " in text or text[0] == " " or _SPACE in text:
        return _RESET.split(text)
    return text.split(" ")


class Counts(dict):
    """The tokens of each short stretch that follows a reset. Made on first use."""

    def __init__(self, machine: Transducer, chunk: int = CHUNK) -> None:
        self.machine, self.chunk = machine, chunk

    def __missing__(self, stretch: str) -> int:
        added = self.machine.counts(_SPACE + stretch.replace(" ", _SPACE), self.chunk)[-1]
        if len(stretch) <= _SHORT:
            if len(self) >= MOST_STRETCHES:
                self.clear()
            self[stretch] = added
        return added

    def of(self, text: str) -> int:
        return sum(map(self.__getitem__, stretches(text))) if text else 0


def count_tokens(docs: DataFrame, model: bytes, limit: int = 4096, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs(doc_id, text)``.

    ``model`` is the content of a piece model file. Whole texts are counted, without begin
    and end tokens. A null text counts as empty and has no tokens; repeated rows come back
    as often; other columns are ignored; an empty table gives an empty result.
    """
    read_pieces(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts_of = counter(shared.value, chunk)
        for batch in batches:
            sizes, counts = [], []
            for text in batch.column("text").to_pylist():
                sizes.append(len(text))
                counts.append(counts_of.of(text.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    narrow = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), text_bytes(F.col("text")).alias("text"))
    counted = narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

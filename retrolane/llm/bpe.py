"""Byte-level BPE: a lazily determinised transducer encodes, an incremental UTF-8 machine decodes.

Merging pair by pair needs the whole piece. Left to right the result can be had from
prefixes instead: the last token of a prefix is the only token t ending there for which
(last token before t, t) would stay two tokens under the merges. So after each byte the
state of the transducer is what further input can depend on: the starts from which some
token may still be running, and for each the tokens that lead there. Tokens that all of
these agree on are emitted at once; a start dies when no token has its bytes as a prefix,
so a token waits for at most as many bytes as the longest token has. States and their
moves are built when first met and kept in a table of bounded size.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_STATES = 200_000
MOST_PIECES = 400_000
LONGEST_KEPT_PIECE = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: base64 of the token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes the bytes of one piece to token ids; the same object serves any number of pieces."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        # a trie of the tokens: node << 8 | byte leads to a node; what a node spells, and whether it goes on
        self.trie: dict[int, int] = {}
        self.spelt: list[int | None] = [None]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = self.trie.setdefault(node << 8 | byte, len(self.spelt))
                if node == len(self.spelt):
                    self.spelt.append(None)
            self.spelt[node] = rank
        self.inner = {step >> 8 for step in self.trie}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.most_states = most_states
        self._clear()

    def _clear(self) -> None:
        start = (None, ((0, ()),))
        self.states = [start]
        self.numbers = {start: 0}
        # state << 8 | byte to the next state and the tokens emitted
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that the last merge of a token joins; None for a single byte."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            _, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _spine(self, token: int, side: int) -> tuple[list[bytes], list[int]]:
        """The parts that touch one side of a token while it is built, from one byte up, and their ranks."""
        known = self.spines[side].get(token)
        if known is None:
            parts = [self.tokens[token]]
            while (halves := self._halves(parts[-1])) is not None:
                parts.append(halves[side])
            parts.reverse()
            known = self.spines[side][token] = (parts, [self.ranks[part] for part in parts])
        return known

    def stays(self, left: int, right: int) -> bool:
        """Whether the bytes of two adjacent tokens encode to just these two.

        Both are built side by side in the order of ranks; they fail to stay if the parts that
        meet at the border could merge before either grows. Of equal merges the leftmost goes first.
        """
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        (parts, ranks), (others, other_ranks) = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            across = self.ranks.get(parts[i] + others[j], 1 << 60)
            grow = ranks[i + 1] if i + 1 < len(ranks) else 1 << 60
            other = other_ranks[j + 1] if j + 1 < len(other_ranks) else 1 << 60
            if across < grow and across <= other and across < 1 << 60:
                known = False
                break
            if grow == other == 1 << 60:
                known = True
                break
            if grow <= other:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= 4 * self.most_states:
            self.pairs.clear()
        self.pairs[left, right] = known
        return known

    def _move(self, number: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Builds the move of a state under a byte: the next state and the tokens emitted."""
        before, live = self.states[number]
        trie, spelt, inner = self.trie, self.spelt, self.inner
        following, reached = [], None
        for node, path in live:
            node = trie.get(node << 8 | byte)
            if node is None:
                continue
            if node in inner:
                following.append((node, path))
            if reached is None and (token := spelt[node]) is not None:
                last = path[-1] if path else before
                if last is None or self.stays(last, token):
                    reached = path + (token,)
        following.append((0, reached))
        emitted: tuple[int, ...] = ()
        first = following[0][1]
        if len(following) == 1:
            emitted = reached
            following = [(0, ())]
        elif first:
            shared = len(first)
            for _, path in following:
                if path[:shared] != first[:shared]:
                    shared = next(i for i in range(shared) if path[i : i + 1] != first[i : i + 1])
            if shared:
                emitted = first[:shared]
                following = [(node, path[shared:]) for node, path in following]
        if emitted:
            before = emitted[-1]
        # what was emitted last matters only to a start that follows it directly
        direct = before if () in [path for _, path in following] else None
        state = (direct, tuple(following))
        to = self.numbers.get(state)
        if to is None:
            to = self.numbers[state] = len(self.states)
            self.states.append(state)
        move = self.moves[number << 8 | byte] = (to, emitted)
        return move

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece. A piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.most_states:
            self._clear()
        out: list[int] = []
        state = 0
        for byte in piece:
            move = self.moves.get(state << 8 | byte)
            if move is None:
                if len(self.states) > 4 * self.most_states:  # inside one very long piece
                    kept = self.states[state]
                    self._clear()
                    state = self.numbers[kept] = len(self.states)
                    self.states.append(kept)
                move = self._move(state, byte)
            state, emitted = move
            if emitted:
                out += emitted
        return out + list(self.states[state][1][-1][1])


class PieceIds(dict):
    """Ids of pieces as text, encoded when first met. Cleared at its bound, never wrong."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> str:
        ids = " ".join(map(str, self.transducer.encode(piece.encode())))
        if len(piece) <= LONGEST_KEPT_PIECE:
            if len(self) >= MOST_PIECES:
                self.clear()
            self[piece] = ids
        return ids


BROKEN = 8


def utf8_moves() -> np.ndarray:
    """moves[state, byte] of UTF-8. States: 0 between characters, 1 to 3 with as many bytes to come, 4 to 7 after a
    lead byte that bounds the next one, BROKEN after a byte that fits nothing."""
    moves = np.full((BROKEN + 1, 256), BROKEN, np.uint8)
    moves[0, :0x80] = 0
    moves[0, 0xC2:0xE0] = 1
    moves[0, 0xE0:0xF0] = 2
    moves[0, 0xF0:0xF5] = 3
    moves[0, [0xE0, 0xED, 0xF0, 0xF4]] = [4, 5, 6, 7]
    for more in (1, 2, 3):
        moves[more, 0x80:0xC0] = more - 1
    moves[4, 0xA0:0xC0] = moves[5, 0x80:0xA0] = 1
    moves[6, 0x90:0xC0] = moves[7, 0x80:0x90] = 2
    return moves


MOVES = utf8_moves()
BYTE_MOVES = [row.tobytes() for row in MOVES]


class Utf8Machine:
    """UTF-8 in pieces of any size: whole characters come out, the bytes of an unfinished one wait.

    Bytes that can't be part of a character become U+FFFD, as `bytes.decode(errors="replace")` does.
    """

    def __init__(self) -> None:
        self.state = 0
        self.waiting = b""

    def feed(self, data: bytes, last: bool = False) -> str:
        """The characters that data makes whole, byte by byte; after the last piece nothing waits."""
        at, data = len(self.waiting), self.waiting + data
        out, first, begin, state = [], 0, 0, self.state
        while at < len(data):
            state = BYTE_MOVES[state][data[at]]
            if state == BROKEN:
                # what was begun is lost as one; the byte may begin a character itself
                out += [data[first:begin].decode(), "\ufffd"]
                at += begin == at
                first, begin, state = at, at, 0
                continue
            at += 1
            if state == 0:
                begin = at
        out.append(data[first:begin].decode())
        self.state, self.waiting = state, data[begin:]
        if last and self.waiting:
            out.append("\ufffd")
        if last:
            self.state, self.waiting = 0, b""
        return "".join(out)

    def feed_ids(self, ids: np.ndarray, decoder: Decoder, last: bool = False) -> str:
        """The same over tokens: whole tokens move the machine at once, only the last few go byte by byte."""
        data = decoder.decode(ids)
        whole = decoder.whole(ids, self.state)
        if not whole:
            return self.feed(data, last)
        cut = len(data) if whole == len(ids) else int(decoder.lengths[ids[:whole]].sum())
        head = (self.waiting + data[:cut]).decode()
        self.state, self.waiting = 0, b""
        return head + self.feed(data[cut:], last)


class Decoder:
    """Ids to bytes by gathers over the vocabulary's bytes, and the moves of the UTF-8 machine over whole tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = {rank: token for token, rank in ranks.items()}
        parts = [tokens.get(rank, b"") for rank in range(max(tokens, default=-1) + 1)]
        self.lengths = np.array([len(part) for part in parts], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1] if parts else np.zeros(0, np.int64)
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.moves = np.repeat(np.arange(BROKEN + 1, dtype=np.uint8)[:, None], len(parts), axis=1)
        longer, place = np.flatnonzero(self.lengths), 0
        while len(longer):
            self.moves[:, longer] = MOVES[self.moves[:, longer], self.blob[self.starts[longer] + place]]
            place += 1
            longer = longer[self.lengths[longer] > place]
        self.token_moves = [row.tobytes() for row in self.moves]

    def whole(self, ids: np.ndarray, state: int) -> int | None:
        """How many of the first ids end with a whole character; None if some byte fits nothing."""
        inside = np.flatnonzero(self.moves[0][ids]).tolist()
        if not state and not inside:
            return len(ids)
        tokens, at, ends = ids.tolist(), 0, 0
        starts = iter(inside)
        while at < len(tokens):
            if not state:
                # tokens that begin and end between characters need no look
                at = next((i for i in starts if i >= at), len(tokens))
                ends = at
                if at == len(tokens):
                    break
            state = self.token_moves[state][tokens[at]]
            if state == BROKEN:
                return None
            at += 1
            if not state:
                ends = at
        return ends

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        at = np.repeat(self.starts[ids] - ends + lengths, lengths)
        at += np.arange(ends[-1])
        return self.blob[at].tobytes()


def decode_stream(chunks: Iterable[list[int]], decoder: Decoder) -> Iterator[str]:
    """Text of a stream of id lists, as soon as its characters are whole."""
    machine = Utf8Machine()
    for ids in chunks:
        yield machine.feed_ids(np.asarray(ids, dtype=np.int64), decoder)
    yield machine.feed(b"", last=True)


CHUNK_IDS = 1 << 16  # ids that the decoder is fed at once

# Letters, numbers and white space among the code points up to U+024F.
NARROW = {
    r"\p{L}": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f",
    r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe",
    r"\s": "\\t-\\r \x85\xa0",
    r"\S": "",
}
WIDE = re.compile("[^\x00-\u024f]")


def narrowed(pattern: str) -> re.Pattern | None:
    """The pattern for texts of code points up to U+024F, for a matcher that is faster but knows no \\p classes.

    None if the pattern has parts other than these classes whose meaning the two matchers may not share.
    """
    rest = pattern
    for name in NARROW:
        rest = rest.replace(name, "")
    if "\\" in rest or "(?" in rest.replace("(?!", "").replace("(?:", ""):
        return None
    out, inside = "", False
    at = 0
    while at < len(pattern):
        name = next((name for name in NARROW if pattern.startswith(name, at)), None)
        if name == r"\S":
            if inside:
                return None
            out += f"[^{NARROW[chr(92) + 's']}]"
        elif name:
            out += NARROW[name] if inside else f"[{NARROW[name]}]"
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out += pattern[at]
        at += len(name or "x")
    return re.compile(out)


class Encoder:
    """Whole texts to ids and back, with one transducer for all pieces. Serves one task, and its tables go with it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ids = PieceIds(Transducer(ranks))
        self.pattern = regex.compile(pattern)
        self.narrow = narrowed(pattern)
        self.decoder = Decoder(ranks)

    def encode_text(self, text: str) -> str:
        """Decimal ids joined by one space."""
        return " ".join(map(self.ids.__getitem__, self.pieces(text)))

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern, which has no groups."""
        narrow = self.narrow is not None and WIDE.search(text) is None
        return (self.narrow if narrow else self.pattern).findall(text)

    def decode_ids(self, ids: np.ndarray) -> str:
        machine = Utf8Machine()
        parts = [machine.feed_ids(ids[at : at + CHUNK_IDS], self.decoder) for at in range(0, len(ids), CHUNK_IDS)]
        return "".join(parts) + machine.feed(b"", last=True)


@contextmanager
def collector_paused() -> Iterator[None]:
    """The tables of a task hold no cycles; the collector would walk them over and over to find none."""
    running = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if running:
            gc.enable()


def id_array(text: str) -> np.ndarray:
    return np.fromstring(text, dtype=np.int32, sep=" ") if text else np.zeros(0, np.int32)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, column: str = "text", ids: bool = True, decoded: bool = False
) -> DataFrame:
    """Adds n_tokens and the digests of ids and decoded bytes to every row; on request ids and the decoded text.

    Every input column is kept; of names that clash with an added column the added one wins.
    A null text counts as empty: no tokens, the digests of nothing, an empty id list. Repeated
    rows get equal results. The vocabulary is read on the driver and broadcast (its size is fixed).
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids + ["decoded"] * decoded
    kept = [name for name in docs.columns if name not in added]
    if column not in kept:
        raise ValueError(f"{column} is also the name of an added column")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{k}`" for k in kept]).schema.fields]
    fields += ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>"] * ids + ["decoded string"] * decoded
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with collector_paused():
            encoder = Encoder(ranks.value, pattern)
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    counts, first, second, lists, texts = [], [], [], [], []
                    for text in batch.column(column).to_pylist():
                        said = encoder.encode_text(text or "")
                        numbers = id_array(said)
                        back = encoder.decode_ids(numbers)
                        counts.append(len(numbers))
                        first.append(hashlib.sha256(said.encode()).hexdigest())
                        second.append(hashlib.sha256(back.encode()).hexdigest())
                        if ids:
                            lists.append(numbers)
                        if decoded:
                            texts.append(back)
                    columns = [*batch.columns, pa.array(counts, pa.int64()), pa.array(first, pa.string())]
                    columns.append(pa.array(second, pa.string()))
                    columns += [pa.array(lists, pa.list_(pa.int32()))] * ids + [pa.array(texts, pa.string())] * decoded
                    yield pa.RecordBatch.from_arrays(columns, names=kept + added)

    return docs.select(*[f"`{name}`" for name in kept]).mapInArrow(rows, ", ".join(fields))


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return encode(docs.select("doc_id", F.col("text")), ranks_path, pattern, ids=False)

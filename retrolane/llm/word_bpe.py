"""BPE over words with a segment tree: the root of the tree is the next merge.

A piece starts as one symbol for each byte, the last with the mark of a word's end. The leaves of
the tree hold the ranks of adjacent pairs, with their places below the ranks, and every inner node
the least of its children: the root is the leftmost pair of the lowest rank. A merge changes
three leaves (the pair itself, the one before, the one after) and their paths, so a piece of n
bytes takes O(n log n), however long it is.

Files are those of the tokenizers library with a byte-level BPE: a normaliser, a pattern whose
matches are the pieces (the rest is dropped), merges, no decoder. Special tokens found in the raw
text become their ids, as they do in that library. Normalising and splitting texts with characters
above U+024F is left to the library, whose Unicode tables they follow; merging never is.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from retrolane.llm.bpe import WIDE, narrowed

NO_PAIR = 1 << 62
FAN = 16  # children of a node
CACHE_BYTES = 64_000_000  # of pieces that a task remembers, in two generations
PIECE_OVERHEAD = 240  # bytes of a remembered piece besides its letters and ids
SEGMENT = 1 << 20  # characters of a text that are worked on at once; cut before white space
ROWS = 256

# Fixed value: the normaliser under which lower-casing alone prepares texts up to U+024F.
PLAIN = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte) if byte in printable else chr(next(others)) for byte in range(256)]


class PairTree:
    """Least rank over adjacent pairs, with point updates. Equal ranks: the leftmost.

    A leaf is a rank with its place below it; a node is the least of its FAN children, so that a
    change costs one short minimum for each level.
    """

    def __init__(self, ranks: list[int | None]):
        leaves = [NO_PAIR if rank is None else rank << 32 | at for at, rank in enumerate(ranks)]
        self.levels = [leaves]
        while len(leaves) > FAN:
            leaves = [min(leaves[at : at + FAN]) for at in range(0, len(leaves), FAN)]
            self.levels.append(leaves)

    def put(self, at: int, rank: int | None) -> None:
        below = self.levels[0]
        below[at] = NO_PAIR if rank is None else rank << 32 | at
        for level in self.levels[1:]:
            at //= FAN
            least = min(below[at * FAN : at * FAN + FAN])
            if level[at] == least:
                break
            level[at] = least
            below = level

    def root(self) -> int:
        """Rank and place of the leftmost pair of the lowest rank; NO_PAIR if no pair can merge."""
        return min(self.levels[-1])


class Merges:
    """Symbols of single bytes and the merges between symbols, by id."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str):
        letters = byte_letters()
        self.inner = [vocabulary[letter] for letter in letters]
        self.last = [vocabulary[letter + end] for letter in letters]
        self.ranks = {(vocabulary[left], vocabulary[right]): rank for rank, (left, right) in enumerate(merges)}
        self.made = [vocabulary[left + right] for left, right in merges]

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece, which holds at least one byte."""
        inner, rank_of, made = self.inner, self.ranks.get, self.made
        symbols = [inner[byte] for byte in piece]
        symbols[-1] = self.last[piece[-1]]
        many = len(symbols)
        if many == 1:
            return symbols
        tree = PairTree([rank_of(pair) for pair in zip(symbols, symbols[1:], strict=False)])
        put = tree.put
        after = list(range(1, many + 1))
        before = list(range(-1, many))
        while (least := tree.root()) != NO_PAIR:
            left = least & 0xFFFFFFFF
            right = after[left]
            symbol = symbols[left] = made[least >> 32]
            symbols[right] = -1
            further = after[left] = after[right]
            before[further] = left
            if further < many:
                put(right, None)
                put(left, rank_of((symbol, symbols[further])))
            else:
                put(left, None)
            earlier = before[left]
            if earlier >= 0:
                put(earlier, rank_of((symbols[earlier], symbol)))
        return [symbol for symbol in symbols if symbol >= 0]


class Model:
    """What a file says, checked and reduced to what tasks need; picklable, of fixed size."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, split = said["model"], said["pre_tokenizer"]
        steps = split.get("pretokenizers", [])
        whole = [step["type"] for step in steps] == ["Split", "ByteLevel"]
        if not whole or model["type"] != "BPE" or said.get("decoder") or said.get("post_processor"):
            raise ValueError("not a byte-level BPE file with a pattern and without decoder or post-processor")
        if steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or steps[1]["use_regex"] or steps[1]["add_prefix_space"]:
            raise ValueError("only patterns whose matches are the pieces are known")
        if model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("drop-out, unknown tokens, prefixes and ignored merges are not known")
        marks = said["added_tokens"]
        if any(mark[flag] for mark in marks for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only added tokens that are found as they stand in the raw text are known")
        self.vocabulary = model["vocab"]
        self.merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.end = model.get("end_of_word_suffix") or ""
        self.marks = {mark["content"]: mark["id"] for mark in marks}
        self.pattern = steps[0]["pattern"]["Regex"]
        self.plain = said["normalizer"] == PLAIN
        rest = {"type": "Sequence", "pretokenizers": steps[:1]}
        empty = model | {"vocab": {}, "merges": []}
        self.library = json.dumps(said | {"added_tokens": [], "pre_tokenizer": rest, "model": empty})


class Encoder:
    """Whole texts to ids and back. Serves one task."""

    def __init__(self, model: Model):
        self.model = model
        self.merges = Merges(model.vocabulary, model.merges, model.end)
        self.tokens = {number: token for token, number in model.vocabulary.items()}
        self.tokens |= {number: mark for mark, number in model.marks.items()}
        longest = sorted(model.marks, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.narrow = narrowed(model.pattern) if model.plain else None
        self.library = None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text without special tokens."""
        if self.narrow is not None and (text.isascii() or WIDE.search(text) is None):
            lowered = text.lower()
            if lowered.isascii() or WIDE.search(lowered) is None:
                return self.narrow.findall(lowered)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.model.library)
        text = self.library.normalizer.normalize_str(text)
        return [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def piece(self, piece: str) -> bytes:
        """A piece's ids as little-endian unsigned 32-bit integers."""
        known = self.older.get(piece)
        if known is None:
            known = np.array(self.merges.encode(piece.encode()), "<u4").tobytes()
        size = PIECE_OVERHEAD + 4 * len(piece) + len(known)
        if size <= CACHE_BYTES // 1000:
            if self.held + size > CACHE_BYTES // 2:
                self.older, self.known, self.held = self.known, {}, 0
            self.known[piece] = known
            self.held += size
        return known

    @staticmethod
    def segments(text: str) -> Iterator[str]:
        """Parts of a text that can be normalised and split by themselves: no piece holds white space."""
        at = 0
        while len(text) - at > SEGMENT:
            space = re.compile(r"[\t\n\r ]").search(text, at + SEGMENT)
            if space is None:
                break
            yield text[at : space.start()]
            at = space.start()
        yield text[at:] if at else text

    def encode(self, text: str) -> Iterator[bytes]:
        """The ids of a text, in runs, as little-endian unsigned 32-bit integers."""
        marks = self.marks
        for part in marks.split(text) if marks is not None and marks.search(text) else (text,):
            if part in self.model.marks:
                yield self.model.marks[part].to_bytes(4, "little")
                continue
            for segment in self.segments(part):
                yield b"".join([self.known.get(piece) or self.piece(piece) for piece in self.pieces(segment)])

    def decode(self, ids: bytes) -> str:
        """Tokens of a run of ids joined by one space, which is what a file without decoder says."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, column: str = "text", ids: bool = True, decoded: bool = False) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 to every row; on request the ids and the decoded text.

    Every input column is kept; of names that clash with an added column the added one wins. A null
    text counts as empty: no tokens, the digests of nothing, an empty id list. Repeated rows get
    equal results. Long texts are worked on in segments, so that only their ids are held whole, and
    only where they are asked for. The file is read on the driver and broadcast (its size is fixed).
    """
    added = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids + ["decoded"] * decoded
    kept = [name for name in docs.columns if name not in added]
    if column not in kept:
        raise ValueError(f"{column} is also the name of an added column")
    docs = docs.select(*[f"`{name}`" for name in kept])
    fields = [f"`{field.name}` {field.dataType.simpleString()}" for field in docs.schema.fields]
    fields += ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<bigint>"] * ids + ["decoded string"] * decoded
    model = docs.sparkSession.sparkContext.broadcast(Model(path))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                counts, first, second, lists, texts = [], [], [], [], []
                for text in batch.column(column).to_pylist():
                    many, runs, said = 0, hashlib.sha256(), hashlib.sha256()
                    kept_ids, kept_text = [], []
                    for run in encoder.encode(text or ""):
                        if not run:
                            continue
                        shown = encoder.decode(run)
                        said.update((" " + shown if many else shown).encode())
                        runs.update(run)
                        many += len(run) // 4
                        if ids:
                            kept_ids.append(np.frombuffer(run, "<u4").astype(np.int64))
                        if decoded:
                            kept_text.append(shown)
                    counts.append(many)
                    first.append(runs.hexdigest())
                    second.append(said.hexdigest())
                    if ids:
                        lists.append(np.concatenate(kept_ids) if kept_ids else np.zeros(0, np.int64))
                    if decoded:
                        texts.append(" ".join(kept_text))
                columns = [*batch.columns, pa.array(counts, pa.int64()), pa.array(first, pa.string())]
                columns.append(pa.array(second, pa.string()))
                columns += [pa.array(lists, pa.list_(pa.int64()))] * ids + [pa.array(texts, pa.string())] * decoded
                yield pa.RecordBatch.from_arrays(columns, names=kept + added)

    return docs.mapInArrow(rows, ", ".join(fields))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return encode(docs.select("doc_id", "text"), path, ids=False).drop("text")

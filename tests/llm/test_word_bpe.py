import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from retrolane.llm import word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", " ", "\n\t", "a" * 3000, "Hello  World<|endoftext|>it's", "<|endoftext|><|startoftext|>", "<|endoftext|"]
TEXTS += ["İstanbul ΣΊΣΥΦΟΣ σς", "日本語のテキスト" * 20, "x́" * 5 + " é", "½ ² Ⅷ\x1c\x85\xa0y 123", "don't I'LL we'Re",
          "!!! ... ,,," * 30, "ǅ ß ÀÉÎ \x00 \x7f", "a ́b", "Ᲊ ՘ Ɤ"]


@pytest.fixture(scope="module")
def encoder():
    return word_bpe.Encoder(word_bpe.Model(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(encoder, text):
    data = b"".join(encoder.encode(text))
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def noise(seed: int) -> str:
    rng = random.Random(seed)
    letters = [*"abehtnSIN'  \n_1.,", *"éßñÄ", "世", "😀", "\x1c", "́", "<|endoftext|>"]
    return "".join(rng.choice(letters[: rng.choice([15, 19, len(letters)])]) for _ in range(rng.randrange(60)))


def test_ids_equal_the_library_and_decode_as_it_does(encoder, library):
    for text in TEXTS + [noise(seed) for seed in range(1500)]:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(encoder, text) == want, text
        shown = " ".join(part for part in map(encoder.decode, encoder.encode(text)) if part)
        assert shown == library.decode(want, skip_special_tokens=False)


def test_every_character_splits_as_in_the_library(encoder, library):
    for low in range(0, 0x3000, 16):
        text = " ".join(f"a{chr(c)}1{chr(c)}!{chr(c)}{chr(c)}" for c in range(low, low + 16))
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids, hex(low)
        for c in range(low, low + 16) if low < 0x300 else ():
            assert ids_of(encoder, chr(c) + "x") == library.encode(chr(c) + "x", add_special_tokens=False).ids, hex(c)


def test_tree_gives_the_leftmost_lowest_rank_after_every_change():
    rng = random.Random(5)
    for many in (1, 2, 16, 17, 31, 256, 257, 700):
        ranks = [rng.choice([None, 0, 1, 2, 5]) for _ in range(many)]
        tree = word_bpe.PairTree(ranks)
        for _ in range(60):
            known = [(rank, at) for at, rank in enumerate(ranks) if rank is not None]
            least = min(known) if known else None
            assert tree.root() == (least[0] << 32 | least[1] if least else word_bpe.NO_PAIR)
            at = rng.randrange(many)
            ranks[at] = rng.choice([None, 0, 1, 2, 5])
            tree.put(at, ranks[at])


def test_segments_of_long_texts_change_nothing(encoder, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "SEGMENT", 7)
    for seed in range(300):
        text = noise(seed) * 3
        assert ids_of(encoder, text) == library.encode(text, add_special_tokens=False).ids


def test_a_small_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHE_BYTES", 400_000)  # no generation holds more than half of it
    small = word_bpe.Encoder(word_bpe.Model(PATH))
    for seed in range(50):
        text = " ".join(str(random.Random(seed * 100 + i).random()) + noise(i) for i in range(20))
        assert ids_of(small, text) == library.encode(text, add_special_tokens=False).ids
        assert small.held <= 200_000


def test_rows_with_nulls_repeats_and_clashing_names(spark, library):
    rows = [Row(doc_id=1, text="Ha 1", ids="mine"), Row(doc_id=1, text="Ha 1", ids="mine")]
    rows += [Row(doc_id=None, text=None, ids=None), Row(doc_id=2, text="", ids="x")]
    rows += [Row(doc_id=3, text="é" * 40000, ids=""), Row(doc_id=4, text="one two, " * 300000, ids="")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = word_bpe.encode(docs, PATH, decoded=True).collect()
    assert len(out) == 6
    empty = hashlib.sha256(b"").hexdigest()
    for row in out:
        want = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == want and row["n_tokens"] == len(want)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        shown = library.decode(want, skip_special_tokens=False)
        assert row["decoded"] == shown and row["decoded_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert (row["ids_sha256"] == empty) == (not row["text"])
    assert word_bpe.encode(docs.limit(0), PATH).count() == 0
    assert set(word_bpe.digests(docs, PATH).columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}

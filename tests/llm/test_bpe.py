import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row

from retrolane.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["", " ", "a" * 3000, " " * 700 + "x", "\x00퟿😀é\n\n\t  b", "'s't  don't I'LL 12345 ١٢٣ _a_b", "<|endoftext|>"]
TEXTS += ["abab" * 400, "ö" * 900, "日本語のテキスト" * 20, "x́" * 5, "½ ² Ⅷ\x1c\x85\xa0y"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = bpe.load_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def noise(seed: int) -> str:
    rng = random.Random(seed)
    letters = [*"abehtnS'  \n_1", *"éßñ", "世", "😀", "\x1c", " "]
    return "".join(rng.choice(letters) for _ in range(rng.randrange(60)))


def test_ids_equal_the_library_and_decode_back(encoder, library):
    for text in TEXTS + [noise(seed) for seed in range(1500)]:
        ids = bpe.id_array(encoder.encode_text(text))
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode_ids(ids) == text


def test_a_small_state_table_gives_the_same_ids(library):
    small = bpe.Transducer(bpe.load_ranks(PATH), most_states=8)
    for text in ["unbelievable", "aaaaaaaaaaab" * 30, "Donaudampfschiff"]:
        assert small.encode(text.encode()) == library.encode_ordinary(text)


def test_pair_check_equals_the_merges(encoder):
    machine = encoder.ids.transducer
    rng = random.Random(3)
    for _ in range(4000):
        left, right = rng.randrange(50256), rng.randrange(50256)
        both = machine.tokens[left] + machine.tokens[right]
        parts = [both[i : i + 1] for i in range(len(both))]
        while len(parts) > 1:
            rank, at = min((machine.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert machine.stays(left, right) == (parts == [machine.tokens[left], machine.tokens[right]])


def test_stream_decoding_holds_back_unfinished_characters(encoder):
    text = "a😀é日" * 7
    data = text.encode()
    machine = bpe.Utf8Machine()
    assert "".join(machine.feed(data[i : i + 1]) for i in range(len(data))) + machine.feed(b"", last=True) == text
    broken = b"\xe6\x97x\xff\xf0\x9f\x98"
    machine = bpe.Utf8Machine()
    said = "".join(machine.feed(broken[i : i + 1]) for i in range(len(broken))) + machine.feed(b"", last=True)
    assert said == broken.decode(errors="replace")
    ids = bpe.id_array(encoder.encode_text(text)).tolist()
    assert "".join(bpe.decode_stream([[i] for i in ids], encoder.decoder)) == text


def test_the_machine_equals_the_codec_on_any_bytes_in_any_pieces(encoder):
    rng = random.Random(4)
    leads = [0x41, 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC1, 0xC2, 0xDF, 0xE0, 0xE1, 0xED, 0xEF, 0xF0, 0xF3, 0xF4, 0xF5, 0xFF]
    ranks = bpe.load_ranks(PATH)
    ids_of = [ranks[bytes([i])] for i in range(256)]
    whole = [rank for token, rank in ranks.items() if len(token) > 1]
    for _ in range(3000):
        data = bytes(rng.choice(leads) for _ in range(rng.randrange(14)))
        machine, out, at = bpe.Utf8Machine(), "", 0
        while at < len(data):
            size = rng.randrange(1, 5)
            out += machine.feed(data[at : at + size])
            at += size
        assert out + machine.feed(b"", last=True) == data.decode(errors="replace")
        ids = [ids_of[byte] for byte in data]
        for _ in range(rng.randrange(4)):
            ids.insert(rng.randrange(len(ids) + 1), rng.choice(whole))
        cuts = sorted(rng.choices(range(len(ids) + 1), k=3))
        chunks = [ids[a:b] for a, b in zip([0, *cuts], [*cuts, len(ids)])]
        raw = encoder.decoder.decode(bpe.np.array(ids, int))
        assert "".join(bpe.decode_stream(chunks, encoder.decoder)) == raw.decode(errors="replace")


def test_a_long_text_is_decoded_in_chunks(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_IDS", 3)
    for text in [*TEXTS, *map(noise, range(200))]:
        assert encoder.decode_ids(bpe.id_array(encoder.encode_text(text))) == text


def test_rows_with_nulls_repeats_and_clashing_names(spark, library):
    rows = [Row(doc_id=1, text="Ha 1", ids="mine"), Row(doc_id=1, text="Ha 1", ids="mine")]
    rows += [Row(doc_id=None, text=None, ids=None), Row(doc_id=2, text="", ids="x"), Row(doc_id=3, text="é" * 40000, ids="")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode(docs, PATH, public_tokenizers.PATTERN, decoded=True).collect()
    assert len(out) == 5
    empty = hashlib.sha256(b"").hexdigest()
    for row in out:
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert row["decoded"] == (row["text"] or "")
        assert row["n_tokens"] == len(row["ids"])
        assert (row["ids_sha256"] == empty) == (not row["text"])
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0

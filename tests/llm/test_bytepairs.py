import base64
import hashlib
import random
import string

import public_tokenizers
import pytest
import tiktoken

from cohorta.llm.bytepairs import Encoder, encode, encode_digests
from tests.llm.odd import EXTRA, SCHEMA, odd_rows, with_extra

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def hard_texts():
    rng = random.Random(6)
    letters = string.ascii_letters + "éüñ日本"
    return [
        "", "a", "a" * 500, "ab" * 300, " " * 300 + "x", "\n" * 200, "<|endoftext|>", "日本語テキスト" * 20,
        "😀😃🎉" * 30, "the" * 200, "!" * 333, "é" * 100, "it's we'll THEY'RE x y", "\x00\x01\r\n\t",
        *["".join(rng.choice(letters) for _ in range(rng.randint(1, 120))) for _ in range(60)],
    ]


def test_same_ids_as_the_library_and_exact_round_trip(reference):
    encoder = Encoder(PATH, public_tokenizers.PATTERN)
    texts = hard_texts()
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        assert [i for w in found for i in w[0]] == reference.encode_ordinary(text)
        assert b"".join(w[2] for w in found) == text.encode()


def test_long_words_take_the_same_tokens_either_way(reference):
    # words just over and under the limit of the short form, as prefixes of one text
    encoder = Encoder(PATH, public_tokenizers.PATTERN)
    rng = random.Random(7)
    words = ["".join(rng.choice("eainotrs") for _ in range(n)) for n in range(40, 60)] * 2
    words += ["e" * n for n in range(44, 54)]
    for word, found in zip(words, encoder.encode(words), strict=True):
        assert [i for w in found for i in w[0]] == reference.encode_ordinary(word)


def test_documents(spark, reference):
    rows = odd_rows()
    docs = spark.createDataFrame(with_extra(rows), f"{SCHEMA}, {EXTRA}").repartition(2)
    got = encode(docs, PATH, public_tokenizers.PATTERN)
    digests = encode_digests(docs, PATH, public_tokenizers.PATTERN)
    assert got.columns == [*[c for c in docs.columns if c not in ("ids", "Decoded")], "ids", "decoded"]
    for r in got.collect():
        assert r["ids"] == reference.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    for r in digests.collect():
        ids = reference.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_ranks_past_two_bytes(tmp_path):
    """Large vocabularies: no pair of parts is taken for another."""
    rng = random.Random(9)
    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {b"xy": 65_635, b"axy": 65_636, b"c" + b"\xff": 65_791}
    rank = 70_000
    made = [bytes([b]) for b in b"abcdexy"]
    while rank < 200_000 + 60:
        token = rng.choice(made) + rng.choice(made)
        if token not in ranks and len(token) < 9:
            ranks[token] = rank
            made.append(token)
            rank += rng.choice((1, 2, 5, 4000))
    path = tmp_path / "large.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    library = tiktoken.Encoding("large", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    encoder = Encoder(str(path), r"\S+|\s+")
    texts = ["bc", "axy xy", "bÿ"] + ["".join(rng.choice("abcdexy") for _ in range(rng.randint(1, 90))) for _ in range(200)]
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        assert [i for w in found for i in w[0]] == library.encode_ordinary(text)
        assert b"".join(w[2] for w in found) == text.encode()


def test_a_full_store_keeps_what_comes_again(monkeypatch, reference):
    """Words of two blocks outlive a block without them, and words of one block do not."""
    monkeypatch.setattr("cohorta.llm.bytepairs.STORE", 40)
    encoder = Encoder(PATH, public_tokenizers.PATTERN)
    asked = []
    contract = encoder._contract
    monkeypatch.setattr(encoder, "_contract", lambda words, short: (asked.extend(words), contract(words, short)))
    common = "blurghful zyxwv"
    blocks = [[f"{common} alone{chr(97 + i)}"] for i in range(2)]
    letters = string.ascii_lowercase
    blocks += [[" ".join(f"q{a}{b}{c}" for a in letters[:3] for b in letters), None, ""] for c in "xy"] + [[common]]
    for texts in blocks:
        for text, (n, ids, decoded) in zip(texts, encoder.encode_whole(texts), strict=True):
            wanted = reference.encode_ordinary(text or "")
            assert (n, ids, decoded) == (len(wanted), " ".join(map(str, wanted)), (text or "").encode())
    assert asked.count("blurghful") == 1
    assert not any("alone" in word for word in encoder.ids)

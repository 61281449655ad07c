import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from fieldcast.llm import bpe, packing

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", " a", "a  b", "a   b", "a\n b", "a \n b", "a\n \nb", "x<|endoftext|>y <|endoftext|>  z",
    "don't I'll we've", "\x1c\x1d a\x85b\xa0c", "日本語 テスト", "ab" * 3000, "é x́", "İstanbul ß ΣΑΣ",
    "😀 😀x", "a\tb\r\n d", "1234 5 67a8", "'s'S 't", "­ soft", ". ..", "<|startoftext|>a", "q" * 700,
]


def odd_texts(n):
    pick = random.Random(1)
    return ODD + ["".join(pick.choice("ab  \n\t'sStT<|1é日́\x85!") for _ in range(pick.randint(1, 40)))
                  for _ in range(n)]


def test_ids_and_texts_are_those_of_the_library():
    for path in (BYTES, WORDS):
        library, coder = Tokenizer.from_file(path), bpe.TextCoder(path)
        texts = odd_texts(400)
        for text, ids in zip(texts, coder.encode(texts)):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text
            if path == BYTES:
                assert coder.pairs.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_forced_boundaries_cut_no_token():
    pairs = bpe.BytePairs(BYTES)
    for raw in list(pairs.bytes_of.values())[::7]:
        codes = np.frombuffer(raw, np.uint8)
        if raw != b"<|endoftext|>":
            assert not pairs.forced[codes[:-1], codes[1:]].any()
    assert pairs.forced[ord("a"), ord(" ")]  # a letter and a space share no token


def test_long_text_is_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 50)
    library, coder = Tokenizer.from_file(BYTES), bpe.TextCoder(BYTES)
    text = "some words, and\n\nmore  words " * 40
    assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode(text).ids


def test_every_distinct_chunk_is_encoded_once(monkeypatch):
    seen, whole = [], bpe.BytePairs.encode_codes
    monkeypatch.setattr(bpe.BytePairs, "encode_codes",
                        lambda self, codes, *rest: seen.append(len(codes)) or whole(self, codes, *rest))
    text = "x" * 60 + " word" * 400_000  # three texts of a batch each; long chunks count, too
    library, coder = Tokenizer.from_file(WORDS), bpe.TextCoder(WORDS)
    ids = coder.encode([text] * 3)
    assert sum(seen) == 60 + 4
    assert np.frombuffer(ids[2], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids == \
        np.frombuffer(ids[0], "<u4").tolist()


def test_long_text_after_a_short_one_is_cut_too(monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_CHARS", 50)
    parts, cut = [], bpe.TextCoder._parts
    monkeypatch.setattr(bpe.TextCoder, "_parts", lambda self, text: parts.append(text) or cut(self, text))
    for path in (BYTES, WORDS):
        library, coder = Tokenizer.from_file(path), bpe.TextCoder(path)
        texts = ["x", "some words, and\n\nmore  words " * 40, "", "y z"]
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in coder.encode(texts)] == want
        assert parts.pop() == texts[1] and not parts


def test_blocks_of_any_size_and_nulls():
    texts = [None, *odd_texts(300), None]
    for path in (BYTES, WORDS):
        library, coder = Tokenizer.from_file(path), bpe.TextCoder(path)
        want = [library.encode(t or "", add_special_tokens=False).ids for t in texts[1:]]
        for block in (64, 1000, bpe.BLOCK_CHARS):
            got = coder.stream(pa.array(texts).slice(1), block)
            assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == want
        assert coder.encode([]) == []


def test_digests(spark, documents):
    docs = documents([None, "", "two words", "two words", *ODD])
    rows = bpe.coded_digests(docs, BYTES).collect()
    library, by_id = Tokenizer.from_file(BYTES), {r["doc_id"]: r for r in rows}
    assert len(rows) == 4 + len(ODD)
    for i, text in enumerate([None, "", "two words", "two words", *ODD]):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert by_id[i]["n_tokens"] == len(ids)
        assert by_id[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert by_id[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.coded_digests(docs.where("false"), BYTES).count() == 0
    assert bpe.coded(docs["text"], BYTES) is not None


def test_packing_places_every_piece(spark, documents):
    texts = [None, "", "a b", "a b", *[f"w{i} " * (i % 37) for i in range(300)], "long " * 9000]
    rows = packing.pack(documents(texts), WORDS, capacity=64).collect()
    library, want = Tokenizer.from_file(WORDS), {}
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[at:at + 64], "<u4")
            want[i, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in bins.values():
        inside.sort()
        assert [a for a, _ in inside] == list(np.cumsum([0, *[n for _, n in inside]])[:-1])
        assert sum(n for _, n in inside) <= 64
    assert len(bins) <= 1.01 * sum(n for _, n, _ in want.values()) / 64 + 1
    assert packing.pack(documents([]).limit(0), WORDS).count() == 0


def test_smaller_batches_give_the_same_pieces(spark, documents):
    docs = documents([*odd_texts(50), "word " * 700_000, None])  # more than a batch of either size
    full, trimmed = (packing.token_pieces(docs.coalesce(1), WORDS, trim=t).collect() for t in (False, True))
    assert sorted(map(str, full)) == sorted(map(str, trimmed)) and len(full) > 100


def test_fullest_is_the_best_subset_sum():
    pick = random.Random(2)
    for _ in range(200):
        left = {pick.randint(1, 20): pick.randint(1, 3) for _ in range(pick.randint(0, 5))}
        room = pick.randint(0, 60)
        sums = {0}
        for length, n in left.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        chosen = packing.fullest(left, room)
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= left[k] for k, n in chosen.items())

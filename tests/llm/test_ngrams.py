import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fieldcast.llm import ngrams
from fieldcast.llm.eliasfano import NOTHING, MonotoneSequence, NgramTrie, dequantise, quantise


def test_sequences_decode_any_window():
    pick = random.Random(1)
    for _ in range(150):
        n = pick.randint(0, 3000)
        values = np.sort(np.array([pick.randrange(pick.choice([3, 1000, 10**12])) for _ in range(n)], np.int64))
        packed = MonotoneSequence.encode(values)
        a = pick.randint(0, n)
        b = pick.randint(a, n)
        assert packed.window(a, b).tolist() == values[a:b].tolist()
    sparse = MonotoneSequence.encode(np.arange(0, 10**9, 10**5))
    assert sum(x.nbytes for x in sparse.arrays()) < 10_000 * 20 / 8 * 1.2  # 2 + log2(10**5) bits each


def test_trie_finds_exactly_its_pairs(monkeypatch):
    pick = np.random.default_rng(2)
    for window in (1, 7, 100, 65_536):
        monkeypatch.setattr(NgramTrie, "WINDOW", window)
        for span in (1, 4, 90, 10**6):
            keys = np.unique(pick.integers(0, span, 1500) * span + pick.integers(0, span, 1500))
            p = pick.random(len(keys))
            trie = NgramTrie(keys // span, keys % span, p, p)
            asked = np.sort(np.r_[pick.choice(keys, 300), pick.integers(0, span * span, 300)])
            want = dict(zip(keys.tolist(), quantise(p).tolist()))
            assert trie.find(asked // span, asked % span).tolist() == [want.get(k, NOTHING) for k in asked.tolist()]
            trie.close()
    none = np.zeros(0, np.int64)
    assert NgramTrie(none, none, none, none).find(np.array([3]), np.array([1])).tolist() == [NOTHING]


def test_codes_keep_three_decimals():
    p = np.array([1.0, 0.5, 1e-9, 0.0])
    back = dequantise(quantise(p))
    assert back[3] == 0 and np.allclose(back[:3], p[:3], rtol=3e-4)


def plain_scores(rows):
    """Word and pair counts in dictionaries, no quantising."""
    end = "\n"
    tokens = [[*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), end] for _, t in rows]
    held = [zlib.crc32((str(d) if d is not None else "").encode()) % 7 == 2 for d, _ in rows]
    single, pairs, n_texts = Counter(), Counter(), 0
    for words, out in zip(tokens, held):
        if not out:
            n_texts += 1
            single.update(words)
            pairs.update(zip([None, *words], words))
    n, v = sum(single.values()), len(single)
    result = []
    for (d, _), words, out in zip(rows, tokens, held):
        base = total = 0.0
        for a, b in zip([None, *words], words):
            p = (single[b] + 1) / (n + v + 1)
            c = n_texts if a is None else single[a]
            base += math.log10(p)
            total += math.log10((pairs[a, b] + ngrams.PRIOR * p) / (c + ngrams.PRIOR))
        result.append((d, out, len(words), sum(single[w] > 0 for w in words), n, base, total))
    return result


def compared(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[5], 6))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], abs_tol=1e-6)
        assert abs(g[6] - w[6]) <= 2e-4 * w[2] + 1e-9


@pytest.mark.parametrize("shard_tokens, chunk_bytes", [(4_000_000, 8 << 20), (300, 2000), (40, 1)])
def test_scores_equal_plain_counts(spark, documents, shard_tokens, chunk_bytes):
    """One shard, several, and so many that common words spread over all of them."""
    pick = random.Random(3)
    words = ["The", "the", "of", "é", "É", "x1", "ZÜ", " ", *[f"w{i}" for i in range(60)]]
    texts = ["", None, " \t\n ", "The The the\x0bof", "only here once", "the of " * 4000]
    texts += [" ".join(pick.choices(words, [60, 40, 30, *[1] * (len(words) - 3)], k=pick.randint(1, 80))) for _ in range(80)]
    texts += texts[-3:]
    ids = [*range(50, 50 + len(texts) - 2), 51, -4]
    rows = list(zip(ids, texts))
    got = ngrams.score(documents(texts, ids), shard_tokens=shard_tokens, chunk_bytes=chunk_bytes).collect()
    compared(got, plain_scores(rows))


def test_no_texts_and_no_training_texts(spark, documents):
    assert ngrams.score(documents(["a"]).where("false")).count() == 0
    held = next(i for i in range(1, 99) if ngrams.held_out(i, 7, 2))
    (row,) = ngrams.score(documents(["a b"], [held])).collect()
    assert tuple(row) == (held, True, 3, 0, 0, 0.0, 0.0)
    null = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    compared(ngrams.score(null).collect(), plain_scores([(None, "a b")] * 2))


def test_the_model_beats_single_words_on_texts_it_has_not_seen(spark, documents):
    pick = random.Random(8)
    follow = {w: pick.sample(range(40), 3) for w in range(40)}
    texts = []
    for _ in range(300):
        w, out = pick.randrange(40), []
        for _ in range(60):
            out.append(f"w{w}")
            w = pick.choice(follow[w])
        texts.append(" ".join(out))
    rows = [r for r in ngrams.score(documents(texts)).collect() if r["held_out"]]
    assert len(rows) > 20 and all(r["score"] > 0.5 * r["base_score"] for r in rows)

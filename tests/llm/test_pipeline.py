"""The corpus pipeline against a version in plain Python that shares no Spark code with it."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from fieldcast.llm import classifier, packing, pii, rules, simhash


def prose(pick, n):
    words = rules.COMMON_WORDS["en"]
    return " ".join(pick.choice(words) if pick.random() < 0.25 else "".join(
        pick.choice("aeinorst") for _ in range(pick.randint(3, 9))) for _ in range(n)) + "."


def corpus():
    pick = random.Random(11)
    good = [prose(pick, pick.randint(55, 260)) for _ in range(50)]
    bad = [prose(pick, 80).upper().replace(" ", "!! ") for _ in range(30)]
    near = [good[k].replace(" the ", " the the ", 1) if k % 2 else good[k] for k in range(10)]
    personal = [f"{t} Write to ab.{k}9@example.com or +1 (726) 555-78{k:02d}; 726-555-78{k:02d}." for k, t in enumerate(
        prose(pick, 70) for _ in range(8))]
    odd = [None, "", "two words", "same " * 90, prose(pick, 200).replace(" ", "$ "), prose(pick, 5000)]
    texts = good + bad + near + personal + odd
    docs = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    labels = [(i, 1, 0) for i in range(50)] + [(i, 0, 0) for i in range(50, 80)]
    return docs, labels


def classified(docs, labels):
    marked = {i: q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5}
    rows = [(at, n.astype(np.float32), marked[i]) for i, t, *_ in sorted(docs, key=lambda d: d[0])
            if i in marked and t is not None for at, n in [classifier.text_features(t)]]
    scores = classifier.Scorer(classifier.train(rows)).scores([d[1] or "" for d in docs])
    return [d for d, s in zip(docs, scores) if s >= 0.3]


def distance(counts, shares):
    total, out = max(sum(counts), 1), 0.0
    for c, q in zip(counts, shares):
        p = c / total
        m = (p + q) / 2
        out += (p * math.log2(p / m) if p else 0.0) + (q * math.log2(q / m) if q else 0.0)
    return math.sqrt(max(out / 2, 0.0))


def histograms(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    named = [sum(map(len, re.findall(p, text))) for p in (
        "[A-Z]", "[0-9]", "[.,;:!?]", "[#*$%&|<>]", r"[^\x00-\x7F]")]
    space = len(text) - sum(map(len, words))
    return [space, *named, len(text) - space - sum(named)], words


def sound(docs):
    out = []
    for d in docs:
        classes, words = histograms(d[1] or "")
        grams = list(zip(words, words[1:], words[2:]))
        seen = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        places = {k + n for k, g in enumerate(grams) if seen[g] > 1 for n in range(3)}
        near = False
        for lang, (class_shares, word_shares) in rules.references().items():
            common = [sum(w.lower() == x for w in words) for x in rules.COMMON_WORDS[lang]]
            near |= ((sum(classes) < rules.MIN_CHARS or distance(classes, class_shares) <= rules.CLASS_LIMIT) and (
                len(words) < rules.MIN_COMMON
                or distance([*common, len(words) - sum(common)], word_shares) <= rules.WORD_LIMIT))
        if len(words) >= 50 and 100 * len(places) <= 50 * len(words) and near:
            out.append(d)
    return out


def single(docs):
    prints = [simhash.fingerprint(t) & (2 ** 64 - 1) for _, t, *_ in docs]
    label = list(range(len(docs)))
    for _ in range(4):
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    return [d for i, d in enumerate(docs) if d[0] == min(docs[j][0] for j in range(len(docs)) if label[j] == label[i])]


def test_against_plain_python(spark, tmp_path):
    docs, labels = corpus()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = classified(docs, labels)
    assert {d[0] for d in kept} >= set(range(50)) and not {d[0] for d in kept} & set(range(50, 80))
    kept = single(sound(kept))
    field = pii.learn(sorted({(k, t[a:b][:80]) for _, t, *_ in kept for a, k, b in pii.base_spans(t)[:20]}))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, lengths = {}, {}
    for i, t, *_ in kept:
        ids = [*library.encode(pii.masked(field, t), add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at:at + 4096], "<u4")
            want[i, piece] = (at, len(part), zlib.crc32(part.tobytes()))
            lengths[len(part)] = lengths.get(len(part), 0) + 1
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    assert len({r["sequence_id"] for r in got}) == sum(n for n, _ in packing.minimum_slack(lengths))


def test_stages_keep_the_columns(spark, tmp_path):
    docs, labels = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    table = spark.createDataFrame(docs, schema).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path))
        assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"] and table.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path)).count() == 0

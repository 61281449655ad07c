"""Operator 11: scores of a bigram language model held in Elias-Fano tries.

Texts become chunks of tokens with a vocabulary of their own, kept in a table bucketed by chunk.
Each chunk sends its words, once each, to shards by checksum; a shard sums their counts, numbers
them and answers every chunk. With these numbers each chunk sends its different pairs of
neighbouring words to shards, once each with their number in training texts. A shard sums the
counts, builds a trie of its pairs (:mod:`fieldcast.llm.eliasfano`) and answers every chunk with
the quantised probabilities of the pairs it sent, from which the chunk scores its texts. A shard
holds a bounded number of words and pairs on average; contexts with very many tokens are spread
over all shards by their successor, and a word or pair comes once from a chunk, however frequent
it is. No table is held as a whole anywhere.

Probability of word w after v: (c(v, w) + PRIOR * p(w)) / (c(v) + PRIOR), with p(w) =
(c(w) + 1) / (N + V + 1) as in the base score; the probabilities sum to one over the vocabulary
and one unknown word. The first context of a text is a mark that is no token.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fieldcast.llm.common import give_back, write_bucketed, write_shared
from fieldcast.llm.eliasfano import NgramTrie, dequantise, quantise

CHUNK_BYTES = 8 << 20     # text of a chunk, one document at least
SHARD_TOKENS = 2_000_000  # tokens of the corpus for each shard
PRIOR = 100.0             # tokens that the unigrams count for after any word
END = b""                 # no word has this text


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, equal bytes of neighbours side by side, compressed."""
    wide = values.astype("<u8" if len(values) and int(values.max()) >> 32 else "<u4")
    body = wide.view(np.uint8).reshape(-1, wide.itemsize).T.tobytes()
    return bytes([wide.itemsize]) + zstandard.compress(body, 1)


def unpacked(data: bytes) -> np.ndarray:
    size = data[0]
    body = np.frombuffer(zstandard.decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(body.reshape(size, -1).T).view(f"<u{size}").ravel().astype(np.int64)


_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())),
    *[(c, pa.binary()) for c in ("codes", "lengths", "order", "words", "trained")], ("n_tokens", pa.int64())])
CHUNK = ("chunk long, doc_ids array<long>, held_out array<boolean>, codes binary, lengths binary, order binary, "
         "words binary, trained binary, n_tokens long")


def held_out(doc_id: int | None, fold: int, held: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else b"%d" % doc_id) % fold == held


def checksums(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _text(words: list[bytes]) -> bytes:
    return zstandard.compress(b" ".join(words), 1)


def _words(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split(b" ")


def _chunks(batches: Iterator[pa.RecordBatch], fold: int, held: int, most: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    vocabulary, codes, lengths, ids, size = defaultdict(), [], [], [], 0

    def fresh():
        nonlocal vocabulary, codes, lengths, ids, size
        vocabulary, codes, lengths, ids, size = defaultdict(), [], [], [], 0
        vocabulary.default_factory = vocabulary.__len__

    def chunk():
        nonlocal number
        out = [held_out(d, fold, held) for d in ids]
        flat = np.concatenate(codes)
        trains = np.repeat(~np.array(out), lengths)
        words = list(vocabulary)
        order = np.argsort(checksums(words), kind="stable")
        trained = np.bincount(flat[trains], minlength=len(words))
        row = [number, ids, out, packed(flat), packed(np.array(lengths)), packed(order),
               _text([words[k] for k in order]), packed(trained[order]), len(flat)]
        number += 1
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK)], schema=_CHUNK)

    fresh()
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            data = text.as_py() or b""
            words = data.lower().split()  # bytes: A-Z only, and the six white space characters
            words.append(END)
            codes.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
            lengths.append(len(words))
            ids.append(doc_id)
            size += len(data)
            if size >= most:
                yield chunk()
                fresh()
    if ids:
        yield chunk()
    give_back()


class Chunk:
    """A chunk with the global ids and counts of its words, and its different pairs."""

    def __init__(self, row: dict, starts: int, shards: int, hot: float):
        lengths = unpacked(row["lengths"])
        self.lengths, self.words = lengths, unpacked(row["codes"])
        order = unpacked(row["order"])
        n = len(order)
        self.counts = np.zeros(n + 1, np.int64)   # the last one is the mark at the start
        ids = np.full(n + 1, -1, np.int64)
        told = [_split(a["answer"]) for a in sorted(row["known"], key=lambda a: a["shard"])]
        ids[order], self.counts[order] = (np.concatenate([t[k] for t in told]) for k in (0, 1))
        ids -= ids == 0
        self.counts[n], ids[n] = starts, 0 if starts else -1
        self.before = np.empty_like(self.words)
        self.before[1:] = self.words[:-1]
        self.firsts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
        self.before[self.firsts] = n
        self.paired = (ids[self.before] >= 0) & (ids[self.words] >= 0)
        key = self.before[self.paired] * (n + 1) + self.words[self.paired]
        pairs, self.place = np.unique(key, return_inverse=True)
        left, right = pairs // (n + 1), pairs % (n + 1)
        v, w, self.c = ids[left], ids[right], self.counts[left]
        mixed = v * 0x9E3779B1 + np.where(self.c > hot, w * 0x85EBCA77, 0)
        self.shard = ((mixed ^ (mixed >> 15)) & 0x7FFFFFFF) % shards
        self.order = np.lexsort((w, v, self.shard))
        self.v, self.w = v, w


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {c: batch[c][i].as_py() for c in batch.schema.names}


_SENT = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("words", pa.binary()), ("trained", pa.binary())])
_NUMBERED = pa.schema([("chunk", pa.int64()), ("shard", pa.int64()), ("answer", pa.binary()),
                       ("tokens", pa.int64()), ("known", pa.int64())])


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _sent_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The words of each chunk by shard; they lie in the order of their checksums, so do shards."""
    for batch in batches:
        for row in _rows(batch):
            words, trained = _words(row["words"]), unpacked(row["trained"])
            shard = (checksums(words) * np.uint64(shards)) >> np.uint64(32)
            edges = np.searchsorted(shard, np.arange(shards + 1).astype(np.uint64))
            yield _record([
                (k, row["chunk"], _text(words[edges[k]:edges[k + 1]]), packed(trained[edges[k]:edges[k + 1]]))
                for k in np.flatnonzero(np.diff(edges))], _SENT)
    give_back()


def _by_shard(batches: Iterator[pa.RecordBatch], answer) -> Iterator[pa.RecordBatch]:
    """Rows of sorted batches, all of a shard at a time."""
    here, held = None, []
    for batch in batches:
        for shard, *row in zip(*[c.to_pylist() for c in batch.columns]):
            if shard != here and held:
                yield answer(here, held)
                held = []
            here = shard
            held.append(row)
    if held:
        yield answer(here, held)
    give_back()


def _numbered(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    def answer(shard: int, held: list) -> pa.RecordBatch:
        places: defaultdict = defaultdict()
        places.default_factory = places.__len__
        sent = [np.fromiter(map(places.__getitem__, _words(words)), np.int64) for _, words, _ in held]
        total = np.zeros(len(places), np.int64)
        for at, (_, _, trained) in zip(sent, held):
            total[at] += unpacked(trained)  # a chunk has a word once
        ids = np.where(total > 0, (np.cumsum(total > 0) - 1) * shards + shard + 1, 0)
        rows = [(chunk, shard, _joined([ids[at], total[at]]), 0, 0) for at, (chunk, *_) in zip(sent, held)]
        return _record([*rows, (None, shard, None, int(total.sum()), int((total > 0).sum()))], _NUMBERED)

    yield from _by_shard(batches, answer)


_PAIRS = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("pairs", pa.binary())])


def _joined(parts: list[np.ndarray]) -> bytes:
    blobs = [packed(p) for p in parts]
    return b"".join(len(b).to_bytes(4, "little") + b for b in blobs)


def _split(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "little")
        out.append(unpacked(data[at + 4:at + 4 + size]))
        at += 4 + size
    return out


def _pairs(batches: Iterator[pa.RecordBatch], starts: int, shards: int, hot: float) -> Iterator[pa.RecordBatch]:
    """The different pairs of each chunk by shard: contexts with their counts and numbers of
    successors, successors with their numbers in training texts."""
    for batch in batches:
        for row in _rows(batch):
            at = Chunk(row, starts, shards, hot)
            trains = np.repeat(~np.array(row["held_out"], bool), at.lengths)[at.paired]
            n = np.bincount(at.place, weights=trains, minlength=len(at.v)).astype(np.int64)
            v, w, n, c, shard = (x[at.order] for x in (at.v, at.w, n, at.c, at.shard))
            edges = np.searchsorted(shard, np.arange(shards + 1))
            out = []
            for k in np.flatnonzero(np.diff(edges)):
                s = slice(edges[k], edges[k + 1])
                first = np.flatnonzero(np.r_[True, v[s][1:] != v[s][:-1]])
                run = np.diff(np.r_[first, s.stop - s.start])
                out.append((k, row["chunk"], _joined([np.diff(v[s][first], prepend=0), run, c[s][first], w[s], n[s]])))
            yield _record(out, _PAIRS)
    give_back()


_ANSWERS = pa.schema([("chunk", pa.int64()), ("shard", pa.int64()), ("answer", pa.binary())])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _by_shard(batches, _answered)


def _answered(shard: int, held: list) -> pa.RecordBatch:
    """The trie of a shard, and the codes of all pairs that were sent to it."""
    sent = [_split(pairs) for _, pairs in held]
    v = np.concatenate([np.repeat(np.cumsum(d), run) for d, run, _, _, _ in sent])
    c = np.concatenate([np.repeat(c, run) for _, run, c, _, _ in sent])
    w, n = (np.concatenate([s[k] for s in sent]) for k in (3, 4))
    contexts, v_at = np.unique(v, return_inverse=True)
    words, w_at = np.unique(w, return_inverse=True)
    pairs, first, place = np.unique(v_at * len(words) + w_at, return_index=True, return_inverse=True)
    total = np.bincount(place, weights=n)
    v, w, c = v[first], w[first], c[first]
    seen = total > 0
    trie = NgramTrie(v[seen], w[seen], total[seen] / (c[seen] + PRIOR), PRIOR / (c[seen] + PRIOR))
    codes = trie.find(v, w)[place].astype(np.int64)
    trie.close()
    ends = np.cumsum([len(s[3]) for s in sent])[:-1]
    rows = [(chunk, shard, packed(part)) for (chunk, _), part in zip(held, np.split(codes, ends))]
    return _record(rows, _ANSWERS)


_SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORE = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
         "score double")


def _scores(batches: Iterator[pa.RecordBatch], starts: int, shards: int, hot: float, n: int, v: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            at = Chunk(row, starts, shards, hot)
            codes = np.zeros(len(at.v), np.uint16)
            answers = [unpacked(a["answer"]) for a in sorted(row["answers"] or [], key=lambda a: a["shard"])]
            codes[at.order] = np.concatenate(answers) if answers else []
            single = (at.counts + 1) / (n + (v + 1))
            left = np.where(at.counts > 0, dequantise(quantise(PRIOR / (at.counts + PRIOR))), 1.0)
            p = left[at.before] * single[at.words]
            p[at.paired] += dequantise(codes)[at.place]
            known = (at.counts[at.words] > 0).astype(np.int64)
            sums = [np.add.reduceat(x, at.firsts) for x in (known, np.log10(single)[at.words], np.log10(np.minimum(p, 1.0)))]
            yield pa.RecordBatch.from_arrays([
                pa.array(x, f.type) for x, f in zip([
                    row["doc_ids"], row["held_out"], at.lengths, sums[0], np.full(len(at.lengths), n), *sums[1:]], _SCORE)],
                schema=_SCORE)
    give_back()


def score(docs: DataFrame, fold: int = 7, held: int = 2, shard_tokens: int = SHARD_TOKENS,
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of ``docs``.

    Columns doc_id and text are read, others ignored; a null text is empty, that is, one end token.
    A null doc_id has the checksum of an empty text and stays null; rows are scored one by one,
    also those that repeat an id. Without training texts every token has the probability one. An
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # Bucketed, so that neither of the two joins by chunk moves the tokens.
    chunks = write_bucketed(
        rows.mapInArrow(partial(_chunks, fold=fold, held=held, most=chunk_bytes), CHUNK), "chunk", "lm_chunks")
    lengths = chunks.agg(F.sum(F.size(F.filter("held_out", lambda x: ~x))), F.sum("n_tokens")).first()
    starts, shards = lengths[0] or 0, 1 + (lengths[1] or 0) // shard_tokens
    sent = chunks.select("chunk", "words", "trained").mapInArrow(
        partial(_sent_words, shards=shards), "shard long, chunk long, words binary, trained binary")
    numbered = write_shared(sent.repartition("shard").sortWithinPartitions("shard", "chunk").mapInArrow(
        partial(_numbered, shards=shards), "chunk long, shard long, answer binary, tokens long, known long"), "lm-words")
    totals = numbered.agg(F.sum("tokens"), F.sum("known")).first()
    tokens, vocabulary = totals[0] or 0, totals[1] or 0
    known = numbered.where("chunk IS NOT NULL").groupBy("chunk").agg(
        F.collect_list(F.struct("shard", "answer")).alias("known"))
    slim = chunks.drop("words", "trained", "n_tokens").join(known, "chunk")
    at = {"starts": starts, "shards": shards, "hot": max(1.0, tokens / (8 * shards))}
    pairs = slim.drop("doc_ids").mapInArrow(partial(_pairs, **at), "shard long, chunk long, pairs binary")
    answers = pairs.repartition("shard").sortWithinPartitions("shard", "chunk").mapInArrow(
        _answers, "chunk long, shard long, answer binary")
    gathered = answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "answer")).alias("answers"))
    return slim.join(gathered, "chunk", "left").mapInArrow(partial(_scores, **at, n=tokens, v=vocabulary), SCORE)

"""Operator 4: byte-pair encoding and decoding with forced boundaries.

A pair of adjacent bytes that occurs inside no token of the vocabulary can never end up in
one token, so the text may be cut there before any merge is tried. Fragments between cuts
are encoded on their own, all fragments of a batch side by side in numpy, and their ids are
joined again.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.llm.common import slices, texts_of

# The pre-tokenizer patterns of the two vocabularies. White_Space stands for
# \s, which Python would widen by four control characters.
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

BATCH_CHARS = 2_000_000   # characters that are Python strings at a time
BLOCK_CHARS = 16_000_000  # characters whose distinct chunks are encoded once: bounds the memory of a task
LONG_FRAGMENT = 512       # longer fragments use the heap
NONE = np.iinfo(np.int32).max
#: Characters whose class no edition of Unicode disputes; others go to the library's splitter.
PLAIN = re.compile(r"[\x20-\x7e\n¡-¬®-įĲ-ɏ]*")
#: Characters of chunks whose pre-tokens are their runs of letters, of digits and of other marks;
#: such a chunk may also begin with a space.
RUNS = re.compile(r"[\x21-\x26\x28-\x3b\x3d-\x7e¡-¬®-ÿ]")
SAFE_CUT = re.compile(r"(?<=\S)(?= )")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, as letter -> byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairTable:
    """(left id, right id) -> (rank, merged id), looked up for whole arrays at once."""

    BITS = 19

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.pairs = pairs
        size = 1 << self.BITS
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NONE, np.int32)
        self.made = np.zeros(size, np.int32)
        table = np.array([(a << 32 | b, *to) for (a, b), to in pairs.items()], np.int64).reshape(-1, 3)
        at = self._slot(table[:, 0])
        while at.size:  # all pairs at once; those whose slot is taken go on to the next one
            free = self.keys[at] < 0
            self.keys[at[free]] = table[free, 0]
            put = self.keys[at] == table[:, 0]
            self.rank[at[put]], self.made[at[put]] = table[put, 1], table[put, 2]
            at, table = (at[~put] + 1) & (size - 1), table[~put]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair, or -1."""
        keys = (left.astype(np.int64) << 32) | right
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, at, -1)
        todo = np.flatnonzero((seen != keys) & (seen >= 0))
        while todo.size:
            at[todo] = (at[todo] + 1) & (self.keys.size - 1)
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit & (seen >= 0)]
        return out


def merge_long(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge one fragment with a heap of pairs: n log n for a fragment of any length."""
    n = len(symbols)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    symbols, heap = list(symbols), []
    for i in range(n - 1):
        if found := pairs.get((symbols[i], symbols[i + 1])):
            heap.append((found[0], i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    gone = [False] * n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j < 0 or symbols[i] != a or symbols[j] != b:
            continue
        symbols[i] = pairs[(a, b)][1]
        gone[j] = True
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] >= 0:
                pair = symbols[left], symbols[after[left]]
                if found := pairs.get(pair):
                    heapq.heappush(heap, (found[0], left, *pair))
    return [s for s, dead in zip(symbols, gone) if not dead]


class BytePairs:
    """A vocabulary file's merges over bytes, and its forced boundaries."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.suffix = suffix
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.first = np.zeros(256, np.int32)   # id of a byte inside a word
        self.last = np.zeros(256, np.int32)    # id of a byte that ends a word
        for letter, byte in letters.items():
            self.first[byte] = vocab[letter]
            self.last[byte] = vocab[letter + suffix]
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.table = PairTable(merges)
        self.bytes_of: dict[int, bytes] = {}
        self.forced = np.ones((256, 256), bool)
        known, as_bytes = set(letters), {ord(letter): byte for letter, byte in letters.items()}
        for token, i in vocab.items():
            word = token.removesuffix(suffix) if suffix else token
            self.bytes_of[i] = word.translate(as_bytes).encode("latin-1") if known.issuperset(word) else word.encode()
        codes = np.frombuffer(b"".join(self.bytes_of.values()), np.uint8)
        inside = np.ones(codes.size + 1, bool)  # places that do not begin a token
        inside[np.cumsum([0, *map(len, self.bytes_of.values())])] = False
        inside = np.flatnonzero(inside)
        self.forced[codes[inside - 1], codes[inside]] = False
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        ordered = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.sizes = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(ordered), np.uint8)

    def encode_words(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids (little-endian 32-bit) of each pre-token; words are never empty."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        first = np.zeros(int(ends[-1]), bool)
        first[0] = True
        first[ends[:-1]] = True
        ids, counts = self.encode_codes(np.frombuffer(b"".join(words), np.uint8), first, ends)
        raw, stops = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def encode_codes(self, codes: np.ndarray, first: np.ndarray, ends: np.ndarray):
        """``codes``: bytes of all chunks; ``first``: where a pre-token begins; ``ends``: end of
        each chunk. The ids of all chunks, joined, and how many each chunk has."""
        symbols = np.where(np.append(first[1:], True), self.last[codes], self.first[codes])
        cut = first.copy()
        cut[1:] |= self.forced[codes[:-1], codes[1:]]
        ids, owner = self._merge(symbols, np.cumsum(cut) - 1)
        chunk = np.searchsorted(ends, np.flatnonzero(cut), side="right")
        return ids.astype("<u4"), np.bincount(chunk[owner], minlength=len(ends))

    def _merge(self, symbols: np.ndarray, fragment: np.ndarray):
        """Ids in order and the fragment of each; every round merges, in every fragment, all
        places of its lowest-ranked pair."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        sizes = np.bincount(fragment)
        if (long := np.flatnonzero(sizes > LONG_FRAGMENT)).size:
            stops = np.cumsum(sizes)
            for k in long:
                ids = merge_long(symbols[stops[k] - sizes[k]:stops[k]].tolist(), self.table.pairs)
                done.append((np.array(ids, np.int32), np.full(len(ids), k)))
            short = sizes[fragment] <= LONG_FRAGMENT
            symbols, fragment = symbols[short], fragment[short]
        slot = self._slots(symbols, fragment, np.arange(symbols.size - 1))
        while symbols.size:
            rank = np.where(slot >= 0, self.table.rank[slot], NONE)
            starts = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            counts = np.diff(np.append(starts, symbols.size))
            best = np.repeat(np.minimum.reduceat(rank, starts), counts)
            still = best == NONE
            if still.any():
                done.append((symbols[still], fragment[still]))
            here = (rank == best) & ~still
            # of overlapping places (a run of one repeated symbol) every second one, from the left
            if (here[1:] & here[:-1]).any():
                begins = here & ~np.concatenate([[False], here[:-1]])
                run = np.maximum.accumulate(np.where(begins, np.arange(here.size), 0))
                here &= (np.arange(here.size) - run) % 2 == 0
            symbols = np.where(here, self.table.made[slot], symbols)
            keep = ~still
            keep[1:] &= ~here[:-1]
            symbols, fragment, slot, here = symbols[keep], fragment[keep], slot[keep], here[keep]
            changed = here.copy()
            changed[:-1] |= here[1:]
            slot = self._slots(symbols, fragment, np.flatnonzero(changed[:-1]), slot)
        ids = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int32)
        owner = np.concatenate([d[1] for d in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def _slots(self, symbols, fragment, places, slot=None):
        """Table slots of the pairs that begin at ``places``; -1 at the end of a fragment."""
        if slot is None:
            slot = np.full(symbols.size, -1, np.int64)
        elif slot.size:
            slot[-1] = -1
        inner = fragment[places] == fragment[places + 1]
        slot[places[~inner]] = -1
        places = places[inner]
        slot[places] = self.table.find(symbols[places], symbols[places + 1])
        return slot

    def decode(self, ids: bytes) -> str:
        codes = np.frombuffer(ids, "<u4")
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[codes] - (ends - sizes), sizes) + np.arange(ends[-1] if ends.size else 0)
        return self.blob[at].tobytes().decode("utf-8", "replace")


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start:start + size] of every item, joined."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if ends.size else 0)]


class TextCoder:
    """Texts to ids. Texts are cut into chunks at spaces where no pre-token can span the cut;
    Arrow tells the chunks of a block of texts apart, and each distinct one is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.pairs = BytePairs(path)
        self.words = bool(self.pairs.suffix)
        self.pattern = regex.compile(WORD_PATTERN if self.words else BYTE_PATTERN)
        self.letters = byte_letters()
        special = "|".join(map(re.escape, sorted(self.pairs.special, key=len, reverse=True)))
        self.special = re.compile(f"({special})") if special else None
        kinds = [1 + bool(regex.match(r"\p{N}", chr(i))) + 2 * (not regex.match(r"[\p{L}\p{N}]", chr(i)))
                 for i in range(0x100)]
        self.kind = np.array(kinds, np.int8)  # 1 letter, 2 digit, 3 other
        self.plain = np.array([bool(RUNS.match(chr(i))) for i in range(0x100)] + [False])
        self.lower = np.array([ord(chr(i).lower() if self.words else chr(i)) for i in range(0x100)], np.uint32)

    def chunks(self, text: str) -> list[str]:
        if self.words:  # this vocabulary drops white space
            return text.replace("\n", " ").split(" ")
        flat = text.replace("\n", " ")
        single = "  " not in flat and flat[:1] != " " and flat[-1:] != " "
        if not single or len(text.split()) != flat.count(" ") + 1:
            return SAFE_CUT.split(text)
        # All white space is single spaces and line feeds: a line feed is a pre-token of its
        # own, and a space belongs to the word after it.
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def pre_tokens(self, chunk: str) -> list[bytes]:
        if PLAIN.fullmatch(chunk):
            return [x.encode() for x in self.pattern.findall(chunk.lower() if self.words else chunk)]
        if self.words:
            chunk = self.library.normalizer.normalize_str(chunk)
        parts = self.library.pre_tokenizer.pre_tokenize_str(chunk)
        return [bytes(map(self.letters.__getitem__, part)) for part, _ in parts if part]

    def learn(self, chunks: pa.StringArray, most: int):
        """The ids of distinct chunks, about ``most`` bytes at a time: (ids, starts, sizes), the ids of
        chunk k being ids[starts[k]:starts[k] + sizes[k]]."""
        total = np.cumsum(pc.binary_length(chunks).to_numpy().astype(np.int64))
        steps = np.searchsorted(total, np.arange(most, total[-1] if total.size else 0, most)) + 1
        bounds = np.unique([0, *steps, len(chunks)]).tolist()
        done, at = [(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
        for a, b in zip(bounds, bounds[1:]):
            ids, starts, sizes = self._learn(chunks.slice(a, b - a))
            done.append((ids, starts + at, sizes))
            at += ids.size
        return tuple(map(np.concatenate, zip(*done)))

    def _learn(self, chunks: pa.StringArray):
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(chunks)], chunks), "")[0].as_py()
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        lengths = pc.utf8_length(chunks).to_numpy().astype(np.int64)
        head = np.zeros(points.size + 1, bool)  # the first character of a chunk
        head[np.cumsum(lengths) - lengths] = True
        head = head[:-1]
        space = head & (points == 32)
        odd = ~(space | self.plain[np.minimum(points, 0x100)])
        odds, spaces = (np.diff(np.append(0, np.cumsum(x))[np.append(0, np.cumsum(lengths))]) for x in (odd, space))
        runs = (odds == 0) & (lengths > spaces)
        kept = np.repeat(runs, lengths)
        ids, counts = self._learn_runs(points[kept], head[kept], lengths[runs])
        rest = self._learn_rest(chunks.filter(pa.array(~runs)).to_pylist())
        sizes = np.zeros(len(chunks), np.int64)
        sizes[runs], sizes[~runs] = counts, [len(x) // 4 for x in rest]
        starts = np.zeros(len(chunks), np.int64)
        starts[runs] = np.cumsum(counts) - counts
        starts[~runs] = ids.size + np.cumsum(sizes[~runs]) - sizes[~runs]
        return np.concatenate([ids, np.frombuffer(b"".join(rest), "<u4")]), starts, sizes

    def _learn_runs(self, points: np.ndarray, head: np.ndarray, lengths: np.ndarray):
        """Chunks whose pre-tokens begin where the class of the character changes."""
        if not lengths.size:
            return np.zeros(0, np.uint32), lengths
        points = self.lower[points]
        kind = self.kind[points]
        kind[points == 32] = 4
        begins = head.copy()
        begins[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != 4)
        if self.words:
            begins |= kind == 2  # digits stand alone
        two = points >= 0x80
        after = np.cumsum(1 + two)
        place = after - 1 - two
        first, codes = np.zeros(int(after[-1]), bool), np.zeros(int(after[-1]), np.uint8)
        first[place[begins]] = True
        codes[place] = np.where(two, 0xC0 | points >> 6, points)
        codes[place[two] + 1] = 0x80 | points[two] & 0x3F
        return self.pairs.encode_codes(codes, first, after[np.cumsum(lengths) - 1])

    def _learn_rest(self, new: list[str]) -> list[bytes]:
        """Chunks with apostrophes, white space, special tokens or rare characters."""
        flat: list[bytes] = []
        plan: list[list[tuple[int, int, bytes]]] = []
        for chunk in new:
            parts = []
            pieces = self.special.split(chunk) if self.special and "<|" in chunk else [chunk]
            for k, piece in enumerate(pieces):
                if k % 2:
                    parts.append((0, 0, self.pairs.special[piece].to_bytes(4, "little")))
                elif piece:
                    words = self.pre_tokens(piece)
                    parts.append((len(flat), len(flat) + len(words), b""))
                    flat += words
            plan.append(parts)
        ids = self.pairs.encode_words(flat) if flat else []
        return [b"".join(s or b"".join(ids[a:b]) for a, b, s in parts) for parts in plan]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        return list(self.stream(pa.array(texts, pa.string())))

    def stream(self, texts: pa.StringArray, block: int = BLOCK_CHARS) -> Iterator[bytes]:
        """The ids of each text in order, nulls as empty texts; memory is bounded by ``block``
        characters and the longest text without a safe cut."""
        sizes, start = pc.fill_null(pc.binary_length(texts), 0).to_numpy(), 0
        for k in [*np.flatnonzero(sizes > 2 * BATCH_CHARS).tolist(), len(texts)]:
            for a, b in slices(sizes[start:k].tolist(), block):
                yield from self._encode(texts.slice(start + a, b - a), block)
            if k < len(texts):
                parts = self._parts(texts[k].as_py())
                yield b"".join(ids for part in parts for ids in self._encode(pa.array([part]), block))
            start = k + 1

    def _parts(self, text: str):
        """A very long text in parts, cut where a pre-token cannot span the cut."""
        start, cut = 0, re.compile(r"(?<=\S)(?= \S)")
        while len(text) - start > 2 * BATCH_CHARS:
            found = cut.search(text, start + BATCH_CHARS)
            if not found:
                break
            yield text[start:found.start()]
            start = found.start()
        yield text[start:]

    def _split(self, texts: pa.StringArray):
        """The chunks of all texts, joined, and where those of each text begin and end."""
        if self.words:  # as in ``chunks``
            lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
            return lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
        values, counts = [pa.array([], pa.string())], [0]
        for _, part in texts_of(texts, BATCH_CHARS):
            split = [self.chunks(t) for t in part]
            values.append(pa.array(list(chain.from_iterable(split)), pa.string()))
            counts += map(len, split)
        return pa.concat_arrays(values), np.cumsum(counts)

    def _encode(self, texts: pa.StringArray, block: int) -> Iterator[bytes]:
        values, bounds = self._split(texts)
        found = values.dictionary_encode()
        ids, starts, sizes = self.learn(found.dictionary, block // 32)
        which = found.indices.to_numpy()
        for a, b in slices(np.diff(bounds).tolist(), block // 64):
            here = which[bounds[a]:bounds[b]]
            raw = gathered(ids, starts[here], sizes[here]).tobytes()
            cuts = (4 * np.append(0, np.cumsum(sizes[here]))[bounds[a:b + 1] - bounds[a]]).tolist()
            yield from (raw[i:j] for i, j in zip(cuts, cuts[1:]))


_CODERS: dict[str, TextCoder] = {}


def coder(path: str) -> TextCoder:
    """One coder per worker process and vocabulary file."""
    if path not in _CODERS:
        _CODERS[path] = TextCoder(path)
    return _CODERS[path]


def drop_coders() -> None:
    """Free the vocabulary at the end of a task; loading it again takes a fraction of a second."""
    _CODERS.clear()


def coded(text: Column, path: str) -> Column:
    """struct(ids binary, text string): the ids of a text, and what they decode to.

    Null counts as the empty text, which has no ids. ``path`` must be readable on every
    executor (a vocabulary file of an installed package).
    """

    @F.pandas_udf("ids binary, text string")
    def run(texts: pd.Series) -> pd.DataFrame:
        c = coder(path)
        ids = c.encode(["" if t is None else t for t in texts])
        return pd.DataFrame({"ids": ids, "text": [c.pairs.decode(i) for i in ids]})

    return run(text)


def coded_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text of ``docs``.

    One row per input row, in one pass without a shuffle; other columns play no part. Null
    texts count as empty (0 tokens, digests of nothing); rows without an id keep a null id.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(texts: pd.Series) -> pd.DataFrame:
        c, rows = coder(path), []
        for ids in c.stream(pa.array(texts, pa.string(), from_pandas=True)):
            rows.append((
                len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                hashlib.sha256(c.pairs.decode(ids).encode()).hexdigest(),
            ))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", run("text").alias("r")).select("doc_id", "r.*")

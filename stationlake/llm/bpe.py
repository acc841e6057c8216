"""BPE encoding and decoding with a memory-mapped lexicon of frequent words.

The frequent words of the corpus are encoded once and compiled into a minimal
acyclic automaton: states with equal futures are one state, and the numbers of
words below each branch give every word its index (so ids need no place in the
states). The automaton is one block of bytes that a task maps read-only and
looks words up in. Words outside it are merged exactly, by rank and then from
the left, so the lexicon changes the speed and never a result.

NULL is an empty text; empty texts have no ids. Special tokens are found in
the raw text, before anything else. White space is dropped, as the vocabulary
has it. Every row is encoded by itself: repeated rows, any order and other
columns make no difference.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import struct
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.session import materialize

#: Words in the lexicon: the most frequent of the whole corpus.
LEXICON_WORDS = 50_000
#: Runs a task counts before it passes the counts on.
COUNT_CACHE = 300_000
#: Runs in each of the two generations that a task remembers while it encodes.
WORD_CACHE = 300_000
#: Up to so many bytes a word is merged by scanning its pairs; longer ones by a heap.
SCAN_BYTES = 48
#: Words that are looked up or merged side by side, and characters of the texts whose words are.
ROWS, PORTION_CHARS = 4096, 1 << 20


def byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte: itself if printable, else the next free character from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merge ranks, word pattern and special tokens of a tokenizer file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("a BPE file without decoder and post-processor is expected")
        self.end = model["end_of_word_suffix"] or ""
        self.ids = dict(model["vocab"])
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # The file's engine has Unicode's white space; here \s also has U+001C to U+001F.
        space = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
        self.pattern = split["pattern"]["Regex"].replace(r"[^\s", f"[^{space}")
        self.char = [c for _, c in sorted(byte_chars().items())]
        # For short words: ids of single bytes, alone and as a word's end, and the merges by id pairs.
        single = [[self.ids.get(c + e) for c in self.char] for e in ("", self.end)]
        self.single = None if None in single[0] + single[1] else single
        known = ((r, self.ids.get(a), self.ids.get(b)) for (a, b), r in self.ranks.items())
        self.pairs = {a << 32 | b: r for r, a, b in known if a is not None and b is not None}
        self.made = [self.ids.get(a + b) for a, b in self.ranks]
        if None in self.made or len(self.pairs) < len(self.ranks):
            self.single = None
        if self.single:  # the same as arrays, for many words at a time
            self.alone, self.last = (np.array(x, np.int32) for x in self.single)
            self.result = np.array(self.made, np.int32)
            at = np.fromiter(self.pairs, np.int64, len(self.pairs))
            self.pair = np.sort(at)
            self.rank = np.fromiter(self.pairs.values(), np.int32, len(at))[np.argsort(at)]

    def merge(self, word: str) -> list[int]:
        """Ids of one word: the adjacent pair of lowest rank is merged, leftmost first."""
        raw = word.encode("utf-8")
        if len(raw) <= SCAN_BYTES and self.single:
            return self._scan([*map(self.single[0].__getitem__, raw[:-1]), self.single[1][raw[-1]]])
        parts: list[str | None] = [self.char[b] for b in raw]
        parts[-1] += self.end
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [self.ids[p] for p in parts if p is not None and p in self.ids]

    def _scan(self, ids: list[int]) -> list[int]:
        """The same merges, on ids and with the ranks of all pairs in a list: the quicker way for short words."""
        get, none, made = self.pairs.get, len(self.made), self.made
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            del ranks[i], ids[i + 1]
            ids[i] = new = made[low]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | new, none)
            if i < len(ranks):
                ranks[i] = get(new << 32 | ids[i + 1], none)
        return ids

    def merge_all(self, words: list[str]) -> list[bytes]:
        """``merge`` of each word, as little-endian 32-bit integers."""
        raw = [w.encode("utf-8") for w in words]
        out: list[bytes] = [b""] * len(raw)
        short = []
        for i, r in enumerate(raw):
            if self.single and len(r) <= SCAN_BYTES:
                short.append(i)
            else:
                out[i] = np.asarray(self.merge(words[i]), "<u4").tobytes()
        short.sort(key=lambda i: len(raw[i]))  # rows of like length go together
        for at in range(0, len(short), ROWS):
            some = short[at : at + ROWS]
            for i, ids in self._merge_rows([raw[i] for i in some]):
                out[some[i]] = ids
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; the number of merges for none. -1 is no id."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair, key)
        at[at == len(self.pair)] = 0
        return np.where(self.pair[at] == key, self.rank[at], np.int32(len(self.made)))

    def _merge_rows(self, raw: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """(place, id bytes) of short words, one merge of every word at a time."""
        ids, size = _padded(raw, np.int32, -1, self.alone)
        ids[np.arange(len(raw)), size - 1] = self.last[[r[-1] for r in raw]]
        ranks, place = self._ranks(ids[:, :-1], ids[:, 1:]), np.arange(len(raw))
        while len(place):
            at = np.arange(len(place))
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(place), np.int64)
            low = ranks[at, best] if ranks.shape[1] else np.full(len(place), len(self.made))
            more = low < len(self.made)
            if not more.all():
                over = ~more
                n = size[over]
                whole = ids[over][np.arange(ids.shape[1]) < n[:, None]].astype("<u4").tobytes()
                ends = (np.cumsum(n) * 4).tolist()
                yield from zip(place[over].tolist(), map(whole.__getitem__, map(slice, [0, *ends[:-1]], ends)))
                ids, ranks, size, place, best, low = (x[more] for x in (ids, ranks, size, place, best, low))
                at = np.arange(len(place))
                if not len(place):
                    return
            # The pair becomes one id; the rest of its row moves up.
            stay = np.ones(ids.shape, bool)
            stay[at, best + 1] = False
            ids[at, best] = new = self.result[low]
            ids = ids[stay].reshape(len(at), -1)
            size = size - 1
            stay = np.ones(ranks.shape, bool)
            stay[at, best] = False
            ranks = ranks[stay].reshape(len(at), -1)
            k = np.flatnonzero(best > 0)
            ranks[k, best[k] - 1] = self._ranks(ids[k, best[k] - 1], new[k])
            k = np.flatnonzero(best < ranks.shape[1])
            ranks[k, best[k]] = self._ranks(new[k], ids[k, best[k] + 1])


def _padded(raw: list[bytes], kind: type, blank: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``values`` by byte for each word, filled up with ``blank``, and the words' lengths."""
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    rows = np.full((len(raw), size.max()), blank, kind)
    rows[np.arange(rows.shape[1]) < size[:, None]] = values[np.frombuffer(b"".join(raw), np.uint8)]
    return rows, size


SEPARATORS = regex.compile(r"[\x1c-\x1f]")


class Words:
    """Cuts a text into the words that are merged each by itself."""

    def __init__(self, vocab: Vocabulary):
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True))) or r"(?!)")
        self.find = regex.compile(vocab.pattern, regex.V0).findall

    def plain(self, text: str) -> list[str]:
        # Lower case is by character: a final capital sigma is no special case.
        text = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()
        if text.isalpha():  # letters alone are one word, and so are those before a comma or full stop
            return [text]
        if text[-1:] in (".", ",") and text[:-1].isalpha():
            return [text[:-1], text[-1]]
        return self.find(text)

    def __call__(self, text: str) -> Iterator[tuple[list[str], str | None]]:
        """(runs without white space, special token after them) through the text.
        No word goes over white space, so runs can be cut into words each by itself."""
        at = 0
        for m in self.special.finditer(text):
            yield self.runs(text[at : m.start()]), m.group()
            at = m.end()
        yield self.runs(text[at:]), None

    @staticmethod
    def runs(text: str) -> list[str]:
        # Here split() also cuts at U+001C to U+001F, which are no white space for the file's engine.
        return [text] if SEPARATORS.search(text) else text.split()


class Lexicon:
    """Minimal acyclic automaton from words (UTF-8) to their ids, as one block of bytes.

    Block: 4 counts; per state the start of its branches and whether a word
    ends there; per branch target, and the words that come before it under
    this state; per word the start of its ids; the ids; per branch its byte.
    """

    ONE = [bytes([b]) for b in range(256)]

    def __init__(self, block: mmap.mmap | bytes):
        states, branches, words, ids = struct.unpack_from("<4I", block, 0)
        at, whole = 16, memoryview(block)

        def view(n: int) -> memoryview:
            nonlocal at
            at += 4 * n
            return whole[at - 4 * n : at].cast("I")

        self.start, self.final = view(states + 1), view(states)
        self.target, self.before = view(branches), view(branches)
        self.first, self.ids = view(words + 1), view(ids)
        self.find, self.bytes = block.find, at
        self.root = states - 1
        # Branches lie by state and byte: as one number each, they are looked up for many words at a time.
        byte = np.frombuffer(block, np.uint8, branches, at)
        self.branch = np.repeat(np.arange(states, dtype=np.int64), np.diff(self.start)) << 8 | byte

    @staticmethod
    def build(entries: dict[str, list[int]]) -> bytes:
        """Sorted words go in one by one; the part of the last word that the
        next does not share is final, and is replaced by an equal known state."""
        items = sorted((w.encode("utf-8"), v) for w, v in entries.items())
        known: dict[tuple, int] = {}
        table: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        counts: list[int] = []

        def settle(final: bool, branches: list[tuple[int, int]]) -> int:
            key = (final, tuple(branches))
            if key not in known:
                known[key] = len(table)
                table.append(key)
                counts.append(final + sum(counts[t] for _, t in branches))
            return known[key]

        path: list[list] = [[False, []]]  # open states along the last word
        last = b""

        def close(keep: int) -> None:
            while len(path) > keep + 1:
                final, branches = path.pop()
                path[-1][1].append((last[len(path) - 1], settle(final, branches)))

        for word, _ in items:
            same = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
            close(same)
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        close(0)
        key = (path[0][0], tuple(path[0][1]))
        known.pop(key, None)  # the root is the last state
        table.append(key)

        start, final, byte, target, before = [0], [], [], [], []
        for ends, branches in table:
            seen = int(ends)
            for b, t in branches:
                byte.append(b)
                target.append(t)
                before.append(seen)
                seen += counts[t]
            start.append(len(byte))
            final.append(int(ends))
        first = np.cumsum([0, *(len(v) for _, v in items)])
        ids = [i for _, v in items for i in v]
        head = struct.pack("<4I", len(table), len(byte), len(items), len(ids))
        return head + b"".join(np.asarray(x, "<u4").tobytes() for x in (start, final, target, before, first, ids)) + bytes(byte)

    @classmethod
    def mapped(cls, block: bytes) -> Lexicon:
        """The block, memory-mapped from a file without a name that ends with the task."""
        with tempfile.TemporaryFile() as f:
            f.write(block)
            f.flush()
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def get(self, word: str) -> bytes | None:
        """The word's ids as little-endian 32-bit integers; None if it is not here."""
        state, index = self.root, 0
        find, one, start, target, before, at = self.find, self.ONE, self.start, self.target, self.before, self.bytes
        for b in word.encode("utf-8"):
            k = find(one[b], at + start[state], at + start[state + 1]) - at
            if k < 0:
                return None
            index += before[k]
            state = target[k]
        if not self.final[state]:
            return None
        return self.ids[self.first[index] : self.first[index + 1]].tobytes()

    def get_all(self, words: list[str]) -> list[bytes | None]:
        """``get`` of each word."""
        raw = [w.encode("utf-8") for w in words]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        out: list[bytes | None] = [None] * len(raw)
        for at in range(0, len(order) if len(self.branch) else 0, ROWS):
            some = order[at : at + ROWS]
            for i, index in self._walk([raw[i] for i in some]):
                out[some[i]] = self.ids[self.first[index] : self.first[index + 1]].tobytes()
        return out

    def _walk(self, raw: list[bytes]) -> Iterator[tuple[int, int]]:
        """(place, index) of the words that are here, one byte of every word at a time."""
        text, size = _padded(raw, np.int64, 0, np.arange(256))
        place, index = np.arange(len(raw)), np.zeros(len(raw), np.int64)
        state = np.full(len(raw), self.root, np.int64)
        final, target, before = map(np.asarray, (self.final, self.target, self.before))
        for k in range(text.shape[1] + 1):
            over = size[place] == k
            found = over & (final[state] != 0)
            yield from zip(place[found].tolist(), index[found].tolist())
            place, index, state = place[~over], index[~over], state[~over]
            if not len(place):
                return
            key = state << 8 | text[place, k]
            at = np.searchsorted(self.branch, key)
            at[at == len(self.branch)] = 0
            hit = self.branch[at] == key
            at, place = at[hit], place[hit]
            index, state = index[hit] + before[at], target[at].astype(np.int64)


class Encoder(dict):
    """Runs without white space to id bytes: remembered (the older half goes
    when the cache is full), else word by word from the lexicon, else merged."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon):
        self.vocab, self.lexicon, self.words = vocab, lexicon, Words(vocab)
        self.special = {t: struct.pack("<I", i) for t, i in vocab.special.items()}
        self.old: dict[str, bytes] = {}
        self.merged: dict[str, bytes] = {}  # words that are not in the lexicon
        self.tokens = [vocab.tokens.get(i) for i in range(max(vocab.tokens, default=-1) + 1)]

    def __missing__(self, run: str) -> bytes:
        ids = self.old.get(run)
        if ids is None:
            ids = b"".join(map(self.word, self.words.plain(run)))
        if len(self) >= WORD_CACHE:
            self.old = dict(self)
            self.clear()
        self[run] = ids
        return ids

    def word(self, word: str) -> bytes:
        ids = self.merged.get(word) or self.lexicon.get(word)
        if ids is None:
            if len(self.merged) >= WORD_CACHE:
                self.merged.clear()
            found = self.vocab.merge(word)
            ids = self.merged[word] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def learn(self, runs: Iterable[str]) -> None:
        """Remembers the ids of all these runs; the words of those that are new
        are looked up side by side, and so are those merged that the lexicon has not."""
        if len(self) >= WORD_CACHE:
            self.old = dict(self)
            self.clear()
        if len(self.merged) >= WORD_CACHE:
            self.merged.clear()
        fresh, get = [], self.old.get
        for run in [r for r in runs if r not in self]:
            if (ids := get(run)) is None:
                fresh.append(run)
            else:
                self[run] = ids
        cut = dict(zip(fresh, map(self.words.plain, fresh)))
        new = list({w for words in cut.values() for w in words if w not in self.merged})
        known = dict(zip(new, self.lexicon.get_all(new)))
        rare = [w for w, ids in known.items() if ids is None]
        merged = dict(zip(rare, self.vocab.merge_all(rare)))
        known |= merged
        self.merged |= merged
        for run, words in cut.items():
            self[run] = b"".join([known[w] if w in known else self.merged[w] for w in words])

    def pieces(self, text: str) -> list[bytes]:
        """Id bytes of each run and special token, in order."""
        return self.joined(self.words(text))

    def joined(self, cut: Iterable[tuple[list[str], str | None]]) -> list[bytes]:
        """``pieces`` of a text that is cut into runs already."""
        out: list[bytes] = []
        for runs, special in cut:
            out += map(self.__getitem__, runs)
            if special:
                out.append(self.special[special])
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(self.pieces(text))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Decoder:
    """Pieces to text. Tokens are joined by a blank and nothing else, and a list
    of them by id is read faster than texts of pieces are found again."""

    def __init__(self, coder: Encoder):
        self.whole = coder.decode

    def text(self, pieces: Iterable[bytes]) -> str:
        return self.whole(b"".join(pieces))


def load_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def word_counts(docs: DataFrame, spec: dict) -> DataFrame:
    """word, n over all texts. Tasks count first, in bounded portions; Spark adds up."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, counts = Words(Vocabulary(shared.value)), Counter()

        def portion() -> pd.DataFrame:
            found: dict[str, int] = {}  # runs that differ in case or marks only share words
            for run, n in counts.items():
                for w in words.plain(run):
                    found[w] = found.get(w, 0) + n
            counts.clear()
            return pd.DataFrame({"word": list(found), "n": list(found.values())}).astype({"word": object, "n": "int64"})

        for b in batches:
            for text in b["text"]:
                for runs, _ in words(text or ""):
                    counts.update(runs)
                if len(counts) > COUNT_CACHE:
                    yield portion()
        yield portion()

    parts = docs.select("text").mapInPandas(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """The words (of word, n) that are more frequent than a cut-off, which leaves at
    most ``size`` of them. How many words have a count says where to cut, so what
    reaches the driver is a line a count and the words themselves."""
    counts = materialize(counts, "word-counts")
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    # Far fewer counts than words; of those above the cut there are at most `size`.
    top, found = by_count.orderBy(F.desc("n")).limit(size + 1).collect(), 0
    cut = 0
    for r in top:
        found += r["words"]
        if found > size:
            cut = r["n"]
            break
    return [r["word"] for r in counts.where(F.col("n") > cut).select("word").collect()]


def build_lexicon(docs: DataFrame, spec: dict, size: int = LEXICON_WORDS) -> bytes:
    """The most frequent words of ``docs``, ``size`` at most, compiled."""
    vocab = Vocabulary(spec)
    return Lexicon.build({w: vocab.merge(w) for w in frequent_words(word_counts(docs, spec), size)})


def encode(docs: DataFrame, vocabulary: str, size: int = LEXICON_WORDS, ids: bool = True) -> DataFrame:
    """``docs`` plus ``ids`` (array<int>, left out on request), ``n_tokens``,
    ``ids_sha256`` and ``decoded_sha256``; columns of these names are replaced."""
    spec = load_vocabulary(vocabulary)
    sc = docs.sparkSession.sparkContext
    shared, block = sc.broadcast(spec), sc.broadcast(build_lexicon(docs, spec, size))
    added = {"ids": "array<int>"} if ids else {}
    added |= {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    docs = docs.drop(*added)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = Encoder(Vocabulary(shared.value), Lexicon.mapped(block.value))
        decoder = Decoder(coder)
        for part in texts:
            yield pd.DataFrame(_digests(coder, decoder, part, ids), columns=list(added))

    done = F.pandas_udf(run, ", ".join(f"{c} {t}" for c, t in added.items()))
    out = docs.select(F.struct("*").alias("d"), done("text").alias("e"))
    return out.select(
        *[F.col("d").getField(c).alias(c) for c in docs.columns], *[F.col("e").getField(c).alias(c) for c in added]
    )


def _portions(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """The texts in parts of about so many characters; a long text is one by itself."""
    some, size = [], 0
    for text in texts:
        some.append(text or "")
        size += len(some[-1])
        if size >= PORTION_CHARS:
            yield some
            some, size = [], 0
    yield some


def _digests(coder: Encoder, decoder: Decoder, texts: Iterable[str | None], ids: bool) -> list[tuple]:
    rows = []
    for part in _portions(texts):
        cut = [list(coder.words(text)) for text in part]
        coder.learn(set().union(*[runs for text in cut for runs, _ in text]))
        for text in cut:
            raw = b"".join(coder.joined(text))
            row = (len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoder.whole(raw).encode("utf-8")).hexdigest())
            rows.append((np.frombuffer(raw, "<i4"), *row) if ids else row)
    return rows

"""Alignment of the tokens of two tokenizers over the same bytes.

Each tokenizer's tokens end at cumulative byte offsets. A dictionary leads from
every end to the token that ends there; the hash-set intersection of both key
sets, sorted, cuts the two id lists into groups that cover the same bytes. Tokens
of a group whose byte ranges overlap are linked: as no inner end is common, a
group of n and m tokens has n + m - 1 links, found by stepping past whichever
token ends first.

A is a byte-level BPE of the tokenizers library, given a space and the text; B is
a sentencepiece model, which puts the space itself. Special tokens are not added,
and their strings inside a text are ordinary text.

Neither tokenizer has tokens over a space between two words, if their files say
so (``Tokenizers.by_word``). Both then end a token there, so a text is the chain
of its words, groups and links of a word are its own, and a task tokenizes and
aligns each word once while it remembers it. Otherwise, and for texts with other
runs of white space, longer pieces are aligned the same way.

NULL and empty texts, and texts whose tokens' bytes are not the space and the
text (a tokenizer that normalises), have no tokens: zeros and no groups. Every
row counts as a document, repeated rows and rows without an id too. Memory is in
proportion to one text: portions of a batch are tokenized one after the other.
Columns pass through unchanged; added ones replace those of the same names.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, count
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.session import materialize, materialize_counted

#: Code points of the texts that are tokenized at a time (one text at least).
PORTION = 1 << 20
#: Pieces in each of the two generations that a task remembers.
PIECE_CACHE = 250_000
#: Id pairs that a task counts at a time.
COUNTED_PAIRS = 4_000_000
#: Up to so many id pairs, with their counts, are sent to the tasks; more are joined by a shuffle.
MAX_BROADCAST_PAIRS = 1_000_000


def printable_bytes() -> dict[str, int]:
    """Byte-level alphabet: a printable byte stands for itself, the others for the next characters from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return {chr(b if b in plain else next(rest)): b for b in range(256)}


class Tokenizers:
    """Both tokenizers, from the contents of their files, with the bytes of their tokens."""

    def __init__(self, byte_bpe: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        alphabet = printable_bytes()
        names = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            known = all(c in alphabet for c in token)
            self.bytes_a[i] = bytes(map(alphabet.__getitem__, token)) if known else token.encode("utf-8")
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = [[*map(len, x)] for x in (self.bytes_a, self.bytes_b)]
        self.by_word = _splits_words(byte_bpe) and _joins_no_words(pieces, self.b)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def same(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether the bytes of both id lists are the text's."""
        raw = text.encode("utf-8")
        return all(b"".join(map(of.__getitem__, ids)) == raw for of, ids in ((self.bytes_a, a), (self.bytes_b, b)))

    def encode(self, spaced: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Both id lists of every text, each with its space; None where the bytes differ from the text's."""
        found = self.a.encode_batch_fast(spaced, add_special_tokens=False)
        for whole, first, b in zip(spaced, found, self.b.encode([s[1:] for s in spaced], num_threads=1)):
            yield (first.ids, b) if self.same(whole, first.ids, b) else None

    def encode_words(self, words: list[str]) -> tuple[list[int], list[int]] | None:
        """The same for a text of such words; one call for all is faster with A, a call per word with B."""
        whole = "".join(words)
        a = self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        b = list(chain.from_iterable(self.b.encode([w[1:] for w in words], num_threads=1)))
        return (a, b) if self.same(whole, a, b) else None


def _splits_words(byte_bpe: str) -> bool:
    """Whether the byte-level BPE cuts texts into words by the usual pattern, which begins a word at its space."""
    spec = json.loads(byte_bpe)
    cut = spec.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    return bool(plain and not spec.get("normalizer") and all(t.get("special") for t in spec.get("added_tokens") or []))


def _joins_no_words(model: bytes, pieces) -> bool:
    """Whether the sentencepiece model keeps texts as they are and has no piece that goes on after a space."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # no protobuf: whole texts are right, if slower
        return False
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    rules, kind = spec.normalizer_spec, spec.trainer_spec.model_type
    as_is = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.add_dummy_prefix
    inner = any("▁" in pieces.id_to_piece(i).lstrip("▁") for i in range(pieces.get_piece_size()))
    return bool(as_is and kind == spec.trainer_spec.BPE and not inner)


# A space beside other white space, and the places before a space between two words.
_RUN = re.compile(r" \s|\s |\s\Z")
_WORD_START = re.compile(r"(?<=\S)(?= \S)")


class Piece(NamedTuple):
    """Part of a text, aligned by itself."""

    tokens: int  # A's in the high half, B's in the low one (32 bits)
    groups: str  # a1,a2|b1;a3|b2,b3
    links: bytes  # 64-bit numbers, A's id in the high half and B's in the low one


def slices(ends_a: Iterable[int], ends_b: Iterable[int]) -> Iterator[tuple[int, int, int]]:
    """Groups as (end, tokens of A up to it, tokens of B up to it), from the cumulative ends of both."""
    at_a, at_b = dict(zip(ends_a, count(1))), dict(zip(ends_b, count(1)))
    for end in sorted(at_a.keys() & at_b.keys()):
        yield end, at_a[end], at_b[end]


def align(a: list[int], b: list[int], size_a: list[int], size_b: list[int], stops: Iterable[int] = ()) -> list[Piece]:
    """The tokens aligned: one piece, or one up to each of ``stops`` (byte offsets where tokens of both end)."""
    ends_a, ends_b = (list(accumulate(map(size.__getitem__, ids))) for size, ids in ((size_a, a), (size_b, b)))
    border = iter(stops or ends_a[-1:])
    stop, out, groups, links = next(border, None), [], [], []
    name_a, name_b = list(map(str, a)), list(map(str, b))
    i = j = from_i = from_j = 0
    for end, stop_i, stop_j in slices(ends_a, ends_b):
        if stop_i - i == 1:
            high = a[i] << 32
            if stop_j - j == 1:
                groups.append(f"{name_a[i]}|{name_b[j]}")
                links.append(high | b[j])
            else:
                groups.append(f"{name_a[i]}|{','.join(name_b[j:stop_j])}")
                links += [high | y for y in b[j:stop_j]]
        else:
            groups.append(f"{','.join(name_a[i:stop_i])}|{','.join(name_b[j:stop_j])}")
            while i < stop_i:
                links.append(a[i] << 32 | b[j])
                ahead = ends_a[i] - ends_b[j]
                i += ahead <= 0
                j += ahead >= 0
        i, j = stop_i, stop_j
        if end == stop:
            out.append(Piece(i - from_i << 32 | j - from_j, ";".join(groups), array("q", links).tobytes()))
            stop, groups, links, from_i, from_j = next(border, None), [], [], i, j
    if stop is not None:
        raise RuntimeError("a token reaches over the border of a piece")
    return out


class Aligner:
    """Aligns texts piece by piece and remembers the pieces."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.known: dict[str, Piece | None] = {}
        self.old: dict[str, Piece | None] = {}

    def cut(self, text: str) -> list[str]:
        """The pieces of a text and the space before it: parts that both tokenizers handle by themselves."""
        spaced = " " + text
        if not text:
            return []
        if not self.both.by_word or "▁" in text:
            return [spaced]
        return _WORD_START.split(spaced) if _RUN.search(spaced) else [" " + w for w in text.split(" ")]

    def align(self, texts: list[str]) -> Iterator[list[Piece]]:
        """The pieces of every text; none where a tokenizer's bytes are not the text's."""
        cuts = [self.cut(t) for t in texts]
        need = set().union(*cuts).difference(self.known)
        self.known.update((p, self.old[p]) for p in need & self.old.keys())
        self.learn(list(need.difference(self.old)))
        for pieces in cuts:
            found = list(map(self.known.__getitem__, pieces))
            yield [] if None in found else found
        if len(self.known) > PIECE_CACHE:
            self.old, self.known = self.known, {}

    def learn(self, pieces: list[str]) -> None:
        """Align new pieces. Words without white space but their own space are chained to one text."""
        chained = [p for p in pieces if self.both.by_word and not _RUN.search(p) and "▁" not in p]
        ids = self.both.encode_words(chained) if chained else None
        if ids:
            stops = accumulate(len(p.encode("utf-8")) for p in chained)
            self.known.update(zip(chained, align(*ids, self.both.size_a, self.both.size_b, stops)))
            pieces = list(set(pieces).difference(chained))
        for piece, ids in zip(pieces, self.both.encode(pieces) if pieces else ()):
            self.known[piece] = align(*ids, self.both.size_a, self.both.size_b)[0] if ids else None


def pack(links: bytes) -> bytes:
    """The distinct id pairs with their numbers of occurrences, sorted and deflated."""
    pairs, times = np.unique(np.frombuffer(links, np.int64), return_counts=True)
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    cols = np.stack([np.diff(a, prepend=0), b, times]).astype("<u4")
    # Equal bytes of neighbouring numbers stand together.
    return zlib.compress(cols.view(np.uint8).reshape(3, -1, 4).transpose(0, 2, 1).tobytes(), 1)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs (A's id in the high half) and their numbers of occurrences."""
    raw = np.frombuffer(zlib.decompress(block), np.uint8).reshape(3, 4, -1).transpose(0, 2, 1)
    a, b, times = np.ascontiguousarray(raw).view("<u4")[:, :, 0].astype(np.int64)
    return (np.cumsum(a) << 32) | b, times


def _portions(texts: Iterable[str | None]) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= PORTION:
            yield part
            part, size = [], 0
    if part:
        yield part


_ADDED = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups": "string", "groups_sha256": "string", "links": "binary"}


def _aligned(docs: DataFrame, byte_bpe: str, pieces: str, groups: bool, text: str) -> DataFrame:
    """``doc`` (struct of the columns of ``docs`` but ``text``) beside the added columns."""
    with open(byte_bpe, encoding="utf-8") as f, open(pieces, "rb") as g:
        shared = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    added = {k: t for k, t in _ADDED.items() if groups or k != "groups"}

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(Tokenizers(*shared.value))
        gc.disable()  # nothing here is cyclic; the collector would walk the remembered pieces over and over
        for batch in batches:
            rows = []
            for part in _portions(batch):
                for pieces in aligner.align(part):
                    tokens, groups_, links_ = zip(*pieces) if pieces else ((), (), ())
                    total, line, links = sum(tokens), ";".join(groups_), b"".join(links_)
                    digest = hashlib.sha256(line.encode()).hexdigest() if line else ""
                    row = {"n_a": total >> 32, "n_b": total & 0xFFFFFFFF, "n_groups": line.count(";") + bool(line)}
                    row |= {"n_links": len(links) // 8, "groups": line, "groups_sha256": digest, "links": pack(links)}
                    rows.append([row[k] for k in added])
            yield pd.DataFrame(rows, columns=list(added))
        gc.enable()

    done = F.pandas_udf(run, ", ".join(f"{k} {t}" for k, t in added.items()))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    out = docs.select(F.struct(*rest or [F.lit(1)]).alias("doc"), done(F.col(f"`{text}`")).alias("e"))
    return out.select("doc", *[F.col("e").getField(c).alias(c) for c in added])


def _flat(aligned: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    added = [c for c in aligned.columns if c != "doc"]
    keep = [c for c in docs.columns if c not in (text, *added)]
    return aligned.select(*[F.col("doc").getField(c).alias(c) for c in keep], *added)


def alignments(docs: DataFrame, byte_bpe: str, pieces: str, groups: bool = True, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, plus ``n_a, n_b, n_groups, n_links``, ``groups``
    (``a1,a2|b1;a3|b2,b3``, left out on request), ``groups_sha256`` and ``links``
    (see ``pack``). ``byte_bpe`` and ``pieces`` are paths on the driver."""
    return _flat(_aligned(docs, byte_bpe, pieces, groups, text), docs, text)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: how many documents hold an id pair linked, and whether
    no other pair of its A id is in more. Tasks count first, in bounded portions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def portion() -> pd.DataFrame:
            pairs, n = np.unique(np.concatenate([*held, np.empty(0, np.int64)]), return_counts=True)
            held.clear()
            return pd.DataFrame({"pair": pairs, "n": n})

        for batch in batches:
            for block in batch["links"]:
                held.append(unpack(block)[0])
                size += len(held[-1])
                if size >= COUNTED_PAIRS:
                    yield portion()
                    size = 0
        yield portion()

    counts = aligned.select("links").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pair-documents")
    a = F.shiftright("pair", 32).alias("a")
    top = counts.groupBy(a).agg(F.max("n").alias("top"))
    return counts.select("pair", "n", a).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _score_broadcast(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    table = counts.orderBy("pair").toArrow()
    shared = aligned.sparkSession.sparkContext.broadcast(
        tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
    )

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pairs, n, best = shared.value
        for batch in batches:
            rows = []
            for block in batch:
                found, times = unpack(block)
                at = np.searchsorted(pairs, found)
                rows.append((int(times[best[at]].sum()), int((times * n[at]).sum())))
            yield pd.DataFrame(rows, columns=["n_best", "count_sum"])

    scored = F.pandas_udf(run, "n_best long, count_sum long")
    out = aligned.withColumn("_s", scored(F.col("links")))
    return out.select("*", "_s.n_best", "_s.count_sum").drop("_s")


def _score_joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, block in zip(batch["_row"], batch["links"]):
                found, times = unpack(block)
                yield pd.DataFrame({"_row": row, "pair": found, "times": times})

    rows = materialize(aligned.withColumn("_row", F.monotonically_increasing_id()), "aligned-rows")
    held = rows.select("_row", "links").mapInPandas(run, "_row long, pair long, times long")
    # An A id is linked in nearly every document: adaptive execution splits such pairs.
    sums = held.join(counts, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    none = F.lit(0).cast("long")
    out = rows.join(sums, "_row", "left").drop("_row")
    return out.withColumns({c: F.coalesce(F.col(c), none) for c in ("n_best", "count_sum")})


def align_documents(docs: DataFrame, byte_bpe: str, pieces: str, groups: bool = True, text: str = "text") -> DataFrame:
    """``alignments`` plus ``n_best`` (links whose pair is in most documents among
    its A id's, ties included) and ``count_sum`` (documents of a link's pair,
    summed over links). The alignment is written once and read for both steps."""
    aligned = materialize(_aligned(docs, byte_bpe, pieces, groups, text), "alignments")
    counts, seen = materialize_counted(pair_counts(aligned), "pair-counts")
    scored = _score_broadcast if seen["rows"] <= MAX_BROADCAST_PAIRS else _score_joined
    return _flat(scored(aligned, counts).drop("links"), docs, text)

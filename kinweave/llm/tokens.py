"""Tokenizer files applied to whole columns of text: encoding and decoding in numpy, and counting."""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from kinweave.llm.common import over_texts

#: Pieces of text before the merges, as byte-level BPE files of this kind cut them (fixed value).
BYTE_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters outside these ranges may be classed otherwise by another version of Unicode: texts that
#: hold any are cut by the tokenizers library's own code.
BYTE_OTHERS = re.compile(r"[^\x00-\u0557\u2010-\u2026]")
WORD_OTHERS = re.compile(r"[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u02ff\u2010-\u2026]")
#: Pieces whose ids a worker remembers, their bytes, and characters that it works on at once.
REMEMBERED, REMEMBERED_BYTES, CHARS = 400_000, 32 << 20, 4_000_000
#: Bytes of a piece that is not worth remembering when room is short.
LONG_PIECE = 64


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges start..start+length, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Pieces:
    """Ids of the pieces seen so far, in flat arrays; when it holds too many, the rarer half goes."""

    def __init__(self, encode):
        self.encode = encode
        self.pieces = pa.array([], pa.large_string())
        self.flat, self.lengths, self.seen = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _forget(self) -> None:
        kept = np.sort(np.argsort(-self.seen, kind="stable")[: len(self.seen) // 2])
        kept = kept[pc.less_equal(pc.binary_length(self.pieces.take(kept)), LONG_PIECE).to_numpy(zero_copy_only=False)]
        starts = np.cumsum(self.lengths) - self.lengths
        self.flat = self.flat[_gather(starts[kept], self.lengths[kept])]
        self.pieces, self.lengths, self.seen = self.pieces.take(kept), self.lengths[kept], self.seen[kept] // 2

    def ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after another, and the number of each piece's ids."""
        if len(self.pieces) > REMEMBERED or self.pieces.nbytes > REMEMBERED_BYTES:
            self._forget()
        coded = pieces.dictionary_encode()
        own = coded.dictionary
        place = pc.index_in(own, value_set=self.pieces)
        fresh = place.is_null().to_numpy(zero_copy_only=False)
        at = place.fill_null(0).to_numpy().astype(np.int64)
        if fresh.any():
            new = own.filter(pa.array(fresh))
            flat, lengths = self.encode(new.to_pylist())
            at[fresh] = len(self.pieces) + np.arange(len(new))
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.flat, self.lengths = np.concatenate([self.flat, flat]), np.concatenate([self.lengths, lengths])
            self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)])
        order = at[coded.indices.to_numpy()]
        self.seen += np.bincount(order, minlength=len(self.seen))
        lengths = self.lengths[order]
        starts = np.cumsum(self.lengths) - self.lengths
        return self.flat[_gather(starts[order], lengths)], lengths


class ByteBpe:
    """A byte-level BPE file: merges in numpy rounds, and decoding by a table of bytes."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.slow = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.pieces = regex.compile(BYTE_PIECES)
        shown = _byte_characters()
        byte_of = {c: b for b, c in enumerate(shown)}
        self.id_of_byte = np.array([vocab[c] for c in shown], np.int64)
        size = max([*vocab.values(), *self.special.values()]) + 1
        held = [b""] * size
        for token, i in vocab.items():
            held[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            held[i] = token.encode()
        lengths = np.array([len(b) for b in held], np.int64)
        self.bytes, self.byte_lengths = np.frombuffer(b"".join(held), np.uint8), lengths
        self.byte_starts = np.cumsum(lengths) - lengths
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.known = Pieces(self.merge)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words at once.

        All symbols lie in one flat array. In each round, the ranks of all neighbouring pairs are found
        by binary search over the sorted keys of the merges; in each word, the pairs of its lowest
        rank are merged, from the left; words without a pair to merge leave the rounds.
        """
        raw = [w.encode() for w in words]
        sizes = np.array([len(b) for b in raw], np.int64)
        symbols = self.id_of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        none = len(self.keys)
        while len(symbols):
            rank = np.full(len(symbols), none, np.int64)
            at = np.zeros(len(symbols), np.int64)
            same = np.flatnonzero(word[1:] == word[:-1])
            keys = (symbols[same] << 32) | symbols[same + 1]
            where = np.minimum(np.searchsorted(self.keys, keys), none - 1)
            hit = self.keys[where] == keys
            rank[same[hit]], at[same[hit]] = self.ranks[where[hit]], where[hit]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            count = np.diff(np.r_[first, len(symbols)])
            alive = np.repeat(lowest < none, count)
            if not alive.all():
                done_symbols.append(symbols[~alive])
                done_words.append(word[~alive])
                symbols, word, rank, at = symbols[alive], word[alive], rank[alive], at[alive]
                if not len(symbols):
                    break
                keep = lowest < none
                lowest, count = lowest[keep], count[keep]
            chosen = np.flatnonzero(rank == np.repeat(lowest, count))
            # of pairs that overlap (equal symbols in a row), every other one, from the left
            run = np.r_[True, chosen[1:] != chosen[:-1] + 1]
            start = np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
            chosen = chosen[(np.arange(len(chosen)) - start) % 2 == 0]
            symbols[chosen] = self.made[at[chosen]]
            left = np.ones(len(symbols), bool)
            left[chosen + 1] = False
            symbols, word = symbols[left], word[left]
        symbols = np.concatenate([*done_symbols, np.empty(0, np.int64)])
        word = np.concatenate([*done_words, np.empty(0, np.int64)])
        order = np.argsort(word, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(word, minlength=len(words))

    def _cut(self, text: str) -> list[str]:
        if BYTE_OTHERS.search(text):
            return [text[a:b] for _, (a, b) in self.slow.pre_tokenize_str(text)]
        return self.pieces.findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the number of each text's ids."""
        special, pieces, owner_counts, marks = self.special, [], [], []
        for text in texts:
            before = len(pieces)
            if self.cut_special is not None and self.cut_special.search(text):
                for part in self.cut_special.split(text):
                    if part in special:
                        marks.append((len(pieces), special[part]))
                        pieces.append("")
                    elif part:
                        pieces += self._cut(part)
            else:
                pieces += self._cut(text)
            owner_counts.append(len(pieces) - before)
        ids, lengths = self.known.ids(pa.array(pieces, pa.large_string()))
        if marks:
            at = np.array([m[0] for m in marks])
            ids = np.insert(ids, (np.cumsum(lengths) - lengths)[at], [m[1] for m in marks])
            lengths = lengths.copy()
            lengths[at] = 1
        owner = np.repeat(np.arange(len(texts)), owner_counts)
        return ids, np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes[_gather(self.byte_starts[ids], self.byte_lengths[ids])].tobytes()


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level files.

    Printable bytes stand for themselves; the others, in order, for the characters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, other = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(other))
            other += 1
    return out


def portions(texts: list[str]) -> Iterator[slice]:
    """Cut a batch so that one portion has about CHARS characters, or one text."""
    lo, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHARS:
            yield slice(lo, i)
            lo, held = i, 0
        held += len(text)
    if lo < len(texts):
        yield slice(lo, len(texts))


@lru_cache(maxsize=1)
def byte_bpe(path: str) -> ByteBpe:
    """One for all tasks of a worker, with the pieces it has seen."""
    return ByteBpe(path)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode each whole text by a byte-level BPE file and decode it again.

    Result: doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers), decoded_sha256
    (of the decoded text in UTF-8). A null or empty text has no ids. Repeated rows stay; an empty
    table gives no rows; other columns are not read. A worker loads the file once and
    remembers the ids of REMEMBERED pieces at most.
    """
    path = path or default_path("byte_bpe_50k.json")

    def coded() -> Callable[[list[str]], list]:
        bpe = byte_bpe(path)

        def of(texts: list[str]) -> list:
            counts, hashes, back = [], [], []
            for at in portions(texts):
                ids, sizes = bpe.encode(texts[at])
                ends = np.cumsum(sizes)
                for lo, hi in zip(ends - sizes, ends, strict=True):
                    own = ids[lo:hi]
                    hashes.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    back.append(hashlib.sha256(bpe.decode(own).decode("utf-8", "replace").encode()).hexdigest())
                counts += sizes.tolist()
            return [counts, hashes, back]

        return of

    return over_texts(docs, coded, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _lowered(text: str) -> str:
    """Lower case; of the characters that WORD_OTHERS leaves, the white space that is not ASCII as blanks."""
    lowered = text.lower()
    return lowered if text.isascii() else lowered.replace("\x85", " ").replace("\xa0", " ")


class WordBpe:
    """A BPE file with word ends.

    No token spans white space, so texts are cut there, and the library encodes each new word once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.others = re.compile("|".join([WORD_OTHERS.pattern, *map(re.escape, special)]))
        self.signs = [*special, *"\x1c\x1d\x1e\x1f"]
        self.known = Pieces(self._new)

    def _new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.int32, int(lengths.sum())), lengths

    def _plain(self, text: str) -> bool:
        return not (any(c in text for c in self.signs) if text.isascii() else self.others.search(text))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self._plain(t) for t in texts]
        lowered = pa.array([_lowered(t) for t, easy in zip(texts, plain, strict=True) if easy], pa.large_string())
        words = pc.ascii_split_whitespace(lowered)
        ids, lengths = self.known.ids(words.flatten())
        ends = np.concatenate([[0], np.cumsum(lengths)])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        easy_ids = (ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
        return [
            next(easy_ids) if easy else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
            for text, easy in zip(texts, plain, strict=True)
        ]


@lru_cache(maxsize=1)
def word_bpe(path: str) -> WordBpe:
    """One for all tasks of a worker, with the words it has seen."""
    return WordBpe(path)


def cut_pieces(docs: DataFrame, path: str | None = None, most: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenize whole texts, append ``end_id`` and cut the ids into pieces of ``most`` at most.

    Result: doc_id, piece, start, length, ids_crc32. A null or empty text has the end id alone.
    """
    path = path or default_path("word_bpe_49k.json")

    def cut() -> Callable[[list[str]], list]:
        bpe = word_bpe(path)
        end = np.array([end_id], np.int32)

        def of(texts: list[str]) -> list:
            rows: list[tuple[int, ...]] = []
            for at in portions(texts):
                for row, ids in enumerate(bpe.encode(texts[at]), at.start):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for k, lo in enumerate(range(0, len(ids), most)):
                        own = ids[lo : lo + most]
                        rows.append((k, lo, len(own), zlib.crc32(own.tobytes()), row))
            return list(map(list, zip(*rows, strict=True))) or [[]] * 5

        return of

    return over_texts(docs, cut, "piece int, start long, length long, ids_crc32 long")

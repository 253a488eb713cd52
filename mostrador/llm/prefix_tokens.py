"""Exact token counts of every prefix of a text, by dynamic programming.

For a piece of text the state after byte i is the last token of the encoding of its
first i bytes. A token t that ends at i is that last token exactly when the last
token of the prefix before t, followed by t, is left unmerged by the encoder; there
is one such t. The count is then one more than the count of the prefix before t.
Counts of a whole text follow from its pieces: a table holds the change of the count
at each character, one byte each, so cutting a text at any character, or finding how
much of it fits a budget, needs no encoding.

Counts of prefixes are not monotone: one more character can join two tokens.

Edge cases: a null text has an empty table and no tokens. Special strings inside a
text are one token each, as the library's default has it; a prefix that ends inside
one is ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm.bpe import MergeTable, byte_letters
from mostrador.llm.memo import Memo

# The byte-level pre-tokenizer's pattern.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A run of white space whose last character goes to what follows, or stands alone.
_RUN = regex.compile(r"\s{2,}(?=\S)")
_TWO = re.compile(r"\s\s")  # a quick look whether there can be one
# White space and what follows a single space, split without looking at letters; no piece spans two of these.
_CHUNK = re.compile(" ?[^{0}]+|[{0}]+(?![^{0}])|[{0}]+".format("\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_PAIR_BITS = 21
_TOGETHER = 2_000  # texts whose unknown words are counted at once
_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    def __init__(self, path: str) -> None:
        self.table = MergeTable(path)
        code = {letter: b for b, letter in enumerate(byte_letters())}
        self._bytes = {n: bytes(code[x] for x in t) for t, n in self.table.vocab.items()}
        self._token = {spelled: n for n, spelled in self._bytes.items()}
        self._longest = max(map(len, self._token))
        self._special = regex.compile("|".join(map(regex.escape, self.table.specials)))
        spelled = sorted(self._token)
        self._powers = np.full(self._longest + 1, _BASE, np.uint64)
        self._powers[0] = 1
        self._powers = np.cumprod(self._powers, dtype=np.uint64)
        hashes = np.array([self._hash_of(x) for x in spelled], np.uint64)
        order = np.argsort(hashes)
        self._hash = hashes[order]
        if (self._hash[1:] == self._hash[:-1]).any():
            raise ValueError("two tokens have one hash: choose another base")
        self._id = np.array([self._token[x] for x in spelled], np.int64)[order]
        self._size = np.array([len(x) for x in spelled], np.int64)[order]
        self._seen = np.zeros(1 << 20, bool)
        self._seen[self._hash >> np.uint64(44)] = True
        # Tokens that the encoder makes of their own bytes; others never come up.
        self._whole = np.zeros(self.table.width, bool)
        for token, ids in zip(self._token.values(), self.table.merge_all(list(self._token))):
            self._whole[token] = ids == np.array([token], "<i4").tobytes()
        self._pair = np.full(1 << _PAIR_BITS, -1, np.int64)
        self._pair_stays = np.zeros(1 << _PAIR_BITS, bool)
        self._changes = Memo(self._all_changes)

    @staticmethod
    def _hash_of(spelled: bytes) -> int:
        value = 0
        for b in spelled:
            value = (value * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def _stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each ``left`` (-1: nothing) followed by ``right`` is what the encoder makes of their bytes."""
        pair = (left + 1) * self.table.width + right
        slot = (pair.astype(np.uint64) * _ODD) >> np.uint64(64 - _PAIR_BITS)
        out = self._pair_stays[slot]
        missing = np.flatnonzero(self._pair[slot] != pair)
        if len(missing):
            new, back = np.unique(pair[missing], return_inverse=True)
            lefts, rights = new // self.table.width - 1, new % self.table.width
            known = self._whole[rights] & ((lefts < 0) | self._whole[lefts])
            two = np.flatnonzero(known & (lefts >= 0))
            known[two] = self.table.stay_apart(lefts[two], rights[two])
            out[missing] = known[back]
            # One entry per slot, the latest: memory is fixed, and a lost entry is computed again.
            self._pair[slot[missing]], self._pair_stays[slot[missing]] = pair[missing], known[back]
        return out

    def _counts_in_step(self, pieces: list[bytes], n: int) -> np.ndarray:
        """Token counts of all prefixes of pieces of one length, a row for each piece."""
        raw = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, n)
        rows = len(pieces)
        hashes = np.zeros((rows, n + 1), np.uint64)
        for i in range(n):
            hashes[:, i + 1] = hashes[:, i] * _BASE + (raw[:, i] + np.uint64(1))
        counts = np.zeros((rows, n + 1), np.int32)
        last = np.full((rows, n + 1), -1, np.int64)
        for end in range(1, n + 1):
            low = max(0, end - self._longest)
            sizes = end - np.arange(low, end)
            own = hashes[:, end, None] - hashes[:, low:end] * self._powers[sizes]
            candidate = np.full(own.shape, -1, np.int64)
            row, column = np.nonzero(self._seen[own >> np.uint64(44)])
            wanted = own[row, column]
            at = np.minimum(np.searchsorted(self._hash, wanted), len(self._hash) - 1)
            same = (self._hash[at] == wanted) & (self._size[at] == sizes[column])
            candidate[row[same], column[same]] = self._id[at[same]]
            open_, waiting = candidate >= 0, np.arange(rows)
            while len(waiting):
                first = open_[waiting].argmax(1)  # the longest candidate left
                token = candidate[waiting, first]
                fits = self._stay(last[waiting, low + first], token)
                done = waiting[fits]
                counts[done, end] = counts[done, low + first[fits]] + 1
                last[done, end] = token[fits]
                waiting, first = waiting[~fits], first[~fits]
                open_[waiting, first] = False
        return counts

    def byte_counts(self, piece: bytes) -> list[int]:
        """Token counts of the prefixes of 0, 1, ... bytes of one piece."""
        return self._counts_in_step([piece], len(piece))[0].tolist() if piece else [0]

    def _all_changes(self, chunks: list[str]) -> Iterator[bytes]:
        """The changes of each chunk, from those of its pieces; pieces of one length are counted in step."""
        parts = [_PIECE.findall(c) for c in chunks]
        by_length: dict[int, list[tuple[bytes, str]]] = {}
        for piece in set().union(*parts):
            raw = piece.encode()
            by_length.setdefault(len(raw), []).append((raw, piece))
        known: dict[str, bytes] = {}
        for n, members in by_length.items():
            together = max(1, min(4096, 200_000 // n))
            for at in range(0, len(members), together):
                some = members[at : at + together]
                counts = self._counts_in_step([raw for raw, _ in some], n)
                changes = np.diff(counts, axis=1).astype(np.int8)
                for k, (raw, piece) in enumerate(some):
                    if len(piece) == n and piece not in _LONG_CONTRACTIONS:
                        known[piece] = changes[k].tobytes()
                    else:
                        known[piece] = self._at_characters(piece, raw, counts[k].tolist())
        return (b"".join(map(known.__getitem__, p)) for p in parts)

    @staticmethod
    def _at_characters(piece: str, raw: bytes, counts: list[int]) -> bytes:
        if len(raw) != len(piece):
            # A character ends before each byte that does not continue one, and at the end.
            counts = [0, *(counts[i] for i in range(1, len(raw)) if raw[i] & 0xC0 != 0x80), counts[len(raw)]]
        if piece in _LONG_CONTRACTIONS:
            counts = [*counts[:2], 2, counts[3]]  # the quote and one letter are no contraction yet
        return bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])

    def _with_runs(self, text: str, changes: bytes) -> bytes:
        fixed = None
        if not _TWO.search(text):
            return changes
        for run in _RUN.finditer(text):
            # Ending at the run's last character, a prefix takes the whole run as one piece.
            if fixed is None:
                fixed = np.frombuffer(changes, np.int8).copy()
                counts = np.concatenate([[0], np.cumsum(fixed, dtype=np.int32)])
            start, end = run.span()
            shift = int(counts[start] + self.byte_counts(run[0].encode())[-1] - counts[end])
            fixed[end - 1] += shift
            fixed[end] -= shift
        return changes if fixed is None else fixed.tobytes()

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self._changes.joined([_CHUNK.findall(t) for t in texts])
        return [self._with_runs(t, c) for t, c in zip(texts, found)]

    def _with_specials(self, text: str) -> bytes:
        out, start = [], 0
        for found in self._special.finditer(text):
            # Up to the special string's last character but one it is ordinary text.
            (part,) = self._plain([text[start : found.end() - 1]])
            held = np.frombuffer(part, np.int8)
            before = held[: found.start() - start].sum(dtype=np.int64)
            out += [part, np.array([before + 1 - held.sum(dtype=np.int64)], np.int8).tobytes()]
            start = found.end()
        return b"".join([*out, *self._plain([text[start:]])])

    def changes_many(self, texts: list[str]) -> list[bytes]:
        """The change of the token count at each character of each text, as signed bytes."""
        out = []
        for at in range(0, len(texts), _TOGETHER):
            some = texts[at : at + _TOGETHER]
            special = ["<|" in t and bool(self._special.search(t)) for t in some]
            plain = iter(self._plain([t for t, s in zip(some, special) if not s]))
            out += [self._with_specials(t) if s else next(plain) for t, s in zip(some, special)]
        return out


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_table(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, changes`` of every whole text.

    ``changes`` holds one signed byte per character; its running sum is the token
    count of every prefix, and ``n_tokens`` is its last value. Rows with equal or
    null ids are kept as they are.
    """

    @F.arrow_udf("struct<changes: binary, n_tokens: bigint>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = prefix_counter(vocabulary)
        for batch in batches:
            tables = counter.changes_many(batch.to_pylist())
            last = [int(np.frombuffer(t, np.int8).sum(dtype=np.int64)) for t in tables]
            yield pa.StructArray.from_arrays(
                [pa.array(tables, pa.binary()), pa.array(last, pa.int64())], ["changes", "n_tokens"]
            )

    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return named.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), counted("text").alias("t")).select(
        "doc_id", "n_bytes", F.col("t.n_tokens").alias("n_tokens"), F.col("t.changes").alias("changes")
    )


def tokens_before(changes: Column, n_chars: Column) -> Column:
    """The token count of the first ``n_chars`` characters, from a prefix table."""

    @F.arrow_udf("bigint")
    def counted(tables: pa.Array, lengths: pa.Array) -> pa.Array:
        out = []
        for table, n in zip(tables.to_pylist(), lengths.to_pylist()):
            held = np.frombuffer(table or b"", np.int8)
            out.append(None if n is None else int(held[: max(0, n)].sum(dtype=np.int64)))
        return pa.array(out, pa.int64())

    return counted(changes, n_chars.cast("bigint"))


def chars_within(changes: Column, budget: Column) -> Column:
    """The most characters a prefix may have with at most ``budget`` tokens, from a prefix table."""

    @F.arrow_udf("bigint")
    def fitted(tables: pa.Array, budgets: pa.Array) -> pa.Array:
        out = []
        for table, most in zip(tables.to_pylist(), budgets.to_pylist()):
            counts = np.cumsum(np.frombuffer(table or b"", np.int8), dtype=np.int64)
            out.append(None if most is None else int(np.flatnonzero(np.r_[0, counts] <= max(0, most))[-1]))
        return pa.array(out, pa.int64())

    return fitted(changes, budget.cast("bigint"))

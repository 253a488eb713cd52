"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of the tree hold, for every pair of neighbouring symbols, its merge rank
and its place; inner nodes hold the least of their two children. The root is then
the leftmost pair of lowest rank. A merge changes three leaves, each a logarithmic
update, until no pair can be merged; a piece of n symbols costs O(n log n), so one
very long run of letters is no danger.

Edge cases: a null text encodes as no ids, and null ids decode as the empty text;
ids outside the vocabulary are skipped by decoding, as the public library does.
"""

from __future__ import annotations

import json
import string
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm.memo import Memo

_NONE = 1 << 62
_TOGETHER = 500  # texts whose unknown words are encoded at once
_CHARACTERS = 4_000_000  # or as few as have so many characters
_SLICE = 500  # texts handed back at once
# The pattern of the word vocabulary's pre-tokenizer; white space is dropped.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_CHUNK = regex.compile(r"[^\s]+")
# Characters at which str.split() splits although they are no white space in Unicode.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The printable stand-in for each byte: itself where it is printable, else the next free code from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class MergeTable:
    """Vocabulary and ranked merges of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model = parsed["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        suffix = model.get("end_of_word_suffix") or ""
        self.tokens: list[str | None] = [None] * (1 + max([*self.vocab.values(), *self.specials.values()]))
        for text, number in [*self.vocab.items(), *self.specials.items()]:
            self.tokens[number] = text
        letters = byte_letters()
        self.inner = [self.vocab[x] for x in letters]
        self.last = [self.vocab[x + suffix] for x in letters]
        self.width = len(self.tokens)
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for left, right in model["merges"]:
            self.rank.setdefault(self.vocab[left] * self.width + self.vocab[right], len(self.merged))
            joined = left.removesuffix(suffix) + right if suffix else left + right
            self.merged.append(self.vocab[joined])
        pairs = np.fromiter(self.rank, np.int64, len(self.rank))
        numbers = np.fromiter(self.rank.values(), np.int64, len(self.rank))
        order = np.argsort(pairs)
        self._pairs, self._numbers = pairs[order], numbers[order]
        self._merged = np.array(self.merged, np.int64)
        self._inner, self._last = np.array(self.inner, np.int64), np.array(self.last, np.int64)
        # The merge that makes each token (-1: none) and what it joins.
        self.made_by = np.full(self.width, -1, np.int64)
        self.left, self.right = np.full(self.width, -1, np.int64), np.full(self.width, -1, np.int64)
        in_order = np.empty(len(pairs), np.int64)
        in_order[numbers] = pairs
        self.made_by[self._merged] = np.arange(len(in_order))
        self.left[self._merged], self.right[self._merged] = in_order // self.width, in_order % self.width

    def symbols(self, piece: bytes) -> list[int]:
        inner = self.inner
        out = [inner[b] for b in piece]
        if out:
            out[-1] = self.last[piece[-1]]
        return out

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, lowest rank first and leftmost among equals."""
        n = len(symbols)
        if n < 2:
            return symbols
        rank, width, merged = self.rank, self.width, self.merged
        size = 1
        while size < n - 1:
            size *= 2
        tree = [_NONE] * (2 * size)
        for i in range(n - 1):
            found = rank.get(symbols[i] * width + symbols[i + 1])
            if found is not None:
                tree[size + i] = found * n + i
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        if tree[1] == _NONE:
            return symbols
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        while (root := tree[1]) != _NONE:
            number, i = divmod(root, n)
            gone = following[i]
            after = following[gone]
            symbols[i], alive[gone], following[i] = merged[number], False, after
            changed = [(i, _NONE)]
            if after < n:
                before[after] = i
                found = rank.get(symbols[i] * width + symbols[after])
                changed = [(i, _NONE if found is None else found * n + i)]
            if gone < n - 1:
                changed.append((gone, _NONE))
            if (p := before[i]) >= 0:
                found = rank.get(symbols[p] * width + symbols[i])
                changed.append((p, _NONE if found is None else found * n + p))
            for leaf, value in changed:
                node = size + leaf
                if tree[node] == value:
                    continue
                tree[node] = value
                node //= 2
                while node:
                    left, right = tree[2 * node], tree[2 * node + 1]
                    least = left if left < right else right
                    if tree[node] == least:
                        break
                    tree[node] = least
                    node //= 2
        return [s for s, here in zip(symbols, alive) if here]

    def _leaf(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        """The leaf values of pairs: rank and place in one number, or none."""
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
        return np.where(self._pairs[at] == wanted, self._numbers[at] * n + place, _NONE)

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the encoder leaves each pair of tokens as it is, where either token is its own encoding.

        The merges of both sides are undone, latest first, down to single symbols. The pair is
        broken if the symbols at the border could have merged before either was used up.
        """
        apart = np.ones(len(left), bool)
        never = np.int64(len(self.merged))
        rows, x, y = np.arange(len(left)), left.copy(), right.copy()
        x_used, y_used = np.full(len(left), never), np.full(len(left), never)
        while len(rows):
            wanted = x * self.width + y
            at = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
            rank = np.where(self._pairs[at] == wanted, self._numbers[at], never)
            # Of two places for one merge the left one goes first.
            merges = (rank < x_used) & (rank <= y_used) & (rank < never)
            apart[rows[merges]] = False
            of_x, of_y = self.made_by[x], self.made_by[y]
            going = ~merges & ((of_x >= 0) | (of_y >= 0))
            undo_x = (of_x > of_y)[going]
            rows, of_x, of_y, x, y = rows[going], of_x[going], of_y[going], x[going], y[going]
            x_used = np.where(undo_x, of_x, x_used[going])
            y_used = np.where(undo_x, y_used[going], of_y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return apart

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """``merge`` of many pieces, as little-endian 32-bit ids; pieces of one length go through their trees in step."""
        out: list[bytes] = [b""] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(k)
        for n, members in by_length.items():
            if n > 64 or len(members) < 8:
                for k in members:
                    out[k] = np.array(self.merge(self.symbols(pieces[k])), "<i4").tobytes()
                continue
            for at in range(0, len(members), 4096):
                some = members[at : at + 4096]
                for k, ids in zip(some, self._in_step([pieces[k] for k in some], n)):
                    out[k] = ids
        return out

    def _in_step(self, pieces: list[bytes], n: int) -> list[bytes]:
        raw = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, n)
        symbols = self._inner[raw]
        symbols[:, -1] = self._last[raw[:, -1]]
        rows = len(pieces)
        alive = np.ones((rows, n), bool)
        if n > 1:
            size = 1 << (n - 2).bit_length() if n > 2 else 1
            places = np.arange(n - 1)
            tree = np.full((rows, 2 * size), _NONE, np.int64)
            tree[:, size : size + n - 1] = self._leaf(symbols[:, :-1], symbols[:, 1:], places, n)
            level = size // 2
            while level:
                np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2], out=tree[:, level : 2 * level])
                level //= 2
            # One more column takes what has no neighbour.
            following = np.tile(np.arange(1, n + 2), (rows, 1))
            before = np.tile(np.arange(-1, n), (rows, 1))
            active = np.arange(rows)
            while True:
                root = tree[active, 1]
                going = root != _NONE
                active, root = active[going], root[going]
                if not len(active):
                    break
                number, i = np.divmod(root, n)
                gone = following[active, i]
                after = following[active, gone]
                symbols[active, i] = self._merged[number]
                alive[active, gone] = False
                following[active, i] = after
                before[active, after] = i
                p = before[active, i]
                here = symbols[active, i]
                right = self._leaf(here, symbols[active, np.minimum(after, n - 1)], i, n)
                left = self._leaf(symbols[active, p], here, p, n)
                tree[active, size + np.minimum(gone, n - 2)] = _NONE
                tree[active, size + np.minimum(i, n - 2)] = np.where(after < n, right, _NONE)
                has = p >= 0
                tree[active[has], size + p[has]] = left[has]
                for leaf in (np.minimum(gone, n - 2), np.minimum(i, n - 2), np.maximum(p, 0)):
                    node = (size + leaf) // 2
                    for _ in range(size.bit_length() - 1):
                        tree[active, node] = np.minimum(tree[active, 2 * node], tree[active, 2 * node + 1])
                        node = node // 2
        ends = np.cumsum(alive.sum(1)).tolist()
        ids = symbols[alive].astype("<i4").tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]


def chunks_of(text: str) -> list[str]:
    """The maximal runs without white space (Unicode's, which excludes the four separators)."""
    if any(s in text for s in _SEPARATORS):
        return _CHUNK.findall(text)
    return text.split()


def _taken(values: bytes | np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The listed runs of ids, one after the other, and where they start and the last one ends; ``sizes`` parts the ids into runs."""
    own = sizes[which]
    reach = np.concatenate([[0], np.cumsum(own)])
    moved = (np.cumsum(sizes) - sizes)[which] - reach[:-1]
    return np.frombuffer(values, "<i4")[np.repeat(moved, own) + np.arange(reach[-1])], reach


class WordEncoder:
    """Encoder and decoder for the vocabulary with word ends.

    No piece spans white space and special tokens hold none, so a text is encoded
    chunk by chunk. Arrow splits texts and numbers their distinct chunks, so Python sees each
    chunk of a request once; pieces met before are remembered.
    """

    def __init__(self, path: str) -> None:
        self.table = MergeTable(path)
        self._special = regex.compile("|".join(map(regex.escape, self.table.specials)))
        self._ids = {" " + text: np.array([n], "<i4").tobytes() for text, n in self.table.specials.items()}
        self._pieces = Memo(self._merge_pieces)

    @staticmethod
    def _folded(text: str) -> str:
        if not text.isascii():
            # Letters are lowered one by one, so a final sigma has no form of its own.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _keys(self, text: str) -> list[str]:
        """The folded chunks of a text; special tokens stand between them behind a blank, which no chunk holds."""
        out, start = [], 0
        for found in self._special.finditer(text) if "<|" in text else ():
            out += [*chunks_of(self._folded(text[start : found.start()])), " " + found[0]]
            start = found.end()
        return out + chunks_of(self._folded(text[start:]))

    def _merge_pieces(self, pieces: list[str]) -> Iterator[bytes]:
        merged = iter(self.table.merge_all([p.encode() for p in pieces if p not in self._ids]))
        return (self._ids[p] if p in self._ids else next(merged) for p in pieces)

    def _encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks one after the other, and how many each has."""
        words = pc.utf8_rtrim(chunks, string.punctuation)
        marks = pc.subtract(pc.binary_length(chunks), pc.binary_length(words)).to_numpy()
        # Letters are one piece, and so are the marks behind them; all else is left to the pattern.
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        numbered = words.filter(pa.array(letters)).dictionary_encode()
        pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        texts, marked = chunks.to_numpy(zero_copy_only=False), letters & (marks > 0)
        tails = [text[-n:] for text, n in zip(texts[marked].tolist(), marks[marked].tolist())]
        parts = [[c] if c[:1] == " " else _PIECE.findall(c) for c in texts[~letters].tolist()]
        others = {p: k for k, p in enumerate(set(tails).union(*parts), len(pieces))}
        counts = 1 + marked.astype(np.int64)
        counts[~letters] = list(map(len, parts))
        ends = np.cumsum(counts)
        first = ends - counts
        which = np.empty(counts.sum(), np.int64)
        which[first[letters]] = numbered.indices.to_numpy()
        which[first[marked] + 1] = [others[t] for t in tails]
        which[np.repeat(~letters, counts)] = [others[p] for own in parts for p in own]
        found = self._pieces.results(pieces + list(others))
        values, reach = _taken(b"".join(found), np.fromiter(map(len, found), np.int64, len(found)) // 4, which)
        return values, reach[ends] - reach[first]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens and separators."""
        chunks = pc.utf8_split_whitespace(pa.array(map(self._folded, texts), pa.large_string()))
        numbered = chunks.values.dictionary_encode()
        values, sizes = self._encode_chunks(numbered.dictionary)
        values, reach = _taken(values, sizes, numbered.indices.to_numpy())
        edges, raw = (4 * reach[chunks.offsets.to_numpy()]).tolist(), values.tobytes()
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        out = [b""] * len(texts)
        plain, size = [], 0
        for k, text in enumerate(texts):
            if not text:
                continue
            if "<|" in text or any(s in text for s in _SEPARATORS):
                out[k] = self._encode_chunks(pa.array(self._keys(text), pa.large_string()))[0].tobytes()
                continue
            plain.append(k)
            size += len(text)
            if len(plain) == _TOGETHER or size > _CHARACTERS:
                self._fill(out, texts, plain)
                plain, size = [], 0
        self._fill(out, texts, plain)
        return out

    def _fill(self, out: list[bytes], texts: list[str | None], places: list[int]) -> None:
        for k, ids in zip(places, self._encode_plain([texts[k] for k in places])):
            out[k] = ids

    def decode(self, ids: list[int] | None) -> str:
        tokens = self.table.tokens
        known = len(tokens)
        try:
            return " ".join(map(tokens.__getitem__, ids or []))
        except (IndexError, TypeError):
            return " ".join(tokens[i] for i in ids if i is not None and 0 <= i < known and tokens[i] is not None)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def id_lists(parts: list[bytes]) -> pa.Array:
    """One list of ids per entry, without a Python object per id."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int64)
    if ends[-1] >= 1 << 31:
        raise ValueError("more ids in one Arrow batch than it can address: lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(text: Column, vocabulary: str) -> Column:
    """The token ids of each text as ``array<int>``, equal to the public library's for this vocabulary file."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = word_encoder(vocabulary)
        for batch in batches:
            yield id_lists(encoder.encode_many(batch.to_pylist()))

    return ids(text)


def decode(ids: Column, vocabulary: str) -> Column:
    """The text of each list of ids: its tokens joined by spaces, as the vocabulary names no decoder."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = word_encoder(vocabulary)
        for batch in batches:
            yield pa.array([encoder.decode(x.as_py() if x.is_valid else None) for x in batch], pa.string())

    return texts(ids)


def round_trip(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``ids, decoded`` of every whole text beside the columns to ``keep``, in one pass over small batches."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                rows = batch.slice(at, _SLICE)
                ids = encoder.encode_many(rows.column(len(keep)).to_pylist())
                decoded = pa.array([encoder.decode(np.frombuffer(x, "<i4").tolist()) for x in ids], pa.string())
                own = rows.columns[: len(keep)]
                yield pa.RecordBatch.from_arrays([*own, id_lists(ids), decoded], [*keep, "ids", "decoded"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(both, f"{kinds}, ids array<int>, decoded string")

"""Benchmark passages in documents, found despite edits.

A test item of length m may differ by ``budget = floor(share * m)`` insertions, deletions
and substitutions. Cut into ``budget + 1`` pieces, at least one piece of any such copy is
unchanged (pigeonhole), so an automaton over all pieces finds every candidate in one pass
over a text. A hit is verified upwards through a binary tree over the item's pieces: a node
of b pieces may have b - 1 errors, for if both halves had more, so would the whole. Each
node is checked with Myers's bit-parallel edit distance near the hit; chance hits fail at
small nodes, and only a copy reaches the root.

Letters are compared in lower case and all white space as blanks, character by character,
so positions are those of the text.

Items are a stated query set; they go to the tasks in blocks of at most ``BLOCK_CHARS``
characters, short items counted as ``LEAST_CHARS``, so what a task holds is bounded whatever
the number of items.

Items under ``least_chars`` characters may not differ at all, and count only where no letter
or digit goes on at either end: "tin" is not found in "tiny". A short item that is an everyday
word is so found in every text that has the word.

Edge cases: null and empty texts hold nothing. Null items and items of white space alone are
not searched. Equal items are all reported.
Of overlapping places of one item in a text the first that is verified is reported. An empty
table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.08
LEAST_CHARS = 25
BLOCK_CHARS = 8_000_000
_BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def folded(text: str) -> str:
    """Lower case and blanks, of the same length as the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    for blank in _BLANKS:
        if blank in low:
            low = low.replace(blank, " ")
    return low


def myers(masks: dict[str, int], m: int, text: str, budget: int) -> tuple[int, int] | None:
    """Least distance of the pattern to any substring of ``text`` and the first end reaching it, if within budget."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = budget + 1, -1
    for i, char in enumerate(text):
        equal = masks.get(char, 0)
        carry = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | ~(carry | up) & full
        minus = up & carry
        if score < best:
            best, end = score, i + 1
            if best == 0:
                break
    return (best, end) if end >= 0 else None


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, char in enumerate(pattern):
        out[char] = out.get(char, 0) | (1 << i)
    return out


class _Node:
    """Some neighbouring pieces of an item: where they stand, and how many errors they may hold."""

    __slots__ = ("start", "end", "budget", "parent", "_pattern", "_masks")

    def __init__(self, pattern: str, start: int, end: int, budget: int, parent: _Node | None) -> None:
        self.start, self.end, self.budget, self.parent = start, end, budget, parent
        self._pattern, self._masks = pattern[start:end], None

    def nearest(self, text: str) -> tuple[int, int] | None:
        if self._masks is None:
            self._masks = masks_of(self._pattern)
        return myers(self._masks, self.end - self.start, text, self.budget)

    def begin(self, text: str, end: int, distance: int) -> int:
        """Where the copy that ends at ``end`` begins: the same search backwards."""
        head = text[max(0, end - (self.end - self.start) - distance) : end][::-1]
        back = myers_anchored(masks_of(self._pattern[::-1]), self.end - self.start, head, distance)
        return end - back


def myers_anchored(masks: dict[str, int], m: int, text: str, distance: int) -> int:
    """The longest prefix of ``text`` at exactly ``distance`` from the pattern (0 if there is none)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, found = full, 0, m, 0
    for i, char in enumerate(text):
        equal = masks.get(char, 0)
        carry = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = ((up << 1) | 1) & full  # the prefix starts at the text's start
        down = (down << 1) & full
        plus = down | ~(carry | up) & full
        minus = up & carry
        if score <= distance:
            found = i + 1
    return found


def _stands_alone(text: str, start: int, end: int) -> bool:
    """Does no word go on over either end?"""
    before = start > 0 and text[start - 1].isalnum() and text[start].isalnum()
    after = end < len(text) and text[end].isalnum() and text[end - 1].isalnum()
    return not before and not after


class ItemSearch:
    """All places of a block of items in a text."""

    def __init__(self, items: list[tuple[int, str]], share: float = SHARE, least_chars: int = LEAST_CHARS) -> None:
        self.items: list[tuple[int, str, int]] = []
        self._exact: set[int] = set()
        self._automaton = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, _Node]]] = {}
        for item_id, text in items:
            pattern = folded(text)
            short = len(pattern) < least_chars
            if short:
                pattern = pattern.strip()
            if not pattern.strip():
                continue
            budget = 0 if short else int(share * len(pattern))
            cuts = [k * len(pattern) // (budget + 1) for k in range(budget + 2)]
            number = len(self.items)
            self.items.append((item_id, pattern, budget))
            if short:
                self._exact.add(number)
            for leaf in self._leaves(pattern, cuts, 0, budget + 1, None):
                pieces.setdefault(pattern[leaf.start : leaf.end], []).append((number, leaf))
        for piece, places in pieces.items():
            self._automaton.add_word(piece, (len(piece), places))
        self._automaton.make_automaton()

    def _leaves(self, pattern: str, cuts: list[int], a: int, b: int, parent: _Node | None) -> Iterator[_Node]:
        node = _Node(pattern, cuts[a], cuts[b], b - a - 1, parent)
        if b - a == 1:
            yield node
        else:
            middle = (a + b) // 2
            yield from self._leaves(pattern, cuts, a, middle, node)
            yield from self._leaves(pattern, cuts, middle, b, node)

    def find(self, text: str | None) -> list[dict]:
        if not text or not self.items:
            return []
        data = folded(text)
        found: dict[int, list[tuple[int, int, int]]] = {}
        refused: set[tuple[int, int]] = set()
        for last, (length, places) in self._automaton.iter(data):
            first = last + 1 - length
            for number, leaf in places:
                spans = found.get(number)
                if number in self._exact:  # these come in order
                    if (spans is None or spans[-1][1] <= first) and _stands_alone(data, first, last + 1):
                        found.setdefault(number, []).append((first, last + 1, 0))
                    continue
                if spans is not None and any(start <= first < end for start, end, _ in spans):
                    continue
                shift = first - leaf.start  # where the item would begin without edits before the piece
                match = self._climb(data, leaf, shift, refused)
                if match is not None:
                    found.setdefault(number, []).append(match)
        return [
            {"item_id": self.items[n][0], "start": s, "end": e, "distance": d}
            for n, spans in sorted(found.items())
            for s, e, d in sorted(spans)
        ]

    @staticmethod
    def _climb(data: str, leaf: _Node, shift: int, refused: set[tuple[int, int]]) -> tuple[int, int, int] | None:
        node, size = leaf, len(data)
        result = (0, 0)
        while node.parent is not None:
            node = node.parent
            key = (id(node), shift)
            if key in refused:
                return None
            low = max(0, shift + node.start - node.budget)
            high = min(size, shift + node.end + node.budget)
            nearest = node.nearest(data[low:high])
            if nearest is None:
                refused.add(key)
                return None
            result = (nearest[0], low + nearest[1])
        if leaf.parent is None:  # no error allowed: the piece is the item
            return shift, shift + leaf.end, 0
        distance, end = result
        return node.begin(data, end, distance), end, distance


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``block_chars`` characters, or of one item."""
    held, size = [], 0
    for row in items.select("item_id", "text").where(F.col("text").isNotNull()).orderBy("item_id", "text").toLocalIterator():
        chars = max(len(row["text"]), LEAST_CHARS)
        if held and size + chars > block_chars:
            yield held
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += chars
    if held:
        yield held


_PLACES = "array<struct<item_id: bigint, start: int, end: int, distance: int>>"
_PLACES_ARROW = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("distance", pa.int32())])
)


def places(text: Column, items: list[tuple[int, str]], share: float = SHARE, least_chars: int = LEAST_CHARS) -> Column:
    """Where the items of a block stand in each text."""

    @F.arrow_udf(_PLACES)
    def searched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = ItemSearch(items, share, least_chars)
        for batch in batches:
            yield pa.array([search.find(t) for t in batch.to_pylist()], _PLACES_ARROW)

    return searched(text)


def contaminated(docs: DataFrame, items: DataFrame, share: float = SHARE, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc_id, item_id, start, end, distance`` of every place of an item in a document."""
    found = None
    for block in item_blocks(items):
        hits = docs.select("doc_id", F.explode(places(F.col("text"), block, share, least_chars)).alias("hit"))
        part = hits.select("doc_id", "hit.item_id", "hit.start", "hit.end", "hit.distance")
        found = part if found is None else found.unionByName(part)
    if found is None:
        key = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {key}, item_id bigint, start int, end int, distance int")
    return found


def without_contamination(docs: DataFrame, items: DataFrame, share: float = SHARE, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    kept = docs
    for block in item_blocks(items):
        kept = kept.where(F.size(places(F.col("text"), block, share, least_chars)) == 0)
    return kept

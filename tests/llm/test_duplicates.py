"""Near duplicates, repeated passages and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from mostrador.llm import lpf_dedup, near_dup
from mostrador.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sentence(r, n):
    return " ".join("".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 7))) for _ in range(n))


def _sets(texts, size):
    out = []
    for text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = WORD.findall(low)
        out.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    return out


def _classes(ids, sets, percent):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in zip(ids, sets):
        for b, y in zip(ids, sets):
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


@pytest.fixture(scope="module")
def near_rows():
    r = random.Random(2)
    texts = [None, "", " \n", "one", "ONE", "two words", "Two  Words"]
    for base in range(4):
        words = _sentence(r, 60 + 20 * base).split()
        texts += [" ".join(words)] * 3
        for _ in range(25):
            changed = list(words)
            for _ in range(r.randint(0, 4)):
                changed[r.randrange(len(changed))] = _sentence(r, 1)
            texts.append(" ".join(changed))
    texts += [_sentence(r, 40) for _ in range(20)] + [_sentence(r, 6000)]
    ids = list(range(10, 10 + len(texts)))
    r.shuffle(ids)
    return list(zip(ids, texts))


def test_classes_equal_all_pairs(frame, near_rows):
    docs = frame([(i, t, "x") for i, t in near_rows], "doc_id bigint, text string, node string")
    for size in (4, 5):
        sets = _sets([t for _, t in near_rows], size)
        expected = _classes([i for i, _ in near_rows], sets, 80)
        found = near_dup.near_duplicates(docs, words=size).collect()
        assert len(found) == len(near_rows)
        sizes = {i: len(s) for (i, _), s in zip(near_rows, sets)}
        for row in found:
            assert (row.n_shingles, row.component_id, row.kept) == (sizes[row.doc_id], expected[row.doc_id], expected[row.doc_id] == row.doc_id)


def test_clusters_cut_into_chunks_keep_their_links(frame, near_rows, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", 7)
    expected = _classes([i for i, _ in near_rows], _sets([t for _, t in near_rows], 5), 80)
    found = near_dup.near_duplicates(frame(near_rows, "doc_id bigint, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == expected


def test_rows_without_id_are_kept(frame):
    text = "a b c d e f g h"
    found = near_dup.near_duplicates(frame([(None, text), (3, text), (2, text), (2, text)], "doc_id bigint, text string"))
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in found.collect()), key=str)
    assert rows == [(2, 2, True), (2, 2, True), (3, 2, False), (None, None, True)]
    assert near_dup.near_duplicates(frame([], "doc_id bigint, text string")).count() == 0


def test_word_hashes_do_not_depend_on_place():
    a = near_dup.word_hashes(np.frombuffer("  Über\tthe HOUSE\n".encode(), np.uint8))
    b = near_dup.word_hashes(np.frombuffer("house the Über".encode(), np.uint8))
    assert a.tolist() == b.tolist()[::-1]


def test_components_of_chains_and_stars(frame):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = components(frame(links, "a bigint, b bigint"), "a", "b").collect()
    expected = {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)


def _brute(texts, length):
    places = {}
    data = [(t or "").encode() for t in texts]
    for k, text in enumerate(data):
        for p in range(len(text) - length + 1):
            places.setdefault(text[p : p + length], []).append((k, p))
    out = []
    for k, text in enumerate(data):
        gone, later = np.zeros(len(text), bool), np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            found = places[text[p : p + length]]
            if len(found) > 1:
                gone[p : p + length] = True
                if found[0] != (k, p):
                    later[p : p + length] = True
        out.append((gone, later))
    return data, out


def _check(frame, texts, length, anchor):
    data, expected = _brute(texts, length)
    docs = frame([(k, t, 5, "b") for k, t in enumerate(texts)], "doc_id bigint, text string, rid int, kept string")
    for first in (False, True):
        found = lpf_dedup.remove_repeats(docs, length, anchor, keep_first=first).collect()
        assert len(found) == len(texts)
        for row in found:
            gone = expected[row.doc_id][int(first)]
            kept = bytes(np.frombuffer(data[row.doc_id], np.uint8)[~gone])
            assert (bytes(row.kept), row.n_bytes) == (kept, len(data[row.doc_id])), (first, row.doc_id)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
            assert [(s.start, s.end) for s in row.spans] == list(zip(edges[0::2].tolist(), edges[1::2].tolist()))
            assert row.rid == 5


@pytest.fixture(scope="module")
def passages():
    r = random.Random(9)
    shared = [_sentence(r, n) for n in (8, 12, 30)]
    texts = [None, "", "short", "é" * 90, "é" * 60, "ab" * 100, "ab" * 80 + "c", "x" * 300, "\0" * 120]
    for _ in range(40):
        parts = [_sentence(r, r.randint(1, 12)) for _ in range(3)]
        texts.append(f"{parts[0]} {r.choice(shared)} {parts[1]} {r.choice(shared)} {parts[2]}")
    return texts + [texts[12], texts[12], texts[20]]


def test_repeats_equal_brute_force(frame, passages):
    _check(frame, passages, 60, 16)


def test_hot_anchors_are_split_without_loss(frame, passages, monkeypatch):
    monkeypatch.setattr(lpf_dedup, "LIMIT", 3)
    _check(frame, passages, 60, 16)


def test_long_texts_in_parts(frame, monkeypatch):
    monkeypatch.setattr(lpf_dedup, "_PART", 50)
    r = random.Random(4)
    text = _sentence(r, 120)
    _check(frame, [text, _sentence(r, 5) + text[100:400] + _sentence(r, 9), text[37:]], 60, 16)


def test_equal_rows_repeat_each_other(frame):
    text = _sentence(random.Random(1), 40)
    rows = lpf_dedup.remove_repeats(frame([(1, text), (1, text), (None, text[:30])], "doc_id bigint, text string"), 60, 16).collect()
    assert sorted(len(r.kept) for r in rows) == [0, 0, 30]
    assert lpf_dedup.remove_repeats(frame([], "doc_id bigint, text string")).count() == 0


def test_whole_characters_stay(frame):
    a, b = "é" * 50 + "x" * 20, "è" + "é" * 49 + "x" * 20  # the second bytes differ: a repeat begins within a character
    rows = lpf_dedup.remove_repeats(frame([(1, a), (2, b)], "doc_id bigint, text string"), 60, 16, whole_characters=True).collect()
    for row in rows:
        bytes(row.kept).decode()
    assert hashlib.sha256(b"").digest()


def test_places_of_a_common_passage_are_not_joined_one_by_one(frame, tmp_path):
    r = random.Random(6)
    common = _sentence(r, 400)
    texts = [f"{_sentence(r, 5)} {common} {_sentence(r, 5)}" for _ in range(30)]
    docs = frame(list(enumerate(texts)), "doc_id bigint, text string")
    _, found = lpf_dedup.find_repeats(docs, str(tmp_path / "repeats"), 60, 16)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "Join" in line and "around#" in line]
    # Every document has many places of the passage, and all but the first document's are later copies.
    assert found.where("later").select("id").distinct().count() == 29
    assert found.where("not later").select("id").distinct().count() == 30


def test_later_copies_of_a_document_stay_together(frame, tmp_path):
    r = random.Random(8)
    common = _sentence(r, 400)
    texts = [f"{_sentence(r, 5)} {common} {_sentence(r, 5)}" for _ in range(30)]
    _, found = lpf_dedup.find_repeats(frame(list(enumerate(texts)), "doc_id bigint, text string"), str(tmp_path / "repeats"), 60, 16)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    # The passage is over 2,000 bytes long, so a document has dozens of places in it.
    rows = found.where("later").selectExpr("id", "size(cuts) as n").collect()
    assert all(sum(row.n for row in rows if row.id == k) > 30 for k in range(1, 30))
    assert len(rows) < 30 * 10


@pytest.mark.parametrize("limit", [20_000, 3])
def test_repeated_runs_of_words_equal_brute_force(frame, monkeypatch, limit):
    monkeypatch.setattr(lpf_dedup, "LIMIT", limit)
    r = random.Random(11)
    shared = [_sentence(r, n).split() for n in (9, 10, 14, 25)]
    texts = [None, "", "a " * 40, "b\u00a0" * 25, " ".join("é" * 30 for _ in range(12))]
    for _ in range(40):
        parts = [_sentence(r, r.randint(1, 6)).split() for _ in range(3)]
        words = parts[0] + r.choice(shared) + parts[1] + r.choice(shared) + parts[2]
        texts.append("".join(w + r.choice([" ", "\n", "  ", "\u3000"]) for w in words))
    places = {}
    split = [list(re.finditer(r"\S+", t or "")) for t in texts]
    for k, words in enumerate(split):
        for p in range(len(words) - 9):
            places.setdefault(tuple(w[0] for w in words[p : p + 10]), []).append((k, p))
    for first in (False, True):
        docs = frame(list(enumerate(texts)), "doc_id bigint, text string")
        # No string of 5,000 bytes stands twice, so only words decide.
        found = {row.doc_id: row for row in lpf_dedup.remove_repeats(docs, 5_000, 16, keep_first=first, words=10).collect()}
        assert len(found) == len(texts)
        for k, (text, words) in enumerate(zip(texts, split)):
            gone, cut = [False] * len(text or ""), [False] * len(words)
            for p in range(len(words) - 9):
                same = places[tuple(w[0] for w in words[p : p + 10])]
                if len(same) > 1 and (not first or same[0] != (k, p)):
                    cut[p : p + 10] = [True] * 10
            for p, w in enumerate(words):
                # Blanks go between words that go.
                a = words[p - 1].end() if p and cut[p] and cut[p - 1] else w.start()
                gone[a : w.end()] = [cut[p]] * (w.end() - a)
            assert bytes(found[k].kept).decode() == "".join(c for c, g in zip(text or "", gone) if not g), (first, k)

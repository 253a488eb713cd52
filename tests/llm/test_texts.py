"""Fingerprints, archives, toxicity, quality and decontamination."""

import base64
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mostrador.llm import arc_warc, decontaminate, fingerprints, toxicity, zstd_quality


def _sentence(r, n):
    return " ".join("".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 7))) for _ in range(n))


# --- fingerprints ------------------------------------------------------------
def test_entropy_of_windows_is_the_definition():
    data = np.frombuffer(_sentence(random.Random(1), 40).encode(), np.uint8)
    found = fingerprints._entropies(data)
    for p in range(0, len(found), 7):
        counts = np.unique(data[p : p + fingerprints.WINDOW], return_counts=True)[1]
        share = counts / fingerprints.WINDOW
        exact = -(share * np.log2(share)).sum() / math.log2(fingerprints.WINDOW) * fingerprints.BINS
        assert abs(found[p] - exact) <= 1


def test_selection_marks_the_lowest_rank_of_neighbours():
    r = np.random.default_rng(2)
    ranks = r.integers(0, 9, 400).astype(np.int16)
    marks = np.zeros(400, int)
    for p in range(400 - fingerprints.NEIGHBOURS + 1):
        part = ranks[p : p + fingerprints.NEIGHBOURS]
        ranked = np.flatnonzero(part > 0)
        if len(ranked):
            marks[p + ranked[np.argmin(part[ranked])]] += 1
    assert fingerprints._selected(ranks).tolist() == np.flatnonzero(marks >= fingerprints.LEAST_MARKS).tolist()


def test_long_texts_in_parts_have_the_same_fingerprint(monkeypatch):
    text = _sentence(random.Random(3), 900)
    ranks = fingerprints.ranks_of(fingerprints.entropy_counts([text]).tolist())
    whole = fingerprints.fingerprint(text, ranks)
    monkeypatch.setattr(fingerprints, "_CHUNK", 100)
    assert fingerprints.fingerprint(text, ranks) == whole


def test_edited_texts_and_neighbours(frame):
    r = random.Random(4)
    texts = [None, "", "short", "é" * 40, "z" * 500] + [_sentence(r, r.randint(20, 300)) for _ in range(25)]
    rows = [(7 * k, t, "x") for k, t in enumerate(texts)]
    docs = frame(rows + [(None, "no id", "y")], "doc_id bigint, text string, part string")
    rarity = fingerprints.fit_rarity(docs)
    assert sum(rarity) == sum(len((t or "").encode()) for t in [*texts, "no id"])
    found = {row.doc_id: row for row in fingerprints.edited_fingerprints(docs, rarity).collect()}
    assert len(found) == len(texts) + 1
    assert found[None].edited_sha256 is None and found[None].n_chars == 5
    order = sorted(rows, reverse=True)
    for (doc, text, _), (_, following, _) in zip(order, order[1:] + order[:1]):
        text, half = text or "", len(text or "") // 2
        edited = text[: len(text) - half] + (following or "")[:half]
        row = found[doc]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= row.near_next <= 1 and 0 <= row.near_edited <= 1
        if len(text) > 400:
            assert row.near_edited > row.near_next + 0.1
    assert found[0].fingerprint == found[7].fingerprint == ""
    plain = {x.doc_id: x.fingerprint for x in fingerprints.fingerprints(docs, rarity).collect()}
    assert plain == {k: v.fingerprint for k, v in found.items()}


def test_ties_and_empty_tables(frame):
    docs = frame([(5, "b" * 60), (5, "a" * 60), (5, "a" * 60)], "doc_id bigint, text string")
    rarity = fingerprints.fit_rarity(docs)
    assert fingerprints.edited_fingerprints(docs, rarity).count() == 3
    assert fingerprints.edited_fingerprints(docs.limit(0), rarity).count() == 0
    assert fingerprints.fit_rarity(docs.limit(0)) == [0] * (fingerprints.BINS + 1)


# --- archives ----------------------------------------------------------------
def _lines(data):
    return iter([("f", x) for x in data.split(b"\n")])


def test_both_arc_versions_are_parsed_by_declared_length():
    one = b"filedesc://a.arc 0.0.0.0 19970101000000 text/plain 4\n1 0 \n\nhttp://a/ 1.2.3.4 19970102030405 text/html 7\nab\ncd\n\n\n"
    one += b"http://b/ 1.2.3.4 19970102030406 text/html 0\n\nhttp://c/ 1.2.3.4 19970102030407 text/html 99\ncut"
    found = list(arc_warc.arc_records(_lines(one)))
    assert [(r["target_uri"], r["block"], r["truncated"]) for r in found] == [
        ("http://a/", b"ab\ncd\n\n", False),
        ("http://b/", b"", False),
        ("http://c/", b"cut", True),
    ]
    two = b"filedesc://a.arc 0.0.0.0 19980101000000 text/plain 200 - - 0 a.arc 4\n2 0 \n\n"
    two += b"http://d/ 1.2.3.4 19980102030405 text/plain 200 - - 88 a.arc 5\nhello\nno header here\n"
    found = list(arc_warc.arc_records(_lines(two)))
    assert (found[0]["block"], found[0]["date"]) == (b"hello", "19980102030405") and found[1] == {"error": "no header here"}
    record = arc_warc._as_warc(found[0])
    assert record["kind"] == "resource" and record["warc_date"] == "1998-01-02T03:04:05Z"
    assert record["payload_digest"] == base64.b32encode(hashlib.sha1(b"hello").digest()).decode()
    assert record == arc_warc._as_warc(dict(found[0]))


def test_pages_to_arc_to_warc_and_back(spark, frame, folder):
    hard = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nhttp://x/ 1.1.1.1 19990101000000 text/html 4\n"
    pages = [(1, "http://a/", "same"), (2, "http://b /x", "same"), (3, None, None), (4, "http://c/", ""), (5, "u", hard), (6, "u", "é\n" * 50)]
    pages += [(7, "u", hard), (None, "u", "same"), (8, "u", "tie"), (8, "u", "tie"), (9, "u", "x" * 100_000)]
    table = frame([(*p, "z") for p in pages], "page_id bigint, url string, html string, payload string")
    arc_warc.write_arc(table, folder("arc"))
    records = arc_warc.read_arc(spark, folder("arc"))
    assert records.where("error is not null or truncated").count() == 0
    arc_warc.write_warc(arc_warc.convert(records), folder("warc"))
    read = arc_warc.referred_pages(arc_warc.read_warc(spark, folder("warc"))).collect()
    best = {}
    for page, _, html in pages:
        if page is not None:
            best[html or ""] = max(page, best.get(html or "", -1))
    expected = []
    for page, _, html in pages:
        data = (html or "").encode()
        again = page != best[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, len(data), digest, "revisit" if again else "response", best[html or ""] if again else None))
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert all(r.intact and r.error is None for r in read)
    large = arc_warc.convert(records, least_bytes=10).where("record_type = 'revisit'")
    assert {r.payload_bytes for r in large.collect()} == {len(hard.encode())}


def test_no_pages_no_records(spark, frame, folder):
    arc_warc.write_arc(frame([], "page_id bigint, url string, html string"), folder("arc"))
    arc_warc.write_warc(arc_warc.convert(arc_warc.read_arc(spark, folder("arc"))), folder("warc"))
    assert arc_warc.read_warc(spark, folder("warc")).count() == 0


# --- toxicity and quality ----------------------------------------------------
@pytest.fixture(scope="module")
def judged(spark):
    r = random.Random(6)
    docs, labels = [], []
    for i in range(400):
        sentences = [_sentence(r, 8) for _ in range(r.randint(1, 9))]
        toxic, good = i % 5 == 0, i % 3 != 0
        if toxic:
            sentences[r.randrange(len(sentences))] += " " + r.choice(["idiot", "scum"])
        text = ". ".join(sentences)
        docs.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good), int(toxic)))
    docs += [(1000, None), (1001, ""), (None, "An idiot.")]
    labels += [(5000, 1, 1), (None, 1, 1), (3, None, None)]
    return (
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, y int").repartition(3),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_toxic_documents_and_sentences_are_found(judged):
    docs, labels = judged
    model = toxicity.fit(docs, labels.where("doc_id % 4 <> 0"), least_docs=3)
    scored = docs.select("doc_id", toxicity.score(F.col("text"), model).alias("score")).join(labels, "doc_id", "left").collect()
    held = [r for r in scored if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 0 and r.toxic is not None]
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in held) / len(held) > 0.95
    assert {r.score for r in scored if r.doc_id in (1000, 1001)} == {0.0}
    spots = toxicity.locate(docs, model).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert spots and all(texts[s.doc_id][s.start : s.end] == s.text for s in spots)
    assert sum(any(w in s.text.lower() for w in ("idiot", "scum")) for s in spots) / len(spots) > 0.95


def test_a_document_is_the_noisy_or_of_its_sentences():
    scorer = toxicity.Scorer(toxicity.ToxicityModel(-3.0, {"bad": 2.0, "worse": 4.0}))
    text = "Bad one. A quiet one! worse, bad\nlast"
    singles = scorer.sentences(text)
    assert scorer.document(text) == pytest.approx(1 - np.prod([1 - s for s in singles]))
    assert scorer.document("quiet. quiet") == pytest.approx(1 - np.prod([1 - s for s in scorer.sentences("quiet. quiet")]))


def test_nothing_to_learn(judged):
    docs, labels = judged
    assert toxicity.fit(docs, labels.limit(0)).constant == 0.0
    assert toxicity.fit(docs, labels.where("toxic = 1")).constant == 1.0
    model = zstd_quality.fit(docs, labels.where("quality = 0"))
    assert docs.select(zstd_quality.score(F.col("text"), model).alias("s")).distinct().collect()[0].s == 0.0


def test_quality_scores_are_right_and_calibrated(judged):
    docs, labels = judged
    model = zstd_quality.fit(docs, labels.where("doc_id % 4 <> 0"))
    scored = docs.select("doc_id", zstd_quality.score(F.col("text"), model).alias("score")).join(labels, "doc_id", "left").collect()
    held = [r for r in scored if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 4 == 0 and r.quality is not None]
    assert sum((r.score >= 0.5) == bool(r.quality) for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in scored) and len(scored) >= 403
    again = zstd_quality.fit(docs, labels.where("doc_id % 4 <> 0"))
    assert again == model


def test_dictionaries_are_built_from_all_over_long_texts(frame):
    r = random.Random(12)
    docs = [(i, _sentence(r, 2_500) + (" shiny" if i % 2 else " rotten") * 1_000 + _sentence(r, 2_500)) for i in range(40)]
    assert all("shiny" not in t[: zstd_quality.SAMPLE_BYTES] and "rotten" not in t[: zstd_quality.SAMPLE_BYTES] for _, t in docs)
    labels = frame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    model = zstd_quality.fit(frame(docs, "doc_id bigint, text string"), labels)
    assert b"shiny" in model.good and b"rotten" in model.bad
    data = docs[0][1].encode()
    for size in (1, 3_000, 8_192, len(data)):
        part = zstd_quality.sampled_blocks(data, size)
        assert 0 < len(part) <= max(size, zstd_quality.BLOCK)
        assert all(part[i : i + zstd_quality.BLOCK] in data for i in range(0, len(part), zstd_quality.BLOCK))
    assert zstd_quality.sampled_blocks(data, len(data)) == data


# --- decontamination ---------------------------------------------------------
def _edit_distance_within(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for char in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != char), row[i + 1] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance_is_the_edit_distance():
    r = random.Random(7)
    for _ in range(200):
        pattern = "".join(r.choice("abc") for _ in range(r.randint(1, 30)))
        text = "".join(r.choice("abc") for _ in range(r.randint(0, 60)))
        exact = _edit_distance_within(pattern, text)
        found = decontaminate.myers(decontaminate.masks_of(pattern), len(pattern), text, len(pattern))
        assert (found[0] if found else len(pattern)) == exact


def test_items_are_found_despite_edits_and_only_they(frame):
    r = random.Random(8)
    items = [(k, _sentence(r, 25 + k)) for k in range(12)] + [(50, None), (51, "tiny"), (52, "")]
    docs = []
    for k in range(120):
        text = _sentence(r, r.randint(0, 60))
        if k % 3 == 0:
            chars = list(items[k % 12][1])
            for _ in range(r.randint(0, int(decontaminate.SHARE * len(chars) * 1.3))):
                p = r.randrange(len(chars))
                chars[p : p + 1] = r.choice([[], [r.choice("xyz")], [chars[p], "q"]])
            text += " " + "".join(chars).upper().replace(" ", "\n") + " " + _sentence(r, 5)
        docs.append((k, text, 3))
    docs += [(500, None, 3), (501, "", 3), (None, items[0][1], 3)]
    found = decontaminate.contaminated(
        frame(docs, "doc_id bigint, text string, item_id int"), frame(items, "item_id bigint, text string")
    ).collect()
    got = {(row.doc_id, row.item_id): row.distance for row in found}
    for doc, text, _ in docs:
        for item, pattern in items[:12]:
            exact = _edit_distance_within(decontaminate.folded(pattern), decontaminate.folded(text or ""))
            budget = int(decontaminate.SHARE * len(pattern))
            assert ((doc, item) in got) == (exact <= budget), (doc, item, exact, budget)
            if exact == 0:
                assert got[doc, item] == 0
    assert {i for _, i in got} <= set(range(12))


def test_blocks_of_items_and_clean_documents(frame, monkeypatch):
    r = random.Random(9)
    items = frame([(k, _sentence(r, 20)) for k in range(6)], "item_id bigint, text string")
    texts = {row.item_id: row.text for row in items.collect()}
    docs = frame([(k, "intro " + texts[k] + " end", k) for k in range(6)] + [(9, "clean", 1), (10, None, 1)], "doc_id bigint, text string, hit int")
    whole = sorted(map(tuple, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1)
    assert len(list(decontaminate.item_blocks(items, 1))) == 6
    assert len(whole) == 6
    kept = decontaminate.without_contamination(docs, items)
    assert {row.doc_id for row in kept.collect()} == {9, 10} and kept.columns == docs.columns
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_short_items_are_found_exactly_and_at_word_boundaries(frame):
    items = frame([(1, "What is 2+2?"), (2, "tin"), (3, " Blue\n"), (4, "  "), (5, ""), (6, None), (7, "What is 2+3?")], "item_id bigint, text string")
    docs = frame(
        [(1, "He asked: WHAT\nis 2+2? tiny tins, a tin-opener, tin"), (2, "martin What is 2+4? blues"), (3, "blue"), (4, "  "), (5, None)],
        "doc_id bigint, text string",
    )
    found = {(r.doc_id, r.item_id, r.start, r.end, r.distance) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(1, 1, 10, 22, 0), (1, 2, 36, 39, 0), (1, 2, 48, 51, 0), (3, 3, 0, 4, 0)}
    assert {r.doc_id for r in decontaminate.without_contamination(docs, items).collect()} == {2, 4, 5}

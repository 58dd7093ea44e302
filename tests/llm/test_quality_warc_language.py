import base64
import collections
import hashlib
import random
import re

import numpy as np
import pytest

from texts import SCHEMA, prose
from tradewind.llm import language, quality, warc
from tradewind.llm.storage import shared_folder, stored


def brute_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_statistics_of_odd_rows(make_docs, odd_pairs):
    more = odd_pairs + [(30, "a b c a b c\nx\n\nx\n y"), (31, "#* $% &|<>"), (32, "a a a a"), (33, "\x0b\x1ca b")]
    rows = quality.judged(make_docs(more)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    found = collections.Counter((r["id"], *(r[n] for n in names)) for r in rows)
    assert found == collections.Counter((i, *brute_statistics(t)) for i, t in more)
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def brute_verdicts(vectors):
    """Distances of one group by the same steps in numpy."""
    x, p = np.array(vectors, float), quality.P
    floors = np.array(quality.FLOORS)

    def at(column, q):
        return np.sort(column)[int(np.ceil(q * len(column))) - 1]

    mean = np.array([at(c, 0.5) for c in x.T])
    spread = np.array([max((at(c, 0.75) - at(c, 0.25)) / 1.349, f) for c, f in zip(x.T, floors)])
    inverse = np.diag(1 / spread**2)

    def edge():
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        classes = np.floor(np.log2(1 + np.maximum(d, 0)) * quality.CLASSES)
        return d, classes, np.sort(classes)[int(np.ceil(quality.CORE * len(x))) - 1]

    for _ in range(quality.STEPS):
        _, classes, last = edge()
        core = x[classes <= last]
        mean = core.mean(axis=0)
        inverse = np.linalg.inv((core.T @ core) / len(core) - np.outer(mean, mean) + np.diag(floors**2))
    d, _, last = edge()
    return d * quality.EDGE / max(2 ** ((last + 1) / quality.CLASSES) - 1, quality.EDGE)


def test_robust_distances_agree_with_numpy_and_reject_junk(spark):
    draw = random.Random(5)
    rows = []
    for i in range(300):
        text = prose(draw.randint(60, 200), i)
        if i % 7 == 0:
            text = text.replace(" ", "%%% ")
        rows.append((i, text, "en", "s", len(text), None, "x", 7, 1))
    found = quality.judged(spark.createDataFrame(rows, SCHEMA)).orderBy("id").collect()
    judged = [r for r in found if not r["base_failed"]]
    assert len(judged) > 250
    expected = brute_verdicts([[r[f] for f in quality.FEATURES] for r in judged])
    assert np.allclose([r["distance"] for r in judged], expected, rtol=1e-6, atol=1e-9)
    assert {r["id"] for r in judged if not r["kept"]} == {r["id"] for r in judged if r["id"] % 7 == 0}


def test_small_and_null_cells_use_wider_estimates(spark):
    rows = [(i, prose(80, i), [None, "en", "fr"][i % 3], f"s{i % 40}" if i % 5 else None, 1, None, "x", 7, 1) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = quality.judged(docs).collect()
    assert len(found) == 120 and all(r["kept"] or r["base_failed"] for r in found)
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in found)


def test_a_row_is_judged_in_its_own_language_even_where_id_and_text_repeat(spark):
    """Marks after every word are usual in one language and junk in the other."""
    marked = lambda i: prose(120, i).replace(" ", "%%% ")
    rows = [(i, prose(120, i), "en", "s", 1, None, "x", 7, 1) for i in range(250)]
    rows += [(1000 + i, marked(i), "xx", "s", 1, None, "x", 7, 1) for i in range(250)]
    rows.append((1003, marked(3), "en", "s", 1, None, "y", 7, 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = [(r["doc_id"], r["lang"]) for r in quality.accepted(docs).collect()]
    assert (1003, "xx") in kept and (1003, "en") not in kept and len(kept) > 480


def test_quality_of_nothing(make_docs):
    assert quality.judged(make_docs([])).count() == 0 and quality.accepted(make_docs([])).count() == 0


PAGES = [
    (1, "http://a/1?x=%0A y: z", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (3, "http://a/3\r\nInjected: yes", "é\r\n\r\nWARC/1.1\r\n" * 5000),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (None, "http://a/6", "<p>same</p>"),
    (1, "http://a/1", "<p>same</p>"),
    (7, "http://a/7", "own"),
]


def test_captures_come_back_whole(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, kind string").repartition(3)
    rows = warc.round_trip(pages).collect()
    assert len(rows) == len(PAGES)
    first = {}
    for i, _, h in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(h or "", i)
    payloads = collections.defaultdict(set)
    for i, _, h in PAGES:
        payloads[i].add((h or "").encode())
    for r in rows:
        response, page = r["response"], r["metadata"]["page_id"]
        (data,) = payloads[page]
        origin = first[data.decode()]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (response["payload_bytes"], response["payload_digest"]) == (len(data), digest)
        assert (response["kind"], response["refers_to"]) == (("response", None) if origin == page else ("revisit", origin))
        assert (response["payload"] is None) == (origin != page)
        if origin == page:
            assert bytes(response["payload"]) == data and response["found_digest"] == digest
        assert (r["n_request"], r["n_metadata"]) == (1, 1) and r["request"]["url"] == r["url"]
    assert {r["url"] for r in rows} == {u or "" for _, u, _ in PAGES}


def test_short_payloads_can_all_be_responses(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = collections.Counter(r["response"]["kind"] for r in warc.round_trip(pages, least_bytes=100).collect())
    assert kinds == {"response": len(PAGES)}


def test_lost_records_leave_gaps_not_crashes(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    manifest = warc.write(pages, shared_folder(spark, "warc-test"))
    found = stored(warc.records(spark, manifest), "warc-test").filter("kind <> 'request'")
    rows = warc.captures(found).collect()
    assert len(rows) == len(PAGES) and all(r["request"] is None and r["n_request"] == 0 for r in rows)


def test_no_pages_no_captures(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_languages(spark):
    draw = random.Random(1)
    alphabets = {"aa": "abcde", "bb": "vwxyz", "cc": "éèçàù"}
    rows = []
    for i in range(180):
        lang = list(alphabets)[i % 3]
        text = " ".join("".join(draw.choices(alphabets[lang], k=5)) for _ in range(20))
        rows.append((i, text, lang if i % 4 else None, None, 1, None, "x", 7, 1))
    rows += [(500, None, "aa", None, 1, None, "x", 7, 1), (501, " 12 !!", "bb", None, 1, None, "x", 7, 1)]
    rows += [(None, "abc abd", "aa", None, 1, None, "x", 7, 1), (502, "abcde " * 300_000, None, None, 1, None, "x", 7, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["id"]: r for r in language.identify(docs).collect()}
    assert len(found) == len(rows)
    wrong = [i for i in range(180) if found[i]["lang_pred"] != list(alphabets)[i % 3]]
    assert not wrong
    for i in (500, 501):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[None]["lang_pred"] == found[502]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in found.values())


def test_very_many_labels_and_one_row_very_often(spark, monkeypatch):
    """The most frequent labels are learned; a third of all rows alike count once in the sample."""
    draw = random.Random(2)
    word = lambda letters: " ".join("".join(draw.choices(letters, k=5)) for _ in range(20))
    rows = [(3 * i, word("abcde"), "aa") for i in range(60)] + [(3 * i + 900, word("vwxyz"), "bb") for i in range(60)]
    rows += [(5, "lmnop mnopl", "aa")] * 120 + [(i + 5000, word("abcde"), f"dirt{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    monkeypatch.setattr(language, "LABELS", 2)
    found = language.identify(docs).collect()
    assert len(found) == len(rows) and {r["lang_pred"] for r in found} == {"aa", "bb"}
    assert all(r["lang_pred"] == "bb" for r in found if 900 <= r["id"] < 1200)


def test_languages_of_nothing_and_without_labels(make_docs):
    assert language.identify(make_docs([])).count() == 0
    found = language.identify(make_docs([(1, "some text"), (2, None)], lang=None)).collect()
    assert {r["lang_pred"] for r in found} == {"und"}


@pytest.mark.parametrize("size", [5, 40])
def test_counts_of_long_texts_come_in_stretches(monkeypatch, size):
    text = prose(200, 9) + " é ß"
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "STRETCH", size)
    assert (language.gram_counts(text) == whole).all()

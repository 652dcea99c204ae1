import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarlens.llm import licenses
from tests.llm.conftest import LONG

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(text, phrases):
    words = WORDS.findall(text.translate(LOWER))
    places = []
    for phrase, label in phrases.items():
        p = phrase.split()
        places += [(label, i, i + len(p)) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


@pytest.fixture(scope="module")
def scan():
    return licenses.scanner(licenses.PHRASES, licenses.TEMPLATES)


PIECES = sorted({w for p in licenses.PHRASES for w in p.split()} | {"x", "État", "license,", "BY-NC"})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES + list(licenses.PHRASES)), max_size=30))
def test_places_against_brute_force(scan, pieces):
    text = " ".join(pieces)
    n, places, _ = scan(text)
    assert (n, sorted(places)) == brute_force(text, licenses.PHRASES)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=25), st.lists(st.text("ab", min_size=1, max_size=4), min_size=1, max_size=4, unique=True))
def test_overlapping_phrases(text, phrases):
    marks = {" ".join(p): p for p in phrases}
    scan = licenses.scanner(marks, {"t": "a b a b b a"})
    n, places, _ = scan(" ".join(text))
    assert (n, sorted(places)) == brute_force(" ".join(text), marks)


def test_matching_statistics_chain_over_gaps(scan):
    words = licenses.TEMPLATES["bsd"][0].split()
    text = "intro " + " ".join(words[:9]) + " (inserted note) " + " ".join(words[9:]) + " tail"
    _, _, spans = scan(text)
    assert [(s[0], s[1], s[2]) for s in spans] == [("bsd", 1, 1 + len(words) + 2)]
    assert spans[0][3] == 1.0
    # a short part of a template is no span
    assert scan(" ".join(words[:6]))[2] == []


def test_scattered_words_in_wrong_order_are_no_span(scan):
    words = licenses.TEMPLATES["gpl"][0].split()
    parts = [words[i : i + 3] for i in range(0, len(words), 3)]
    text = " ".join(w for part in reversed(parts) for w in part)
    assert all(s[3] < 1 for s in scan(text)[2])


def test_a_repeated_run_does_not_break_a_chain(scan):
    """Words of a template once more in its middle, and a run that stands at two places of it."""
    words = licenses.TEMPLATES["apache-2"][0].split()
    text = " ".join([*words[:12], "licensed under the", *words[12:]])
    spans = [s for s in scan(text)[2] if s[0] == "apache-2"]
    assert spans == [("apache-2", 0, len(words) + 3, 1.0)]
    twice = "one two three x y z one two three u v w"
    both = licenses.scanner({}, {"t": twice})
    assert both(f"a {twice} b")[2] == [("t", 1, 13, 1.0)]
    assert both("x y z one two three u v w")[2] == [("t", 0, 9, 9 / 12)]
    assert both(f"{twice} {twice}")[2] == [("t", 0, 12, 1.0), ("t", 12, 24, 1.0)]


def test_every_paragraph_is_found(scan):
    for label, texts in licenses.TEMPLATES.items():
        for text in texts:
            found = [s for s in scan(f"some words {text.upper()} and more")[2] if s[0] == label]
            assert (label, 2, 2 + len(text.split()), 1.0) in found
    notice = licenses.TEMPLATES["mit"][2].replace("as is", '"AS IS",').replace("merchantability", "MERCHANTABILITY,\n")
    assert [s[0] for s in scan(notice)[2]] == ["mit"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=20), st.lists(st.sampled_from("abc"), min_size=3, max_size=12))
def test_chains_are_within_bounds(text, template):
    """Covers are shares, spans of a template don't overlap, and a whole copy is found whole."""
    scan = licenses.scanner({}, {"t": " ".join(template)})
    spans = scan(" ".join(text))[2]
    assert all(0.6 <= s[3] <= 1 and 0 <= s[1] < s[2] <= len(text) for s in spans)
    assert all(a[2] <= b[1] for a, b in zip(spans, spans[1:]))
    whole = scan(" ".join([*text, "q", *template, "q", *text]))[2]
    assert max(s[3] for s in whole) == 1.0


def test_odd_rows(odd):
    rows = licenses.scan_licenses(odd).collect()
    assert len(rows) == odd.count()
    for row in rows:
        assert (row["n_words"], row["places"]) == brute_force(row["text"] or "", licenses.PHRASES)
    assert max(r["n_words"] for r in rows) == len(LONG.split())
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


def test_clashing_columns(odd):
    df = odd.withColumnRenamed("more", "SPANS")
    columns = [c.lower() for c in licenses.scan_licenses(df).columns]
    assert columns.count("spans") == 1


def test_query(spark):
    got = licenses.op10_licenses(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for row in got:
        n, places = brute_force(docs[row["doc_id"]] or "", licenses.PHRASES)
        starts = [p[1] for p in places]
        assert (row["n_words"], row["n_base"]) == (n, len(places))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({p[0] for p in places}))
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) | {""}
        assert 0 <= row["score"] <= 1

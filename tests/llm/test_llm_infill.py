"""Rearranged texts against slices of strings."""

from collections import Counter
from hashlib import sha256

import pytest
from conftest import ODD
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from tidemark.llm import infill
from tidemark.llm.infill import Frames

TEXT = st.text(alphabet=st.sampled_from("ab<PSM> \né🙂"), max_size=40)


def choice(doc_id, text, seed=1):
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in infill.MARKS) or h[2] % 100 >= 90:
        return "plain", None, None, text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h[3] % 100 < 20:
        return "spm", first, second - first, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", first, second - first, f"<P>{prefix}<S>{suffix}<M>{middle}"


def digest(text):
    return sha256(text.encode()).hexdigest()


def expected(rows):
    found = []
    for doc_id, text in rows:
        form, prefix, middle, output = choice(doc_id, text or "")
        found.append((doc_id, len(text or ""), form, prefix, middle, digest(output), digest(text or "")))
    return Counter(found)


@settings(max_examples=150, deadline=None)
@drawn(TEXT, st.integers(1, 7), st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm", "plain"]))
def test_frames_are_cut_moved_and_rebuilt(text, units, a, b, form):
    kept, infill.FRAME_UNITS = infill.FRAME_UNITS, units
    try:
        frames = Frames.of(text)
        assert frames.units == len(text) and len(frames.data) == -(-len(text) // units)
        first, second = sorted((a % (len(text) + 1), b % (len(text) + 1)))
        assert b"".join(frames.stream(first, second)).decode() == text[first:second]
        part = frames.part(first, second)
        assert b"".join(part.stream()).decode() == text[first:second]
        output = infill.arranged(frames, form, first, second)
        whole = b"".join(output.stream()).decode()
        parts = {"<P>": text[:first], "<M>": text[first:second], "<S>": text[second:]}
        assert whole == (text if form == "plain" else "".join(m + parts[m] for m in infill.ORDER[form]))
        if form == "plain" or not any(mark in text for mark in infill.MARKS):
            assert b"".join(infill.restored(output, form)).decode() == text
        if "<P>" in text[first:]:
            assert frames.find("<P>", first) == text.index("<P>", first)
    finally:
        infill.FRAME_UNITS = kept


def test_only_frames_with_a_cut_are_packed_anew(monkeypatch):
    text = "".join(chr(97 + i % 26) for i in range(20 * infill.FRAME_UNITS + 5))
    frames = Frames.of(text)
    opened = []
    monkeypatch.setattr(infill, "_text", lambda f, real=infill._text: opened.append(f) or real(f))
    output = infill.arranged(frames, "psm", 3 * infill.FRAME_UNITS + 1, 9 * infill.FRAME_UNITS)
    assert len(opened) == 2  # one cut lies inside a frame, which both of its sides need
    assert len([d for d in output.data if d in set(frames.data)]) == len(frames.data) - 1


def test_a_mark_that_is_missing():
    with pytest.raises(ValueError):
        Frames.of("no mark").find("<P>", 0)


def test_odd_documents(documents):
    found = infill.digests(infill.store(documents)).collect()
    assert Counter(map(tuple, found)) == expected(ODD)


def test_marks_in_texts_and_many_ids(spark):
    long = "é🙂" * 9000
    rows = [(i, t) for i in range(120) for t in (f"text {i} é🙂", long, "a<P>b", "<S", "<M>", "<P", "x")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    frames = infill.store(documents)
    assert Counter(map(tuple, infill.digests(frames).collect())) == expected(rows)
    outputs = infill.texts(infill.transform(frames)).select("doc_id", "form", "text").collect()
    assert Counter(map(tuple, outputs)) == Counter(
        (i, choice(i, t)[0], choice(i, t)[3]) for i, t in rows
    )
    assert {r["form"] for r in outputs} == {"plain", "psm", "spm"}


def test_another_seed(spark):
    documents = spark.createDataFrame([(i, "some text") for i in range(50)], "doc_id bigint, text string")
    found = infill.chosen(infill.store(documents), seed=7).select("doc_id", "form", "prefix_chars").collect()
    assert {tuple(r) for r in found} == {(i, *choice(i, "some text", 7)[:2]) for i in range(50)}


def test_no_rows(nothing):
    assert infill.digests(infill.store(nothing)).count() == 0

"""Line, paragraph and chunk deduplication against plain scans in Python."""

import hashlib
import random
import re

import pytest

from cohortloom.llm import chunks, lines

SAME = "one line that many documents share"


def corpus():
    rng = random.Random(11)
    pool = [f"line number {k} has some words é" for k in range(30)] + [SAME, "short", "", "\t", SAME.upper() + "  "]
    pairs = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for k in range(60)]
    body = "\n".join(f"body line {k}" for k in range(30))
    pairs += [(99, body)] + [(100 + k, f"head {k}\n{body}") for k in range(20)] + [(200, None), (201, "")]
    return pairs


def plain_units(pairs, paragraphs=False):
    seen, removed = {}, []
    for i, text in sorted(pairs):
        for k, (a, b, unit) in enumerate(lines.units(text or "", paragraphs)):
            assert (text or "")[a:b] == unit
            words = unit.lower().split()
            if len(words) >= lines.MIN_WORDS:
                first = seen.setdefault(tuple(words), (i, k))
                if first != (i, k):
                    removed.append((i, k, a, b, *first))
    return sorted(removed)


@pytest.mark.parametrize("paragraphs", [False, True])
def test_units(documents, paragraphs):
    rows = lines.repeated_units(documents(corpus()), paragraphs=paragraphs).collect()
    found = sorted((r.doc_id, r.unit, r.start, r.end, r.keep_id, r.keep_unit) for r in rows)
    assert found == plain_units(corpus(), paragraphs)


def plain_sentences(pairs, least):
    """Whole lines, and sentences of the lines that stay, by one scan in order."""
    seen, removed = {}, []
    for i, text in sorted(pairs):
        for k, (a, _, line) in enumerate(lines.units(text or "")):
            bodies, at = [], 0
            for m in re.finditer(r"[.!?]([ \t]+)", line):
                bodies.append((at, m.start(1)))
                at = m.end()
            bodies = [(x, y) for x, y in [*bodies, (at, len(line))] if line[x:y].split()]
            parts = [(0, 0, len(line))] + ([(p, x, y) for p, (x, y) in enumerate(bodies, 1)] if len(bodies) > 1 else [])
            gone = False
            for part, x, y in parts:
                words = tuple(line[x:y].lower().split())
                if len(words) < (least if part else 1):
                    continue
                first = seen.setdefault(words, (i, k, part))
                if first != (i, k, part) and not (part and gone):
                    removed.append((i, k, part, a + x, a + y, *first))
                    gone = gone or not part
    return sorted(removed)


def test_sentences(documents):
    rng = random.Random(5)
    stock = ["One sentence of some length.", "Another one is here!", "Is this short?", "No.", "", "and an open end"]
    pairs = [(k, "\n".join(" ".join(rng.choice(stock) for _ in range(rng.randrange(5))) + rng.choice(["", " ", "\t "]) for _ in range(4))) for k in range(40)]
    pairs += [(100, None), (101, ""), (102, "One sentence of some length. " * 20_000), (103, "No.  \tNo. ")]
    for least in (1, 3):
        rows = lines.repeated_units(documents(pairs), sentence_words=least).collect()
        found = sorted((r.doc_id, r.unit, r.part, r.start, r.end, r.keep_id, r.keep_unit, r.keep_part) for r in rows)
        assert found == plain_sentences(pairs, least)


def test_cut_sentences(documents):
    docs = documents([(1, "This is one sentence. And two.\nend"), (2, "Here: new. This is one sentence.\nlast")])
    kept = lines.cut_repeats(docs, sentence_words=3).collect()
    assert {r.doc_id: r.text for r in kept} == {1: "This is one sentence. And two.\nend", 2: "Here: new. \nlast"}


def test_cut(documents):
    docs = documents([(1, f"{SAME}\nkeep"), (2, f"a\n{SAME}\nb\n{SAME}"), (3, SAME), (4, None)])
    rows = lines.cut_repeats(docs).collect()
    assert {r.doc_id: r.text for r in rows} == {1: f"{SAME}\nkeep", 2: "a\nb\n", 3: "", 4: None}


def test_cut_goes_by_row(documents):
    pairs = [(None, SAME), (None, f"x\n{SAME}"), (1, f"{SAME}\none"), (1, f"two\n{SAME}\nrest"), (2, f"{SAME}")]
    docs = documents(pairs).withColumnsRenamed({"lang": "_spans", "source": "row", "n_chars": "spans"})
    cut = lines.cut_repeats(docs)
    assert cut.dtypes == docs.dtypes
    found = sorted(((r.doc_id, r.text) for r in cut.collect()), key=str)
    firsts = [f"{SAME}\none", "one"]  # either row with id 1 may be the first of the two
    assert found in [
        sorted([(None, ""), (None, "x\n"), (1, a), (1, b), (2, "")], key=str)
        for a, b in ((firsts[0], "two\nrest"), (firsts[1], f"two\n{SAME}\nrest"))
    ]


def test_very_long_texts(documents):
    line = "word " * 300_000
    docs = documents([(1, f"{line}\nown"), (2, f"first\n{line}"), (3, "z" * 2_000_000), (4, "z" * 2_000_000 + "\nend"), (5, "")])
    kept = {r.doc_id: r.text for r in lines.cut_repeats(docs).collect()}
    assert kept == {1: f"{line}\nown", 2: "first\n", 3: "z" * 2_000_000, 4: "end", 5: ""}


def plain_chunks(pairs):
    seen, removed = {}, []
    for i, text in sorted(pairs):
        text = text or ""
        parts = text.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in parts]
        rolling = [sum(31**j * h[k - j] for j in range(3) if k >= j) for k in range(len(parts))]
        runs, open_ = [], []
        for k in range(len(parts)):
            open_.append(k)
            still = rolling[k] in rolling[max(0, k - 2) : k]
            if (rolling[k] % 1_000_003 % 4 == 0 or still) and len(open_) >= 2 or k == len(parts) - 1:
                runs.append(open_)
                open_ = []
        for c, run in enumerate(runs):
            piece = "\n".join(parts[k] for k in run)
            if len(run) >= 2:
                first = seen.setdefault(piece, (i, c))
                if first != (i, c):
                    removed.append((i, c, run[0], len(run), piece, *first))
    return sorted(removed)


def test_chunks(documents):
    pairs = corpus()
    text = dict(pairs)
    rows = chunks.repeated_chunks(documents(pairs)).collect()
    found = sorted(
        (r.doc_id, r.chunk, r.line, r.n_lines, text[r.doc_id][r.start : r.end], r.keep_id, r.keep_chunk) for r in rows
    )
    assert found == plain_chunks(pairs)
    assert len({r.doc_id for r in rows if r.doc_id >= 100}) == 20  # found again behind another first line


def test_periodic_lines_are_cut(documents):
    pairs = [(1, "\n".join(["same"] * 40)), (2, "other\n" + "\n".join(["one", "two"] * 50)), (3, "\n".join(["same"] * 31))]
    rows = chunks.repeated_chunks(documents(pairs)).collect()
    assert sorted((r.doc_id, r.chunk, r.line, r.n_lines) for r in rows) == sorted(x[:4] for x in plain_chunks(pairs))
    lost = {i: sum(r.n_lines for r in rows if r.doc_id == i) for i in (1, 2, 3)}
    assert lost[1] > 30 and lost[2] > 90 and lost[3] > 25


def test_empty_repeated_and_missing(documents):
    assert lines.repeated_units(documents([])).count() == 0
    assert chunks.repeated_chunks(documents([])).count() == 0
    rows = lines.repeated_units(documents([(1, SAME), (1, SAME), (None, SAME)])).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "None"] and {r.keep_id for r in rows} == {1}
    long = "\n".join(f"line {k} of a very long text" for k in range(20_000))
    removed = chunks.repeated_chunks(documents([(1, long), (2, long), (None, long)])).collect()
    assert {r.keep_id for r in removed} == {1}

"""Line deduplication of short lines and of lines without spaces."""

from cohortloom.llm import lines


def test_every_line_counts(documents):
    wide = "这是一行很长的中文文本没有空格"
    docs = documents([(1, f"Menu\n{wide}\n\n"), (2, f"menu \n\nx\n{wide}"), (3, "Menu")])
    rows = lines.repeated_units(docs).collect()
    assert sorted((r.doc_id, r.unit, r.keep_id, r.keep_unit) for r in rows) == [(2, 0, 1, 0), (2, 3, 1, 1), (3, 0, 1, 0)]
    assert lines.repeated_units(docs, min_words=2).count() == 0

"""Rows with nulls, empty and long texts, copies and repeated rows, for the tests of the text operators."""

BASE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank. "
STORY = " ".join(f"word{i} follows another{i % 7} in passage{i * 3}." for i in range(60))
DOCS = [
    (1, STORY),
    (2, STORY),
    (3, STORY.replace("word7 ", "changed ")),
    (4, "A short start.\n" + STORY + "\nAnd an end of its own that is not shared."),
    (5, None),
    (6, ""),
    (7, " \t\n\x0b "),
    (8, "single"),
    (9, "Single"),
    (10, "again " * 300),
    (11, BASE * 3),
    (12, BASE + "Something else entirely, written once, stands here. " * 2),
    (13, "\n".join(f"Line {i} of a long document with its own words {i * i}." for i in range(3000))),
    (13, "\n".join(f"Line {i} of a long document with its own words {i * i}." for i in range(3000))),
    (14, "  Ünïcödé wörds ÀÉ. 東京 タワー x  <|endoftext|>  it's  'll  1234 ###\r\n tail "),
    (None, STORY),
    (None, "no key here"),
]

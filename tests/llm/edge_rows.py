"""Rows that every operator has to handle."""

LONG_WORD = "ab" * 10_000
LONG_TEXT = "lorem ipsum dolor " * 8_000

#: doc_id, text, source: nulls, empty and blank texts, very long ones, repeated rows, equal ids and equal texts.
EDGE_ROWS = [
    (1, "one two three four five six seven", "a"),
    (2, "one two three four five six seven", None),
    (3, None, "a"),
    (4, "", "b"),
    (5, " \t\n ", "b"),
    (6, LONG_WORD, "c"),
    (7, LONG_TEXT, "c"),
    (8, "naïve 中文   x <|endoftext|> it's", "ä"),
    (8, "naïve 中文   x <|endoftext|> it's", "ä"),
    (8, "another text under the same id", "ä"),
    (None, "no id here", "a"),
    (None, None, None),
    (-3, "a", "a"),
]

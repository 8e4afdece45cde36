"""Names that several of these tests share."""

import os

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; they must not mind them in their input.
CLASHES = (
    "size", "source_size", "target", "hash", "group", "row", "slot", "shard", "digest", "n", "unit", "key",
    "spans", "label", "score", "statistics", "content", "ids", "sample", "block", "_of", "_times", "_id", "_first",
)

LONG = "tall tree " * 60_000 + "x" * 50_000
AWKWARD = [
    (1, "one two three four five six"),
    (2, "one two three four five six"),
    (2, "one two three four five six"),
    (3, ""),
    (4, None),
    (None, "one two three four five six"),
    (5, " \t\n "),
    (6, "é ß 漢字 🙂 \u0000 ▁ a  b\r\n "),
    (7, LONG),
    (8, "one"),
]

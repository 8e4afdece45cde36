"""Secret scans: a keyword automaton finds places, anchored patterns and checksums decide.

One pass of an Aho-Corasick automaton over each text reports the places of keywords. A
pattern is then matched only there, anchored at the hit. Kinds with a checksum or an
embedded structure are kept only if that holds.
"""

from __future__ import annotations

import base64
import binascii
import itertools
import json
import re
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back

# The base kinds in listed order, then the kinds this scan adds.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]++")
# Breaks may be written as the escapes \r and \n, as in code and JSON. Lines "Name: value" may come first.
_BREAK = r"(?:\s|\\+[rn])"
_HEADER = rf"[A-Za-z][A-Za-z0-9-]*+:(?:[^\r\n\\-]|-(?!----)|\\++(?![rn]))*+{_BREAK}++"
_BODY = r"(?:[A-Za-z0-9+/=\s]++|\\+[rn/])*+"
# A label of any length ends in one of these: "RSA PRIVATE KEY", "PGP PRIVATE KEY BLOCK".
_LABEL = r"[A-Z0-9 ]*+(?:(?<=PRIVATE KEY)|(?<=PRIVATE KEY BLOCK))-----"
PEM = re.compile(rf"-----BEGIN {_LABEL}{_BREAK}++(?:{_HEADER})*+{_BODY}-----END {_LABEL}")

ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
GITHUB_KEYWORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

# A run of 16 hexadecimal digits holds such a window at every place that is a multiple of 4.
HEX_WINDOW = 4
HEX_DIGITS = frozenset("0123456789abcdef")

_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def _automaton():
    """Keywords in lower case; the value is the kind and the keyword's length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    words = {"assign": ASSIGN_KEYWORDS, "access": ("akia",), "github": GITHUB_KEYWORDS}
    words |= {"npm": ("npm_",), "jwt": ("eyj",), "pem": ("-----begin ",)}
    for kind, keywords in words.items():
        for word in keywords:
            found.add_word(word, (kind, len(word)))
    for window in itertools.product(sorted(HEX_DIGITS), repeat=HEX_WINDOW):
        found.add_word("".join(window), ("hex", HEX_WINDOW))
    found.make_automaton()
    return found


def _checksum_holds(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the others in base 62."""
    value, digits = zlib.crc32(match[1].encode("ascii")), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == match[2]


def _header_holds(match: re.Match) -> bool:
    """The first part is an object in base64 that names an algorithm."""
    part = match[1]
    try:
        header = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header


def _holds(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return match.end(2) - match.start(2) >= 12
    if kind == "access":
        return match.end() - match.start() >= 18
    if kind in ("github", "npm"):
        return _checksum_holds(match)
    if kind == "jwt":
        return _header_holds(match)
    return True


_PATTERNS = {"assign": ASSIGN, "access": ACCESS, "github": GITHUB, "npm": NPM, "jwt": JWT, "pem": PEM}


def find(text: str | None) -> list[Span]:
    """(kind, start, end) of all secrets, by start and then by kind as listed.

    Time grows with the length of the text, whatever it holds: no run is scanned anew at
    each of its hits.

    Offsets are code points, ends exclusive. Spans of one kind do not overlap, the
    leftmost wins; spans of different kinds may. Null and empty texts hold none.
    """
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # some letters lower to two
        low = text.translate(_ASCII_LOWER)
    spans: list[Span] = []
    done = dict.fromkeys(KINDS, 0)
    hits = [(last - value[1] + 1, value[0]) for last, value in _automaton().iter(low)]
    hits.sort()
    for start, kind in hits:
        if start < done[kind]:
            continue
        if kind == "hex":
            match = _hex_run(text, start, done)
            if match and match.end() - match.start() >= 16:
                spans.append((kind, match.start(), match.end()))
            continue
        match = _PATTERNS[kind].match(text, start)
        if match:
            done[kind] = match.end()
            if _holds(kind, match):
                spans.append((kind, match.start(), match.end()))
        elif kind == "jwt" and text.startswith("eyJ", start):
            # What follows the run decides; it is the same for every other hit in the run.
            done[kind] = JWT_RUN.match(text, start).end()
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans


def _hex_run(text: str, start: int, done: dict[str, int]) -> re.Match | None:
    """The whole run of digits at a hit; the automaton ignores case, the run does not."""
    if text[start] not in HEX_DIGITS:
        return None
    first = start
    while first > done["hex"] and text[first - 1] in HEX_DIGITS:
        first -= 1
    match = HEX.match(text, first)
    done["hex"] = match.end()
    return match


def redact(text: str | None) -> str | None:
    """The text with every span, overlapping ones as one, replaced by ``[kind]``."""
    out, at = [], 0
    for kind, start, end in find(text):
        if start >= at:
            out.append(f"{text[at:start]}[{kind}]")
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def scan(docs: DataFrame, text: str = "text", name: str = "spans") -> DataFrame:
    """Add an array of (kind, start, stop); null and empty texts have an empty one.

    Rows, repeated or not, stand by themselves, and texts of any length are scanned whole.
    Other columns stay as they are; a column of the new name is replaced. An empty table
    stays empty.
    """

    @F.pandas_udf("array<struct<kind:string,start:int,stop:int>>")
    def spans(texts: pd.Series) -> pd.Series:
        give_back()
        return texts.map(lambda t: [{"kind": k, "start": a, "stop": b} for k, a, b in find(t)])

    return docs.withColumn(name, spans(F.col(f"`{text}`")))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with secrets masked in the text.

    Null stays null and empty texts stay empty; repeated rows are masked alike. Very long
    texts are masked whole, other columns stay, and an empty table stays empty.
    """

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        give_back()
        return texts.map(redact)

    return docs.withColumn(text, masked(F.col(f"`{text}`")))


def joined(spans: Column) -> Column:
    """``kind:start:stop``, comma-joined."""
    each = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    )
    return F.array_join(each, ",")


def report(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: counts of the base kinds, their digest, all spans.

    Null and empty texts count 0 and have the digest of nothing. Rows without an id and
    repeated rows each get their row. Very long texts are scanned whole. An empty table gives
    an empty result; columns other than ``doc_id`` and ``text`` are ignored.
    """
    scanned = scan(docs.select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return scanned.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )

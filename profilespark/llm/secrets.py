"""Secret scan: a keyword automaton finds where to look, anchored patterns look, checksums decide.

One pass over whole texts and no shuffle. An Aho-Corasick automaton over the lower-cased text
yields keyword hits; a pattern is matched only at a hit. Runs of hex digits have no keyword:
every eighth character is probed, and only places with four hex probes in a row are matched.
Of the added kinds, tokens that embed a CRC-32 are kept only if it fits the rest of the token,
and web tokens only if their first part decodes to a JSON object.

Null and empty texts have no spans. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from profilespark.llm.text import per_text, sliced

#: kinds in the order that sorts spans with the same start
KINDS = ("assign", "access", "hex", "hosting", "registry", "web")
BASE_KINDS = KINDS[:3]

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
# Prefixes of tokens whose last six characters are the CRC-32 of the thirty before, in base 62.
HOSTING = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
REGISTRY = ("npm_",)
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
WEB = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_STEP = 8
_HEX_BYTE = np.zeros(256, dtype=bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True


def _automaton() -> ahocorasick.Automaton:
    kinds = dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign")
    kinds |= {"akia": "access", "eyj": "web"} | dict.fromkeys(HOSTING, "hosting") | dict.fromkeys(REGISTRY, "registry")
    automaton = ahocorasick.Automaton()
    for word, kind in kinds.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


_KEYWORDS = _automaton()


def base62(number: int, width: int) -> str:
    out = ""
    while number:
        number, digit = divmod(number, 62)
        out = _DIGITS[digit] + out
    return out.rjust(width, "0")


def _checksum_fits(match: re.Match) -> bool:
    return base62(zlib.crc32(match[1].encode()), 6) == match[2]


def _is_web_token(match: re.Match) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(match[1] + "=" * (-len(match[1]) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and "alg" in head


#: kind -> (pattern matched at a hit, test of the match)
_RULES = {
    "assign": (ASSIGN, lambda m: len(m[1]) >= LEAST["assign"]),
    "access": (ACCESS, lambda m: len(m[0]) >= LEAST["access"]),
    "hosting": (CHECKED, _checksum_fits),
    "registry": (CHECKED, _checksum_fits),
    "web": (WEB, _is_web_token),
}


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least 32 hex digits; each covers four probes in a row."""
    if text.isascii():
        data = np.frombuffer(text.encode(), dtype=np.uint8)
    else:  # one byte a code point; what is not ASCII becomes a byte that is no digit
        data = np.frombuffer(text.encode("ascii", "replace"), dtype=np.uint8)
    probes = _HEX_BYTE[data[_STEP - 1::_STEP]]
    if len(probes) < 4:
        return
    four = np.flatnonzero(probes[:-3] & probes[1:-2] & probes[2:-1] & probes[3:])
    done = 0
    for place in (four * _STEP + _STEP - 1).tolist():
        if place < done:
            continue
        end = HEX.match(text, place).end()
        start = place
        while start and text[start - 1] in "0123456789abcdef":
            start -= 1
        done = end
        if end - start >= LEAST["hex"]:
            yield start, end


def find(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then kind as listed."""
    if not text:
        return []
    # A-Z only: lower() of other letters may change the length
    lower = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    hits = sorted((last + 1 - size, kind) for last, (kind, size) in _KEYWORDS.iter(lower))
    spans, done = [], dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start < done[kind]:  # inside the match before, as for a scan from left to right
            continue
        pattern, holds = _RULES[kind]
        match = pattern.match(text, start)
        if match:
            done[kind] = match.end()
            if holds(match):
                spans.append((start, match.end(), kind))
    spans += [(start, end, "hex") for start, end in _hex_runs(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and `spans array<struct<kind, start, end>>`."""

    def start():
        return lambda texts, _: ([[{"kind": k, "start": s, "end": e} for s, e, k in find(t)] for t in texts],)

    return per_text(docs, start, "spans array<struct<kind:string,start:bigint,end:bigint>>", id_col, text_col)


def redact(text: str | None) -> str | None:
    """The text with every secret replaced by the name of its kind in brackets; overlapping spans are one."""
    if not text:
        return text
    parts, done = [], 0
    for start, end, kind in find(text):
        if start >= done:
            parts += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]


def redacted(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets replaced, and the length column brought up to date."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, names.index(text_col)):
            texts = [redact(t) for t in batch.column(names.index(text_col)).to_pylist()]
            arrays = list(batch.columns)
            arrays[names.index(text_col)] = pa.array(texts, pa.string())
            if length_col in names:
                kind = batch.column(names.index(length_col)).type
                arrays[names.index(length_col)] = pa.array([None if t is None else len(t) for t in texts], kind)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(run, docs.schema)


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def digest_hash(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(digest(spans).encode()).hexdigest()


def summary(docs: DataFrame) -> DataFrame:
    """The digest columns: counts of the base kinds, the hash of the base spans, and all spans as text."""

    def columns(texts: list[str | None], _ids) -> list[list]:
        spans = [find(t) for t in texts]
        base = [[s for s in found if s[2] in BASE_KINDS] for found in spans]
        counts = [[sum(s[2] == kind for s in found) for found in base] for kind in BASE_KINDS]
        return [*counts, [digest_hash(found) for found in base], [digest(found) for found in spans]]

    return per_text(docs, lambda: columns, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")

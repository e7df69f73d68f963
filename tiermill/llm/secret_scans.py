"""Secret scans: an Aho-Corasick automaton finds keywords, anchored expressions look only at its hits, and checksums
inside a candidate decide where a kind has one.

Runs of hexadecimal digits have no keyword. Every 24 characters hold three neighbouring places of every eighth, so
a look at each eighth character finds all places where such a run can be.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.rows import map_texts

#: Kinds in the order of output at one place. The first three are the base.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
#: Keywords in lower case, and the kind each may begin.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
    "eyj": "jwt", "-----begin ": "pem",
}
ANCHORED = {
    "assign": re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)"),
    "pem": re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
}
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
STEP = 8
HEX_RUN, HEX_SAMPLES = re.compile(f"[0-9a-f]{{{LEAST_HEX},}}"), re.compile(f"[0-9a-f]{{{LEAST_HEX // STEP},}}")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(value: int, width: int) -> str:
    digits = ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(width, "0")


def has_checksum(body: str) -> bool:
    """The last six characters are the CRC-32 of the others in base 62."""
    return base62(zlib.crc32(body[:-6].encode()), 6) == body[-6:]


def is_header(part: str) -> bool:
    """A JSON object that names an algorithm."""
    try:
        found = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(found, dict) and "alg" in found


def holds(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= LEAST_VALUE
    if kind == "access":
        return len(match[0]) >= LEAST_ACCESS
    if kind in ("github", "npm"):
        return has_checksum(match[1])
    return kind != "jwt" or is_header(match[1])


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        words.add_word(word, (kind, len(word)))
    words.make_automaton()
    return words


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, end, place of the kind in KINDS) of all secrets, in order. Matches of a kind don't overlap."""
    # one character is longer in lower case; all others keep their places
    low = (text if text.isascii() else text.replace("İ", "I")).lower()
    starts: dict[str, list[int]] = {}
    for end, (kind, size) in automaton().iter(low):
        starts.setdefault(kind, []).append(end + 1 - size)
    found = []
    for kind, places in starts.items():
        over, number = 0, KINDS.index(kind)
        for start in sorted(places):
            # a failing candidate takes its place too, as it does for a search from left to right
            if start >= over and (match := ANCHORED[kind].match(text, start)):
                over = match.end()
                if holds(kind, match):
                    found.append((start, over, number))
    for hit in HEX_SAMPLES.finditer(text[STEP - 1 :: STEP]):
        low_end, high_end = hit.start() * STEP, hit.end() * STEP + STEP - 1
        found += [(m.start(), m.end(), 2) for m in HEX_RUN.finditer(text, low_end, min(high_end, len(text)))]
    return sorted(found, key=lambda x: (x[0], x[2]))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def work(texts: list[str]) -> dict:
    out: dict[str, list] = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
    for text in texts:
        spans = scan(text)
        for k, name in enumerate(("n_assign", "n_access", "n_hex")):
            out[name].append(sum(s[2] == k for s in spans))
        out["base_sha256"].append(hashlib.sha256(_listed([s for s in spans if s[2] < 3]).encode()).hexdigest())
        out["spans"].append(_listed(spans))
    return out


def secret_scans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end in code points, end exclusive).

    One row per row of `docs`; repeated rows and null ids are kept. A null or empty text has no secrets. Texts are
    scanned whole. Spans that begin at one place come in the order of KINDS. Other columns are not read.
    """
    return map_texts(docs, work, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", {"doc_id": F.col(id_col)}, text_col)

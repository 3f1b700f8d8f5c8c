"""Secrets in texts: assignments, access keys and hex strings by pattern, and keys and signed tokens by structure.

What looks like base64 or hex is decoded and parsed before it is reported: a private key has to be DER whose nested
lengths add up and whose fields are those of a key, or the binary form of OpenSSH; a signed token needs a header and
a payload that are JSON objects and a signature that fits the algorithm. Strings that only look random are not reported
by structure.

Every pattern takes time in proportion to the text: candidates begin where a run of their letters does, marks are found in one pass
and paired, and what a candidate is decoded up to follows from the lengths that it states itself.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrivel.llm.columns import Batches, add_column, as_bytes

#: Kinds of spans in the order in which spans of one start are listed; the first three go by pattern alone.
KINDS = ("assign", "access", "hex", "jwt", "key", "pem")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs of 16 and more are found whole, shorter ones never
# Runs of letters joined by points; three neighbouring ones may be a token whose header begins with a brace.
_CHAIN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,}+")
_BRACE = re.compile(r"e[w-z0-9_-]")
# First signs of DER, of OpenSSH's binary form, and of a PEM block in base64; the same for DER and OpenSSH in hex.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+_-])(?:M[A-I](?=[A-Za-z0-9+/_-]{20})|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi)")
_HEX_KEY = re.compile(r"(?<![0-9A-Za-z])(?:0[xX])?+((?:30|6[fF]70656[eE]737368)[0-9A-Fa-f]{30,}+)(?![0-9A-Za-z])")
# Base64 over one line or several, also with line ends that are spelled out.
_BREAK = re.compile(r"[ \t]*+\r?\n[ \t]*+|(?:\\r)?\\n")
_LINES = re.compile(rf"[A-Za-z0-9+/_-]++(?:(?:{_BREAK.pattern})[A-Za-z0-9+/_-]++)*+")
_ENDS = re.compile(r"={0,2}(?![A-Za-z0-9+/_=-])")
_REST = re.compile(r"[A-Za-z0-9+/_-]*+={0,2}")
_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}?PRIVATE KEY)-----")
_BODY = re.compile(r"[A-Za-z0-9+/=\s\\:,-]*+")
#: Bytes of the largest key; those of an RSA key of 16,384 bits are 9,300.
MAX_KEY = 1 << 15
# Something of the above may be in a text only if this is in its bytes.
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ANY = re.compile(
    rb"AKIA|-----BEGIN|[0-9a-f]{16}|b3BlbnNzaC|LS0tLS1CRU|(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]*+\.[A-Za-z0-9_-]++\."
    rb"|M[A-I][A-Za-z0-9+/_-]{20}|(?:30|6[fF]70656[eE]737368)[0-9A-Fa-f]{30}"
)
#: Signature bytes by the algorithm of a signed token; RSA signatures have the length of their key.
_SIGNED = {
    "HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES256K": {64}, "ES384": {96}, "ES512": {132},
    "EdDSA": {64, 114}, "Ed25519": {64}, "Ed448": {114}, "none": set(),
}
#: Signature bytes of an algorithm that is not known here.
_PLAUSIBLE = range(16, 4097)
_RSA = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")
_INT, _OCTETS, _OID, _SEQUENCE = 2, 4, 6, 48


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of the values that fill ``data`` exactly; None if lengths do not add up."""
    fields, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 128:
            width = size - 128
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width], "big")
            if size < 128 or size >> 8 * (width - 1) == 0:  # not the shortest form
                return None
            at += width
        if at + size > len(data):
            return None
        fields.append((tag, data[at : at + size]))
        at += size
    return fields


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are a private key: PKCS#1, PKCS#8 (plain or encrypted), SEC 1 or DSA."""
    outer = der_fields(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    fields = der_fields(outer[0][1])
    if not fields:
        return False
    tags = [tag for tag, _ in fields]
    if tags[0] == _INT and all(t == _INT for t in tags) and len(tags) in (6, 9):
        return fields[0][1] in (b"\0", b"\1") and len(fields[1][1]) >= 32
    if tags[:3] == [_INT, _SEQUENCE, _OCTETS]:
        algorithm = der_fields(fields[1][1])
        return bool(algorithm) and algorithm[0][0] == _OID and len(fields[2][1]) >= 16
    if tags[:2] == [_INT, _OCTETS] and fields[0][1] == b"\1":
        return len(fields[1][1]) >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags == [_SEQUENCE, _OCTETS]:
        algorithm = der_fields(fields[0][1])
        return bool(algorithm) and algorithm[0][0] == _OID and len(fields[1][1]) >= 32
    return False


def der_size(head: bytes) -> int | None:
    """Bytes of the sequence that begins with ``head``, by its own length."""
    if len(head) < 6 or head[0] != _SEQUENCE:
        return None
    width = head[1] - 128
    if width < 0:
        return 2 + head[1]
    return 2 + width + int.from_bytes(head[2 : 2 + width], "big") if 1 <= width <= 3 else None


def openssh_asks(data: bytes) -> int | None:
    """How many bytes a key in OpenSSH's form has that ``data`` begins with, as far as it tells: names of cipher and
    derivation, its options, then public and private parts, each with its length. None if it is no such key."""
    if not data.startswith(b"openssh-key-v1\0"):
        return None
    at = 15
    for i in range(6):
        if at + 4 > len(data):
            return at + 4
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if i == 3:  # the number of keys
            if not 1 <= size <= 16:
                return None
        elif size > MAX_KEY or (i == 0 and size > 64) or (i == 5 and (size == 0 or size % 8)):
            return None
        else:
            at += size
    return at


def is_openssh_key(data: bytes) -> bool:
    cipher = data[19 : 19 + int.from_bytes(data[15:19], "big")]
    return openssh_asks(data) == len(data) and cipher.isascii()


def _unbase64(text: str) -> bytes:
    plain = text.rstrip("=").translate({45: 43, 95: 47})
    if len(plain) % 4 == 1:
        return b""
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except binascii.Error:
        return b""


def _unjson(text: str) -> dict | None:
    try:
        value = json.loads(_unbase64(text))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether the header names an algorithm, the payload is an object, and the signature has bytes as many as the algorithm makes."""
    head = _unjson(header)
    if head is None or not isinstance(head.get("alg"), str) or _unjson(payload) is None:
        return False
    alg, size = head["alg"], len(_unbase64(signature))
    if alg in _RSA:
        return size >= 128
    return size in _SIGNED.get(alg, _PLAUSIBLE)


def _tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Each run is a header once at most, and a payload once."""
    for chain in _CHAIN.finditer(text):
        runs, at = chain[0].split("."), chain.start()
        for i in range(len(runs) - 2):
            if _BRACE.match(runs[i]) and is_signed_token(*runs[i : i + 3]):
                yield "jwt", at, at + sum(map(len, runs[i : i + 3])) + 2
            at += len(runs[i]) + 1


def is_pem_key(label: str, body: str) -> bool:
    lines = re.split(r"\\[rn]|\s", body.replace("\\r\\n", "\\n"))
    lines = [x for x in lines if x]
    headers = [x for x in lines if ":" in x or "," in x]
    if headers:  # an encrypted key in the old form: its content has no structure left, its headers have
        return "PRIVATE KEY" in label and "DEK-Info:" in body and "ENCRYPTED" in body
    data = _unbase64("".join(lines))
    return is_openssh_key(data) if label.startswith("OPENSSH") else is_der_key(data)


def pem_blocks(text: str) -> Iterator[tuple[int, int]]:
    """Key blocks from their first to their last mark; an end belongs to the nearest beginning before it."""
    opened = None
    for mark in _MARK.finditer(text):
        if mark[1] == "END" and opened and opened[2] == mark[2]:
            if _BODY.fullmatch(text, opened.end(), mark.start()) and is_pem_key(mark[2], text[opened.end() : mark.start()]):
                yield opened.start(), mark.end()
        opened = mark if mark[1] == "BEGIN" else None


def _runs(text: str, start: int, letters: int) -> Iterator[tuple[int, int]]:
    """Where base64 stands from ``start`` on, without the line ends in between, up to that many letters."""
    lines = _LINES.match(text, start, start + 2 * letters + 64)
    at = start
    for gap in _BREAK.finditer(text, start, lines.end()):
        if letters <= gap.start() - at:
            break
        yield at, gap.start()
        letters -= gap.start() - at
        at = gap.end()
    yield at, min(lines.end(), at + letters)


def _is_broken(text: str, start: int, letters: int) -> bool:
    return any(text.find(sign, start, start + letters) >= 0 for sign in "\n\\")


def _spelled(text: str, start: int, size: int) -> tuple[bytes, int]:
    """So many bytes in base64 from ``start`` on, or fewer where it ends before; and where their letters end."""
    runs = list(_runs(text, start, -(-size * 4 // 3)))
    letters = "".join([text[a:b] for a, b in runs])
    return _unbase64(letters[: len(letters) - (len(letters) % 4 == 1)])[:size], runs[-1][1]


def _der_secret(text: str, start: int, head: bytes) -> tuple[str, int] | None:
    size = der_size(head)
    if size is None or size > MAX_KEY or head[2 + (head[1] & 0x7F if head[1] > 127 else 0)] not in (_INT, _SEQUENCE):
        return None
    letters = -(-size * 4 // 3)
    if not _is_broken(text, start, letters) and not _ENDS.match(text, start + letters):
        return None
    ends = _ENDS.match(text, list(_runs(text, start, letters))[-1][1])
    if not ends:
        return None
    data, _ = _spelled(text, start, size)
    return ("key", ends.end()) if len(data) == size and is_der_key(data) else None


def _openssh_secret(text: str, start: int, head: bytes) -> tuple[str, int] | None:
    """As many bytes are decoded as the parts before ask for."""
    size = len(head)
    while size <= MAX_KEY:
        data, end = _spelled(text, start, size)
        asked = openssh_asks(data)
        if asked is None or len(data) < size:
            return None
        if asked == size:
            ends = _ENDS.match(text, end)
            return ("key", ends.end()) if ends and is_openssh_key(data) else None
        size = asked
    return None


def _pem_secret(text: str, start: int, head: bytes) -> tuple[str, int] | None:
    """A block with its marks, all in base64. More is decoded until a second mark is met, so no letter is decoded often."""
    size, second = 64, None
    while second is None:
        data, _ = _spelled(text, start, size)
        plain = data.decode("latin-1")
        mark = _MARK.match(plain)
        if not mark or mark[1] != "BEGIN":
            return None
        second = _MARK.search(plain, mark.end())
        if second is None and (len(data) < size or size > MAX_KEY):
            return None
        size *= 2
    if next(pem_blocks(plain[: second.end()]), None) is None:
        return None
    _, end = _spelled(text, start, second.end())
    return "pem", _REST.match(text, end).end()


def _base64_secret(text: str, start: int, sign: str) -> tuple[str, int] | None:
    """Kind and end of the secret that begins here in base64; the first letters tell whether it is worth reading on."""
    head, _ = _spelled(text, start, 15 if sign.startswith(("M", "b3")) else 21)
    if len(head) < 15:
        return None
    read = _der_secret if sign.startswith("M") else _openssh_secret if sign.startswith("b3") else _pem_secret
    return read(text, start, head)


def _base64_secrets(text: str) -> Iterator[tuple[str, int, int]]:
    at = 0
    while found := _BASE64.search(text, at):
        secret = _base64_secret(text, found.start(), found[0])
        if secret:
            yield secret[0], found.start(), secret[1]
        at = secret[1] if secret else found.end()


def spans(raw: bytes) -> list[tuple[str, int, int]]:
    """Kind, start and end (exclusive, in code points) of every secret, by start, then kind, then end."""
    low = raw.lower()
    assigned = any(w in low for w in _WORDS)
    if not assigned and not _ANY.search(raw):
        return []
    text = raw.decode()
    found = []
    if assigned:
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    found += _tokens(text)
    found += _base64_secrets(text)
    for m in _HEX_KEY.finditer(text):
        if len(m[1]) <= 2 * MAX_KEY and len(m[1]) % 2 == 0:
            data = bytes.fromhex(m[1])
            if is_der_key(data) or is_openssh_key(data):
                found.append(("key", m.start(1), m.end(1)))
    blocks = [("pem", start, end) for start, end in pem_blocks(text)]
    found = [s for s in found if s[0] != "key" or not any(b[1] <= s[1] and s[2] <= b[2] for b in blocks)] + blocks
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """All rows and columns with ``out``, an array of ``kind, start, end``; places count code points, ends are exclusive.

    Null and empty texts have none. Whole texts are read, however long. Rows are independent, so repeated rows and
    empty tables need no rule. A column that is called as ``out`` is replaced.
    """
    fields = [T.StructField(name, kind) for name, kind in (("kind", T.StringType()), ("start", T.LongType()), ("end", T.LongType()))]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Batches) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans(t.as_py() or b"")] for t in as_bytes(batch.column("of"))
            ]
            yield batch, pa.array(found, span)

    return add_column(docs, text, out, T.ArrayType(T.StructType(fields)), run)


def without_spans(raw: bytes, mark: str) -> bytes:
    found = spans(raw)
    if not found:
        return raw
    text, out, end = raw.decode(), [], 0
    for _, start, stop in found:
        if start >= end:
            out += [text[end:start], mark]
        end = max(end, stop)
    return "".join([*out, text[end:]]).encode()


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns; in ``text`` every secret, or overlapping ones together, is replaced by ``mark``.
    Null texts stay null."""

    def run(batches: Batches) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        for batch in batches:
            clean = [without_spans(t.as_py(), mark).decode() if t.is_valid else None for t in as_bytes(batch.column("of"))]
            yield batch, pa.array(clean, pa.string())

    masked = add_column(docs, text, text, T.StringType(), run)
    return masked.select(*(F.col(f"`{c}`") for c in docs.columns))

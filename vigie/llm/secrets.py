"""Secrets in texts, confirmed by their structure.

Three plain patterns are taken as they are: assignments to a secret's name, access key ids and long
runs of hex digits. Everything else that looks like an encoded key is only a candidate. It is decoded
(base64, base64url or hex, armoured or bare, wrapped in lines or not) and then parsed: a private
key must be a sequence whose nested lengths fill each other exactly and whose parts are those of a
known key form, a signed token must have a header that names an algorithm, an object as payload and a
signature of that algorithm's size. Texts that are encoded once more are looked into once. A candidate
that does not parse is not reported, so long identifiers, digests and file paths stay unreported.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in the order in which spans with an equal start are listed; the first three are plain.
KINDS = ("assign", "access", "hex", "token", "armour", "key", "hexkey")
BASE = KINDS[:3]

# ---------------------------------------------------------------------------
# The plain patterns, their least sizes, and the forms of keys and tokens
# ---------------------------------------------------------------------------
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of hex digits is one match, so the least size can stand here
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

TOKEN_STARTS = ("eyJ", "eyA", "ewo", "ew0")  # {" and {, then white space, in base64
TOKEN = re.compile(r"[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40})PRIVATE KEY-----")
BLOB = re.compile(r"[A-Za-z0-9+/_-]{60,}(?:\r?\n[A-Za-z0-9+/_-]+)*={0,2}")
HEX_BLOB = re.compile(r"[0-9A-Fa-f]{96,}")

SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "ES256K": 64, "EdDSA": 64}
LEAST_RSA_BYTES = 128
OPENSSH = b"openssh-key-v1\x00"
INTEGER, BITS, OCTETS, OID, SEQUENCE, PARAMETERS = 0x02, 0x03, 0x04, 0x06, 0x30, 0xA0
PASSWORD_BASED = bytes.fromhex("2a864886f70d0105")  # the arc of password-based encryption
# ---------------------------------------------------------------------------


def unbase64(text: str) -> bytes | None:
    """Bytes of base64 or base64url without regard to padding; None if no whole byte string fits."""
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return None
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


# --- nested lengths ---------------------------------------------------------
def element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value of the element at a place; None if it does not fit before ``end``."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > end:
            return None
        size, start = int.from_bytes(data[start:start + n], "big"), start + n
        if size < 0x80:  # a short length must be written short
            return None
    return (tag, start, start + size) if start + size <= end else None


def elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill a range exactly; None if they do not."""
    found = []
    while at < end:
        one = element(data, at, end)
        if one is None:
            return None
        found.append(one)
        at = one[2]
    return found


def _number(data: bytes, part: tuple[int, int, int]) -> int:
    return int.from_bytes(data[part[1]:part[2]], "big", signed=True)


def _oid(data: bytes, part: tuple[int, int, int]) -> bool:
    """An object identifier: at least two bytes, the last of which ends a number."""
    return part[0] == OID and part[2] - part[1] >= 2 and data[part[2] - 1] < 0x80


def key_form(data: bytes) -> tuple[str, int] | None:
    """Form and size in bytes of the private key at the start of a byte string, None if there is none."""
    if data.startswith(OPENSSH):
        return _openssh(data)
    whole = element(data, 0, len(data))
    if whole is None or whole[0] != SEQUENCE:
        return None
    parts = elements(data, whole[1], whole[2])
    if not parts or len(parts) < 2:
        return None
    tags, size = [p[0] for p in parts], whole[2]
    if tags[0] == INTEGER and parts[0][2] - parts[0][1] == 1:
        version = _number(data, parts[0])
        if len(parts) >= 9 and tags[:9] == [INTEGER] * 9 and version in (0, 1):
            n, p, q = (_number(data, parts[i]) for i in (1, 4, 5))
            if n > 1 << 500 and (p * q == n or version == 1):
                return "rsa", size
        elif tags == [INTEGER] * 6 and version == 0 and _number(data, parts[1]) > 1 << 500:
            return "dsa", size
        elif version in (0, 1) and len(parts) >= 3 and tags[1:3] == [SEQUENCE, OCTETS]:
            algorithm = elements(data, parts[1][1], parts[1][2])
            if algorithm and _oid(data, algorithm[0]) and parts[2][2] - parts[2][1] >= 16:
                return "pkcs8", size
        elif version == 1 and tags[1] == OCTETS and 16 <= parts[1][2] - parts[1][1] <= 66 and len(parts) >= 3 and tags[2] in (PARAMETERS, PARAMETERS + 1):
            inner = elements(data, parts[2][1], parts[2][2])
            if inner and (_oid(data, inner[0]) if tags[2] == PARAMETERS else inner[0][0] == BITS):
                return "ec", size
    elif tags[:2] == [SEQUENCE, OCTETS] and len(parts) == 2:
        algorithm = elements(data, parts[0][1], parts[0][2])
        if algorithm and _oid(data, algorithm[0]) and data[algorithm[0][1]:].startswith(PASSWORD_BASED):
            return "pkcs8 encrypted", size
    return None


def _openssh(data: bytes) -> tuple[str, int] | None:
    """Strings with their lengths in front: cipher, key derivation, its options, public keys, private part."""
    at, strings = len(OPENSSH), []

    def size() -> int | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        at += 4
        return int.from_bytes(data[at - 4:at], "big")

    def text() -> bool:
        nonlocal at
        n = size()
        if n is None or at + n > len(data):
            return False
        strings.append(data[at:at + n])
        at += n
        return True

    if not all(text() for _ in range(3)):
        return None
    keys = size()
    if not keys or keys > 16 or not all(text() for _ in range(keys + 1)) or len(strings[-1]) < 16:
        return None
    return ("openssh" if strings[0] == b"none" else "openssh encrypted"), at


def token_form(text: str) -> str | None:
    """The algorithm of a signed token, None if header, payload and signature do not fit together."""
    head, payload, signature = text.split(".")
    try:
        header, body = (json.loads(unbase64(part) or b"") for part in (head, payload))
    except (ValueError, RecursionError):
        return None
    if not isinstance(header, dict) or not isinstance(body, dict) or not isinstance(header.get("alg"), str):
        return None
    signed, algorithm = unbase64(signature), header["alg"]
    if signed is None:
        return None
    if algorithm in SIGNATURE_BYTES:
        return algorithm if len(signed) == SIGNATURE_BYTES[algorithm] else None
    if algorithm[:2] in ("RS", "PS"):
        return algorithm if len(signed) >= LEAST_RSA_BYTES else None
    return None


# --- candidates -------------------------------------------------------------
def _tokens(text: str) -> Iterator[tuple[int, int, str]]:
    for start in TOKEN_STARTS:
        at = text.find(start)
        while at >= 0:
            found = TOKEN.match(text, at) if not at or not (text[at - 1].isalnum() or text[at - 1] in "_-") else None
            form = token_form(found.group()) if found else None
            if form:
                yield at, found.end(), form
            at = text.find(start, found.end() if form else at + len(start))


def _armoured(text: str) -> Iterator[tuple[int, int, str]]:
    for opening in ARMOUR.finditer(text):
        closing = f"-----END {opening.group(1)}PRIVATE KEY-----"
        at = text.find("-----END ", opening.end())
        if at < 0 or not text.startswith(closing, at):
            continue
        body = text[opening.end():at].replace("\\n", "\n").replace("\\r", "")
        if "\n\n" in body.replace("\r", "").strip("\n"):  # header lines end at an empty line
            body = body.replace("\r", "").strip("\n").split("\n\n", 1)[1]
            data = unbase64("".join(body.split()))
            if data and len(data) >= 32 and len(data) % 8 == 0:  # whole cipher blocks
                yield opening.start(), at + len(closing), "encrypted"
            continue
        data = unbase64("".join(body.split()))
        form = key_form(data) if data else None
        if form and form[1] == len(data):
            yield opening.start(), at + len(closing), form[0]


def _nested(data: bytes) -> str | None:
    """What a decoded text holds, if it is a text."""
    try:
        text = data.decode("ascii")
    except UnicodeDecodeError:
        return None
    for _, _, form in (*_armoured(text), *_tokens(text)):
        return f"nested {form}"
    return None


def _bare(text: str) -> Iterator[tuple[int, int, str]]:
    for found in BLOB.finditer(text):
        run = found.group()
        lines = run.split()
        for size, joined in ((len(run), "".join(lines)), (len(lines[0]), lines[0])):
            data = unbase64(joined if len(joined.rstrip("=")) % 4 != 1 else joined.rstrip("=")[:-1])
            if data is None:
                continue
            form = key_form(data)
            if form and form[1] < len(data):  # the outer length says where the key ends
                need, size = (form[1] * 8 + 5) // 6, 0
                for c in run:
                    need -= c not in "\r\n"
                    size += 1
                    if not need:
                        break
            name = form[0] if form else _nested(data)
            if name:
                yield found.start(), found.start() + size, name
                break


def _hex_keys(text: str) -> Iterator[tuple[int, int, str]]:
    for found in HEX_BLOB.finditer(text):
        run = found.group()
        data = bytes.fromhex(run[:len(run) & ~1])
        form = key_form(data)
        name = form[0] if form else _nested(data)
        if name:
            yield found.start(), found.start() + 2 * (form[1] if form else len(data)), name


def spans_of(text: str) -> list[tuple[int, int, int, str]]:
    """Start, number of the kind, end and form of every secret of a text, in order."""
    found = [(m.start(), 0, m.end(), "") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end(), "") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), "") for m in HEX.finditer(text)]
    armoured = list(_armoured(text)) if "-----BEGIN " in text else []
    found += [(a, 3, b, form) for a, b, form in _tokens(text)]
    found += [(a, 4, b, form) for a, b, form in armoured]
    inside = [(a, b) for a, b, _ in armoured]
    found += [(a, 5, b, form) for a, b, form in _bare(text) if not any(x <= a < y for x, y in inside)]
    found += [(a, 6, b, form) for a, b, form in _hex_keys(text)]
    return sorted(found)


SPANS = "array<struct<kind:string,start:long,end:long,form:string,found:string>>"


def scan(documents: DataFrame) -> DataFrame:
    """``doc_id, secrets`` of every row: kind, start, end (code points, exclusive), form and text.

    The form names what a candidate was parsed as and is empty for the plain kinds. Null and empty
    texts have no secrets. Ids may be null or repeat: every row gives a row. Other columns are not read.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("form", pa.string()), ("found", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"kind": KINDS[k], "start": a, "end": b, "form": form, "found": text[a:b]} for a, k, b, form in spans_of(text)]
                for text in (t.as_py() or "" for t in batch.column(1))
            ]
            yield pa.record_batch([batch.column(0), pa.array(rows, kind)], ["doc_id", "secrets"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id long, secrets {SPANS}")


def listed(secrets: Column) -> Column:
    """``kind:start:end`` of each secret, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(secrets: Column, *kinds: str) -> Column:
    return F.filter(secrets, lambda s: s["kind"].isin(*kinds))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every secret's text replaced by its kind in angle brackets.

    Overlapping spans are one gap, named after its first kind. Null texts stay null; all columns stay.
    """
    schema, place = documents.schema, documents.columns.index("text")

    def cover(text: str) -> str:
        out, at = [], 0
        for start, kind, end, _ in spans_of(text):
            if start >= at:
                out += [text[at:start], f"<{KINDS[kind]}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else cover(t) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.names[place], pa.array(texts, pa.string()))

    return documents.mapInArrow(work, schema)

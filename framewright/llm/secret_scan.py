"""Secrets in texts: patterns, and blobs whose decoded structure proves them keys or tokens.

Patterns give the kinds ``assign``, ``access`` and ``hex``.  The structural pass takes base64
and hex runs of 40 characters or more (with the line breaks of a PEM block) and dotted
triples, decodes them, and reports only what parses:

* ``pkey``: DER of a private key.  The outer SEQUENCE must fill the blob, every nested length
  must fill its parent, and the fields must be those of PKCS#1, PKCS#8 (whose octets must hold a key
  of the algorithm they name), encrypted PKCS#8 or SEC 1.  A PEM block with header lines is one if these
  name a cipher and its start vector and the body fills whole cipher blocks;
* ``openssh``: the OpenSSH private key container, by its magic and its nested string lengths;
* ``jwt``: a signed token whose header is JSON with ``alg`` and whose body is a JSON object.

Spans are in code points, end exclusive.  Null texts count as empty and have none;
repeated rows are scanned row by row; texts are scanned whole, whatever their length; only
doc_id and text are read (:func:`redact` passes all other columns through).
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from framewright.llm import words as W
from framewright.storage import table

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pkey", "openssh", "jwt")
LEAST = {"access": 20, "hex": 24}
MASK = "[SECRET]"
#: Levels of nested DER that are followed; keys have fewer than ten.
MOST_LEVELS = 64

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----\s((?:[A-Za-z-]+:[^\n]*\n)*)([A-Za-z0-9+/=\s]{40,}?)-----END")
_CIPHER = re.compile(r"^DEK-Info: *([A-Z0-9-]+), *([0-9A-Fa-f]{16,32})\s*$", re.M)
_BLOB = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_IS_HEX = re.compile(r"(?:[0-9A-Fa-f]{2})+")

SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06
CONSTRUCTED = 0x20
#: Object identifiers of key algorithms, as DER holds them: fixed values.
RSA, EC, DSA = (bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2a8648ce380401"))
CURVES = tuple(bytes.fromhex(x) for x in ("2b656e", "2b656f", "2b6570", "2b6571"))
#: What identifiers of password-based encryption begin with.
ENCRYPTION = tuple(bytes.fromhex(x) for x in ("2a864886f70d0105", "2a864886f70d010c01"))

Span = tuple[int, str, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the patterns, leftmost and non-overlapping within each kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that fill ``data`` exactly, or None if a length doesn't fit."""
    out, i = [], 0
    while i < len(data):
        if i + 2 > len(data):
            return None
        tag, n, i = data[i], data[i + 1], i + 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or i + k > len(data):
                return None
            n, i = int.from_bytes(data[i : i + k], "big"), i + k
        if i + n > len(data):
            return None
        out.append((tag, data[i : i + n]))
        i += n
    return out


def well_formed(fields: list[tuple[int, bytes]] | None) -> bool:
    """Whether all lengths below the fields fit, in at most ``MOST_LEVELS`` levels; deeper nesting is no key."""
    level = fields
    for _ in range(MOST_LEVELS):
        if level is None:
            return False
        inner = [der_fields(x) for tag, x in level if tag & CONSTRUCTED]
        if not inner:
            return True
        level = None if None in inner else [f for x in inner for f in x]
    return False


def _sequence(data: bytes) -> list[tuple[int, bytes]] | None:
    """The fields of a SEQUENCE that fills the data."""
    outer = der_fields(data)
    return der_fields(outer[0][1]) if outer and len(outer) == 1 and outer[0][0] == SEQUENCE else None


def _version(fields: list[tuple[int, bytes]]) -> int | None:
    tag, value = fields[0]
    return value[0] if tag == INTEGER and len(value) == 1 else None


def _is_rsa(fields: list[tuple[int, bytes]] | None) -> bool:
    """PKCS#1: a version and eight numbers."""
    return bool(fields) and _version(fields) == 0 and [t for t, _ in fields[1:9]] == [INTEGER] * 8


def _is_ec(fields: list[tuple[int, bytes]] | None) -> bool:
    """SEC 1: version 1 and the private number as octets."""
    return bool(fields) and len(fields) > 1 and _version(fields) == 1 and fields[1][0] == OCTETS and len(fields[1][1]) >= 16


def _holds_key(algorithm: bytes, octets: bytes) -> bool:
    """Whether the octets of PKCS#8 hold a key of the algorithm; of others, well-formed DER."""
    if algorithm in (RSA, EC):
        return (_is_rsa if algorithm == RSA else _is_ec)(_sequence(octets))
    inner = der_fields(octets)
    if algorithm == DSA or algorithm in CURVES:
        return bool(inner) and [t for t, _ in inner] == [INTEGER if algorithm == DSA else OCTETS]
    return bool(inner) and well_formed(inner)


def is_private_key(data: bytes) -> bool:
    fields = _sequence(data)
    if not fields or len(fields) < 2 or not well_formed(fields):
        return False
    tags = [t for t, _ in fields]
    if tags == [SEQUENCE, OCTETS]:  # encrypted PKCS#8
        scheme = der_fields(fields[0][1])
        return bool(scheme) and scheme[0][0] == OID and scheme[0][1].startswith(ENCRYPTION) and len(fields[1][1]) > 0
    if _version(fields) in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS]:
        algorithm = der_fields(fields[1][1])
        return bool(algorithm) and algorithm[0][0] == OID and _holds_key(algorithm[0][1], fields[2][1])
    return _is_rsa(fields) or _is_ec(fields)


def is_encrypted_body(headers: str, data: bytes | None) -> bool:
    """A PEM body in whole blocks of the cipher that its header lines name."""
    cipher = _CIPHER.search(headers)
    return bool(cipher and data) and len(data) % (len(cipher[2]) // 2) == 0


def is_openssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, strings = len(magic), []
    for k in range(5):  # cipher, kdf, kdf options, then after a count the public and private parts
        if k == 3:
            at += 4
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return False
        strings.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return at == len(data) and len(strings[4]) > 0


def decoded(blob: str) -> bytes | None:
    """The bytes of a hex or base64 blob, of either alphabet."""
    if _IS_HEX.fullmatch(blob):
        return bytes.fromhex(blob)
    flat = blob.rstrip("=").translate({45: "+", 95: "/"})
    try:
        return base64.b64decode(flat + "=" * (-len(flat) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_part(part: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return None


def is_signed_token(token: str) -> bool:
    header, body, _ = token.split(".")
    head = _json_part(header)
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(_json_part(body), dict)


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "pkey" if data[0] == SEQUENCE and is_private_key(data) else "openssh" if is_openssh_key(data) else None


def structural_spans(text: str) -> list[Span]:
    """(start, kind, end) of what decodes to a key or a signed token."""
    out = []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            data = decoded("".join(m[2].split()))
            if kind := "pkey" if m[1] and is_encrypted_body(m[1], data) else _key_kind(data):
                out.append((m.start(2), kind, m.end(2)))
    blocks, k = list(out), 0
    for m in _BLOB.finditer(text):
        while k < len(blocks) and blocks[k][2] <= m.start():  # both go from left to right
            k += 1
        if (k == len(blocks) or m.start() < blocks[k][0]) and (kind := _key_kind(decoded(m[0]))):
            out.append((m.start(), kind, m.end()))
    if "eyJ" in text:
        out += [(m.start(), "jwt", m.end()) for m in _JWT.finditer(text) if is_signed_token(m[0])]
    return out


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The patterns' spans, and all spans in order of start and kind."""
    base = base_spans(text)
    return base, sorted([*base, *structural_spans(text)], key=lambda s: (s[0], KINDS.index(s[1])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def masked(text: str) -> str:
    """The text with every stretch covered by spans replaced by one mask."""
    out, at = [], 0
    for a, _, b in all_spans(text)[1]:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], MASK]
        at = b
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the patterns, the SHA-256 of their spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                base, every = all_spans(text.as_py() or "")
                kinds = [k for _, k, _ in base]
                rows.append((*map(kinds.count, BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with secrets masked in ``text``; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            for part in W.blocks(batch, "text"):
                texts = [None if t is None else masked(t) for t in part.column(place).to_pylist()]
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))

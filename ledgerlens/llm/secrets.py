"""Secret scan: text patterns, then structural confirmation of decoded candidates.

Three patterns report what looks like a secret by its text (assign, access,
hex). Five kinds are reported only after their bytes were parsed:

- der: base64 or hex that decodes to a private key in ASN.1: PKCS#1, SEC1 or DSA
  with numbers of a plausible size, PKCS#8 with such a key inside, or PKCS#8 under a known
  password scheme. Every length down to the inner key closes exactly. Lines of base64 may have any
  width from 24 on, be indented, quoted, or parted by escaped line breaks; hex may
  be wrapped or have colons,
- openssh: base64 of an `openssh-key-v1` file whose length-prefixed fields
  close and whose private part is there,
- jwt: a token with a signature, whose header is a JSON object that names its algorithm
  and whose payload is a JSON object,
- jwt_unsigned: the same under the algorithm `none`.

Null and empty texts have no spans. Repeated rows are scanned each for itself.
Positions are code points, ends exclusive. Whole texts are scanned; all patterns
start at the edge of a run of their letters, so long runs cost linear time.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ["assign", "access", "hex"]
PARSED_KINDS = ["der", "openssh", "jwt", "jwt_unsigned"]
KINDS = BASE_KINDS + PARSED_KINDS

KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
# Between lines: a real or an escaped line break, then indentation or quote marks.
BREAK = re.compile(r"""(?:\r?\n|(?:\\+r)?\\+n)[\x20\t>|"']*+""")
HEX_PAIR = re.compile(r"[0-9A-Fa-f]{2}")
# A run of hex pairs, bare, with colons or wrapped; of base64 lines; or of base64 in either alphabet.
HEX_BYTES = re.compile(rf"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{{2}}(?::?+(?:{BREAK.pattern})?+)){{31,}}[0-9A-Fa-f]{{2}}(?![0-9A-Fa-f])")
BASE64 = re.compile(
    r"(?:(?<![A-Za-z0-9+/_-])(?!(?<=\\)[nr])|(?<=\\n))"
    rf"(?:(?:[A-Za-z0-9+/]{{24,}}{BREAK.pattern})+[A-Za-z0-9+/]+={{0,2}}|[A-Za-z0-9+/_-]{{44,}}={{0,2}})"
)
# A JSON object starts with `ey` in base64, or with `ew` where a line break follows the brace.
JWT = re.compile(r"(?<![A-Za-z0-9_.-])(e[wy][A-Za-z0-9_-]+)\.(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")

SEQUENCE, INTEGER, OCTETS, OBJECT_ID = 0x30, 0x02, 0x04, 0x06
SPAN_TYPE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def unbase64(text: str) -> bytes | None:
    """Bytes of a base64 text in either alphabet, wrapped or not, padded or not."""
    text = re.sub(r"\s", "", BREAK.sub("", text)).rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, content) fields that fill `data` exactly, or None."""
    fields, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size, at = int.from_bytes(data[at : at + width], "big"), at + width
        if at + size > len(data):
            return None
        fields.append((tag, data[at : at + size]))
        at += size
    return fields


# Object identifiers of key algorithms, and the beginnings of those of password-based schemes.
RSA, EC, DSA = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201"), bytes.fromhex("2a8648ce380401")
EDWARDS = {bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56, bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57}
PASSWORD_SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def sequence(data: bytes) -> list[tuple[int, bytes]]:
    """Fields of the one sequence that `data` is; none if it is no such thing."""
    outer = der_fields(data)
    return (der_fields(outer[0][1]) or []) if outer and len(outer) == 1 and outer[0][0] == SEQUENCE else []


def is_rsa_key(fields: list[tuple[int, bytes]]) -> bool:
    """PKCS#1: version, modulus, exponents, primes, coefficients, then more primes if there are."""
    if [tag for tag, _ in fields[:9]] != [INTEGER] * 9 or [tag for tag, _ in fields[9:]] not in ([], [SEQUENCE]):
        return False
    sizes = [len(content.lstrip(b"\0")) for _, content in fields[:9]]
    return min(sizes[1], sizes[3]) >= 32 and min(sizes[4:]) >= 16 and sizes[2] >= 1


def is_ec_key(fields: list[tuple[int, bytes]]) -> bool:
    """SEC1: version 1, scalar, then curve and public point if they are there."""
    tags = [tag for tag, _ in fields]
    return tags[:2] == [INTEGER, OCTETS] and set(tags[2:]) <= {0xA0, 0xA1} and fields[0][1] == b"\x01" and 20 <= len(fields[1][1]) <= 72


def is_dsa_key(fields: list[tuple[int, bytes]]) -> bool:
    """Legacy DSA: version 0, primes and generator, public and private value."""
    sound = [tag for tag, _ in fields] == [INTEGER] * 6 and all(content for _, content in fields)
    return sound and fields[0][1] == b"\x00" and len(fields[1][1]) >= 64


def holds_key(algorithm: bytes, inner: bytes) -> bool:
    """Whether the octets of a PKCS#8 key are a private key of its algorithm; of one not known here, some ASN.1."""
    if algorithm == RSA:
        return is_rsa_key(sequence(inner))
    if algorithm == EC:
        return is_ec_key(sequence(inner))
    fields = der_fields(inner) or []
    if algorithm in EDWARDS:
        return [(tag, len(content)) for tag, content in fields] == [(OCTETS, EDWARDS[algorithm])]
    if algorithm == DSA:
        return [tag for tag, _ in fields] == [INTEGER] and len(fields[0][1]) >= 16
    return len(fields) == 1 and len(fields[0][1]) >= 16


def is_private_der(data: bytes) -> bool:
    fields = sequence(data)
    tags = [tag for tag, _ in fields]
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # PKCS#8: version, algorithm, wrapped key, attributes
        algorithm = der_fields(fields[1][1]) or [(0, b"")]
        sound = fields[0][1] in (b"\x00", b"\x01") and algorithm[0][0] == OBJECT_ID and set(tags[3:]) <= {0xA0, 0x81, 0xA1}
        return sound and holds_key(algorithm[0][1], fields[2][1])
    if tags == [SEQUENCE, OCTETS]:  # encrypted PKCS#8: scheme, ciphertext
        scheme = der_fields(fields[0][1]) or [(0, b"")]
        return scheme[0][0] == OBJECT_ID and scheme[0][1].startswith(PASSWORD_SCHEMES) and len(fields[1][1]) >= 32
    return is_rsa_key(fields) or is_ec_key(fields) or is_dsa_key(fields)


def is_private_openssh(data: bytes) -> bool:
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at, found = len(magic), []

    def take(n: int) -> bytes | None:
        nonlocal at
        piece = data[at : at + n]
        at += n
        return piece if len(piece) == n else None

    def field() -> bytes | None:
        size = take(4)
        return None if size is None else take(int.from_bytes(size, "big"))

    found = [field(), field(), field()]  # cipher, key derivation, its options
    count = take(4)
    if None in found or count is None or not 1 <= int.from_bytes(count, "big") <= 16:
        return False
    keys = [field() for _ in range(int.from_bytes(count, "big"))]
    secret = field()
    return None not in keys and bool(secret) and at == len(data)


def token_kind(header: str, payload: str, signature: str) -> str | None:
    try:
        head, body = (json.loads(unbase64(x) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return None
    if not (isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str)):
        return None
    if head["alg"].lower() == "none":
        return "jwt_unsigned"
    return "jwt" if unbase64(signature) else None


def hex_key(match: re.Match) -> tuple[int, int] | None:
    """Start and end of the private key that the pairs of a HEX_BYTES match begin with."""
    pairs = [m.span() for m in HEX_PAIR.finditer(match[0])]
    data = bytes.fromhex("".join(match[0][s:e] for s, e in pairs))
    size = der_size(data) or 0
    return (match.start(), match.start() + pairs[size - 1][1]) if 0 < size <= len(data) and is_private_der(data[:size]) else None


def key_kind(text: str) -> str | None:
    data = unbase64(text)
    return data and ("der" if is_private_der(data) else "openssh" if is_private_openssh(data) else None) or None


def der_size(head: bytes) -> int | None:
    """Bytes of the ASN.1 sequence that starts with `head`, by its own length."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    width = head[1] & 0x7F if head[1] >= 0x80 else 0
    if width > 4:
        return None
    return 2 + width + (int.from_bytes(head[2 : 2 + width], "big") if width else head[1])


def der_letters(text: str) -> int | None:
    """Base64 letters of the ASN.1 sequence that starts with `text`."""
    size = der_size(unbase64(text[:8]) or b"")
    return size and -(-size * 8 // 6)


def base64_keys(match: re.Match) -> Iterator[tuple[str, int, int]]:
    """The private keys that a BASE64 match holds: all of it, or some of its lines among other keys or words."""
    whole, first = match[0], match.start()
    if kind := key_kind(whole):
        yield kind, first, match.end()
        return
    breaks = [m.span() for m in BREAK.finditer(whole)]
    starts, ends = [0, *(e for _, e in breaks)], [*(s for s, _ in breaks), len(whole)]
    if len(starts) == 1:
        return
    letters = [0]
    for s, e in zip(starts, ends):
        letters.append(letters[-1] + len(whole[s:e].rstrip("=")))
    at = 0
    while at < len(starts):
        line, tried = whole[starts[at] : ends[at]], []
        wanted = der_letters(line)
        if wanted and letters[at] + wanted <= letters[-1]:
            tried = [bisect_left(letters, letters[at] + wanted) - 1]
        elif line.startswith("b3BlbnNzaC1rZXktdjE"):  # openssh-key-v1
            later = [i for i in range(at + 1, len(starts)) if whole.startswith("b3BlbnNzaC1rZXktdjE", starts[i])]
            last = later[0] - 1 if later else len(starts) - 1
            tried = [i for i in (last, last - 1) if i >= at]
        for last in tried:
            if kind := key_kind(whole[starts[at] : ends[last]]):
                yield kind, first + starts[at], first + ends[last]
                at = last
                break
        at += 1


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed in KINDS."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    for m in HEX_BYTES.finditer(text):
        if m[0].startswith("30") and (key := hex_key(m)):
            found.append(("der", *key))
    for m in BASE64.finditer(text):
        found += base64_keys(m)
    for m in JWT.finditer(text) if "." in text else ():
        if kind := token_kind(m[1], m[2], m[3]):
            found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id and `spans`, an array of (kind, start, end)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text.as_py())] for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(SPAN_TYPE))], ["id", "spans"])

    kept = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    id_type = kept.schema["id"].dataType.simpleString()
    found = kept.mapInArrow(scan, f"id {id_type}, spans array<struct<kind: string, start: bigint, end: bigint>>")
    return found.withColumnRenamed("id", id_column)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the pattern spans and all spans as one text."""

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(BASE_KINDS))
    return found.select(
        "doc_id",
        *[of(kind) for kind in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        *[of(kind) for kind in PARSED_KINDS],
    )

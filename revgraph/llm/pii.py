"""Personal data replaced by format-preserving Feistel pseudonyms.

Each kind of value has a pattern, a check that accepts real values only (card
check digits, IBAN remainders, calendar dates, address ranges) and a numbering
of all values of its format. A keyed Feistel network permutes the numbers, and
the value is written back in the format it had. Equal values get equal
pseudonyms in every document, different values different ones, and no value
stands for itself; nothing but the key is shared between tasks, and ``reveal``
inverts a pseudonym with the key.

Defined results: a null text stays null, an empty one empty; text outside the
values found is untouched; repeated rows are treated alike; other columns are
kept by ``pseudonymise``. Where two patterns could match, the one earlier in
``KINDS`` wins from the same position, else the one that starts first.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revgraph.llm.common import pieces, release

ROUNDS = 10
#: For tests and sample queries; a deployment passes its own secret.
SAMPLE_KEY = b"revgraph sample key"

UPPER, LOWER, DIGIT, HEX = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"


class Feistel:
    """A keyed permutation of 0 .. size - 1 that moves every number (for a size of 2 or more).

    The network permutes a power of four; numbers beyond ``size`` are sent on
    until they fall within it. A keyed rotation between the network and its
    inverse leaves no number in its place.
    """

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.key = hashlib.blake2b(tweak.encode(), key=hashlib.sha256(key).digest(), digest_size=32).digest()
        self.shift = 1 + int.from_bytes(hashlib.blake2b(b"rotation", key=self.key).digest(), "big") % (size - 1) if size > 1 else 0

    def _f(self, step: int, x: int) -> int:
        n = (self.half + 7) // 8
        raw = step.to_bytes(1, "big") + x.to_bytes(n, "big")
        # every bit of a half must move, and one digest of BLAKE2b has 64 bytes at most
        digest = hashlib.blake2b(raw, key=self.key, digest_size=n).digest() if n <= 64 else hashlib.shake_256(self.key + raw).digest(n)
        return int.from_bytes(digest, "big") & self.mask

    def _network(self, x: int, steps: range) -> int:
        back = steps.step < 0
        while True:
            a, b = x >> self.half, x & self.mask
            for i in steps:
                a, b = (b ^ self._f(i, a), a) if back else (b, a ^ self._f(i, b))
            x = a << self.half | b
            if x < self.size:
                return x

    def _turn(self, x: int, by: int) -> int:
        x = self._network(x, range(ROUNDS))
        return self._network((x + by) % self.size, range(ROUNDS - 1, -1, -1))

    def permute(self, x: int) -> int:
        return self._turn(x, self.shift)

    def invert(self, x: int) -> int:
        return self._turn(x, -self.shift)


@lru_cache(maxsize=4096)
def _feistel(key: bytes, tweak: str, size: int) -> Feistel:
    return Feistel(key, tweak, size)


Move = Callable[[str, int, int], int]  # (tweak, size, number) -> number


def _by_alphabets(value: str, alphabets: list[str | None], move: Move, tweak: str) -> str:
    """Move the characters that have an alphabet, as one mixed-radix number; the others stay."""
    number, size = 0, 1
    for c, a in zip(value, alphabets):
        if a:
            number, size = number * len(a) + a.index(c), size * len(a)
    number = move(tweak, size, number) if size > 1 else number
    out = []
    for c, a in zip(reversed(value), reversed(alphabets)):
        if a:
            number, at = divmod(number, len(a))
            c = a[at]
        out.append(c)
    return "".join(reversed(out))


def _class_of(c: str) -> str | None:
    return next((a for a in (LOWER, UPPER, DIGIT) if c in a), None)


def _shape(value: str, alphabets: list[str | None]) -> str:
    return "".join("?" if a is None else {LOWER: "a", UPPER: "A", DIGIT: "0", HEX: "h"}.get(a, "x") for a in alphabets) + "/" + "".join(c for c, a in zip(value, alphabets) if a is None)


def _digits_into(template: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in template)


def _only_digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


def luhn(digits: str) -> int:
    """Sum of a number with its check digit, modulo 10; 0 if it is right."""
    return sum((2 * int(c) - 9 * (c > "4")) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def _card(m: re.Match, move: Move) -> str | None:
    digits = _only_digits(m.group())
    if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
        return None
    n = len(digits) - 2
    size = 10**n
    while True:  # all digits alike are no card: they are passed over, as in the check
        body = digits[0] + str(move(f"card{len(digits)}{digits[0]}", size, int(digits[1:-1]))).zfill(n)
        digits = body + str(-luhn(body + "0") % 10)
        if len(set(digits)) > 1:
            return _digits_into(m.group(), digits)


def _iban_remainder(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _iban(m: re.Match, move: Move) -> str | None:
    value = m.group().replace(" ", "")
    if not 15 <= len(value) <= 34 or _iban_remainder(value) != 1 or not 2 <= int(value[2:4]) <= 98:
        return None
    alphabets = [_class_of(c) for c in value[4:]]
    body = _by_alphabets(value[4:], alphabets, move, "iban" + value[:2] + _shape(value[4:], alphabets))
    checked = value[:2] + str(98 - _iban_remainder(value[:2] + "00" + body)).zfill(2) + body
    it = iter(checked)
    return "".join(c if c == " " else next(it) for c in m.group())


def _email(m: re.Match, move: Move) -> str | None:
    """The local part and all of the host but its last label."""
    head, dot, top = m.group().rpartition(".")
    if not top.isalpha() or ".." in head:
        return None
    alphabets = [_class_of(c) for c in head]
    return _by_alphabets(head, alphabets, move, "email" + _shape(head, alphabets)) + dot + top


#: Characters of a key or password that are permuted as one number.
SECRET_BLOCK = 512


def _secret(m: re.Match, move: Move) -> str | None:
    """A key or password: hexadecimal values stay hexadecimal, others keep the class of each character."""
    name, value = m.group("name") or "", m.group("value") or m.group("aws")
    if value is None:
        return None
    if m.group("aws"):
        alphabets: list[str | None] = [None] * 4 + [UPPER + DIGIT] * 16
    elif len(value) >= 16 and all(c in HEX for c in value):
        alphabets = [HEX] * len(value)
    else:
        alphabets = [_class_of(c) for c in value]
    out = name
    for i in range(0, len(value), SECRET_BLOCK):  # of any length, in blocks
        part, own = value[i : i + SECRET_BLOCK], alphabets[i : i + SECRET_BLOCK]
        out += _by_alphabets(part, own, move, "secret" + (f"{i}/" if i else "") + _shape(part, own))
    return out


#: First numbers of an address that belong to hosts of the open internet.
_OPEN = [n for n in range(1, 224) if n not in (10, 127)]


def _ipv4(m: re.Match, move: Move) -> str | None:
    """An open address stays open; others keep their first number."""
    parts = m.group().split(".")
    if any(len(p) > 1 and p[0] == "0" or int(p) > 255 for p in parts):
        return None
    a, b, c, d = map(int, parts)
    rest = b << 16 | c << 8 | d
    if a in _OPEN:
        first, rest = divmod(move("ipv4", len(_OPEN) << 24, _OPEN.index(a) << 24 | rest), 1 << 24)
        a = _OPEN[first]
    else:
        rest = move(f"ipv4/{a}", 1 << 24, rest)
    return f"{a}.{rest >> 16}.{rest >> 8 & 255}.{rest & 255}"


def _ssn(m: re.Match, move: Move) -> str | None:
    a, b, c = map(int, m.group().split("-"))
    if a in (0, 666) or a >= 900 or not b or not c:
        return None
    n = move("ssn", 898 * 99 * 9999, ((a - 1 - (a > 666)) * 99 + b - 1) * 9999 + c - 1)
    n, c = divmod(n, 9999)
    a, b = divmod(n, 99)
    return f"{a + 1 + (a >= 665):03}-{b + 1:02}-{c + 1:04}"


_FIRST, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def _date(m: re.Match, move: Move) -> str | None:
    """Year first, or else month before day where that is a date, and day first with dots. All ways of writing a day
    share one pseudonym, but a day-first date with slashes is sent on until its day cannot be read as a month."""
    a, mark, b, c = m.group("d1"), m.group("mark"), m.group("d2"), m.group("d3")
    if len(a) == 4:
        order = [(a, b, c)]
    else:
        order = [(c, b, a)] if mark == "." else [(c, a, b), (c, b, a)]
    for i, (y, mo, d) in enumerate(order):
        try:
            day = date(int(y), int(mo), int(d)).toordinal()
        except ValueError:
            continue
        if not _FIRST <= day <= _LAST:
            return None
        new = date.fromordinal(_FIRST + move("date", _LAST - _FIRST + 1, day - _FIRST))
        # Written so that it reads back as the same day: a day-first date keeps a day that cannot be a month.
        while len(a) != 4 and mark != "." and i == 1 and new.day <= 12:
            new = date.fromordinal(_FIRST + move("date", _LAST - _FIRST + 1, new.toordinal() - _FIRST))
        y, mo, d = f"{new.year:04}", f"{new.month:02}", f"{new.day:02}"
        parts = (y, mo, d) if len(a) == 4 else (d, mo, y) if mark == "." or i == 1 else (mo, d, y)
        return mark.join(parts)
    return None


def _phone(m: re.Match, move: Move) -> str | None:
    """Ten digits of the North American plan, with or without its 1, or the digits behind an international prefix."""
    value = m.group()
    digits = _only_digits(value)
    if value.startswith("+") and not (digits[0] == "1" and len(digits) == 11):
        if not 8 <= len(digits) <= 15:
            return None
        head = _only_digits(re.split(r"[ .()-]", value, maxsplit=1)[0])
        head = head if len(head) <= 3 else head[:2]
        rest = digits[len(head) :]
        return _digits_into(value, head + str(move(f"phone{head}/{len(rest)}", 10 ** len(rest), int(rest))).zfill(len(rest)))
    head, rest = digits[:-10], digits[-10:]
    if head not in ("", "1"):
        return None
    plan = rest[0] > "1" and rest[3] > "1"
    if plan:
        n = (int(rest[0]) - 2) * 10**8 + int(rest[1:3]) * 10**6
        n = ((int(rest[0]) - 2) * 100 + int(rest[1:3])) * 8 + int(rest[3]) - 2
        n = move("phone", 8 * 100 * 8 * 10**6, n * 10**6 + int(rest[4:]))
        n, last = divmod(n, 10**6)
        n, b = divmod(n, 8)
        a, mid = divmod(n, 100)
        return _digits_into(value, head + f"{a + 2}{mid:02}{b + 2}{last:06}")
    if not value.startswith("+"):
        return None
    while True:  # numbers outside the plan stay outside it
        rest = str(move("phone10", 10**10, int(rest))).zfill(10)
        if not (rest[0] > "1" and rest[3] > "1"):
            return _digits_into(value, head + rest)


#: kind: (pattern, rewriting). Earlier kinds win from the same position.
KINDS: dict[str, tuple[str, Callable[[re.Match, Move], str | None]]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![A-Za-z0-9])", _email),
    "secret": (
        r"(?P<name>(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?P<value>[A-Za-z0-9+/_.-]{8,}(?<![.-]))"
        r"|(?<![A-Za-z0-9])(?P<aws>(?:AKIA|ASIA)[A-Z0-9]{16})(?![A-Za-z0-9])",
        _secret,
    ),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    "ipv4": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _ipv4),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "date": (r"(?<![\d/.-])(?P<d1>\d{4}|\d{1,2})(?P<mark>[-/.])(?P<d2>\d{1,2})(?P=mark)(?P<d3>(?<=\d{4}.\d.)\d{1,2}|(?<=\d{4}.\d\d.)\d{1,2}|\d{4})(?![\d/-]|\.\d)", _date),
    "card": (r"(?<![\d+.-])\d(?:[ -]?\d){12,18}(?![\d-]|\.\d)", _card),
    "phone": (r"(?<![\d+])(?:\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}|(?:1[ .-])?\(\d{3}\) ?\d{3}[ .-]\d{4}|(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d|[.-]\d)", _phone),
}
_PATTERNS = {kind: re.compile(p) for kind, (p, _) in KINDS.items()}
#: No value of any kind is without one of these.
_TRACE = re.compile(r"[\d@]")
_NAMES = ("password", "passwd", "pwd", "token", "secret", "api")


def _rewrite(text: str, move: Move) -> tuple[str, dict[str, int]]:
    low = text.lower()
    secret = "AKIA" in text or "ASIA" in text or any(n in low for n in _NAMES)
    if not secret and not _TRACE.search(text):
        return text, {}
    spans: list[tuple[int, int, int, str, str]] = []
    for rank, (kind, (_, rewrite)) in enumerate(KINDS.items()):
        if kind == "email" and "@" not in text or kind == "secret" and not secret:
            continue
        for m in _PATTERNS[kind].finditer(text):
            new = rewrite(m, move)
            if new is not None:
                spans.append((m.start(), rank, m.end(), new, kind))
    spans.sort()
    out, at, found = [], 0, {}
    for start, _, end, new, kind in spans:
        if start >= at:
            out += [text[at:start], new]
            at = end
            found[kind] = found.get(kind, 0) + 1
    return "".join([*out, text[at:]]), found


def mover(key: bytes, back: bool = False) -> Move:
    def move(tweak: str, size: int, number: int) -> int:
        f = _feistel(key, tweak, size)
        return f.invert(number) if back else f.permute(number)

    return move


def replace(text: str, key: bytes = SAMPLE_KEY) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many of each kind."""
    return _rewrite(text, mover(key))


def reveal(text: str, key: bytes = SAMPLE_KEY) -> str:
    """The values behind the pseudonyms of a text."""
    return _rewrite(text, mover(key, back=True))[0]


def find_and_replace(docs: DataFrame, key: bytes = SAMPLE_KEY) -> DataFrame:
    """doc_id, text with pseudonyms, n_replaced and the kinds found, for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                done = [_rewrite(t, mover(key)) for t in texts]
                kept = part.column("text").is_valid().to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([t if ok else None for (t, _), ok in zip(done, kept)], pa.string()),
                        pa.array([sum(f.values()) for _, f in done], pa.int32()),
                        pa.array([sorted(f) for _, f in done], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "text", "n_replaced", "kinds"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text string, n_replaced int, kinds array<string>")


def pseudonymise(docs: DataFrame, key: bytes = SAMPLE_KEY) -> DataFrame:
    """The same table, with pseudonyms in ``text`` and, where there is one, ``n_chars`` of the new text."""
    names = docs.columns
    schema = docs.withColumn("text", F.col("text").cast("string")).schema
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()  # what earlier stages left in a worker that Spark uses again
        for batch in batches:
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part, texts in pieces(named, f"c{at}"):
                kept = part.column(at).is_valid().to_pylist()
                new = pa.array([_rewrite(t, mover(key))[0] if ok else None for t, ok in zip(texts, kept)], pa.string())
                yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(part.columns)], names=names)

    out = docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out

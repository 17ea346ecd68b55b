"""Personal data replaced by surrogates that keep their kind, script and format.

Found are e-mail addresses, phone numbers, IPv4 addresses, payment cards, US social security numbers, valid
IBANs, access keys, passwords and tokens behind a word that says so, and names behind a title.  Passwords and
tokens have six characters or more and end at white space, a quote, comma or semicolon; quoted ones at the
closing quote on their line, blanks included.  A surrogate is a
keyed permutation of the value's letters and digits among all values of its shape: letters become letters
of the same case and script, digits become digits, punctuation stays.  A card keeps its check digit right
(or wrong), an IBAN its check sum, an address its network class, a phone number its country code, an e-mail
address its top-level domain, and a name its title, its vowels' places and the ending that shows a gender.

A permutation gives different values different surrogates and a value the same surrogate everywhere, so
documents need no table of replacements: coreference holds across the corpus, however a number is
punctuated.  It is built as "one step on" along a keyed order, so that no value is its own surrogate.  All
distinct values of a corpus are checked for both by a job of its own before any text is rewritten; if the
check fails, all are drawn anew with another key derived from the first.

Null texts stay null, empty ones empty.  Texts without personal data come back as they are.  Rows that
repeat get the same surrogates.  Other columns pass through; columns with a result's name are replaced.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioscope.llm.shared import Work

#: Draws before giving up.
ATTEMPTS = 20

_ROUNDS = 8
#: Longer values are permuted piece by piece, as the numbers drawn have 512 bits; values longer than ``_CACHED`` are not cached.
_PIECE, _CACHED = 128, 256
_ALPHABETS = tuple(
    map(
        str,
        (
            "0123456789",
            "abcdefghijklmnopqrstuvwxyz",
            "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            "абвгдежзийклмнопрстуфхцчшщъыьэюя",
            "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
            "αβγδεζηθικλμνξοπρστυφχψω",
            "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
            "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ",
            "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
        ),
    )
)
_ALPHABET_OF = {c: alphabet for alphabet in _ALPHABETS for c in alphabet}
_HEX, _HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"

# Titles by gender: m, f or unknown.
_TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m", "Г-н": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Señora": "f", "Sra": "f", "Señorita": "f", "Doña": "f", "Г-жа": "f", "Госпожа": "f", "Κυρία": "f",
    "Dr": "", "Prof": "",
}
_VOWELS = "aeiou", "AEIOU", "аеиоуыэюя", "АЕИОУЫЭЮЯ", "αεηιουω", "ΑΕΗΙΟΥΩ"
#: For names: vowels among vowels, other letters among those.
_SOUNDS = _ALPHABET_OF | {c: sounds for v in _VOWELS for whole in [_ALPHABET_OF[v[0]]] for sounds in (v, "".join(x for x in whole if x not in v)) for c in sounds}
#: Last letters that may show a name's gender, which stay.
_ENDINGS = frozenset("aAаяАЯαηςΑΗ")

_NUMBER = re.compile(r"[+(]?[0-9][0-9 ().\-]{5,}[0-9]")
_IP = re.compile(r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])")
_PHONE = re.compile(r"(?<![\w.+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![\w]|[.-][0-9])|(?<![\w.])\+[0-9]{8,15}(?!\w)")
_CARD = re.compile(r"(?<![\w.+-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w-]|\.[0-9])")
_SSN = re.compile(r"(?<![\w.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_LOCAL = re.compile(r"[\w.%+\-]{1,64}\Z")
_DOMAIN = re.compile(r"@(?:[^\W_](?:[\w-]{0,61}[^\W_])?\.)+[^\W\d_]{2,24}(?![\w-])")
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])")
_DAY = re.compile(r"(?:19|20)[0-9]{2}[-. ][01][0-9][-. ][0-3][0-9](?![0-9])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SAYS = re.compile(r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|auth|credential)s?[\"']?\s{0,2}\Z", re.I)
_SECRET = re.compile(r"[=:]\s{0,2}(?:\"([^\r\n\"]{6,}+)\"|'([^\r\n']{6,}+)'|([^\s\"',;]{6,}+))")
_CAPITAL = r"[^\W\d_a-zß-öø-ÿа-яα-ω]"
_WORD = rf"{_CAPITAL}(?:[^\W\d_]|['’-](?=[^\W\d_]))+"
_NAME = re.compile(r"(?<!\w)(" + "|".join(sorted(_TITLES, key=len, reverse=True)) + rf")\.? ({_WORD}(?: {_WORD}){{0,2}})")

Entity = tuple[int, int, str]


def find(text: str) -> list[Entity]:
    """(begin, end, kind) of the personal data in a text, in order and apart from each other.  Of two that overlap, the one found first by this list counts."""
    found: list[Entity] = []
    at = text.find("@")
    while at >= 0:
        local, domain = _LOCAL.search(text, max(0, at - 64), at), _DOMAIN.match(text, at)
        if local and domain:
            begin = local.start()
            while begin < at and text[begin] in ".%+-":
                begin += 1
            if begin < at:
                found.append((begin, domain.end(), "email"))
        at = text.find("@", at + 1)
    for sign in "=:":
        at = text.find(sign)
        while at >= 0:
            if _SAYS.search(text, max(0, at - 16), at) and (m := _SECRET.match(text, at)) and any(map(str.isalnum, m[m.lastindex])):
                found.append((*m.span(m.lastindex), "secret"))
            at = text.find(sign, at + 1)
    secrets = [(a, b) for a, b, kind in found if kind == "secret"]
    if secrets:  # an address inside a longer secret is part of it
        secrets.sort()
        begins = [a for a, _ in secrets]
        within = lambda a, b: (k := bisect_right(begins, a)) and b <= secrets[k - 1][1] and (a, b) != secrets[k - 1]
        found = [x for x in found if x[2] == "secret" or not within(x[0], x[1])]
    if "AKIA" in text or "ASIA" in text:
        found += [(*m.span(), "key") for m in _KEY.finditer(text)]
    found += [(*m.span(), "iban") for m in _IBAN.finditer(text) if _iban_sum(m.group().replace(" ", "")) == 1]
    for m in _NUMBER.finditer(text):
        a, b = m.span()
        for kind, pattern in (("ip", _IP), ("ssn", _SSN), ("card", _CARD), ("phone", _PHONE)):
            for m in pattern.finditer(text, a, b + 1 if b < len(text) else b):
                if _bounded(text, *m.span()) and not (kind == "phone" and (_DAY.match(m.group()) or not 7 <= sum(map(str.isdigit, m.group())) <= 15)):
                    found.append((*m.span(), kind))
    found += [(*m.span(2), "name" + _TITLES[m[1]]) for m in _NAME.finditer(text)]
    if len(found) < 2:
        return found
    out, taken = [], bytearray(len(text))
    for a, b, kind in found:
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\x01" * (b - a)
            out.append((a, b, kind))
    return sorted(out)


def _bounded(text: str, a: int, b: int) -> bool:
    """No letter or digit goes on at either end."""
    return not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())


def _iban_sum(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _luhn(digits: str) -> int:
    """The check digit of these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


class Surrogates:
    """The permutations of a key and a draw."""

    def __init__(self, key: bytes, attempt: int = 0):
        self.key, self.attempt = key, attempt
        self._seed = hashlib.blake2b(b"%d" % attempt, key=hashlib.blake2b(key, digest_size=32).digest(), digest_size=32).digest()
        self.of = lru_cache(maxsize=20_000)(self._of)

    def _number(self, *parts: object) -> int:
        return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), key=self._seed, digest_size=64).digest(), "big")

    def _order(self, value: int, left: int, right: int, tweak: str, sign: int) -> int:
        """A keyed permutation of the numbers below left * right (sign 1) or its inverse (sign -1)."""
        a, b = divmod(value, right)
        for i in range(_ROUNDS)[::sign]:
            if i % 2:
                b = (b + sign * self._number(tweak, i, left, right, a)) % right
            else:
                a = (a + sign * self._number(tweak, i, left, right, b)) % left
        return a * right + b

    def permuted(self, value: int, left: int, right: int, tweak: str) -> int:
        """A permutation of the numbers below left * right that leaves none where it is: one step on in a keyed order."""
        n = left * right
        return self._order((self._order(value, left, right, tweak, 1) + 1) % n, left, right, tweak, -1)

    def string(self, text: str, tweak: str, alphabet_of: dict[str, str] = _ALPHABET_OF, stays: int = -1, last: str | None = None) -> str:
        """Each letter and digit by one of its alphabet, but that at ``stays``, the last by one of ``last`` if given; a permutation of all strings of that shape.

        A piece of a long string is permuted as the pieces in front of it say, so that the whole is a permutation too.
        """
        if len(text) > _PIECE:
            out, before = [], b""
            for at in range(0, len(text), _PIECE):
                piece = text[at : at + _PIECE]
                ends = at + _PIECE >= len(text)
                out.append(self.string(piece, f"{tweak}\x1d{len(text)}\x1d{before.hex()}", alphabet_of, stays - at if stays >= at else -1, last if ends else None))
                before = hashlib.blake2b(before + piece.encode("utf-8", "surrogatepass"), digest_size=32).digest()
            return "".join(out)
        alphabets = [alphabet_of.get(c) or _neighbourhood(c) for c in text]
        if last is not None:
            alphabets[-1] = last
        places = [(i, alphabet) for i, alphabet in enumerate(alphabets) if len(alphabet) > 1 and i != stays]
        half = len(places) // 2
        value, left, right = 0, 1, 1
        for k, (i, alphabet) in enumerate(places):
            value = value * len(alphabet) + alphabet.index(text[i])
            if k < half:
                left *= len(alphabet)
            else:
                right *= len(alphabet)
        shape = "".join(alphabet[0] if len(alphabet) > 1 and i != stays else c for i, (c, alphabet) in enumerate(zip(text, alphabets, strict=True)))
        value = self.permuted(value, left, right, tweak + "\x1e" + shape)
        out = list(text)
        for i, alphabet in reversed(places):
            value, digit = divmod(value, len(alphabet))
            out[i] = alphabet[digit]
        return "".join(out)

    def drawn(self, kind: str, value: str) -> str:
        """The surrogate of a canonical value; a long one is not kept."""
        return self.of(kind, value) if len(value) <= _CACHED else self._of(kind, value)

    def _of(self, kind: str, value: str) -> str:
        """The surrogate of a canonical value."""
        if kind == "card":
            body, check = value[:-1], int(value[-1])
            new = self.string(body, kind)
            return new + str((_luhn(new) + check - _luhn(body)) % 10)
        if kind == "phone":
            country, rest = value.split("|")
            return country + "|" + self.string(rest, kind + country)
        if kind == "ip":
            return self._address(value)
        if kind == "email":
            local, domain = value.split("@")
            return self.string(local, kind) + "@" + self._domain(domain)
        if kind == "secret" or kind == "key":
            if kind == "key":
                return value[:4] + self.string(value[4:], kind)
            if all(c in _HEX for c in value):
                return self.string(value, kind, dict.fromkeys(_HEX, _HEX))
            if all(c in _HEX_UPPER for c in value):
                return self.string(value, kind, dict.fromkeys(_HEX_UPPER, _HEX_UPPER))
            return self.string(value, kind)
        if kind == "iban":
            body = self.string(value[4:], kind + value[:2])
            return f"{value[:2]}{98 - _iban_sum(value[:2] + '00' + body):02d}{body}"
        if kind.startswith("name"):
            return " ".join(map(self._name, value.split(" ")))
        return self.string(value, kind)

    def _address(self, value: str) -> str:
        fixed = 1 if value.startswith(("10.", "127.")) else 2 if re.match(r"192\.168\.|169\.254\.|172\.(1[6-9]|2[0-9]|3[01])\.", value) else 0
        parts = [int(x) for x in value.split(".")]
        number = 0
        for x in parts[fixed:]:
            number = number * 256 + x
        left = 256 ** ((4 - fixed) // 2)
        right = 256 ** (4 - fixed) // left
        while True:  # walks on along the permutation until the address is of the same class
            number = self.permuted(number, left, right, "ip" + ".".join(map(str, parts[:fixed])))
            new = ".".join(map(str, [*parts[:fixed], *number.to_bytes(4 - fixed, "big")]))
            if fixed or _class(new) == _class(value):
                return new

    def _domain(self, domain: str) -> str:
        labels = domain.split(".")
        kept = 2 if len(labels) > 2 and labels[-2] == "example" else 1  # reserved names stay reserved
        return ".".join([self.string(x, f"domain{len(labels) - i}") for i, x in enumerate(labels[:-kept])] + labels[-kept:])

    def _name(self, word: str) -> str:
        """A name of the same sounds; told apart, as it is written, by its letters alone."""
        low = word.lower() if len(word.lower()) == len(word) else word
        if low[-1] in _ENDINGS:
            new = self.string(low, "name", _SOUNDS, len(low) - 1)
        else:  # no other ending becomes one of those
            new = self.string(low, "name", _SOUNDS, last="".join(x for x in _SOUNDS.get(low[-1]) or _neighbourhood(low[-1]) if x not in _ENDINGS))
        return "".join(n.upper() if o.isupper() and len(n.upper()) == 1 else n for o, n in zip(word, new, strict=True))

    def replace(self, text: str, found: list[Entity]) -> str:
        out, at = [], 0
        for a, b, kind in found:
            out += [text[at:a], self.written(text[a:b], kind)]
            at = b
        return "".join([*out, text[at:]])

    def written(self, value: str, kind: str) -> str:
        """The surrogate in the format the value is written in."""
        new = self.drawn(kind, canonical(value, kind))
        if kind in ("phone", "card", "iban"):
            signs = iter(new.replace("|", ""))
            return "".join(next(signs) if c.isalnum() else c for c in value)
        if kind == "email":
            return "".join(n.upper() if o.isupper() else n for o, n in zip(value, new, strict=True))
        return new


@lru_cache(maxsize=4096)
def _neighbourhood(c: str) -> str:
    """The alphabet of a character of another script: the letters of its block; of anything else itself."""
    if not c.isalpha():
        return c
    block = ord(c) & ~0xFF
    return "".join(x for x in map(chr, range(block, block + 256)) if x.isalpha() and x not in _ALPHABET_OF and x.isupper() == c.isupper())


def _class(address: str) -> int:
    first = int(address.split(".")[0])
    private = re.match(r"10\.|127\.|192\.168\.|169\.254\.|172\.(1[6-9]|2[0-9]|3[01])\.", address)
    return 0 if private else 1 if first == 0 else 2 if first < 224 else 3


def canonical(value: str, kind: str) -> str:
    """What two ways to write the same have in common."""
    if kind == "phone":
        digits = "".join(c for c in value if c.isdigit())
        country = re.match(r"\+([0-9]{1,3})[ .(-]", value)
        n = len(country[1]) if country else max(0, len(digits) - 10) if value[0] == "+" else 0
        return digits[:n] + "|" + digits[n:]
    if kind == "card":
        return re.sub(r"[ -]", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "email":
        low = "".join(c.lower() if len(c.lower()) == 1 and c.lower().upper() == c else c for c in value)
        return low if low.count("@") == 1 else value
    return value


def entities(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, begin, end, kind, value) of the personal data; begin and end in characters, value canonical."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, value in enumerate(batch.column(1)):
                content = value.as_py() or ""
                rows += [(i, a, b, kind, canonical(content[a:b], kind)) for a, b, kind in find(content)]
            if rows:
                where, a, b, kind, value = zip(*rows, strict=True)
                ids = batch.column(0).take(pa.array(where, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(kind), pa.array(value)], names=["id", "begin", "end", "kind", "value"])

    kind = dict(df.dtypes)[key]
    found = df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, begin long, end long, kind string, value string")
    return found.withColumnRenamed("id", key)


def fit(work: Work, df: DataFrame, secret: bytes, text: str = "text") -> Surrogates:
    """The first draw in which the corpus's values have surrogates of their own: distinct, and none of them its own value."""
    listed = entities(df.select(F.lit(0).alias("_key"), F.col(text).alias("text")), "_key", "text").select("kind", "value").distinct()
    values = work.stage(listed)
    for attempt in range(ATTEMPTS):
        surrogates = Surrogates(secret, attempt)

        def draw(batches: Iterator[pa.RecordBatch], surrogates: tuple[bytes, int] = (secret, attempt)) -> Iterator[pa.RecordBatch]:
            own = Surrogates(*surrogates)
            for batch in batches:
                new = [own.drawn(k, v) for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], names=["kind", "value", "new"])

        drawn = values.mapInArrow(draw, "kind string, value string, new string")
        same = drawn.where("value = new").select("new")
        # Names are told apart whatever the gender of the title in front of them.
        group = F.when(F.col("kind").startswith("name"), "name").otherwise(F.col("kind"))
        value = F.when(group == "name", F.lower("value")).otherwise(F.col("value"))
        new = F.when(group == "name", F.lower("new")).otherwise(F.col("new"))
        pairs = drawn.select(group.alias("kind"), value.alias("value"), new.alias("new")).distinct()
        twice = pairs.groupBy("kind", "new").agg(F.count("*").alias("n")).where("n > 1").select("new")
        if not same.union(twice).limit(1).count():
            return surrogates
    raise ValueError("surrogates collide in every draw")


def replaced(df: DataFrame, surrogates: Surrogates, text: str = "text", counted: str | None = "n_entities") -> DataFrame:
    """The rows with personal data replaced in ``text``; adds how many were, unless ``counted`` is None."""
    secret, attempt = surrogates.key, surrogates.attempt
    keep = [c for c in df.columns if c != counted or c == text]
    added = [counted] if counted else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = Surrogates(secret, attempt), keep.index(text)
        for batch in batches:
            texts, counts = [], []
            for value in batch.column(at):
                content = value.as_py()
                found = find(content) if content else []
                texts.append(own.replace(content, found) if found else content)
                counts.append(len(found))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            if counted:
                columns.append(pa.array(counts, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *added])

    old = df.select(*[f"`{c}`" for c in keep])
    return old.mapInArrow(run, ", ".join([f"`{c}` {t}" for c, t in old.dtypes] + [f"`{c}` long" for c in added]))

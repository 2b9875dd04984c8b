"""Personal data: detected entities become keyed surrogates of the same type and format.

A surrogate is the image of the entity under a keyed permutation of all values of its
format: digits stay digits, letters letters of their script and case, vowels vowels,
separators stay, card numbers keep their issuer digit and check digit, addresses stay
public or private, given names stay in the pool of their gender and script. So

* equal entities get equal surrogates in every document (coreference), whatever their
  case or separators, and parts of a name named again in a text follow it;
* distinct entities of a kind get distinct surrogates, none its own: the permutation is
  one keyed cycle. ``collisions`` checks that over a whole table. A surrogate may equal
  another entity's original, but that one is replaced too, so the two stay distinct.

Nothing is shuffled and no table of entities is kept; the key alone fixes the mapping.

Defined cases: a null text stays null, an empty one empty; every row gives one row,
repeated rows included; all other columns pass through.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names by script and gender, and titles by gender, that mark a person.
GIVEN = {
    ("latin", "f"): (
        "Alice Amanda Barbara Carmen Catherine Charlotte Claire Elena Elizabeth Emily Fiona "
        "Hannah Helen Isabel Jennifer Jessica Julia Karin Laura Linda Lucia Margaret Maria "
        "Martina Michelle Monika Nancy Patricia Petra Rachel Rebecca Sandra Sarah Sophie Susan "
        "Ursula Valentina Victoria").split(),
    ("latin", "m"): (
        "Andrew Anthony Carlos Charles Christopher Daniel David Edward Francisco George "
        "Hans Henri Jacques James Javier John Joseph Juan Klaus Kevin Louis Manuel Matthew "
        "Michael Miguel Patrick Pedro Peter Philippe Pierre Richard Robert Stefan Steven "
        "Thomas Walter William Wolfgang").split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Светлана Татьяна Юлия Екатерина".split(),
    ("cyrillic", "m"): "Иван Алексей Сергей Дмитрий Андрей Михаил Николай Павел Владимир Юрий".split(),
}
TITLES = {
    "f": "Mrs Ms Miss Madame Mme Mlle Frau Señora Sra Госпожа".split(),
    "m": "Mr Monsieur Herr Señor Господин".split(),
}
VOWELS = {"latin": "aeiouy", "cyrillic": "аеёиоуыэюя", "greek": "αεηιουω"}
CONSONANTS = {"latin": "bcdfghjklmnpqrstvwxz", "cyrillic": "бвгджзйклмнпрстфхцчшщ", "greek": "βγδζθκλμνξπρστφχψ"}
DIGITS = "0123456789"

_CLASSES = [DIGITS, *VOWELS.values(), *CONSONANTS.values()]
_CLASS_OF = {c: k for k, letters in enumerate(_CLASSES) for c in letters}
_ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_PATTERN = re.compile(
    r"(?P<email>(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-]))"
    rf"|(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d))"
    r"|(?P<card>(?<![\w+])[3-6]\d{3}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}(?!\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\w))")

_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_TITLE = {title: gender for gender, titles in TITLES.items() for title in titles}
_SURNAME = r"[^\W\d_a-zа-яß-öø-ÿ][^\W\d_]+"
_PERSON = re.compile(
    rf"\b(?:(?P<title>{'|'.join(_TITLE)})\.? )?(?P<given>{'|'.join(_GENDER)}) (?P<family>{_SURNAME})\b"
    rf"|\b(?P<only>{'|'.join(_TITLE)})\.? (?P<called>{_SURNAME})\b")

KINDS = ("email", "ip", "card", "ssn", "phone", "name")


class Surrogates:
    """The keyed mapping. One object per task; it holds nothing but a bounded memory."""

    def __init__(self, key: str) -> None:
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()
        self.of = lru_cache(100_000)(self._of)

    def _round(self, tweak: bytes, k: int, half: int, width: int) -> int:
        size = max(8, (width + 7) // 8 + 8)
        data = k.to_bytes(1, "big") + half.to_bytes((width + 7) // 8 or 1, "big") + tweak
        digest = b""
        while len(digest) < size:
            digest += hashlib.blake2b(data + len(digest).to_bytes(4, "big"), key=self.key).digest()
        return int.from_bytes(digest[:size], "big") & ((1 << width) - 1)

    def _shuffled(self, value: int, size: int, tweak: bytes, back: bool) -> int:
        """A keyed permutation of range(size) or its inverse: Feistel rounds, walked until inside."""
        width = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << width) - 1
        while True:
            left, right = value >> width, value & mask
            for k in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
                if back:
                    left, right = right ^ self._round(tweak, k, left, width), left
                else:
                    left, right = right, left ^ self._round(tweak, k, right, width)
            value = left << width | right
            if value < size:
                return value

    def image(self, value: int, size: int, tweak: bytes) -> int:
        """The next value on one keyed cycle through range(size): one to one, never itself."""
        if size < 2:
            return value
        at = self._shuffled(value, size, tweak, back=False)
        return self._shuffled((at + 1) % size, size, tweak, back=True)

    def spelled(self, text: str, tweak: str, fixed: frozenset[int] = frozenset()) -> str:
        """Each digit or letter replaced within its class; case, others and ``fixed`` places stay."""
        low = text.lower()
        if len(low) != len(text):
            low = text
        places = [(i, _CLASS_OF[c]) for i, c in enumerate(low) if c in _CLASS_OF and i not in fixed]
        value, size = 0, 1
        for i, kind in places:
            letters = _CLASSES[kind]
            value, size = value * len(letters) + letters.index(low[i]), size * len(letters)
        form = f"{tweak}:{''.join(chr(65 + k) for _, k in places)}"
        value = self.image(value, size, form.encode())
        out = list(text)
        for i, kind in reversed(places):
            letters = _CLASSES[kind]
            value, at = divmod(value, len(letters))
            out[i] = letters[at].upper() if text[i] != low[i] else letters[at]
        return "".join(out)

    def _digits(self, text: str, tweak: str, keep: int) -> str:
        """Digits replaced but the first ``keep``; other characters stay."""
        digits = "".join(c for c in text if c in DIGITS)
        new = iter(self.spelled(digits, tweak, frozenset(range(keep))))
        return "".join(next(new) if c in DIGITS else c for c in text)

    def _card(self, text: str) -> str:
        digits = "".join(c for c in text if c in DIGITS)
        if luhn(digits) != 0:
            return self._digits(text, "card", 1)
        body = self.spelled(digits[:-1], "luhn", frozenset({0}))
        new = iter(body + str(-luhn(body + "0") % 10))
        return "".join(next(new) if c in DIGITS else c for c in text)

    def _ip(self, text: str) -> str:
        address = ipaddress.IPv4Address(text)
        value = int(address)
        for net in (ipaddress.IPv4Network(n) for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")):
            if address in net:
                inner = self.image(value - int(net[0]), net.num_addresses, str(net).encode())
                return str(net[inner])
        while True:  # one cycle of the permutation, so still one to one
            value = self.image(value, 1 << 32, b"ip")
            if ipaddress.IPv4Address(value).is_global == address.is_global and not any(
                    ipaddress.IPv4Address(value) in ipaddress.IPv4Network(n)
                    for n in ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")):
                return str(ipaddress.IPv4Address(value))

    def _phone(self, text: str) -> str:
        code = re.match(r"\+\d{1,3}(?!\d)", text)
        keep = len(code.group()) - 1 if code else (1 if text.startswith("+") else 0)
        return self._digits(text, f"phone{text[:keep + 1] if keep else ''}", keep)

    def _name(self, word: str) -> str:
        if word in _GENDER:
            pool = GIVEN[_GENDER[word]]
            tweak = "/".join(_GENDER[word]).encode()
            return pool[self.image(pool.index(word), len(pool), tweak)]
        return self.spelled(word, "name")

    def _email(self, text: str) -> str:
        top = text.rindex(".")
        return self.spelled(text[:top], "email") + text[top:]

    def _of(self, kind: str, text: str) -> str:
        if kind == "ssn":
            return self._digits(text, "ssn", 0)
        return getattr(self, f"_{kind}")(text)


def luhn(digits: str) -> int:
    """The check sum of a card number, 0 if it holds."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, in order, not overlapping.

    A name gives one entity per word; words of a found name are found again alone.
    """
    found = [(m.start(), m.end(), m.lastgroup if m.lastgroup != "gap" else "card")
             for m in _PATTERN.finditer(text)]
    people = list(_PERSON.finditer(text))
    words = {m[g] for m in people for g in ("given", "family", "called") if m[g]}
    if words:
        again = re.compile(rf"\b(?:{'|'.join(sorted(map(re.escape, words), key=len, reverse=True))})\b")
        taken = [(a, b) for a, b, _ in found]
        found += [(m.start(), m.end(), "name") for m in again.finditer(text)
                  if not any(a < m.end() and m.start() < b for a, b in taken)]
    return sorted(found)


def replaced_text(text: str, surrogates: Surrogates) -> tuple[str, list[dict]]:
    """The text with surrogates, and its entities: kind, place, original and surrogate."""
    places = entities(text)
    out, at, rows = [], 0, []
    for a, b, kind in places:
        out += [text[at:a], surrogates.of(kind, text[a:b])]
        at = b
        rows.append({"kind": kind, "original": text[a:b], "surrogate": out[-1]})
    out.append(text[at:])
    return "".join(out), rows


def replaced(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with surrogates in a text column; all other columns pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in batches:
            at = batch.schema.get_field_index(column)
            texts = [t and replaced_text(t, surrogates)[0] for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.types[at]))

    return docs.mapInArrow(run, docs.schema)


FOUND = "entities array<struct<kind: string, original: string, surrogate: string>>"


def found(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, entities): the replaced text, and the entities in order."""
    kind = pa.list_(pa.struct([(n, pa.string()) for n in ("kind", "original", "surrogate")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in batches:
            results = [(t, []) if not t else replaced_text(t, surrogates)
                       for t in batch.column("text").to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                "text": pa.array([t for t, _ in results], pa.string()),
                "entities": pa.array([e for _, e in results], kind)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, text string, {FOUND}")


def collisions(found: DataFrame) -> DataFrame:
    """(kind, surrogate, originals) of surrogates that stand for several entities; none by right."""
    each = found.select(F.explode("entities").alias("e")).select("e.*").distinct()
    return each.groupBy("kind", "surrogate").agg(F.count("*").alias("originals")).where("originals > 1")

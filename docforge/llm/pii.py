"""Surrogates for personal data and secrets: keyed bijections within the format of each entity."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import gcd

import pyarrow as pa
from pyspark.sql import DataFrame

from docforge.llm.common import map_arrow, widened

# Given names by script and gender, letters by script, titles by gender.
NAMES = {
    ("latin", "f"): "Alice Amelia Barbara Camille Carmen Catherine Charlotte Christine Elena Elizabeth Emily Emma Francesca Friederike Gabriela Hannah Heike Ingrid Isabella Jennifer Jessica Katharina Laura Lucia Margaret Martina Mary Michelle Monika Natalie Olivia Patricia Petra Rachel Rebecca Sabine Sarah Sophie Susan Ursula Victoria Yvonne".split(),
    ("latin", "m"): "Alexander Andreas Anthony Antonio Benjamin Bernhard Carlos Charles Christopher Daniel David Diego Edward Fernando Francisco Frederic George Gerhard Guillaume Heinrich Henry Jacques James Javier John Joseph Juan Jürgen Kevin Manuel Matthew Michael Miguel Nicolas Patrick Paul Pierre Richard Robert Stefan Thomas Wolfgang William".split(),
    ("cyrillic", "f"): "Анна Валентина Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Борис Владимир Дмитрий Иван Михаил Николай Сергей".split(),
    ("greek", "f"): "Αικατερίνη Άννα Βασιλική Ελένη Ιωάννα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξανδρος Γεώργιος Δημήτριος Ιωάννης Κωνσταντίνος Νικόλαος Παναγιώτης".split(),
}
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ", "áàâäçéèêëíîïñóôöúùûüÿ"]
TITLES = {"m": ["Mr", "Mr.", "Herr", "Monsieur", "Señor", "Sr."], "f": ["Mrs", "Mrs.", "Ms", "Ms.", "Frau", "Madame", "Mme", "Señora", "Sra."]}

#: Words before a person's name, in lower case: "my name is", "signed by", "Dear" and their like.
CUES = ["my name is", "name is", "name:", "i am", "dear", "signed by", "signed,", "contact", "regards,", "sincerely,", "mein name ist", "ich heiße", "lieber", "liebe", "je m'appelle", "cher", "chère", "me llamo", "mi nombre es", "querido", "querida", "меня зовут"]
NO_NAMES = {"Sir", "Sirs", "Madam", "All", "Customer", "Customers", "Friend", "Friends", "Team", "Us"}
VOWELS = "aeiouyаеиоуыэюяαεηιουωáàâäéèêëíîïóôöúùûü"

CLASS = {c: a for a in ALPHABETS for c in a}
#: For names: vowels by vowels and consonants by consonants of the same script and case, so that they can be spoken.
SPOKEN = {c: "".join(x for x in a if (x.lower() in VOWELS) == (c.lower() in VOWELS)) for a in ALPHABETS[1:] for c in a}
GENDER = {name: key for key, names in NAMES.items() for name in names}
WORD = re.compile(r"[^\W\d_]+\.?")
HEXADECIMAL, HEX = re.compile("[0-9a-f]+"), {c: "0123456789abcdef" for c in "0123456789abcdef"}
CUE = re.compile(r"(?i)(?<!\w)(?:" + "|".join(re.escape(c).replace(r"\ ", r"\s+") for c in CUES) + r")\s+")
#: Address blocks whose kind a surrogate keeps: this network, private, loopback, link-local, multicast and beyond.
BLOCKS = [("0.0.0.0", 8), ("10.0.0.0", 8), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.168.0.0", 16), ("224.0.0.0", 4), ("240.0.0.0", 4)]
PATTERNS = [
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}")),
    ("ipv4", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)")),
    ("card", re.compile(r"(?<![\d.])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?!\d)")),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d){8,12}(?!\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("key", re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA|ghp_|gho_|xoxb-|sk-)[A-Za-z0-9]{16,}(?![A-Za-z0-9])")),
    ("secret", re.compile(r"(?i)(?<=[\"'=: ])(?<![A-Za-z0-9])[0-9a-f]{16,}(?![A-Za-z0-9])|(?<=password=)\S{6,}|(?<=passwd=)\S{6,}|(?<=api_key=)\S{6,}")),
]
RANGES = sorted((int.from_bytes(bytes(map(int, a.split("."))), "big"), int.from_bytes(bytes(map(int, a.split("."))), "big") + (1 << 32 - n) - 1) for a, n in BLOCKS)
#: What every match of a pattern holds; texts without it are not searched for the whole.
NEEDS = {"email": re.compile("@"), "ipv4": re.compile(r"\d\.\d"), "card": re.compile(r"\d{4}"), "phone": re.compile(r"\d"), "ssn": re.compile(r"\d{3}-")}
TITLE_WORDS = {t for own in TITLES.values() for t in own}
OPENS = frozenset(GENDER) | TITLE_WORDS
SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
#: Letters that are one number; a longer value is taken in such pieces, as numbers cost the square of their length.
PIECE = 128


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1], 1))
    return total % 10 == 0


@lru_cache(1 << 14)
def kin(c: str) -> str:
    """What a character outside of the alphabets may become: a sign of ASCII for one, else one of its category in its block
    of 256. Kin and alphabets share no character, so that values of different formats stay distinct too."""
    if c in SIGNS:
        return SIGNS
    first, category = ord(c) & ~255, unicodedata.category(c)
    if c.isspace() or ord(c) < 128:
        return c
    return "".join(x for x in map(chr, range(max(first, 128), first + 256)) if unicodedata.category(x) == category and x not in CLASS)


class Surrogates:
    """One bijection for each kind and format, without fixed points, so that distinct values stay distinct.

    A value is a number n below the count N of values of its format. With P a keyed permutation (a Feistel network that
    walks until it is below N) the surrogate is P'(P(n) + r mod N), r from 1 to N - 1: one cycle through all values.
    """

    def __init__(self, key: bytes) -> None:
        self.key = key
        self.piece = lru_cache(1 << 16)(self._letters)

    def _round(self, tag: str, i: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{tag}|{i}|{half}".encode(), key=self.key, digest_size=32).digest(), "big")

    def _permute(self, tag: str, n: int, count: int, back: bool) -> int:
        bits = max(1, (count - 1).bit_length() + 1 >> 1)
        mask = (1 << bits) - 1
        while True:
            left, right = n >> bits, n & mask
            for i in reversed(range(8)) if back else range(8):
                if back:
                    left, right = right ^ (self._wide(tag, i, left, bits) & mask), left
                else:
                    left, right = right, left ^ (self._wide(tag, i, right, bits) & mask)
            n = left << bits | right
            if n < count:
                return n

    def _wide(self, tag: str, i: int, half: int, bits: int) -> int:
        out, k = 0, 0
        while k * 256 < bits:
            out |= self._round(f"{tag}|{k}", i, half) << 256 * k
            k += 1
        return out

    def number(self, tag: str, n: int, count: int) -> int:
        if count < 2:
            return n
        tag = f"{tag}|{count}"
        step = 1 + self._round(tag, -1, 0) % (count - 1)
        while gcd(step, count) > 1:
            step = step % (count - 1) + 1
        return self._permute(tag, (self._permute(tag, n, count, False) + step) % count, count, True)

    def letters(self, tag: str, text: str, table: str = "class") -> str:
        return "".join(self.piece(f"{tag}+{i}" if i else tag, text[i : i + PIECE], table) for i in range(0, len(text), PIECE))

    def _letters(self, tag: str, text: str, table: str = "class") -> str:
        """Each letter or digit by one of its class (script and case; hexadecimal; speakable), those outside of the
        alphabets by their kin; signs of ASCII stay unless all characters are to change."""
        own = {"class": CLASS, "hex": HEX, "spoken": SPOKEN, "all": CLASS}[table]
        classes = [own.get(c) or (None if c in SIGNS and table != "all" or c.isspace() else kin(c)) for c in text]
        n, count, shape = 0, 1, []
        for c, a in zip(text, classes, strict=True):
            if a:
                n, count = n * len(a) + a.index(c), count * len(a)
            shape.append(a[0] if a else c)
        n, out = self.number(f"{tag}|{''.join(shape)}", n, count), []
        for c, a in zip(reversed(text), reversed(classes), strict=True):
            if a:
                n, k = divmod(n, len(a))
                c = a[k]
            out.append(c)
        return "".join(reversed(out))

    def cased(self, tag: str, text: str) -> str:
        """Letters without regard to case, which is put back: spellings of one value keep one surrogate."""
        new = self.letters(tag, text.lower()) if len(text.lower()) == len(text) else self.letters(tag, text)
        return "".join(b.upper() if a.isupper() and len(b.upper()) == 1 else b for a, b in zip(text, new, strict=True))

    def digits(self, tag: str, text: str, own: Callable[[str], bool] | None = None) -> str:
        """The digits of ``text`` in their places; with ``own``, walked until it says of old and new the same."""
        old = new = "".join(c for c in text if c.isdigit())
        while True:
            new = self.letters(tag, new)
            if own is None or own(new) == own(old):
                break
        it = iter(new)
        return "".join(next(it) if c.isdigit() else c for c in text)

    def email(self, text: str) -> str:
        name, _, domain = text.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{self.cased('email', name)}@{self.cased('domain', host)}.{top}"

    def ipv4(self, text: str) -> str:
        """A number within the address's own block, or among all addresses outside of the blocks."""
        old = int.from_bytes(bytes(int(p) for p in text.split(".")), "big")
        for first, last in RANGES:
            if first <= old <= last:
                return self._dotted(first + self.number(f"ipv4|{first}", old - first, last - first + 1))
        place, size = old, 1 << 32
        for first, last in RANGES:
            size -= last - first + 1
            place -= last - first + 1 if last < old else 0
        new = self.number("ipv4", place, size)
        for first, last in RANGES:
            new += last - first + 1 if first <= new else 0
        return self._dotted(new)

    @staticmethod
    def _dotted(n: int) -> str:
        return ".".join(str(b) for b in n.to_bytes(4, "big"))

    def card(self, text: str) -> str:
        head = text[0]
        return head + self.digits(f"card{head}", text[1:], lambda d: luhn(head + d))

    def phone(self, text: str) -> str:
        """The last ten digits change, the country code stays; one number in several formats keeps one surrogate."""
        at = [i for i, c in enumerate(text) if c.isdigit()]
        cut = at[max(0, len(at) - 10)]
        return text[:cut] + self.digits("phone", text[cut:], lambda d: len(d) == 10 and d[0] in "23456789" and d[3] in "23456789")

    def key_value(self, text: str) -> str:
        prefix = re.match(r"AKIA|ASIA|ghp_|gho_|xoxb-|sk-", text)
        at = prefix.end() if prefix else 0
        return text[:at] + self.letters(f"key{text[:at]}", text[at:])

    def secret(self, text: str) -> str:
        """Hexadecimal secrets among themselves, others among others: both walks stay on one cycle of a bijection."""
        if HEXADECIMAL.fullmatch(text):
            return self.letters("secret", text, "hex")
        new = self.letters("secret", text, "all")
        while HEXADECIMAL.fullmatch(new):
            new = self.letters("secret", new, "all")
        return new

    def masked(self, kind: str, text: str) -> str:
        """For a value that has no other of its format: a keyed digest in its place."""
        return hashlib.blake2b(f"{kind}|{text}".encode(), key=self.key, digest_size=16).hexdigest()

    def given(self, name: str) -> str:
        kind = GENDER[name]
        pool = NAMES[kind]
        return pool[self.number(f"given{kind}", pool.index(name), len(pool))]

    def surname(self, name: str) -> str:
        """A speakable name of the same length, script and case; not one of the given names."""
        new = self.letters("surname", name, "spoken")
        while new in GENDER or new == name:
            if new == name and all(c not in SPOKEN or len(SPOKEN[c]) < 2 for c in name):
                break  # nothing to exchange
            new = self.letters("surname", new, "spoken")
        return new

    def of(self, kind: str, text: str) -> str:
        return {"email": self.email, "ipv4": self.ipv4, "card": self.card, "phone": self.phone, "ssn": lambda t: self.digits("ssn", t), "key": self.key_value, "secret": self.secret, "given": self.given, "surname": self.surname}[kind](text)


def people(text: str) -> list[tuple[int, int, str]]:
    """Spans of given names and surnames: a known given name before a capitalised word, a title before such a word, or
    a cue such as "my name is" before one or two; and in the same text every later or earlier mention of these words."""
    words = [(m.start(), m.end(), m.group()) for m in WORD.finditer(text)]
    known: dict[str, str] = {}
    proper = lambda w: len(w) > 1 and w[0].isupper() and w[1:].islower()
    kind = lambda w: "given" if w in GENDER else "surname"
    for (_, e, a), (s, _, b) in zip(words, words[1:], strict=False):
        b = b.rstrip(".")
        if text[e:s] == " " and proper(b):
            if a in GENDER:
                known[a] = "given"
                known.setdefault(b, kind(b))
            elif a in TITLE_WORDS:
                known.setdefault(b, kind(b))
    for m in CUE.finditer(text):
        at = m.end()
        for _ in range(2):
            found = WORD.match(text, at)
            name = found.group().rstrip(".") if found else ""
            if not proper(name) or name in TITLE_WORDS or name in NO_NAMES:
                break
            known.setdefault(name, kind(name))
            at = found.end() + 1
            if text[found.end() : at] != " ":
                break
    if not known:
        return []
    return [(s, s + len(w.rstrip(".")), known[w.rstrip(".")]) for s, _, w in words if w.rstrip(".") in known]


def detect(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in order, without overlaps; of two the earlier in PATTERNS wins, names come last."""
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(text))

    def take(start: int, end: int, kind: str) -> None:
        if taken.find(1, start, end) < 0:
            found.append((start, end, kind))
            taken[start:end] = b"\x01" * (end - start)

    for kind, pattern in PATTERNS:
        if kind not in NEEDS or NEEDS[kind].search(text):
            for m in pattern.finditer(text):
                take(m.start(), m.end(), kind)
    if not OPENS.isdisjoint(WORD.findall(text)) or CUE.search(text):
        for p in people(text):
            take(*p)
    return sorted(found)


def replace(text: str, surrogates: Surrogates) -> tuple[str, list[dict]]:
    """(text with surrogates, the entities).

    Should two values of one kind have one surrogate in spite of the bijections, the later one is mapped on until its
    surrogate is its own; so is each mention of it in this text. A value that keeps itself, or finds no free surrogate, is
    masked by a digest.
    """
    out, at, entities, given, chosen = [], 0, [], {}, {}
    for start, end, kind in detect(text):
        old = text[start:end]
        new = chosen.get((kind, old))
        if new is None:
            new = surrogates.of(kind, old)
            for _ in range(64):
                if given.get((kind, new), old) == old and new != old:
                    break
                new = surrogates.of(kind, new)
            if given.get((kind, new), old) != old or new == old:
                new = surrogates.masked(kind, old)
            given.setdefault((kind, new), old)
            chosen[kind, old] = new
        out += [text[at:start], new]
        entities.append({"kind": kind, "start": start, "end": end, "surrogate": new})
        at = end
    return "".join([*out, text[at:]]), entities


ENTITY = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", out: str = "entities") -> DataFrame:
    """``docs`` with surrogates in ``text`` and the list ``out`` of entities (kind, character span of the input, surrogate).

    Kinds: email, ipv4, card, phone, ssn, key, secret, given name, surname. A value has the same surrogate wherever it
    stands under one ``key``, other values of its kind have others, and none keeps its own. Formats stay: letters by
    letters of their script and case, digits by digits, separators and the top-level domain, Luhn's check, the class of
    an address (private, loopback, public); in secrets signs change too; given names stay within their script and gender. As every surrogate is the
    value of a bijection, no table of values is kept or shuffled; distinctness is checked again in each text. Null texts
    stay null with no entities. A column called ``out`` is replaced. Repeated rows come out alike.
    """
    docs = docs.drop(out)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in batches:
            pairs = [(None, []) if t is None else replace(t, surrogates) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([p[0] for p in pairs], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([p[1] for p in pairs], ENTITY)], names=[*batch.schema.names, out])

    return map_arrow(docs, run, widened(docs.schema, f"{out} array<struct<kind:string,start:int,end:int,surrogate:string>>"))

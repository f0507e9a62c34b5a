"""PII surrogates: keyed, type-consistent replacements.

Detected entities are e-mail addresses, telephone numbers (international ones
too), IP addresses (IPv4 and IPv6), card, account (IBAN) and social security
numbers, secrets (behind a key word, by the prefix of their issuer, or in a PEM
block), and personal names behind a title with all their later and earlier
mentions in the document.  A surrogate is a keyed permutation of the entities of
its own type and format: digits go to digits, letters to letters of the same
script and case (and kind, vowel or consonant, where the script has a row for
each); separators, country codes before ten digits, Luhn and IBAN validity stay.  A given name goes
to another one of the same gender and script.

As each is a permutation, two entities of one format never share a surrogate, at
any scale and without a table of all entities; as it has no fixed point, none
stays as it is; and as it works on the entity's canonical form, all its mentions
(in other case or with other separators) get the same surrogate in every
document.  Where two permutations serve one format (given names of the fixed
lists and other names, hexadecimal and other secrets), neither gives what the
other may give.  ``checked_surrogates`` detects once, and fails if two entities
share a surrogate or one stays as it is.

Every label of a host turns, but for the public suffix, and a label turns alike
under all names of its domain: addresses of one company keep one company.

Defined results: a null text stays null with zero counts; rows with a null or
repeated doc_id are treated one by one; a very long text is treated as a whole;
an empty table gives no rows.  Input columns that clash with the counts are
replaced; without counts all columns stay.

Entities go to their natural end, however long: a keyed secret to white space or
a quote, a hexadecimal run to its last digit, a name over all capitalised words,
initials and particles behind its title.  Scripts without case show no end of a
name: there it is the first two words behind the title.  A further mention of a
titled name is a word of three characters or more, capitalised and the same but
for case, unless the document also writes it in lower case (``May``, ``may``); a
given name of the fixed lists right before it goes with it.

Not detected: keyed secrets of under 12 characters, hexadecimal runs of under 32,
names that no title introduces in their document, postal addresses.
"""

from __future__ import annotations

import ipaddress
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tune

TYPES = ["email", "phone", "ip", "card", "iban", "ssn", "secret", "name"]

#: Given names by gender and script, and titles by gender.
MALE = "Adam Albert Anton Bruno Carl Daniel David Emil Felix Hugo Ivan James Jean John Jorge Juan Karl Louis Lucas Marco Martin Michael Oscar Otto Paul Pedro Peter Robert Thomas Victor".split()
FEMALE = "Ada Alice Anna Carla Clara Diana Elena Elsa Emma Eva Flora Hanna Helena Ida Ines Jane Julia Laura Lucia Maria Marta Mary Nina Olga Paula Rosa Sara Sofia Teresa Vera".split()
MALE_CYRILLIC = "Андрей Борис Виктор Иван Игорь Михаил Николай Олег Павел Сергей".split()
FEMALE_CYRILLIC = "Анна Вера Галина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split()
TITLES = ["Mr", "Mrs", "Ms", "Miss", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra", "Dr", "Dra", "Prof", "Professor"]
#: Words in lower case that may stand between the parts of a name.
PARTICLES = frozenset("af al bin da das de del della den der di do dos du el ibn la las le los ter ten van vom von y zu zum zur".split())
POOLS = {name.lower(): pool for pool in (MALE, FEMALE, MALE_CYRILLIC, FEMALE_CYRILLIC) for name in pool}
#: Letters that a letter may become: one of its own row.
ROWS = ["aeiouy", "bcdfghjklmnpqrstvwxz", "áâàäãåæéêèëíîìïóôòöõøúûùüýÿ", "çñßðþ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "0123456789"]
ROW = {c: row for row in ROWS for c in row}
#: Names under which others register, besides the last label of a host: in any country, and names that stand for nobody.
SECOND_LEVEL = frozenset("ac co com edu gob gov go ltd ne net nom or org".split())
NOBODYS = frozenset(["example.com", "example.net", "example.org"])
#: Longer entities are permuted in parts of so many characters, as one number takes time with the square of its length.
PART = 256


def _round(key: bytes, tweak: str, r: int, half: int, bits: int) -> int:
    said = f"{tweak}|{r}|{half}"
    h = b"".join(blake2b((f"{said}|{i}" if i else said).encode(), key=key, digest_size=32).digest() for i in range(-(-bits // 256)))
    return int.from_bytes(h, "big") & ((1 << bits) - 1)


def _feistel(n: int, size: int, key: bytes, tweak: str, back: bool) -> int:
    """A keyed permutation of range(size), or its inverse: Feistel rounds, walked until the number is in range."""
    bits = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = (1 << bits) - 1
    while True:
        left, right = n >> bits, n & mask
        for r in range(5, -1, -1) if back else range(6):
            if back:
                left, right = right ^ _round(key, tweak, r, left, bits), left
            else:
                left, right = right, left ^ _round(key, tweak, r, right, bits)
        n = left << bits | right
        if n < size:
            return n


def permuted(n: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size) without fixed points (where size > 1): the next number in a keyed order."""
    return _feistel((_feistel(n, size, key, tweak, False) + 1) % size, size, key, tweak, True)


def _parts(text: str, key: bytes, kind: str) -> Iterator[tuple[str, str]]:
    """Parts of a text and their tweaks.  A tweak depends on all parts before its own, so the whole stays a permutation."""
    before = blake2b(key=key, digest_size=16)
    for k in range(0, len(text), PART):
        part = text[k : k + PART]
        yield part, f"{kind}{k}|{before.hexdigest()}" if k else kind
        before.update(part.encode())


def _turned(text: str, rows: list[str], key: bytes, kind: str, barred: Callable[[str], bool]) -> str:
    """Each character of ``text``, which isn't barred, becomes another of its row: the next text in a keyed order that isn't barred."""
    n, size = 0, 1
    for c, row in zip(text, rows):
        n, size = n * len(row) + row.index(c), size * len(row)
    while True:
        k = n = permuted(n, size, key, f"{kind}|{'|'.join(rows)}")
        out = []
        for row in reversed(rows):
            k, i = divmod(k, len(row))
            out.append(row[i])
        if not barred(new := "".join(reversed(out))):
            return new


def _class(c: str) -> tuple[str, str, bool]:
    """Script, category, and whether there is a capital that has ``c`` as its small letter."""
    return unicodedata.name(c, "").partition(" ")[0], unicodedata.category(c), c != c.upper() and _lower(c.upper()) == c


@lru_cache(1)
def _lonely() -> dict[tuple[str, bool], str]:
    """Letters and numbers that have no other of their class in their block: letters turn into letters, numbers into numbers."""
    out: dict[tuple[str, bool], str] = {}
    for block in range(0, 0x110000, 128):
        members: dict[tuple, str] = {}
        for c in _free(block):
            members[_class(c)] = members.get(_class(c), "") + c
        for (_, category, cased), found in members.items():
            if len(found) == 1:
                out[category[0], cased] = out.get((category[0], cased), "") + found
    return out


def _free(block: int) -> list[str]:
    """Small or caseless letters and numbers of a block of 128 that no fixed row holds."""
    return [c for c in map(chr, range(block, block + 128)) if unicodedata.category(c)[0] in "LN" and c not in ROW and _lower(c) == c]


@lru_cache(10_000)
def _row(c: str) -> str:
    """What a character (canonical: lower case) may become: one of its fixed row or of its class and block; all but letters and numbers only itself."""
    if c in ROW:
        return ROW[c]
    if unicodedata.category(c)[0] not in "LN" or _lower(c) != c:
        return c
    kind = _class(c)
    row = "".join(x for x in _free(ord(c) & ~127) if _class(x) == kind)
    return row if len(row) > 1 else _lonely()[kind[1][0], kind[2]]


def _letters(text: str, key: bytes, kind: str, barred: Callable[[str], bool] = lambda new: False) -> str:
    """Letters and digits of ``text`` (canonical: lower case) become others of their rows; all else stays."""
    return "".join(_turned(part, [_row(c) for c in part], key, tweak, barred) for part, tweak in _parts(text, key, kind))


def _suffix(host: str) -> bool:
    """Whether others register names under ``host`` (lower case)."""
    first, dot, last = host.partition(".")
    return not dot or host in NOBODYS or ("." not in last and len(last) == 2 and first in SECOND_LEVEL)


def _host(host: str, key: bytes) -> str:
    """The surrogate of a host (lower case): from the public suffix to the left, each label turns by all that stands right of it."""
    label, dot, rest = host.partition(".")
    if _suffix(host):
        return host
    # No name becomes a public suffix, so none gets the place of names that are registered under one.
    return _letters(label, key, f"host|{rest}", lambda new: _suffix(f"{new}.{rest}")) + dot + _host(rest, key)


def _cased(like: str, low: str) -> str:
    """``low`` in the case of ``like``, letter by letter, where that can be undone."""
    return "".join(c.upper() if a != a.lower() and _lower(c.upper()) == c else c for a, c in zip(like, low))


def _lower(text: str) -> str:
    """Lower case, but for letters that lower case would lengthen; both lower case sigmas are one letter."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text).replace("ς", "σ")


def _digits(entity: str, changed: str) -> str:
    it = iter(changed)
    return "".join(next(it) if c.isdigit() else c for c in entity)


def _luhn(digits: str) -> int:
    """The check digit that ``digits`` need."""
    total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _mod97(code: str) -> int:
    """Remainder of an account number, country and check digits last, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in code)) % 97


@lru_cache(100_000)
def surrogate(kind: str, entity: str, key: bytes) -> str:
    """The replacement of one entity."""
    if kind == "email":
        local, _, host = entity.rpartition("@")
        # The host also decides how local parts turn, so equal ones differ at other hosts.
        low = _letters(_lower(local), key, f"email|{_lower(host)}")
        return f"{_cased(local, low)}@{_cased(host, _host(_lower(host), key))}"
    if kind == "ip" and ":" in entity:
        return str(ipaddress.IPv6Address(permuted(int(ipaddress.IPv6Address(entity)), 1 << 128, key, "ipv6")))
    if kind == "ip":
        n = int.from_bytes(bytes(map(int, entity.split("."))), "big")  # parts may have leading zeros
        return str(ipaddress.IPv4Address(permuted(n, 1 << 32, key, "ip")))
    if kind in ("phone", "ssn"):
        d = "".join(c for c in entity if c.isdigit())
        tail = d[-10:] if kind == "phone" else d
        return _digits(entity, d[: len(d) - len(tail)] + _letters(tail, key, kind))
    if kind == "card":
        d = "".join(c for c in entity if c.isdigit())
        body = d[0] + _letters(d[1:-1], key, f"card{d[0]}")
        return _digits(entity, body + str((_luhn(body) + int(d[-1]) - _luhn(d[:-1])) % 10))
    if kind == "iban":
        bare = canonical(kind, entity)
        body = _letters(bare[4:].lower(), key, f"iban{bare[:2]}").upper()
        new = iter(f"{bare[:2]}{98 - _mod97(f'{body}{bare[:2]}00'):02d}{body}")
        return "".join(c if c == " " else next(new) for c in entity)
    if kind == "secret":
        return _cased_secret(entity, key)
    if kind == "name" and (pool := POOLS.get(_lower(entity))):
        other = pool[permuted(pool.index(_lower(entity).capitalize()), len(pool), key, f"name|{pool[0]}")]
        return other.upper() if entity.isupper() and len(entity) > 1 else other
    barred = POOLS.__contains__ if kind == "name" and len(entity) <= PART else lambda new: False
    return _cased(entity, _letters(_lower(entity), key, kind, barred))


@lru_cache(10_000)
def _secret_row(c: str, hexa: bool) -> str:
    """What a character of a secret may become: letters and digits one of their kind and case, all else only itself."""
    for row, few in (("0123456789", 10), ("abcdefghijklmnopqrstuvwxyz", 6), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 6)):
        if c in row:
            return row[:few] if hexa else row
    kind = unicodedata.category(c)
    if c.isascii() or kind[0] not in "LMN":
        return c
    block = ord(c) & ~127
    return "".join(x for x in map(chr, range(block, block + 128)) if unicodedata.category(x) == kind)


def _hexa(text: str) -> bool:
    return all(c in "0123456789abcdefABCDEF" for c in text)


def _cased_secret(entity: str, key: bytes) -> str:
    """Secrets differ by case, and hexadecimal ones (of long ones, each part) stay hexadecimal."""
    out = []
    for part, tweak in _parts(entity, key, "secret"):
        hexa = _hexa(part)
        out.append(_turned(part, [_secret_row(c, hexa) for c in part], key, tweak, lambda new: not hexa and _hexa(new)))  # noqa: B023
    return "".join(out)


_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_NUMBER = re.compile(
    r"""(?<![\w.])(?:
    (?P<phone>\+?[0-9]{0,3}[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:\+[0-9]{1,3}[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}
        |\+(?=(?:[0-9][ .()/-]{0,3}){8,15}(?![0-9]))[1-9][0-9]{0,2}(?:[ .()/-]{1,3}[0-9]{1,10}){1,6}|\+[1-9][0-9]{7,14}
        |0[0-9]{2,4}[ /-][0-9]{5,8})(?![0-9])
    |(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])
    |(?P<ip>(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]))(?![0-9]|\.[0-9])
    |(?P<card>[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|[0-9]{13,19})(?![0-9])
    )""",
    re.X,
)
_HEX = re.compile(r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[0-9])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])")
#: A secret behind its key ends before white space, a quote, or the punctuation of the sentence.
_KEYED = re.compile(r"\b(?:token|secret|password|passwd|api[_-]?key)\b[\"']?\s{0,3}[=:]\s{0,3}[\"'`]?([^\s\"'`]{11,}[^\s\"'`.,;:!?)\]}>])", re.I)
#: Secrets by the prefixes of their issuers, which stay, and the body of a private key.
_ISSUED = re.compile(r"\b(?:(?:AKIA|ASIA)([0-9A-Z]{16})|gh[opsur]_([0-9A-Za-z]{36,}+)|xox[abprs]-([0-9A-Za-z-]{20,}+)|sk-([0-9A-Za-z_-]{20,}+))(?![0-9A-Za-z])|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----([^-]+)-----END")
_IBAN = re.compile(r"\b[A-Z]{2}(?:0[2-9]|[1-8][0-9]|9[0-8])(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)(?![0-9A-Za-z])")
_IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}(?:::)?(?![\w:])")
_TITLE = re.compile(rf"\b(?:{'|'.join(TITLES)})\b\.?(?=\s)")
#: A word, combining marks included, behind white space with at most one line break.
_NAME = r"[^\W\d_][\w\p{M}'’-]*"
_WORD = regex.compile(rf"((?:[^\S\n]+|[^\S\n]*\n[^\S\n]*)?)({_NAME})")
_WORDS = regex.compile(_NAME)
_LOCAL = frozenset("._%+-")


#: A possessive ending isn't part of the name.
_OWNED = re.compile(r"['’]s?$", re.I)


def _caseless(c: str) -> bool:
    return unicodedata.category(c) in ("Lo", "Lt")


def _names(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each capitalised word or initial behind a title, as far as the name goes."""
    at = 0
    for m in _TITLE.finditer(text):
        if m.start() < at:
            continue
        at, first, tight, caseless = m.end(), True, False, 0
        while (w := _WORD.match(text, at)) and (w[1] or tight):
            word, tight = w[2], False
            dot = text[w.end() : w.end() + 1] == "."
            if word in TITLES:
                at = w.end() + dot
            elif word[0].isupper() or (_caseless(word[0]) and caseless < 2):
                caseless += _caseless(word[0])
                a, z = w.span(2)
                yield a, z - len(owned[0]) if (owned := _OWNED.search(word)) and owned.start() > 1 else z
                # The full stop of an initial doesn't end the name.
                tight, first = dot and len(word) == 1, False
                at = w.end() + tight
            elif first or word in PARTICLES:
                at, first = w.end(), False
            else:
                break


def _mentions(text: str, titled: set[str]) -> Iterator[tuple[int, int]]:
    """Start and end of the words that repeat a titled name (lower case), where the document has it capitalised only."""
    found, common, given = [], set(), None
    for m in _WORDS.finditer(text):
        end = m.end() - len(owned[0]) if (owned := _OWNED.search(m[0])) else m.end()
        word = text[m.start() : end]
        if (low := _lower(word)) in titled:
            if word[0].islower():
                common.add(low)
            else:
                found += [(*given, low)] if given and text[given[1] : m.start()] == " " else []
                found.append((m.start(), end, low))
        given = (m.start(), end) if low in POOLS and word[0].isupper() else None
    return ((a, z) for a, z, low in found if low not in common)


def entities(text: str) -> list[tuple[int, int, str]]:
    """start, end, type of the entities of a text, in order and apart."""
    found = []
    at = text.find("@")
    while at >= 0:
        a = at
        while a > 0 and (text[a - 1].isalnum() or text[a - 1] in _LOCAL):
            a -= 1
        while a < at and text[a] in _LOCAL:
            a += 1
        if a < at and (m := _HOST.match(text, at + 1)):
            found.append((a, m.end(), "email"))
        at = text.find("@", at + 1)
    if re.search("[0-9]", text):
        for m in _NUMBER.finditer(text):
            found.append((*m.span(), m.lastgroup if m.lastgroup != "gap" else "card"))
        found += [(*m.span(), "secret") for m in _HEX.finditer(text)]
        for m in _IBAN.finditer(text):
            bare = canonical("iban", m[0])
            if len(bare) > 14 and _mod97(bare[4:] + bare[:4]) == 1:
                found.append((*m.span(), "iban"))
    if text.count(":") > 1:
        for m in _IPV6.finditer(text):
            try:
                ipaddress.IPv6Address(m[0])
            except ValueError:
                continue
            found.append((*m.span(), "ip"))
    if re.search("AKIA|ASIA|gh[opsur]_|xox[abprs]-|sk-|PRIVATE KEY", text):
        found += [(*m.span(m.lastindex), "secret") for m in _ISSUED.finditer(text)]
    if re.search("(?i)token|secret|passw|api", text):
        found += [(*m.span(1), "secret") for m in _KEYED.finditer(text)]
    if any(t in text for t in TITLES):
        spans = list(_names(text))
        titled = {_lower(text[a:z]) for a, z in spans if z - a > 2}
        found += [(a, z, "name") for a, z in {*spans, *(_mentions(text, titled) if titled else ())}]
    out, end = [], 0
    for a, z, kind in sorted(found, key=lambda x: (x[0], -x[1])):
        if kind == "secret" and a < end < z:
            a = end  # what another entity leaves of a secret is secret still
        if a >= end:
            if kind != "secret" or any(len(_secret_row(c, False)) > 1 for c in text[a:z]):  # a row of dots or stars hides nothing
                out.append((a, z, kind))
            end = z
    return out


def replaced(text: str, key: bytes) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (type, entity, surrogate) of each mention."""
    out, at, said = [], 0, []
    for a, z, kind in entities(text):
        # Long ones would fill the memory of the cache.
        new = (surrogate if z - a <= PART else surrogate.__wrapped__)(kind, text[a:z], key)
        said.append((kind, text[a:z], new))
        out += [text[at:a], new]
        at = z
    return "".join([*out, text[at:]]), said


def canonical(kind: str, entity: str) -> str:
    """What all mentions of one entity have in common."""
    if kind == "ip" and ":" in entity:
        return str(ipaddress.IPv6Address(entity))
    if kind == "ip":
        return ".".join(str(int(x)) for x in entity.split("."))
    if kind == "iban":
        return entity.replace(" ", "")
    if kind in ("phone", "ssn", "card"):
        return "".join(c for c in entity if c.isdigit())
    return entity if kind == "secret" else _lower(entity)


_MENTION = pa.struct([("type", pa.string()), ("entity", pa.string()), ("surrogate", pa.string())])
_PAIR = pa.struct([("type", pa.string()), *((c, pa.int64()) for c in ("e1", "e2", "s1", "s2"))])


def _detected(docs: DataFrame, key: str, counted: bool, mentions: str | None = None, pairs: str | None = None) -> DataFrame:
    """``docs`` with its ``text`` replaced, counts, and columns of the given names: (type, entity, surrogate) of all mentions,
    and type and 128-bit hashes of entity (e1, e2) and surrogate (s1, s2), in canonical form, once a document."""
    tune(docs.sparkSession)
    secret = blake2b(key.encode(), digest_size=32).digest()
    types = TYPES if counted else []
    counts = [f"n_{t}" for t in types]
    added = {mentions: "array<struct<type:string,entity:string,surrogate:string>>", pairs: "array<struct<type:string,e1:long,e2:long,s1:long,s2:long>>"}
    added = {c: t for c, t in added.items() if c}
    rows = docs.drop(*counts, *added)
    names = rows.columns
    k = names.index("text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"{c} int" for c in counts), *(f"`{c}` {t}" for c, t in added.items())])

    def half(kind: str, x: str) -> tuple[int, int]:
        return struct.unpack("<qq", blake2b(canonical(kind, x).encode(), key=secret, digest_size=16).digest())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, said = [], []
            for x in b.column(k):
                text = x.as_py()
                new, s = (None, []) if text is None else replaced(text, secret)
                texts.append(new)
                said.append(s)
            columns = [pa.array(texts, pa.string()) if i == k else c for i, c in enumerate(b.columns)]
            columns += [pa.array([sum(m[0] == t for m in s) for s in said], pa.int32()) for t in types]
            if mentions:
                columns.append(pa.array([[dict(zip(("type", "entity", "surrogate"), m)) for m in s] for s in said], pa.list_(_MENTION)))
            if pairs:
                hashed = [[(kind, *half(kind, old), *half(kind, new)) for kind, old, new in sorted(set(s))] for s in said]
                columns.append(pa.array([[dict(zip(("type", "e1", "e2", "s1", "s2"), m)) for m in s] for s in hashed], pa.list_(_PAIR)))
            yield pa.RecordBatch.from_arrays(columns, [*names, *counts, *added])

    return rows.mapInArrow(run, schema)


def with_surrogates(docs: DataFrame, key: str = "public test key", mentions: bool = False, counted: bool = True) -> DataFrame:
    """``docs`` with its ``text`` replaced, and, if ``counted``, a count n_<type> for each type; with ``mentions``, an array of (type, entity, surrogate) too."""
    return _detected(docs, key, counted, mentions="mentions" if mentions else None)


def _pairs(found: DataFrame, column: str) -> DataFrame:
    return found.select(F.inline(column))


def _collided(pairs: DataFrame) -> DataFrame:
    """type and hash (s1, s2) of surrogates that stand for more than one entity, or for themselves."""
    ends = [f(e).alias(f"{f.__name__}_{e}") for e in ("e1", "e2") for f in (F.min, F.max)]
    found = pairs.groupBy("type", "s1", "s2").agg(*ends, F.bool_or(F.expr("e1 = s1 AND e2 = s2")).alias("same"))
    return found.where("min_e1 < max_e1 OR min_e2 < max_e2 OR same").select("type", "s1", "s2")


def collisions(docs: DataFrame, key: str = "public test key") -> DataFrame:
    """type and hash (s1, s2) of surrogates that stand for more than one entity (in canonical form) or are their own entity; none, if all is well."""
    return _collided(_pairs(_detected(docs.select("text"), key, False, pairs="pairs"), "pairs"))


def checked_surrogates(docs: DataFrame, key: str = "public test key", counted: bool = True) -> DataFrame:
    """``with_surrogates``, which fails if two entities share a surrogate or one stays: texts are written once, with the hashes that the check reads."""
    column = "pairs"
    while column in docs.columns:
        column = "_" + column
    out = stored(_detected(docs, key, counted, pairs=column), "surrogates")
    found = _collided(_pairs(out, column)).groupBy("type").count().collect()
    if found:
        raise ValueError("surrogates that stand for more than one entity, or stay: " + ", ".join(f"{n} of type {kind}" for kind, n in sorted(map(tuple, found))))
    return out.drop(column)

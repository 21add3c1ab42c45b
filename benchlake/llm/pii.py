"""PII: surrogate generation by keyed, format-preserving permutations.

Detected entities are e-mail addresses, phone numbers, payment cards (Luhn-valid), IPv4 and IPv6
addresses, bank accounts (IBAN), social security numbers (ddd-dd-dddd), access keys and secrets in
assignments, and personal names after a title. Each gets a surrogate of its own kind and format: digits
stay digits of their script, letters stay letters of the same script and case, cards and accounts keep
their issuer and valid check digits, an address stays in its class (private, public, mapped and so on), a name keeps
its title and its gender (the title's, or after a neutral title the given name's), and a surname its
pattern of vowels and consonants. Names in capitals are the same names.

A surrogate is a keyed permutation (a Feistel network with cycle walking) of the entity's canonical
form, so equal entities get equal surrogates in every document and on every worker, without a table
(coreference), and different ones get different surrogates (distinctness). Each surrogate is accepted
only after the collision check: the inverse permutation must give the entity back, so no other entity
can have the same surrogate; else ``Collision`` is raised.

Entities of any length are permuted in blocks of ``BLOCK`` letters, each under a tweak of all letters
before it. Letters without a lower and upper case that lead back to each other (sharp s, the Kelvin sign) stand for
other such letters. The one loopback and the one unspecified IPv6 address name nobody and are no entities.

The key is the caller's: whoever has it can take surrogates back. Defined cases: null text stays null in ``anonymise`` and counts as empty in ``surrogates``; text
without entities is returned as it is; where entities overlap, the one that starts first wins, then
the longer; rows that repeat a doc_id are rewritten one by one.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchlake.llm.common import texts, tuned, unkey

#: Letters of an entity that are permuted as one number.
BLOCK = 64

# Given names by gender and script, and titles by gender.
NAMES = {
    ("f", "latin"): "Alice Amelia Anna Beatrice Carla Charlotte Clara Diana Elena Emma Eva Florence Grace Hannah Helen Ida Irene Jane Julia Laura Lena Louise Lucia Maria Martha Nina Nora Olivia Paula Rosa Sara Sofia Teresa Vera".split(),
    ("m", "latin"): "Adam Alan Albert Andrew Anton Bruno Carl Charles Daniel David Edward Emil Eric Felix Frank George Henry Hugo Ivan Jack James John Jonas Leo Louis Luis Mark Martin Max Michael Oscar Paul Peter Robert Thomas Victor William".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Софья".split(),
    ("m", "cyrillic"): "Алексей Борис Виктор Глеб Денис Иван Михаил Николай Олег Пётр".split(),
}
TITLES = {"f": "Mrs Ms Miss Mme Mlle Madame Frau Señora Señorita Sra Srta Signora Госпожа".split(), "m": "Mr Mister Monsieur Herr Señor Sr Signor Господин".split(), "n": "Dr Prof".split()}
#: Letters that stand for each other, by script and case.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъыьэюя")
_VOWELS = {"aeiou", "аеиоуыэюя", "αεηιουω"}


def _sides(alphabet: str) -> dict[str, tuple[str, int, bool]]:
    """Character -> its alphabet, its place there, whether it is a capital; only what leads back to itself."""
    out = {}
    for k, c in enumerate(alphabet):
        out[c] = (alphabet, k, False)
        if c.upper() != c and len(c.upper()) == 1 and c.upper().lower() == c:
            out[c.upper()] = (alphabet, k, True)
    return out


def _apart(alphabet: str) -> list[str]:
    """The vowels and the rest of an alphabet, so that surrogates of names can be spoken."""
    vowels = next((v for v in _VOWELS if set(v) <= set(alphabet)), "")
    return [v for v in (vowels, "".join(c for c in alphabet if c not in vowels)) if v]


_PLACE = {c: p for a in ALPHABETS for c, p in _sides(a).items()}
_SPOKEN = {c: p for a in ALPHABETS for part in _apart(a) for c, p in _sides(part).items()}
_HEX = _sides("0123456789abcdef")


@lru_cache(maxsize=1)
def _others() -> dict[str, tuple[str, int, bool]]:
    """The same for all other letters and digits, by rule: a script's decimal digits of one block, its
    small letters that have capitals, and its letters without case are an alphabet each."""
    groups: dict[tuple[str, object], list[str]] = defaultdict(list)
    for c in map(chr, range(0x80, 0x30000)):
        if c in _PLACE or not c.isalnum():
            continue
        script = unicodedata.name(c, "").partition(" ")[0]
        if c.isdecimal():
            groups[script, ord(c) - unicodedata.decimal(c)].append(c)
        elif c.lower() == c.upper() == c:
            groups[script, "letter"].append(c)
        elif c.lower() == c and len(c.upper()) == 1 and c.upper().lower() == c and c.upper() not in _PLACE:
            groups[script, "small"].append(c)
        elif c.isalpha() and not (len(c.lower()) == 1 and c.lower() != c and c.lower().upper() == c):
            groups[unicodedata.category(c), "odd"].append(c)
    return {c: p for g in groups.values() for c, p in _sides("".join(g)).items()}


def _place(c: str, table: dict[str, tuple[str, int, bool]]) -> tuple[str, int, bool] | None:
    return table.get(c) or (_others().get(c) if ord(c) > 127 and table is not _HEX else None)


def _permute(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1."""
    if size < 2:
        return x
    half = max(1, (size - 1).bit_length() + 1 >> 1)
    mask = (1 << half) - 1
    turns = range(8)
    while True:
        a, b = x >> half, x & mask
        for r in reversed(turns) if back else turns:
            if back:
                a, b = b ^ _round(key, tweak, size, r, a) & mask, a
            else:
                a, b = b, a ^ _round(key, tweak, size, r, b) & mask
        x = a << half | b
        if x < size:
            return x


def _round(key: bytes, tweak: str, size: int, r: int, half: int) -> int:
    data = f"{tweak}|{size}|{r}|{half}".encode()
    return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=64).digest() * (1 + half.bit_length() // 512), "little")


def _mixed(digits: list[int], radices: list[int]) -> int:
    x = 0
    for d, r in zip(digits, radices, strict=True):
        x = x * r + d
    return x


def _unmixed(x: int, radices: list[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        x, d = divmod(x, r)
        out.append(d)
    return out[::-1]


def _letters(s: str, key: bytes, tweak: str, back: bool = False, table: dict[str, tuple[str, int, bool]] = _PLACE, fixed: int = 0) -> str:
    """Permute the letters and digits of s within their alphabets; the rest, and ``fixed`` leading
    characters, stay. Case is laid over afterwards, so spellings that differ in case agree."""
    out, before = list(s), ""
    placed = [(k, p) for k, c in enumerate(s) if k >= fixed and (p := _place(c, table))]
    for at in range(0, len(placed), BLOCK):
        part = placed[at : at + BLOCK]
        radices = [len(p[0]) for _, p in part]
        size = 1
        for r in radices:
            size *= r
        # the format is part of the tweak: two formats never share a permutation
        own = tweak + "|" + ",".join(map(str, radices)) + before
        old = [p[1] for _, p in part]
        new = _unmixed(_permute(_mixed(old, radices), size, key, own, back), radices)
        for (k, (alphabet, _, capital)), d in zip(part, new, strict=True):
            out[k] = alphabet[d].upper() if capital else alphabet[d]
        if at + BLOCK < len(placed):
            before = "|" + hashlib.blake2b(f"{before}|{new if back else old}".encode(), digest_size=16).hexdigest()
    return "".join(out)


def _check_digit(body: str) -> str:
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def luhn(number: str) -> bool:
    return _check_digit(number[:-1]) == number[-1]


def _relay(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdecimal() else c for c in shape)


def _digits(s: str) -> str:
    return "".join(str(unicodedata.decimal(c)) for c in s if c.isdecimal())


def _card(s: str, key: bytes, back: bool) -> str:
    d = _digits(s)
    kept = d[: {"4": 1, "2": 4}.get(d[0], 2)]  # the digits that name the brand
    body = kept + _letters(d[len(kept) : -1], key, "card" + kept, back)
    return _relay(s, body + _check_digit(body))


#: Leading digits of payment cards.
_BRANDS = re.compile(r"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[689])|6(?:011|4[4-9]|5)|62|35")


def _phone(s: str, key: bytes, back: bool) -> str:
    """Country code and the first digit of the number stay, so it remains a dialable format."""
    d = _digits(s)
    keep = len(m[1]) if (m := re.match(r"\+([0-9]{1,3})[^0-9]", s)) else 1 if s.startswith("+") else 0
    return _relay(s, d[: keep + 1] + _letters(d[keep + 1 :], key, "phone" + d[: keep + 1], back))


def _address_class(x: int) -> int:
    a, b = x >> 24, x >> 16 & 255
    return 1 if a == 10 else 2 if a == 172 and 16 <= b < 32 else 3 if a == 192 and b == 168 else 4 if a == 127 else 5 if a == 0 or a >= 224 else 0


def _ipv4(s: str, key: bytes, back: bool) -> str:
    x = _mixed([int(o) for o in s.split(".")], [256] * 4)
    kind, y = _address_class(x), x
    while True:
        y = _permute(y, 1 << 32, key, "ipv4", back)
        if _address_class(y) == kind:
            return ".".join(map(str, _unmixed(y, [256] * 4)))


#: Prefixes of special classes of IPv6 addresses (mapped, translated, documentation).
_IPV6_CLASSES = (("::ffff:0:0", 96), ("64:ff9b::", 96), ("2001:db8::", 32))
_IPV6_PREFIXES = [(int(ipaddress.IPv6Address(p)) >> 128 - n, n) for p, n in _IPV6_CLASSES]


def _ipv6_class(x: int) -> tuple[int, int]:
    """(prefix, its bits) that an address shares with its class: a special one's, else the first sixteen bits."""
    return next(((p, n) for p, n in _IPV6_PREFIXES if x >> 128 - n == p), (x >> 112, 16))


def _ipv6(s: str, key: bytes, back: bool) -> str:
    """Another address of the same class, in the shortest form."""
    x = int(ipaddress.IPv6Address(s))
    own, free = _ipv6_class(x), 128 - _ipv6_class(x)[1]
    tail = x & (1 << free) - 1
    while True:  # walk past special classes, and past what is no entity
        tail = _permute(tail, 1 << free, key, f"ipv6{own[0]}/{own[1]}", back)
        y = own[0] << free | tail
        if y > 1 and _ipv6_class(y) == own:
            return str(ipaddress.IPv6Address(y))


def _account_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _is_account(s: str) -> bool:
    d = s.replace(" ", "")
    return 15 <= len(d) <= 34 and _account_check(d[:2], d[4:]) == d[2:4]


def _iban(s: str, key: bytes, back: bool) -> str:
    """Country and grouping stay; the check digits are those of the new number."""
    country, body = s[:2], s[2:].replace(" ", "")[2:]
    new = _letters(body, key, "iban" + country, back)
    it = iter(country + _account_check(country, new) + new)
    return "".join(c if c == " " else next(it) for c in s)


def _email(s: str, key: bytes, back: bool) -> str:
    """Local part, and each host label but the last two, which keep the address of its kind."""
    local, _, host = s.partition("@")
    labels = host.split(".")
    inner, outer = ".".join(labels[:-2]), ".".join(labels[-2:])
    if outer.lower() not in ("example.com", "example.org", "example.net"):
        inner, outer = ".".join(labels[:-1]), labels[-1]
    inner = _letters(inner, key, "host" + outer.lower(), back) if inner else ""
    return f"{_letters(local, key, 'local', back)}@{inner}{'.' if inner else ''}{outer}"


def _hex_case(s: str) -> str:
    """"lower" or "upper" for hexadecimal with a letter, else ""."""
    if not re.search("[A-Fa-f]", s):
        return ""
    return "lower" if re.fullmatch("[0-9a-f]+", s) else "upper" if re.fullmatch("[0-9A-F]+", s) else ""


def _secret(s: str, key: bytes, back: bool) -> str:
    case, out = _hex_case(s), s
    while True:  # walk on within the format
        if case:
            out = _letters(out.lower(), key, "secret" + case, back, _HEX)
            out = out.upper() if case == "upper" else out
        else:
            out = _letters(out, key, "secret", back, fixed=4 if s.startswith("AKIA") else 0)
        if _hex_case(out) == case:
            return out


def _cased(name: str) -> str:
    """A name in capitals as it is listed."""
    return name[:1] + name[1:].lower() if len(name) > 1 and name.isupper() else name


def _name(s: str, key: bytes, back: bool) -> str:
    title, *names = s.split(" ")
    script = "cyrillic" if re.search("[а-яё]", s.lower()) else "latin"
    gender = next((g for g, ts in TITLES.items() if title.rstrip(".").lower() in map(str.lower, ts)), "n")
    if gender == "n" and names:  # the given name's, which its surrogate has as well
        gender = next((g for g in ("f", "m") if _cased(names[0]) in NAMES[g, script]), "n")
    out = [title]
    own = NAMES.get((gender, script), [])
    listed = {n for g in ("f", "m") if gender in (g, "n") for n in NAMES[g, script]}
    for k, n in enumerate(names):
        if k == 0 and (known := _cased(n)) in own:
            new = own[_permute(own.index(known), len(own), key, f"given|{gender}|{script}", back)]
            out.append(new if known == n else new.upper())
            continue
        while True:  # walk past the listed names, which only stand for each other
            n = _letters(n, key, "name", back, _SPOKEN)
            if k or _cased(n) not in listed:
                break
        out.append(n)
    return " ".join(out)


_MAKERS: dict[str, Callable[[str, bytes, bool], str]] = {"email": _email, "phone": _phone, "card": _card, "ipv4": _ipv4, "ipv6": _ipv6, "iban": _iban, "ssn": lambda s, k, b: _letters(s, k, "ssn", b), "secret": _secret, "name": _name}


class Collision(ValueError):
    """Two entities would share a surrogate."""


#: Kinds whose digits may be of any script: they are worked on as 0-9 and written back in their own.
_NUMERIC = frozenset(("phone", "card", "ipv4", "ssn"))


def _zero(s: str) -> int:
    """The zero of the script of the digits of s."""
    return next((ord(c) - unicodedata.decimal(c) for c in s if c.isdecimal()), 48)


def _made(kind: str, entity: str, key: bytes, back: bool) -> str:
    if kind not in _NUMERIC or entity.isascii():
        return _MAKERS[kind](entity, key, back)
    zero = _zero(entity)
    plain = "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in entity)
    return "".join(chr(zero + int(c)) if c in "0123456789" else c for c in _MAKERS[kind](plain, key, back))


@lru_cache(maxsize=1 << 14)
def surrogate(kind: str, entity: str, key: bytes) -> str:
    """The surrogate of an entity, after the collision check."""
    out = _made(kind, entity, key, False)
    again = _made(kind, out, key, True)
    if again != (str(ipaddress.IPv6Address(entity)) if kind == "ipv6" else entity):
        raise Collision(f"{kind}: a surrogate does not lead back to its entity")
    return out


_TITLE = "|".join(sorted({x for ts in TITLES.values() for t in ts for x in (t, t.upper())}, key=len, reverse=True))
# a capital, then letters; parts joined by a hyphen or an apostrophe, but no possessive s
_ONE_NAME = r"(?=[^\W\d_a-z])(?:[^\W\d_]{2,}|[^\W\d_](?=['’-]))(?:(?:-|['’](?![sS]\b))[^\W\d_]+)*"
_NAME = re.compile(rf"(?<!\w)(?:{_TITLE})\.? {_ONE_NAME}(?: {_ONE_NAME})?")
_HOST = re.compile(r"@((?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})")
#: What ends the local part of an address.
_OUTSIDE = frozenset("@<>()[],;:\"!?#$%&*/\\|")
_IPV6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:]|\.\w)")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_NUMBER = re.compile(
    r"(?<![\w.])(?:(?P<ipv4>\d{1,3}(?:\.\d{1,3}){3})(?!\.?\d)"
    r"|(?P<phone>\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d-])"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])"
    r"|(?P<card>\d(?:[ -]?\d){12,18})(?!\d))"
)
_KEYED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?:token|password|passwd|secret|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?([A-Za-z0-9+/_\-]{8,}))", re.I)


_BREAK = re.compile(r"[ -]")


def _local(text: str, at: int) -> int:
    """Where the local part before the @ at this place starts: all of it, however long."""
    k = at
    while k and text[k - 1] not in _OUTSIDE and not text[k - 1].isspace():
        k -= 1
    while k < at and text[k] in ".'-":
        k += 1
    return k


def _is_ipv6(s: str) -> bool:
    try:
        return int(ipaddress.IPv6Address(s)) > 1
    except ValueError:
        return False


def _one_script(s: str) -> bool:
    return s.isascii() or len({ord(c) - unicodedata.decimal(c) for c in s if c.isdecimal()}) < 2


def _is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and _BRANDS.match(digits) is not None and luhn(digits)


def _found(text: str) -> Iterator[tuple[int, int, str]]:
    if "@" in text:
        for m in _HOST.finditer(text):
            if (start := _local(text, m.start())) < m.start():
                yield start, m.end(), "email"
    if ":" in text:
        for m in _IPV6.finditer(text):
            if _is_ipv6(m[0]):
                yield m.start(), m.end(), "ipv6"
    for m in _IBAN.finditer(text):
        if _is_account(m[0]):
            yield m.start(), m.end(), "iban"
    at = 0
    while m := _NUMBER.search(text, at):
        at, kind = m.end(), m.lastgroup or ""
        d = _digits(m[0])
        if not _one_script(m[0]):
            continue
        if kind == "ipv4" and any(len(o) > 1 and int(o[0]) == 0 or int(o) > 255 for o in m[0].split(".")):
            continue
        if kind == "card":
            stops = [m.end(), *(m.start() + g.start() for g in reversed(list(_BREAK.finditer(m[0]))))]
            stop = next((z for z in stops if _is_card(_digits(text[m.start() : z]))), None)
            if stop is not None:
                yield m.start(), stop, kind
            at = stop or min(stops) + (len(stops) > 1)  # else the next group of digits may start one
            continue
        if kind == "phone" and not 7 <= len(d) <= 15:
            continue
        yield m.start(), m.end(), kind
    if "AKIA" in text or "=" in text or ":" in text:
        for m in _KEYED.finditer(text):
            group = 1 if m[1] else 0
            yield m.start(group), m.end(group), "secret"
    for m in _NAME.finditer(text):
        yield m.start(), m.end(), "name"


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of the entities of a text, in order and without overlap."""
    out: list[tuple[int, int, str]] = []
    for e in sorted(_found(text), key=lambda e: (e[0], -e[1])):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


def rewrite(text: str, key: bytes) -> tuple[str, list[tuple[str, str, str]]]:
    """(text with surrogates, [(kind, entity, surrogate)])."""
    found = detect(text)
    if not found:
        return text, []
    parts, at, entities = [], 0, []
    for start, stop, kind in found:
        new = surrogate(kind, text[start:stop], key)
        parts += [text[at:start], new]
        entities.append((kind, text[start:stop], new))
        at = stop
    return "".join([*parts, text[at:]]), entities


#: The setting that names the key, and what stands in where it is unset: enough to try the queries out,
#: useless as a secret.
KEY_SETTING, TRIAL_KEY = "spark.benchlake.pii.key", "trial"


def session_key(spark: SparkSession) -> bytes:
    """The key that the session's settings give to the registered query and the pipeline."""
    return spark.conf.get(KEY_SETTING, TRIAL_KEY).encode()


def anonymise(docs: DataFrame, key: bytes, text_column: str = "text") -> DataFrame:
    """The table with its text column rewritten; every other column stays."""
    tuned(docs.sparkSession)

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: None if t is None else rewrite(t, key)[0])

    return docs.withColumn(text_column, run(F.col(text_column).cast("string")))


def surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """Per row: doc_id, text (rewritten), n_entities, entities (kind and surrogate, in text order)."""
    tuned(docs.sparkSession)
    entity = pa.struct([("kind", pa.string()), ("surrogate", pa.string())])

    def run(batches):
        for b in batches:
            out = [rewrite(t, key) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in out], pa.string()), pa.array([len(e) for _, e in out], pa.int64()), pa.array([[{"kind": k, "surrogate": s} for k, _, s in e] for _, e in out], pa.list_(entity))], names=["doc_id", "text", "n_entities", "entities"])

    out = texts(docs).mapInArrow(run, "doc_id long, text string, n_entities long, entities array<struct<kind: string, surrogate: string>>")
    return out.select(unkey("doc_id"), "text", "n_entities", "entities")

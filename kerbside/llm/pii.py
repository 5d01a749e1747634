"""Personal data: detected entities get keyed surrogates of the same type, script and format.

Numbers, addresses and secrets are replaced through keyed permutations of the values of their shape (digits stay digits,
letters stay letters of their script, separators and upper case stay in place): equal entities get equal surrogates in
every document and different ones different surrogates, because a permutation cannot collide; check digits are made
right again, and a value stays in its class (valid or invalid card number, unicast or multicast address).

Names follow a form of address, which tells their gender. Given names and surnames are replaced by names of the same
gender and script, drawn by key. Draws can collide, so Spark gathers the distinct names, gives each drawn name to one of
them and lets the others draw again, from a space that grows with the draws, until all are distinct. A name that stands
alone later in the document is replaced alike.

Defined results: null stays null, empty stays empty; repeated rows are replaced alike; a text without entities is
unchanged; the order and the other columns of the table are kept by ``anonymise``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import sliced
from kerbside.session import materialise

# Alphabets of the scripts whose letters are replaced.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "αβγδεζηθικλμνξοπρστυφχψω",
)
_HEX = "0123456789abcdef"
# Forms of address and the gender they tell (m, f, or n for neither).
ADDRESS = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Mx": "n", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "господин": "m", "госпожа": "f", "κύριος": "m", "κυρία": "f",
}
# Names to draw first, by script and kind (m and f: given names, s: surnames).
NAMES = {
    "latin": {
        "m": "Adam Bruno Carl David Emil Felix Hugo Ivan Jonas Karl Leon Marco Nils Oscar Paul Simon Tomas Victor",
        "f": "Anna Bella Clara Diana Elena Flora Greta Helena Irene Julia Laura Maria Nina Olga Paula Rosa Sara Vera",
        "s": "Adler Berger Castro Dumont Ferrer Graham Hansen Keller Lambert Moreno Novak Olsen Pereira Quinn Rossi Steiner Torres Weber",
    },
    "cyrillic": {
        "m": "Алексей Борис Виктор Глеб Денис Иван Кирилл Максим Николай Олег Павел Роман Сергей",
        "f": "Анна Вера Галина Дарья Елена Ирина Ксения Лидия Мария Нина Ольга Полина Юлия",
        "s": "Беленко Власенко Гордиенко Доценко Захаренко Климчук Лукашук Марченко Панчук Романюк Савченко Ткачук",
    },
    "greek": {
        "m": "Αλέξης Γιάννης Δημήτρης Κώστας Μιχάλης Νίκος Πέτρος Σπύρος",
        "f": "Άννα Βασιλική Γεωργία Ελένη Ιωάννα Μαρία Σοφία Χριστίνα",
        "s": "Αλεξίου Γεωργίου Δημητρίου Ιωάννου Κωνσταντίνου Νικολάου Παύλου Χρήστου",
    },
}
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va vo".split(),
    "cyrillic": "ба бе бо да де до га ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то ва во".split(),
    "greek": "βα βε βο δα δε δο γα κα κε κο λα λε λο μα με μο να νε νο ρα ρε ρο σα σε σο τα τε το".split(),
}
_ENDINGS = {"latin": {"m": "n", "f": "a", "n": "e", "s": "r"}, "cyrillic": {"m": "н", "f": "а", "n": "й", "s": "ко"}, "greek": {"m": "ς", "f": "α", "n": "ο", "s": "ου"}}

_PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]++@(?:[\w-]++\.)+[^\W\d_]{2,}",
    "secret": r"(?i:(?:token|secret|password|passwd|api[_-]?key)\s*[:=]\s*[\"']?)(?P<value>[A-Za-z0-9_\-/+]{12,})|(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "ipv4": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
}
_ENTITY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _PATTERNS.items()))
_MAYBE = re.compile(r"[0-9@]|(?i:token|secret|passw|api.?key)")
_NAME = re.compile(rf"\b({'|'.join(ADDRESS)})(\.?\s+)([^\W\d_][\w'-]+(?:[ ][^\W\d_][\w'-]+){{0,2}})")
KINDS = (*_PATTERNS, "name")
_BLOCK = 64  # signs that are permuted as one number


class Surrogates:
    """Surrogates under one key; a pure function of key and entity."""

    def __init__(self, key: bytes) -> None:
        self._key = key
        self.of = lru_cache(100_000)(self._of)

    def number(self, *parts: str) -> int:
        return int.from_bytes(hmac.new(self._key, "\x1f".join(parts).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()[:16], "big")

    def permute(self, domain: str, value: int, size: int) -> int:
        """A keyed permutation of 0..size-1: value = left * width + right, each part shifted in turn by a hash of the other.

        When the size is not a product of its parts, values that leave the range are sent on until they return."""
        if size < 2:
            return value
        width = max(2, int(size**0.5))
        height = -(-size // width)
        while True:
            left, right = divmod(value, width)
            for turn in range(6):
                left = (left + self.number(domain, str(size), f"l{turn}", str(right))) % height
                right = (right + self.number(domain, str(size), f"r{turn}", str(left))) % width
            value = left * width + right
            if value < size:
                return value

    def shaped(self, domain: str, text: str, alphabets: tuple[str, ...] = ALPHABETS) -> str:
        """Permutes the texts of one shape: letters and digits within their alphabets, case and other signs in place."""
        if len(text) > _BLOCK:  # block by block, each under what stood before it: still one to one, and in linear time
            out, before = [], hashlib.sha256(str(len(text)).encode())
            for at in range(0, len(text), _BLOCK):
                block = text[at : at + _BLOCK]
                out.append(self.shaped(f"{domain}|{before.hexdigest()}", block, alphabets))
                before.update(block.encode("utf-8", "surrogatepass"))
            return "".join(out)
        places = [(i, a) for i, c in enumerate(text) for a in alphabets if c.lower() in a and len(c.lower()) == 1]
        value, size, shape = 0, 1, list(text)
        for i, a in places:
            value, size, shape[i] = value * len(a) + a.index(text[i].lower()), size * len(a), a[0]
        value = self.permute(f"{domain}|{''.join(shape)}", value, size)
        out = list(text)
        for i, a in reversed(places):
            value, at = divmod(value, len(a))
            out[i] = a[at].upper() if text[i].isupper() else a[at]
        return "".join(out)

    def digits(self, domain: str, text: str, keep: int, suits=lambda digits: True) -> str:
        """Permutes the digits after the first ``keep``, among those that ``suits`` treats like the given ones."""
        numbers = re.sub(r"[^0-9]", "", text)
        kind, now = suits(numbers), numbers
        while True:
            now = now[:keep] + self.shaped(f"{domain}|{now[:keep]}", now[keep:])
            if suits(now) == kind:
                break
        fill = iter(now)
        return re.sub(r"[0-9]", lambda _: next(fill), text)

    def _of(self, kind: str, entity: str) -> str:
        if kind == "email":
            local, domain = entity.rsplit("@", 1)
            labels = domain.split(".")
            masked = [self.shaped("label", x) for x in labels[:-1]]
            return ".".join([f"{self.shaped('local|' + domain.lower(), local)}@{masked[0]}", *masked[1:], labels[-1]])
        if kind == "secret":
            hexadecimal = re.fullmatch("[0-9a-f]+|[0-9A-F]+", entity) is not None
            return self.shaped("secret", entity, (_HEX,) if hexadecimal else ALPHABETS)
        if kind == "ipv4":
            value, inside = 0, lambda v: 1 <= v >> 24 <= 223 and v >> 24 not in (10, 127)
            for octet in entity.split("."):
                value = value << 8 | int(octet)
            was = inside(value)
            while True:
                value = self.permute("ipv4", value, 1 << 32)
                if inside(value) == was:
                    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
        if kind == "card":
            return self.digits("card", entity, 1, luhn)
        if kind == "iban":
            body = self.shaped("iban", re.sub(" ", "", entity)[4:])
            country = entity[:2]
            check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97
            fill = iter(f"{country}{check:02d}{body}")
            return re.sub(r"[A-Z0-9]", lambda _: next(fill), entity)
        if kind == "phone":
            code = re.match(r"\+([0-9]{1,3})[ .(-]", entity)
            return self.digits("phone", entity, len(code[1]) if code else 0)
        return self.digits(kind, entity, 0)

    def draw(self, kind: str, script: str, name: str, attempt: int) -> str:
        """The ``attempt``-th name for ``name``: from the list first, then of more and more syllables."""
        if attempt < 4:
            pool = NAMES[script]["s" if kind == "s" else kind if kind in "mf" else "mf"[self.number("g", name) % 2]].split()
            return pool[self.number("name", kind, script, name, str(attempt)) % len(pool)]
        syllables, value = _SYLLABLES[script], self.number("name", kind, script, name, str(attempt))
        out = ""
        for _ in range(2 + attempt // 4):
            value, at = divmod(value, len(syllables))
            out += syllables[at]
        return (out + _ENDINGS[script][kind]).capitalize()


def luhn(digits: str) -> bool:
    """Whether the last digit checks the ones before."""
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def script_of(name: str) -> str:
    """The script of a name's first letter."""
    first = name[0].lower()
    return "cyrillic" if "Ѐ" <= first <= "ӿ" else "greek" if "Ͱ" <= first <= "Ͽ" or "ἀ" <= first <= "῿" else "latin"


def _name_parts(text: str) -> list[tuple[str, str, str]]:
    """(kind, script, name) of the names after forms of address: given names by gender, the last name as surname."""
    out = []
    for m in _NAME.finditer(text):
        names = [n for n in m[3].split(" ") if n[0].isupper()]
        for n in names[: names.index(names[-1])] if names else []:
            out.append((ADDRESS[m[1]], script_of(n), n))
        if names:
            out.append(("s", script_of(names[-1]), names[-1]))
    return list(dict.fromkeys(out))


def replace_entities(text: str, surrogates: Surrogates, names: dict[tuple[str, str], str]) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and how many entities of each kind were replaced."""
    counts: dict[str, int] = {}

    def entity(m: re.Match) -> str:
        kind = m.lastgroup if m.lastgroup != "value" else "secret"
        counts[kind] = counts.get(kind, 0) + 1
        if m.group("value"):
            return m[0][: m.start("value") - m.start()] + surrogates.of("secret", m.group("value"))
        return surrogates.of(kind, m[0])

    if _MAYBE.search(text):
        text = _ENTITY.sub(entity, text)
    if names:
        by_name = {name: new for (_, name), new in sorted(names.items())}

        def name(m: re.Match) -> str:
            counts["name"] = counts.get("name", 0) + 1
            return by_name[m[0]]

        known = "|".join(map(re.escape, sorted(by_name, key=len, reverse=True)))
        text = re.sub(rf"(?<!\w)(?:{known})(?!\w)", name, text)
    return text, counts


def _assigned_names(parts: DataFrame, key: bytes) -> DataFrame:
    """(kind, script, name, new): distinct names of a kind and script get distinct new names, none of them in use."""
    originals = materialise(parts.distinct(), "names")
    left, done, attempt = originals, None, 0
    while not left.isEmpty():

        def run(batches: Iterator[pa.RecordBatch], attempt: int = attempt) -> Iterator[pa.RecordBatch]:
            surrogates, columns = Surrogates(key), ["kind", "script", "name"]
            for batch in sliced(batches):
                given = [batch.column(c) for c in columns]
                new = [surrogates.draw(*entity, attempt) for entity in zip(*(c.to_pylist() for c in given), strict=True)]
                yield pa.RecordBatch.from_arrays([*given, pa.array(new, pa.string())], [*columns, "new"])

        taken = originals.withColumnRenamed("name", "new")
        if done is not None:
            taken = taken.unionByName(done.select("kind", "script", "new"))
        drawn = left.select("kind", "script", "name").mapInArrow(run, "kind string, script string, name string, new string")
        free = drawn.join(taken, ["kind", "script", "new"], "left_anti")
        won = free.groupBy("kind", "script", "new").agg(F.min("name").alias("name")).select("kind", "script", "name", "new")
        done = materialise(won if done is None else done.unionByName(won), "new-names")
        left = materialise(left.join(done, ["kind", "script", "name"], "left_anti"), "names")
        attempt += 1
    return done if done is not None else originals.withColumn("new", F.col("name"))


def anonymise(df: DataFrame, key: bytes, text_col: str = "text", counts_col: str | None = None) -> DataFrame:
    """``df`` with surrogates in its text column; ``counts_col`` names a new map column of replaced entities by kind."""
    schema, at = df.schema, df.columns.index(text_col)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [(t, *p) for t in batch.column(0).to_pylist() if t for p in _name_parts(t)]
            if found:
                keys = [hashlib.sha256(x[0].encode("utf-8", "surrogatepass")).hexdigest() for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *[pa.array([x[i] for x in found]) for i in (1, 2, 3)]], ["of", "kind", "script", "name"])

    # Names are rare: only their parts and the digests of their texts are written.
    parts = df.select(text_col).mapInArrow(find, "of string, kind string, script string, name string").distinct()
    parts = materialise(parts, "name-parts")
    named = df
    extra = "_new_names"
    while extra in df.columns:
        extra += "_"
    if not parts.isEmpty():
        new = parts.join(_assigned_names(parts.select("kind", "script", "name"), key), ["kind", "script", "name"])
        new = new.groupBy("of").agg(F.collect_list(F.struct("kind", "name", "new")).alias(extra))
        new = materialise(new.withColumnRenamed("of", extra + "of"), "text-names")
        named = df.withColumn(extra + "key", F.sha2(text_col, 256)).join(new, F.col(extra + "key") == F.col(extra + "of"), "left").select(*df.columns, extra)
    else:
        named = df.select(*df.columns, F.lit(None).cast("array<struct<kind: string, name: string, new: string>>").alias(extra))

    out_schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    if counts_col:
        out_schema += f", `{counts_col}` map<string, bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in sliced(batches):
            texts, counted = [], []
            for text, names in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                counts: dict[str, int] = {}
                if text:
                    text, counts = replace_entities(text, surrogates, {(x["kind"], x["name"]): x["new"] for x in names or []})
                texts.append(text)
                counted.append(list(counts.items()))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, pa.string())
            names = batch.schema.names[:-1]
            if counts_col:
                columns.append(pa.array(counted, pa.map_(pa.string(), pa.int64())))
                names = [*names, counts_col]
            yield pa.RecordBatch.from_arrays(columns, names)

    return named.mapInArrow(run, out_schema)

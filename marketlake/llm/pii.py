"""Personal data: keyed surrogates that keep type, gender, script and format.

Entities: e-mail addresses, phone numbers, IPv4 addresses, payment cards, social security numbers,
IBANs, and names after a title (the title tells the gender; given and family names are entities of
their own, so "Mr Ian Hale" and later "Hale" stay one person).  An entity's canonical value does not
depend on how it was written; its surrogate is a keyed permutation of the values of its shape (digits
stay digits, letters stay letters, check digits hold, names become pronounceable names of the same
gender and script), written back in the format of each occurrence.

Distinctness and coreference hold over the whole input: the distinct entities form a table; a surrogate
that two entities share, or that equals any entity found, is a collision, and the entity moves to
its next permutation until none is left.  Only the (few) moved entities travel back to the documents
that hold them, as a written table whose size the planner knows (it broadcasts only below its own
threshold).  Texts are read twice and not shuffled unless that table outgrows the threshold.

Null texts stay null and empty ones empty; long texts are read whole; repeated rows get the same
result; rows with a null doc_id are treated like others; all other columns pass unchanged.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import new_location
from .common import materialize, parts, ship, table, text_digest

#: The default key; a deployment passes its own secret.
KEY = os.environ.get("MARKETLAKE_PII_KEY", "marketlake-surrogates")
ROUNDS, PIECE = 6, 96
#: Rounds with one attempt for each entity; after them the attempts of a round double, up to AT_ONCE, and an entity
#: without a surrogate after MOST_ATTEMPTS has none left in its shape.
SINGLE_ROUNDS, AT_ONCE, MOST_ATTEMPTS = 8, 4_096, 1 << 17

# Titles by gender.
MALE = ["Mr", "Mister", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Господин", "господин", "г-н"]
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Mlle",
          "Госпожа", "госпожа", "г-жа"]
# The sounds that surrogate names are made of, by script.
SOUNDS = {
    "latin": ("b d f g h j k l m n p r s t v z", "a e i o u", {"m": "n r s", "f": "a", "": "k l m t"}),
    "cyrillic": ("б в г д ж з к л м н п р с т", "а е и о у", {"m": "н р с", "f": "а", "": "в к м л"}),
    "greek": ("β γ δ ζ κ λ μ ν π ρ σ τ", "α ε ι ο", {"m": "ς", "f": "α", "": "ς"}),
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?$")
_LOCAL_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_NUMBERS = [
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("ip", re.compile(rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("card", re.compile(r"(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d)")),
    ("phone", re.compile(r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
                         r"|(?<![\w+])\+(?!1[ .(-])\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)"
                         r"|(?<![\w.+-])1[ .-](?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])"
                         r"|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
                         r"|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
                         # spaces as separators: not inside a row of numbers
                         r"|(?<![\w.+-])(?<!\d )\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])(?! \d)"
                         r"|(?<![\w.+-])(?<!\d )0\d{1,4}[ -]\d{3,4}[ -]?\d{3,4}(?![\w-])(?! \d)"
                         # no separators: only what the North American plan allows
                         r"|(?<![\w.+=#/-])(?:[2-9]\d\d){2}\d{4}(?![\w/-])(?!\.\d)")),
]
# Lengths of the IBAN registry.
_IBAN_LENGTH = {c: int(x[:2]) for x in (
    "15NO 16BE 18DKFIFOGLNL 19MKSI 20ATBAEEKZLTLUXK 21CHLILV 22BGBHCRDEGBGEIEMERSVA 23AEGIILIQTL 24ADCZESMDPKROSASESKTNVG "
    "25LYPTST 26HRISTR 27FRGRITMCMRSM 28ALAZBYCYDOGTHULBPLSV 29BREGPSQAUA 30JOKWMU 31MTSC 32LC").split()
    for c in re.findall("..", x[2:])}
_COUNTRY = re.compile(r"\+(\d{1,3})(?=[ .(-])")
_DIGIT = re.compile(r"\d")
_TITLE = re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, MALE + FEMALE), key=len, reverse=True)) + r")\b\.?")
_NAME = re.compile(r"[^\S\n]((?:[^\W\d_]+(?:['’-][^\W\d_]+)*[^\S\n]){0,2}[^\W\d_]+(?:['’-][^\W\d_]+)*)")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban(value: str) -> bool:
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _ibans(pattern: re.Pattern, text: str) -> Iterator[tuple[int, int, str, str]]:
    """A match may run into words after the number: of its valid beginnings the one of the country's
    length counts, else the longest."""
    m = pattern.search(text)
    while m:
        tries = []
        for end in [m.end(), *(m.start() + i for i, c in enumerate(m.group()) if c == " ")]:
            value = text[m.start():end].replace(" ", "")
            if _iban(value):
                tries.append((len(value) == _IBAN_LENGTH.get(value[:2]), end, value))
        if tries:
            _, end, value = max(tries)
            yield m.start(), end, "iban", value
        m = pattern.search(text, end if tries else m.start() + 1)


def _american(digits: str) -> bool:
    """Ten digits that the North American numbering plan allows."""
    return len(digits) == 10 and digits[0] > "1" and digits[3] > "1"


def script(word: str) -> str:
    c = ord(next((c for c in word if c.isalpha()), "a"))
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def _without(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    """The text with the spans blanked out, places unchanged."""
    out, last = [], 0
    for a, b, *_ in sorted(spans):
        if a >= last:
            out += [text[last:a], "\0" * (b - a)]
            last = b
    return "".join([*out, text[last:]])


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities of a text; none overlap."""
    found: list[tuple[int, int, str, str]] = []
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        before = text.rfind("@", 0, m.start()) + 1
        signs = len(text[before:m.start()].rstrip(_LOCAL_SIGNS))
        local = _LOCAL.search(text, before + signs, m.start()) if text[m.start() - 1: m.start()] != "." else None
        if local:
            found.append((local.start(), m.end(), "email", text[local.start(): m.end()].lower()))
    if _DIGIT.search(text):
        rest = _without(text, found)   # what one kind has taken, no later kind runs into
        for kind, pattern in _NUMBERS:
            taken = []
            if kind == "iban":
                taken += _ibans(pattern, rest)
            for m in pattern.finditer(rest) if kind != "iban" else ():
                value = m.group()
                if kind == "ip":
                    value = ".".join(str(int(x)) for x in value.split("."))
                else:
                    value = "".join(_DIGIT.findall(value))
                    if kind == "phone":
                        if not 7 <= len(value) <= 15:
                            continue
                        # the country code stays: what a separator sets off, else one digit; so does a trunk 0
                        code = _COUNTRY.match(m.group())
                        keep = len(code.group(1)) if code else int(m.group()[0] == "+" or value[0] == "0" or len(value) == 11)
                        value = f"{keep}:{value}"
                taken.append((m.start(), m.end(), kind, value))
            found += taken
            rest = _without(rest, taken)
    for m in _TITLE.finditer(text):
        gender = "m" if m.group().rstrip(".") in MALE else "f"
        n = _NAME.match(text, m.end())
        if not n:
            continue
        words = []
        for w in re.finditer(r"\S+", n.group(1)):
            if not w.group()[0].isupper():
                break
            words.append((n.start(1) + w.start(), n.start(1) + w.end(), w.group()))
        for i, (a, b, w) in enumerate(words):
            last = i == len(words) - 1
            found.append((a, b, f"family_{script(w)}" if last else f"given{gender}_{script(w)}", w.lower()))
    names = {v: k for _, _, k, v in found if k[:5] in ("given", "famil")}
    if names:   # later mentions without a title are the same person
        again = re.compile(r"(?<![\w@.])(?:" + "|".join(sorted(map(re.escape, names), key=len, reverse=True)) + r")(?![\w@])", re.I)
        found += [(m.start(), m.end(), names[m.group().lower()], m.group().lower())
                  for m in again.finditer(text) if m.group()[0].isupper() and m.group().lower() in names]
    found.sort(key=lambda x: (x[0], -x[1]))
    out, stop = [], 0
    for x in found:
        if x[0] >= stop:
            out.append(x)
            stop = x[1]
    return out


class Surrogates:
    """Keyed permutations of the values of a kind and shape."""

    def __init__(self, key: str):
        self.key = hashlib.sha256(key.encode()).digest()

    def _noise(self, tweak: str, r: int, x: int) -> int:
        h = hashlib.blake2b(f"{tweak}|{r}|{x}".encode(), key=self.key, digest_size=32)
        return int.from_bytes(h.digest(), "big")

    def permute(self, x: int, size: int, tweak: str) -> int:
        """A permutation of range(size): balanced Feistel rounds, walked until inside."""
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        while True:
            left, right = x >> half, x & mask
            for r in range(ROUNDS):
                left, right = right, left ^ (self._noise(tweak, r, right) & mask)
            x = left << half | right
            if x < size:
                return x

    def shaped(self, text: str, tweak: str) -> str:
        """Letters become letters, digits digits; anything else stays.  A long text goes in pieces that
        the noise covers."""
        if len(text) > PIECE:
            return "".join(self.shaped(text[i:i + PIECE], f"{tweak}|{len(text)}|{i}") for i in range(0, len(text), PIECE))
        radix = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in text]
        shape = "".join("9" if r == 10 else "a" if r == 26 else c for r, c in zip(radix, text))
        x, size = 0, 1
        for r, c in zip(radix, text):
            x = x * r + (int(c) if r == 10 else ord(c.lower()) - 97 if r == 26 else 0)
            size *= r
        if size == 1:
            return text
        x, out = self.permute(x, size, f"{tweak}|{shape}"), []
        for r, c in zip(reversed(radix), reversed(text)):
            x, d = divmod(x, r)
            out.append(str(d) if r == 10 else chr(97 + d) if r == 26 else c)
        return "".join(reversed(out))

    def value(self, kind: str, value: str, attempt: int = 0) -> str:
        """The surrogate of a canonical value, canonical itself."""
        tweak = f"{kind}|{attempt}"
        grown = attempt // 8   # where many values of a shape are taken, surrogates become longer
        if kind == "email":
            local, domain = value.rsplit("@", 1)
            local += "a" * grown
            labels = domain.split(".")
            tail = labels[-1] if labels[-1] in ("com", "org", "net") else "com"
            host = labels[:-2] if len(labels) > 2 and labels[-2] == "example" else labels[:-1]
            # reserved names only; the permutation runs over the whole address
            mixed = self.shaped("@".join([local, ".".join(host)]) if host else local, f"{tweak}|{domain if not host else tail}")
            local, _, host = mixed.partition("@")
            return f"{local}@{host + '.' if host else ''}example.{tail}"
        if kind == "ip":
            x = self.permute(int.from_bytes(bytes(map(int, value.split("."))), "big"), 1 << 32, tweak)
            return ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "card":
            n = len(value)
            if _luhn(value):
                body = value[0] + f"{self.permute(int(value[1:-1]), 10 ** (n - 2), f'{tweak}|{value[0]}|{n}'):0{n - 2}d}"
                return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
            x = int(value[1:])
            while True:   # walk past the valid numbers, so an invalid one stays invalid
                x = self.permute(x, 10 ** (n - 1), f"{tweak}|{value[0]}|{n}|no")
                if not _luhn(out := value[0] + f"{x:0{n - 1}d}"):
                    return out
        if kind == "ssn":
            return f"{self.permute(int(value), 10 ** 9, tweak):09d}"
        if kind == "phone":
            head, digits = value.split(":")
            keep = int(head)
            rest = out = digits[keep:] + "0" * min(grown, 15 - len(digits))
            while True:   # walk until as good a number as before: what was found without separators is found again
                out = f"{self.permute(int(out), 10 ** len(rest), f'{tweak}|{digits[:keep]}|{len(rest)}'):0{len(rest)}d}"
                if keep or out[0] != "0" and _american(out) == _american(rest):
                    return f"{head}:{digits[:keep]}{out}"
        if kind == "iban":
            body = self.shaped(value[4:].lower(), f"{tweak}|{value[:2]}").upper()
            check = 98 - int("".join(str(int(c, 36)) for c in body + value[:2] + "00")) % 97
            return f"{value[:2]}{check:02d}{body}"
        role, alphabet = kind.split("_")
        consonants, vowels, ends = (x.split() if isinstance(x, str) else x for x in SOUNDS[alphabet])
        gender = role[5:] if role.startswith("given") else ""
        x = self._noise(f"{tweak}|{value}", 0, 0)
        out = ""
        for _ in range(3 + grown):
            x, a = divmod(x, len(consonants))
            x, b = divmod(x, len(vowels))
            out += consonants[a] + vowels[b]
        last = ends[gender].split()
        if out[-1] == last[0]:
            out = out[:-1]
        return out + last[x % len(last)]


def write(kind: str, original: str, value: str) -> str:
    """A canonical surrogate in the format of an occurrence."""
    if kind in ("card", "ssn", "phone"):
        digits = iter(value.split(":")[-1])
        return "".join([*(next(digits) if c.isdigit() else c for c in original), *digits])
    if kind == "iban":
        letters = iter(value)
        return "".join(c if c == " " else next(letters) for c in original)
    if kind == "ip":
        return value
    if original.isupper():
        return value.upper()
    if kind == "email":
        return value
    return value.capitalize() if original[0].isupper() else value


def occurrences(docs: DataFrame) -> DataFrame:
    """__null, __id, __digest (the row), kind, value: each entity of each document once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, "text"):
            rows, kinds, values = [], [], []
            for i, t in enumerate(batch.column(3).to_pylist()):
                for kind, value in {(k, v) for _, _, k, v in find(t)} if t else ():
                    rows.append(i)
                    kinds.append(kind)
                    values.append(value)
            keys = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([keys.column(0), keys.column(1), keys.column(2), pa.array(kinds, pa.string()),
                                              pa.array(values, pa.string())], ["__null", "__id", "__digest", "kind", "value"])

    ship(docs.sparkSession)
    return docs.select(*_keys(), "text").mapInArrow(
        run, "__null boolean, __id long, __digest long, kind string, value string")


def _keys():
    return [F.col("doc_id").isNull().alias("__null"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"),
            text_digest().alias("__digest")]


def _named(entities: DataFrame, key: str) -> DataFrame:
    """kind, value, attempt -> with ``surrogate``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Surrogates(key)
        for batch in batches:
            out = [made.value(k, v, a) for k, v, a in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())],
                                             ["kind", "value", "attempt", "surrogate"])

    return entities.select("kind", "value", "attempt").mapInArrow(
        run, "kind string, value string, attempt int, surrogate string")


def moved(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, value, attempt of the entities whose first surrogate collides.

    A surrogate belongs to the smallest value that asks for it first and may not be an entity of the
    input; each round moves the others on and checks only them against all.  In a shape that is nearly
    used up few attempts succeed, so late rounds try many at a time; an entity keeps its earliest."""
    entities = materialize(entities.select("kind", "value").distinct())
    originals = entities.select("kind", F.col("value").alias("surrogate"))
    settled, round_, tried, at_once = None, 0, 0, 1
    left = entities
    while tried < MOST_ATTEMPTS:
        attempts = F.explode(F.sequence(F.lit(tried), F.lit(tried + at_once - 1)))
        asking = materialize(_named(left.select("kind", "value", attempts.alias("attempt")), key))
        winners = asking.join(originals, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            winners = winners.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        first = winners.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        won = winners.join(first, ["kind", "surrogate", "value"]).groupBy("kind", "value").agg(
            F.min(F.struct("attempt", "surrogate")).alias("w"))
        won = materialize(won.select("kind", "value", "w.attempt", "w.surrogate"))
        settled = won if settled is None else settled.unionByName(won)
        left = materialize(left.join(won.select("kind", "value"), ["kind", "value"], "left_anti"))
        if left.isEmpty():
            return settled.where("attempt > 0").select("kind", "value", "attempt")
        round_, tried = round_ + 1, tried + at_once
        if round_ >= SINGLE_ROUNDS:
            at_once = min(2 * at_once, AT_ONCE)
            settled = materialize(settled)
    # addresses, names and phone numbers have grown by then; the other shapes have 10 ** 9 values or more
    raise ValueError(f"no value of a fixed shape is left after {MOST_ATTEMPTS} attempts for each entity")


def pseudonymize(docs: DataFrame, key: str = KEY, count: str | None = None) -> DataFrame:
    """The documents with surrogates in ``text``; ``count`` names an added column of replacements."""
    spark = docs.sparkSession
    seen = materialize(occurrences(docs))
    path = new_location(spark, "pii")
    (seen.join(moved(seen, key), ["kind", "value"]).groupBy("__null", "__id", "__digest")
     .agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("__moved")).write.parquet(path))
    special = spark.read.parquet(path)   # its size is known to the planner
    names = [c for c in docs.columns if c != count]
    joined = docs.select(*[F.col(f"`{c}`") for c in names], *_keys()).join(
        special, ["__null", "__id", "__digest"], "left").select(*[F.col(f"`{c}`") for c in names], "__moved")
    schema = StructType([docs.schema[c] for c in names] + ([StructField(count, LongType())] if count else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Surrogates(key)
        for batch in parts(batches, "text"):
            texts, counts = [], []
            for t, special in zip(batch.column(names.index("text")).to_pylist(), batch.column(len(names)).to_pylist()):
                entities = find(t) if t else []
                counts.append(len(entities))
                if not entities:
                    texts.append(t)
                    continue
                attempts = {(s["kind"], s["value"]): s["attempt"] for s in special or ()}
                pieces, last = [], 0
                for a, b, kind, value in entities:
                    pieces += [t[last:a], write(kind, t[a:b], made.value(kind, value, attempts.get((kind, value), 0)))]
                    last = b
                texts.append("".join([*pieces, t[last:]]))
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(i) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(counts, pa.int64())] if count else []),
                                             names + ([count] if count else []))

    return joined.mapInArrow(run, schema)


def op2(spark, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents"), count="n_replaced").select("doc_id", "text", "n_replaced")


def replace_private(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: entities become surrogates."""
    return pseudonymize(docs)

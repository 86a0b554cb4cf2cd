"""Personal data and secrets replaced by surrogates that keep type, format, script and gender.

A surrogate follows from a secret key, the kind and the normal form of what it replaces: the same entity gets
the same surrogate everywhere, in any spelling. The first draft of a surrogate needs no lookup. A check over the
distinct entities of the corpus finds drafts that two entities share, or that are real entities themselves,
and draws again for these, until all are distinct; only these few travel back to the documents that hold them.
"""

import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.worker import give_back, keep_only
from quillrank.storage import Scratch, broadcast_if_small

KEY = "quillrank surrogates"  # replace it by a secret of your own
_REDRAWN_ROWS, _REDRAWN_BYTES = 200_000, 32 << 20
_TOGETHER = 1_000  # texts that are returned as one frame

# Titles before names, by gender; n is for either.
TITLES = {
    "f": "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Mlle Señora Sra Señorita Srta Signora Госпожа Г-жа Κυρία",
    "m": "Mr Mister Sir Herr Herrn Monsieur Señor Sr Signor Господин Г-н Κύριος",
    "n": "Dr Prof Professor Doctor Doktor Docteur",
}
_GENDER = {title.lower(): gender for gender, titles in TITLES.items() for title in titles.split()}
_TITLE = "|".join(sorted(map(re.escape, (t for titles in TITLES.values() for t in titles.split())), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

_UPPER = "".join(c for c in map(chr, range(0x2000)) if c.isupper() or c.istitle())
# A part of a name: an initial, or a word with capitals after apostrophes.
_PART = rf"(?:[{_UPPER}](?:\.|(?=[ ][{_UPPER}])|(?:['’](?=[{_UPPER}])|\w)+))"
_HEX = r"[0-9A-Fa-f]{1,4}"
_COUNTRY = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
_DATE_AT = r"\d\d(?P<between>[./-])\d\d(?P=between)\d{4}(?!\d)"
# Digits in any groups, as many as there are: how many is checked afterwards.
_GROUPS = r"(?:(?:[ ]?\(\d{1,4}\)[ ]?|[ ./-]?)\d)"

_ENTITY = re.compile(
    rf"""
    (?P<email>(?<![\w.+-])\w(?:[\w.%+-]*[\w%+-])?@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{{2,}})
  | (?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d))
  | (?P<ip6>(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,6}})?|::{_HEX}(?::{_HEX}){{1,6}})(?![\w:]|\.\d))
  | (?P<key>\b(?:AKIA|ASIA)[A-Z0-9]{{16}}\b|\bgh[pousr]_[A-Za-z0-9]{{36,}}|\bsk-[A-Za-z0-9_-]{{20,}})
  | (?P<secret>(?<![\w])(?i:password|passwd|pwd|secret|token|api[_-]?key)(?:\s*[=:]\s*)["']?(?P<value>[^\s"',;]{{6,}}))
  | (?P<iban>\b[A-Z]{{2}}\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?\b)
  | (?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
  | (?P<card>(?<![\w.-])\d(?:[ -]?\d){{12,18}}(?![\w-]))
  | (?P<phone>(?<![\w.])(?:\+|00(?=[1-9]))\(?\d\)?{_GROUPS}{{7,}}+(?![\w-])
      |(?<![\w.+/-])(?!{_DATE_AT})\(?0[1-9]\d{{0,3}}\)?{_GROUPS}{{4,}}+(?![\w-])
      |(?<![\w.+/-])[6-9]\d\d(?:[ .-]\d\d){{3}}(?![\w-]|[ .-]\d)
      |(?<![\w.])(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)[ ]?|\d{{2,4}}[ .-])\d{{3,4}}[ .-]\d{{3,4}}(?![\w-])|(?<![\w.])\+\d{{8,15}}(?![\w-]))
  | (?P<name>\b(?P<title>{_TITLE})\.?[ ](?P<who>{_PART}(?:(?:[ -]|(?<=\.))(?!(?:{_TITLE})\b){_PART})*|[^\W\d_a-z]\w+(?:[ -][^\W\d_a-z]\w+)?))
    """,
    re.X,
)
_MAY_HOLD = re.compile(rf"[0-9@]|\bA[KS]IA[A-Z]|\bgh[pousr]_|\bsk-|(?i:passw|pwd|secret|token|api.?key)|\b(?:{_TITLE})\.?[ ]")# What every text has that _MAY_HOLD finds, and most texts have not: digits or @ first, then capitals and rare letters. Folded, for any case.
_DIGIT = re.compile("[0-9@]")
_TITLED = re.compile(rf"(?:{_TITLE})\.?[ ]")
_PLAIN = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-")
_FOLDED = ("passw", "pwd", "secret", "token", "key")


def _may_hold(text: str) -> bool:
    """Whether ``_MAY_HOLD`` finds anything, without its slow search in texts that plainly have nothing."""
    if _DIGIT.search(text):
        return True
    if any(map(text.__contains__, _PLAIN)) or any(map(text.casefold().__contains__, _FOLDED)) or _TITLED.search(text):
        return bool(_MAY_HOLD.search(text))
    return False


# What made-up names consist of, by script: consonants, vowels, female and male endings.
_SYLLABLES = {
    "LATIN": ("b c d f g k l m n p r s t v z".split(), "a e i o u".split(), "ina ela ara issa".split(), "en or ik ald".split()),
    "CYRILLIC": ("б в г д з к л м н п р с т".split(), "а е и о у".split(), "ина ела ара иса".split(), "ен ор ик ад".split()),
    "GREEK": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο ω".split(), "ινα ελα αρα ισα".split(), "ενος ορος ικος αλος".split()),
}


class _Stream:
    """Choices that follow from the secret key and a name."""

    def __init__(self, key: str, *name: object):
        self._key, self._name = key.encode(), "\0".join(map(str, name)).encode()
        self._bytes, self._block = b"", 0

    def below(self, n: int) -> int:
        if len(self._bytes) < 4:
            self._bytes += hmac.digest(self._key, self._block.to_bytes(4, "big") + self._name, "sha256")
            self._block += 1
        drawn, self._bytes = int.from_bytes(self._bytes[:4], "big"), self._bytes[4:]
        return drawn % n

    def of(self, choices):
        return choices[self.below(len(choices))]


def _luhn_digit(digits: str) -> str:
    """The last digit that makes ``digits`` with it a valid card number."""
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 else sum(divmod(2 * digit, 10))
    return str(-total % 10)


def _iban_ok(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _like(text: str, stream: _Stream) -> str:
    """Letters for letters of the same case, digits for digits; the rest stays. Hexadecimal stays hexadecimal."""
    letters = "abcdef" if re.fullmatch(r"[0-9a-f]+", text) else "abcdefghijklmnopqrstuvwxyz"
    out = []
    for c in text:
        if c.isdigit():
            out.append(stream.of("0123456789"))
        elif c.isalpha():
            drawn = stream.of(letters)
            out.append(drawn.upper() if c.isupper() else drawn)
        else:
            out.append(c)
    return "".join(out)


def _made_up(gender: str, script: str, words: int, stream: _Stream) -> str:
    consonants, vowels, female, male = _SYLLABLES[script]
    syllables = lambda n: "".join(stream.of(consonants) + stream.of(vowels) for _ in range(n))
    ending = stream.of({"f": female, "m": male}.get(gender, ["is", "an"] if script == "LATIN" else vowels))
    first = syllables(2) + stream.of(consonants) + ending
    return " ".join([first, *(syllables(3) + stream.of(consonants) for _ in range(words - 1))])


def draft(kind: str, normal: str, attempt: int, key: str = KEY) -> str:
    """The surrogate of a normal form in its normal form; another attempt gives another."""
    stream = _Stream(key, kind, normal, attempt)
    if kind == "email":
        local, _, domain = normal.partition("@")
        ending = domain.rpartition(".")[2]
        return f"{_like(local, stream)}@{_like('abcdef', stream)}.example.{ending if ending in ('com', 'net', 'org') else 'org'}"
    if kind == "ip":
        # The reserved block 240.0.0.0/4 for public addresses, 10.0.0.0/8 for private ones.
        private = re.match(r"10\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.", normal)
        return ".".join(map(str, [10 if private else 240 + stream.below(15), *(stream.below(254) + 1 for _ in range(3))]))
    if kind == "ip6":
        # The block for documentation; no group is zero, so this is the normal form.
        return "2001:db8:" + ":".join(f"{stream.below(0xFFFF) + 1:x}" for _ in range(6))
    if kind == "phone":
        return stream.of("6789" if normal[0] in "6789" else "123456789") + _like(normal[1:], stream)
    if kind == "card":
        digits = normal[0] + "".join(stream.of("0123456789") for _ in normal[1:-1])
        return digits + _luhn_digit(digits)
    if kind == "key":
        head = re.match(r"AKIA|ASIA|gh[pousr]_|sk-", normal)[0]
        return head + _like(normal[len(head) :], stream)
    if kind == "iban":
        body = _like(normal[4:], stream)
        check = 98 - int("".join(str(int(c, 36)) for c in body + normal[:2] + "00")) % 97
        return f"{normal[:2]}{check:02d}{body}"
    if kind == "name":
        gender, script, who = normal.split(":", 2)
        return _made_up(gender, script, len(who.split()), stream)
    return _like(normal, stream)  # ssn: digits; secret: as it looks


def _script(text: str) -> str:
    name = unicodedata.name(next(c for c in text if c.isalpha()), "LATIN")
    return name.split()[0] if name.split()[0] in _SYLLABLES else "LATIN"


_NAME_PART = re.compile(r"[^ .-]+\.?")


def _normal(found: re.Match) -> tuple[str, str, str] | None:
    """(kind, normal form, the part of the text that is replaced), or None if it only looks like an entity."""
    kind, text = found.lastgroup, found[0]
    # Groups inside groups end before the outer ones, so lastgroup names the kind.
    digits = re.sub(r"\D", "", text)
    if kind == "email":
        return kind, text.lower(), text
    if kind == "secret":
        return kind, found["value"], found["value"]
    if kind == "iban":
        plain = text.replace(" ", "")
        return (kind, plain, text) if _iban_ok(text) else None
    if kind == "card":
        if digits[-1] == _luhn_digit(digits[:-1]):
            return kind, digits, text
        if not text.startswith("0"):
            return None
        kind = "phone"
    if kind == "phone":
        # Without country code and leading zeros, so that both spellings are one number.
        abroad = text.startswith(("+", "00"))
        if not (8 if abroad or re.match(r"\(?0", text) else 7) <= len(digits.lstrip("0") if abroad else digits) <= 15:
            return None
        plain = digits.lstrip("0")
        if abroad:
            plain = plain[_COUNTRY.match(plain).end() :].lstrip("0")
        return ("phone", plain, text) if plain else None
    if kind == "ip6":
        try:
            return (kind, ipaddress.IPv6Address(text).compressed, text) if re.search(r"\d", text) else None
        except ValueError:
            return None
    if kind == "ssn":
        return kind, digits, text
    if kind == "name":
        gender = _GENDER[found["title"].lower()]
        who = found["who"]
        return kind, f"{gender}:{_script(who)}:{' '.join(_NAME_PART.findall(who)).lower()}", who
    return kind, text, text


def _shown(kind: str, surrogate: str, original: str) -> str:
    """The surrogate in the format of the text it replaces."""
    if kind in ("card", "phone", "ssn", "iban"):
        # From the end, so that a country code in front, which the normal form leaves out, stays.
        left, out = list(surrogate), []
        for c in reversed(original):
            out.append(left.pop() if c.isalnum() and left else c)
        return "".join(reversed(out))
    if kind == "email":
        return surrogate.upper() if original.isupper() else surrogate
    if kind == "name":
        words = iter(surrogate.split(" "))

        def part(old: re.Match) -> str:
            new = next(words)
            if len(old[0].rstrip(".")) == 1:
                return new[0].upper() + old[0][1:]
            return new.upper() if original.isupper() else new.capitalize()

        return _NAME_PART.sub(part, original)
    return surrogate


def entities(text: str | None) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of every entity, from left to right."""
    if not text or not _may_hold(text):
        return
    at = 0
    while found := _ENTITY.search(text, at):
        what = _normal(found)
        at = found.end()
        if what is None:
            # Only a look-alike: what is inside it may still be something else.
            at = found.start() + 1
            while at < len(text) and text[at - 1].isalnum() and text[at].isalnum():
                at += 1
            continue
        kind, normal, part = what
        start = text.index(part, found.start({"secret": "value", "name": "who"}.get(kind, 0)))
        yield start, start + len(part), kind, normal


def replaced(text: str | None, redrawn: dict[tuple[str, str], str], key: str = KEY) -> tuple[str | None, int]:
    """The text with surrogates, and how many; ``redrawn`` holds those that differ from the first draft."""
    out, at, count = [], 0, 0
    for start, end, kind, normal in entities(text):
        surrogate = redrawn.get((kind, normal)) or draft(kind, normal, 0, key)
        out += [text[at:start], _shown(kind, surrogate, text[start:end])]
        at, count = end, count + 1
    return ("".join([*out, text[at:]]), count) if count else (text, 0)


_ENTITY_FIELDS = "text_key bigint, kind string, normal string"


def _found(documents: DataFrame) -> DataFrame:
    """(text_key, kind, normal): the entities of every row, each once per row."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_only()
        for frame in frames:
            found = [
                (text_key, kind, normal)
                for text_key, text in zip(frame["text_key"], frame["text"], strict=True)
                for kind, normal in dict.fromkeys((kind, normal) for _, _, kind, normal in entities(text))
            ]
            del frame  # before the next one is read
            yield pd.DataFrame(found, columns=["text_key", "kind", "normal"])
        give_back()

    return documents.select(F.xxhash64("text").alias("text_key"), "text").mapInPandas(rows, _ENTITY_FIELDS)


def surrogates(found: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """(kind, normal, attempt, surrogate) of every distinct entity; surrogates of a kind are distinct and no entities."""

    @F.pandas_udf("string")
    def drafts(kind: pd.Series, normal: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([draft(k, n, a, key) for k, n, a in zip(kind, normal, attempt, strict=True)], dtype=object)

    # A name's normal form holds gender and script as well; what must not be met again is the name itself.
    plain = F.when(F.col("kind") == "name", F.substring_index("normal", ":", -1)).otherwise(F.col("normal"))
    known = scratch.stored(found.select("kind", "normal").distinct())
    real = known.select("kind", plain.alias("surrogate")).distinct().withColumn("is_real", F.lit(True))
    drawn = known.withColumn("attempt", F.lit(0))
    while True:
        drawn = scratch.stored(
            drawn.select("kind", "normal", "attempt").withColumn("surrogate", drafts("kind", "normal", "attempt"))
        )
        shared = drawn.groupBy("kind", "surrogate").agg(F.min("normal").alias("first"), F.count("*").alias("n"))
        wrong = (
            shared.join(real, ["kind", "surrogate"], "left").where("n > 1 or is_real")
            .select("kind", "surrogate", F.when(F.col("is_real").isNull(), F.col("first")).alias("keeps"))
        )
        wrong = scratch.stored(wrong)
        if wrong.isEmpty():
            return drawn
        again = F.col("wrong") & ~F.col("normal").eqNullSafe(F.col("keeps"))
        drawn = drawn.join(wrong.withColumn("wrong", F.lit(True)), ["kind", "surrogate"], "left").select(
            "kind", "normal", (F.col("attempt") + F.when(again, 1).otherwise(0)).alias("attempt")
        )


def with_surrogates(documents: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """``documents`` with every entity of ``text`` replaced, and ``n_entities``, how many there were.

    Texts without entities, null and empty ones stay as they are. Other columns are untouched, but a column
    ``n_chars`` follows the text where it changed; ``n_entities`` takes the place of a column of that name. Rows
    are independent: null ids and repeated rows do not matter. The result reads from ``scratch``.
    """
    found = scratch.stored(_found(documents))
    redrawn = surrogates(found, scratch, key).where("attempt > 0").select("kind", "normal", "surrogate")
    redrawn = scratch.stored(redrawn)
    # The row travels whole, so its columns may have any names.
    rows = documents.select(F.struct("*").alias("row"), "text", F.xxhash64("text").alias("text_key"))
    if redrawn.isEmpty():
        rows = rows.withColumn("redrawn", F.lit(None).cast("array<struct<kind:string,normal:string,surrogate:string>>"))
    else:
        by_text = scratch.stored(
            found.distinct().join(redrawn, ["kind", "normal"]).groupBy("text_key")
            .agg(F.collect_list(F.struct("kind", "normal", "surrogate")).alias("redrawn"))
        )
        by_text = broadcast_if_small(by_text, F.size("redrawn") * 256, _REDRAWN_ROWS, _REDRAWN_BYTES)
        rows = rows.join(by_text, "text_key", "left")

    @F.pandas_udf("struct<text:string,n:int>")
    def exchange(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        keep_only()
        for texts, redrawn in batches:
            for at in range(0, len(texts), _TOGETHER):  # short frames, so that little is copied at a time
                out = []
                for text, other in zip(texts[at : at + _TOGETHER], redrawn[at : at + _TOGETHER], strict=True):
                    names = {} if other is None else {(o["kind"], o["normal"]): o["surrogate"] for o in other}
                    out.append(replaced(text, names, key))
                yield pd.DataFrame(out, columns=["text", "n"])
                del out
            del texts, redrawn
        give_back()

    new = rows.select("row", exchange("text", "redrawn").alias("new"))
    columns = {c: F.col(f"row.`{c}`") for c in documents.columns if c != "n_entities"}
    columns["text"] = F.col("new.text")
    if "n_chars" in columns:
        length = F.when(F.col("new.n") > 0, F.length("new.text")).otherwise(columns["n_chars"])
        columns["n_chars"] = length.cast(documents.schema["n_chars"].dataType)
    return new.select(*[column.alias(name) for name, column in columns.items()], F.col("new.n").alias("n_entities"))
